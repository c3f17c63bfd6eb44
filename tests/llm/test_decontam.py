import numpy as np

from affinity.llm import decontam as D

ITEM = ("What is the capital of the small green kingdom by the northern sea near old mountains?\n"
        "It is the walled city of Halvarn upon the river")
OTHER = "Count the seven silver boats. Seven boats"


def items(spark, rows=((1, ITEM), (2, OTHER), (3, None), (4, ""), (None, "null id item text"))):
    return spark.createDataFrame([(*r, "z") for r in rows], "item_id long, text string, term string")


def pairs(docs, its, **kw):
    return sorted((r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, its, **kw).collect())


def test_wand_equals_brute_force():
    g = np.random.default_rng(0)
    vocab = [f"t{i}".encode() for i in range(60)]
    parts = []
    for k in range(90):
        t = g.choice(60, size=g.integers(2, 12), replace=False)
        w = g.random(len(t))
        parts.append(((k, 0), dict(zip([vocab[x] for x in t], w / w.sum()))))
    index = D.Index(parts, {})
    for _ in range(200):
        q = [vocab[x] for x in g.choice(60, size=g.integers(1, 30), replace=False)]
        least = g.uniform(0.1, 0.9)
        want = {d: sum(p.get(t, 0.0) for t in q) for d, (_, p) in enumerate(parts)}
        want = {d: s for d, s in want.items() if s >= least}
        got = index.search([index.terms[t] for t in q if t in index.terms], least)
        assert set(got) == set(want) and all(abs(got[d] - want[d]) < 1e-9 for d in got)


def test_question_and_answer():
    q, a = D.question_answer(ITEM)
    assert q[0] == b"what" and a[:2] == [b"it", b"is"]
    assert D.question_answer("Count them. Seven boats")[1] == [b"seven", b"boats"]
    assert D.question_answer("one sentence") == ([b"one", b"sentence"], [])
    assert D.question_answer(None) == ([], [])


def test_leaks_are_found_and_clean_texts_left(spark):
    filler = " ".join(f"word{i}" for i in range(1000))
    rows = [(10, filler + " " + ITEM + " " + filler), (11, ITEM.upper().replace("\n", "  ")), (12, filler),
            (13, ITEM.split("\n")[0] + " " + filler), (14, ITEM.split("\n")[1]), (15, OTHER + " " + ITEM), (15, OTHER + " " + ITEM),
            (16, None), (17, ""), (18, "the is of by near it upon " * 200)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    assert pairs(docs, items(spark)) == [(10, 1), (11, 1), (15, 1), (15, 1), (15, 2), (15, 2)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert pairs(docs, items(spark).limit(0)) == [] and pairs(docs.limit(0), items(spark)) == []


def test_long_items_and_several_shards(spark, monkeypatch):
    long = " ".join(f"unique{i} phrase{i * 7}" for i in range(200))
    its = items(spark, [(k, f"Item number{k} asks about thing{k} and place{k}. Reply{k} given here{k}") for k in range(30)] + [(99, long)])
    monkeypatch.setattr(D, "SHARD_PARTS", 7)
    docs = spark.createDataFrame([(k, f"before it Item number{k} asks about thing{k} and place{k}. Reply{k} given here{k} after")
                                  for k in range(0, 30, 3)] + [(500, "x " * 300 + long)], "doc_id long, text string")
    assert pairs(docs, its) == [(k, k) for k in range(0, 30, 3)] + [(500, 99)]


def test_benchmark_table_equals_substring_search(spark):
    sf = "/root/testdata/sf0.001"
    its = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r["doc_id"], r["item_id"]) for r in D.query(spark, sf).collect())
    assert got == sorted((d, i) for d, t in docs for i, x in its if x in t)


def test_partly_quoted_long_items(spark):
    words = [f"unique{i % 200} phrase{i * 7}" for i in range(200)]
    long = " ".join(words) + ".\nThe reply is short and given here"             # 400 words and an answer
    middle = " ".join(f"asks{i}" for i in range(100)) + ". This last sentence answers it"
    essay = "Tell me all.\n" + " ".join(f"essay{i}" for i in range(300))
    its = items(spark, [(1, long), (2, middle), (3, essay)])
    filler = " ".join(f"word{i}" for i in range(300))
    rows = [(10, f"{filler} {' '.join(words[60:135])} {filler}"),              # 150 words of the middle
            (11, f"{filler} {middle.split('. ')[0]} {filler}"),                # no last sentence
            (12, f"{filler} {' '.join(essay.split()[100:220])} {filler}"),     # a piece of the answer
            (13, f"{filler} {' '.join(words[60:68])} {filler}"),               # 16 words
            (14, f"{filler} The reply is short and given here {filler}"), (15, filler), (16, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert pairs(docs, its) == [(10, 1), (11, 2), (12, 3), (16, 1)]


def test_words_of_a_part():
    q, a = list(range(70)), list(range(100, 110))
    assert D.part_of(q, a, 0) == (q[:64], []) and D.part_of(q, a, 1) == (q[32:], a)
    assert D.part_of(q[:60], a, 0) == (q[:60], [])                             # less than half of the answer
    assert D.part_of(q[:2], list(range(200)), 1) == ([], list(range(30, 94)))
