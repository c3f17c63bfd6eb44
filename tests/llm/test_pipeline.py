import corpus_pipeline as C
from affinity.llm import neardup

SF = "/root/testdata/sf0.01"


def test_stages_and_decisions(spark):
    assert [n for n, _ in C.STAGES] == ["quality classifier", "toxicity", "near duplicates", "benchmark decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = [{r["doc_id"] for r in docs.collect()}]
    frames = []
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF).cache()
        frames.append(docs)
        left.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert all(f.columns == C.COLUMNS for f in frames[:-1])
    assert all(b <= a for a, b in zip(left, left[1:])) and left[4] == left[5]
    good = [i for i, r in labels.items() if r["quality"] == 1]
    assert sum(i in left[1] for i in good) >= 0.97 * len(good)
    bad = [i for i, r in labels.items() if r["quality"] == 0]
    assert sum(i in left[1] for i in bad) <= 0.1 * len(bad)
    clean = [i for i in left[1] if i in labels and labels[i]["toxic"] == 0]
    assert sum(i in left[2] for i in clean) >= 0.98 * len(clean)
    groups = {}
    for r in neardup.near_duplicates(frames[1]).collect():
        groups.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert left[3] == set(groups)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r["doc_id"] for r in frames[2].collect() if any(x in r["text"] for x in items)}
    assert left[3] - left[4] == leaks
    assert all(r["round_trip"] for r in frames[4].collect())
    for f in frames:
        f.unpersist()


def test_empty_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _score double, _id long"
    rows = [(1, None, None, None, None, 1.0, 1), (2, "", "en", "s", 0, 1.0, 1), (2, "", "en", "s", 0, 1.0, 1), (None, "x y z", "en", "s", 5, 1.0, 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in C.STAGES:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() <= len(data)


def test_rows_of_a_class_are_known_by_their_text(spark):
    """Null ids and ids of two texts: one row of each class is kept."""
    copy, far, other = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(None, far), (None, far + " end"), (None, other), (1, copy), (1, copy + " more"), (2, copy + " end"), (2, "lonely words of the second id")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"][:3]) for r in C.keep_one_of_each(spark, df, "").collect()]
    assert sorted(kept, key=str) == [(1, "a0 "), (2, "lon"), (None, "b0 "), (None, "c0 ")]


def test_leaks_are_known_by_their_text(spark):
    """Rows that share an id, or have none, stay where their own text is clean."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    lone = " ".join(f"plain{i}" for i in range(60))
    rows = [(None, f"before {item} after"), (None, lone + " a"), (7, lone + " b"), (7, f"again {item} end")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"]) for r in C.keep_clean(spark, df, SF).collect()]
    assert sorted(kept, key=str) == sorted([(None, lone + " a"), (7, lone + " b")], key=str)
