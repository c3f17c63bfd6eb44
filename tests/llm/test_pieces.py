import random

import pytest

from affinity.llm import pieces as P

TEXTS = ["Hello world", " two  spaces   inside ", "tab\tnew\nline\r\n", "été naïve 漢字 \U0001f600 mixed", "a" * 300, "", None,
         "Licensed under the Apache License, Version 2.0.", "x" + " " * 20 + "y", "mark ▁ inside", "CamelCaseWORDS...!!!"]


def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    with open(P.MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1                      # best path by scores over the same pieces
    for p in m.pieces:
        p.score = max(p.score, -50_000.0)              # the library adds up in single precision
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


@pytest.mark.parametrize("head", [3, P.HEAD])
def test_round_trip_and_edges(spark, head):
    rows = [(i, t, "k") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "k"), (None, "null id", "k")]
    got = P.encode_documents(spark.createDataFrame(rows, "doc_id long, text string, seg string"), head=head).collect()
    assert len(got) == len(rows)
    v = P.vocabulary()
    for r in got:
        t = TEXTS[r["doc_id"]] if r["doc_id"] is not None else "null id"
        text = b"".join(v.text[i] for i in r["ids"])[1:].decode()
        assert text == (t or "").replace("▁", " ") and r["n_pieces"] == len(r["ids"])
        assert r["round_trip"] == ("▁" not in (t or ""))


def test_equals_the_library(spark):
    lib = library()
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = [(k, x) for k, x in enumerate(sorted({x for r in df.collect() for x in r["text"].split("\n") if x}))]
    got = P.encode_documents(spark.createDataFrame(lines, "doc_id long, text string"), head=500).collect()
    want = dict(lines)
    assert len(got) == len(lines)
    for r in got:
        assert r["ids"] == lib.encode(want[r["doc_id"]])


def best_path(seg, v):
    """Viterbi over one segment, position by position."""
    pieces = {p: (s, i) for p, i, s in v.rows}
    best = [(0.0, 0, 0)] + [None] * len(seg)
    for end in range(1, len(seg) + 1):
        for start in range(max(0, end - v.longest), end):
            s, i = pieces.get(seg[start:end], (v.unknown, -ord(seg[start])) if end - start == 1 else (None, None))
            if s is not None and (best[end] is None or best[start][0] + s > best[end][0]):
                best[end] = (best[start][0] + s, start, i)
    out, at = [], len(seg)
    while at:
        out.insert(0, best[at][2])
        at = best[at][1]
    return [j for i in out for j in ([i] if i >= 0 else [P.BYTE_0 + b for b in chr(-i).encode()])]


def test_fold_equals_plain_viterbi(spark):
    v = P.vocabulary()
    segs = ["▁the", "▁thereis", "ing", "▁▁▁▁x", "漢", "▁" + "an" * 20, "▁étét", "a" * 200, "ʯ", "\U0001f9ff", "\x01"]
    got = {r["seg"]: r["ids"] for r in P.viterbi(spark.createDataFrame([(s, 1) for s in segs], "seg string, c long")).collect()}
    assert got == {s: best_path(s, v) for s in segs}


def test_empty_table(spark):
    assert P.encode_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_runs_without_a_cut(spark):
    """A path of a long segment equals the lattice's, and 100,000 letters are encoded in whole."""
    v = P.vocabulary()
    g = random.Random(5)
    segs = ["".join(g.choice("abcdeinrst") for _ in range(n)) for n in (1, 7, 60, 300)] + ["aaaaaaaaaaaa", "aéçx€𝄞b"]
    want = {r["seg"]: list(r["ids"]) for r in P.viterbi(spark.createDataFrame([(s, 1) for s in segs], "seg string, c long")).collect()}
    assert {s: P.long_path(s, v) for s in segs} == want
    run = "".join(g.choice("abcdeinrst") for _ in range(100_000))
    rows = [(1, run), (2, "one two " + run[:5000] + " three"), (3, "one two three")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in P.encode_documents(df).collect()}
    assert all(got[i]["round_trip"] and got[i]["n_pieces"] == len(got[i]["ids"]) for i, _ in rows)
    assert P.count_segments(df).where(f"char_length(seg) > {P.LONG}").count() == 0
