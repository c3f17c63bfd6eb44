import hashlib
import os
import random
from collections import Counter

import pyarrow as pa
import pytest

from affinity.llm import align

SCHEMA = "doc_id long, text string, a string, b string"
TEXTS = ["plain words, twice words", "", None, "two  spaces \n\n and\ttabs ", " leading", "trailing ", "   ", "\n", "é ö 漢字 🎉 ünï",
         "don't we're I'll <|endoftext|> <s> </s> <0x41> <unk>", "under▁score", "nul\x00 byte \x1f x", "a" * 3000, "   x 　y",
         "x" * 50 + " " * 40 + "y", "é ‍​ ok", "1234567 89,000.50 $5", "plain words, twice words"]


@pytest.fixture(scope="module")
def pair():
    with open(os.path.join(align.TOKENIZERS, align.FILE_A), encoding="utf-8") as f, \
            open(os.path.join(align.TOKENIZERS, align.FILE_B), "rb") as g:
        return align.Pair(f.read(), g.read())


def whole(pair, text):
    """Token ids with their byte ranges from the whole text, or None."""
    if not text:
        return None
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    sides = []
    for ids, table in ((a, pair.a_bytes), (b, pair.b_bytes)):
        raw = [table[i].as_py() for i in ids]
        if b"".join(raw) != (" " + text).encode():
            return None
        spans, at = [], 0
        for i, r in zip(ids, raw):
            spans.append((i, at, at + len(r)))
            at += len(r)
        sides.append(spans)
    return sides


def brute(pair, rows):
    counts, docs = Counter(), []
    for doc_id, text, *_ in rows:
        sides = whole(pair, text)
        links, groups = [], []
        if sides:
            a, b = sides
            links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 400 else _sweep(a, b)
            cut, last = sorted({x[2] for x in a} & {y[2] for y in b}), 0
            for c in cut:
                groups.append("|".join(",".join(str(t[0]) for t in s if last < t[2] <= c) for s in sides))
                last = c
            counts.update(links)
        docs.append((doc_id, sides, links, groups))
    high = {}
    for (_, b), n in counts.items():
        high[b] = max(n, high.get(b, 0))
    return sorted(((d, len(s[0]) if s else 0, len(s[1]) if s else 0, len(g), len(ln), sum(counts[x] == high[x[1]] for x in ln),
                    sum(counts[x] for x in ln), hashlib.sha256(";".join(g).encode()).hexdigest() if s else "")
                   for d, s, ln, g in docs), key=repr)


def _sweep(a, b):
    out, j = [], 0
    for t, lo, hi in a:
        while j < len(b) and b[j][2] <= lo:
            j += 1
        k = j
        while k < len(b) and b[k][1] < hi:
            out.append((t, b[k][0]))
            k += 1
    return out


@pytest.mark.parametrize("most", [align.MAX_PAIRS, 20, 0])
def test_equals_whole_texts(spark, pair, most):
    rng = random.Random(3)
    bits = ["Straße", " ", " ", " ", "  ", "\n", "word", "tion", "'s", "42", "é", "\t", "🎉", ".", ",", "longerword", " ", "<s>"]
    texts = TEXTS + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    rows = [(None if i == 4 else i // 2, t, "x", "y") for i, t in enumerate(texts)]
    got = align.align_documents(spark.createDataFrame(rows, SCHEMA).repartition(5), max_pairs=most)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(pair, rows)


def test_empty_table(spark):
    got = align.align_documents(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[0] == "doc_id"


def test_words_do_not_change_the_tokens(pair):
    assert pair.by_word
    for text in filter(None, TEXTS):
        a, b = pair.encode(pair.words(text))
        assert a.flatten().to_pylist() == pair.a.encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text:
            assert b.flatten().to_pylist() == pair.b.encode(text)


def test_words_between_single_spaces_are_cut_in_arrow():
    """All texts give the words of ``Pair.words``, which only sees texts with other white space."""
    g = random.Random(9)
    seen = []

    class Cut:
        by_word = True

        def words(self, text):
            seen.append(text)
            return align.WORD_START.split(" " + text)
    signs = [" ", " ", "a", "b", "\u00e9", "\n", "\t", "\u3000", "\u00a0", "\x1f", "\x85", "\u2028", "\u200b"]
    texts = [None, "", " ", "a ", " a", "a\n", "a b\nc d", "a  b"] + [
        "".join(g.choice(signs) for _ in range(g.randrange(8))) for _ in range(3000)] + [f"one two{i} three" for i in range(50)]
    words, lens = align._words(pa.array(texts, pa.string()), Cut())
    want = [align.WORD_START.split(" " + t) if t else [] for t in texts]
    assert words.to_pylist() == [w for x in want for w in x] and lens.tolist() == [len(x) for x in want]
    assert "a  b" in seen and "a b\nc d" not in seen and not any(t.startswith("one") for t in seen)
