import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from affinity.llm import suffix_dedup
from affinity.llm.suffix_dedup import LENGTH

SCHEMA = "doc_id long, text string, row string, body string"


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(t[k:k + LENGTH] for _, t in texts for k in range(len(t) - LENGTH + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - LENGTH + 1):
            if seen[t[k:k + LENGTH]] > 1:
                gone[k:k + LENGTH] = True
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows(seed=1):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdé fgh") for _ in range(n))
    passage, line = text(260), text(205)
    out = [(i, text(rng.randrange(0, 900)), "x", "y") for i in range(20)]
    out += [(100 + i, text(rng.randrange(0, 300)) + passage + text(rng.randrange(0, 300)), "x", "y") for i in range(25)]
    out += [(200 + i, text(150) + line[:195 + i] + text(150), "x", "y") for i in range(8)]      # around the length
    near = text(1500)
    for i in range(12):                                                                       # near copies
        b = list(near)
        for _ in range(i):
            b[rng.randrange(len(b))] = "#"
        out.append((300 + i, "".join(b), "x", "y"))
    out += [(400, near, "x", "y"), (401, near, "x", "y"), (401, near, "x", "y")]
    out += [(500, "a" * 199, "", ""), (501, "ab" * 900, "", ""), (502, "z" * 3000, "", ""), (503, text(300) + "\0" * 210 + text(50), "", "")]
    out += [(600, None, None, None), (601, "", "", ""), (None, text(400), "", ""), (None, passage[:230], "", "")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("most,size", [(suffix_dedup.MAX_CONTEXTS, suffix_dedup.BUCKET_BYTES), (3, 4000)])
def test_equals_brute_force(spark, most, size):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = suffix_dedup.remove_repeats(df, max_contexts=most, bucket_bytes=size).collect()
    assert sorted(map(tuple, got), key=repr) == brute(data)


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_merge_orders_by_the_first_bytes(monkeypatch):
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 500))) for _ in range(30)]
    strings += [strings[3] * 2, b"a" * 450, strings[5][:300], b""]
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1500)
    got = suffix_dedup.repeated_starts(strings)
    seen = Counter(s[k:k + LENGTH] for s in strings for k in range(len(s) - LENGTH + 1))
    for s, flags in zip(strings, got):
        assert flags.tolist() == [seen[s[k:k + LENGTH]] > 1 for k in range(len(s) - LENGTH + 1)]
    shards = [suffix_dedup.Shard(strings[:12]), suffix_dedup.Shard(strings[12:])]
    z, interval = suffix_dedup.merge(shards)
    owner = np.concatenate([shards[0].string[shards[0].order], 12 + shards[1].string[shards[1].order]])
    at = np.concatenate([s.at[s.order] for s in shards])
    heads = [strings[owner[e]][at[e]:at[e] + LENGTH] for e in z]
    assert heads == sorted(heads) and sorted(z) == list(range(len(z)))
    assert [len(set(h)) for h in zip(*[iter(interval)])] and all((a == b) == (i == j) for a, b, i, j in
                                                                 zip(heads, heads[1:], interval, interval[1:]))
