import hashlib
import random
import zlib
from collections import defaultdict

from affinity.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, text_hash string"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text, _ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):
        leaves, saved = int(not kids[node]), (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for k in kids[node]:
            a, b = below(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), *below(node),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(spark, rows):
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_random_branches(spark):
    rng = random.Random(5)
    rows = []
    for c in range(120):
        for turn in range(rng.randrange(0, 12)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn > 2 else "user",
                         rng.choice(["a", "bé", ""]) if turn > 1 else "hello", "x"))
    rows += [(1000 + k, t, "user", f"same {t}", None) for k in range(0, 300, 5) for t in range(9)]     # copies
    rng.shuffle(rows)
    assert rows_of(spark, rows) == brute(rows)


def test_nulls_ties_repeats_long_and_turnless(spark):
    rows = [(5, None, None, None, ""), (5, None, "user", None, ""), (5, 1, "user", "x", ""), (5, 1, "user", "x", ""),
            (5, 1, "assistant", "y", ""), (None, 1, "user", "lost", ""), (7, 3, "user", "z" * 100_000, ""), (9, 0, "user", "q", "")]
    rows += [(20, t, "user", "t", "") for t in range(700)] + [(25, t, "user", "t", "") for t in range(650)]
    # 4 has one turn and takes none of conversation 0, which does not exist.
    rows += [(4, 0, "user", "only", ""), (-3, 0, "user", "below zero", "")]
    assert rows_of(spark, rows) == brute(rows)
    only = [(c, 0, "user", "x", "") for c in range(1, 5) if zlib.crc32(str(c).encode()) % 9 > 0]
    got = rows_of(spark, only)
    assert got == brute(only) and len(got) == 1 and got[0][1] == 0


def test_empty_table(spark):
    assert rows_of(spark, []) == []


def test_fattest_number(spark):
    pairs = [(a, b) for a in range(0, 70) for b in range(a + 1, 70)]
    got = spark.createDataFrame(pairs, "a int, b int").selectExpr("a", "b", f"{prefix_trie._fattest('a', 'b')} as f").collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)
