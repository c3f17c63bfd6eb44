"""Inline fixtures for the scalar functions."""

from pyspark.sql import functions as F

from affinity.functions import scalars


def test_truncating_int(spark):
    df = spark.createDataFrame([("81.0",), ("3.5",), ("0.5",), ("",), ("abc",), (None,), ("-2.7",)], "x string")
    got = [r.v for r in df.select(scalars.truncating_int("x").alias("v")).collect()]
    assert got == [81, 3, 0, None, None, None, -2]


def test_empty_to_null_does_not_trim(spark):
    df = spark.createDataFrame([("",), (" ",), ("a",)], "x string")
    assert [r.v for r in df.select(scalars.empty_to_null("x").alias("v")).collect()] == [None, " ", "a"]


LITERALS = [
    ("[{'id': 16, 'name': 'Animation'}]", [(16, "Animation")]),
    ("""[{'id': 1, 'name': "O'Brien", 'job': 'Director'}]""", [(1, "O'Brien")]),
    ("[{'id': 2, 'name': None}]", [(2, None)]),
    ("[]", []),
    ("[{'id': 3, 'name': 'Jos\\xe9'}]", [(3, "José")]),
    ("[{'id': 4, 'name': 'None: None'}]", [(4, "None: None")]),
    ("garbage", None),
    (None, None),
    ("{'id': 1, 'name': 'x'}", None),                       # a dict is no list
    ("[{'id': 1, 'name': null}]", None),                    # null is no Python word
    ("[{'id': 1, 'name': 'x'}] junk", None),
    ("[{'id': 1, 'name': 'x'}], [{'id': 2, 'name': 'y'}]", None),
    ("[{'id': 'abc', 'name': 'x'}]", None),                 # a number field must be a number
    ("[{'id': 1.5, 'name': 'x'}]", [(1, "x")]),             # and is truncated
    ("[{'id': 5, 'name': 1.50}]", [(5, "1.5")]),            # a text field is taken as text
    ("[{'id': True, 'name': 'x'}]", None),
    ("[{'name': 'only'}]", [(None, "only")]),
    ("[{'id': 99999999999999999999, 'name': 'x'}]", None),
    ("[{'id': 7, 'name': 'a]b, c'}]", [(7, "a]b, c")]),
    ("[{'id': 8, 'name': 'x'}, None]", None),
    ("  [ {'id': 9 , 'name' : 'sp'} ] ", [(9, "sp")]),
    ("[{'id': 10, 'name': true}]", None),
    ("[{'id': 10, 'name': 'true'}]", [(10, "true")]),
    ("[{'id': 11, 'name': '50 Cent'}, {'id': 12, 'name': '-x'}]", [(11, "50 Cent"), (12, "-x")]),
    ("[{'id': 13, 'name': {'a': 1}}]", [(13, "{'a': 1}")]),
    ("[{'id': 14, 'name': NaN}]", None),
    ("[{'id': 15, 'name': 'a' 'b'}]", [(15, "ab")]),
    ("[{'id': 16, 'name': 'x // y', 'id': 17}]", [(17, "x // y")]),
    ("[{'id': 18, 'name': 'x'} // note\n]", None),
    ("[{'id': 19, 'name': 'x'},]", [(19, "x")]),
    ("[{'id': 0x14, 'name': 'x'}]", [(20, "x")]),
    ("[{'id': 1e2, 'name': 'x: y'}]", [(100, "x: y")]),
]


def test_nested_literals_follow_literal_eval(spark):
    # The same table for the JSON path and for the fallback alone.
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LITERALS)], "k long, t string")
    got = scalars.with_nested(df, "t", scalars.GENRE_LIST, out="p").orderBy("k").collect()
    slow = scalars._literal_parser(scalars.GENRE_LIST)
    for r, (text, want) in zip(got, LITERALS, strict=True):
        fast = None if r.p is None else [(e["id"], e["name"]) for e in r.p]
        alone = slow(text)
        assert fast == want, text
        assert (None if alone is None else [(e["id"], e["name"]) for e in alone]) == want, text


def test_tokens_unicode_and_stop_words(spark):
    df = spark.createDataFrame([(1, "The étion of a Ring ring, x y_z 42")], "mov_id long, t string")
    a = df.select("mov_id", F.explode(scalars.raw_tokens("t")).alias("term"))
    assert sorted(r.term for r in scalars.drop_stop_words(a).collect()) == sorted(["étion", "ring", "ring", "y_z", "42"])


def test_stop_word_list_is_fixed():
    assert len(scalars.ENGLISH_STOP_WORDS) == 318
    assert scalars.ENGLISH_STOP_WORDS == sorted(scalars.ENGLISH_STOP_WORDS)


def test_drop_stop_words(spark):
    df = spark.createDataFrame([(1, "the cat and the hat sat on the mat")], "mov_id long, t string")
    a = df.select("mov_id", F.explode(scalars.raw_tokens("t")).alias("term"))
    assert sorted(r.term for r in scalars.drop_stop_words(a).collect()) == ["cat", "hat", "mat", "sat"]


def test_cells_that_hold_no_list_skip_the_parser(spark):
    no_list = ["None", " None\n", "{'id': 1}", "{'id': ']'}", "{'a': 1", "{'a': 1 # }", "[{'id': 1}] junk", "[{'id': 1}], 2",
               "[], {'id': 1}", "['a]', 'b'", "[1] + 2"]
    ask = ["[{'id': 1}]", "[{'id': 1}] # note", "{'id': 1}, {'id': 2}", "[{'id': 1, 'name': 'a]b'}]", "({'id': 1},)", "", "x",
           "[{'id': 1}]\f", "[{'id': 1, 'name': 'a}b'}]", "[{'id': 1}]\\\n", "{'a': '}'}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(no_list + ask)], "i int, t string")
    df = df.withColumn("no", scalars._no_list(F.col("t")))
    rows = scalars.with_nested(df, "t", scalars.GENRE_LIST, out="p").orderBy("i").collect()
    parse = scalars._literal_parser(scalars.GENRE_LIST)
    assert [r["no"] for r in rows[:len(no_list)]] == [t != "{'a': 1" for t in no_list]
    for r in rows:
        want = parse(r["t"])
        assert (r["p"] is None) == (want is None) and not (r["no"] and want is not None)
        assert want is None or [x.asDict() for x in r["p"]] == want
