import duckdb

from affinity.llm import quotes as Q

ROWS = [(1, 0, "user", "Hello there\nHow are you?"),
        (1, 1, "assistant", "On Monday X wrote:\n> Hello there\n> How are you?\nFine, thanks"),
        (1, 2, "user", "Other topic starts"), (1, 3, "user", ">> how are you\n> fine thanks\nGood!"),
        (1, 4, "assistant", "> Other TOPIC, starts\n> > nothing\nok"), (1, 4, "assistant", "> Other TOPIC, starts\n> > nothing\nok"),
        (1, 5, "user", "&gt; Good!\nyes"), (2, 0, None, None), (2, None, "user", "> Hello there"), (None, 3, "user", "x\r\ny"),
        (None, 1, "user", ""), (3, 0, "u", "a\n\nb"), (3, 1, "u", "> b\n> a\n c "), (4, 1, "user", "> quote of the later\nmine"),
        (4, 2, "user", "quote of the later"), (4, 2, "assistant", "same turn")]
SCHEMA = "conv_id long, turn long, role string, text string, msg string"
COLUMNS = ["conv_id", "position", "turn", "role", "content", "reply_to", "thread_turn", "n_quotes", "formatted"]


def spark_rows(df):
    return sorted((tuple(r) for r in Q.reply_order(df).select(*COLUMNS).collect()), key=repr)


def sql_rows(df):
    c = duckdb.connect()
    c.register("conversations", df.toArrow())
    return sorted(c.execute(f"SELECT {', '.join(COLUMNS)} FROM ({Q.SQL})").fetchall(), key=repr)


def test_links_and_order(spark):
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], SCHEMA)
    got = spark_rows(df)
    assert got == sql_rows(df)
    one = {r[2]: r for r in got if r[0] == 1}
    assert [one[t][5] for t in range(6)] == [None, 0, None, 1, 2, 3]
    assert [one[t][1] for t in (0, 1, 3, 5, 2, 4)] == list(range(6))
    assert one[1][4] == "Fine, thanks" and one[1][8] == "<|assistant|>\nFine, thanks<|end|>"


def test_long_chains_and_hot_conversation(spark):
    rows = [(9, t, "u", (f"> line {t - 1} of talk\n" if t else "") + f"line {t} of talk", "") for t in range(200)]
    rows += [(9, 1000 + t, "u", f"> line 0 of talk\nreply {t}", "") for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = spark_rows(df)
    assert got == sql_rows(df) and {r[6] for r in got} == {0} and sorted(r[1] for r in got) == list(range(500))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], SCHEMA)
    for d in (Q.parsed(df), Q.link_replies(Q.parsed(df)), Q.reply_order(df)):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_empty_table_and_long_message(spark):
    df = spark.createDataFrame([(1, 0, "u", "word\n" * 20_000 + "> q", "")], SCHEMA)
    assert len(spark_rows(df)) == 1 and spark_rows(df.limit(0)) == []
