"""Scalar column functions used by the ETL and the text operators.

All of these are JVM-side column expressions except ``with_nested``'s
fallback, an Arrow-batched Python UDF that only receives the rows the
JVM JSON parser could not read (every other row is passed as NULL).
"""

from __future__ import annotations

import ast

import pyarrow as pa

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# F1 -------------------------------------------------------------------------

def truncating_int(col) -> Column:
    """``int(float(x))``: parse as double, truncate toward zero; NULL if unparsable.

    With ANSI mode on, ``try_cast('81.0' as int)`` is NULL, so the parse
    always goes through double.
    """
    d = _c(col).try_cast("double")
    # cast(double as int) truncates toward zero; guard the int range.
    ok = d.isNotNull() & (F.abs(d) < F.lit(2147483648.0)) & ~F.isnan(d)
    return F.when(ok, d.cast("int"))


# F10 ------------------------------------------------------------------------

def empty_to_null(col) -> Column:
    """'' -> NULL (no trimming), as a CSV COPY reads an empty field."""
    return F.nullif(_c(col), F.lit(""))


# F2 -------------------------------------------------------------------------

GENRE_LIST = T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]))
CAST_LIST = T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("gender", T.LongType()), T.StructField("character", T.StringType())]))
CREW_LIST = T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("gender", T.LongType()), T.StructField("job", T.StringType())]))


def _literal_parser(schema: T.ArrayType):
    fields = [(f.name, f.dataType) for f in schema.elementType.fields]

    def conv(v, dt):
        if v is None:
            return None
        if isinstance(dt, T.LongType):
            if isinstance(v, bool) or not isinstance(v, (int, float)):
                raise ValueError("not a number")
            v = int(v)
            if not -(2 ** 63) <= v < 2 ** 63:
                raise ValueError("outside the long range")
            return v
        return v if isinstance(v, str) else str(v)

    def parse(text):
        if text is None:
            return None
        try:
            val = ast.literal_eval(text)
            if not isinstance(val, (list, tuple)):
                return None
            out = []
            for d in val:
                if not isinstance(d, dict):
                    return None
                out.append({n: conv(d.get(n), dt) for n, dt in fields})
            return out
        except (ValueError, SyntaxError, TypeError, OverflowError, MemoryError, RecursionError):
            return None

    return parse


JSON_OPTIONS = {"allowSingleQuotes": "true", "allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}


def _read_by_json(raw: Column, parsed: Column, schema: T.ArrayType) -> Column:
    """Whether the JSON reading of a literal is sure to equal ``ast.literal_eval``'s: one
    list without escapes, and every declared field read.  All else goes to the fallback.

    JSON refuses comments, unquoted keys, None, NaN and words outside values.  What it
    reads as text without quotes (numbers, true, false, nested values) is told by the
    text it gives; quoted texts that look like that take the fallback too, which reads
    them the same way.  No pattern is run over the cell."""
    cell = F.btrim(raw, F.lit(" \t\r\n"))

    def doubtful(e):
        some = e.isNull()
        for f in schema.elementType.fields:
            v = e[f.name]
            some = some | v.isNull()
            if isinstance(f.dataType, T.StringType):
                some = some | F.left(v, F.lit(1)).isin(*"-.0123456789{[") | v.isin("true", "false")
        return some

    return (parsed.isNotNull() & cell.startswith("[") & (F.instr(cell, "]") == F.length(cell)) & ~raw.contains("\\")
            & ~F.exists(parsed, doubtful))


def _no_list(raw: Column) -> Column:
    """Whether a literal is sure to be no list, so that no parser need see it: the word None;
    a dict or set up to the end (its only closing brace); text, but no comment, after
    the only closing bracket of a list (a tuple that begins with a list holds no dicts
    only).  A bracket within a quoted text leaves the list open, which is no literal either."""
    cell = F.btrim(raw, F.lit(" \t\r\n\f"))
    end = F.instr(cell, "]")
    rest = F.substr(cell, end + 1)
    return ((cell == "None")
            | (cell.startswith("{") & (F.instr(cell, "}") == F.length(cell)))
            | (cell.startswith("[") & (end > 0) & (end < F.length(cell)) & ~rest.contains("]")
               & ~rest.contains("#") & ~raw.contains("\\")))


def with_nested(df, col: str, schema: T.ArrayType = GENRE_LIST, out: str | None = None):
    """``df`` with ``out`` (default: ``col`` replaced) = the parsed literal.

    A cell is a Python list-of-dict literal (``ast.literal_eval`` semantics):
    declared number fields must be numbers (truncated) or None, declared text
    fields are taken as text, missing fields are NULL; anything else gives a NULL
    list.  ``from_json`` (accepts single quotes) reads the cells on which both
    agree for sure, ``_no_list`` tells those that hold no list for sure, an Arrow-batched
    ``literal_eval`` reads the rest.

    The JSON parse is a column of its own, so it runs once per row, and the
    fallback is marked non-deterministic so the optimizer never copies the
    parse into another operator (e.g. the ``size(list) > 0`` filter it infers
    for an ``explode`` and pushes below the projection).
    """
    out = out or col
    raw = F.col(col)
    tmp = f"_json_{out}"
    df = df.withColumn(tmp, F.from_json(raw, schema, JSON_OPTIONS))
    ok = f"_ok_{out}"                       # a column of its own: read twice, computed once
    df = df.withColumn(ok, F.coalesce(_read_by_json(raw, F.col(tmp), schema), F.lit(False)))
    parse = _literal_parser(schema)

    fields = [(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string())
              for f in schema.elementType.fields]
    arrow = pa.list_(pa.struct(fields))

    @F.arrow_udf(schema)
    def slow_parse(texts: pa.Array) -> pa.Array:
        # Rows that need no parser arrive as NULL and are skipped.
        return pa.array([parse(t) for t in texts.to_pylist()], arrow)

    slow_parse = slow_parse.asNondeterministic()
    return (df.withColumn(out, F.when(F.col(ok), F.col(tmp)).otherwise(
                slow_parse(F.when(~F.col(ok) & ~_no_list(raw), raw))))
              .drop(tmp, ok))


# F6 -------------------------------------------------------------------------

# Token: two or more word characters (letters, digits, underscore, any script).
TOKEN_PATTERN = r"([\p{L}\p{N}_]{2,})"

# The English stop-word list used for TF-IDF (the scikit-learn
# "english" list the reference relies on), in its natural (alphabetical) order.
ENGLISH_STOP_WORDS = (
    "a about above across after afterwards again against all almost alone along already also "
    "although always am among amongst amoungst amount an and another any anyhow anyone anything "
    "anyway anywhere are around as at back be became because become becomes becoming been before "
    "beforehand behind being below beside besides between beyond bill both bottom but by call can "
    "cannot cant co con could couldnt cry de describe detail do done down due during each eg eight "
    "either eleven else elsewhere empty enough etc even ever every everyone everything everywhere "
    "except few fifteen fifty fill find fire first five for former formerly forty found four from "
    "front full further get give go had has hasnt have he hence her here hereafter hereby herein "
    "hereupon hers herself him himself his how however hundred i ie if in inc indeed interest into "
    "is it its itself keep last latter latterly least less ltd made many may me meanwhile might "
    "mill mine more moreover most mostly move much must my myself name namely neither never "
    "nevertheless next nine no nobody none noone nor not nothing now nowhere of off often on once "
    "one only onto or other others otherwise our ours ourselves out over own part per perhaps "
    "please put rather re same see seem seemed seeming seems serious several she should show side "
    "since sincere six sixty so some somehow someone something sometime sometimes somewhere still "
    "such system take ten than that the their them themselves then thence there thereafter thereby "
    "therefore therein thereupon these they thick thin third this those though three through "
    "throughout thru thus to together too top toward towards twelve twenty two un under until up "
    "upon us very via was we well were what whatever when whence whenever where whereafter whereas "
    "whereby wherein whereupon wherever whether which while whither who whoever whole whom whose "
    "why will with within without would yet you your yours yourself yourselves"
).split()


def raw_tokens(col) -> Column:
    """Lower-case and extract 2+ word-character tokens (repeats kept)."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TOKEN_PATTERN), 1)


def drop_stop_words(df, term_col: str = "term", stop_words=ENGLISH_STOP_WORDS):
    """Remove stop-word rows from an exploded token frame.

    A broadcast anti-join against the fixed list (318 rows, a proven size
    bound): one hash probe per token instead of a scan of the list.
    """
    stop = df.sparkSession.createDataFrame([(w,) for w in stop_words], f"{term_col} string")
    return df.join(F.broadcast(stop), term_col, "left_anti")
