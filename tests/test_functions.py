"""Whitespace fast paths equal the regex definitions they short-cut."""

import random

from pyspark.sql import functions as F

from tidewell.functions import WHITESPACE_CHARS, edge_ws, is_blank, strip
from tidewell.operators.dq import edge_ws_sql

RX_WS = r"\p{IsWhite_Space}"


def test_whitespace_list_is_the_regex_class(spark):
    chars = [chr(cp) for cp in range(0x10000) if not 0xD800 <= cp <= 0xDFFF]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    got = {r.c for r in df.where(F.col("c").rlike(RX_WS)).collect()}
    assert got == set(WHITESPACE_CHARS)


def test_fast_paths_equal_regex_forms(spark):
    rnd = random.Random(7)
    alphabet = ["a", "B", "1", "_", "é"] + WHITESPACE_CHARS
    vals = ["", None, " ", "　", "a", " a", "a ", "\ta\n", " x "]
    vals += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "s string").withColumn(
        "_ws_set", F.array(*[F.lit(ch) for ch in WHITESPACE_CHARS]))
    rows = df.select(
        "s",
        is_blank("s").alias("blank"),
        (F.col("s").isNull() | ~F.col("s").rlike(r"\P{IsWhite_Space}")).alias("blank_rx"),
        strip("s").alias("stripped"),
        F.regexp_replace("s", r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$", "").alias("stripped_rx"),
        edge_ws("s").alias("edge"),
        F.expr(edge_ws_sql("s")).alias("edge_sql"),
    ).collect()
    for r in rows:
        assert r.blank == r.blank_rx, r
        assert r.stripped == r.stripped_rx, r
        if r.s is not None:
            py_edge = r.s != r.s.strip("".join(WHITESPACE_CHARS))
            assert r.edge == py_edge == r.edge_sql, r


def test_simple_id_pattern_equals_regex(spark):
    from tidewell.operators.dq import _pattern_sql

    rnd = random.Random(11)
    alphabet = ["B", "P", "b", "0", "7", "9", "٣", " ", "\n", "x"]
    vals = ["B1234567", "B123456", "B12345678", "b1234567", "B123456\n", "B12345٣7", ""]
    vals += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9))) for _ in range(2000)]
    vals += ["B" + "".join(rnd.choice("0123456789x") for _ in range(7)) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "s string").withColumn(
        "_rx", F.lit(r"\A(?:B\d{7})\z"))
    rows = df.select("s", F.expr(_pattern_sql("s", r"B\d{7}", "_rx")).alias("fast"),
                     F.expr("s RLIKE _rx").alias("rx")).collect()
    assert all(r.fast == r.rx for r in rows)
    assert sum(r.rx for r in rows) > 10


def test_zones_and_number_suffixes(spark):
    from tidewell.functions import to_date, to_number, to_ts
    from tidewell.operators.dq import _num_sql, _ts_sql

    texts = {"2024-03-01 10:00:00+02:00": "2024-03-01 08:00:00", "2024-03-01T10:00:00Z": "2024-03-01 10:00:00",
             "2024-03-01T01:00:00+02:00": "2024-02-29 23:00:00", "2024-03-01 10:00:00": "2024-03-01 10:00:00",
             "2024-03-01": "2024-03-01 00:00:00", "bad": None, "2024-03-01 10:00:00 nowhere": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for r in df.select("s", to_ts("s").alias("a"), F.expr(_ts_sql("s")).alias("b"), to_date("s").alias("d")).collect():
        want = texts[r.s]
        assert (str(r.a) if r.a else None) == (str(r.b) if r.b else None) == want, r
        assert (str(r.d) if r.d else None) == (want and want[:10]), r
    numbers = {"10": 10.0, "10d": None, "10F": None, "1e3": 1000.0, "inf": None, "NaN": None, "x": None, None: None}
    df = spark.createDataFrame([(t,) for t in numbers], "s string")
    for r in df.select("s", to_number("s").alias("a"), F.expr(_num_sql("s")).alias("b")).collect():
        assert r.a == r.b == numbers[r.s], r
