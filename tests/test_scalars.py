"""Golden rows for the scalar functions (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from threadmill.functions import scalars as S
from threadmill.functions.text import tokens


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_abbrev_count(spark):
    cases = {"12K": 12000, "3M": 3000000, "45": 45, "0": 0, "1.5K": 1500, "2.25M": 2250000, "": None, "abc": None,
             None: None, " 7 ": 7, "-5": -5, "+3K": 3000, "1,204": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["r"] for r in df.select("v", S.abbrev_count("v").alias("r")).collect()}
    assert got == cases


def test_parse_forum_ts(spark):
    cases = {
        "Jun 12, 2022 at 3:04 PM": dt.datetime(2022, 6, 12, 15, 4),
        "Jun 12, 2022  3:04 PM": dt.datetime(2022, 6, 12, 15, 4),
        "Jun 02, 2022 03:04 AM": dt.datetime(2022, 6, 2, 3, 4),
        "Jun 12, 2022 3:04:05 PM": dt.datetime(2022, 6, 12, 15, 4, 5),
        "bad": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["r"] for r in df.select("v", S.parse_forum_ts("v").alias("r")).collect()}
    assert got == cases


def test_parse_forum_date(spark):
    assert one(spark, S.parse_forum_date, "Jun 2, 2022") == dt.date(2022, 6, 2)
    assert one(spark, S.parse_forum_date, "nope") is None


def test_format_stamp(spark):
    v = dt.datetime(2022, 6, 12, 15, 4)
    assert one(spark, S.format_stamp, v, "v timestamp_ntz") == "Jun 12, 2022 03:04 PM"


def test_truncate_trim(spark):
    assert one(spark, lambda c: S.truncate_trim(c, 4), "  ab   ") == "  ab"
    assert one(spark, lambda c: S.truncate_trim(c, 3), "abcdef") == "abc"


def test_replace_invalid_utf8(spark):
    assert one(spark, S.replace_invalid_utf8, bytearray(b"a\xffb"), "v binary") == "a b"


def test_id_from_link(spark):
    assert one(spark, S.id_from_link, "/t/some-title.12345/") == 12345
    assert one(spark, S.id_from_link, "/t/a.b.77/") == 77
    assert one(spark, S.id_from_link, "/t/nope/") is None


def test_number_helpers(spark):
    assert one(spark, S.int_with_separators, "1,204\n") == 1204
    assert one(spark, S.int_with_separators, "\t7") == 7
    assert one(spark, S.digits_or_zero, "Love 1,204") == 1204
    assert one(spark, S.digits_or_zero, "") == 0
    assert one(spark, S.digits_or_zero, "12") == 12
    assert one(spark, S.remove_tabs_newlines, "a\tb\nc") == "abc"


def test_text_after_marker(spark):
    assert one(spark, S.text_after_marker, "Dev From  Ha Noi") == "Ha Noi"
    assert one(spark, S.text_after_marker, "x From A From B") == "B"
    assert one(spark, S.text_after_marker, "Dev") == "Namek"


def test_status_array(spark):
    df = spark.createDataFrame([(None,), ([],), (["Sticky"],), (["Locked"],)], "v array<string>")
    got = [r["r"] for r in df.select(S.status_array("v").alias("r")).collect()]
    assert got == [["Open"], ["Open"], ["Sticky", "Open"], ["Locked"]]


def test_fill_default_and_escape(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("NA",), ("Ha Noi",), ("\\./",), ("a\\./",)], "v string")
    got = [r["r"] for r in df.select(S.fill_default("v").alias("r")).collect()]
    assert got == ["Namek", "Namek", "Namek", "NA", "Ha Noi", "\\./", "a\\./"]
    got = [r["r"] for r in df.select(S.replace_escape_cell("v").alias("r")).collect()]
    assert got == [None, "", "  ", "NA", "Ha Noi", "", "a\\./"]
    got = [r["r"] for r in df.select(S.replace_escape_cell("v", remove_backslashes=True).alias("r")).collect()]
    assert got == [None, "", "  ", "NA", "Ha Noi", "", "a./"]


def test_role_suffix_and_strip(spark):
    df = spark.createDataFrame([("Member", " Staff ", True), ("Member", "x", False)], "t string, b string, m boolean")
    got = [r["r"] for r in df.select(S.role_suffix("t", "b", "m").alias("r")).collect()]
    assert got == ["Member | Staff", "Member"]
    assert one(spark, S.strip, "\u3000 ab\x1c\n") == "ab"


def test_coalesce_run_time(spark):
    run = dt.datetime(2024, 1, 2, 3, 4)
    df = spark.createDataFrame([(None,), (dt.datetime(2020, 1, 1),)], "v timestamp_ntz")
    got = [r["r"] for r in df.select(S.coalesce_run_time("v", run).alias("r")).collect()]
    assert got == [run, dt.datetime(2020, 1, 1)]


def test_tokens_match_python_split(spark):
    import string

    texts = ["good, good keyboard!", "Good.", "", "...", "  lead\ttab\u00a0nbsp\x1csep\u2003em  ", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r["r"] for r in df.select(tokens("v").alias("r")).collect()]
    want = [None if t is None else t.translate(str.maketrans("", "", string.punctuation)).split() for t in texts]
    assert got == want


def test_parsing_ignores_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        # 02:30 on this day does not exist in that zone (daylight-saving gap)
        assert one(spark, S.parse_forum_ts, "Mar 10, 2024 2:30 AM") == dt.datetime(2024, 3, 10, 2, 30)
        assert one(spark, S.parse_forum_date, "Mar 10, 2024") == dt.date(2024, 3, 10)
        run = dt.datetime(2024, 3, 10, 2, 30)
        got = spark.range(1).select(S.coalesce_run_time(F.lit(None).cast("timestamp_ntz"), run).alias("r")).first()["r"]
        assert got == run
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_split_matches_python_for_every_space_character(spark):
    # every code point Python's str.split() breaks on, up to U+3000, plus
    # look-alikes it does not break on (zero-width space, Mongolian separator)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    others = ["\u200b", "\u180e", "\u2060", "\ufeff"]
    texts = [f"a{s}b" for s in spaces + others] + ["".join(spaces) + "x" + "".join(spaces)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = {r["i"]: r["r"] for r in df.select("i", tokens("v").alias("r")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == t.split(), (i, [hex(ord(ch)) for ch in t])
