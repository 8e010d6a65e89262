
from pyspark.sql import functions as F

from threadmill.operators import dedupe, nested, upsert, wordcount
from threadmill.schemas import PARTICIPANT, THREADS_RAW

P = "user_id int, username string, reply string, created_at string, love int, brick int"


def _threads(spark, rows):
    schema = f"thread_id int, participants array<struct<{P.replace(' ', ':', 0)}>>"
    return spark.createDataFrame(rows, "thread_id int, participants array<struct<user_id:int,username:string,reply:string,created_at:string,love:int,brick:int>>")


def test_thread_word_count_golden(spark):
    df = _threads(spark, [
        (1, [(7, "an", "good, good keyboard!", "Jun 12, 2022 3:04 PM", 0, 0), (8, "b", "Good.", "Jun 12, 2022 3:05 PM", 1, 0)]),
        (2, []),
        (3, None),
        (4, [(7, "an", "", "x", 0, 0), (8, "b", "...", "y", 0, 0), (9, "c", None, "z", 0, 0)]),
    ])
    got = {r["thread_id"]: r["word_count"] for r in wordcount.thread_word_count(df).collect()}
    assert got[1] == {"good": 2, "keyboard": 1, "Good": 1}
    assert got[2] == {}
    assert got[3] is None
    assert got[4] == {}


def test_word_count_total_equals_token_count(spark):
    import string

    texts = ["a b a", "Hello, world! hello", "", "x\ny\tz  x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string")
    m = {r["k"]: r["word_count"] for r in wordcount.text_word_count(df, "text").collect()}
    for i, t in enumerate(texts):
        toks = t.translate(str.maketrans("", "", string.punctuation)).split()
        assert sum(m[i].values()) == len(toks)
        assert m[i] == {w: toks.count(w) for w in set(toks)}


def test_lower_case_variant(spark):
    df = spark.createDataFrame([(1, "Good good GOOD, bad")], "k int, text string")
    m = wordcount.text_word_count(df, "text", lower_case=True).first()["word_count"]
    assert m == {"good": 3, "bad": 1}


def test_keep_last_in_array_golden(spark):
    # same (user, minute) at positions 0 and 3 -> position 3 survives; NULL keys compare equal
    df = _threads(spark, [
        (1, [
            (7, "a", "first", "Jun 12, 2022 3:04 PM", 0, 0),
            (8, "b", "other", "Jun 12, 2022 3:04 PM", 0, 0),
            (None, "n1", "null-1", None, 0, 0),
            (7, "a", "last", "Jun 12, 2022 3:04 PM", 0, 0),
            (None, "n2", "null-2", None, 0, 0),
        ]),
        (2, None),
    ])
    rows = nested.explode_participants(df, parse_created_at=False).collect()
    replies = [r["reply"] for r in rows]
    assert replies == ["other", "last", "null-2"]
    assert all(r["thread_id"] == 1 for r in rows)


def test_explode_participants_parses_stamp(spark):
    df = _threads(spark, [(1, [(7, "a", "hi", "Jun 12, 2022  3:04 PM", 2, 0)])])
    r = nested.explode_participants(df).first()
    assert str(r["created_at"]) == "2022-06-12 15:04:00" and r["love"] == 2


def test_flat_keep_last_first(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 5), (1, "a", 3), (2, "b", 2), (None, "n", 4), (None, "m", 6)],
        "k int, v string, o int")
    key = lambda t: (t[0] is None, t[0] or 0)
    last = [(r["k"], r["o"]) for r in dedupe.keep_last(df, "k", "o").collect()]
    first = [(r["k"], r["o"]) for r in dedupe.keep_first(df, "k", "o").collect()]
    assert sorted(last, key=key) == [(1, 5), (2, 2), (None, 6)]
    assert sorted(first, key=key) == [(1, 1), (2, 2), (None, 4)]


def _prod_stg(spark):
    arr = "array<int>"
    prod = spark.createDataFrame([(1, None, "p1"), (2, [1], "p2"), (3, None, "p3"), (5, [], "p5")],
                                 f"id int, participants {arr}, v string")
    stg = spark.createDataFrame([(1, [9], "s1"), (2, [8], "s2"), (4, None, "s4"), (5, [7], "s5")],
                                f"id int, participants {arr}, v string")
    return prod, stg


def test_upsert_protect_golden(spark):
    prod, stg = _prod_stg(spark)
    out = upsert.upsert_protect(prod, stg, "id", F.col("participants").isNotNull())
    got = {r["id"]: r["v"] for r in out.collect()}
    assert got == {1: "s1", 2: "p2", 3: "p3", 4: "s4", 5: "p5"}


def test_upsert_replace_idempotent_and_unique(spark):
    prod, stg = _prod_stg(spark)
    once = upsert.upsert_replace(prod, stg, "id")
    twice = upsert.upsert_replace(once, stg, "id")
    a = sorted(map(tuple, once.collect()), key=str)
    b = sorted(map(tuple, twice.collect()), key=str)
    assert a == b
    ids = [r["id"] for r in once.collect()]
    assert len(ids) == len(set(ids)) == 5
    assert {r["id"]: r["v"] for r in once.collect()} == {1: "s1", 2: "s2", 3: "p3", 4: "s4", 5: "s5"}


def test_upsert_without_broadcast_same_rows(spark):
    prod, stg = _prod_stg(spark)
    a = upsert.upsert_protect(prod, stg, "id", F.col("participants").isNotNull())
    b = upsert.upsert_protect(prod, stg, "id", F.col("participants").isNotNull())
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_check_staging_rejects(spark):
    stg = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "c"), (None, "d"), (3, None), (4, "x" * 120)], "id int, name string")
    c = upsert.check_staging(stg, "id", ["name"], {"name": 100})
    assert sorted(r["id"] for r in c.good.collect()) == [1]
    reasons = sorted((str(r["id"]), r["reject_reason"]) for r in c.rejects.collect())
    assert reasons == [("2", "duplicate key"), ("2", "duplicate key"), ("3", "null name"),
                       ("4", "width name"), ("None", "null id")]


def test_row_delta(spark):
    prod, stg = _prod_stg(spark)
    r = upsert.row_delta(prod, upsert.upsert_replace(prod, stg, "id")).first()
    assert (r["rows_before"], r["rows_after"], r["delta"]) == (4, 5, 1)


def test_decode_repr_cell(spark):
    cells = [
        "[{'user_id': 7, 'username': 'an', 'reply': 'it\\'s fine', 'created_at': 'x', 'love': 1, 'brick': 0}]",
        "[{'user_id': 8, 'username': None, 'reply': 'a\\xa0b', 'created_at': 'y', 'love': 0, 'brick': 0}]",
        None,
        "[]",
    ]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r["p"] for r in df.select(nested.decode_repr_cell("c").alias("p")).collect()]
    assert got[0][0]["reply"] == "it's fine" and got[0][0]["love"] == 1
    assert got[1][0]["user_id"] == 8 and got[1][0]["username"] is None and got[1][0]["reply"] == "a\xa0b"
    assert got[2] is None
    assert got[3] == []


def test_json_recordset(spark):
    df = spark.createDataFrame([('[{"user_id": 1, "extra": 5}, {"username": "b"}]',)], "j string")
    rows = nested.json_recordset(df, "j", PARTICIPANT).collect()
    assert rows[0]["user_id"] == 1 and rows[0]["username"] is None
    assert rows[1]["username"] == "b" and rows[1]["user_id"] is None


def test_schema_fields():
    assert [f.name for f in THREADS_RAW.fields][6] == "participants"


def test_ordered_counts_and_flatten(spark):
    df = spark.createDataFrame([(1, "b a b c a b")], "k int, text string")
    rows = wordcount.ordered_counts(wordcount.text_word_count(df, "text"), "k").collect()
    assert [(r["word"], r["n"]) for r in rows] == [("b", 3), ("a", 2), ("c", 1)]
    ll = spark.createDataFrame([([[1, 2], [3]],)], "x array<array<int>>")
    assert ll.select(nested.flatten_lists("x").alias("f")).first()["f"] == [1, 2, 3]


def test_explode_status_rows(spark):
    df = spark.createDataFrame([(1, ["Sticky", "Open"]), (2, []), (3, None)], "thread_id int, status array<string>")
    assert sorted(tuple(r) for r in nested.explode_status(df).collect()) == [(1, "Open"), (1, "Sticky")]
