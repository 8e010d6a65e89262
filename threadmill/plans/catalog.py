"""Registered queries: each operator of the inventory run over the given tables.

Every query reads whole tables (forum tables do not exist in the test data, so
stand-ins with the same shape are used: conversations/documents for replies,
events for extraction and dedupe, customer/documents for upserts, orders for
listings, pages for HTML). `ORACLE_SQL` holds the DuckDB statement computing
the same result; column names match exactly.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.functions import scalars as S
from threadmill.functions.text import PUNCTUATION, explode_rows
from threadmill.operators import dedupe, joins, listing, maintained, nested, sketches, upsert, variants, wordcount
from threadmill.plans import html as H
from threadmill.session import checkpoint_dir
from threadmill.sources import extract, files, ledger, rejects

WATERMARK_TS = "2024-01-20 00:00:00"
#: The batches of `newest_merge`; the last one takes every other type.
EVENT_TYPES = ["click", "error", "purchase", "signup", None]
NEW_KEY_OFFSET = 1_000_000_000


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def _wide(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A table feeding CPU-heavy per-row work, pruned. Its parallelism is the
    scan's: file layout and `spark.sql.files.*` decide it."""
    df = _t(spark, sf_dir, name)
    return df.select(*cols) if cols else df


def _dealt(spark: SparkSession, sf_dir: str, name: str, key: str, *cols: str) -> DataFrame:
    """The narrow rows of a table that CPU-heavy per-row work is built from, dealt by
    their unique key over the session's shuffle partitions: a file of one row group is
    read by one task, however many rows it has, and all that work would stay there."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _t(spark, sf_dir, name).select(key, *cols).repartition(tasks, key)


# ------------------------------------------------------------------ word counts


def q_word_count(spark, sf):
    conv = _wide(spark, sf, "conversations", "conv_id", "text")
    return wordcount.word_counts(conv, "conv_id", "text")


def q_word_count_map(spark, sf):
    conv = _wide(spark, sf, "conversations", "conv_id", "text")
    m = wordcount.word_count_map(conv, "conv_id", "text")
    return m.select(
        "conv_id",
        F.size("word_count").cast("bigint").alias("n_words"),
        F.aggregate(F.map_values("word_count"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_tokens"),
    )


def q_doc_word_count(spark, sf, tasks=None):
    docs = _wide(spark, sf, "documents", "doc_id", "text")
    return wordcount.text_word_rows(docs, "doc_id", "text", tasks=tasks)


def q_thread_word_count(spark, sf):
    # G-A1 in its nested form: each document is a thread whose lines are the
    # replies (an array of reply structs built per row, no grouping)
    docs = _wide(spark, sf, "documents", "doc_id", "text").where(F.col("text").isNotNull())
    replies = F.transform(F.split("text", "\n"), lambda l: F.struct(l.alias("reply")))
    threads = docs.select("doc_id", replies.alias("participants"))
    counted = wordcount.thread_word_count(threads)
    return explode_rows(counted, ["doc_id"], F.col("word_count"), ["word", "n"])


def q_top_words(spark, sf):
    conv = _wide(spark, sf, "conversations", "conv_id", "text")
    busiest = (
        conv.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
        .orderBy(F.desc("turns"), F.asc("conv_id")).limit(20).select("conv_id")
    )
    picked = conv.join(F.broadcast(busiest), "conv_id", "left_semi")  # 20 ids: bounded
    return wordcount.top_words(picked, "conv_id", "text", 50)


def q_title_keywords(spark, sf):
    li = _t(spark, sf, "lineitem")
    part = _t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return wordcount.keyword_stats(li, part, "l_partkey", "p_name", {"qty": "l_quantity", "price": "l_extendedprice"})


def q_title_medians(spark, sf):
    """Q1 with medians: line items of two runs (returned or not), their sketches merged;
    `close` says whether the median misses by at most 1 % of the exact ranks."""
    li = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice", "l_returnflag")
    part = _t(spark, sf, "part").select("p_partkey", "p_name")
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    args = part, "p_partkey", "p_name", "l_extendedprice"
    runs = [_written(sketches.keyword_sketches(li.where(some), *args), "sketches") for some in (returned, ~returned)]
    both = _written(sketches.merged(runs[0].unionByName(runs[1]), "word"), "sketches")
    errors = sketches.rank_errors(li, *args, both, 0.5)
    return both.select("word", sketches.n_values().alias("n_values")).join(errors, "word").select(
        "word", "n_values", "n_rows", (F.col("error") <= 0.01).alias("close"))


def q_maintained_counts(spark, sf):
    """G-A1 kept up: all turns are counted, then the assistants' turns come again
    with another text (J3) and the users' first turns are deleted."""
    turns = _t(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    keys = ["conv_id", "turn"]
    counts = _written(wordcount.word_counts(turns, "conv_id", "text"), "counts")
    edited = turns.where(F.col("role") == "assistant").withColumn("text", F.concat("text", F.lit(" edited twice")))
    stored = upsert.upsert_replace(turns, edited, keys)
    opening = stored.where((F.col("role") == "user") & (F.col("turn") == 0))
    changes = [maintained.replaced(turns, edited, keys), maintained.removed(stored, opening, keys)]
    for change in changes:
        counts = _written(maintained.merge_counts(counts, maintained.count_changes(change, "conv_id", "text"), "conv_id"), "counts")
    return counts


# ------------------------------------------------------------------ extraction


def q_incremental_extract(spark, sf):
    return extract.incremental(_t(spark, sf, "events"), "ts", F.lit(WATERMARK_TS).cast("timestamp_ntz"))


def q_full_extract(spark, sf):
    return extract.incremental(_t(spark, sf, "events"), "ts", None)


def q_watermark_advance(spark, sf):
    batch = q_incremental_extract(spark, sf)
    return extract.next_watermark(batch, "ts", "events")


def q_tie_extract(spark, sf):
    """A1 after a run that has read all rows up to a day's stamp but the errors
    of that day: they were written late, with the watermark's own stamp."""
    events = _t(spark, sf, "events").withColumn("stamp", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    wm = F.lit(WATERMARK_TS).cast("timestamp_ntz")
    late = (F.col("stamp") == wm) & (F.col("event_type") == "error")
    state = extract.advance(None, events.where((F.col("stamp") <= wm) & ~late), "stamp", "events", "event_id")
    return extract.since(events, "stamp", state, "events", "event_id")


def q_newest_merge(spark, sf):
    """T2's rule: the events of each type are a batch of user versions, merged in
    alphabetical order of their types, so most versions arrive out of order."""
    events = _t(spark, sf, "events")
    version = ["ts", "event_id"]
    table = None
    for kind in EVENT_TYPES:
        rows = events.where(F.col("event_type") == kind if kind else ~F.coalesce(F.col("event_type").isin(EVENT_TYPES[:-1]), F.lit(False)))
        batch = dedupe.keep_last(rows, "user_id", version)
        table = _written(batch if table is None else upsert.upsert_newest(table, batch, "user_id", version), "newest")
    return table


def _written(df, name):
    """A written table in the shared folder, as each merge leaves one: the next plan starts from it."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_file_ledger(spark, sf):
    """The pages as landing files; those of plain http were consumed by an
    earlier run, and each page lies in the folder of its host under a second name too."""
    pages = _t(spark, sf, "pages").where(F.col("html").isNotNull())
    files = pages.select(
        F.concat(F.lit("/landing/"), F.lpad(F.col("page_id").cast("string"), 12, "0")).alias("path"), F.octet_length("html").cast("bigint").alias("length"),
        F.lit("2024-01-01").cast("timestamp").alias("modified"), F.sha2("html", 256).alias("digest"), F.col("url").startswith("https://").alias("fresh"))
    consumed = files.where(~F.col("fresh"))
    again = files.withColumn("path", F.concat("path", F.lit("-again")))
    fresh = ledger.unseen(files.unionByName(again), consumed)
    return ledger.classified(fresh, consumed).select("path", "length", "digest", "status")


def q_checked_load(spark, sf):
    """A4 with D18: the events as a TSV file whose errors have words for numbers;
    good rows are loaded, the others kept with their reason."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/checked-load-{uuid.uuid4().hex}"
    events = _t(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit("nobody")).otherwise(F.col("user_id").cast("string")).alias("user_id"), "event_type")
    files.write_tsv(events, f"{folder}/in")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())])
    loaded = rejects.load_checked(spark, f"{folder}/in", schema, "tsv", f"{folder}/rejects", "run", budget=1.0)
    bad = rejects.read_rejects(spark, f"{folder}/rejects", "run")
    record = F.split("record", "\t")
    return loaded.good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.select(
        record[0].cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("user_id"), record[2].alias("event_type"), "reason"))


# ------------------------------------------------------------------ nested


def _doc_lines(spark, sf):
    docs = _wide(spark, sf, "documents", "doc_id", "text").where(F.col("text").isNotNull())
    lines = F.transform(F.split("text", "\n"), lambda l, i: F.struct(l.alias("line"), i.alias("pos")))
    return docs.select("doc_id", lines.alias("lines"))


def q_explode_nested(spark, sf):
    d = _doc_lines(spark, sf)
    return explode_rows(d, ["doc_id"], F.col("lines"), "l").select("doc_id", "l.pos", "l.line")


def q_keep_last_nested(spark, sf):
    d = _doc_lines(spark, sf)
    kept = nested.keep_last_in_array("lines", ["line"])
    return explode_rows(d, ["doc_id"], kept, "l").select("doc_id", "l.pos", "l.line")


def q_json_records(spark, sf):
    from pyspark.sql import types as T

    # the id travels inside the record: an array of one object per event
    record = F.concat(F.lit('[{"event_id":'), F.col("event_id").cast("string"), F.lit(","), F.substring("props", 2, 1 << 30), F.lit("]"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.IntegerType())])
    return nested.json_recordset(_t(spark, sf, "events").select(record.alias("j")), "j", schema)


def q_variant_cells(spark, sf):
    """A9/A10 for cells of unknown shape: errors hold a word for the number, purchases a
    broken cell, signups a key that nobody asks for; read as variants and written back."""
    events = _t(spark, sf, "events").select("event_id", "event_type", "props")
    kind = F.col("event_type")
    cell = (
        F.when(kind == "error", '{"k": "none"}').when(kind == "purchase", F.concat("props", F.lit("}")))
        .when(kind == "signup", F.concat(F.lit('{"extra":{"from":["web",1]},'), F.substring("props", 2, 1 << 30))).otherwise(F.col("props"))
    )
    got = variants.with_fields(events.withColumn("cell", cell), "cell", {"k": ("$.k", "bigint")}, keep="v")
    back = F.get_json_object(variants.back_to_text(F.col("v")), "$.extra.from[0]")
    return got.select("event_id", "k", F.col("k_outcome").alias("outcome"), back.alias("extra"))


# ------------------------------------------------------------------ dedupe


def _events_day(spark, sf):
    return _t(spark, sf, "events").withColumn("day", F.to_date("ts"))


def q_keep_last(spark, sf):
    ev = _events_day(spark, sf)
    return dedupe.keep_last(ev, ["user_id", "event_type", "day"], "event_id").drop("day")


def q_keep_first(spark, sf):
    ev = _events_day(spark, sf)
    return dedupe.keep_first(ev, ["user_id", "event_type", "day"], "event_id").drop("day")


# ------------------------------------------------------------------ upserts and joins


def _customer_staging(cust: DataFrame) -> DataFrame:
    updated = cust.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).withColumn(
        "c_acctbal", F.col("c_acctbal") + 1
    )
    new = cust.where(F.col("c_nationkey") == 0).withColumn("c_custkey", F.col("c_custkey") + NEW_KEY_OFFSET)
    return updated.unionByName(new)


def q_upsert_replace(spark, sf):
    cust = _t(spark, sf, "customer")
    return upsert.upsert_replace(cust, _customer_staging(cust), "c_custkey")


def q_row_delta(spark, sf):
    cust = _t(spark, sf, "customer")
    after = upsert.upsert_replace(cust, _customer_staging(cust), "c_custkey")
    return upsert.row_delta(cust, after)


def _doc_prod(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = _t(spark, sf, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left")


def _doc_staging(spark, sf):
    docs = _t(spark, sf, "documents")
    base = docs.select("doc_id", "lang", F.lit("staged").alias("source"), "n_chars", F.lit(None).cast("int").alias("quality"))
    changed = base.where(F.col("lang") == "de")
    new = base.where(F.col("lang") == "fr").withColumn("doc_id", F.col("doc_id") + NEW_KEY_OFFSET)
    return changed.unionByName(new)


def q_upsert_protect(spark, sf):
    prod = _doc_prod(spark, sf)
    return upsert.upsert_protect(prod, _doc_staging(spark, sf), "doc_id", F.col("quality").isNotNull())


def q_anti_seen(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.anti_seen(docs, _t(spark, sf, "labels"), "doc_id")


def q_enrich(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.enrich(docs, _t(spark, sf, "labels"), "doc_id")


# ------------------------------------------------------------------ listings


def q_top_n(spark, sf):
    orders = _t(spark, sf, "orders")
    return listing.top_n(orders, 20, order="o_totalprice", direction="desc", last_days=7,
                         ts_col="o_orderdate", id_col="o_orderkey", order_columns=("o_totalprice",))


def q_page_range(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = listing.page_range(orders, 2, 4, [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return out.select("o_orderkey", "o_totalprice", F.col("pos").cast("bigint").alias("pos"), "page_no")


def q_keyword_exclude(spark, sf):
    part = _t(spark, sf, "part").select("p_partkey", "p_name")
    return listing.exclude_keywords(part, "p_name", ("ring", "gear"))


# ------------------------------------------------------------------ scalar cleaning


def q_abbrev_count(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    k = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    t = F.round(F.col("o_totalprice") / 100).cast("bigint")
    u = F.round(F.col("o_totalprice") / 10000).cast("bigint")
    txt = o.select(
        "o_orderkey",
        F.concat(k.cast("string"), F.lit("K")).alias("count_k"),
        F.concat((t / 10).cast("bigint").cast("string"), F.lit("."), (t % 10).cast("string"), F.lit("K")).alias("count_kd"),
        F.concat((u / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((u % 100).cast("string"), 2, "0"), F.lit("M")).alias("count_md"),
    )
    return txt.select(
        "o_orderkey", "count_k", "count_kd", "count_md",
        S.abbrev_count("count_k").alias("n_k"),
        S.abbrev_count("count_kd").alias("n_kd"),
        S.abbrev_count("count_md").alias("n_md"),
    )


def q_default_fill(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "event_type")
    blanked = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type"))
    return ev.select("event_id", S.fill_default(blanked, "unknown").alias("event_type"))


def _order_labels():
    return (
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("Locked")))
        .when(F.col("o_orderstatus") == "P", F.array(F.lit("Sticky")))
        .otherwise(F.array().cast("array<string>"))
    )


def q_status_array(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return o.select("o_orderkey", F.array_join(S.status_array(_order_labels()), ",").alias("status"))


def q_parse_stamp(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "ts")
    stamp = S.format_stamp("ts")
    return ev.select("event_id", stamp.alias("stamp"), S.parse_forum_ts(stamp).alias("parsed"))


def q_clean_text(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", S.strip(S.remove_tabs_newlines("text")).alias("clean"))


def q_props_digits(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "props")
    return ev.select("event_id", S.digits_or_zero("props").alias("k"))


def q_id_from_url(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", "url")
    num = F.regexp_extract("url", r"/([0-9]+)(?:\.html)?/?(?:[?#].*)?$", 1).try_cast("int")
    return pages.select("page_id", num.alias("url_id"))


def q_truncate_trim(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    # E9 is the operator (a declared column width); the whole text is still
    # trimmed, and its trimmed length is reported next to the stored head
    return docs.select("doc_id", S.truncate_trim("text", 100).alias("head"),
                       F.length(F.rtrim("text")).alias("n_chars"))


# ------------------------------------------------------------------ more inventory items


def q_word_count_lower(spark, sf):
    conv = _wide(spark, sf, "conversations", "conv_id", "text")
    return wordcount.word_counts(conv, "conv_id", "text", lower_case=True)


def q_status_rows(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    threads = o.select(F.col("o_orderkey"), S.status_array(_order_labels()).alias("status"))
    return nested.explode_status(threads, key="o_orderkey")


def q_flag_first_n(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = listing.flag_first_n(o, 10, [F.desc("o_totalprice"), F.asc("o_orderkey")], "o_orderkey")
    return out.select("o_orderkey", "enriched")


def q_number_separators(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    txt = F.format_number(F.floor("o_totalprice").cast("bigint"), 0)
    return o.select("o_orderkey", txt.alias("txt"), S.int_with_separators(txt).alias("n"))


def q_text_after_marker(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", "url")
    return pages.select("page_id", S.text_after_marker("url", "/", "none").alias("tail"))


def q_nested_to_json(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "event_type", "user_id")
    return ev.select("event_id", nested.to_json_text(F.struct("event_id", "event_type", "user_id")).alias("j"))


def q_invalid_chars(spark, sf):
    pages = _wide(spark, sf, "pages", "page_id", "html")
    return pages.select("page_id", F.length(S.replace_invalid_utf8(F.col("html").cast("binary"))).alias("n_chars"))


def q_repr_cells(spark, sf):
    from pyspark.sql import types as T

    ev = _t(spark, sf, "events").select("event_id", "props")
    cell = F.concat(F.lit("["), F.regexp_replace("props", '"', "'"), F.lit("]"))
    elem = T.StructType([T.StructField("k", T.IntegerType())])
    return explode_rows(ev, ["event_id"], nested.decode_repr_cell(cell, elem), "r").select("event_id", "r.k")


def q_keep_last_turn(spark, sf):
    conv = _t(spark, sf, "conversations")
    return dedupe.keep_last(conv, ["conv_id", "role"], "turn")


# ------------------------------------------------------------------ HTML


def q_html_links(spark, sf):
    pages = _wide(spark, sf, "pages", "page_id", "html")
    return H.links(pages)


# ------------------------------------------------------------------ extractors over generated markup


def _escaped(c):
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def q_thread_comments(spark, sf):
    # H2 + H3: each turn is the only comment of a page of its conversation's thread
    conv = _t(spark, sf, "conversations").where(F.col("text").isNotNull())
    url = F.format_string("https://f.example/t/talk.%d/page-%d", "conv_id", F.col("turn") + 2)
    article = F.concat(
        F.lit('<article class="message message--post js-post js-inlineModContainer" data-author="'), "role",
        F.lit('"><a class="username" href="/u/'), "role", F.lit("."), F.col("turn").cast("string"),
        F.lit('/">x</a><div class="message-attribution-main listInline"><time title="Jun 12, 2022 at 3:04 PM"></time></div><div class="bbWrapper">'),
        _escaped(F.col("text")), F.lit("</div></article>"))
    overlay = F.format_string('<a id="reaction-1">Love %d,%03d</a><a id="reaction-2">%d</a>', F.col("turn") + 1, F.col("conv_id") % 1000, "turn")
    pages = conv.select(F.col("conv_id").alias("page_id"), url.alias("url"), article.alias("html"))
    overlays = conv.where("turn % 2 = 0").select(url.alias("url"), F.lit(0).alias("pos"), overlay.alias("html"))
    return H.thread_comments(pages, overlays).select("thread_id", "page_no", "pos", "user_id", "username", "reply", "love", "brick")


def q_thread_listing(spark, sf):
    # H1: each order is an item of a listing page of its own
    o = _dealt(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    item = F.concat(
        F.lit('<div class="structItemContainer-group js-threadList"><div class="structItem" data-author="'), F.col("o_custkey").cast("string"),
        F.lit('"><div class="structItem-title"><a data-tp-primary="on" href="/t/order.'), F.col("o_orderkey").cast("string"), F.lit('/"> '),
        "o_orderpriority", F.lit(' </a></div><a class="username" href="/u/c.'), F.col("o_custkey").cast("string"),
        F.lit('/">c</a><dl class="pairs pairs--justified"><dd>'), F.col("o_orderkey").cast("string"),
        F.lit('K</dd></dl><dl class="pairs pairs--justified structItem-minor"><dd>'), F.col("o_custkey").cast("string"), F.lit("</dd></dl></div></div>"))
    pages = o.select(F.col("o_orderkey").alias("page_id"), F.lit("https://f.example/f/33/page-4").alias("url"), item.alias("html"))
    listed = H.thread_listing(pages)
    return listed.select("page_no", "pos", "thread_id", "title", "author_name", "author_id", "reply_count", "view_count",
                         F.array_join("status", ",").alias("status"))


RUN_TS = _dt.datetime(2024, 1, 2, 3, 4)


def q_member_cards(spark, sf):
    # H4, H6 (+E13, E15, E18): each customer is a member card, every third id on two pages
    c = _dealt(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    stat = lambda n: F.concat(F.lit("<dl><dd>"), F.format_number(n, 0), F.lit("</dd></dl>"))
    card = F.concat(
        F.lit('<div class="memberTooltip"><a class="username" data-user-id="'), F.col("c_custkey").cast("string"), F.lit('"> '), "c_name",
        F.lit(' </a><span class="userTitle">'), "c_mktsegment", F.lit('</span><div class="memberTooltip-blurb">Dev From  N'),
        F.col("c_nationkey").cast("string"), F.lit('\n</div><time class="u-dt" title="Jun 2, 2022 at 3:04 PM"></time><div class="memberTooltip-stats">'),
        stat(F.col("c_custkey") * 7), stat(F.col("c_custkey")), stat(F.col("c_nationkey")), F.lit("</div></div>"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("c_custkey") % 3 == 0, 2).otherwise(1)))
    pages = c.select(F.col("c_custkey").alias("page_id"), card.alias("html"), copies.alias("n")).withColumn(
        "url", F.format_string("https://f.example/online/page-%d", "n"))
    members = H.online_members(pages, RUN_TS)
    return members.select("user_id", "username", "title", "location", F.col("join_date").cast("string").alias("join_date"),
                          F.col("last_seen").cast("string").alias("last_seen"), "message", "reaction", "point")


# ------------------------------------------------------------------ pipelines over the tables


def _order_threads(spark, sf):
    """Orders as raw threads; the replies of an order are its clerk's priority words."""
    reply = lambda user, text, minute: F.struct(
        user.cast("int").alias("user_id"), F.lit("u").alias("username"), text.alias("reply"),
        F.format_string("Jun 12, 2022 3:%02d PM", minute.cast("int")).alias("created_at"), F.lit(0).alias("love"), F.lit(0).alias("brick"))
    key = F.col("o_orderkey")
    replies = F.array(reply(key % 3, F.col("o_orderpriority"), key % 2), reply(key % 2, F.lit("again, again"), key % 2))
    return _t(spark, sf, "orders").select(
        key.cast("int").alias("thread_id"), F.col("o_orderpriority").alias("title"), F.lit("  padded author  ").alias("author_name"),
        F.col("o_custkey").cast("int").alias("author_id"), F.concat(key.cast("string"), F.lit("K")).alias("reply_count"),
        F.lpad(key.cast("string"), 20, "9").alias("view_count"), F.when(key % 5 != 0, replies).alias("participants"),
        F.lit("Jun 12, 2022 at 3:04 PM").alias("created_at"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        F.lit(33).alias("f"), F.when(F.col("o_orderstatus") == "F", F.array(F.lit("Locked"))).alias("status"))


def q_clean_threads(spark, sf):
    # P1 (E1 with numbers beyond a bigint, G-A1 in a row, E7, E9, E17)
    from threadmill.plans import etl

    words = F.aggregate(F.map_values("word_count"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return etl.clean_threads(_order_threads(spark, sf)).select(
        "thread_id", "author_name", "reply_count", "view_count", F.col("created_at").cast("string").alias("created_at"),
        F.array_join("status", ",").alias("status"), words.alias("n_words"))


def q_participants_etl(spark, sf):
    # P3 (C1, C3, N1, G-A4): two replies share a key where user and minute agree
    from threadmill.plans import etl

    return etl.clean_participants(_order_threads(spark, sf)).select(
        "thread_id", "user_id", "reply", F.col("created_at").cast("string").alias("created_at"))


def q_stream_merge_rows(spark, sf):
    # T2's rule: of one batch the last row of each key, then replace (J3) by user
    ev = _t(spark, sf, "events").select("user_id", "event_id", "event_type")
    stored = dedupe.keep_last(ev.where("event_id % 2 = 0"), "user_id", "event_id")
    batch = dedupe.keep_last(ev.where("event_id % 2 = 1 AND user_id % 3 <> 0"), "user_id", "event_id")
    return upsert.upsert_replace(stored, batch, "user_id")


def q_id_from_link(spark, sf):
    link = F.concat(F.lit("/members/"), F.lower("c_name"), F.lit("."), F.col("c_custkey").cast("string"), F.when(F.col("c_nationkey") % 2 == 0, "/").otherwise(""))
    return _t(spark, sf, "customer").select("c_custkey", S.id_from_link(link).alias("user_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": q_word_count,
    "word_count_map": q_word_count_map,
    "doc_word_count": q_doc_word_count,
    "thread_word_count": q_thread_word_count,
    "top_words": q_top_words,
    "title_keywords": q_title_keywords,
    "title_medians": q_title_medians,
    "maintained_counts": q_maintained_counts,
    "incremental_extract": q_incremental_extract,
    "full_extract": q_full_extract,
    "watermark_advance": q_watermark_advance,
    "tie_extract": q_tie_extract,
    "newest_merge": q_newest_merge,
    "file_ledger": q_file_ledger,
    "checked_load": q_checked_load,
    "explode_nested": q_explode_nested,
    "keep_last_nested": q_keep_last_nested,
    "json_records": q_json_records,
    "variant_cells": q_variant_cells,
    "keep_last": q_keep_last,
    "keep_first": q_keep_first,
    "upsert_replace": q_upsert_replace,
    "row_delta": q_row_delta,
    "upsert_protect": q_upsert_protect,
    "anti_seen": q_anti_seen,
    "enrich": q_enrich,
    "top_n": q_top_n,
    "page_range": q_page_range,
    "keyword_exclude": q_keyword_exclude,
    "abbrev_count": q_abbrev_count,
    "default_fill": q_default_fill,
    "status_array": q_status_array,
    "parse_stamp": q_parse_stamp,
    "clean_text": q_clean_text,
    "props_digits": q_props_digits,
    "id_from_url": q_id_from_url,
    "truncate_trim": q_truncate_trim,
    "html_links": q_html_links,
    "word_count_lower": q_word_count_lower,
    "status_rows": q_status_rows,
    "flag_first_n": q_flag_first_n,
    "number_separators": q_number_separators,
    "text_after_marker": q_text_after_marker,
    "nested_to_json": q_nested_to_json,
    "invalid_chars": q_invalid_chars,
    "repr_cells": q_repr_cells,
    "keep_last_turn": q_keep_last_turn,
    "thread_comments": q_thread_comments,
    "thread_listing": q_thread_listing,
    "member_cards": q_member_cards,
    "clean_threads": q_clean_threads,
    "participants_etl": q_participants_etl,
    "stream_merge_rows": q_stream_merge_rows,
    "id_from_link": q_id_from_link,
}


# ------------------------------------------------------------------ DuckDB oracle

_P = PUNCTUATION.replace("'", "''")
_WORDS = f"string_split_regex(translate(text, '{_P}', ''), '\\s+')"

_CUST_STG = f"""stg AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  UNION ALL
  SELECT c_custkey + {NEW_KEY_OFFSET}, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_nationkey = 0)"""

_CUST_UPSERT = f"""WITH {_CUST_STG}
SELECT * FROM customer p WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.c_custkey = p.c_custkey)
UNION ALL SELECT * FROM stg"""

_DOC_LINES = """SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS pos,
       unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL"""

ORACLE_SQL: dict[str, str] = {
    "thread_comments": """
        SELECT CAST(conv_id AS INTEGER) AS thread_id, CAST(turn + 2 AS INTEGER) AS page_no, 0 AS pos, CAST(turn AS INTEGER) AS user_id,
               role AS username, replace(replace(text, chr(9), ''), chr(10), '') AS reply,
               CASE WHEN turn % 2 = 0 THEN CAST((turn + 1) * 1000 + conv_id % 1000 AS INTEGER) ELSE 0 END AS love,
               CASE WHEN turn % 2 = 0 THEN CAST(turn AS INTEGER) ELSE 0 END AS brick
        FROM conversations WHERE text IS NOT NULL""",
    "thread_listing": """
        SELECT 4 AS page_no, 0 AS pos, CAST(o_orderkey AS INTEGER) AS thread_id, o_orderpriority AS title, CAST(o_custkey AS VARCHAR) AS author_name,
               CAST(o_custkey AS INTEGER) AS author_id, o_orderkey || 'K' AS reply_count, CAST(o_custkey AS VARCHAR) AS view_count, 'Open' AS status
        FROM orders""",
    "member_cards": """
        SELECT CAST(c_custkey AS INTEGER) AS user_id, c_name AS username, c_mktsegment AS title, 'N' || c_nationkey AS location,
               '2022-06-02' AS join_date, '2024-01-02 03:04:00' AS last_seen, CAST(c_custkey * 7 AS INTEGER) AS message,
               CAST(c_custkey AS INTEGER) AS reaction, CAST(c_nationkey AS INTEGER) AS point
        FROM customer""",
    "clean_threads": """
        SELECT CAST(o_orderkey AS INTEGER) AS thread_id, '  padded author' AS author_name, o_orderkey * 1000 AS reply_count,
               CAST(NULL AS BIGINT) AS view_count, '2022-06-12 15:04:00' AS created_at,
               CASE WHEN o_orderstatus = 'F' THEN 'Locked' ELSE 'Open' END AS status,
               CASE WHEN o_orderkey % 5 <> 0 THEN 2 + len(list_filter(
                 string_split(replace(o_orderpriority, '-', ''), ' '), lambda x: x <> '')) END AS n_words
        FROM orders""",
    "participants_etl": """
        WITH r AS (
          SELECT o_orderkey AS k, o_orderkey % 3 AS u, o_orderpriority AS reply, 0 AS pos FROM orders WHERE o_orderkey % 5 <> 0
          UNION ALL SELECT o_orderkey, o_orderkey % 2, 'again, again', 1 FROM orders WHERE o_orderkey % 5 <> 0)
        SELECT CAST(k AS INTEGER) AS thread_id, CAST(u AS INTEGER) AS user_id, reply,
               CASE WHEN k % 2 = 0 THEN '2022-06-12 15:00:00' ELSE '2022-06-12 15:01:00' END AS created_at
        FROM r QUALIFY row_number() OVER (PARTITION BY k, u ORDER BY pos DESC) = 1""",
    "stream_merge_rows": """
        WITH ev AS (SELECT user_id, event_id, event_type, event_id % 2 = 1 AS fresh FROM events WHERE event_id % 2 = 0 OR user_id % 3 <> 0)
        SELECT user_id, event_id, event_type FROM ev
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY fresh DESC, event_id DESC) = 1""",
    "id_from_link": "SELECT c_custkey, CAST(c_custkey AS INTEGER) AS user_id FROM customer",
    "word_count": f"""
        SELECT conv_id, word, count(*) AS n
        FROM (SELECT conv_id, unnest({_WORDS}) AS word FROM conversations)
        WHERE word <> '' GROUP BY conv_id, word""",
    "word_count_map": f"""
        SELECT conv_id, CAST(count(*) AS BIGINT) AS n_words, CAST(sum(n) AS BIGINT) AS n_tokens FROM (
          SELECT conv_id, word, count(*) AS n
          FROM (SELECT conv_id, unnest({_WORDS}) AS word FROM conversations)
          WHERE word <> '' GROUP BY conv_id, word) GROUP BY conv_id""",
    "doc_word_count": f"""
        SELECT doc_id, word, count(*) AS n
        FROM (SELECT doc_id, unnest({_WORDS}) AS word FROM documents)
        WHERE word <> '' GROUP BY doc_id, word""",
    "thread_word_count": f"""
        SELECT doc_id, word, count(*) AS n
        FROM (SELECT doc_id, unnest({_WORDS}) AS word FROM documents)
        WHERE word <> '' GROUP BY doc_id, word""",
    "top_words": f"""
        WITH busiest AS (SELECT conv_id FROM conversations GROUP BY conv_id
                         ORDER BY count(*) DESC, conv_id LIMIT 20)
        SELECT word, CAST(count(*) AS BIGINT) AS n
        FROM (SELECT unnest({_WORDS}) AS word FROM conversations
              WHERE conv_id IN (SELECT conv_id FROM busiest))
        WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 50""",
    "title_keywords": f"""
        WITH w AS (SELECT DISTINCT p_partkey, word FROM (
                     SELECT p_partkey, unnest(string_split_regex(lower(translate(p_name, '{_P}', '')), '\\s+')) AS word
                     FROM part) WHERE word <> '')
        SELECT word, count(*) AS n_rows,
               CAST(sum(CAST(l_quantity AS DECIMAL(38,4))) AS DOUBLE) AS sum_qty,
               CAST(sum(CAST(l_quantity AS DECIMAL(38,4))) AS DOUBLE) / count(*) AS avg_qty,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS DOUBLE) AS sum_price,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS DOUBLE) / count(*) AS avg_price
        FROM lineitem JOIN w ON l_partkey = p_partkey GROUP BY word""",
    "title_medians": f"""
        WITH w AS (SELECT DISTINCT p_partkey, word FROM (
                     SELECT p_partkey, unnest(string_split_regex(lower(translate(p_name, '{_P}', '')), '\\s+')) AS word
                     FROM part) WHERE word <> '')
        SELECT word, count(*) AS n_values, count(*) AS n_rows, true AS "close"
        FROM lineitem JOIN w ON l_partkey = p_partkey WHERE l_extendedprice IS NOT NULL GROUP BY word""",
    "maintained_counts": f"""
        WITH edited AS (SELECT conv_id, turn, role, text || ' edited twice' AS text FROM conversations WHERE role = 'assistant'),
        stored AS (SELECT conv_id, turn, role, text FROM conversations c
                   WHERE NOT EXISTS (SELECT 1 FROM edited e WHERE e.conv_id = c.conv_id AND e.turn = c.turn)
                   UNION ALL SELECT * FROM edited),
        left_over AS (SELECT conv_id, text FROM stored s
                   WHERE NOT EXISTS (SELECT 1 FROM stored o WHERE o.role = 'user' AND o.turn = 0 AND o.conv_id = s.conv_id AND o.turn = s.turn))
        SELECT conv_id, word, count(*) AS n
        FROM (SELECT conv_id, unnest(string_split_regex(translate(text, '{_P}', ''), '\\s+')) AS word FROM left_over)
        WHERE word <> '' GROUP BY conv_id, word""",
    "incremental_extract": f"SELECT * FROM events WHERE ts > TIMESTAMP '{WATERMARK_TS}'",
    "full_extract": "SELECT * FROM events",
    "tie_extract": f"""
        SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS stamp FROM events
        WHERE date_trunc('day', ts) > TIMESTAMP '{WATERMARK_TS}'
           OR (date_trunc('day', ts) = TIMESTAMP '{WATERMARK_TS}' AND event_type = 'error')""",
    "newest_merge": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "file_ledger": """
        WITH f AS (SELECT '/landing/' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS path, CAST(octet_length(encode(html)) AS BIGINT) AS length,
                          sha256(html) AS digest, starts_with(url, 'https://') AS fresh FROM pages WHERE html IS NOT NULL),
        k AS (SELECT DISTINCT digest FROM f WHERE NOT fresh),
        u AS (SELECT path, length, digest FROM f WHERE fresh UNION ALL SELECT path || '-again', length, digest FROM f)
        SELECT path, length, digest, CASE WHEN digest NOT IN (SELECT digest FROM k)
               AND path = min(path) OVER (PARTITION BY digest) THEN 'new' ELSE 'refused' END AS status FROM u""",
    "checked_load": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id, event_type,
               CASE WHEN event_type = 'error' THEN 'user_id is no bigint' END AS reason FROM events""",
    "watermark_advance": f"""
        SELECT 'events' AS entity, max(ts) AS updated_at FROM events WHERE ts > TIMESTAMP '{WATERMARK_TS}'""",
    "explode_nested": f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, line FROM ({_DOC_LINES})",
    "keep_last_nested": f"""
        SELECT doc_id, CAST(max(pos) AS INTEGER) AS pos, line FROM ({_DOC_LINES}) GROUP BY doc_id, line""",
    "variant_cells": """
        SELECT event_id,
               CASE WHEN event_type IN ('error', 'purchase') THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
               CASE WHEN event_type = 'error' THEN 'wrong type' WHEN props IS NULL THEN 'null' WHEN event_type = 'purchase' THEN 'unreadable cell'
                    WHEN json_extract(props, '$.k') IS NULL THEN 'missing' ELSE 'read' END AS outcome,
               CASE WHEN event_type = 'signup' AND props IS NOT NULL THEN 'web' END AS extra
        FROM events""",
    "json_records": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "keep_last": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                                       ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "keep_first": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                                       ORDER BY event_id ASC) AS rn FROM events) WHERE rn = 1""",
    "upsert_replace": _CUST_UPSERT,
    "row_delta": f"""
        SELECT (SELECT count(*) FROM customer) AS rows_before,
               (SELECT count(*) FROM ({_CUST_UPSERT})) AS rows_after,
               (SELECT count(*) FROM ({_CUST_UPSERT})) - (SELECT count(*) FROM customer) AS delta""",
    "upsert_protect": f"""
        WITH prod AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality
                      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
        stg AS (SELECT doc_id, lang, 'staged' AS source, n_chars, CAST(NULL AS INTEGER) AS quality
                FROM documents WHERE lang = 'de'
                UNION ALL
                SELECT doc_id + {NEW_KEY_OFFSET}, lang, 'staged', n_chars, CAST(NULL AS INTEGER)
                FROM documents WHERE lang = 'fr'),
        acc AS (SELECT * FROM stg s WHERE NOT EXISTS (
                  SELECT 1 FROM prod p WHERE p.doc_id = s.doc_id AND p.quality IS NOT NULL))
        SELECT * FROM prod p WHERE NOT EXISTS (SELECT 1 FROM acc a WHERE a.doc_id = p.doc_id)
        UNION ALL SELECT * FROM acc""",
    "anti_seen": """
        SELECT doc_id, lang, source, n_chars FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "enrich": """
        SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "top_n": """
        SELECT * FROM orders
        WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 7 DAY
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
    "page_range": """
        SELECT o_orderkey, o_totalprice, pos, CAST(ceil(pos / 20) AS INTEGER) AS page_no FROM (
          SELECT o_orderkey, o_totalprice,
                 CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS pos
          FROM orders) WHERE pos BETWEEN 21 AND 80""",
    "keyword_exclude": """
        SELECT p_partkey, p_name FROM part
        WHERE NOT (lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%gear%')""",
    "abbrev_count": """
        SELECT o_orderkey, count_k, count_kd, count_md,
               k * 1000 AS n_k, t * 100 AS n_kd, u * 10000 AS n_md FROM (
          SELECT o_orderkey, k, t, u,
                 CAST(k AS VARCHAR) || 'K' AS count_k,
                 CAST(t // 10 AS VARCHAR) || '.' || CAST(t % 10 AS VARCHAR) || 'K' AS count_kd,
                 CAST(u // 100 AS VARCHAR) || '.' || lpad(CAST(u % 100 AS VARCHAR), 2, '0') || 'M' AS count_md
          FROM (SELECT o_orderkey,
                       CAST(floor(o_totalprice / 1000) AS BIGINT) AS k,
                       CAST(round(o_totalprice / 100) AS BIGINT) AS t,
                       CAST(round(o_totalprice / 10000) AS BIGINT) AS u FROM orders))""",
    "default_fill": """
        SELECT event_id, coalesce(nullif(trim(CASE WHEN event_type = 'error' THEN '' ELSE event_type END), ''),
                                  'unknown') AS event_type FROM events""",
    "status_array": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Locked' WHEN 'P' THEN 'Sticky,Open'
                                              ELSE 'Open' END AS status FROM orders""",
    "parse_stamp": """
        SELECT event_id, strftime(ts, '%b %d, %Y %I:%M %p') AS stamp, date_trunc('minute', ts) AS parsed
        FROM events""",
    "clean_text": "SELECT doc_id, trim(regexp_replace(text, '[\\t\\n]', '', 'g')) AS clean FROM documents",
    "props_digits": """
        SELECT event_id, coalesce(TRY_CAST(regexp_replace(props, '\\D', '', 'g') AS INTEGER), 0) AS k
        FROM events""",
    "id_from_url": """
        SELECT page_id, TRY_CAST(regexp_extract(url, '/([0-9]+)(?:\\.html)?/?(?:[?#].*)?$', 1) AS INTEGER) AS url_id
        FROM pages""",
    "truncate_trim": "SELECT doc_id, left(rtrim(text), 100) AS head, CAST(length(rtrim(text)) AS INTEGER) AS n_chars FROM documents",
    "html_links": """
        SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM (
          SELECT page_id, unnest(range(0, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) AS pos,
                 unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)""",
    "word_count_lower": f"""
        SELECT conv_id, word, count(*) AS n
        FROM (SELECT conv_id, unnest(string_split_regex(lower(translate(text, '{_P}', '')), '\\s+')) AS word
              FROM conversations)
        WHERE word <> '' GROUP BY conv_id, word""",
    "status_rows": """
        SELECT o_orderkey, unnest(CASE o_orderstatus WHEN 'F' THEN ['Locked'] WHEN 'P' THEN ['Sticky', 'Open']
                                                     ELSE ['Open'] END) AS status FROM orders""",
    "flag_first_n": """
        SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) <= 10 AS enriched
        FROM orders""",
    "number_separators": """
        SELECT o_orderkey, txt, CAST(replace(txt, ',', '') AS INTEGER) AS n FROM (
          SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS txt FROM orders)""",
    "text_after_marker": """
        SELECT page_id, CASE WHEN contains(url, '/') THEN trim(string_split(url, '/')[-1]) ELSE 'none' END AS tail
        FROM pages""",
    "nested_to_json": """
        SELECT event_id, CAST(json_object('event_id', event_id, 'event_type', event_type, 'user_id', user_id)
                              AS VARCHAR) AS j FROM events""",
    "invalid_chars": "SELECT page_id, CAST(length(html) AS INTEGER) AS n_chars FROM pages",
    "repr_cells": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "keep_last_turn": """
        SELECT conv_id, turn, role, text FROM (
          SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS rn FROM conversations)
        WHERE rn = 1""",
}
