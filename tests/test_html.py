"""HTML record jobs on small markup written for these tests (the stand-in
`pages` table holds no forum markup)."""

import datetime as dt

from pyspark.sql import functions as F

from threadmill.plans import html as H

LISTING = """<html><body>
<div class="structItem structItem--thread" data-author="pinned"><div class="structItem-title">
  <a href="/t/pinned.1/" data-tp-primary="on">Rules</a></div></div>
<div class="structItemContainer-group js-threadList">
 <div class="structItem" data-author="an">
  <div class="structItem-title"><a href="/t/review-of-a-keyboard.1001/" data-tp-primary="on"> Review of a keyboard </a></div>
  <a class="username" href="/u/an.7/">an</a>
  <dl class="pairs pairs--justified"><dt>Replies</dt><dd>12K</dd></dl>
  <dl class="pairs pairs--justified structItem-minor"><dt>Views</dt><dd>3M</dd></dl>
  <time class="u-dt" title="Jun 12, 2022 at 3:04 PM">x</time>
  <span class="u-srOnly">Sticky</span>
 </div>
 <div class="structItem" data-author="bo">
  <div class="structItem-title"><a href="/t/locked-one.1002/" data-tp-primary="on">Locked one</a></div>
  <a class="username" href="/u/bo.8/">bo</a>
  <dl class="pairs pairs--justified"><dt>Replies</dt><dd>45</dd></dl>
  <dl class="pairs pairs--justified structItem-minor"><dt>Views</dt><dd>1.5K</dd></dl>
  <time class="u-dt" title="Jun 2, 2022 at 11:00 AM">y</time>
  <span class="u-srOnly">Locked</span>
 </div>
 <div class="structItem" data-author="cy">
  <div class="structItem-title"><a href="/t/plain.1003/" data-tp-primary="on">Plain</a></div>
  <a class="username" href="/u/cy.9/">cy</a>
  <dl class="pairs pairs--justified"><dd>0</dd></dl><dl class="pairs pairs--justified structItem-minor"><dd>7</dd></dl>
  <time class="u-dt" title="Jun 3, 2022 at 1:00 PM">z</time>
 </div>
</div></body></html>"""

COMMENTS = """<html><body>
<article class="message message--post js-post js-inlineModContainer  " data-author="an">
  <h4 class="message-name"><a class="username" href="/u/an.7/">an</a></h4>
  <div class="message-attribution-main listInline"><time title="Jun 12, 2022 at 3:04 PM">t</time></div>
  <div class="bbWrapper">opening post</div>
</article>
<article class="message message--post js-post js-inlineModContainer" data-author="bo">
  <h4 class="message-name"><a class="username" href="/u/bo.8/">bo</a></h4>
  <div class="message-attribution-main listInline"><time title="Jun 12, 2022 at 3:10 PM">t</time></div>
  <div class="bbWrapper"><blockquote>quoted <span>who</span></blockquote><span>x</span>good,
\tgood <a href="/l">link</a>keyboard!<i>i</i><i>kept</i></div>
</article></body></html>"""

CARD = """<div role="tooltip"><div class="memberTooltip">
 <a class="username" data-user-id="42"> dev </a><span class="userTitle">Senior Member</span>
 <div class="memberTooltip-blurb">Dev From  Ha Noi\n</div>
 <time class="u-dt" title="Jun 2, 2022">j</time><time class="u-dt" title="Jun 12, 2022 at 3:04 PM">l</time>
 <div class="memberTooltip-stats"><dl><dd>1,204\n</dd></dl><dl><dd>\t7</dd></dl><dl><dd>12</dd></dl></div>
</div></div>"""

CARD_NO_LOC = CARD.replace("Dev From  Ha Noi", "Dev").replace('<time class="u-dt" title="Jun 12, 2022 at 3:04 PM">l</time>', "")

PROFILE = """<html><body><h1 class="memberHeader-name"><span class="username--staff username--moderator"><span class="username">mod</span></span></h1><span class="userTitle">Member</span>
<div class="memberHeader-banners"> Staff </div>
<div class="memberHeader-blurb">Lives in <a href="/loc">Ha Noi</a></div>
<div class="memberHeader-blurb"><dl><dt>Joined</dt><dd>Jun 2, 2022</dd></dl></div>
<time class="u-dt" title="Jun 12, 2022 at 3:04 PM">s</time>
<div class="pairJustifier"><dl><a href="/m"> 1,204 </a></dl><dl><dd> 7 </dd></dl><dl><dd> 12 </dd></dl></div>
</body></html>"""


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_thread_listing(spark):
    df = H.thread_listing(_pages(spark, [(1, "https://f.example/f/33/page-2", LISTING)]))
    rows = sorted(df.collect(), key=lambda r: r["pos"])
    assert [r["thread_id"] for r in rows] == [1001, 1002, 1003]  # pinned item excluded (C9)
    r = rows[0]
    assert (r["page_no"], r["title"], r["author_name"], r["author_id"]) == (2, "Review of a keyboard", "an", 7)
    assert (r["reply_count"], r["view_count"]) == ("12K", "3M")
    assert r["created_at"] == dt.datetime(2022, 6, 12, 15, 4)
    assert r["status"] == ["Sticky", "Open"]
    assert rows[1]["status"] == ["Locked"] and rows[2]["status"] == ["Open"]
    assert H.thread_listing(_pages(spark, [(1, "u", LISTING)]), per_page=2).count() == 2


def test_thread_comments_skips_opening_post(spark):
    pages = _pages(spark, [(1, "https://f.example/t/kb.1001/", COMMENTS), (2, "https://f.example/t/kb.1001/page-2", COMMENTS)])
    rows = sorted(H.thread_comments(pages).collect(), key=lambda r: (r["page_no"], r["pos"]))
    assert [(r["page_no"], r["pos"]) for r in rows] == [(1, 1), (2, 0), (2, 1)]
    r = rows[0]
    assert (r["thread_id"], r["user_id"], r["username"]) == (1001, 8, "bo")
    # the first span, blockquote, a and i are removed in that order, each once: the
    # first span is the one inside the quote, so the later <span>x</span> stays
    assert r["reply"] == "xgood,good keyboard!kept"
    assert r["created_at"] == dt.datetime(2022, 6, 12, 15, 10) and r["love"] == 0


def test_reaction_counts(spark):
    html = '<div><a id="reaction-1">Love 1,204</a><a id="reaction-2"></a></div>'
    r = H.reaction_counts(_pages(spark, [(1, "u", html), (2, "u", "<p>none</p>")])).orderBy("page_id").collect()
    assert [(x["love"], x["brick"]) for x in r] == [(1204, 0), (0, 0)]


def test_member_cards(spark):
    run = dt.datetime(2024, 1, 2, 3, 4)
    pages = _pages(spark, [(1, "u", CARD), (2, "u", CARD_NO_LOC), (3, "u", "<div>no card</div>")])
    rows = {r["page_id"]: r for r in H.member_cards(pages, run).collect()}
    assert set(rows) == {1, 2}
    a = rows[1]
    assert (a["user_id"], a["username"], a["title"], a["location"]) == (42, "dev", "Senior Member", "Ha Noi")
    assert a["join_date"] == dt.date(2022, 6, 2) and a["last_seen"] == dt.datetime(2022, 6, 12, 15, 4)
    assert (a["message"], a["reaction"], a["point"]) == (1204, 7, 12) and a["created_at"] == run
    assert rows[2]["location"] == "Namek" and rows[2]["last_seen"] == run


def test_member_profiles(spark):
    err = '<html><body><div data-template="error">x</div></body></html>'
    pages = _pages(spark, [(1, "https://f.example/u/77", PROFILE), (2, "https://f.example/u/78", err)])
    rows = {r["user_id"]: r for r in H.member_profiles(pages).collect()}
    m = rows[77]
    assert (m["username"], m["location"], m["title"], m["join_date"]) == ("mod", "Ha Noi", "Member | Staff", "Jun 2, 2022")
    assert (m["message"], m["reaction"], m["point"]) == ("1,204", "7", "12")
    assert m["last_seen"] == "Jun 12, 2022 at 3:04 PM"
    assert rows[78]["username"] == "" and rows[78]["title"] == ""


def test_online_members_keep_last(spark):
    run = dt.datetime(2024, 1, 2, 3, 4)
    later = CARD.replace("Senior Member", "Veteran")
    pages = _pages(spark, [(1, "https://f.example/online/page-1", CARD), (2, "https://f.example/online/page-2", later)])
    rows = H.online_members(pages, run).collect()
    assert len(rows) == 1 and rows[0]["title"] == "Veteran" and rows[0]["updated_at"] == run


def test_collect_threads_flat_comments(spark):
    from threadmill.plans import etl

    run = dt.datetime(2024, 1, 2, 3, 4)
    listing = _pages(spark, [(1, "https://f.example/f/33/page-1", LISTING)])
    comments = _pages(spark, [(10, "https://f.example/t/review-of-a-keyboard.1001/", COMMENTS),
                              (11, "https://f.example/t/review-of-a-keyboard.1001/page-2", COMMENTS),
                              (12, "https://f.example/t/plain.1003/", "<html><body></body></html>")])
    stored = spark.createDataFrame([(1002,)], "thread_id int")
    got = etl.collect_threads(listing, comments, stored, run, f=33)
    rows = {r["thread_id"]: r for r in got.threads.collect()}
    assert set(rows) == {1001, 1003}  # 1002 already stored (J5)
    r = rows[1001]
    assert r["f"] == 33 and r["updated_at"] == run and r["reply_count"] == "12K" and r["n_comments"] == 3
    assert rows[1003]["n_comments"] == 0  # collected, no comments: still counts as enriched
    c = sorted((x["page_no"], x["pos"], x["reply"]) for x in got.comments.collect())
    assert c == [(1, 1, "xgood,good keyboard!kept"), (2, 0, "opening post"), (2, 1, "xgood,good keyboard!kept")]
    excluded = etl.collect_threads(listing, comments, None, run, f=33, exclude_words=("locked",))
    assert {r["thread_id"] for r in excluded.threads.collect()} == {1001, 1003}


def test_collect_users_clears_escape_cell(spark):
    from threadmill.plans import etl

    run = dt.datetime(2024, 1, 2, 3, 4)
    card = CARD.replace("Dev From  Ha Noi", "Dev From \\./")
    rows = etl.collect_users(_pages(spark, [(1, "https://f.example/online/page-1", card)]), run).collect()
    assert len(rows) == 1 and rows[0]["location"] == "" and rows[0]["user_id"] == 42


def test_collected_loads_protect_enriched_threads(spark):
    import os
    import tempfile

    from threadmill.plans import etl
    from threadmill.sources import tables

    d = tempfile.mkdtemp(prefix="tm-p4-", dir="/tmp")
    root, croot, rej, uroot = (os.path.join(d, n) for n in ("threads", "comments", "rejects", "users"))
    listing = _pages(spark, [(1, "https://f.example/f/33/page-1", LISTING)])
    comments = _pages(spark, [(10, "https://f.example/t/review-of-a-keyboard.1001/", COMMENTS)])
    run1, run2 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 9)
    # run 1: 1001 collected with its comments, 1002 and 1003 listed only
    etl.load_collected_threads(spark, etl.collect_threads(listing, comments, None, run1, f=33), root, croot, rej)
    # run 2: listed again, and 1001's page again (with the same comments)
    m = etl.load_collected_threads(spark, etl.collect_threads(listing, comments, None, run2, f=33), root, croot, rej)
    rows = {r["thread_id"]: r for r in tables.read_partitioned(spark, root).collect()}
    assert m["rows_before"] == 3 and m["rows_after"] == 3
    assert rows[1001]["updated_at"] == run1 and rows[1001]["n_comments"] == 1  # protected (J4)
    assert rows[1002]["updated_at"] == run2 and rows[1002]["n_comments"] is None  # replaced
    assert tables.read_partitioned(spark, croot).count() == 1  # no comment appended twice

    # the warehouse step reads the flat layout directly (P1 + P3)
    roots = etl.Roots(*(os.path.join(d, n) for n in ("state", "wthreads", "wusers", "parts", "rej2", "stg")))
    src = tables.read_partitioned(spark, root)
    etl.threads_and_participants(spark, src, roots, run2, comments=tables.read_partitioned(spark, croot))
    wt = {r["thread_id"]: r["word_count"] for r in tables.read_partitioned(spark, roots.threads).collect()}
    # punctuation is removed before splitting, so "xgood,good" is one word
    assert wt[1001] == {"xgoodgood": 1, "keyboardkept": 1} and wt[1002] is None
    parts = tables.read_partitioned(spark, roots.participants).collect()
    assert [(p["thread_id"], p["user_id"]) for p in parts] == [(1001, 8)]

    users = etl.collect_users(_pages(spark, [(1, "https://f.example/online/page-1", CARD)]), run2)
    assert etl.load_collected_users(spark, users, uroot, rej)["rows_after"] == 1


def test_reactions_reach_the_participants_table(spark):
    import os
    import tempfile

    from threadmill.plans import etl
    from threadmill.sources import tables

    d = tempfile.mkdtemp(prefix="tm-h3-", dir="/tmp")
    root, croot, rej, uroot = (os.path.join(d, n) for n in ("threads", "comments", "rejects", "users"))
    url = "https://f.example/t/review-of-a-keyboard.1001/"
    listing = _pages(spark, [(1, "https://f.example/f/33/page-1", LISTING)])
    comments = _pages(spark, [(10, url, COMMENTS + CARD)])
    overlays = spark.createDataFrame([(url, 1, '<a id="reaction-1">Love 1,204</a><a id="reaction-2">3</a>')], "url string, pos int, html string")
    run = dt.datetime(2024, 1, 2)
    batch = etl.collect_threads(listing, comments, None, run, f=33, overlays=overlays)
    etl.load_collected_threads(spark, batch, root, croot, rej)
    assert [(r["love"], r["brick"]) for r in tables.read_partitioned(spark, croot).collect()] == [(1204, 3)]
    # members whose cards are on thread pages are collected too
    etl.load_collected_users(spark, batch.members, uroot, rej)
    assert [r["user_id"] for r in tables.read_partitioned(spark, uroot).collect()] == [42]
    roots = etl.Roots(*(os.path.join(d, n) for n in ("state", "wthreads", "wusers", "parts", "rej2", "stg")))
    etl.threads_and_participants(spark, tables.read_partitioned(spark, root), roots, dt.datetime(2024, 1, 3), comments=croot)
    assert [(r["love"], r["brick"]) for r in tables.read_partitioned(spark, roots.participants).collect()] == [(1204, 3)]
    assert not os.path.exists(os.path.join(d, "stg", "threads_raw", "20240103000000"))  # staging dropped (B11)


def test_a_thread_twice_in_the_source_adds_no_comments(spark):
    import os
    import tempfile

    from threadmill.plans import etl
    from threadmill.schemas import THREADS_RAW
    from threadmill.sources import tables

    d = tempfile.mkdtemp(prefix="tm-p3-", dir="/tmp")
    roots = etl.Roots(*(os.path.join(d, n) for n in ("state", "threads", "users", "parts", "rejects", "staging")))
    at = dt.datetime(2022, 6, 19)
    row = lambda k: (k, "t", "a", 1, "1", "2", [(7, "u", "hi", "Jun 12, 2022 3:04 PM", 0, 0)], "Jun 12, 2022 at 3:04 PM", at, 33, None)
    source = spark.createDataFrame([row(1), row(1), row(2)], THREADS_RAW)
    for _ in range(2):  # a rerun of the same batch changes nothing, rejects included
        report = etl.threads_and_participants(spark, source, roots, dt.datetime(2024, 1, 3), inclusive=True)
        assert [r["thread_id"] for r in tables.read_partitioned(spark, roots.participants).collect()] == [2]
        assert report["threads"].get("rejects", 2) == 2
        assert spark.read.parquet(roots.rejects + "/threads/*").count() == 2


def test_plain_pages_parse_as_the_parser_does():
    import random

    def shape(node):
        return (node.tag, node.attrs, [shape(c) if isinstance(c, H.Node) else c for c in node.children])

    def merged(tree):
        tag, attrs, children = tree
        out = []
        for c in children:
            if isinstance(c, str) and out and isinstance(out[-1], str):
                out[-1] += c
            else:
                out.append(c if isinstance(c, str) else merged(c))
        return (tag, attrs, out)

    def by_parser(html):
        b = H._Builder()
        b.feed(html)
        b.close()
        return merged(shape(b.root))

    tokens = ["<div>", '<div class="a b">', "</div>", "<p>", "</p>", '<a href="/x" href="/y" class="">', "</a>", "<br>", '<img src="é>">', "</br>", "text ", "\n", "a&amp;b",
              "&lt", "&#65;", "&", "1 < 2", "<", ">", "<dd >", "<DIV>", "<br/>", "<script>", "</script>", "<!-- <p> -->", "<!doctype html>", "<a href=x>", "<a b>", "<a href='q'>",
              '<a href="1&amp;2">', '<a href="', "</ div>", "</>", "<?x?>", "<title>", "</title>", "é", '"']
    rng, plain = random.Random(3), 0
    for i in range(4000):
        html = "".join(rng.choices(tokens[: 14 if i % 2 else len(tokens)], k=rng.randrange(1, 12)))
        assert merged(shape(H.parse(html))) == by_parser(html), html
        plain += H._parse_plain(html) is not None
    assert plain > 1000  # both ways were taken


def test_records_of_odd_pages(spark):
    pages = spark.createDataFrame([(None, None, LISTING), (2**60 + 1, "u", None), (2**60 + 1, "u", LISTING), (4, "u", "")], "page_id long, url string, html string")
    assert sorted(str(r["page_id"]) for r in H._run(pages.coalesce(1), H._listing, H.LISTING_RAW).collect()) == sorted(["None"] * 3 + [str(2**60 + 1)] * 3)


def test_rows_of_one_row_group_are_parsed_by_many_tasks(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from threadmill.plans import catalog

    n = 4000
    keys = list(range(1, n + 1))
    pq.write_table(pa.table({"o_orderkey": pa.array(keys, pa.int64()), "o_custkey": pa.array(keys, pa.int64()), "o_orderpriority": ["3-MEDIUM"] * n}), tmp_path / "orders.parquet")
    pq.write_table(pa.table({"c_custkey": pa.array(keys, pa.int64()), "c_name": ["n"] * n, "c_nationkey": pa.array([3] * n, pa.int64()), "c_mktsegment": ["m"] * n}), tmp_path / "customer.parquet")
    listed = catalog.QUERIES["thread_listing"](spark, str(tmp_path))
    tasks = listed.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == n
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in tasks) < n / 4
    assert catalog.QUERIES["member_cards"](spark, str(tmp_path)).count() == n
