"""HTML record jobs (H1-H6): a table of stored pages -> typed records.

Each job is one `mapInArrow` over batches of `(page_id, url, html)`: a small
element tree is built per page, as Python's stdlib `html.parser` reads it
(plain markup by one expression, anything else by that parser itself), and
the job pulls out raw field text. Everything after that (ids from links, numbers,
timestamps, status arrays, defaults) is built-in column expressions from
`threadmill.functions.scalars`, so the Python step stays a per-page helper.
Pages are independent: the jobs are narrow (no shuffle) and scale with the
number of input partitions. Files of few, large row groups give few of them:
a caller deals such rows over tasks first (`plans.catalog._dealt`).
"""

from __future__ import annotations

import datetime as _dt
import re
from html import unescape
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.functions import scalars as S

# The per-page / per-cell Python code of this module runs in Python workers.
# Ship it by value, so workers need no installed copy of this package (they
# may start anywhere on a cluster, with any working directory).
from threadmill._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    # -- queries
    def iter(self):
        """All nodes below, in document order (a stack: real pages nest thousands deep)."""
        stack = self.children[::-1]
        while stack:
            ch = stack.pop()
            if isinstance(ch, Node):
                yield ch
                stack.extend(reversed(ch.children))

    def matches(self, tag=None, cls=None, **attrs) -> bool:
        if tag and self.tag != tag:
            return False
        if cls is not None:
            have = self.attrs.get("class")
            if not have:
                return False
            # one class: membership; several: the whole class set (as bs4 does)
            if have != cls and (cls not in have.split() if " " not in cls else set(cls.split()) != set(have.split())):
                return False
        for k, v in attrs.items():
            k = k.replace("_", "-")
            if k not in self.attrs if v is True else self.attrs.get(k) != v:
                return False
        return True

    def find_all(self, tag=None, cls=None, **attrs):
        return [n for n in self.iter() if n.matches(tag, cls, **attrs)]

    def find(self, tag=None, cls=None, **attrs):
        return next((n for n in self.iter() if n.matches(tag, cls, **attrs)), None)

    def text(self) -> str:
        parts, stack = [], self.children[::-1]
        while stack:
            ch = stack.pop()
            if isinstance(ch, Node):
                stack.extend(reversed(ch.children))
            else:
                parts.append(ch)
        return "".join(parts)

    def extract(self):
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        n = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(n)
        if tag not in _VOID:
            self.cur = n

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


# Text, then a start or end tag without anything a parser could read in another way.
_PLAIN = re.compile(r'([^<]*)<(?:/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"<>&]*")*))>')
_PLAIN_ATTR = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')
# Elements whose content (some) versions of the parser take as text.
_TEXT_ONLY = {"iframe", "math", "noembed", "noframes", "noscript", "plaintext", "script", "style", "svg", "textarea", "title", "xmp"}


def _parse_plain(html: str) -> Node | None:
    """The tree that `_Builder` makes of a page of plain tags and text, None for any other page."""
    root = cur = Node("[document]", {}, None)
    at, token = 0, _PLAIN.match
    while m := token(html, at):
        at = m.end()
        text, end, tag, attrs = m.groups()
        if text:
            cur.children.append(unescape(text) if "&" in text else text)
        if end:
            n = cur
            while n is not None and n.tag != end:
                n = n.parent
            if n is not None and n.parent is not None:
                cur = n.parent
            continue
        if tag in _TEXT_ONLY:
            return None
        n = Node(tag, dict(_PLAIN_ATTR.findall(attrs)) if attrs else {}, cur)
        cur.children.append(n)
        if tag not in _VOID:
            cur = n
    rest = html[at:]
    if "<" in rest:
        return None
    if rest:
        cur.children.append(unescape(rest))
    return root


def parse(html: str | None) -> Node:
    root = _parse_plain(html) if html else None
    if root is not None:
        return root
    b = _Builder()
    if html:
        b.feed(html)
        b.close()
    return b.root


def _attr(n: Node | None, name: str):
    return None if n is None else n.attrs.get(name)


def _text(n: Node | None):
    return None if n is None else n.text()


_ARROW = {T.LongType(): "int64", T.IntegerType(): "int32", T.StringType(): "string", T.BooleanType(): "bool_"}


def _batches(fn, schema: T.StructType):
    """Wrap a per-page function (row -> list of dicts) as a mapInArrow body.
    The page's `url` is copied onto every record, so fields derived from it
    (thread id, page number) are computed afterwards without a join."""
    kinds = [(f.name, isinstance(f.dataType, T.ArrayType), _ARROW[getattr(f.dataType, "elementType", f.dataType)]) for f in schema.fields]

    def run(it):
        import pyarrow as pa

        types = [pa.list_(getattr(pa, kind)()) if nested else getattr(pa, kind)() for _, nested, kind in kinds]
        for batch in it:
            columns = [[] for _ in kinds]
            for rec in batch.to_pylist():
                for out in fn(rec):
                    out.setdefault("url", rec.get("url"))
                    for (name, _, _), column in zip(kinds, columns):
                        column.append(out.get(name))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[name for name, _, _ in kinds])

    return run


def _run(pages: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """One narrow mapInArrow job over (page_id, url, html)."""
    full = T.StructType(list(schema.fields) + [T.StructField("url", T.StringType())])
    return pages.select("page_id", "url", "html").mapInArrow(_batches(fn, full), full)


# ----------------------------------------------------------------------------- links


LINK_SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType())]
)


class _Hrefs(HTMLParser):
    """The hrefs of a page's links as their start tags come by; no tree."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            own = dict(attrs)
            if "href" in own:
                self.found.append(own["href"] or "")


def _links(rec):
    p = _Hrefs()
    if rec["html"]:
        p.feed(rec["html"])
        p.close()
    return [{"page_id": rec["page_id"], "pos": i, "href": href} for i, href in enumerate(p.found)]


def links(pages: DataFrame) -> DataFrame:
    """Harness job: every `<a href>` of every page, in document order."""
    return _run(pages.withColumn("url", F.lit(None).cast("string")) if "url" not in pages.columns else pages,
                _links, LINK_SCHEMA).drop("url")


# ----------------------------------------------------------------------------- H1


LISTING_RAW = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("href", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("author_name", T.StringType()),
        T.StructField("author_href", T.StringType()),
        T.StructField("reply_count", T.StringType()),
        T.StructField("view_count", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
    ]
)


def _listing(rec):
    root = parse(rec["html"])
    group = root.find("div", cls="structItemContainer-group js-threadList")
    if group is None:
        return []
    out = []
    # Only items inside the main list that carry an author (pinned items sit outside)
    for pos, item in enumerate(group.find_all("div", data_author=True)):
        inside = list(item.iter())

        def first(tag=None, cls=None):
            return next((n for n in inside if n.matches(tag, cls)), None)

        title_box = first(cls="structItem-title")
        a = title_box.find("a", data_tp_primary="on") if title_box else None
        replies = first("dl", "pairs pairs--justified")
        views = first("dl", "pairs pairs--justified structItem-minor")
        labels = [n.text() for n in inside if n.matches(cls="u-srOnly")]
        out.append(
            {
                "page_id": rec["page_id"], "pos": pos,
                "href": _attr(a, "href"), "title": _text(a),
                "author_name": item.attrs.get("data-author"),
                "author_href": _attr(first("a", "username"), "href"),
                "reply_count": _text(replies.find("dd")) if replies else None,
                "view_count": _text(views.find("dd")) if views else None,
                "created_at": _attr(first("time", "u-dt"), "title"),
                "labels": labels,
            }
        )
    return out


def thread_listing(pages: DataFrame, per_page: int | None = None) -> DataFrame:
    """H1: listing pages -> threads (page_no, pos, thread_id, title, author_name,
    author_id, reply_count, view_count, created_at, status). Counts stay raw
    text here (E1 runs in the threads transform), timestamps are parsed (E7)."""
    raw = _run(pages, _listing, LISTING_RAW)
    out = raw.select(
        _page_no("url").alias("page_no"), "pos",
        S.id_from_link("href").alias("thread_id"),
        S.strip("title").alias("title"),
        "author_name",
        S.id_from_link("author_href").alias("author_id"),
        S.strip("reply_count").alias("reply_count"),
        S.strip("view_count").alias("view_count"),
        S.parse_forum_ts("created_at").alias("created_at"),
        S.status_array("labels").alias("status"),
    )
    if per_page is not None:
        out = out.where(F.col("pos") < per_page)  # S3
    return out


def _page_no(url_col: str):
    n = F.regexp_extract(F.col(url_col), r"page-(\d+)", 1).try_cast("int")
    return F.coalesce(n, F.lit(1))


# ----------------------------------------------------------------------------- H2


COMMENT_RAW = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("username", T.StringType()),
        T.StructField("user_href", T.StringType()),
        T.StructField("reply", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)


def _comments(rec):
    root = parse(rec["html"])
    out = []
    arts = root.find_all("article", cls="message message--post js-post js-inlineModContainer")
    for pos, art in enumerate(arts):
        body = art.find(cls="bbWrapper")
        reply = None
        if body is not None:
            for tag in ("span", "blockquote", "a", "i"):  # first of each, once
                n = body.find(tag)
                if n is not None:
                    n.extract()
            reply = body.text()
        attrib = art.find(cls="message-attribution-main listInline")
        out.append(
            {
                "page_id": rec["page_id"], "pos": pos,
                "username": art.attrs.get("data-author"),
                "user_href": _attr(art.find("a", cls="username"), "href"),
                "reply": reply,
                "created_at": _attr(attrib.find("time") if attrib else None, "title"),
            }
        )
    return out


def thread_id_from_url(url_col: str):
    """'/t/some-title.1001/page-2' -> 1001."""
    return F.regexp_extract(F.col(url_col), r"/t/(?:[^/]*\.)?(\d+)/", 1).try_cast("int")


def thread_comments(pages: DataFrame, overlays: DataFrame | None = None) -> DataFrame:
    """H2 (+C8, E7, E12): thread pages -> comments (thread_id, page_no, pos,
    user_id, username, reply, created_at, love, brick). The first comment of
    page 1 is the opening post and is skipped.

    `overlays` (H3) holds the reaction overlays that were opened: the thread
    page's `url`, the comment's `pos` on it and the overlay's `html`. A comment
    without one has no reactions (0); of several for one comment, the largest
    counts stand.

    A page stored twice (page_id and url) gives its comments once."""
    raw = _run(pages, _comments, COMMENT_RAW).dropDuplicates(["page_id", "url", "pos"]).select(
        "*",
        thread_id_from_url("url").alias("thread_id"),
        _page_no("url").alias("page_no"),
    )
    out = raw.where(~((F.col("page_no") == 1) & (F.col("pos") == 0)))
    comments = out.select(
        "thread_id", "page_no", "pos",
        S.id_from_link("user_href").alias("user_id"),
        "username",
        S.remove_tabs_newlines("reply").alias("reply"),
        S.parse_forum_ts("created_at").alias("created_at"),
    )
    if overlays is None:
        return comments.withColumns({"love": F.lit(0), "brick": F.lit(0)})
    key = ["thread_id", "page_no", "pos"]
    counts = comment_reactions(overlays).groupBy(*key).agg(F.max("love").alias("love"), F.max("brick").alias("brick"))
    zero = F.lit(0)
    return comments.join(counts, key, "left").withColumns({"love": F.coalesce("love", zero), "brick": F.coalesce("brick", zero)}).select(
        *comments.columns, "love", "brick")


# ----------------------------------------------------------------------------- H3


REACTIONS_RAW = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("love", T.StringType()), T.StructField("brick", T.StringType())]
)


def _reactions(rec):
    root = parse(rec["html"])
    return [{"page_id": rec["page_id"], "love": _text(root.find("a", id="reaction-1")),
             "brick": _text(root.find("a", id="reaction-2"))}]


def reaction_counts(overlays: DataFrame) -> DataFrame:
    """H3: reaction overlay markup -> (page_id, love, brick), default 0."""
    raw = _run(overlays, _reactions, REACTIONS_RAW)
    return raw.select("page_id", S.digits_or_zero("love").alias("love"), S.digits_or_zero("brick").alias("brick"))


def comment_reactions(overlays: DataFrame) -> DataFrame:
    """H3 per comment: overlays (page_id, url, pos, html) -> (thread_id, page_no, pos, love, brick)."""
    schema = T.StructType([T.StructField("pos", T.IntegerType())] + [f for f in REACTIONS_RAW.fields if f.name != "page_id"])
    full = T.StructType(list(schema.fields) + [T.StructField("url", T.StringType())])
    rows = overlays.select(F.col("pos").cast("int").alias("pos"), "url", "html").mapInArrow(_batches(_overlay, full), full)
    return rows.select(
        thread_id_from_url("url").alias("thread_id"), _page_no("url").alias("page_no"), "pos",
        S.digits_or_zero("love").alias("love"), S.digits_or_zero("brick").alias("brick"))


def _overlay(rec):
    found = _reactions({"page_id": None, "html": rec["html"]})[0]
    return [{"pos": rec["pos"], "love": found["love"], "brick": found["brick"]}]


# ----------------------------------------------------------------------------- H4


CARD_RAW = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("blurb", T.StringType()),
        T.StructField("join_date", T.StringType()),
        T.StructField("last_seen", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("reaction", T.StringType()),
        T.StructField("point", T.StringType()),
    ]
)


def _cards(rec):
    root = parse(rec["html"])
    out = []
    for pos, card in enumerate(root.find_all(cls="memberTooltip")):
        user = card.find(cls="username")
        stamps = card.find_all(cls="u-dt")
        stats_box = card.find(cls="memberTooltip-stats")
        stats = [n.text() for n in stats_box.find_all("dd")] if stats_box else []
        stats += [None] * (3 - len(stats))
        out.append(
            {
                "page_id": rec["page_id"], "pos": pos,
                "user_id": _attr(user, "data-user-id"),
                "username": _text(user),
                "title": _text(card.find(cls="userTitle")),
                "blurb": _text(card.find(cls="memberTooltip-blurb")),
                "join_date": _attr(stamps[0], "title") if stamps else None,
                "last_seen": _attr(stamps[1], "title") if len(stamps) == 2 else None,
                "message": stats[0], "reaction": stats[1], "point": stats[2],
            }
        )
    return out


def member_cards(pages: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """H4 (+E8, E13, E15, E18): member cards -> users rows. A page without a
    card gives no row; `run_ts` fills a missing last_seen and created_at."""
    raw = _run(pages, _cards, CARD_RAW)
    run = S.ntz_literal(run_ts)
    return raw.select(
        "page_id", "pos", _page_no("url").alias("page_no"),
        F.col("user_id").try_cast("int").alias("user_id"),
        S.strip("username").alias("username"),
        "title",
        S.text_after_marker(S.remove_tabs_newlines("blurb")).alias("location"),
        S.parse_forum_date(F.regexp_replace("join_date", r"\s+at\s+.*$", "")).alias("join_date"),
        S.coalesce_run_time(S.parse_forum_ts("last_seen"), run_ts).alias("last_seen"),
        S.int_with_separators("message").alias("message"),
        S.int_with_separators("reaction").alias("reaction"),
        S.int_with_separators("point").alias("point"),
        run.alias("created_at"),
    )


# ----------------------------------------------------------------------------- H5


PROFILE_RAW = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("banner", T.StringType()),
        T.StructField("is_moderator", T.BooleanType()),
        T.StructField("last_seen", T.StringType()),
        T.StructField("join_date", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("reaction", T.StringType()),
        T.StructField("point", T.StringType()),
    ]
)

_BLANK_PROFILE = dict(username="", location="", title="", banner="", is_moderator=False,
                      last_seen="", join_date="", message="", reaction="", point="")


def _profile(rec):
    root = parse(rec["html"])
    if root.find(data_template="error") or root.find(data_template="login"):
        return [dict(_BLANK_PROFILE, page_id=rec["page_id"])]
    blurbs = root.find_all("div", cls="memberHeader-blurb")
    loc_a = blurbs[0].find("a", href=True) if blurbs else None
    name_box = root.find("h1", cls="memberHeader-name")
    mod = name_box.find("span", cls="username--staff username--moderator") if name_box else None
    banners = root.find(cls="memberHeader-banners")
    pairs = root.find("div", cls="pairJustifier")
    dls = pairs.find_all("dl") if pairs else []

    def dl_text(i, tag):
        if i >= len(dls):
            return ""
        n = dls[i].find(tag, href=True) if tag == "a" else dls[i].find(tag)
        return n.text().strip() if n else ""

    join_dd = blurbs[1].find("dd") if len(blurbs) > 1 else None
    return [
        {
            "page_id": rec["page_id"],
            "username": _text(root.find("span", cls="username")) or "",
            "location": loc_a.text() if loc_a else "",
            "title": _text(root.find(cls="userTitle")) or "",
            "banner": (banners.text().strip() if banners else ""),
            "is_moderator": mod is not None,
            "last_seen": _attr(root.find("time", cls="u-dt"), "title") or "",
            "join_date": _text(join_dd) or "",
            "message": dl_text(0, "a"), "reaction": dl_text(1, "dd"), "point": dl_text(2, "dd"),
        }
    ]


def member_profiles(pages: DataFrame) -> DataFrame:
    """H5 (+E19): profile pages -> text fields; error/login pages -> blanks.
    The user id comes from the page url (`/u/<id>` or `/members/<name>.<id>/`)."""
    raw = _run(pages, _profile, PROFILE_RAW)
    user_id = F.coalesce(F.regexp_extract("url", r"/u/(\d+)", 1).try_cast("int"), S.id_from_link("url"))
    return raw.select(
        "page_id", user_id.alias("user_id"), "username", "location",
        S.role_suffix("title", "banner", "is_moderator").alias("title"),
        "last_seen", "join_date", "message", "reaction", "point",
    )


# ----------------------------------------------------------------------------- H6


def online_members(pages: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """H6 (+C6, G-A5, C7): cards of every listing page; failed cards dropped;
    the last card per user (page order, then position) kept; stamped with the
    run time."""
    from threadmill.operators.dedupe import keep_last

    cards = member_cards(pages, run_ts).where(F.col("user_id").isNotNull())
    last = keep_last(cards, "user_id", ["page_no", "pos"])
    return last.drop("page_id", "pos", "page_no").withColumn("updated_at", S.ntz_literal(run_ts))

