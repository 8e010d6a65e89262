"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
URL schemes and identifier cues ("password", "IBAN", ...). From each anchor a
deterministic local parser expands to the left and right and validates what it
found; nothing else of the text is looked at. The base kinds equal a
leftmost, non-overlapping search for their patterns (given as fixed values
below); the method adds URLs and accounts.

Offsets are code points, ends exclusive; kinds may overlap each other.

Defined results: NULL text is empty and has no spans; a repeated row gives the
same spans again; an empty table gives no rows; columns to carry along are
named, others are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.byte_bpe import _sliced
from threadmill.llm.common import table, worker_state

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = BASE_KINDS + ["url", "account"]

# What the base kinds are.
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
#   card   [0-9]([\x20-]?[0-9])+, 14 to 19 digits that pass Luhn
#   phone  \+[0-9][\x20().0-9-]+[0-9], 10 to 15 digits
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
MAX_PART, CARD_DIGITS, PHONE_DIGITS = 255, (14, 19), (10, 15)

# Schemes and cues, in any mixture of cases.
SCHEMES = ["http://", "https://", "ftp://"]
CUES = ["account", "acct", "iban", "password", "passwd", "passport", "user id", "userid", "customer id", "api key", "api_key", "secret"]
KEY_PREFIX = "AKIA"

SPAN = "array<struct<kind:string,start:int,end:int>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    compact = value.replace(" ", "").upper()
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def lowered(text: str) -> str:
    """`text` in lower case, every character at its own place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


class Finder:
    """The automaton and the local parsers."""

    def __init__(self):
        import ahocorasick

        self.anchors = ahocorasick.Automaton()
        for d in "0123456789":
            self.anchors.add_word(d, ("digit", 1))
        self.anchors.add_word("@", ("at", 1))
        self.anchors.add_word("+", ("plus", 1))
        for s in SCHEMES:
            self.anchors.add_word(s, ("scheme", len(s)))
        for c in CUES:
            self.anchors.add_word(c, ("cue", len(c)))
        self.anchors.add_word(KEY_PREFIX.lower(), ("key", len(KEY_PREFIX)))
        self.anchors.make_automaton()
        self.domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
        self.dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*")
        self.spaced = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
        self.dialled = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
        self.address = re.compile(r"[^\s<>\"'`{}|\\^\[\]]+")
        self.value = re.compile(r"(?:\x20(?i:is|no|nr|number|id))?[\x20:=#.]{1,4}([A-Za-z0-9][A-Za-z0-9._/+-]{3,})")
        self.bank = re.compile(r"[\x20:=#.]{1,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
        self.key = re.compile(r"[0-9A-Z]{16}(?![0-9A-Za-z])")

    def _email(self, text: str, at: int, done: int) -> tuple[int, int] | None:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        tail = self.domain.match(text, at + 1) if start < at else None
        return (start, tail.end()) if tail else None

    def _ips(self, text: str, start: int, end: int):
        """Of a chain of dotted numbers, four at a time from the left."""
        numbers = [m.span() for m in re.finditer("[0-9]+", text[start:end])]
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            if all(int(text[start + a : start + b].lstrip("0")[:4] or 0) <= MAX_PART for a, b in four):
                yield start + four[0][0], start + four[3][1]

    def _account(self, text: str, cue: int, end: int) -> tuple[int, int] | None:
        if cue and text[cue - 1].isalnum():
            return None
        bank = self.bank.match(text, end)
        if bank and iban(bank.group(1)):
            return bank.span(1)
        found = self.value.match(text, end)
        if found:
            value = found.group(1).rstrip("._/+-")
            if len(value) >= 4 and any(c.isdigit() for c in value):
                return found.start(1), found.start(1) + len(value)
        return None

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        out = []
        email_done = dotted_done = spaced_done = url_done = account_done = 0
        for last, (kind, size) in self.anchors.iter(lowered(text)):
            at = last - size + 1
            if kind == "digit":
                if at >= spaced_done:
                    spaced_done = self.spaced.match(text, at).end()
                    digits = re.sub("[^0-9]", "", text[at:spaced_done]) if spaced_done - at >= CARD_DIGITS[0] else ""
                    if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                        out.append(("card", at, spaced_done))
                if at >= dotted_done:
                    dotted_done = self.dotted.match(text, at).end()
                    if dotted_done - at >= 7:
                        out += [("ip", a, b) for a, b in self._ips(text, at, dotted_done)]
            elif kind == "at":
                found = self._email(text, at, email_done)
                if found:
                    email_done = found[1]
                    out.append(("email", *found))
            elif kind == "plus":
                found = self.dialled.match(text, at)
                if found and PHONE_DIGITS[0] <= sum(c.isdigit() for c in found.group()) <= PHONE_DIGITS[1]:
                    out.append(("phone", at, found.end()))
            elif kind == "scheme":
                found = self.address.match(text, last + 1) if at >= url_done else None
                end = last + 1 + len(found.group().rstrip(".,;:!?)")) if found else 0
                if end > last + 1:
                    url_done = end
                    out.append(("url", at, end))
            elif kind == "key":
                whole = text.startswith(KEY_PREFIX, at) and not (at and text[at - 1].isalnum())
                found = self.key.match(text, last + 1) if whole and at >= account_done else None
                if found:
                    account_done = found.end()
                    out.append(("account", at, account_done))
            elif at >= account_done:
                found = self._account(text, at, last + 1)
                if found:
                    account_done = found[1]
                    out.append(("account", *found))
        return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def finder() -> Finder:
    kept = worker_state("pii")
    if "pii" not in kept:
        kept["pii"] = Finder()
    return kept["pii"]


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """`text` with every run of overlapping spans replaced by the kind that starts it."""
    out, at, done = [], 0, 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[at:start], f"[{kind.upper()}]"]
        done = max(done, end)
        at = done
    return "".join(out) + text[at:]


def find(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `carry` columns and `spans`, ordered by start, then kind."""
    kept = docs.select(*carry, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        f = finder()
        for b in _sliced(batches):
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in f.spans(t)] if t else [] for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(b.num_columns - 1)] + [pa.array(found, kind)], names=b.schema.names[:-1] + ["spans"])

    return kept.mapInArrow(run, f"{schema}, spans {SPAN}")


def redact(docs: DataFrame, text: str = "text", kinds: tuple[str, ...] = tuple(BASE_KINDS) + ("account",)) -> DataFrame:
    """`docs` with the spans of `kinds` in `text` replaced by their kind in brackets."""

    def run(batches):
        import pyarrow as pa

        f = finder()
        for b in _sliced(batches):
            at = b.schema.names.index(text)
            texts = []
            for t in b.column(at).to_pylist():
                spans = [s for s in f.spans(t) if s[0] in kinds] if t else []
                texts.append(redacted(t, spans) if spans else t)
            cols = b.columns
            cols[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _is(kind: str):
    return lambda s: s["kind"] == kind


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4(spark, sf_dir) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    number = [F.size(F.filter("spans", _is(k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *number, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
