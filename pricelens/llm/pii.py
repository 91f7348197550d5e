"""Personal data: plain patterns, and disguised forms found by a transducer that keeps source offsets.

Defined results: a null text counts as empty and has no spans; rows are handled one by one, so repeated rows and null keys
give a row each; offsets are code points, ends exclusive; texts of any length are read whole, in time that grows with their length;
kinds may overlap, and of disguised spans of one kind those that overlap a plain one give way; only the columns named are read,
whatever the others are called; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Inside a run of digits no match can begin that did not begin at its start, so the look-behind changes nothing but time.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """As the pattern local@domain finds them, from one @ to the next, so that a long run is read once."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _octet(x: str) -> bool:
    x = x.lstrip("0")
    return len(x) <= 3 and int(x or "0") <= 255


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the plain patterns, by kind, then start."""
    out = [("email", *s) for s in _emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


# Letters of other scripts that look like ASCII ones, as pairs.
_ALIKE = dict(
    zip(
        "АВЕКМНОРСТХаеорсухіѕјԁһΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορ",
        "ABEKMHOPCTXaeopcyxisjdhABEZHIKMNOPTYXavop",
        strict=True,
    )
)
# Characters that other blocks of digits start with, and single signs that stand for ASCII ones.
_ZEROS = (0x0660, 0x06F0, 0x0966, 0xFF10, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
_SIGNS = {"\u2024": ".", "\u3002": ".", "\u00b7": ".", "\u00a0": " ", "\u2009": " ", "\u202f": " "} | {chr(c): "-" for c in (0x2010, 0x2011, 0x2012, 0x2013, 0x2212)}
_UNSEEN = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
_MAP = _ALIKE | {chr(z + i): str(i) for z in _ZEROS for i in range(10)} | {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | _SIGNS
_ODD = re.compile("[" + re.escape("".join(_MAP)) + _UNSEEN + "]")
_TABLE = {ord(a): b for a, b in _MAP.items()} | {ord(c): None for c in _UNSEEN}
_UNSEEN_CODES = np.array([ord(c) for c in _UNSEEN], dtype=np.uint32)

# The spelled digits.
_SPELLED = dict(zip(("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"), "0123456789", strict=True))
_WORD = "(?:" + "|".join(_SPELLED) + ")"
_GAP = r"[\s,-]+"
_RUN = rf"\b{_WORD}(?:{_GAP}(?:{_WORD}|[0-9]+))+\b"
# Endings that let unbracketed words stand for an address.
_ENDING = "(?:com|org|net|edu|gov|io|co|info|biz|de|fr|es|it|nl|uk|us|eu|ch|at)"
# White space before a bracket is taken from its start only, so that a long run is read once.
_OPEN, _CLOSE = r"(?:(?<!\s)\s++)?[(\[{<]\s*+", r"\s*+[)\]}>]\s*+"
_RULES = re.compile(
    rf"(?P<at>{_OPEN}at{_CLOSE}|(?<=[A-Za-z0-9])\s++at\s++(?=(?:[A-Za-z0-9-]++\s++dot\s++)+{_ENDING}\b|[A-Za-z0-9-]+{_OPEN}dot{_CLOSE}))"
    rf"|(?P<dot>{_OPEN}dot{_CLOSE}|(?<=[A-Za-z0-9])\s++dot\s++(?=[A-Za-z0-9]))"
    rf"|(?P<plus>\bplus\s++(?={_WORD}\b|[0-9]))"
    rf"|(?P<run>{_RUN})",
    re.I | re.A,
)
_TOKEN = re.compile(rf"{_WORD}|[0-9]", re.I | re.A)
_DISGUISED = re.compile(rf"[(\[{{<]\s*(?:at|dot)\s*[)\]}}>]|\sdot\s|\bplus\s+(?={_WORD}\b|[0-9])|\b{_WORD}{_GAP}(?:{_WORD}|[0-9])", re.I | re.A)


def transduce(text: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The normalised text, and for each of its characters where in the source it starts and ends."""
    # The first transducer works by single characters; it drops unseen ones, so it has its own offsets.
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    at = np.flatnonzero(~np.isin(codes, _UNSEEN_CODES)).astype(np.int32)
    plain = text.translate(_TABLE)
    out: list[str] = []
    starts: list[np.ndarray] = []
    ends: list[np.ndarray] = []

    def copy(a: int, b: int) -> None:
        if b > a:
            out.append(plain[a:b])
            starts.append(at[a:b])
            ends.append(at[a:b] + 1)

    def put(c: str, a: int, b: int) -> None:
        out.append(c)
        starts.append(at[a : a + 1])
        ends.append(at[b - 1 : b] + 1)

    pos = 0
    for m in _RULES.finditer(plain):
        copy(pos, m.start())
        if m.lastgroup == "run":
            for t in _TOKEN.finditer(plain, *m.span()):
                put(_SPELLED.get(t[0].lower(), t[0]), *t.span())
        else:
            put({"at": "@", "dot": ".", "plus": "+"}[m.lastgroup], *m.span())
        pos = m.end()
    copy(pos, len(plain))
    none = np.zeros(0, np.int32)
    return "".join(out), np.concatenate([none, *starts]), np.concatenate([none, *ends])


def overlaps(spans: list[tuple[int, int]]):
    """A function that tells whether a stretch overlaps one of the spans."""
    spans = sorted(spans)
    firsts, reach = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))

    def one(a: int, b: int) -> bool:
        i = bisect_left(firsts, b)
        return i > 0 and reach[i - 1] > a

    return one


def disguised_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans that only the normalised text shows and that overlap no plain span of their kind."""
    if _ODD.search(text) is None and _DISGUISED.search(text) is None:
        return []
    normal, starts, ends = transduce(text)
    taken = {k: overlaps([(a, b) for kind, a, b in base if kind == k]) for k in KINDS}
    found = [(kind, int(starts[a]), int(ends[b - 1])) for kind, a, b in plain_spans(normal)]
    return [(kind, a, b) for kind, a, b in found if not taken[kind](a, b)]


SPAN = "array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, base (plain spans) and extra (disguised ones), each by kind, then start."""
    keep = ["doc_id"] if keep is None else keep

    def make():
        def fn(cols):
            base, extra = [], []
            for t in cols[0]:
                spans = plain_spans(t or "")
                base.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in spans])
                extra.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in disguised_spans(t or "", spans)])
            return {"base": base, "extra": extra}

        return fn

    return map_rows(docs.select(*keep, F.col(text).alias("_text")), make, f"base {SPAN}, extra {SPAN}", keep)


def span_text(spans: Column, kinds: tuple[str, ...], by_kind: bool) -> Column:
    """Spans as kind:start:end, comma-joined, by (kind as listed, start) or by (start, kind as listed)."""
    order = lambda x: F.array_position(F.lit(list(kinds)), x["kind"]).cast("int")
    keyed = F.transform(
        spans,
        lambda x: F.struct(order(x).alias("a"), x["start"].alias("b"), x["end"].alias("c"), x["kind"].alias("k"))
        if by_kind
        else F.struct(x["start"].alias("b"), order(x).alias("a"), x["end"].alias("c"), x["kind"].alias("k")),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["k"], x["b"].cast("string"), x["c"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Contract columns of find()'s result."""
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[n(k) for k in KINDS],
        F.sha2(span_text(F.col("base"), KINDS, True).cast("binary"), 256).alias("base_sha256"),
        span_text(F.concat("base", "extra"), KINDS, True).alias("spans"),
    )


def mask(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """docs with every span replaced by its kind in brackets and the length column renewed; null texts stay null.

    Overlapping spans become one, named after the first.
    """

    def hide(t: str | None) -> str | None:
        if not t:
            return t
        base = plain_spans(t)
        spans = sorted((a, b, k) for k, a, b in base + disguised_spans(t, base))
        if not spans:
            return t
        out, pos = [], 0
        for a, b, k in spans:
            if a >= pos:
                out += [t[pos:a], f"[{k.upper()}]"]
            pos = max(pos, b)
        return "".join(out) + t[pos:]

    def make():
        return lambda cols: {"_masked": [hide(t) for t in cols[0]]}

    rest = [c for c in docs.columns]
    held = map_rows(docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(rest)], F.col(text).alias("_text")), make, "_masked string", [f"_c{i}" for i in range(len(rest))])
    new = {text: F.col("_masked")} | ({length: F.coalesce(F.length("_masked").cast("long"), F.lit(0))} if length in rest else {})
    return held.select(*[new.get(c, F.col(f"_c{i}")).alias(c) for i, c in enumerate(rest)])
