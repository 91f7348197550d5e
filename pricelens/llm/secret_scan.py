"""Secrets: assignment, access-key and hex patterns, and a randomness test battery for other tokens.

Every run of at least MIN_TOKEN encoding characters is tested for randomness in its inferred encoding: a chi-squared test of
alphabet uniformity, a runs test and a serial-correlation test, whose p-values are combined by Fisher's method. How often
text that is no secret scores as high is measured over the whole corpus, by encoding and length: what is left of each text
without tokens and plain patterns is written in each encoding's characters and cut into stretches, which go through the same
battery. How a text is cut depends on that text alone, so files and partitions change nothing. A token's p-value is the share of
stretches of its encoding and length that score as high, and of all tokens those are reported whose p-values keep the
false-discovery rate at most MAX_FDR.

Defined results: a null text counts as empty; repeated rows and null keys give a row each; offsets are code points, ends
exclusive; a token that overlaps a plain span isn't tested; tokens of equal score are reported all or none; only the columns named
are read, whatever the others are called; an empty table gives an empty table; memory grows with
the longest text alone, as slices of rows and of symbols are bounded.
"""

from __future__ import annotations

import math
import re
import string
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stash
from .pii import overlaps, span_text

KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 20
MAX_FDR = 0.05
#: Tokens less likely than this to come from a uniform source are never reported, whatever the corpus is like.
MIN_P = 1e-3
#: Lower ends of the length strata, and the lengths of the stretches of plain text that stand for each. The battery's classes
#: change at multiples of five, and with them the scores of plain text.
STRATA = (20, 22, 25, 27, 30, 32, 35, 37, 40, 45, 50, 55, 60, 65, 80, 100, 128)
STRETCH = STRATA
ENCODINGS = ("hex", "base32", "alnum", "base64")
#: Symbols that go through the battery at once.
BATTERY_SYMBOLS = 500_000
#: Scores are log10(p) in quarters, from -8 to 0.
BINS = 33

_LETTER = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
_ASSIGN = re.compile(
    "(?:" + "|".join(_LETTER(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % MIN_TOKEN)
_NOT_ALNUM = re.compile(r"[^A-Za-z0-9]+")

_ALPHABETS = {
    "hex": string.digits + "abcdef",
    "base32": string.ascii_uppercase + "234567",
    "alnum": string.digits + string.ascii_uppercase + string.ascii_lowercase,
    "base64": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
}


def _index(alphabet: str) -> np.ndarray:
    table = np.full(256, -1, dtype=np.int16)
    table[np.frombuffer(alphabet.encode(), dtype=np.uint8)] = np.arange(len(alphabet))
    return table


_TABLES = {k: _index(a) for k, a in _ALPHABETS.items()}
_TABLES["base64"][[ord("-"), ord("_")]] = (62, 63)


def infer_encoding(token: str) -> str | None:
    """The narrowest alphabet that holds the token; None for bare numbers."""
    if token.isdigit():
        return None
    low = set(token)
    if low <= set(_ALPHABETS["hex"]) or low <= set(_ALPHABETS["hex"].upper()):
        return "hex"
    if low <= set(_ALPHABETS["base32"]):
        return "base32"
    return "alnum" if low <= set(_ALPHABETS["alnum"]) else "base64"


_erfc = np.frompyfunc(math.erfc, 1, 1)


def _upper(z: np.ndarray) -> np.ndarray:
    return (_erfc(z / math.sqrt(2)).astype(np.float64)) / 2


def battery(x: np.ndarray, size: int) -> np.ndarray:
    """p-value of each row of symbols 0..size-1 under a uniform, independent source.

    The alphabet is cut into so many equal classes that each expects five symbols or so; the chi-squared tail is
    Wilson and Hilferty's.
    """
    m, n = x.shape
    classes = int(min(size, max(2, n // 5)))
    of = np.arange(size) * classes // size
    share = np.bincount(of, minlength=classes) / size
    binned = of.astype(np.int8)[x] if classes < 128 else of[x]
    chi = np.zeros(m)
    for j in range(classes):
        seen = (binned == j).sum(axis=1)
        chi += (seen - n * share[j]) ** 2 / (n * share[j])
    df = classes - 1
    p_chi = _upper((np.cbrt(chi / df) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))

    high = x >= size / 2
    n1 = high.sum(axis=1)
    n2 = n - n1
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 2 * n1 * n2 / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    z_runs = np.where((n1 == 0) | (n2 == 0), 9.0, np.abs(runs - mean) / np.sqrt(var))
    p_runs = 2 * _upper(np.minimum(z_runs, 9.0))

    c = (x - x.mean(axis=1, keepdims=True)).astype(np.float32)
    power = (c * c).sum(axis=1)
    r = np.where(power > 0, (c[:, 1:] * c[:, :-1]).sum(axis=1) / np.maximum(power, 1e-9), 1.0)
    p_serial = 2 * _upper(np.minimum(np.abs(r + 1 / n) * math.sqrt(n), 9.0))

    half = -(np.log(np.clip(p_chi, 1e-30, 1)) + np.log(np.clip(p_runs, 1e-30, 1)) + np.log(np.clip(p_serial, 1e-30, 1)))
    return np.exp(-half) * (1 + half + half * half / 2)


def _bin(p: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((8 + np.log10(np.clip(p, 1e-9, 1))) * 4), 0, BINS - 1).astype(np.int64)


def _stratum(length: int) -> int:
    return max(i for i, low in enumerate(STRATA) if length >= low)


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the plain patterns."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def tokens(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Tested tokens that overlap no plain span: start, end, stratum (encoding and length) and score bin."""
    out, taken = [], overlaps([(a, b) for _, a, b in base])
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if (enc := infer_encoding(m[0])) is None or taken(a, b):
            continue
        raw = m[0].lower() if enc == "hex" else m[0]
        x = _TABLES[enc][np.frombuffer(raw.encode("ascii"), dtype=np.uint8)][None, :]
        score = int(_bin(battery(x, len(_ALPHABETS[enc])))[0])
        out.append({"start": a, "end": b, "stratum": ENCODINGS.index(enc) * len(STRATA) + _stratum(b - a), "bin": score})
    return out


def _rest(text: str, base: list[tuple[str, int, int]]) -> str:
    """The text without plain spans and runs of MIN_TOKEN encoding characters, which may be secrets."""
    out, pos = [], 0
    for a, b in sorted([(a, b) for _, a, b in base] + [m.span() for m in _TOKEN.finditer(text)]):
        if a > pos:
            out.append(text[pos:a])
        pos = max(pos, b)
    return " ".join([*out, text[pos:]])


def _as_encoded(texts: list[str], shifts: list[int]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The words of each text, run together as an encoded token would show them: all symbols and each text's number of them, by
    encoding.

    In base64 they keep signs between them: for 30 words a hyphen (or plus), for 30 a slash (or underscore), for 30 both in turn.
    After 90 words as they stand, the next 90 begin with capitals. Both counts begin at the text's shift.
    """
    parts = [_NOT_ALNUM.sub("-", t).strip("-") for t in texts]
    words = np.frombuffer("".join(parts).encode("ascii"), dtype=np.uint8).copy()
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    of = np.repeat(np.arange(len(parts)), sizes)
    sign = words == ord("-")
    before = np.cumsum(sign) - sign
    starts = np.cumsum(sizes) - sizes
    begins = np.append(before, 0)[np.minimum(starts, len(before))]
    nth = before - begins[of] + np.array(shifts, dtype=np.int64)[of]
    first = np.append([True], sign[:-1] | (of[1:] != of[:-1]))[: len(words)] & ~sign & (nth // 90 % 2 == 1)
    words[first & (words >= ord("a"))] -= 32
    lower = np.where((words >= ord("A")) & (words <= ord("Z")), words + 32, words)
    upper = np.where(words >= ord("a"), words - 32, words)
    signed = _TABLES["base64"][words]
    kind = nth[sign] // 30 % 3
    signed[sign] = np.where(kind == 2, 62 + nth[sign] % 2, 62 + kind)
    written = {"hex": _TABLES["hex"][lower], "base32": _TABLES["base32"][upper], "alnum": _TABLES["alnum"][words], "base64": signed}
    return {k: (x[x >= 0], np.bincount(of[x >= 0], minlength=len(parts))) for k, x in written.items()}


def stretches(size: int, shift: int) -> list[tuple[int, int]]:
    """(stratum, start) of the stretches that so many symbols are cut into: the lengths in turn, beginning at the shift; of what is
    left at the end the longest that fits, again and again."""
    out, at, i = [], 0, shift % len(STRETCH)
    while at + STRETCH[i] <= size:
        out.append((i, at))
        at, i = at + STRETCH[i], (i + 1) % len(STRETCH)
    while size - at >= STRETCH[0]:
        i = _stratum(size - at)
        out.append((i, at))
        at += STRETCH[i]
    return out


def plain_text_scores(texts: list[str]) -> np.ndarray:
    """Counts by encoding, length stratum and score bin of the stretches that each text is cut into, flat."""
    counts = np.zeros((len(ENCODINGS), len(STRATA), BINS), dtype=np.int64)
    shifts = [zlib.crc32(t.encode("utf-8", "replace")) % (180 * len(STRETCH)) for t in texts]
    encoded = _as_encoded(texts, shifts)
    for e, encoding in enumerate(ENCODINGS):
        x, sizes = encoded[encoding]
        starts: list[list[int]] = [[] for _ in STRETCH]
        base = 0
        for size, shift in zip(sizes.tolist(), shifts, strict=True):
            for i, at in stretches(size, shift):
                starts[i].append(base + at)
            base += size
        for i, n in enumerate(STRETCH):
            at_once = max(1, BATTERY_SYMBOLS // n)
            for k in range(0, len(starts[i]), at_once):
                rows = x[np.array(starts[i][k : k + at_once])[:, None] + np.arange(n)]
                counts[e, i] += np.bincount(_bin(battery(rows, len(_ALPHABETS[encoding]))), minlength=BINS)
    return counts.ravel()


SPAN = "array<struct<kind:string,start:int,end:int>>"
TOKEN = "array<struct<start:int,end:int,stratum:int,bin:int>>"


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, base, tokens, and (on one row of each slice) the slice's plain-text histogram."""
    keep = ["doc_id"] if keep is None else keep

    def make():
        def fn(cols):
            texts = [t or "" for t in cols[0]]
            spans = [plain_spans(t) for t in texts]
            hist = plain_text_scores([_rest(t, s) for t, s in zip(texts, spans, strict=True)]).tolist()
            return {
                "base": [[dict(zip(("kind", "start", "end"), x, strict=True)) for x in s] for s in spans],
                "tokens": [tokens(t, s) for t, s in zip(texts, spans, strict=True)],
                "hist": [hist if i == 0 else None for i in range(len(texts))],
            }

        return fn

    return map_rows(docs.select(*keep, F.col(text).alias("_text")), make, f"base {SPAN}, tokens {TOKEN}, hist array<bigint>", keep)


def thresholds(scanned: DataFrame) -> list[int]:
    """The least score bin that is reported, by stratum; BINS where none is.

    Two histograms of a fixed number of cells come to the driver, whatever the corpus.
    """
    groups = len(ENCODINGS) * len(STRATA)
    seen = np.zeros((groups, BINS))
    for r in scanned.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.bin").count().collect():
        seen[r["stratum"], r["bin"]] = r["count"]
    plain = np.zeros(groups * BINS)
    for r in scanned.filter("hist is not null").select(F.posexplode("hist")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        plain[r["pos"]] = r["n"]
    plain = plain.reshape(len(ENCODINGS), len(STRATA), BINS)
    tail = plain[..., ::-1].cumsum(axis=-1)[..., ::-1]
    p = ((1 + tail) / (1 + plain.sum(axis=-1, keepdims=True))).reshape(groups, BINS)
    p[:, : int(_bin(np.array([MIN_P]))[0])] = 1.0
    # Benjamini and Hochberg over all tokens: the largest p-value at which few enough of the tokens found are expected by chance.
    levels, at = np.unique(p, return_inverse=True)
    here = np.bincount(at.ravel(), weights=seen.ravel())
    fits = np.flatnonzero((here > 0) & (levels < 1) & (seen.sum() * levels <= MAX_FDR * here.cumsum()))
    most = levels[fits[-1]] if len(fits) else -1.0
    return [int(np.argmax(row <= most)) if (row <= most).any() else BINS for row in p]


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, base and extra spans. Texts are read once; a table of spans and scores is written between."""
    keep = ["doc_id"] if keep is None else keep
    names = [f"_k{i}" for i in range(len(keep))]
    held = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names, strict=True)], F.col(text).alias("_text"))
    scanned = stash(scan(held, "_text", names), "secrets")
    least = F.lit(thresholds(scanned))
    reported = F.filter("tokens", lambda t: t["bin"] >= F.get(least, t["stratum"]))
    extra = F.transform(reported, lambda t: F.struct(F.lit("random").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return scanned.select(*[F.col(n).alias(k) for k, n in zip(keep, names, strict=True)], "base", extra.alias("extra"))


def digests(found: DataFrame) -> DataFrame:
    """Contract columns of find()'s result."""
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[n(k) for k in KINDS[:3]],
        F.sha2(span_text(F.col("base"), KINDS, False).cast("binary"), 256).alias("base_sha256"),
        span_text(F.concat("base", "extra"), KINDS, False).alias("spans"),
    )
