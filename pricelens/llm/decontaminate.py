"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised (lower case; punctuation and white space become one space). An item of n characters may
be found with k = EDITS_PER_CHAR n edits; it is cut into k + 1 pieces, of which one at least must then occur unchanged. An
automaton finds all pieces of all items in one pass over a text, and Myers' bit-parallel algorithm verifies the stretch of
text around each hit. Items of a benchmark often share sentences: an item with h pieces that many others have is cut into k + 1 + h
and found by the rest (looked_for()). An item must begin and end with its words: the white space around it is a part of the match, unless its
own edge is a letter of a script that is written without spaces.

Defined results: null or empty items and texts match nothing; an item that occurs in several rows of the benchmark under one
id counts as all its texts, and the closest match is reported, of equally close ones the first; every row of the documents has
its own hits, so repeated rows and null ids give rows each; offsets are code points of the source text, ends exclusive; ids of items
are of any type; texts of any length are read whole; working columns clash with no others; an empty table on either side gives an
empty table.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stash

EDITS_PER_CHAR = 0.05
#: Pieces are at least so long; a short item has fewer edits for it.
MIN_PIECE = 16
#: A piece in more items than this isn't looked for where rarer ones of at least SHORT_PIECE characters will do.
HOT, SHORT_PIECE = 16, 8
#: Benchmark text that one automaton holds. A larger benchmark is searched in blocks of about this size.
BLOCK_BYTES = 8_000_000

#: From this code point on, scripts are taken to be written without spaces between words.
UNSPACED = 0x2E80

# ASCII upper case to lower case, and everything that is neither letter nor digit to a space.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32) for c in range(256))
# Signs of other blocks that count as spaces (Latin-1 signs, general and CJK punctuation, full-width signs).
_SIGNS = re.compile("[\u0080-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u00d7\u00f7\u2000-\u206f\u2e00-\u2e7f\u3000-\u303f\uff01-\uff0f]")


def normalise(text: str | None) -> str:
    low = (text or "").lower()
    low = low if low.isascii() else _SIGNS.sub(" ", low)
    return b" ".join(low.encode("utf-8", "replace").translate(_FOLD).split()).decode("utf-8")


def budget(length: int, per_char: float = EDITS_PER_CHAR, min_piece: int = MIN_PIECE) -> int:
    """Edits allowed in an item of so many characters."""
    return max(0, min(int(length * per_char), length // min_piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length and where they start."""
    cuts = [round(i * len(item) / (k + 1)) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to a stretch of the text, and where the first such stretch ends."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    get = masks.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def with_edges(item: str) -> tuple[str, int]:
    """The normalised item with the spaces that must surround it, and whether there is one in front."""
    lead, tail = int(ord(item[0]) < UNSPACED), int(ord(item[-1]) < UNSPACED)
    return " " * lead + item + " " * tail, lead


def source_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the normalised text as spans of the text itself."""
    at: list[int] = []
    last = " "
    for i, c in enumerate(text):
        for x in c.lower():
            x = " " if "\ud800" <= x <= "\udfff" or (ord(x) < 128 and not x.isalnum()) or _SIGNS.match(x) else x
            if x != " " or last != " ":
                at.append(i)
            last = x
    return [(at[a], at[b - 1] + 1) for a, b in spans]


def containing(texts: list[str], wanted: set[str]) -> dict[str, int]:
    """In how many of the texts each of these strings occurs."""
    import ahocorasick

    automaton, counts = ahocorasick.Automaton(), dict.fromkeys(wanted, 0)
    for p in wanted:
        automaton.add_word(p, p)
    automaton.make_automaton()
    for t in texts:
        for p in {p for _, p in automaton.iter(t)}:
            counts[p] += 1
    return counts


def looked_for(items: list[tuple[str, int]]) -> list[list[tuple[int, str]]]:
    """For each item text and its budget k, the pieces to look for and where they start.

    These are all k + 1 pieces, unless some are in more than HOT items, as in a benchmark of one template. Then the item is cut into
    k + 1 + h pieces of which h at most are so frequent: k edits leave one at least of the others unchanged, so these are enough,
    and a text that holds the template alone meets no item. Where shorter pieces don't help, as for items that are nearly equal, the
    k + 1 pieces stay.
    """
    texts = [t for t, _ in items]
    out = [pieces(t, k) for t, k in items]
    cuts = dict(enumerate(out))
    while cuts:
        counts = containing(texts, {p for c in cuts.values() for _, p in c})
        again = {}
        for at, cut in cuts.items():
            text, k = items[at]
            rare = [x for x in cut if counts[x[1]] <= HOT]
            hot = len(cut) - len(rare)
            if len(cut) - k > hot:
                out[at] = rare
            elif len(text) // (k + 1 + hot) >= SHORT_PIECE:
                again[at] = pieces(text, k + hot)
        cuts = again
    return out


def prepared(items: list[tuple[object, str]], per_char: float, min_piece: int) -> list[tuple]:
    """The different normalised items: their ids, text with edges, space in front, budget and pieces to look for (by driver, once)."""
    ids: dict[str, list[object]] = defaultdict(list)
    for i, t in items:
        if n := normalise(t):
            ids[n].append(i)
    plain = [(n, budget(len(n), per_char, min_piece)) for n in ids]
    return [(ids[n], *with_edges(n), k, found) for (n, k), found in zip(plain, looked_for(plain), strict=True)]


class Matcher:
    """The automaton of a block of items, as prepared()."""

    def __init__(self, items: list[tuple]):
        import ahocorasick

        self.items = [x[:4] for x in items]
        held: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for at, (_, _, lead, _, found) in enumerate(items):
            for start, piece in found:
                held[piece].append((at, start + lead))
        self.automaton = ahocorasick.Automaton()
        for piece, where in held.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[dict]:
        """The closest match of each item id in the text, within its budget."""
        n = f" {normalise(text)} "
        if not self.items or n == "  ":
            return []
        best: dict[object, tuple[int, int, int]] = {}
        exact: set[int] = set()
        tried: set[tuple[int, int]] = set()
        for last, (length, where) in self.automaton.iter(n):
            for at, offset in where:
                ids, item, lead, k = self.items[at]
                start = last - length + 1 - offset
                if at in exact or (at, start) in tried:
                    continue
                tried.add((at, start))
                if start >= 0 and n.startswith(item, start):  # the first one: hits come in order
                    exact.add(at)
                    a, b, d = start, start + len(item), 0
                elif k == 0:
                    continue
                else:
                    low, high = max(0, start - k), start + len(item) + k
                    d, end = myers(item, n[low:high])
                    if d > k:
                        continue
                    _, length_back = myers(item[::-1], n[low : low + end][::-1])
                    a, b = low + end - length_back, low + end
                a, b = a + (n[a] == " "), b - (n[b - 1] == " ")
                got = (d, a - 1, b - 1)
                for item_id in ids:
                    if item_id not in best or got < best[item_id]:
                        best[item_id] = got
        if not best:
            return []
        spans = source_spans(text, [(a, b) for _, a, b in best.values()])
        return [{"item_id": i, "edits": best[i][0], "start": a, "end": b} for i, (a, b) in zip(best, spans, strict=True)]


def blocks(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark's different items (i, t) in tables of about so many bytes."""
    items = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t")).filter("t is not null").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    return [items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) for b in range(n)]


def find(docs: DataFrame, block: DataFrame, text: str = "text", keep: list[str] | None = None, per_char: float = EDITS_PER_CHAR, min_piece: int = MIN_PIECE) -> DataFrame:
    """The columns ``keep`` and hits (item_id, edits, start, end) of every document in one block of items.

    The block, whose size is bounded, goes to all tasks; documents are never shuffled.
    """
    keep = ["doc_id"] if keep is None else keep
    items = docs.sparkSession.sparkContext.broadcast(prepared([(r["i"], r["t"]) for r in block.collect()], per_char, min_piece))

    def make():
        matcher = Matcher(items.value)
        return lambda cols: {"hits": [matcher.find(t) for t in cols[0]]}

    hits = f"hits array<struct<item_id:{block.schema['i'].dataType.simpleString()},edits:int,start:int,end:int>>"
    return map_rows(docs.select(*keep, F.col(text).alias("_text")), make, hits, keep)


def contaminations(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """A row for each row of the documents and benchmark item that it holds: doc_id, item_id, edits, start, end.

    Each block of the benchmark reads the documents once; if there are several, rows are numbered first, so that the closest match
    of an item with texts in several blocks is found by row.
    """
    parts = blocks(benchmark, block_bytes=block_bytes)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.drop("row") if len(parts) == 1 else stash(rows, "rows")
    keep = rows.drop("text").columns
    found = [find(rows, part, keep=keep, **options).select(*keep, F.explode("hits").alias("h")).select(*keep, "h.*") for part in parts]
    if len(parts) == 1:
        return found[0]
    best = reduce(DataFrame.union, found).groupBy("row", "doc_id", "item_id").agg(F.min(F.struct("edits", "start", "end")).alias("m"))
    return best.select("doc_id", "item_id", "m.*")


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, **options) -> DataFrame:
    """The documents without a benchmark item, with the columns they came with. Between blocks what is left is written."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    held = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)])
    for i, block in enumerate(blocks(benchmark, block_bytes=block_bytes)):
        held = stash(held, "clean") if i else held
        held = find(held, block, text=names[docs.columns.index(text)], keep=names, **options).filter(F.size("hits") == 0).select(*names)
    return held.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
