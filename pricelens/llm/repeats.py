"""Passages of at least MIN_WORDS words that documents share, by sparse suffix arrays.

Only suffixes at minimiser positions are kept: of every WINDOW neighbouring word n-grams, the one with the least hash, which
depends on the text alone, so a shared passage of MIN_WORDS words keeps a suffix at the same place in every document, with HEAD
words of the passage to its right. Suffixes whose head occurs once are dropped; the rest are sorted by the words that follow, in range
partitions of about PART_ROWS rows that cut through heads of any size. Suffixes that share r words to the right are neighbours in
this order. Of those that several documents have with all compared words, which match wholly, two stand for the rest from here
on. For each r at which a neighbourhood grows, its suffixes are sorted by the words to the left and compared with their nearest
neighbours from other documents, as none that shares r words shares more to the left: matches are extended to the left, and those of
MIN_WORDS words or more are merged by document. What neighbours on both sides of a partition's border need of each other is read from
the rows at the borders. Longer passages are covered by the overlapping matches of their suffixes. Words are compared by 31 bits of
their hashes, at least MIN_WORDS of them in a row.

Defined results: words are lower-cased and divided by white space; null, empty and shorter texts share nothing; rows with a null id
are left out; rows that repeat an id are one document, whose repeats of itself do not count; an empty table gives an empty table;
texts of any length are read whole; of ties, every place is reported; only the two columns named are read, whatever the others are
called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_rows, ship, stash
from .shingles import ngram_hashes, word_hashes, words_of

MIN_WORDS = 50
GRAM = 8
WINDOW = 24
HEAD = MIN_WORDS - WINDOW
LEFT = WINDOW
#: Rows of a range partition, about; a task holds one partition. Larger inputs have more partitions.
PART_ROWS = 200_000

_U = np.uint64


def anchors(h: np.ndarray, min_words: int = MIN_WORDS, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and head hashes of the suffixes that are kept of a text with these word hashes."""
    none = np.zeros(0, dtype=np.int64)
    if len(h) < min_words:
        return none, none
    grams = ngram_hashes(h, gram)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    at = np.concatenate([views[i : i + 65536].argmin(axis=1) + np.arange(i, min(i + 65536, len(views))) for i in range(0, len(views), 65536)])
    at = np.unique(at)
    head = min_words - window
    at = at[at + head <= len(h)]
    return at.astype(np.int64), ngram_hashes(h, head)[at].view(np.int64)


def _anchor_rows(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    def make():
        def fn(cols):
            got = [anchors(word_hashes(words_of(t))) for t in cols[0]]
            return {"at": [a.tolist() for a, _ in got], "head": [k.tolist() for _, k in got]}

        return fn

    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("_text"))
    found = map_rows(rows, make, "at array<int>, head array<bigint>", ["id"])
    return found.select("id", F.explode(F.arrays_zip("at", "head")).alias("x")).select("id", F.col("x.at").alias("at"), F.col("x.head").alias("head"))


def _suffixes(docs: DataFrame, marks: DataFrame, text: str, id_col: str) -> DataFrame:
    """head, right and left words (32-bit hashes; zero beyond the text; left ones from near to far) of every marked position."""

    def make():
        def fn(cols):
            heads, rights, lefts = [], [], []
            for t, at in zip(cols[0], cols[1], strict=True):
                h = word_hashes(words_of(t))
                at = np.asarray(at, dtype=np.int64)
                at = at[at + HEAD <= len(h)]  # an id may stand for several texts
                short = np.concatenate([np.zeros(LEFT, np.uint32), (h >> _U(32)).astype(np.uint32) | np.uint32(1), np.zeros(MIN_WORDS, np.uint32)])
                r = short[(at + LEFT)[:, None] + np.arange(MIN_WORDS)[None, :]]
                le = short[(at + LEFT - 1)[:, None] - np.arange(LEFT)[None, :]]
                key = ngram_hashes(h, HEAD)[at].view(np.int64) if len(at) else at
                heads.append([{"at": int(a), "head": int(k)} for a, k in zip(at, key, strict=True)])
                rights.append([x.tobytes() for x in r])
                lefts.append([x.tobytes() for x in le])
            return {"x": heads, "right": rights, "left": lefts}

        return fn

    joined = docs.select(F.col(id_col).alias("id"), F.col(text).alias("_text")).join(marks, "id")
    rows = map_rows(joined, make, "x array<struct<at:int,head:bigint>>, right array<binary>, left array<binary>", ["id"])
    z = rows.select("id", F.explode(F.arrays_zip("x", "right", "left")).alias("z"))
    return z.select("id", F.col("z.x.at").alias("at"), F.col("z.x.head").alias("head"), F.col("z.right").alias("right"), F.col("z.left").alias("left"))


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, the first row of its run of equal keys, and the row after the run's last."""
    new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
    number = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return first[number], np.append(first[1:], len(new))[number]


def _shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many leading words the rows of x and y have in common; zeros lie beyond the text."""
    same = (x == y) & (x != 0)
    return np.where(same.all(axis=1), x.shape[1], same.argmin(axis=1))


def _neighbours(grid: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """_shared() of the rows a and b of a grid, some at a time."""
    parts = [_shared(grid[a[k : k + 16384]], grid[b[k : k + 16384]]) for k in range(0, len(a), 16384)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _below(step: int) -> int:
    """The bits of the levels below a step; bit r - HEAD stands for level r."""
    return (1 << max(0, step - HEAD)) - 1


def _bit(step: int) -> int:
    return 1 << step - HEAD if step >= HEAD else 0


def _levels(step: np.ndarray) -> np.ndarray:
    """The levels after each step: a step at which no later one is lower leaves its own."""
    out = np.zeros(len(step), np.int32)
    at = np.arange(len(step))
    for r in range(HEAD, MIN_WORDS + 1):
        here = step == r
        if here.any():
            last = np.maximum.accumulate(np.where(here, at, -1))
            lower = np.maximum.accumulate(np.where(step < r, at, -1))
            out |= (last > lower).astype(np.int32) << (r - HEAD)
    return out


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """A range partition of about PART_ROWS rows."""
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def _grid(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, n)


_GROWTH = "pid int, ahead int, ahead_least int, behind int, behind_least int, edge int, done struct<start:int,end:int>"


def _growth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each suffix of a sorted partition with the levels at which its neighbourhood grows, as far as the partition shows.

    The suffixes that share r words with this one are its neighbourhood at level r; it grows at r if two of them share no more than
    r (or MIN_WORDS, the most that is compared). Going away from the suffix in the sorted order, these are the values that the
    least step so far takes. ``ahead_least`` and ``behind_least`` are the least steps up to the partition's ends, beyond which lower
    levels may come; ``edge`` is the place of the partition's first and last row.

    Suffixes of several documents that have all compared words in common, on both sides, match as far as their words go, so they are
    ``done``. The first and the last of them, of two documents, go on as partners of the others.
    """
    t = _whole(batches)
    if t is None:
        return
    n = t.num_rows
    rows = np.arange(n)
    heads = t["head"].to_numpy()
    right, left = _grid(t["right"], MIN_WORDS), _grid(t["left"], LEFT)
    step = np.where(heads[1:] == heads[:-1], _neighbours(right, rows[:-1], rows[1:]), 0)
    ids, at = t["id"].to_numpy(), t["at"].to_numpy()
    equal = [np.ascontiguousarray(g).view(f"V{4 * g.shape[1]}").ravel() for g in (right, left)]
    first, after = _runs(heads, *equal)
    done = (rows != first) & (rows != after - 1) & (ids[first] != ids[after - 1])
    new = {"pid": np.full(n, TaskContext.get().partitionId())}
    for name, s, order in (("behind", step, rows), ("ahead", step[::-1], rows[::-1])):
        new[name] = np.concatenate([[0], _levels(s)])[order]
        new[f"{name}_least"] = np.concatenate([[MIN_WORDS + 1], np.minimum.accumulate(s)])[order]
    for name in ("pid", "ahead", "ahead_least", "behind", "behind_least"):
        t = t.append_column(name, pa.array(new[name], pa.int32()))
    edge = [None] * n
    edge[0], edge[-1] = 0, n - 1
    t = t.append_column("edge", pa.array(edge, pa.int32()))
    span = [pa.array(at - np.count_nonzero(left, axis=1), pa.int32()), pa.array(at + np.count_nonzero(right, axis=1), pa.int32())]
    t = t.append_column("done", pa.StructArray.from_arrays(span, names=["start", "end"], mask=pa.array(~done)))
    for name in ("right", "left"):
        t = t.set_column(t.schema.get_field_index(name), name, pc.if_else(pa.array(done), pa.scalar(None, pa.binary()), t[name]))
    yield from t.to_batches(max_chunksize=10_000)


def _levels_beyond(grown: DataFrame) -> DataFrame:
    """pid, from_before and from_after: the levels that other partitions leave at a partition's first and last row.

    Only the first and last rows of the partitions are brought here.
    """
    edges = {}
    for r in grown.filter("edge is not null").select("pid", "edge", "head", "right", "ahead", "ahead_least", "behind", "behind_least").collect():
        edges.setdefault(r["pid"], []).append(r)
    order = sorted(edges)
    first = [min(edges[p], key=lambda r: r["edge"]) for p in order]
    last = [max(edges[p], key=lambda r: r["edge"]) for p in order]
    words = lambda r: np.frombuffer(r["right"], np.uint32)[None, :]
    between = [int(_shared(words(x), words(y))[0]) if x["head"] == y["head"] else 0 for x, y in zip(last, first[1:], strict=False)]
    before, after = [0] * len(order), [0] * len(order)
    for i, s in enumerate(between):
        left = last[i]["behind"] | (before[i] & _below(last[i]["behind_least"]))
        before[i + 1] = (left & _below(s)) | _bit(s)
    for i in range(len(between) - 1, -1, -1):
        right = first[i + 1]["ahead"] | (after[i + 1] & _below(first[i + 1]["ahead_least"]))
        after[i] = (right & _below(between[i])) | _bit(between[i])
    return grown.sparkSession.createDataFrame([(p, b, a) for p, b, a in zip(order, before, after, strict=True)], "pid int, from_before int, from_after int")


def _sorted_suffixes(suffixes: DataFrame, parts: int) -> DataFrame:
    """The suffixes with what _growth() says of them, in order."""
    order = ["head", "right", "left", "id", "at"]
    ordered = suffixes.select("id", "at", "head", "right", "left").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ddl = f"id {suffixes.schema['id'].dataType.simpleString()}, at int, head bigint, right binary, left binary, {_GROWTH}"
    return stash(ordered.mapInArrow(_growth, ddl), "grown")


def _by_level(grown: DataFrame) -> DataFrame:
    """A row for each suffix that isn't done and level at which its neighbourhood grows: id, at, r, key and rest.

    ``key`` stands for the r words to the right and the MIN_WORDS - r to the left; ``rest`` is the words left of these, from near to far.
    """
    below = lambda c: F.expr(f"shiftleft(1, greatest({c} - {HEAD}, 0)) - 1")
    levels = F.col("ahead").bitwiseOR(F.col("behind")).bitwiseOR(F.col("from_before").bitwiseAND(below("behind_least")))
    levels = levels.bitwiseOR(F.col("from_after").bitwiseAND(below("ahead_least")))
    met = grown.filter("done is null").join(F.broadcast(_levels_beyond(grown)), "pid").withColumn("levels", levels)
    r = F.explode(F.filter(F.sequence(F.lit(HEAD), F.lit(MIN_WORDS)), lambda x: F.call_function("getbit", "levels", x - HEAD) == 1))
    met = met.select("id", "at", "head", "right", "left", r.alias("r")).withColumn("m", MIN_WORDS - F.col("r"))
    # Zeros lie beyond the text, whose words end with an odd number.
    met = met.filter((F.col("m") == 0) | (F.expr("substring(left, 4 * m - 3, 4)") != F.lit(bytes(4))))
    key = F.expr("xxhash64(r, head, substring(right, 1, 4 * r), substring(left, 1, 4 * m))")
    return met.select("id", "at", "r", key.alias("key"), F.expr(f"substring(left, 4 * m + 1, {4 * LEFT})").alias("rest"))


_COMPARED = "id {id}, at int, r int, key bigint, more int, pid int, side int, mark int, rest binary"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a sorted partition with the number of words that its nearest neighbours of other documents share further left.

    ``more`` is -1 if the partition has no such neighbour. Rows whose neighbour before (side 1) or behind (side 2) may be in another
    partition keep their ``rest``, and so do the rows that others may need: the partition's first (mark 1), the next one with its key of another
    document (2), the last (4) and the one before it of another document (8).
    """
    t = _whole(batches)
    if t is None:
        return
    n = t.num_rows
    key, ids = t["key"].to_numpy(), t["id"].to_numpy()
    rest = _grid(pa.chunked_array([[(x or b"").ljust(4 * LEFT, b"\0") for x in t["rest"].to_pylist()]]), LEFT)
    first, after = _runs(key, ids)
    more, side, mark = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j, bit in ((first - 1, 1), (after, 2)):
        inside = (j >= 0) & (j < n)
        side[~inside] |= bit
        a = np.flatnonzero(inside)
        a = a[key[a] == key[j[a]]]
        more[a] = np.maximum(more[a], _neighbours(rest, a, j[a]))
    mark[0] |= 1
    mark[-1] |= 4
    if after[0] < n and key[after[0]] == key[0]:
        mark[after[0]] |= 2
    if first[-1] and key[first[-1] - 1] == key[-1]:
        mark[first[-1] - 1] |= 8
    needed = (side > 0) | (mark > 0)
    columns = {"more": more, "pid": np.full(n, TaskContext.get().partitionId()), "side": side, "mark": mark}
    held = t.select(["id", "at", "r", "key"])
    for name, values in columns.items():
        held = held.append_column(name, pa.array(values, pa.int32()))
    kept = pc.if_else(pa.array(needed), t["rest"], pa.scalar(None, pa.binary()))
    yield from held.append_column("rest", kept).filter(pa.array(needed | (more >= 0))).to_batches(max_chunksize=10_000)


_Row = tuple[int, int, bytes]  # key, id, rest


def _nearest_beyond(marked: dict[int, dict[int, _Row]], alone: set[int], order: list[int], near: int, far: int) -> dict[int, tuple[_Row, _Row | None]]:
    """Of each partition, in this order, the row before it and the nearest one before that has its key and another id.

    ``near`` and ``far`` are the marks of these rows; a partition in ``alone`` has rows of one key and id only.
    """
    out = {}
    carried: tuple[_Row, _Row | None] | None = None
    for p in order:
        if carried:
            out[p] = carried
        row, other = marked[p][near], marked[p].get(far)
        if p in alone and carried and carried[0][0] == row[0]:
            other = carried[0] if carried[0][1] != row[1] else carried[1]
        carried = (row, other)
    return out


def _rows_beyond(compared: DataFrame) -> DataFrame:
    """pid, side and the rows beyond that side: key, and id and rest of the nearest row and of the next one of another document.

    Only the rows that end the partitions, four of each at most, are brought here.
    """
    marked: dict[int, dict[int, _Row]] = {}
    alone = set()
    for r in compared.filter("mark > 0").select("pid", "mark", "side", "key", "id", "rest").collect():
        for bit in (1, 2, 4, 8):
            if r["mark"] & bit:
                marked.setdefault(r["pid"], {})[bit] = (r["key"], r["id"], bytes(r["rest"]))
        if r["side"] == 3:
            alone.add(r["pid"])
    order = sorted(marked)
    rows = []
    for side, pids, near, far in ((1, order, 4, 8), (2, order[::-1], 1, 2)):
        for p, (row, other) in _nearest_beyond(marked, alone, pids, near, far).items():
            rows.append((p, side, *row, *(other[1:] if other else (None, None))))
    kind = compared.schema["id"].dataType.simpleString()
    return compared.sparkSession.createDataFrame(rows, f"pid int, beyond int, key_2 bigint, id_2 {kind}, rest_2 binary, id_3 {kind}, rest_3 binary")


def _matches(levels: DataFrame, parts: int) -> DataFrame:
    """id, start and end of what each suffix shares with other documents, by level.

    All matches of a suffix contain its position, so together they reach from the farthest start to the farthest end.
    """
    kind = levels.schema["id"].dataType.simpleString()
    order = ["key", "rest", "id", "at"]
    ordered = levels.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    compared = stash(ordered.mapInArrow(_compared, _COMPARED.format(id=kind)), "compared")
    inner = compared.filter("more >= 0").select("id", "at", "r", "more")
    edges = compared.filter("side > 0").drop("more")
    # The rows beyond are two a partition.
    met = edges.join(F.broadcast(_rows_beyond(compared)), "pid").filter("side & beyond > 0 and key = key_2")
    met = met.withColumn("other", F.when(F.col("id") != F.col("id_2"), F.col("rest_2")).otherwise(F.col("rest_3"))).filter("other is not null")
    same = lambda k: F.expr(f"substring(rest, 1, {4 * k}) = substring(other, 1, {4 * k}) and substring(rest, {4 * k - 3}, 4) not in (X'00000000', X'')")
    more = F.greatest(F.lit(0), *[F.when(same(k), k).otherwise(0) for k in range(1, LEFT + 1)])
    found = inner.union(met.select("id", "at", "r", more))
    return found.select("id", (F.col("at") - MIN_WORDS + F.col("r") - F.col("more")).alias("start"), (F.col("at") + F.col("r")).alias("end"))


def _shared_heads(kept: DataFrame, width: int) -> DataFrame:
    """The anchors whose head several documents have.

    A head with more than its share of a quarter of a partition is joined by broadcast, so that its anchors stay where they
    are; there are at most 4 * width such heads. The other heads are joined by shuffle.
    """
    heads = stash(kept.groupBy("head").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n")).filter("a < b").select("head", "n"), "heads")
    hot = F.broadcast(heads.filter(F.col("n") * (4 * width) > kept.count()).select("head"))
    rest = kept.join(hot, "head", "left_anti").join(heads.join(hot, "head", "left_anti").select("head"), "head")
    return kept.join(hot, "head").union(rest.select(*kept.join(hot, "head").columns))


def repeated_passages(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row for each stretch of a document that other documents have too: id, start_word, end_word (exclusive), n_words."""
    spark = docs.sparkSession
    ship(spark)
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The positions are written once, so that texts are read and hashed once for both uses.
    kept = stash(_anchor_rows(docs, text, id_col), "anchors")
    marks = stash(_shared_heads(kept, width).groupBy("id").agg(F.sort_array(F.collect_set("at")).alias("at")), "marks")
    suffixes = stash(_suffixes(docs, marks, text, id_col), "suffixes")
    parts = lambda df: max(width, math.ceil(df.count() / PART_ROWS))  # noqa: E731 (counts of written tables)
    grown = _sorted_suffixes(suffixes, parts(suffixes))
    levels = stash(_by_level(grown), "levels")
    spans = _matches(levels, parts(levels)).union(grown.filter("done is not null").select("id", "done.start", "done.end"))

    # Of spans with one start the longest counts, so a document brings no more rows here than it has words.
    longest = spans.groupBy("id", "start").agg(F.max("end").alias("end"))
    order = Window.partitionBy("id").orderBy("start")
    reached = longest.withColumn("before", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    runs = reached.withColumn("run", F.sum(F.when(F.col("start") <= F.col("before"), 0).otherwise(1)).over(order))
    out = runs.groupBy("id", "run").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"))
    return out.select(F.col("id").alias(id_col), "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))
