"""N-gram Jaccard join by MinHash banding.

Documents whose sets of hashed five-word n-grams (words are lower-cased and divided by white space) have a Jaccard similarity
of at least THRESHOLD are linked. Band and row counts follow from the target recall. Documents with equal sets are one text, so
copies are never compared. Bands are shuffled alone, as hashes and once. The texts of a band are a bucket; of buckets with the same
texts one is kept. Packed texts, which are a fraction of their sets of hashes, are shuffled to the buckets that are kept, in blocks of
bounded size, and each pair is verified on full sets in the first bucket that it shares, so a chain of weak candidates brings no unrelated texts together. A group of texts is never
expanded into rows of pairs: tasks return link counts and a spanning forest.

Defined results: a null or empty text, or one of white space only, has no n-grams and links to nothing; a text of fewer than five
words has one n-gram, all its words; rows with a null id are left out; rows that repeat an id count as one document with
the texts of all; an empty table gives an empty table; texts of any length are read whole; a pair at the threshold exactly is
linked; only the two columns named are read, whatever the others are called.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import map_rows, ship, small, stash
from .components import components
from .shingles import mix, ngram_hashes, word_hashes, words_of

NGRAM = 5
THRESHOLD = 0.8
#: Share of the pairs at the threshold that at least one band must bring together.
RECALL = 0.9999
#: Hash functions at most.
MAX_HASHES = 200
#: Texts of a block of a bucket, on average; a group of rows is two blocks, verified against each other.
BLOCK_TEXTS = 250
#: Candidates whose lists of buckets are broadcast, at most; each list has an entry a band at most.
BROADCAST_FOUND = 100_000

_U = np.uint64


def band_plan(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows a band: as many rows as the hash functions allow for the recall, as more rows mean fewer false candidates."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


class Signer:
    """Band hashes of a set of n-gram hashes."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
        self.a = (seeds[: bands * rows] >> _U(32)).astype(np.uint32) | np.uint32(1)
        self.b = (seeds[bands * rows :] >> _U(32)).astype(np.uint32)
        self.weights = mix(seeds[:rows]) | _U(1)
        self.salt = mix(np.arange(bands, dtype=_U) + _U(7))

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        x = (grams >> _U(32)).astype(np.uint32)
        for i in range(0, len(x), 2048):
            h = self.a[:, None] * x[None, i : i + 2048]
            h += self.b[:, None]
            np.minimum(low, h.min(axis=1), out=low)
        grid = low.astype(_U).reshape(self.bands, self.rows)
        return mix((grid * self.weights[None, :]).sum(axis=1, dtype=_U) + self.salt).view(np.int64)


def grams_of(text: str | None, n: int = NGRAM) -> np.ndarray:
    return np.unique(ngram_hashes(word_hashes(words_of(text)), n))


def digest_of(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def pack(text: str) -> tuple[int, bytes]:
    """Number of bytes of a text, and these compressed."""
    raw = text.encode("utf-8", "surrogatepass")
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def unpack(size: int, packed: bytes) -> str:
    return pa.decompress(packed, size, codec="zstd", asbytes=True).decode("utf-8", "surrogatepass")


def signatures(docs: DataFrame, text: str, id_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """id, digest of the set (null without n-grams) and band hashes, for rows with an id."""

    def make():
        sign = Signer(bands, rows)

        def fn(cols):
            sets = [grams_of(t, n) for t in cols[0]]
            return {"digest": [digest_of(g) for g in sets], "bands": [sign(g).tolist() if len(g) else [] for g in sets]}

        return fn

    rows_in = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("_text"))
    return map_rows(rows_in, make, "digest binary, bands array<bigint>", ["id"])


def _jaccard_links(bands: np.ndarray, here: int, grams: list[np.ndarray], block: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each text in these blocks of the bucket ``here`` and the first text that it is connected to here.

    ``bands`` has each text's buckets in order, zero for those not kept. With two blocks only pairs across them count.
    """
    m = len(grams)
    sizes = np.array([len(g) for g in grams])
    _, flat = np.unique(np.concatenate(grams), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    present = np.zeros(int(flat.max()) + 1, dtype=bool)
    count, root = np.zeros(m, dtype=np.int64), np.arange(m)
    across = block.min() != block.max()

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(m - 1):
        ratio = np.minimum(sizes[i + 1 :], sizes[i]) / np.maximum(sizes[i + 1 :], sizes[i])
        later = np.flatnonzero((ratio >= threshold) & (block[i + 1 :] != block[i] if across else True)) + i + 1
        shared = (bands[later] == bands[i]) & (bands[i] != 0)
        later = later[bands[i][shared.argmax(axis=1)] == here]
        if not len(later):
            continue
        mine = flat[starts[i] : ends[i]]
        present[mine] = True
        if len(later) * 4 > m - i:
            common = np.add.reduceat(present[flat[starts[i + 1] :]], starts[i + 1 :] - starts[i + 1], dtype=np.int64)[later - i - 1]
        else:
            common = np.array([present[flat[starts[j] : ends[j]]].sum() for j in later])
        present[mine] = False
        linked = later[common >= threshold * (sizes[later] + sizes[i] - common) - 1e-9]
        count[i] += len(linked)
        count[linked] += 1
        for j in linked:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
    return count, np.array([find(i) for i in range(m)], dtype=np.int64)


def buckets(texts: DataFrame) -> DataFrame:
    """band, digest and number of texts n, of every text in a bucket of two texts or more; of buckets with equal texts one."""
    width = max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shared = texts.select("digest", F.explode("bands").alias("band")).repartition(width, "band")
    # Nearly every band is one text's alone. The others are written, so that all bands are shuffled once.
    shared = stash(shared.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("band"))).filter("n > 1"), "shared")
    # The digests' halves, hashed and summed over a bucket, and their number and the least of them tell buckets apart.
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), "digest").cast("decimal(20,0)"))
    kinds = shared.groupBy("band").agg(F.first("n").alias("n"), F.min("digest").alias("first"), total(1).alias("s1"), total(2).alias("s2"))
    kept = stash(kinds.groupBy("n", "first", "s1", "s2").agg(F.min("band").alias("band")).select("band"), "buckets")
    return shared.join(small(kept), "band").select("band", "digest", "n")


def link_texts(docs: DataFrame, texts: DataFrame, text: str, id_col: str, n: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """digest, n_links and root (a digest) of every text that is linked, one row for each pair of blocks that shows it.

    ``texts`` has the digests, representative ids (node) and bands of different texts.
    """
    spark = docs.sparkSession
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = buckets(texts).groupBy("digest").agg(F.collect_list(F.struct("band", "n")).alias("found"))
    found = stash(found, "candidates")
    nodes = stash(texts.select("digest", "node").join(found.select("digest"), "digest").select("node").distinct(), "nodes")

    def make():
        sign = Signer(bands, rows)

        def fn(cols):
            sets, packed = [grams_of(t, n) for t in cols[0]], [pack(t or "") for t in cols[0]]
            return {
                "digest": [digest_of(g) for g in sets], "size": [size for size, _ in packed], "packed": [x for _, x in packed],
                "bands": [sign(g).tolist() if len(g) else [] for g in sets],
            }

        return fn

    # An id can have several texts; those that aren't candidates find nothing in the join by digest.
    chosen = docs.select(F.col(id_col).alias("node"), F.col(text).alias("_text")).join(small(nodes), "node").select("_text")
    sets = stash(map_rows(chosen, make, "digest binary, size bigint, packed binary, bands array<bigint>"), "packed")
    placed = sets.join(small(found, BROADCAST_FOUND), "digest")
    kept = F.transform("bands", lambda x: F.when(F.array_contains("found.band", x), x).otherwise(F.lit(0).cast("bigint")))
    placed = placed.select("digest", "size", "packed", kept.alias("bands"), F.explode("found").alias("at"))
    blocks = F.ceil(F.col("at.n") / BLOCK_TEXTS).cast("int")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("digest"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.select(F.col("at.band").alias("band"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "digest", "size", "packed", "bands")
    out = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n_links", T.LongType()), T.StructField("root", T.BinaryType())])

    def verify(table: pa.Table) -> pa.Table:
        at = {d: i for i, d in enumerate(table["digest"].to_pylist())}  # a row can be repeated
        table = table.take([at[d] for d in sorted(at)])
        grams = [grams_of(unpack(size.as_py(), x.as_py()), n) for size, x in zip(table["size"], table["packed"], strict=True)]
        grid = np.asarray(table["bands"].to_pylist(), dtype=np.int64)
        count, root = _jaccard_links(grid, table["band"][0].as_py(), grams, table["block"].to_numpy(), threshold)
        on = np.flatnonzero(count)
        digests = table["digest"].combine_chunks()
        return pa.table({"digest": digests.take(pa.array(on)), "n_links": count[on], "root": digests.take(pa.array(root[on]))})

    ship(spark)
    return placed.repartition(width, "band", "low", "high").groupBy("band", "low", "high").applyInArrow(verify, out)


def _linked(docs: DataFrame, text: str, id_col: str, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: id and digest of every row with an id; ids of several rows (_twice); and of every different text its
    digest, group (the least digest that it is connected to), class_id (the least id of the group), n_rows and n_links."""
    bands, rows = band_plan(threshold, recall)
    signed = stash(signatures(docs, text, id_col, n, bands, rows), "signatures")
    twice = stash(signed.groupBy("id").count().filter("count > 1").select(F.col("id").alias("_twice")), "repeated")
    texts = signed.filter("digest is not null").groupBy("digest").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n_rows"), F.first("bands").alias("bands"))
    texts = stash(texts, "texts")
    rows_in = docs if twice.isEmpty() else docs.select(id_col, text).dropDuplicates([id_col, text])
    links = stash(link_texts(rows_in, texts, text, id_col, n, threshold, bands, rows), "links")
    groups = components(links, "digest", "root").select(F.col("node").alias("digest"), F.col("component").alias("group"))
    counts = links.groupBy("digest").agg(F.sum("n_links").alias("n_links"))
    linked = texts.select("digest", "node", "n_rows").join(groups, "digest").join(counts, "digest")
    linked = stash(linked, "linked")
    least = linked.groupBy("group").agg(F.min("node").alias("class_id"))
    alone = texts.join(linked, "digest", "left_anti").select("digest", F.col("digest").alias("group"), F.col("node").alias("class_id"), "n_rows", F.lit(0).cast("bigint").alias("n_links"))
    return signed.select("id", "digest"), twice, stash(linked.join(least, "group").select(*alone.columns).union(alone), "classes")


def near_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """A row for each id: class_id (the least id that it is linked to, itself included, through any number of links), n_links
    (different texts that its text is linked to) and n_copies (other rows with the same set of n-grams)."""
    signed, twice, classes = _linked(docs, text, id_col, n, threshold, recall)
    of_id = (signed if twice.isEmpty() else signed.distinct()).join(classes, "digest", "left").groupBy("id").agg(
        F.coalesce(F.min("class_id"), "id").alias("class_id"), F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_links"),
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("n_copies"),
    )
    if not twice.isEmpty():  # an id with several texts ties their classes together
        tied = components(signed.join(classes, "digest").select("id", "class_id"), "id", "class_id")
        of_id = of_id.join(tied, of_id["id"] == tied["node"], "left").withColumn("class_id", F.coalesce("component", "class_id"))
    return of_id.select(F.col("id").alias(id_col), "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Of each class of linked texts and their copies one row, with the least id of the class.

    Rows with a null id or without n-grams stay. Rows that repeat an id are judged one by one by their texts: unrelated texts all
    stay, and of copies under one id the one with the least text, then the least JSON form of its columns.
    """
    signed, twice, classes = _linked(docs, text, id_col, NGRAM, THRESHOLD, RECALL)
    drop = signed.join(classes, "digest").filter("id <> class_id").select(F.col("id").alias("_drop"))
    none = twice.isEmpty()
    drop = small(stash(drop if none else drop.join(twice, drop["_drop"] == twice["_twice"], "left_anti"), "copies"))
    kept = docs.join(drop, docs[id_col] == drop["_drop"], "left_anti")
    if none:
        return kept
    twice = small(twice)

    def make():
        return lambda cols: {"digest": [digest_of(grams_of(t)) for t in cols[0]]}

    repeated = docs.join(twice, docs[id_col] == twice["_twice"], "left_semi")
    repeated = map_rows(repeated.select(F.struct(*repeated.columns).alias("_row"), F.col(id_col).alias("_id"), F.col(text).alias("_text")), make, "digest binary", ["_row", "_id"])
    bare = repeated.filter("digest is null").select("_row.*")
    first = repeated.join(classes, "digest").filter("_id = class_id")
    first = first.groupBy("group").agg(F.min_by("_row", F.struct(F.col(f"_row.`{text}`"), F.to_json("_row"))).alias("_row")).select("_row.*")
    return kept.join(twice, kept[id_col] == twice["_twice"], "left_anti").select(*docs.columns).union(bare).union(first)
