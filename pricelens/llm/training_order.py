"""Training-order materialisation: token sequences in a keyed random order, in shards of fixed stride.

Documents are encoded and packed into sequences of SEQ_LEN tokens, each document closed by an end token. Documents are packed
in the order of their ids (null ids first), then of their texts' SHA-256, so neither files nor partitions nor lost executors
change a byte of the result. The sequences are numbered 0..N-1; a Feistel network with a key, walked until its value is below N,
gives each number its slot, a permutation that needs no table. Slots are dealt by range: a shard holds SHARD_ROWS slots in order,
SEQ_LEN 16-bit ids each, so slot s starts at byte (s mod SHARD_ROWS) * stride of shard s div SHARD_ROWS, and a reader
resumes at any slot by seeking.

Defined results: a null or empty text gives its end token alone; rows with null or repeated ids are packed each, equal ones in
either order; texts of any length are packed whole; the rest of the very last sequence is filled with the end token; an empty table
gives no shard; ids that 16 bits can't hold are refused; only the two columns named are read, whatever the others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .bpe import encoder, encoding
from .common import SLICE_ROWS, new_path, ship, stash
from .files import opened, written_whole
from .shingles import mix

SEQ_LEN = 2048
SHARD_ROWS = 4096
ROUNDS = 6
#: Shards that one task writes at most, one after the other.
SHARDS_OF_A_TASK = 64

_U = np.uint64
_ID = np.dtype("<u2")


def feistel(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each number below n: a permutation of 0..n-1 for every key.

    The network permutes the least even number of bits that holds n - 1; values of n or more walk on, through at most three
    others on average.
    """
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask = _U((1 << half) - 1)
    keys = mix(_U(key & (2**64 - 1)) + np.arange(1, ROUNDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
    out = np.asarray(x, dtype=_U).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> _U(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = (left << _U(half)) | right
        todo = todo[out[todo] >= _U(n)]
    return out.astype(np.int64)


def end_token(path: str, pattern: str) -> int:
    """The first id that the rank file leaves free closes each document."""
    end = encoding(path, pattern).max_token_value + 1
    if end > np.iinfo(_ID).max:
        raise ValueError(f"ids up to {end} don't fit into 16 bits")
    return end


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """part and number (the encoding task, and the row's place in it), id, sha256 of the text, n_tokens and tokens of every row."""
    ship(docs.sparkSession)
    end = end_token(path, pattern)
    fields = [("part", pa.int32()), ("number", pa.int64()), ("sha256", pa.binary()), ("n_tokens", pa.int64()), ("tokens", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number = encoder(path, pattern), TaskContext.get().partitionId(), 0
        close = np.array([end], dtype=_ID).tobytes()
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                ids, texts = batch.column(0).slice(i, SLICE_ROWS), batch.column(1).slice(i, SLICE_ROWS).to_pylist()
                data = [np.frombuffer(encode(t), dtype=np.int32).astype(_ID).tobytes() + close for t in texts]
                digests = [hashlib.sha256((t or "").encode("utf-8", "replace")).digest() for t in texts]
                at = range(number, number + len(data))
                number += len(data)
                columns = [pa.array([part] * len(data)), pa.array(at), pa.array(digests), pa.array([len(d) // 2 for d in data]), pa.array(data)]
                arrays = [ids, *[c.cast(t) for c, (_, t) in zip(columns, fields, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([pa.field("id", ids.type), *[pa.field(*f) for f in fields]]))

    id_type = docs.schema[id_col].dataType
    out = T.StructType([T.StructField("id", id_type), *T.StructType.fromDDL("part int, number bigint, sha256 binary, n_tokens bigint, tokens binary")])
    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("_text")).mapInArrow(run, out)


def write_starts(encoded: DataFrame, folder: str) -> int:
    """Write, for each encoding task, a file of where each of its rows starts in the stream of all tokens; the stream's length.

    Only ids, digests and token counts are sorted, in ranges; a row for each range comes to the driver.
    """
    spark = encoded.sparkSession
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = ["id", "sha256", "part", "number"]
    ranged = encoded.select(*keys, "n_tokens").repartitionByRange(width, *keys)
    ordered = stash(ranged.withColumn("range", F.spark_partition_id()), "order")
    starts, total = {}, 0
    for r in sorted(ordered.groupBy("range").agg(F.sum("n_tokens").alias("n")).collect()):
        starts[r["range"]] = total
        total += r["n"]
    if not total:
        return 0
    offsets = spark.createDataFrame(list(starts.items()), "range int, base bigint")
    before = Window.partitionBy("range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = ordered.join(F.broadcast(offsets), "range").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def put() -> pa.RecordBatch:
            with written_whole(f"{folder}/{part:08d}.starts") as out:
                out.write(np.concatenate(held).astype("<i8").tobytes())
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32())})

        for b in batches:
            parts, places = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(parts)) + 1
            for p, x in zip(parts[np.append([0], cuts)].tolist() if len(parts) else [], np.split(places, cuts), strict=False):
                if p != part and held:
                    yield put()
                    held = []
                part = p
                held.append(x)
        if held:
            yield put()

    # A part has no more rows than one encoding task read.
    dealt = placed.repartition(width, "part").sortWithinPartitions("part", "number").select("part", "start")
    dealt.mapInArrow(run, "part int").write.format("noop").mode("overwrite").save()
    return total


def with_slots(encoded: DataFrame, folder: str, total: int, key: int, seq_len: int = SEQ_LEN) -> tuple[DataFrame, int]:
    """slot, sequence, at (the first token's place in it) and blob of every stretch of tokens, and how many sequences there are.

    Tokens stay where they were encoded; each task reads the starts of its rows. Rows that follow each other in the stream are
    joined before they are compressed, so a table in id order gives whole sequences.
    """
    ship(encoded.sparkSession)
    n = -(-total // seq_len)
    schema = pa.schema([("slot", pa.int64()), ("sequence", pa.int64()), ("at", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, part, starts = zstandard.ZstdCompressor(level=3), None, None
        for b in batches:
            where = np.empty(b.num_rows, dtype=np.int64)
            parts, numbers = b.column(0).to_numpy(), b.column(1).to_numpy()
            for p in np.unique(parts).tolist():
                if p != part:
                    with opened(f"{folder}/{p:08d}.starts") as file:
                        part, starts = p, np.frombuffer(file.read(), dtype="<i8")
                where[parts == p] = starts[numbers[parts == p]]
            order = np.argsort(where, kind="stable")
            tokens = b.column(2).take(pa.array(order)).to_pylist()
            where, sizes = where[order], np.array([len(t) // 2 for t in tokens], dtype=np.int64)
            first = np.flatnonzero(np.append([True], where[1:] != where[:-1] + sizes[:-1]))
            for a, z in zip(first.tolist(), np.append(first[1:], len(tokens)).tolist(), strict=True):
                data, begin = b"".join(tokens[a:z]), int(where[a])
                until = begin + len(data) // 2
                edges = [begin, *range((begin // seq_len + 1) * seq_len, until, seq_len), until]
                numbers_ = np.array(edges[:-1], dtype=np.int64) // seq_len
                blobs = [squeeze.compress(data[2 * (x - begin) : 2 * (y - begin)]) for x, y in zip(edges, edges[1:], strict=False)]
                places = np.array(edges[:-1], dtype=np.int64) % seq_len
                yield pa.RecordBatch.from_arrays([pa.array(feistel(numbers_, n, key)), pa.array(numbers_), pa.array(places, pa.int32()), pa.array(blobs, pa.binary())], schema=schema)

    return encoded.select("part", "number", "tokens").mapInArrow(run, "slot bigint, sequence bigint, at int, blob binary"), n


def write_shards(slotted: DataFrame, total: int, folder: str, fill: int, seq_len: int = SEQ_LEN, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Write the shards; slot, sequence, n_tokens, shard, path, offset of each sequence.

    A partition holds one shard, or several whole ones, in slot order; a shard's file gets its name when it is whole.
    """
    ship(slotted.sparkSession)
    schema = pa.schema([("slot", pa.int64()), ("sequence", pa.int64()), ("n_tokens", pa.int32()), ("shard", pa.int64()), ("path", pa.string()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        shard, context, out, rows, now, held = None, None, None, [], None, b""

        def put() -> None:
            out.write(held + np.full(seq_len - len(held) // 2, fill, dtype=_ID).tobytes())
            rows.append({"slot": now[0], "sequence": now[1], "n_tokens": len(held) // 2, "shard": shard, "path": path, "offset": now[0] % shard_rows * 2 * seq_len})

        for b in batches:
            for slot, seq, blob in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                if now is None or slot != now[0]:
                    if now is not None:
                        put()
                    now, held = (slot, seq), b""
                    if slot // shard_rows != shard:
                        if context is not None:
                            context.__exit__(None, None, None)
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        shard, rows = slot // shard_rows, []
                        path = f"{folder}/{shard:08d}.tokens"
                        context = written_whole(path)
                        out = context.__enter__()
                held += expand.decompress(blob)
        if context is not None:
            put()
            context.__exit__(None, None, None)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    shards = max(1, -(-total // shard_rows))
    tasks = min(shards, max(int(slotted.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shards // SHARDS_OF_A_TASK)))
    task = F.floor(F.floor(F.col("slot") / shard_rows) * tasks / shards).cast("int")
    dealt = slotted.repartitionById(tasks, task).sortWithinPartitions("slot", "at")
    return dealt.select("slot", "sequence", "blob").mapInArrow(run, "slot bigint, sequence bigint, n_tokens int, shard bigint, path string, offset bigint")


def read_shards(manifest: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """The manifest's columns and tokens_sha256 of each slot's bytes, read from the shards in order."""
    ship(manifest.sparkSession)
    stride = 2 * seq_len

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for b in batches:
            digests = []
            for path, offset in zip(b.column("path").to_pylist(), b.column("offset").to_pylist(), strict=True):
                if path != name:
                    if file is not None:
                        file.close()
                    name, file = path, opened(path, random=True)
                if file.tell() != offset:
                    file.seek(offset)
                digests.append(hashlib.sha256(file.read(stride)).hexdigest())
            yield b.append_column("tokens_sha256", pa.array(digests))
        if file is not None:
            file.close()

    return manifest.mapInArrow(run, T.StructType([*manifest.schema, T.StructField("tokens_sha256", T.StringType())]))


def sequences_from(folder: str, slot: int, total: int, seq_len: int = SEQ_LEN, shard_rows: int = SHARD_ROWS) -> Iterator[np.ndarray]:
    """The ids of slots ``slot``, slot + 1, .. total - 1: what a training process reads, and where it resumes after a stop."""
    while slot < total:
        with opened(f"{folder}/{slot // shard_rows:08d}.tokens", random=True) as file:
            file.seek(slot % shard_rows * 2 * seq_len)
            for _ in range(min(total - slot, shard_rows - slot % shard_rows)):
                yield np.frombuffer(file.read(2 * seq_len), dtype=_ID)
                slot += 1


def materialise(
    docs: DataFrame, path: str, pattern: str, key: int, text: str = "text", id_col: str = "doc_id", folder: str | None = None, seq_len: int = SEQ_LEN, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Encode, pack, permute and write all documents; the manifest of the shards."""
    spark = docs.sparkSession
    encoded = encode(docs, path, pattern, text, id_col)
    where = new_path(spark, "encoded")
    encoded.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "9").parquet(where)
    encoded = spark.read.schema(encoded.schema).parquet(where)
    starts = new_path(spark, "starts")
    slotted, total = with_slots(encoded, starts, write_starts(encoded, starts), key, seq_len)
    return stash(write_shards(slotted, total, folder or new_path(spark, "shards"), end_token(path, pattern), seq_len, shard_rows), "manifest")
