"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Defined results: a null text counts as empty; an empty text has no tokens; rows are handled one by one, so repeated rows,
ties and null keys give a row each; texts of any length are encoded whole; the columns kept may have any names; an empty table
gives an empty table.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Longer texts are split into pieces of about so many characters before they are encoded.
PIECE_CHARS = 50_000

_SAFE = re.compile(r"(?<=\S) ")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The tiktoken encoding of a rank file, without special tokens; one for each Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def split_safely(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of at least ``size`` characters (but for the last), cut before a space that follows no white space.

    In the pre-tokenising pattern a space can only begin a match or stand in a run of white space, so no match crosses such
    a cut and none before it looks beyond it. A stretch without one stays whole.
    """
    out, at = [], 0
    while len(text) - at > size and (m := _SAFE.search(text, at + size)):
        out.append(text[at : m.start()])
        at = m.start()
    return out + [text[at:]]


def encoder(path: str, pattern: str):
    """A function from a text to its ids as int32 bytes, equal to encode_ordinary() on the whole text."""
    encode = encoding(path, pattern).encode_ordinary

    def run(text: str | None) -> bytes:
        return b"".join(np.asarray(encode(p), dtype=np.int32).tobytes() for p in split_safely(text)) if text else b""

    return run


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, into: str = "token_ids") -> DataFrame:
    """The columns ``keep`` and each text's token ids (array<int>)."""
    keep = ["doc_id"] if keep is None else keep

    def make():
        run = encoder(path, pattern)

        def fn(cols):
            parts = [run(t) for t in cols[0]]
            ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype(np.int32)
            return {into: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))}

        return fn

    return map_rows(docs.select(*keep, F.col(text).alias("_text")), make, f"{into} array<int>", keep)


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """All columns and the bytes that each row's ids stand for; bytes need not be valid UTF-8, so nothing is replaced.

    Null ids give no bytes.
    """
    keep = tokens.columns

    def make():
        bytes_of = encoding(path, pattern).decode_bytes
        return lambda cols: {into: [bytes_of(x) if x else b"" for x in cols[0]]}

    held = [f"_k{i}" for i in range(len(keep))]
    rows = tokens.select(*[F.col(f"`{c}`").alias(h) for c, h in zip(keep, held, strict=True)], F.col(ids).alias("_ids"))
    return map_rows(rows, make, f"{into} binary", held).toDF(*keep, into)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, token ids and the bytes that they decode to, in one pass through Python."""
    keep = ["doc_id"] if keep is None else keep

    def make():
        run, bytes_of = encoder(path, pattern), encoding(path, pattern).decode_bytes

        def fn(cols):
            ids = [np.frombuffer(run(t), dtype=np.int32) for t in cols[0]]
            ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            return {"token_ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), "decoded": [bytes_of(x.tolist()) for x in ids]}

        return fn

    return map_rows(docs.select(*keep, F.col(text).alias("_text")), make, "token_ids array<int>, decoded binary", keep)


def digests(tokens: DataFrame) -> DataFrame:
    """Contract columns of a table with token_ids and decoded."""
    return tokens.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
