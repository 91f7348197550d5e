"""BPE with word ends: encoding through a trie of distinct words, decoding by the vocabulary.

A text is cut at white space into chunks; those that a task hasn't met lately are normalised and cut into words by the tokenizer
file's own rules, and the distinct words go into a trie. A BPE encoding is settled from left to
right: a sequence of tokens is the encoding of what it spells if and only if each token is its own encoding and no merge across
the border of two neighbours would have come before the merges that made them. Each prefix therefore has one last token, found from
the last tokens of shorter prefixes. A depth-first walk carries these along, so a prefix that many words share is
encoded once, and a word's ids are read backwards from its end. The last symbol of a word is one of its own (with the word-end
mark), which makes "low" and "lower" share only what they encode alike.

Defined results: a null text counts as empty and has no tokens; the strings of added tokens in a text become these tokens, as in the
library; rows are handled one by one, so ties, repeated rows and null keys give a row each; only the columns named are read, whatever
the others are called; an empty table gives an empty table; texts are encoded whole, and memory grows with the longest text alone.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Word-final symbols stand this far above the others in the internal spelling.
_FINAL = 0x1000
#: Bytes of chunks and borders of tokens that a task remembers at most.
REMEMBERED_BYTES, REMEMBERED_BORDERS = 160_000_000, 500_000
#: Symbols of a word that have nodes of their own, so that the trie's size and depth are bounded whatever the words are.
DEPTH = 32
#: White space as the normaliser and the splitting pattern know it.
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Chunks of printable ASCII are cut here, by the file's pattern as it stands for them; Encoder checks that it is this pattern.
_PRINTABLE = re.compile("[!-~]+")
_ASCII_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# The rules of the tokenizer file that the cutting of chunks relies on.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class Merges:
    """Tokens and ranked merges of a vocabulary, over symbols of which word-final ones are apart."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str) -> None:
        # Symbols are single characters or, word-finally, one with the end mark; every other token is spelled by the merge that makes it.
        spelled = {t: t for t in vocab if len(t) == 1} | {t: chr(ord(t[0]) + _FINAL) for t in vocab if len(t) == 1 + len(end) and t.endswith(end)}
        self.made: dict[str, tuple[str, str, int]] = {}
        self.rank: dict[tuple[str, str], int] = {}
        for i, (a, b) in enumerate(merges):
            x, y = spelled[a], spelled[b]
            spelled[a + b] = x + y
            self.rank[x, y] = i
            if x + y in self.made or any(z in self.made and self.made[z][2] > i for z in (x, y)):
                raise ValueError(f"{a} {b}: tokens must be made by one merge, after their parts")
            self.made[x + y] = (x, y, i)
        self.ids = {s: vocab[t].to_bytes(4, "little") for t, s in spelled.items()}
        # Tokens that are the encoding of what they spell, each with what is known of the tokens before it; the longest by last symbol.
        self.after: dict[str, dict[str, bool]] = {}
        self.reach: dict[str, int] = {}
        self._borders = 0
        for s in sorted(self.ids, key=len):
            a, b, _ = self.made.get(s, ("", "", 0))
            if not a or (a in self.after and b in self.after and not self._crossed(a, b, (a, b))):
                self.after[s] = {}
                self.reach[s[-1]] = len(s)

    def _spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """The parts of a token that ever end (side 1) or begin (side 0) it, each with the rank of the merge that took it up."""
        out, until = [], inf
        while True:
            out.append((token, until))
            if token not in self.made:
                return out
            until, token = self.made[token][2], self.made[token][side]

    def _crossed(self, left: str, right: str, besides: tuple[str, str] | None = None) -> bool:
        """Whether a merge across the border would come before the parts that it needs are taken up.

        Of equal merges the leftmost comes first: the one inside ``left`` before the border's, the border's before the one inside
        ``right``.
        """
        starts = self._spine(right, 0)
        for u, gone in self._spine(left, 1):
            for v, taken in starts:
                r = self.rank.get((u, v))
                if r is not None and r < gone and r <= taken and (u, v) != besides:
                    return True
        return False

    def apart(self, left: str, right: str) -> bool:
        """Whether two tokens stay apart when they are neighbours; remembered in after[right]."""
        if self._borders >= REMEMBERED_BORDERS:
            self._borders = 0
            for known in self.after.values():
                known.clear()
        self._borders += 1
        found = self.after[right][left] = not self._crossed(left, right)
        return found

    def last_token(self, spelled: str, at: int, ends: list[str]) -> str:
        """The last token of the encoding of spelled[:at]; ends[i] is that of spelled[:i]."""
        after = self.after
        for start in range(max(0, at - self.reach.get(spelled[at - 1], 0)), at):
            token = spelled[start:at]
            if token in after:
                if start == 0:
                    return token
                apart = after[token].get(ends[start])
                if apart or (apart is None and self.apart(ends[start], token)):
                    return token
        raise ValueError(f"no token for {spelled[at - 1]!r}")


def insert(trie: dict, word: str) -> None:
    """Put a word into a trie of a node a symbol; what is beyond DEPTH symbols hangs on the last node, as a whole."""
    for symbol in word[: min(DEPTH, len(word) - 1)]:
        below = trie.get(symbol)
        if below is None:
            below = trie[symbol] = {}
        trie = below
    if len(word) <= DEPTH + 1:
        trie[word[-1]] = None
    else:
        trie.setdefault("", []).append(word[DEPTH:])


def encode_words(merges: Merges, words: set[str]) -> dict[str, bytes]:
    """The ids of each word, spelled in symbols, as little-endian unsigned 32-bit integers: one depth-first walk over a trie of all words."""
    trie: dict = {}
    for w in words:
        insert(trie, w)
    out: dict[str, bytes] = {}
    ends, ids, last_token = [""], merges.ids, merges.last_token

    def found(word: str) -> None:
        tokens, at = [], len(word)
        while at:
            token = ends[at]
            tokens.append(ids[token])
            at -= len(token)
        tokens.reverse()
        out[word] = b"".join(tokens)

    def walk(node: dict, path: str) -> None:
        depth = len(path)
        for symbol, below in node.items():
            if symbol:
                here = path + symbol
                ends.append(last_token(here, depth + 1, ends))
                if below is None:  # a word-final symbol, so nothing is below
                    found(here)
                else:
                    walk(below, here)
            else:
                for tail in below:
                    word = path + tail
                    for at in range(depth + 1, len(word) + 1):
                        ends.append(last_token(word, at, ends))
                    found(word)
                    del ends[depth + 1 :]
                continue
            ends.pop()

    walk(trie, "")
    return out


class Encoder:
    """Encodes texts as the tokenizers library does with a word-end BPE file and without special tokens around them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["continuing_subword_prefix"] or model["dropout"] or spec["decoder"]:
            raise ValueError("not a BPE with word ends and plain decoding")
        if not spec["added_tokens"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or t["content"][:2] != "<|" for t in spec["added_tokens"]):
            raise ValueError("added tokens must be plain strings that begin with <|")
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if spec["normalizer"]["normalizers"] != _NORMAL or split["pattern"] != {"Regex": _PATTERN} or level["type"] != "ByteLevel" or level["use_regex"]:
            raise ValueError("other rules for words than those that chunks are cut by")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], pairs, model["end_of_word_suffix"])
        rules = Tokenizer.from_file(path)
        self._normal, self._split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._added = {t: i.to_bytes(4, "little") for t, i in added.items()}
        self._marks = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in added.items()}
        self._names = [names.get(i) for i in range(max(names) + 1)]
        self._known: dict[str, bytes] = {}
        self._size = 0

    def _words(self, pieces: list[str]) -> list[list[str]]:
        """The words of each piece, as the file's rules cut them; pieces have no white space."""
        out: list[list[str]] = [[] for _ in pieces]
        other = []
        for i, p in enumerate(pieces):
            if _PRINTABLE.fullmatch(p):
                out[i] = _ASCII_WORDS.findall(p.lower())
            elif p:
                other.append(i)
        # No rule looks across white space, so the others go through the library together.
        if other:
            normal = self._normal(" ".join([pieces[i] for i in other]))
            ends = [e.start() for e in re.finditer(" ", normal)] + [len(normal)]
            k = 0
            for word, (at, _) in self._split(normal):
                while at >= ends[k]:
                    k += 1
                out[other[k]].append(word)
        return out

    def _learn(self, chunks: list[str]) -> None:
        cut = [self._marks.split(c) if "<|" in c else [c] for c in chunks]
        pieces = [p for ps in cut for p in ps if p not in self._added]
        words = dict(zip(pieces, self._words(pieces), strict=True))
        final = {w: w[:-1] + chr(ord(w[-1]) + _FINAL) for ws in words.values() for w in ws}
        ids = encode_words(self.merges, set(final.values()))
        for c, ps in zip(chunks, cut, strict=True):
            self._known[c] = b"".join([self._added[p] if p in self._added else b"".join([ids[final[w]] for w in words[p]]) for p in ps])
            self._size += 200 + 4 * len(c)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cut = [(_WHITE.split(t) if _SEPARATORS.search(t) else t.split()) if t else [] for t in texts]
        if self._size > REMEMBERED_BYTES:
            self._known, self._size = {}, 0
        known = self._known
        new = {c for chunks in cut for c in chunks if c not in known}
        if new:
            self._learn(list(new))
        return [b"".join([known[c] for c in chunks]) for chunks in cut]

    def decode(self, ids: list[int]) -> str:
        """What the ids stand for, as a file without a decoder says it: the tokens' own strings, with a space between two."""
        names = self._names
        return " ".join([names[i] for i in ids])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, into: str = "token_ids") -> DataFrame:
    """The columns ``keep`` and each text's ids (array<int>)."""
    keep = ["doc_id"] if keep is None else keep

    def make():
        run = encoder(path).encode

        def fn(cols):
            parts = run(cols[0])
            ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype(np.int32)
            return {into: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))}

        return fn

    return map_rows(docs.select(*keep, F.col(text).alias("_text")), make, f"{into} array<int>", keep)


def decode(tokens: DataFrame, path: str, ids: str = "token_ids", keep: list[str] | None = None, into: str = "decoded") -> DataFrame:
    """The columns ``keep`` and the string that each row's ids stand for; null ids give an empty one."""
    keep = ["doc_id"] if keep is None else keep

    def make():
        run = encoder(path).decode
        return lambda cols: {into: [run(x or []) for x in cols[0]]}

    return map_rows(tokens.select(*keep, F.col(ids).alias("_ids")), make, f"{into} string", keep)


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, packed (the ids as little-endian unsigned 32-bit integers) and decoded, in one pass through Python."""
    keep = ["doc_id"] if keep is None else keep

    def make():
        run = encoder(path)

        def fn(cols):
            packed = run.encode(cols[0])
            return {"packed": packed, "decoded": [run.decode(np.frombuffer(p, dtype="<u4").tolist()) for p in packed]}

        return fn

    return map_rows(docs.select(*keep, F.col(text).alias("_text")), make, "packed binary, decoded string", keep)


def digests(coded: DataFrame) -> DataFrame:
    """Contract columns of round_trip()'s result."""
    return coded.select(
        "doc_id",
        F.expr("octet_length(packed) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
