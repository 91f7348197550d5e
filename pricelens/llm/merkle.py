"""A Merkle manifest of a dataset: a hash tree for each group of rows, a tree over their roots, and proofs for every row.

Leaves have ranks in their tree, and a node is labelled with the interval of ranks that it covers; labels nest as nodes do. A node's
parent is the one on the next level whose interval contains its own: both fall into the same bucket of that level (the lower end
divided by the level's width), so ancestors are attached, from the roots down, by joins on tree and bucket with containment as the
rest of the condition. A node's siblings are what is left of its parent's children when its own interval is taken away; those that end
before it stand on its left. What a row needs to be checked against the root is so collected in a few narrow joins; texts are read once,
for the leaves, and never shuffled.

Ranks come from one range partitioning by tree and key, numbered within each partition and shifted by the sizes of those before: a
tree of any size is spread over all tasks, and a parent has ARITY children at most.

Defined results: a null value counts as such and differs from an empty one; rows with a null group make a tree of their own, which comes
first; a null key comes first in its tree; rows of equal keys are ordered by their leaves, so repeated rows give a leaf each and the
same root in every layout; a tree of one row has its leaf as root; rows without siblings at any level have a proof of nothing; only the
columns named are read, whatever the others are called; an empty table has no nodes and no proofs; values may be of any length.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small, stash

#: Children of a node.
ARITY = 16
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """H: the lowercase hex sha256 of the parts one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(values: Sequence[Column]) -> Column:
    """H of a row's values, each as its UTF-8 length, a colon and itself, or a dash if null."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(part, values))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with lo, their rank by ``order`` among those of equal ``tree``, hi (lo + 1) and n, the number of these."""
    at = F.monotonically_increasing_id()
    placed = stash(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("_at", at), "placed")
    part = F.shiftright("_at", 33).alias("_part")
    runs = placed.groupBy("tree", part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(w).alias("n"))
    runs = small(stash(runs, "runs"))
    lo = F.col("_at") + F.col("_shift")
    out = placed.withColumn("_part", part).join(runs, ["tree", "_part"])
    return out.select(*rows.columns, lo.alias("lo"), (lo + 1).alias("hi"), "n")


@dataclass(frozen=True)
class Tree:
    """Nodes by level; those of level 0 are the leaves (tree, lo, hi, n, hash and what else they carry)."""

    levels: list[DataFrame]

    @property
    def roots(self) -> DataFrame:
        """tree and hash of each tree's root: the node that covers all its n leaves."""
        return reduce(DataFrame.unionByName, [df.filter("hi - lo = n").filter(F.col("n") > (ARITY ** (i - 1) if i else 0)).select("tree", "hash") for i, df in enumerate(self.levels)])


def grow(leaves: DataFrame) -> Tree:
    """All levels above the leaves; each is written, a sixteenth of the one below."""
    levels, width = [leaves], 1
    most = leaves.agg(F.max("n")).first()[0] or 0
    while width < most:
        kids = levels[-1].filter(F.col("n") > width).groupBy("tree", "n", F.floor(F.col("lo") / (width * ARITY)).alias("bucket"))
        nodes = kids.agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "hash"))).alias("kids"))
        width *= ARITY
        nodes = nodes.select("tree", "n", "bucket", "kids", F.array_min("kids.lo").alias("lo"), F.array_max("kids.hi").alias("hi"), digest(F.concat_ws("", "kids.hash")).alias("hash"))
        levels.append(stash(nodes, f"level{len(levels)}"))
    return Tree(levels)


def _join(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def attach(children: DataFrame, parents: DataFrame, width: int, carried: Sequence[str]) -> DataFrame:
    """Children with the path and the ``carried`` columns of the parent whose interval contains theirs: its bucket on a level of this width.

    What the parent's interval has beside the child's is the siblings: they head the path, left and right apart.
    """
    right = parents.select(F.col("tree").alias("_tree"), F.col("bucket").alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("kids").alias("_kids"), "path", *carried)
    bucket = F.floor(F.col("lo") / width) == F.col("_bucket")
    both = children.join(right, (F.col("tree") == F.col("_tree")) & bucket & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
    before = _join(F.transform(F.filter("_kids", lambda k: k["hi"] <= F.col("lo")), lambda k: k["hash"]))
    after = _join(F.transform(F.filter("_kids", lambda k: k["lo"] >= F.col("hi")), lambda k: k["hash"]))
    here = F.array(F.struct(before.alias("left"), after.alias("right")))
    return both.select(*children.columns, F.concat(here, "path").alias("path"), *carried)


def paths(tree: Tree, above: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Leaves with path: the siblings at each level from their own up, then the path of their tree's root from ``above``.

    ``above`` has tree, path and the ``carried`` columns for each tree.
    """
    top = small(stash(above.select("tree", "path", *carried), "above"), 100_000)
    known = None
    for i in range(len(tree.levels) - 1, -1, -1):
        nodes, width = tree.levels[i], ARITY**i
        own = nodes.filter(F.col("n") <= width).join(top, "tree").select(*nodes.columns, "path", *carried)
        known = own if known is None else own.unionByName(attach(nodes.filter(F.col("n") > width), known, width * ARITY, carried))
    return known


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's hash and its siblings lead to."""
    return F.aggregate(path, start, lambda x, p: digest(p["left"], x, p["right"]))


@dataclass(frozen=True)
class Manifest:
    """Trees of all groups, and the tree over their roots (named by ``tree`` '')."""

    groups: Tree
    top: Tree

    def nodes(self) -> DataFrame:
        """The manifest itself: tree, level, lo, hi and hash of every node, the roots' tree last."""
        out = [df.select("tree", F.lit(i).alias("level"), "lo", "hi", "hash") for t in (self.groups, self.top) for i, df in enumerate(t.levels)]
        return reduce(DataFrame.unionByName, out)

    def proofs(self) -> DataFrame:
        """Leaves with path, subroot and root."""
        root = self.top.roots.select(F.col("hash").alias("root"))
        none = self.top.roots.select("tree", F.lit(None).cast(_PATH).alias("path")).withColumn("path", F.coalesce("path", F.array().cast(_PATH)))
        subroots = paths(self.top, none, ()).select(F.col("of").alias("tree"), "path", F.col("hash").alias("subroot"))
        return paths(self.groups, subroots.crossJoin(F.broadcast(root)), ("subroot", "root"))


def build(docs: DataFrame, columns: Sequence[str], key: str, group: str, seen: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of docs: leaves over ``columns``, ascending by ``key`` in a tree for each value of ``group``.

    With ``seen``, columns as they were found later, a leaf also carries ``seen``, its hash with these, where they differ.
    """
    now = [F.col(c) for c in columns]
    later = [(seen or {}).get(c, F.col(c)) for c in columns]
    same = reduce(lambda a, b: a & b, [a.eqNullSafe(b) for c, a, b in zip(columns, now, later, strict=True) if c in (seen or {})], F.lit(True))
    name = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))  # null first, and apart from every name
    rows = docs.select(F.col(key).alias("key"), name.alias("tree"), leaf(now).alias("hash"), F.when(~same, leaf(later)).alias("seen"))
    groups = grow(stash(ranked(stash(rows, "leaves"), ["key", "hash"]), "ranked"))
    roots = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "hash")
    return Manifest(groups, grow(stash(ranked(stash(roots, "roots"), ["of"]), "tops")))


def check(manifest: Manifest) -> DataFrame:
    """Every row's key, leaf, subroot, root, proof, and folded: the root that its leaf as seen leads to with the manifest's siblings."""
    rows = manifest.proofs()
    proof = F.concat_ws("", F.flatten(F.transform("path", lambda p: F.array(p["left"], p["right"]))))
    folded = fold(F.coalesce("seen", "hash"), F.col("path"))
    return rows.select("key", F.col("hash").alias("leaf"), "subroot", "root", proof.alias("proof"), folded.alias("folded"))


def lowered(text: Column, key: Column) -> Column:
    """The contract's tampering: where 5 divides the key's CRC-32, A-Z become a-z."""
    chosen = F.crc32(key.cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(text)


def digests(checked: DataFrame) -> DataFrame:
    """Contract columns of check()'s result."""
    return checked.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", digest(F.col("proof")).alias("proof_sha256"), F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
