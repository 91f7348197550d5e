"""Many rules at once: patterns are tried only where a literal that they need occurs."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

with warnings.catch_warnings():
    warnings.simplefilter("ignore", DeprecationWarning)
    from re import _constants as _C
    from re import _parser as _P

#: Characters of the keys that literals are indexed by.
GRAM = 3


def needed_literals(pattern: str) -> frozenset[str] | None:
    """Literals of at least GRAM characters of which every match of the pattern contains one; None if there are none that are sure.

    Only what both this parser and Java read alike counts: a pattern with flags, references, lookarounds or anything else unknown has
    none.
    """
    try:
        tree = _P.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return None
    if tree.state.flags & ~re.UNICODE or "\\Q" in pattern or "&&" in pattern:
        return None
    return _of_sequence(list(tree))


def _of_sequence(items: list) -> frozenset[str] | None:
    """The best set among the runs of characters and the groups that all must match."""
    found: list[frozenset[str]] = []
    run = ""
    for kind, arg in [*items, (_C.ANY, None)]:
        if kind is _C.LITERAL:
            run += chr(arg)
            continue
        if len(run) >= GRAM:
            found.append(frozenset([run]))
        run = ""
        inner = _of_group(kind, arg)
        if inner:
            found.append(inner)
    return max(found, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def _of_group(kind, arg) -> frozenset[str] | None:
    if kind is _C.SUBPATTERN and not arg[1] and not arg[2]:
        return _of_sequence(list(arg[3]))
    if kind in (_C.MAX_REPEAT, _C.MIN_REPEAT) and arg[0] >= 1:
        return _of_sequence(list(arg[2]))
    if kind is _C.BRANCH:
        sides = [_of_sequence(list(x)) for x in arg[1]]
        return frozenset().union(*sides) if all(sides) else None
    return None


def apply_rule_table(df: DataFrame, rules: DataFrame, key: str, exact: Sequence[str] = ("sku",)) -> DataFrame:
    """products.apply_rules() for rules in a table: rule_id, priority, match_field, pattern, category.

    Fields in ``exact`` meet their rules by value. Other patterns are indexed by the first GRAM characters of the literals that they
    need, fields by all their stretches of that length, and a pattern is tried where the two meet and the literal is there. Patterns
    that need no literal are tried on every row. Of the rules that match, the one with the lowest priority counts, of equal ones that
    with the least id. The table is reference data and comes to the driver; ``key`` is unique in df.
    """
    spark = df.sparkSession
    table = [(r["rule_id"], int(r["priority"]), r["match_field"], r["pattern"], r["category"]) for r in rules.collect()]
    columns = "rule_id string, priority int, match_field string, pattern string, category string"
    table = [r for r in table if r[2] in df.columns and r[3] is not None]
    indexed, loose = [], []
    for r in table:
        literals = None if r[2] in exact else needed_literals(r[3])
        indexed += [(*r, x, x[:GRAM]) for x in literals or ()]
        loose += [r] if literals is None and r[2] not in exact else []
    fields = sorted({r[2] for r in table})
    cells = df.select(F.col(key).alias("_key"), F.explode(F.array(*[F.struct(F.lit(f).alias("match_field"), F.col(f).cast("string").alias("_value")) for f in fields])).alias("_x")) if fields else None
    hits = []
    if fields:
        cells = cells.select("_key", "_x.*").filter("_value is not null")
        whole = spark.createDataFrame([r for r in table if r[2] in exact], columns)
        hits.append(cells.join(F.broadcast(whole), (cells["match_field"] == whole["match_field"]) & (F.col("_value") == F.col("pattern"))).drop(whole["match_field"]))
        grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length("_value") - GRAM + 1, F.lit(1))), lambda i: F.substr("_value", i, F.lit(GRAM))))
        index = F.broadcast(spark.createDataFrame(indexed, columns + ", literal string, gram string"))
        near = cells.withColumn("gram", F.explode(grams)).join(index, ["match_field", "gram"])
        near = near.filter(F.contains("_value", F.col("literal"))).filter(F.rlike("_value", F.col("pattern")))
        hits.append(near.select(hits[0].columns))
        rest = F.broadcast(spark.createDataFrame(loose, columns))
        hits.append(cells.join(rest, "match_field").filter(F.rlike("_value", F.col("pattern"))).select(hits[0].columns))
        found = hits[0].union(hits[1]).union(hits[2])
        best = found.groupBy("_key").agg(F.min(F.struct("priority", "rule_id", "match_field", "category")).alias("_r"))
        out = df.join(best, df[key].eqNullSafe(best["_key"]), "left")
    else:
        out = df.withColumn("_r", F.lit(None).cast("struct<priority:int,rule_id:string,match_field:string,category:string>"))
    return out.select(*[df[c] for c in df.columns], F.col("_r.rule_id").alias("categorized_by_rule"), F.col("_r.match_field").alias("categorized_on"), F.col("_r.category").alias("rule_category"))
