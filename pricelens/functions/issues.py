"""Rules that fire on a line, and what that means for it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


#: What stands between names while they are put together; no name holds it.
_BETWEEN = "\x01"


def joined(labels: Sequence[Column]) -> Column:
    """Those labels that aren't null, in order, as one text; empty without any. Like split_labels() it needs no function by element,
    which would be interpreted, and names no label twice, so that each is evaluated once.
    """
    return F.concat_ws(_BETWEEN, *labels)


def split_labels(text: Column) -> Column:
    """The labels of joined() texts put together by joined(), as an array."""
    return F.array_remove(F.split(text, _BETWEEN), "")


def present(labels: Sequence[Column]) -> Column:
    """Those labels that aren't null, in order."""
    return split_labels(joined(labels))


def fired(rules: Mapping[str, Column]) -> list[Column]:
    return [F.when(c, F.lit(name)) for name, c in rules.items()]


def collect_issues(rules: Mapping[str, Column], labels: Sequence[Column] = ()) -> Column:
    """The names of all rules whose condition holds, after those labels that aren't null."""
    return present([*labels, *fired(rules)])


def dq_status(issues: Column, handling: Mapping[str, Sequence[str]]) -> Column:
    """quarantine, warn, fixed or pass: the most severe handling of any issue."""
    out = F.lit("pass")
    for name, label in (("fix", "fixed"), ("warn", "warn"), ("quarantine", "quarantine")):
        out = F.when(F.arrays_overlap(issues, F.array(*[F.lit(x) for x in handling[name]])), F.lit(label)).otherwise(out)
    return F.when(F.size(issues) == 0, F.lit("pass")).otherwise(out)
