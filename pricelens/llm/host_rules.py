"""Quality rules by host, with DataFrame functions only.

Documents are measured one by one, their rule failures are summed by host, the hosts' failure rates are shrunk towards an
empirical beta prior, and the hosts' verdicts are joined back.

Defined results: a null text counts as empty and fails; a document without a host (null) belongs to no host and is judged by
its own text; repeated rows are measured and counted each; a rate at the limit exactly is kept; texts of any length are measured
whole; an empty table gives an empty table; other columns stay out of the way, as all working columns are projected away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stash

#: White space between words.
SPACE = r"[\x20\x09-\x0D]"
#: Limits of the rules; a document fails a rule beyond its limit.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_WORD = 1.0
MAX_DUP_LINES_PER_WORD = 0.1
WORD_LENGTH = (2.0, 15.0)
#: A host is rejected when its shrunk failure rate in any rule is above this.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (2.0, 1e6)

RULES = ("few_words", "repetitive", "symbols", "dup_lines", "word_length")


def _at(array: Column, i: Column) -> Column:
    return F.get(array, i)


def signals(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long) of each text.

    Repeated three-word windows are found without a shuffle: each window's hash and position are packed into one long, the
    longs sorted, neighbours of equal hash kept as suspects, and the suspects compared as text, so that colliding hashes
    change nothing.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(t, SPACE + "+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.select(
        *keys,
        words.alias("_words"),
        F.length(F.regexp_replace(t, SPACE + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    n = F.size("_words")
    df = df.select(
        *keys, "_words", "word_chars", "n_symbols", n.alias("_n"), F.ceil(F.log2(n + 1)).cast("int").alias("_bits"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    w = F.col("_words")
    packed = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 3),
        lambda i: F.call_function("shiftleft", F.xxhash64(_at(w, i), _at(w, i + 1), _at(w, i + 2)), F.col("_bits")).bitwiseOR(i.cast("long")),
    )
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_sorted", F.sort_array(F.when(F.col("_n") >= 3, packed).otherwise(none)))
    s, bits = F.col("_sorted"), F.col("_bits")
    high = lambda x: F.call_function("shiftrightunsigned", x, bits)
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    alike = lambda x, y: F.coalesce(high(x) == high(y), F.lit(False))
    suspects = F.transform(
        F.filter(s, lambda x, i: alike(x, _at(s, i - 1)) | alike(x, _at(s, i + 1))), lambda x: x.bitwiseAND(mask).cast("int")
    )
    df = df.withColumn("_suspects", suspects)
    window = lambda p: F.concat_ws(" ", _at(w, p), _at(w, p + 1), _at(w, p + 2))
    df = df.withColumn("_windows", F.array_sort(F.transform("_suspects", lambda p: F.struct(window(p).alias("w"), p.alias("p")))))
    v = F.col("_windows")
    same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
    repeated = F.sort_array(
        F.transform(F.filter(v, lambda x, i: same(x, _at(v, i - 1)) | same(x, _at(v, i + 1))), lambda x: x["p"])
    )
    df = df.withColumn("_repeated", repeated)
    r = F.col("_repeated")
    # Windows that overlap share words: each adds the distance to the next one, three words at most.
    covered = F.aggregate(
        F.zip_with(r, F.slice(r, F.lit(2), F.greatest(F.size(r), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))),
        F.lit(0), lambda acc, x: acc + x,
    )
    measured = F.struct(
        F.col("_n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", covered.cast("long").alias("n_repeat_words")
    )
    # A generated column is a boundary: filters on it aren't moved below, where they would repeat all this work for each use.
    return df.select(*keys, F.explode(F.array(measured)).alias("_measured")).select(*keys, "_measured.*")


def failures() -> dict[str, Column]:
    """Each rule as a condition on the columns of signals()."""
    n = F.col("n_words")
    mean = F.try_divide(F.col("word_chars"), n)
    return {
        "few_words": n < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
        "symbols": F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n,
        "dup_lines": F.col("n_dup_lines") > MAX_DUP_LINES_PER_WORD * n,
        "word_length": F.coalesce((mean < WORD_LENGTH[0]) | (mean > WORD_LENGTH[1]), F.lit(False)),
    }


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """Documents, and each rule's failures, of every host that isn't null."""
    fails = [F.sum(c.cast("long")).alias(f"fails_{r}") for r, c in failures().items()]
    return measured.filter(F.col(host).isNotNull()).groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"), *fails)


def host_verdicts(rates: DataFrame, host: str = "source") -> DataFrame:
    """host, each rule's shrunk rate and host_rejected.

    The prior of a rule is fitted by moments: its mean m is the share of all documents that fail, and its weight is
    m (1 - m) / v - 1, where v is the spread of the hosts' rates beyond what chance gives (the largest weight if there is
    none). A host's rate is then (fails + m weight) / (documents + weight).
    """
    n = F.col("n_docs")
    total = rates.agg(F.sum(n).alias("n"), F.count(F.lit(1)).alias("hosts"), *[F.sum(f"fails_{r}").alias(r) for r in RULES]).first()
    if not total["n"]:
        return rates.select(host, *[F.lit(0.0).alias(f"rate_{r}") for r in RULES], F.lit(False).alias("host_rejected"))
    means = {r: total[r] / total["n"] for r in RULES}
    spread = rates.agg(*[F.sum(n * F.pow(F.col(f"fails_{r}") / n - F.lit(m), 2.0)).alias(r) for r, m in means.items()]).first()
    shrunk = []
    for r, m in means.items():
        between = (spread[r] - (total["hosts"] - 1) * m * (1 - m)) / total["n"]
        low, high = PRIOR_WEIGHT
        weight = min(max(m * (1 - m) / between - 1, low), high) if between > 0 else high
        shrunk.append(((F.col(f"fails_{r}") + m * weight) / (n + weight)).alias(f"rate_{r}"))
    out = rates.select(host, *shrunk)
    return out.withColumn("host_rejected", F.greatest(*[F.col(f"rate_{r}") for r in RULES]) > MAX_HOST_RATE)


def judge(measured: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """measured with base_failed, host_rejected and kept: the base rules' verdict, else the host's."""
    v = small(stash(hosts.select(F.col(host).alias("_host"), "host_rejected"), "hosts"))
    out = measured.join(v, measured[host] == v["_host"], "left").drop("_host")
    f = failures()
    base = f["few_words"] | f["repetitive"]
    return out.select(
        *measured.columns, base.alias("base_failed"), F.coalesce("host_rejected", F.lit(False)).alias("host_rejected"),
    ).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def host_quality(docs: DataFrame, host: str = "source", text: str = "text", keys: list[str] | None = None) -> DataFrame:
    """Signals and verdict of every document. The measured table (no texts) is written once and used for both passes."""
    keys = ["doc_id", host] if keys is None else keys
    measured = stash(signals(docs, keys, text), "signals")
    return judge(measured, host_verdicts(host_rates(measured, host), host), host)


def keep_good(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The documents that are kept, with the columns they came with.

    Measuring costs far more than writing: the documents are written once beside what was measured, and read for the hosts' rates
    (the measured columns alone) and for the verdicts.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col(host).alias("_host_of"), F.col(text).alias("_text_of"))
    measured = stash(signals(rows, ["_row", "_host_of"], "_text_of"), "signals")
    judged = judge(measured, host_verdicts(host_rates(measured, "_host_of"), "_host_of"), "_host_of")
    return judged.filter("kept").select("_row.*")
