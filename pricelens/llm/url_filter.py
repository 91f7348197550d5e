"""URL filter: rules, and for other URLs the ratio of two character language models, with DataFrame functions only.

The models are variable-order Markov models of host and path, one of URLs that the rules allow, one of those they block: the
probability of a character is that of the longest context seen, mixed with that of the context shorter by one, down to a uniform
one (BETA is the weight of the shorter context). They are counted over all different URLs that a rule judges, but for those held
out. A URL's score is the logarithm of the ratio of its two likelihoods, by character. The cut is calibrated on the URLs held out:
where both classes' scores are equally many standard deviations away.

Defined results: a null URL or one without :// has an empty host and path; an empty text scores 0; without labelled URLs of
both kinds every score is 0 and the verdict is allow; a score at the cut is allowed; repeated rows give a row each; URLs of any
length are scored whole; only the columns named are read, whatever the others are called; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stash

#: (verdict, host, path) of the rules of the queries.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Contexts of at most so many characters.
ORDER = 3
BETA = 2.0
#: Size of the uniform distribution below all contexts.
ALPHABET = 256
#: Labelled URLs whose md5 starts with one of these digits are held out for calibration.
HELD_OUT = ("0", "1", "2")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START = "\x02" * ORDER
_CLASSES = ("allow", "block")


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(u, pattern, 1), _UPPER, _LOWER), F.regexp_extract(u, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and path joined) and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _chars(df: DataFrame) -> DataFrame:
    """A row for each character of text: the grams of 1..ORDER+1 characters that end in it, as g1.., with contexts h1..."""
    padded = F.concat(F.lit(_START), F.col("text"))
    df = df.filter("text <> ''").withColumn("_p", padded).withColumn("_i", F.explode(F.sequence(F.lit(1), F.length("text"))))
    gram = lambda end, n: F.substring(F.col("_p"), (end - n + 1), F.lit(n))
    end = F.col("_i") + ORDER
    cols = {f"g{n}": gram(end, n) for n in range(1, ORDER + 2)} | {f"h{n}": gram(end - 1, n) for n in range(1, ORDER + 1)}
    return df.withColumns(cols).drop("_p", "_i")


def fit(labelled: DataFrame) -> DataFrame:
    """gram, and for each class n_<class> (times it occurs) and c_<class> (times it occurs as a context)."""
    chars = _chars(labelled)
    grams = chars.select("verdict", F.explode(F.array(*[F.col(f"g{n}") for n in range(1, ORDER + 2)])).alias("gram"), F.lit(1).alias("n"), F.lit(0).alias("c"))
    contexts = chars.select("verdict", F.explode(F.array(F.lit(""), *[F.col(f"h{n}") for n in range(1, ORDER + 1)])).alias("gram"), F.lit(0).alias("n"), F.lit(1).alias("c"))
    total = lambda x, k: F.sum(F.when(F.col("verdict") == k, F.col(x)).otherwise(0)).alias(f"{x}_{k}")
    return grams.union(contexts).groupBy("gram").agg(*[total(x, k) for x in ("n", "c") for k in _CLASSES])


def ratios(chars: DataFrame, model: DataFrame) -> DataFrame:
    """The longest gram g<ORDER+1> and its log-ratio r of allow to block, for each such gram among the characters.

    The shorter grams and all contexts are parts of the longest gram, so the models are looked up once for each different one.
    """
    longest = f"g{ORDER + 1}"
    keys = [f"g{n}" for n in range(1, ORDER + 2)] + [f"h{n}" for n in range(1, ORDER + 1)]
    rows, known = chars.select(*keys).distinct(), small(model)
    for key in keys:
        side = known.select(F.col("gram").alias(key), *[F.col(f"{x}_{k}").alias(f"{x}_{k}_{key}") for x in ("n", "c") for k in _CLASSES])
        rows = rows.join(side, key, "left")
    top = model.filter("gram = ''").first()
    ratio = F.lit(0.0)
    for sign, k in ((1.0, "allow"), (-1.0, "block")):
        p = F.lit(1.0 / ALPHABET)
        for n in range(1, ORDER + 2):
            seen = F.lit(float(top[f"c_{k}"]) if top else 0.0) if n == 1 else F.coalesce(F.col(f"c_{k}_h{n - 1}"), F.lit(0))
            p = (F.coalesce(F.col(f"n_{k}_g{n}"), F.lit(0)) + BETA * p) / (seen + BETA)
        ratio = ratio + sign * F.log(p)
    return rows.select(longest, ratio.alias("r"))


def score(texts: DataFrame, model: DataFrame) -> DataFrame:
    """text and score of different texts: the mean over characters of the log-ratio of allow to block."""
    chars = _chars(texts.select("text"))
    rows = chars.select("text", f"g{ORDER + 1}").join(small(stash(ratios(chars, model), "ratios")), f"g{ORDER + 1}")
    return rows.groupBy("text").agg((F.sum("r") / F.count("r")).alias("score"))


def cut(scored: DataFrame) -> float:
    """The calibrated threshold for scored, held-out rows with a verdict; 0 where a class is missing."""
    by = {r["verdict"]: r for r in scored.groupBy("verdict").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s")).collect()}
    if any(k not in by or by[k]["m"] is None for k in _CLASSES):
        return 0.0
    a, b = by["allow"], by["block"]
    spread = a["s"] + b["s"]
    return (a["m"] * b["s"] + b["m"] * a["s"]) / spread if spread > 0 else (a["m"] + b["m"]) / 2


def judge(pages: DataFrame, url: str = "url", id_col: str = "page_id", rules=RULES) -> DataFrame:
    """id, host, path, rule, verdict and score of every page."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select(id_col, "host", "path", name.alias("rule"), verdict.alias("ruled"), F.concat("host", "path").alias("text"))
    # Each different text is scored once; they are dealt out, as a text has many characters.
    width = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = rows.filter("text <> ''").groupBy("text").agg(F.max("ruled").alias("verdict"), F.count(F.lit(1)).alias("n")).repartition(width)
    texts = stash(texts.withColumn("held", F.substring(F.md5(F.concat(F.lit("held "), "text")), 1, 1).isin(*HELD_OUT)), "urls")
    labelled, held = texts.filter("verdict is not null"), F.col("held")
    model = stash(fit(labelled.filter(~held)), "model")
    both = labelled.filter(~held).select("verdict").distinct().count() == len(_CLASSES)
    scored = score(texts, model) if both else texts.select("text", F.lit(0.0).alias("score"))
    scored = stash(scored, "scores")
    least = cut(scored.join(labelled.filter(held), "text")) if both else 0.0
    # Texts with more than their share of a quarter of a partition, 4 * width of them at most, meet their pages by broadcast. These pages
    # and those without a text are spread by a salt that no score has.
    often = F.broadcast(texts.filter(F.col("n") * (4 * width) > rows.count()).select("text"))
    met = rows.join(F.broadcast(scored.join(often, "text").withColumnRenamed("score", "known")), "text", "left")
    open_ = (F.col("text") != "") & F.col("known").isNull()
    met = met.withColumn("salt", F.when(open_, 0).otherwise(1 + F.pmod(F.xxhash64(id_col, "path"), F.lit(1 << 20))))
    rest = small(scored.withColumn("salt", F.lit(0).cast("bigint")))
    out = met.join(rest, ["text", "salt"], "left").withColumn("score", F.coalesce("known", "score", F.lit(0.0)))
    method = F.when((F.col("score") >= least) | (F.col("text") == ""), F.lit("allow")).otherwise(F.lit("block"))
    return out.select(id_col, "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "score")
