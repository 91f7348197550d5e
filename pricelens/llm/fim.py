"""Fill-in-the-middle: texts cut at two word boundaries and written with the middle last.

regexp_count() gives a text's number of units; two of them, drawn by a hash of the row's key, become counted possessive
quantifiers in a pattern of the row's own, so that one match captures prefix, middle and suffix. Possessive groups never
backtrack and Java walks them in a loop, so neither time nor stack depends on more than the text's length. All of it are DataFrame
functions.

Defined results: a null text counts as empty; an empty text and one that holds a sentinel stay as they are (form plain); a null key is
drawn for as if its decimal form were empty; rows are handled one by one, so repeated rows and ties give a row each; other columns are
passed on only if named in ``keep``, whatever they are called; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit is a word with the white space before it, or the white space at a text's end.
SPACE = r"\x20\x09-\x0D"
UNIT = rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
# The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_ANY = f"{PREFIX}|{SUFFIX}|{MIDDLE}"


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of '<seed>:<key>'."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def cut_pattern(first: Column, then: Column) -> Column:
    """The pattern whose groups are the first units, the units then and the rest of a text."""
    times = lambda n: F.concat(F.lit(rf"((?:{UNIT}){{"), n.cast("string"), F.lit("}+)"))
    return F.concat(F.lit(r"(?s)\A"), times(first), times(then), F.lit(r"(.*)\z"))


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep``, and n_units, fim_form (plain, psm or spm) and fim_output.

    Of the texts that can be cut, about ``percent`` are; of these about ``spm_percent`` have the suffix first.
    """
    keep = [key] if keep is None else keep
    held = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in zip(keep, held, strict=True)], F.coalesce(F.col(text), F.lit("")).alias("_text"), *[d.alias(f"_h{i}") for i, d in enumerate(draws(F.col(key), seed), 1)])
    rows = rows.withColumn("n_units", F.regexp_count("_text", F.lit(UNIT)).cast("bigint"))
    a, b = F.col("_h1") % (F.col("n_units") + 1), F.col("_h2") % (F.col("n_units") + 1)
    plain = (F.col("_text") == "") | (F.col("_h3") % 100 >= percent) | F.col("_text").rlike(_ANY)
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.withColumns({"_first": F.least(a, b), "_then": F.abs(a - b), "fim_form": form})
    written = F.when(F.col("fim_form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("fim_form") == "plain", F.col("_text")).otherwise(F.regexp_replace("_text", cut_pattern(F.col("_first"), F.col("_then")), written))
    return rows.select(*held, "n_units", "fim_form", output.alias("fim_output")).toDF(*keep, "n_units", "fim_form", "fim_output")


def parts(output: Column, form: Column) -> dict[str, Column]:
    """prefix, middle and suffix of an output; nulls where the form is plain."""
    cut = F.split(output, _ANY, -1)
    psm, spm = form == "psm", form == "spm"
    return {
        "prefix": F.when(psm, F.get(cut, F.lit(1))).when(spm, F.get(cut, F.lit(2))),
        "middle": F.when(psm | spm, F.get(cut, F.lit(3))),
        "suffix": F.when(psm, F.get(cut, F.lit(2))).when(spm, F.get(cut, F.lit(1))),
    }


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    found = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(found["prefix"], found["middle"], found["suffix"]))


def digests(cut: DataFrame) -> DataFrame:
    """Contract columns of transform()'s result."""
    output, form = F.col("fim_output"), F.col("fim_form")
    found = parts(output, form)
    return cut.select(
        "doc_id",
        F.col("n_units").alias("n"),
        form.alias("form"),
        F.char_length(found["prefix"]).cast("bigint").alias("prefix_chars"),
        F.char_length(found["middle"]).cast("bigint").alias("middle_chars"),
        F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(output, form).cast("binary"), 256).alias("restored_sha256"),
    )
