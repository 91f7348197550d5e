"""Column functions that read untrusted text: prices, names, times, flags, keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that regular expressions' \s leaves out.
WIDE_SPACE = r"[\s\x{00A0}\x{202F}]+"

# Words of price texts that are no price, and of those that are a range.
ON_REQUEST = "(?i)request|demande|咨询"
FROM_OR_RANGE = r"(?i)from|partir|\d\s*[-–]\s*\d"

#: UTF-8 lead bytes of two- and three-byte characters that were read as Latin-1, with what follows them.
MOJIBAKE = r"[\x{00C2}-\x{00C3}][\x{0080}-\x{00BF}]|[\x{00E4}-\x{00E9}][\x{0080}-\x{00BF}]{2}"
# What makes a text no UTF-8 that was read as Latin-1: a wider character, a lead byte without what must follow, a byte that must
# follow without its lead, or a sequence that UTF-8 forbids. Each alternative looks at four characters at most.
_UNREPAIRABLE = (
    r"[^\x{0000}-\x{00FF}]|[\x{00C0}\x{00C1}\x{00F0}-\x{00FF}]|[\x{00C2}-\x{00DF}](?![\x{0080}-\x{00BF}])|[\x{00E0}-\x{00EF}](?![\x{0080}-\x{00BF}]{2})"
    r"|(?<![\x{00C2}-\x{00EF}])(?<![\x{00E0}-\x{00EF}][\x{0080}-\x{00BF}])[\x{0080}-\x{00BF}]|\x{00E0}[\x{0080}-\x{009F}]|\x{00ED}[\x{00A0}-\x{00BF}]"
)


def lookup(key: Column, mapping: Mapping[str, object], default: object = None) -> Column:
    """The mapping's value for a key, as a literal map that needs no join."""
    if not mapping:
        return F.lit(default)
    pairs = F.create_map(*[F.lit(x) for item in mapping.items() for x in item])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, F.lit(default))


# Fixed value: what stands for a null part of a key, so that keys equal those of tables built elsewhere.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts as text, joined by '-'; a null part has a token of its own."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts]))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def ascii_digits(c: Column) -> Column:
    """Full-width and Arabic-Indic digits as ASCII ones."""
    digits = "".join(chr(zero + i) for zero in (0xFF10, 0x0660) for i in range(10))
    return F.translate(F.trim(c), digits, "0123456789" * 2)


def price_text_class(raw: Column) -> Column:
    """missing, on_request, from_or_range, no_digits or numeric, the first that applies."""
    return _class_of(raw, ascii_digits(raw))


def _class_of(raw: Column, text: Column) -> Column:
    return (
        F.when(raw.isNull(), "missing")
        .when(text.rlike(ON_REQUEST), "on_request")
        .when(text.rlike(FROM_OR_RANGE), "from_or_range")
        .when(~text.rlike("[0-9]"), "no_digits")
        .otherwise("numeric")
    )


def unpriced(raw: Column) -> dict[str, Column]:
    """The issues of a price text that price_text_class() has without the price: each is tested alone, so one costs no other's patterns."""
    text = ascii_digits(raw)
    asked = text.rlike(ON_REQUEST)
    return {"price_on_request": asked, "price_from_or_range": ~asked & text.rlike(FROM_OR_RANGE)}


def _plain_number(c: Column, units: Column) -> Column:
    """Digits and marks with at most a decimal dot; null where dots and commas can't be told apart.

    The last of both marks is the decimal one; commas before groups of three are thousands; so is a dot before three digits,
    unless the currency has three decimals, when nothing is guessed.
    """
    digits, dots, commas = c["digits"], c["dots"], c["commas"]
    no_commas, no_dots = F.replace(digits, F.lit(","), F.lit("")), F.replace(digits, F.lit("."), F.lit(""))
    both = F.when(c["dot_last"], no_commas).otherwise(F.replace(no_dots, F.lit(","), F.lit(".")))
    only_commas = F.when(digits.rlike(r"^\d{1,3}(,\d{3})+$"), no_commas).when((commas == 1) & c["two_end"], F.replace(digits, F.lit(","), F.lit(".")))
    one_dot = F.when(c["three_end"] & (units != 3), no_dots).when(c["two_end"], digits)
    return (
        F.when((dots > 0) & (commas > 0), both)
        .when(commas > 0, only_commas)
        .when(dots > 1, F.when(digits.rlike(r"^\d{1,3}(\.\d{3})+$"), no_dots))
        .when(dots == 1, one_dot)
        .otherwise(digits)
    )


def read_prices(df: DataFrame, raw: str, minor_units: Column, price: str = "price_local", issue: str = "price_parse_issue") -> DataFrame:
    """df with a price text read as decimal(18,2), null unless it is one number, and what was noteworthy about it, null for a plain
    number.

    Each step is a projection of its own that the next one refers to, so that every expression is evaluated once a row.
    """
    c = F.col
    df = df.withColumns({"_text": ascii_digits(c(raw)), "_units": minor_units})
    df = df.withColumns({"_kind": _class_of(c(raw), c("_text")), "_digits": F.regexp_replace("_text", "[^0-9.,]", "")})
    count = lambda mark: F.length("_digits") - F.length(F.translate("_digits", mark, ""))
    decimals = F.length(F.substring_index(F.translate("_digits", ",", "."), ".", -1))
    df = df.withColumn("_marks", F.struct(count(".").alias("dots"), count(",").alias("commas"), decimals.alias("decimals")))
    mark = F.substring(c("_digits"), -(c("_marks.decimals") + 1), F.lit(1))
    marked = c("_marks.dots") + c("_marks.commas") > 0
    shape = F.struct(
        c("_digits").alias("digits"), c("_marks.dots").alias("dots"), c("_marks.commas").alias("commas"), (marked & (mark == ".")).alias("dot_last"),
        (marked & c("_marks.decimals").between(1, 2)).alias("two_end"), (marked & (mark == ".") & (c("_marks.decimals") == 3)).alias("three_end"),
    )
    df = df.withColumn("_shape", shape)
    x = c("_shape")
    df = df.withColumn(price, F.when(c("_kind") == "numeric", _plain_number(x, c("_units"))).try_cast("decimal(18,2)"))
    three_after_dot = (x["dots"] == 1) & x["three_end"]
    european = ((x["dots"] > 0) & (x["commas"] > 0) & ~x["dot_last"]) | ((x["dots"] == 0) & (x["commas"] == 1) & x["two_end"])
    label = (
        F.when(c("_kind") == "on_request", "price_on_request")
        .when(c("_kind") == "from_or_range", "price_from_or_range")
        .when(c("_kind") != "numeric", "price_unparseable")
        .when(c(price).isNull(), F.when(three_after_dot, "price_ambiguous_separator").otherwise("price_unparseable"))
        .when((c(price) == 0) | x["digits"].rlike("^9{6,}$"), "price_placeholder")
        .when(c("_text") != F.trim(c(raw)), "price_non_ascii_digits")
        .when(c("_text").rlike(r"[^0-9.,\s\x{00A0}\x{202F}]"), "price_currency_symbol")
        .when(european, "price_eu_decimal_format")
        .when(x["commas"] > 0, "price_us_thousands_separator")
        .when(three_after_dot, "price_dot_thousands_ambiguous")
        .when(x["dots"] > 0, "price_trailing_decimals")
    )
    return df.withColumn(issue, label).drop("_text", "_units", "_kind", "_digits", "_marks", "_shape")


def unescape_html(c: Column) -> Column:
    # The entities that crawlers leak.
    for entity, char in (("&amp;", "&"), ("&nbsp;", " "), ("&#39;", "'"), ("&quot;", '"'), ("&#124;", "|")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def has_mojibake(c: Column) -> Column:
    return c.rlike(MOJIBAKE)


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as Latin-1 as it was meant; text that isn't such as a whole stays as it is."""
    safe = c.rlike(MOJIBAKE) & ~c.rlike(_UNREPAIRABLE)
    return F.when(safe, F.decode(F.encode(F.when(safe, c), "ISO-8859-1"), "UTF-8")).otherwise(c)


def clean_name(c: Column) -> Column:
    """White space of every kind collapsed and trimmed; null if nothing is left."""
    return blank_to_null(F.regexp_replace(c, WIDE_SPACE, " "))


def epoch_to_ts(c: Column) -> Column:
    """Epoch seconds (below 1e11) or milliseconds as a timestamp."""
    n = c.try_cast("bigint")
    return F.timestamp_millis(F.when(n < 100_000_000_000, n * 1000).otherwise(n))


def text_boolean(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low == "true", True).when(low == "false", False)


def normalise_sku(c: Column) -> Column:
    return F.nullif(F.upper(F.regexp_replace(c, r"[\s\-]", "")), F.lit(""))


def extract_tag(details: Column, labels: Column, key: str, pattern: str, every: bool = False) -> Column:
    """A tag from the details map, else the first label that matches (or all of them, joined by |)."""
    matching = F.filter(labels, lambda x: F.lower(x).rlike(pattern))
    found = F.nullif(F.array_join(matching, "|"), F.lit("")) if every else F.try_element_at(matching, F.lit(1))
    return F.coalesce(F.try_element_at(details, F.lit(key)), found)


def normalise_tag(c: Column, prefix: str) -> Column:
    """Trimmed lower case; a prefix that lost its last letter gets it back."""
    return F.regexp_replace(F.lower(F.trim(c)), f"^{prefix[:-1]}_", f"{prefix}_")
