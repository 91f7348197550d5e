"""Raw lines to typed, repaired and flagged observations: one row in, one row out, nothing filtered."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelens.config import HANDLING, CrawlConfig
from pricelens.functions import text as t
from pricelens.functions.issues import collect_issues, dq_status, fired, joined, split_labels

#: Column and JSON path of the fields that are read as text.
FIELDS = {
    "object_id_raw": "objectID",
    "brand_id_raw": "brandId",
    "product_name_raw": "name",
    "product_url_raw": "url",
    "preview_url_raw": "previewUrl",
    "original_price_raw": "price.original_price",
    "original_currency_raw": "price.original_currency",
    "price_minor_units_raw": "price.price",
    "price_currency_label_raw": "price.currency",
    "http_status_raw": "status",
    "source_raw": "source",
    "market_raw": "market",
    "crawler_name": "crawlerName",
    "import_source": "importSource",
    "created_at_raw": "createdAt",
    "is_valid_raw": "isValid",
}
#: Column and JSON path of the lists of text.
LISTS = {"skus_raw": "skus", "categories_raw": "categories", "validation_errors_raw": "validationErrors"}
#: The whole line in one parse; numbers and booleans come as their text.
LINE = (
    "objectID string, brandId string, name string, url string, previewUrl string, "
    "price struct<original_price:string,original_currency:string,price:string,currency:string>, status string, source string, market string, "
    "crawlerName string, importSource string, createdAt string, isValid string, skus array<string>, categories array<string>, "
    "validationErrors array<string>, productDetails array<struct<key:string,value:string>>"
)


def with_line_id(lines: DataFrame) -> DataFrame:
    """Number identical lines of a file and give each line an id that no later load changes."""
    same = Window.partitionBy("source_file_name", F.xxhash64("raw_line"), "raw_line").orderBy("loaded_at")
    numbered = lines.withColumn("identical_line_ordinal", F.row_number().over(same))
    return numbered.withColumn("crawl_line_id", line_id())


def line_id(line: str = "raw_line") -> Column:
    return F.sha2(F.concat_ws("|", "source_file_name", line, F.col("identical_line_ordinal").cast("string")), 256)


# Where a file's name has its crawl date and export time, the suffix of a copy, and where a source has its market.
CRAWL_DATE = r"^[A-Za-z]+_(\d{4}-\d{2}-\d{2})_"
EXPORTED_AT = r"_(\d{13})_"
COPY_SUFFIX = r" \(\d+\)\."
SOURCE_MARKET = "_([A-Z]{3})$"


def parse_file_name(df: DataFrame, name: str = "source_file_name") -> DataFrame:
    """What a file's name says: decoded name, crawl date, export time, copy suffix. A name that can't be decoded is kept."""
    c = F.col(name)
    # Only a percent or a plus sign is changed by decoding. What a pattern doesn't find is null before it is cast: a cast that fails
    # costs an exception a line.
    decoded = F.when(c.rlike("[%+]"), F.coalesce(F.try_url_decode(c), c)).otherwise(c)
    found = lambda pattern: F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    return df.withColumns(
        {
            "delivered_file_name": decoded,
            "file_crawl_date": found(CRAWL_DATE).try_cast("date"),
            "file_exported_at": F.timestamp_millis(found(EXPORTED_AT).try_cast("bigint")),
            "file_name_has_copy_suffix": decoded.rlike(COPY_SUFFIX),
        }
    )


def extract_json_text(df: DataFrame, fields: Mapping[str, str], json_col: str = "raw_line") -> DataFrame:
    """JSON paths as text columns."""
    return df.withColumns({c: F.get_json_object(F.col(json_col), f"$.{path}") for c, path in fields.items()})


def kv_list_to_map(df: DataFrame, pairs: str, into: str) -> DataFrame:
    """An array of key/value structs as a map; of entries that repeat a key, or have none, the last one, or none, counts.

    Entries are sorted by key and place, so that each is compared with the next one only; the sorted array is a column of its own,
    as a lambda that refers to an expression would evaluate it again for each entry.
    """
    keyed = F.filter(F.transform(pairs, lambda x, i: F.struct(x["key"].alias("k"), i.alias("i"), x["value"].alias("v"))), lambda x: x["k"].isNotNull())
    df = df.withColumn("_pairs", F.array_sort(keyed))
    last = F.filter("_pairs", lambda x, i: ~F.coalesce(F.get(F.col("_pairs"), i + 1)["k"] == x["k"], F.lit(False)))
    return df.withColumn(into, F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"])))).drop("_pairs")


def parse_lines(df: DataFrame, json_col: str = "raw_line") -> DataFrame:
    """All fields of FIELDS, the lists and the details map, from one parse of the line."""
    parsed = df.withColumn("_j", F.from_json(json_col, LINE))
    parsed = kv_list_to_map(parsed, "_j.productDetails", "product_details_raw")
    return parsed.withColumns({c: F.col(f"_j.{p}") for c, p in (FIELDS | LISTS).items()}).drop("_j")


def parse_fields(df: DataFrame, fields: Sequence[str], json_col: str = "raw_line") -> DataFrame:
    """Some columns of parse_lines() without the details map, from one parse of the line that reads no other fields."""
    paths = {c: (FIELDS | LISTS)[c] for c in dict.fromkeys(fields)}
    if not paths:
        return df
    held = dict.fromkeys(p.split(".")[0] for p in paths.values())
    inner = [p.split(".")[1] for p in paths.values() if "." in p]
    kinds = {"price": "struct<" + ",".join(f"{x}:string" for x in inner) + ">"} | dict.fromkeys(LISTS.values(), "array<string>")
    parsed = df.withColumn("_j", F.from_json(json_col, ", ".join(f"{h} {kinds.get(h, 'string')}" for h in held)))
    return parsed.withColumns({c: F.col(f"_j.{p}") for c, p in paths.items()}).drop("_j")


def resolve_market(df: DataFrame) -> DataFrame:
    """The market field, else the suffix of the source."""
    suffix = F.nullif(F.regexp_extract("source_raw", SOURCE_MARKET, 1), F.lit(""))
    return df.withColumn("market", F.coalesce(t.blank_to_null(F.col("market_raw")), suffix))


def resolve_sku(df: DataFrame) -> DataFrame:
    """The first SKU of the list in its normal form, else the one inside the object id."""
    inside = F.regexp_extract("object_id_raw", "^[^_]+_[A-Za-z]{3}_(.+)$", 1)
    df = df.withColumns(
        {
            "sku_primary_raw": F.try_element_at("skus_raw", F.lit(1)),
            "sku_secondary": F.try_element_at("skus_raw", F.lit(2)),
            "sku_from_list": t.normalise_sku(F.try_element_at("skus_raw", F.lit(1))),
            "sku_from_object_id": t.normalise_sku(inside),
        }
    )
    return df.withColumn("sku", F.coalesce("sku_from_list", "sku_from_object_id"))


def resolve_currency(df: DataFrame, cfg: CrawlConfig) -> DataFrame:
    """A three-letter code as delivered, else the market's currency; and how many decimals it has."""
    code = F.upper(F.trim("original_currency_raw"))
    df = df.withColumn("expected_currency", t.lookup(F.col("market"), cfg.market_currency))
    df = df.withColumn("currency_code", F.when(code.rlike("^[A-Z]{3}$"), code).otherwise(F.col("expected_currency")))
    return df.withColumn("currency_minor_units", t.lookup(F.col("currency_code"), cfg.minor_units, 2))


#: What an observation's identity is made of.
IDENTITY = "objectID string, source string, market string, skus array<string>"


def with_identity(lines: DataFrame, cfg: CrawlConfig, json_col: str = "raw_line") -> DataFrame:
    """What compares the lines of a file, by one shuffle and one sort: line ids as by with_line_id(), and has_conflicting_duplicate.

    Equal lines are of one object, so lines that are dealt by file and object lie with their likes. Only the fields that make the object's
    id are parsed before; the rest is read from the line after the shuffle, which moves lines and no parsed columns.
    """
    j = F.col("_j")
    df = lines.withColumn("_j", F.from_json(json_col, IDENTITY))
    df = df.select(*lines.columns, j["objectID"].alias("object_id_raw"), j["source"].alias("source_raw"), j["market"].alias("market_raw"), j["skus"].alias("skus_raw"))
    df = resolve_sku(resolve_market(df)).select(*lines.columns, object_key(cfg).alias("_object"), F.xxhash64(json_col).alias("_hash"))
    same = Window.partitionBy("source_file_name", "_object", "_hash", json_col).orderBy("loaded_at")
    mates = Window.partitionBy("source_file_name", "_object").orderBy("_hash", json_col, "loaded_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn("identical_line_ordinal", F.row_number().over(same))
    df = df.withColumn("has_conflicting_duplicate", F.min("_hash").over(mates) != F.max("_hash").over(mates))
    return df.withColumn("crawl_line_id", line_id(json_col)).drop("_object", "_hash")


def object_key(cfg: CrawlConfig) -> Column:
    return F.concat_ws("_", F.lit(cfg.brand), "market", "sku")


def flag_conflicting_duplicates(df: DataFrame, file_col: str = "source_file_name", key: str = "object_id", line: str = "raw_line") -> DataFrame:
    """Whether a file has different lines for one object."""
    h = F.xxhash64(line)
    w = Window.partitionBy(file_col, key)
    return df.withColumn("has_conflicting_duplicate", F.min(h).over(w) != F.max(h).over(w))


def line_rules(cfg: CrawlConfig) -> dict[str, Column]:
    """The rules on a repaired line, beside the price's own label."""
    c = F.col
    name, given = c("product_name"), t.blank_to_null
    mixed = c("crawler_name") == cfg.mixed_case_crawler
    shouting = mixed & (name == F.upper(name)) & name.rlike("[A-Z].*[A-Z]")
    return {
        "price_numeric_type_drift": c("raw_line").rlike(r'"original_price":\s*-?[0-9]'),
        "missing_price_value": c("price_minor_units_raw").isNull(),
        "currency_code_notation": c("original_currency_raw") != c("currency_code"),
        "currency_market_mismatch": c("currency_code") != c("expected_currency"),
        "name_html_entity": c("product_name_raw").rlike(r"&(amp|nbsp|quot|#\d+);"),
        "name_whitespace_noise": c("product_name_unescaped") != name,
        "name_missing": name.isNull(),
        "name_case_drift": shouting | (~mixed & (name != F.lower(name))),
        "category_mojibake": c("had_mojibake"),
        "sku_format_variant": c("sku_primary_raw") != F.coalesce("sku_from_list", F.lit("")),
        "sku_recovered_from_object_id": c("sku_from_list").isNull() & c("sku_from_object_id").isNotNull(),
        "market_recovered_from_source": given(c("market_raw")).isNull(),
        "timestamp_epoch_seconds": c("created_at_raw").try_cast("bigint") < 100_000_000_000,
        "is_valid_as_string": c("raw_line").rlike(r'"isValid":\s*"'),
        "url_missing": given(c("product_url_raw")).isNull(),
        "preview_url_missing": given(c("preview_url_raw")).isNull(),
        "exact_duplicate_line": c("identical_line_ordinal") > 1,
        "conflicting_duplicate": c("has_conflicting_duplicate"),
        "non_product_page": c("sku").rlike("^(GIFTCARD|TEST)") | F.lower(name).rlike("gift card|test product"),
        "http_error_or_invalid": (c("http_status") != 200) | ~c("is_valid"),
        "is_valid_contradiction": (F.size("validation_errors") > 0) & c("is_valid"),
    }


# Columns of a staged observation, in order.
STAGED = (
    "crawl_line_id", "object_id", "sku", "sku_secondary", "market", "source_file_name", "delivered_file_name", "file_crawl_date",
    "file_exported_at", "file_name_has_copy_suffix", "loaded_at", "crawled_at", "product_name", "product_name_normalized", "product_url",
    "preview_url", "price_local", "currency_code", "expected_currency", "brand_macro_category", "brand_micro_category",
    "brand_super_micro_category", "top_category_label", "category_label", "product_category_label", "sub_category_label", "color",
    "color_id", "collection", "stock_status", "categories", "source_name", "crawler_name", "import_source", "http_status", "is_valid",
    "validation_errors", "object_id_raw", "product_name_raw", "original_price_raw", "original_currency_raw", "price_minor_units_raw",
    "created_at_raw", "price_parse_issue", "dq_issues", "dq_status",
)


def repair_lines(parsed: DataFrame, cfg: CrawlConfig) -> DataFrame:
    """Typed and repaired columns beside the raw ones, with identities, before the rules."""
    c = F.col
    df = resolve_currency(resolve_sku(resolve_market(parsed)), cfg)
    df = t.read_prices(df, "original_price_raw", c("currency_minor_units"))
    df = df.withColumns(
        {
            "product_name_unescaped": t.unescape_html(c("product_name_raw")),
            "categories": F.transform("categories_raw", t.repair_mojibake),
            "product_details": F.transform_values("product_details_raw", lambda k, v: t.repair_mojibake(v)),
            "had_mojibake": F.coalesce(t.has_mojibake(F.concat_ws("\n", "categories_raw", F.map_values("product_details_raw"))), F.lit(False)),
            "http_status": c("http_status_raw").try_cast("int"),
            "is_valid": t.text_boolean(c("is_valid_raw")),
            "validation_errors": F.coalesce("validation_errors_raw", F.array().cast("array<string>")),
            "crawled_at": t.epoch_to_ts(c("created_at_raw")),
            "object_id": object_key(cfg),
        }
    )
    details, labels, p = c("product_details"), c("categories"), cfg.tag_prefix
    tag = lambda key, pattern, every=False: t.normalise_tag(t.extract_tag(details, labels, key, pattern, every), p)
    detail = lambda key: F.try_element_at(details, F.lit(key))
    return df.withColumns(
        {
            "product_name": t.clean_name(c("product_name_unescaped")),
            "brand_macro_category": tag("macroCategory", f"^{p}_macro", True),
            "brand_micro_category": tag("microCategory", f"^{p}?_micro_"),
            "brand_super_micro_category": tag("superMicroCategory", f"^{p}?_super_micro_"),
            "top_category_label": F.coalesce(detail("topCategory"), F.try_element_at(labels, F.lit(1))),
            "category_label": F.coalesce(detail("category"), F.try_element_at(labels, F.lit(2))),
            "product_category_label": detail("productCategory"),
            "sub_category_label": detail("subCategory"),
            "color": detail("color"),
            "color_id": detail("colorId"),
            "collection": detail("collection"),
            "stock_status": detail("stock"),
        }
    )


def stage_parsed(parsed: DataFrame, cfg: CrawlConfig | None = None, handling=HANDLING) -> DataFrame:
    """Staged observations of lines that are parsed already, with has_conflicting_duplicate or not."""
    cfg = cfg or CrawlConfig()
    df = repair_lines(parsed, cfg)
    if "has_conflicting_duplicate" not in parsed.columns:
        df = flag_conflicting_duplicates(df)
    df = df.withColumn("dq_issues", collect_issues(line_rules(cfg), [F.col("price_parse_issue")]))
    df = df.withColumns(
        {
            "dq_status": dq_status(F.col("dq_issues"), handling),
            "product_name_normalized": F.lower("product_name"),
            "product_url": t.blank_to_null(F.col("product_url_raw")),
            "preview_url": t.blank_to_null(F.col("preview_url_raw")),
            "source_name": F.col("source_raw"),
        }
    )
    return df.select(*STAGED)


#: Rules that compare the lines of a file; all others look at one line.
COMPARED = ("exact_duplicate_line", "conflicting_duplicate")


def stage_columns(bronze: DataFrame, columns: Sequence[str], cfg: CrawlConfig | None = None, handling=HANDLING) -> DataFrame:
    """Some columns of stage_observations(), and raw_line if asked for: lines are parsed once, before the shuffle, which moves what the
    columns are made from and a digest in place of the line.
    """
    cfg = cfg or CrawlConfig()
    df = repair_lines(parse_lines(parse_file_name(bronze)), cfg)
    df = df.withColumns({"_hash": F.xxhash64("raw_line"), "_line": F.unhex(F.sha2("raw_line", 256)), "identical_line_ordinal": F.lit(1), "has_conflicting_duplicate": F.lit(False)})
    rules = line_rules(cfg)
    names = list(rules)
    first, last = names.index(COMPARED[0]), names.index(COMPARED[-1]) + 1
    alone = lambda some: fired({n: rules[n] for n in some})
    df = df.withColumns({"_before": joined([F.col("price_parse_issue"), *alone(names[:first])]), "_after": joined(alone(names[last:]))})
    plain = {"product_name_normalized": F.lower("product_name"), "product_url": t.blank_to_null(F.col("product_url_raw")), "preview_url": t.blank_to_null(F.col("preview_url_raw")), "source_name": F.col("source_raw")}
    moved = [c for c in columns if c not in ("crawl_line_id", "dq_issues", "dq_status")]
    moved += [c for c in ("raw_line",) if "crawl_line_id" in columns and c not in moved]
    held = [c for c in ("source_file_name", "object_id", "loaded_at") if c not in moved]
    df = df.withColumns(plain).select(*moved, *held, "_hash", "_line", "_before", "_after")
    same = Window.partitionBy("source_file_name", "object_id", "_hash", "_line").orderBy("loaded_at")
    mates = Window.partitionBy("source_file_name", "object_id").orderBy("_hash", "_line", "loaded_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn("identical_line_ordinal", F.row_number().over(same))
    df = df.withColumn("has_conflicting_duplicate", F.min("_hash").over(mates) != F.max("_hash").over(mates))
    if "crawl_line_id" in columns:
        df = df.withColumn("crawl_line_id", line_id())
    compared = {"exact_duplicate_line": F.col("identical_line_ordinal") > 1, "conflicting_duplicate": F.col("has_conflicting_duplicate")}
    df = df.withColumn("dq_issues", split_labels(joined([F.col("_before"), *fired(compared), F.col("_after")])))
    return df.withColumn("dq_status", dq_status(F.col("dq_issues"), handling)).select(*columns)


_MARKET = ("market_raw", "source_raw")
_CURRENCY = ("original_currency_raw", *_MARKET)
_NAME = ("product_name_raw",)
_SKU = ("skus_raw", "object_id_raw")
# The fields of the line that a rule on one line is made from; rules that aren't here need the details, or other lines.
RULE_FIELDS = {
    "price_numeric_type_drift": (), "missing_price_value": ("price_minor_units_raw",), "currency_code_notation": _CURRENCY, "currency_market_mismatch": _CURRENCY,
    "name_html_entity": _NAME, "name_whitespace_noise": _NAME, "name_missing": _NAME, "name_case_drift": (*_NAME, "crawler_name"),
    "sku_format_variant": _SKU, "sku_recovered_from_object_id": _SKU, "market_recovered_from_source": ("market_raw",), "timestamp_epoch_seconds": ("created_at_raw",),
    "is_valid_as_string": (), "url_missing": ("product_url_raw",), "preview_url_missing": ("preview_url_raw",), "non_product_page": (*_SKU, *_NAME),
    "http_error_or_invalid": ("http_status_raw", "is_valid_raw"), "is_valid_contradiction": ("validation_errors_raw", "is_valid_raw"),
}
def fired_rules(bronze: DataFrame, rules: Sequence[str], columns: Sequence[str] = (), cfg: CrawlConfig | None = None) -> DataFrame:
    """Columns of bronze, or fields of its lines, and dq_issues as by stage_observations(), but of these rules alone.

    Only what the rules are made from is read and repaired, and lines are compared, which takes a shuffle, only if a rule does so or needs
    more than its own fields.
    """
    cfg = cfg or CrawlConfig()
    unpriced = t.unpriced(F.col("original_price_raw"))
    if not set(rules) <= set(RULE_FIELDS) | set(unpriced):
        some = F.array(*map(F.lit, rules)).cast("array<string>")
        return stage_columns(bronze, [*columns, "dq_issues"], cfg).withColumn("dq_issues", F.array_intersect("dq_issues", some))
    read = dict.fromkeys([*[c for c in columns if c in FIELDS | LISTS], *[f for r in rules for f in RULE_FIELDS.get(r, ("original_price_raw",))]])
    df = parse_fields(bronze, list(read))
    # A field that no rule here is made from stands as null, so that the columns and rules made from it are there to be left out.
    df = df.withColumns({c: F.lit(None).cast("array<string>" if c in LISTS else "string") for c in FIELDS | LISTS if c not in read})
    df = df.withColumns({"product_details_raw": F.lit(None).cast("map<string,string>"), "identical_line_ordinal": F.lit(1), "has_conflicting_duplicate": F.lit(False)})
    df = repair_lines(df, cfg)
    return df.select(*columns, collect_issues({n: c for n, c in (unpriced | line_rules(cfg)).items() if n in rules}).alias("dq_issues"))


def stage_observations(bronze: DataFrame, cfg: CrawlConfig | None = None, handling=HANDLING) -> DataFrame:
    """Staged observations of bronze lines: identity, file name, one parse, repairs, rules, status."""
    return stage_parsed(parse_lines(parse_file_name(with_identity(bronze, cfg or CrawlConfig()))), cfg, handling)
