"""Prices, names and lines on hand-written rows."""

import json

import pytest
from pyspark.sql import functions as F

from pricelens.config import CrawlConfig
from pricelens.functions import text as t
from pricelens.functions.issues import collect_issues, dq_status
from pricelens.operators import quality, staging

NNBSP, NBSP = " ", " "
PRICES = [
    ("1,250", "USD", 1250, "price_us_thousands_separator"),
    ("1.250,00", "GBP", 1250, "price_eu_decimal_format"),
    (f"1{NNBSP}250,00", "EUR", 1250, "price_eu_decimal_format"),
    ("$1,250", "USD", 1250, "price_currency_symbol"),
    (f"1{NBSP}250 €", "EUR", 1250, "price_currency_symbol"),
    ("¥616,000", "JPY", 616000, "price_currency_symbol"),
    ("６１６０００", "JPY", 616000, "price_non_ascii_digits"),
    ("٣٧٥٠", "AED", 3750, "price_non_ascii_digits"),
    ("1250.00", "USD", 1250, "price_trailing_decimals"),
    ("2.490", "USD", 2490, "price_dot_thousands_ambiguous"),
    ("2490", "USD", 2490, None),
    ("Price upon request", "USD", None, "price_on_request"),
    ("Sur demande", "EUR", None, "price_on_request"),
    ("From 1,250", "USD", None, "price_from_or_range"),
    ("1,200 - 1,500", "USD", None, "price_from_or_range"),
    ("0", "USD", 0, "price_placeholder"),
    ("99999999", "USD", 99999999, "price_placeholder"),
    ("1.250", "KWD", None, "price_ambiguous_separator"),
    (None, "USD", None, "price_unparseable"),
    ("n/a", "USD", None, "price_unparseable"),
    ("1,25,0", "USD", None, "price_unparseable"),
    ("1.250.000", "USD", 1250000, "price_trailing_decimals"),
]


def test_prices(spark):
    df = spark.createDataFrame([(i, p, c) for i, (p, c, _, _) in enumerate(PRICES)], "i int, p string, c string")
    units = t.lookup(F.col("c"), CrawlConfig().minor_units, 2)
    for r in t.read_prices(df, "p", units, "price", "issue").collect():
        assert (None if r["price"] is None else float(r["price"]), r["issue"]) == PRICES[r["i"]][2:], PRICES[r["i"]]


@pytest.mark.parametrize(
    ("wrong", "right"),
    [("PrÃªt", "Prêt"), ("å¥³å£«", "女士"), ("Prêt", "Prêt"), ("plain", "plain"), ("Ã", "Ã"), ("Ãª漢", "Ãª漢"), ("Ãª Ã", "Ãª Ã"), (None, None), ("x" * 50000 + "Ã©", "x" * 50000 + "é")],
)
def test_mojibake(spark, wrong, right):
    df = spark.createDataFrame([(wrong,)], "x string")
    assert df.select(t.repair_mojibake(F.col("x")).alias("x")).first()["x"] == right


def test_the_last_of_repeated_keys_counts(spark):
    df = spark.createDataFrame([(1, [("a", "1"), (None, "x"), ("b", "2"), ("a", None), ("a", "3")]), (2, []), (3, None), (4, [("k", str(i)) for i in range(5000)])], "i int, p array<struct<key:string,value:string>>")
    got = {r["i"]: r["m"] for r in staging.kv_list_to_map(df, "p", "m").collect()}
    assert got == {1: {"a": "3", "b": "2"}, 2: {}, 3: None, 4: {"k": "4999"}}


def test_small_functions(spark):
    df = spark.createDataFrame([(" A &amp;  B&#39;s ", "1700000000", "1700000000000", " TRUE ", "ab- 12")], "n string, s string, ms string, b string, k string")
    r = df.select(
        t.clean_name(t.unescape_html(F.col("n"))).alias("n"), t.epoch_to_ts(F.col("s")).alias("s"), t.epoch_to_ts(F.col("ms")).alias("ms"), t.text_boolean(F.col("b")).alias("b"),
        t.normalise_sku(F.col("k")).alias("k"), t.normalise_tag(F.lit(" BA_micro_x "), "bal").alias("g"), t.surrogate_key(F.lit("2026-07-01"), F.lit("ARE"), F.lit("Accessories")).alias("h"),
        t.surrogate_key(F.lit(None).cast("string"), F.lit("a")).alias("null_key"),
    ).first()
    assert r["n"] == "A & B's" and r["s"] == r["ms"] and r["b"] is True and r["k"] == "AB12" and r["g"] == "bal_micro_x"
    assert r["h"] == "e58ec8c8079cbfb69a1e68510ed63f76"
    assert len(r["null_key"]) == 32


def test_status_is_the_worst_handling(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (1, 0, 0), (0, 0, 0)], "f int, w int, q int")
    issues = collect_issues({"name_html_entity": F.col("f") == 1, "url_missing": F.col("w") == 1, "name_missing": F.col("q") == 1}, [F.lit(None).cast("string")])
    from pricelens.config import HANDLING

    got = [r[0] for r in df.select(dq_status(issues, HANDLING)).collect()]
    assert got == ["quarantine", "warn", "fixed", "pass"]


def line(**changes):
    row = {
        "objectID": "Brand_FRA_123AB", "brandId": 7, "name": "le sac", "url": "u", "previewUrl": "p", "price": {"original_price": "1250", "original_currency": "EUR", "price": 125000, "currency": "EUR"},
        "categories": ["br_micro_bags", "Femme"], "productDetails": [{"key": "color", "value": "black"}, {"key": "color", "value": "red"}], "status": 200, "source": "Brand_FRA", "importSource": "x", "crawlerName": "BrandIntl",
        "createdAt": 1751328000000, "skus": ["123AB"], "market": "FRA", "validationErrors": [], "isValid": True,
    }
    price = changes.pop("price", {})
    row = row | changes
    row["price"] = row["price"] | price
    return json.dumps({k: v for k, v in row.items() if v != "absent"}, ensure_ascii=False)


def staged(spark, lines, name="BrandIntl_2025-07-01_1751360000000_x%20(1).ndjson.gz"):
    df = spark.createDataFrame([(x, name, i) for i, x in enumerate(lines)], "raw_line string, source_file_name string, i int")
    return df.withColumn("loaded_at", F.timestamp_seconds("i")).drop("i")


CASES = [
    (line(), []),
    (line(objectID="Brand_FRA_B2", skus=["B 2"]), ["sku_format_variant"]),
    (line(objectID="Brand_FRA_C3", skus=[]), ["sku_recovered_from_object_id"]),
    (line(objectID="Brand_FRA_D4", skus=["D4"], market="absent"), ["market_recovered_from_source"]),
    (line(objectID="Brand_FRA_E5", skus=["E5"], createdAt=1751328000), ["timestamp_epoch_seconds"]),
    (line(objectID="Brand_FRA_F6", skus=["F6"], isValid="true"), ["is_valid_as_string"]),
    (line(objectID="Brand_FRA_G7", skus=["G7"], name="a &amp; b"), ["name_html_entity"]),
    (line(objectID="Brand_FRA_H8", skus=["H8"], name="a  b"), ["name_whitespace_noise"]),
    (line(objectID="Brand_FRA_I9", skus=["I9"], name="Le Sac"), ["name_case_drift"]),
    (line(objectID="Brand_FRA_J1", skus=["J1"], name=" "), ["name_missing"]),
    (line(objectID="Brand_FRA_K1", skus=["K1"], price={"original_price": 1250}), ["price_numeric_type_drift"]),
    (line(objectID="Brand_FRA_L1", skus=["L1"], price={"original_currency": "€"}), ["currency_code_notation"]),
    (line(objectID="Brand_FRA_M1", skus=["M1"], price={"original_currency": "USD"}), ["currency_market_mismatch"]),
    (line(objectID="Brand_FRA_N1", skus=["N1"], url="", previewUrl=None), ["url_missing", "preview_url_missing"]),
    (line(objectID="Brand_FRA_O1", skus=["TEST1"]), ["non_product_page"]),
    (line(objectID="Brand_FRA_P1", skus=["P1"], status=404), ["http_error_or_invalid"]),
    (line(objectID="Brand_FRA_Q1", skus=["Q1"], validationErrors=["e"]), ["is_valid_contradiction"]),
    (line(objectID="Brand_FRA_R1", skus=["R1"], categories=["PrÃªt"]), ["category_mojibake"]),
    (line(objectID="Brand_FRA_S1", skus=["S1"]), []),
    (line(objectID="Brand_FRA_S1", skus=["S1"]), ["exact_duplicate_line"]),
    (line(objectID="Brand_FRA_T1", skus=["T1"], brandId=1), ["conflicting_duplicate"]),
    (line(objectID="Brand_FRA_T1", skus=["T1"], brandId=2), ["conflicting_duplicate"]),
]


def test_every_rule_fires_alone(spark):
    df = staged(spark, [x for x, _ in CASES])
    rows = staging.stage_observations(df).collect()
    assert len(rows) == len(CASES)
    got = sorted((r["object_id_raw"], tuple(r["dq_issues"])) for r in rows)
    assert got == sorted((json.loads(x)["objectID"], tuple(w)) for x, w in CASES)
    first = next(r for r in rows if r["object_id_raw"] == "Brand_FRA_123AB")
    assert (first["object_id"], first["sku"], first["market"], float(first["price_local"]), first["color"], first["dq_status"]) == ("Brand_FRA_123AB", "123AB", "FRA", 1250.0, "red", "pass")
    assert first["delivered_file_name"].endswith("x (1).ndjson.gz") and first["file_name_has_copy_suffix"] and str(first["file_crawl_date"]) == "2025-07-01"
    assert first["brand_micro_category"] == "br_micro_bags" and str(first["crawled_at"]) == "2025-07-01 00:00:00"


def test_bad_names_and_lines_are_kept(spark):
    df = staged(spark, ["no json", "{}", None], "100%_x")
    rows = staging.stage_observations(df).collect()
    assert len(rows) == 3 and all(r["dq_status"] == "quarantine" and r["delivered_file_name"] == "100%_x" for r in rows)


def test_extracted_text_equals_the_one_parse(spark):
    df = staged(spark, [x for x, _ in CASES])
    one = staging.parse_lines(df).select(*staging.FIELDS).collect()
    assert one == staging.extract_json_text(df, staging.FIELDS).select(*staging.FIELDS).collect()


def test_quarantine_repairs_and_grading(spark):
    bronze = staged(spark, [x for x, _ in CASES], "BrandIntl_2025-07-01_1751360000000_x.ndjson.gz")
    obs = staging.stage_observations(bronze)
    q = quality.quarantined(obs, staging.with_line_id(bronze)).collect()
    assert {tuple(r["quarantine_reasons"]) for r in q} == {("name_missing",), ("currency_market_mismatch",), ("non_product_page",), ("http_error_or_invalid",), ("is_valid_contradiction",), ("conflicting_duplicate",)}
    fixed = {r["repair_rule"]: (r["repaired_field"], r["raw_value"], r["repaired_value"]) for r in quality.repairs(obs).collect()}
    assert fixed["currency_code_notation"] == ("currency_code", "€", "EUR") and fixed["name_html_entity"] == ("product_name", "a &amp; b", "a & b")
    manifest = spark.createDataFrame(
        [("f", "1", "Brand_FRA_G7", "C01_html_entity_in_name", "name", "a", "b", "fix"), ("f", "2", "Brand_FRA_123AB", "C04_missing_name", "name", "a", "b", "quarantine"), ("f", "3", "x", "C04_missing_name", "name", "a", "a", "quarantine"), ("g", None, None, "F04_missing_market", "JPN", None, None, "warn")],
        "file_name string, line_number string, object_id string, defect_code string, field string, clean_value string, dirty_value string, expected_handling string",
    )
    files = spark.createDataFrame([("g", False, False, [], ["JPN"])], "file_name string, is_duplicate_content boolean, is_stale_content boolean, partial_markets array<string>, missing_markets array<string>")
    caught_by = {"C01_html_entity_in_name": "name_html_entity", "C04_missing_name": "name_missing", "F04_missing_market": "file:missing_market"}
    got = {r["defect_code"]: (r["n_planted"], r["recall"], r["handled_as_expected"]) for r in quality.grade(manifest, obs.withColumn("file_name", F.lit("f")), files, caught_by).collect()}
    assert got == {"C01_html_entity_in_name": (1, 1.0, True), "C04_missing_name": (1, 0.0, True), "F04_missing_market": (1, 1.0, True)}
