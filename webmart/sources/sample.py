"""The mart's inputs derived from the sample tables ``events``, ``part`` and ``supplier`` (mapping: FIXTURES.md)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webmart.operators import keywords
from webmart.settings import MartSettings
from webmart.sinks.files import write_csv
from webmart.sinks.tables import ScratchStore

SETTINGS = MartSettings(
    event_days=("20240101", "20240130"),
    calendar=(date(2024, 1, 1), date(2024, 1, 28)),
    current_period=(date(2024, 1, 16), date(2024, 1, 30)),
    previous_period=(date(2024, 1, 1), date(2024, 1, 15)),
    snapshot_date=date(2024, 2, 1),
)

# The sample mapping's text lists, picked by remainder.
_HOST = "https://shop.example-store.com"
PAGE_LOCATIONS = (
    f"{_HOST}/Google+Redesign/Apparel/Hoodies?utm=x",
    f"{_HOST}/Google+Redesign/Apparel/Mens/",
    f"{_HOST}/Google+Redesign",
    "https://www.example-store.com/",
    "https://www.example-store.com",
    f"{_HOST}/Google+Redesign/Lifestyle/Drinkware#top",
    f"{_HOST}/Google+Redesign/Shop+by+Brand/YouTube",
    f"{_HOST}/Google+Redesign/Apparel/Cape",
    f"{_HOST}/Cape/Cap",
    f"{_HOST}/signin.html",
    f"{_HOST}/basket.html",
    f"{_HOST}/Google+Redesign/Accessories/Stickers",
    f"{_HOST}/checkout/step1",
    f"{_HOST}/catalogsearch/result?q=1",
    "  HTTPS://shop.example-store.com/Google+Redesign/Apparel/Accessories/Bags/  ",
    None,
    "not-a-url",
    "https://host?x=/a/b",
    f"{_HOST}/Apparel/Accessories/Bags",
    f"{_HOST}/google+redesignx/foo",
    f"{_HOST}/Google+Redesign/Lifestyle/Lanyard//",
    f"{_HOST}/Google+Redesign/Shop/Collections/Chrome-Dino;v=1",
    f"{_HOST}/google+redesign/brands/gemini",
    f"{_HOST}/asearch.html",
)
MEDIA = (
    "organic",
    "cpc",
    "(none)",
    "referral",
    "email",
    "social",
    "Organic",
    "paidsearch",
    "affiliate",
    None,
    "newsletter",
    "sm",
)
TRAFFIC_SOURCES = ("google", "(direct)", None, "youtube.com", "news")
DEVICES = ("desktop", "mobile", "tablet", None)
KEYWORD_URLS = (
    "https://merch.google/apparel/accessories/bags.html",
    "https://merch.google/apparel/accessories/bags",
    "https://merch.google/apparel/apparel/hoodies-sweats.html",
    "https://merch.google/shop/apparel/hoodies?utm=1",
    "https://merch.google/shop/apparel/hoodies/",
    "https://merch.google/product/1234",
    "https://merch.google/lifestyle/drinkware.html",
    "https://merch.google/brands/youtube",
    "https://merch.google/",
    "https://merch.google",
    "https://merch.google/apparel/google-zip-hoodie.html",
    "https://merch.google/shop/collections/chrome-dino;v=2",
    "https://merch.google/shop/new",
    "https://merch.google/stationery/stickers",
    "malformed_url",
    None,
    "https://merch.google/cape/cap",
    "https://merch.google/cape",
    "HTTPS://Merch.Google/Apparel/Mens/",
    "https://merch.google/checkout",
)
KEYWORD_DOMAINS = ("merch.google", "merch.google", "cafepress.com", "redbubble.com", "zazzle.com")
#: The export that is written as a refusal where flaws are asked for.
FLAWED_EXPORT = ("paid", "zazzle_com")
SAMPLE_PHRASES = ("red widget 1", "small ring 0", "no such keyword")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _literal(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _pick(values: tuple, number: str) -> str:
    """SQL for the list item that a remainder points at."""
    return f"element_at(array({', '.join(map(_literal, values))}), CAST({number} % {len(values)} AS INT) + 1)"


def _param(key: str, condition: str, field: str, value: str) -> str:
    """SQL for one event parameter, NULL where the condition fails."""
    whole, text = (value, "CAST(NULL AS STRING)") if field == "int_value" else ("CAST(NULL AS BIGINT)", value)
    record = f"named_struct('int_value', CAST({whole} AS BIGINT), 'string_value', {text})"
    return f"CASE WHEN {condition} THEN named_struct('key', '{key}', 'value', {record}) END"


def events(spark: SparkSession, sf_dir: str, settings: MartSettings = SETTINGS) -> DataFrame:
    """Nested events of the settings' days; the day range reaches the scan as a filter on ``ts``."""
    first, last = (f"to_timestamp_ntz('{day}', 'yyyyMMdd')" for day in settings.event_days)
    raw = _table(spark, sf_dir, "events").where(f"ts >= {first} AND ts < {last} + INTERVAL 1 DAY")
    day = "year(ts) * 10000 + month(ts) * 100 + day(ts)"
    seconds = "CAST(datediff(ts, DATE '1970-01-01') AS BIGINT) * 86400 + hour(ts) * 3600 + minute(ts) * 60"
    location = _pick(PAGE_LOCATIONS, "event_id")
    engagement = "CASE WHEN event_id % 50 = 7 THEN 2500 ELSE event_id * 37 % 90000 END"
    params = (
        _param("ga_session_id", "event_id % 97 <> 5", "int_value", "day_number"),
        _param("page_location", "location IS NOT NULL", "string_value", "location"),
        _param("session_engaged", "event_id % 5 <> 0", "string_value", "CASE WHEN value >= 50 THEN '1' ELSE '0' END"),
        _param("engagement_time_msec", "event_id % 13 <> 0", "int_value", engagement),
    )
    return raw.selectExpr("*", f"{day} AS day_number", f"{location} AS location").selectExpr(
        "CAST(user_id AS STRING) AS user_pseudo_id",
        "CAST(day_number AS STRING) AS event_date",
        "CASE WHEN event_type = 'signup' THEN 'session_start' WHEN event_type IN ('view', 'click') THEN 'page_view' "
        "WHEN event_type = 'purchase' THEN 'purchase' ELSE 'user_engagement' END AS event_name",
        f"({seconds}) * 1000000 + CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT) AS event_timestamp",
        f"named_struct('medium', {_pick(MEDIA, 'user_id')}, 'source', {_pick(TRAFFIC_SOURCES, 'user_id')}) "
        "AS traffic_source",
        f"named_struct('category', {_pick(DEVICES, 'user_id')}) AS device",
        "named_struct('country', CASE WHEN user_id % 29 <> 3 THEN concat('NATION_', user_id % 25) END) AS geo",
        "named_struct('purchase_revenue', CASE WHEN event_id % 11 <> 0 THEN value END) AS ecommerce",
        f"array_compact(array({', '.join(params)})) AS event_params",
    )


def keyword_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw keyword rows as text, under the headers of the exports."""
    return _table(spark, sf_dir, "part").selectExpr(
        "concat(p_name, ' ', p_partkey) AS Keyword",
        "CASE WHEN p_partkey % 37 <> 11 THEN CAST(p_size * 2 - 1 AS STRING) END AS Position",
        "CASE WHEN p_partkey % 41 <> 7 THEN CAST(p_partkey * 7919 % 100000 AS STRING) END AS `Search Volume`",
        "CAST(p_retailprice / 1000 AS STRING) AS CPC",
        "CAST((p_partkey * 31 % 1000) / 10.0D AS STRING) AS `Traffic (%)`",
        "CAST((p_partkey % 100) / 100.0D AS STRING) AS Competition",
        f"{_pick(KEYWORD_URLS, 'p_partkey')} AS Url",
        f"{_pick(KEYWORD_DOMAINS, '(p_partkey div 20)')} AS domain",
        "CASE WHEN (p_partkey div 100) % 3 < 2 THEN 'organic' ELSE 'paid' END AS source",
    )


def export_families(raw: DataFrame) -> dict[str, DataFrame]:
    """The two families of keyword exports, each with a column of its own."""
    return {
        "organic": raw.withColumn("Previous Position", F.col("Position")),
        "paid": raw.withColumn("Title", F.col("Keyword")),
    }


def _lines(rows: DataFrame) -> DataFrame:
    """Rows as lines of text, in one column whose name is the header line."""
    header = ";".join(rows.columns)
    return rows.select(F.to_csv(F.struct(*rows.columns), {"sep": ";"}).alias(header))


def write_keyword_exports(raw: DataFrame, root: str, flawed: bool = False, settings: MartSettings = SETTINGS) -> None:
    """Write one export per domain and source under ``root``.

    ``flawed`` adds what goes wrong in exports: values that do not fit their type, rows with a field too many, an export
    that is a refusal, and one without rows.
    """
    kept = ScratchStore(raw.sparkSession).save("exports", "rows", raw, ("domain", "source"))
    for key, domain in settings.domains.items():
        for source, rows in export_families(kept).items():
            own = rows.where((F.col("domain") == domain) & (F.col("source") == source)).drop("domain", "source")
            path = f"{root}/{source}_keywords_{key}.csv"
            if not flawed:
                write_csv(own, path, sep=";")
                continue
            number = F.regexp_extract("Keyword", r"(\d+)$", 1).cast("int")
            own = own.withColumns(
                {
                    "Position": F.when(number % 17 == 3, F.lit("n/a")).otherwise(F.col("Position")),
                    "CPC": F.when(number % 19 == 4, F.replace("CPC", F.lit("."), F.lit(","))).otherwise(F.col("CPC")),
                }
            )
            lines = _lines(own)
            name = F.col(f"`{lines.columns[0]}`")
            digits = F.regexp_extract(name, r"^[^;]*?(\d+);", 1).cast("int")
            lines = lines.select(F.when(digits % 23 == 5, F.concat(name, F.lit(";surplus"))).otherwise(name).alias(lines.columns[0]))
            if (source, key) == FLAWED_EXPORT:
                lines = raw.sparkSession.range(1).select(F.lit("NOTHING FOUND").alias("ERROR 50"))
            # the lines are written as they are: one field, no quotes
            writer = lines.write.mode("overwrite").option("header", True).option("sep", "\x01")
            writer.option("quote", "\x00").option("escapeQuotes", False).csv(path)


def prepared_keywords(spark: SparkSession, sf_dir: str, settings: MartSettings = SETTINGS) -> DataFrame:
    return keywords.prepare_keywords(keyword_exports(spark, sf_dir), settings)


def loaded_keywords(spark: SparkSession, sf_dir: str, settings: MartSettings = SETTINGS) -> DataFrame:
    return keywords.load_keywords(prepared_keywords(spark, sf_dir, settings), settings)


def rank_exports(spark: SparkSession, sf_dir: str, settings: MartSettings = SETTINGS) -> DataFrame:
    """Rank rows under the headers of the exports, one per supplier; the first suppliers stand for the tracked domains."""
    tracked = tuple(settings.domains.values())
    return _table(spark, sf_dir, "supplier").selectExpr(
        f"CASE WHEN s_suppkey < {len(tracked)} THEN {_pick(tracked, 's_suppkey')} "
        "ELSE concat('shop-', s_suppkey, '.example') END AS Domain",
        "CAST(s_suppkey + 1 AS STRING) AS Rank",
        "CAST(floor(s_acctbal) AS STRING) AS `Organic Keywords`",
        "CAST(floor(s_acctbal) * 10 AS STRING) AS `Organic Traffic`",
        "CAST(s_nationkey AS STRING) AS `Organic Cost`",
        "CASE WHEN s_suppkey <> 2 THEN CAST(s_nationkey * 2 AS STRING) END AS `Adwords Keywords`",
        "'0' AS `Adwords Traffic`",
        "'0' AS `Adwords Cost`",
        "'0' AS `PLA keywords`",
        "'0' AS `PLA uniques`",
    )


def domain_ranks(spark: SparkSession, sf_dir: str, settings: MartSettings = SETTINGS) -> DataFrame:
    return keywords.load_domain_ranks(rank_exports(spark, sf_dir, settings), settings)
