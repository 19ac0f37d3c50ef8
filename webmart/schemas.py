"""Input and output schemas."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


EVENT_PARAM = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField(
            "value",
            T.StructType(
                [
                    T.StructField("int_value", T.LongType()),
                    T.StructField("string_value", T.StringType()),
                ]
            ),
        ),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("traffic_source", _strings("medium", "source")),
        T.StructField("device", _strings("category")),
        T.StructField("geo", _strings("country")),
        T.StructField("ecommerce", T.StructType([T.StructField("purchase_revenue", T.DoubleType())])),
        T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    ]
)

# The headers of the five kinds of export. All columns arrive as text, in the order of each file's own header,
# which is matched with these.
ORGANIC_EXPORT = _strings(
    "Keyword",
    "Position",
    "Previous Position",
    "Position Difference",
    "Search Volume",
    "CPC",
    "Url",
    "Traffic (%)",
    "Traffic Cost (%)",
    "Competition",
    "Number of Results",
    "Trends",
)
PAID_EXPORT = _strings(
    "Keyword",
    "Position",
    "Search Volume",
    "CPC",
    "Traffic (%)",
    "Traffic Cost (%)",
    "Competition",
    "Url",
    "Title",
    "Description",
)
RANKS_EXPORT = _strings(
    "Domain",
    "Rank",
    "Organic Keywords",
    "Organic Traffic",
    "Organic Cost",
    "Adwords Keywords",
    "Adwords Traffic",
    "Adwords Cost",
    "PLA keywords",
    "PLA uniques",
)
BACKLINKS_EXPORT = _strings(
    "source_url",
    "source_title",
    "target_url",
    "anchor",
    "domain_score",
    "page_score",
    "first_seen",
    "last_seen",
)
DIFFICULTY_EXPORT = _strings(
    "Keyword",
    "Search Volume",
    "CPC",
    "Competition",
    "Number of Results",
    "Trends",
    "Keyword Difficulty",
)

EXPORTS = {
    "organic": ORGANIC_EXPORT,
    "paid": PAID_EXPORT,
    "domain_ranks": RANKS_EXPORT,
    "backlinks": BACKLINKS_EXPORT,
    "keyword_difficulty": DIFFICULTY_EXPORT,
}



@dataclass(frozen=True)
class HeaderMatch:
    """How a file's header meets the contract of the kind of export that it shares most columns with."""

    family: str | None
    missing: list[str]
    extra: list[str]
    moved: list[str]

    @property
    def departs(self) -> bool:
        return bool(self.family is None or self.missing or self.extra or self.moved)

    def __str__(self) -> str:
        parts = {"missing": self.missing, "extra": self.extra, "moved": self.moved}
        return f"{self.family or 'no known export'}; " + "; ".join(f"{k}: {', '.join(v)}" for k, v in parts.items() if v)


def match_header(names: Sequence[str]) -> HeaderMatch:
    """The kind of export with the largest share of common columns, and where the header departs from it.

    A column has moved if it stands at another place among the columns that header and contract share.
    """
    given = set(names)
    shares = {
        family: len(given.intersection(schema.names)) / len(given.union(schema.names)) for family, schema in EXPORTS.items()
    }
    family = max(shares, key=shares.get)
    if not shares[family]:
        return HeaderMatch(None, [], list(names), [])
    contract = EXPORTS[family].names
    common = [name for name in contract if name in given]
    placed = [name for name in names if name in contract]
    return HeaderMatch(
        family,
        [name for name in contract if name not in given],
        [name for name in names if name not in contract],
        [name for name, other in zip(common, placed) if name != other],
    )


# Rank export header -> table column.
RANK_COLUMNS = {
    "Domain": "domain",
    "Rank": "semrush_rank",
    "Organic Keywords": "organic_keywords",
    "Organic Traffic": "organic_traffic",
    "Organic Cost": "organic_cost",
    "Adwords Keywords": "paid_keywords",
    "Adwords Traffic": "paid_traffic",
    "Adwords Cost": "paid_cost",
    "PLA keywords": "pla_keywords",
    "PLA uniques": "pla_uniques",
}

# Prepared keyword columns that get an explicit type.
KEYWORD_TYPES = {
    "snapshot_date": "date",
    "Position": "int",
    "Search Volume": "int",
    "CPC": "float",
    "Traffic (%)": "float",
    "Competition": "float",
    "joinable_to_ga4": "bool",
}

# Leading columns of the prepared keyword frame.
KEYWORD_LEADING = (
    "domain",
    "source",
    "snapshot_date",
    "Keyword",
    "Position",
    "Search Volume",
    "CPC",
    "Traffic (%)",
    "Competition",
    "Url",
    "page_path",
    "join_category",
    "joinable_to_ga4",
)

INSIGHTS = T.StructType(
    [
        T.StructField("generated_at", T.TimestampType(), False),
        T.StructField("insight_type", T.StringType(), False),
        T.StructField("insight_text", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)
