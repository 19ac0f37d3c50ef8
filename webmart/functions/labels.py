"""Label expressions: channel group, device group, search-rank bucket."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel group -> traffic media that belong to it.
CHANNEL_GROUPS = {
    "organic search": ("organic",),
    "paid search": ("cpc", "ppc", "paid", "paidsearch"),
    "email": ("email", "e-mail", "newsletter"),
    "social": ("social", "social-network", "social-media", "sm"),
    "direct": ("(none)", "direct"),
    "referral": ("referral",),
}
OTHER_CHANNEL = "other"

# Upper bound of each rank bucket -> label. Ranks start at 1.
RANK_BUCKETS = {
    3: "1 — Top 3",
    10: "2 — Top 10",
    20: "3 — Top 20",
    50: "4 — Top 50",
}
BEYOND_RANKS = "5 — 51+"
NO_RANK = "6 — No SEO Data"

# Device categories counted as mobile.
MOBILE_DEVICES = ("mobile", "tablet")


def channel_group(medium: Column) -> Column:
    medium = F.lower(medium)
    groups = [F.when(medium.isin(*media), F.lit(group)) for group, media in CHANNEL_GROUPS.items()]
    return F.coalesce(*groups, F.lit(OTHER_CHANNEL))


def device_group(category: Column) -> Column:
    return F.when(F.lower(category).isin(*MOBILE_DEVICES), F.lit("Mobile")).otherwise(F.lit("Desktop"))


def rank_bucket(position: Column) -> Column:
    label = F.when(position < 1, F.lit(NO_RANK))
    for bound, name in RANK_BUCKETS.items():
        label = label.when(position <= bound, F.lit(name))
    return label.when(position.isNotNull(), F.lit(BEYOND_RANKS)).otherwise(F.lit(NO_RANK))
