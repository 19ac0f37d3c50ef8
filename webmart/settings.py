"""Run parameters. Every date, window, domain and prefix of the mart lives here."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# The tracked domains, keyed by the form used in export file names.
DOMAINS = {
    "merch_google": "merch.google",
    "cafepress_com": "cafepress.com",
    "redbubble_com": "redbubble.com",
    "zazzle_com": "zazzle.com",
}

# The two keyword export families.
KEYWORD_SOURCES = ("organic", "paid")

# Phrases tracked for the target store.
KNOWN_PHRASES = (
    "plush google",
    "google merchandise store",
    "google merch store",
    "google merch",
    "google store",
    "google plush",
    "google swag",
    "merch google",
)


@dataclass(frozen=True)
class MartSettings:
    """What one run of the mart covers.

    ``event_days`` are inclusive ``yyyyMMdd`` bounds; the other ranges are inclusive dates.
    ``snapshot_date`` stamps keyword and rank loads; ``None`` means the day the job runs.
    ``keep_empty_text`` keeps blank keyword fields as ``''`` where they would otherwise be NULL.
    ``strict_params`` ends a build where an event has a parameter more than once; otherwise the first counts.
    ``save_events`` writes the flat events that sessions and pages read, so that the nested ones are scanned once.
    ``normalize_landing`` also strips the site prefix from landing pages, so that they can meet the page dimension.
    """

    target_domain: str = "merch.google"
    site_prefix: str = "/google+redesign"
    event_days: tuple[str, str] = ("20201101", "20210131")
    calendar: tuple[date, date] = (date(2020, 11, 1), date(2021, 1, 31))
    current_period: tuple[date, date] = (date(2021, 1, 1), date(2021, 1, 31))
    previous_period: tuple[date, date] = (date(2020, 12, 1), date(2020, 12, 31))
    snapshot_date: date | None = None
    keep_empty_text: bool = False
    normalize_landing: bool = False
    strict_params: bool = False
    save_events: bool = False
    domains: dict[str, str] = field(default_factory=lambda: dict(DOMAINS))
