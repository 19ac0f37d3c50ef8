"""Product-category rules over URL paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (pattern, category) in order; the first match wins.
CATEGORY_RULES = (
    (r"hoodie|sweatshirt|sweats|^/apparel/apparel/hoodies|^/shop/apparel/hoodies", "apparel/hoodies"),
    (r"jacket|gilet|^/apparel/apparel/jackets", "apparel/jackets"),
    (r"^/apparel/mens|^/shop/apparel/mens", "apparel/mens"),
    (r"^/apparel/hats|^/shop/apparel/head|hat|cap(?!e)", "apparel/headgear"),
    (r"^/apparel/accessories/bags/backpack|backpack", "apparel/bags/backpacks"),
    (r"^/apparel/accessories/bags|^/shop/lifestyle/bags", "apparel/bags"),
    (r"^/apparel/misc/socks|^/shop/apparel/socks|socks", "apparel/socks"),
    (r"^/shop/apparel/accessories", "apparel/accessories"),
    (r"^/apparel(?:/|$)|^/shop/apparel(?:/|$)", "apparel"),
    (r"drinkware|bottle|mug|tumbler", "lifestyle/drinkware"),
    (r"blanket|towel|^/lifestyle/home", "lifestyle/home"),
    (r"^/lifestyle/accessories/lanyards|lanyard", "lifestyle/accessories"),
    (r"^/shop/lifestyle|^/lifestyle", "lifestyle"),
    (r"^/shop/shop-by-brand/youtube|^/brands/youtube|youtube", "brands/youtube"),
    (r"^/shop/shop-by-brand/android|^/brands/android|android", "brands/android"),
    (r"^/brands/google/google-cloud|google.cloud", "brands/google-cloud"),
    (r"^/brands/gemini|gemini", "brands/gemini"),
    (r"^/brands", "brands"),
    (r"^/shop/collections/chrome-dino|chrome.dino", "collections/chrome-dino"),
    (r"^/shop/collections/emoji|emoji", "collections/emoji"),
    (r"^/shop/collections/google-bike|google.bike|model.bike", "collections/google-bike"),
    (r"^/shop/collections/campus|campus", "collections/campus"),
    (r"^/collections/super-g|super.g", "collections/super-g"),
    (r"^/shop/new(?:/|$)", "new-arrivals"),
    (r"sticker|magnet|pin|patch|pen|notebook|keychain|keyring|^/shop/stationery", "stationery"),
    (r"^/checkout", "checkout"),
    (r"^/catalogsearch", "search"),
    (r"^/$", "homepage"),
)

# Keyword pages that never get a category.
PRODUCT_PAGE = r"^/product/"
LEGACY_PAGE = r"-[a-z0-9]{4,}\.html$"

CATEGORIES = tuple(category for _, category in CATEGORY_RULES)

_ALTERNATIVE = re.compile(r"\|(?![^(]*\))")
_PLAIN = re.compile(r"(\^?)([a-z/\-]+)")
_CAP = "cap(?!e)"


def _test(path: str, text: str) -> str:
    """SQL test of one alternative; plain text is searched without a regular expression."""
    plain = _PLAIN.fullmatch(text)
    if plain is None:
        return f"{path} RLIKE r'{text}'"
    return f"startswith({path}, '{plain[2]}')" if plain[1] else f"contains({path}, '{plain[2]}')"


def _rules(path: str, special: dict[str, str]) -> str:
    arms = []
    for pattern, category in CATEGORY_RULES:
        tests = [special.get(text) or _test(path, text) for text in _ALTERNATIVE.split(pattern)]
        arms.append(f"WHEN {' OR '.join(tests)} THEN '{category}'")
    return " ".join(arms)


def event_category(path: str) -> Column:
    """Category of the event page path in a column (lower case already); NULL when no rule matches.

    The path should be a stored or aggregated column: its expression would be repeated in every rule.
    """
    # Event paths settle cap/cape on the whole path: one "cape" anywhere rules out every "cap".
    cap = f"(contains({path}, 'cap') AND NOT contains({path}, 'cape'))"
    return F.expr(f"CASE {_rules(path, {_CAP: cap})} END")


def keyword_category(path: str) -> Column:
    """The same for a keyword page path; product and legacy pages have no category either."""
    excluded = f"{path} RLIKE r'{PRODUCT_PAGE}' OR {path} RLIKE r'{LEGACY_PAGE}'"
    return F.expr(f"CASE WHEN {excluded} THEN NULL {_rules(path, {})} END")
