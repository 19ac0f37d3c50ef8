"""URL and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_EVENT_PATH = r"https?://[^/]+(/[^?#]*)"
_SCHEME_AND_HOST = r"^(?:[a-z][a-z0-9+.\-]*:)?(?://([^/?#]*))?"
_URL_PATH = _SCHEME_AND_HOST + r"([^?#]*)"


def strip_space(text: Column) -> Column:
    """Drop white space of any script at both ends (by itself the built-in ``trim`` drops blanks only)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def event_path(url: Column) -> Column:
    """Path of an event's page location: lower case, no query, fragment or trailing slash; ``/`` when there is none."""
    found = F.regexp_extract(strip_space(F.lower(F.coalesce(url, F.lit("")))), _EVENT_PATH, 1)
    # What was found starts with a slash or is empty: putting the slash back also turns an empty path into "/".
    return F.concat(F.lit("/"), F.substr(F.rtrim(found, F.lit("/")), F.lit(2)))


def keyword_path(url: Column) -> Column:
    """Path of a keyword's landing URL.

    Differs from :func:`event_path`: text without a scheme is itself a path, a query never counts as path,
    and ``;params`` of the last segment are dropped. A host with an unpaired bracket is not a URL and gives ``/``.
    """
    text = strip_space(F.lower(url))
    host = F.regexp_extract(text, _SCHEME_AND_HOST, 1)
    path = F.regexp_replace(F.regexp_extract(text, _URL_PATH, 2), r";[^/]*$", "")
    bare = F.nullif(F.rtrim(path, F.lit("/")), F.lit(""))
    broken = host.contains("[") != host.contains("]")
    return F.when(broken, F.lit("/")).otherwise(F.coalesce(bare, F.lit("/")))


def strip_prefix(path: Column, prefix: str) -> Column:
    """Drop a leading path segment: ``/p`` -> ``/``, ``/p/a`` -> ``/a``, ``/px`` unchanged."""
    return F.regexp_replace(path, rf"^\Q{prefix}\E(?:/|$)", "/")


def without_html(path: Column) -> Column:
    """Path without a final ``.html``."""
    return F.regexp_replace(path, r"\.html$", "")
