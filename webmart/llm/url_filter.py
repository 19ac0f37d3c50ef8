"""URL filters by a temporal join with dated lists.

A list entry adds a pattern to a list, or removes it, from a day on; a pattern is a host, which also stands for its
subdomains, or a URL without scheme, query and fragment. The entries of a list and pattern become validity intervals. A
capture is blocked by each list that has, on the day of the fetch, one of its patterns: its URL, its host, or a domain
above the host.

Intervals are cut at months and met by pattern and month, so a host with a third of all captures is spread over months,
no capture meets intervals of other months, and what is left of the skew is split by Spark's join. Entries of one pattern
and day are combined before anything is sorted, which bounds a pattern's intervals by its days.

Of entries alike in list, pattern and day, ``add`` wins. An interval starts on its day and ends before the next entry's;
one that no later entry closes has no end.
Captures without URL, day or host are never blocked. Rows alike in page_id, url and fetched_on give one result row. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:@]+)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: str = "url") -> Column:
    """The lower-cased host; '' if the URL has none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def bare_url(url: str = "url") -> Column:
    """Host and path without a final slash."""
    return F.concat(host(url), F.regexp_replace(F.regexp_extract(url, _PATH, 1), "/+$", ""))


def domains(name: Column) -> Column:
    """The host and the domains above it, those of one label left out."""
    labels = F.split(name, r"\.")
    count = F.size(labels)
    return F.when(
        count >= 2,
        F.transform(F.sequence(F.lit(1), count - 1), lambda at: F.array_join(F.slice(labels, at, count), ".")),
    ).otherwise(F.array(name))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, starts, ends) during which a pattern is on a list, from (list, kind, pattern, listed_on, action)."""
    days = (
        entries.where("pattern IS NOT NULL AND listed_on IS NOT NULL")
        .groupBy("list", "kind", "pattern", "listed_on")
        .agg(F.max(F.col("action") == "add").alias("on"))
    )
    order = Window.partitionBy("list", "kind", "pattern").orderBy("listed_on")
    ends = F.lead("listed_on").over(order)
    return days.withColumn("ends", ends).where("on").select("list", "kind", "pattern", F.col("listed_on").alias("starts"), "ends")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture (page_id, url, fetched_on): blocked, and the names of the lists that block it."""
    name = host()
    patterns = F.concat(
        F.transform(domains(name), lambda d: F.struct(F.lit("host").alias("kind"), d.alias("pattern"))),
        F.array(F.struct(F.lit("url").alias("kind"), bare_url().alias("pattern"))),
    )
    looked = F.when(name != "", patterns)
    rows = captures.select("page_id", "url", "fetched_on", F.explode_outer(looked).alias("p"))
    rows = rows.select("page_id", "url", "fetched_on", "p.kind", "p.pattern", F.trunc("fetched_on", "MM").alias("month"))
    bounds = captures.agg(F.trunc(F.min("fetched_on"), "MM").alias("low"), F.trunc(F.max("fetched_on"), "MM").alias("high"))
    spans = intervals(entries).join(F.broadcast(bounds)).where("ends IS NULL OR starts < ends")
    first = F.greatest(F.trunc("starts", "MM"), F.col("low"))
    last = F.least(F.trunc(F.date_sub("ends", 1), "MM"), F.col("high"))  # of the latter alone without an end
    by_month = spans.where(first <= last).withColumn("month", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))))
    found = rows.join(by_month, ["kind", "pattern", "month"], "left")
    active = (F.col("starts") <= F.col("fetched_on")) & (F.col("ends").isNull() | (F.col("fetched_on") < F.col("ends")))
    lists = F.array_sort(F.collect_set(F.when(active, F.col("list"))))
    judged = found.groupBy("page_id", "url", "fetched_on").agg(lists.alias("lists"))
    return judged.select(
        "page_id", "url", "fetched_on", (F.size("lists") > 0).alias("blocked"), F.array_join("lists", ",").alias("lists")
    )


def _number(text: Column) -> Column:
    """A number below 2**28 drawn from a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("int")


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages table, which has no dates, with a day of 2024 drawn from each page's id."""
    key = F.concat(F.lit("page"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    return pages.select("page_id", "url", F.date_add(F.to_date(F.lit("2024-01-01")), _number(key) % 366).alias("fetched_on"))


def drawn_entries(pages: DataFrame) -> DataFrame:
    """Lists drawn from the hosts and URLs of the pages: a host list with removals and returns, and a URL list."""
    day_one = F.to_date(F.lit("2024-01-01"))
    hosts = pages.select(host().alias("pattern")).where("pattern <> ''").distinct()
    number = _number(F.col("pattern"))
    start = number % 300
    dated = [
        F.struct((start).alias("day"), F.lit("add").alias("action"), F.lit(True).alias("used")),
        F.struct((start + 40).alias("day"), F.lit("remove").alias("action"), (number % 3 == 0).alias("used")),
        F.struct((start + 60).alias("day"), F.lit("add").alias("action"), (number % 6 == 0).alias("used")),
    ]
    above = hosts.select(F.element_at(domains(F.col("pattern")), -1).alias("pattern")).distinct()
    urls = pages.select(bare_url().alias("pattern")).where("pattern <> ''").distinct()

    def entries(frame: DataFrame, name: str, kind: str, one_in: int) -> DataFrame:
        chosen = frame.where(_number(F.concat(F.lit(name), "pattern")) % one_in == 0)
        rows = chosen.select("pattern", F.explode(F.array(*dated)).alias("e")).where("e.used")
        return rows.select(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), "pattern",
            F.date_add(day_one, F.col("e.day")).alias("listed_on"), F.col("e.action").alias("action"),
        )

    return (
        entries(hosts, "abuse", "host", 2)
        .union(entries(above, "policy", "host", 2))
        .union(entries(urls, "takedown", "url", 4))
    )


def judge_sql() -> str:
    """DuckDB SQL for :func:`judge` over the dated pages and the drawn entries."""

    def number(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 7) AS BIGINT)"

    def entries(frame: str, name: str, kind: str, one_in: int) -> str:
        chosen = f"(SELECT pattern, {number('pattern')} AS n FROM {frame} WHERE {number(f'{chr(39)}{name}{chr(39)} || pattern')} % {one_in} = 0)"
        tail = f"DATE '2024-01-01' + CAST(n % 300 + %d AS INTEGER) AS listed_on, '%s' AS action FROM {chosen}"
        head = f"SELECT '{name}' AS list, '{kind}' AS kind, pattern, "
        return " UNION ALL ".join(
            [
                head + tail.replace("%d", "0").replace("%s", "add"),
                head + tail.replace("%d", "40").replace("%s", "remove") + " WHERE n % 3 = 0",
                head + tail.replace("%d", "60").replace("%s", "add") + " WHERE n % 6 = 0",
            ]
        )

    return f"""WITH c AS (SELECT page_id, url, DATE '2024-01-01' + CAST({number("'page' || coalesce(CAST(page_id AS VARCHAR), '')")} % 366 AS INTEGER) AS fetched_on,
        lower(regexp_extract(url, '{_HOST}', 1)) AS host,
        lower(regexp_extract(url, '{_HOST}', 1)) || regexp_replace(regexp_extract(url, '{_PATH}', 1), '/+$', '') AS bare FROM pages),
      h AS (SELECT DISTINCT host AS pattern FROM c WHERE host <> ''),
      a AS (SELECT DISTINCT CASE WHEN len(string_split(pattern, '.')) >= 2 THEN array_to_string(string_split(pattern, '.')[-2:], '.')
            ELSE pattern END AS pattern FROM h),
      u AS (SELECT DISTINCT bare AS pattern FROM c WHERE bare <> ''),
      e AS ({entries("h", "abuse", "host", 2)} UNION ALL {entries("a", "policy", "host", 2)} UNION ALL {entries("u", "takedown", "url", 4)}),
      days AS (SELECT list, kind, pattern, listed_on, bool_or(action = 'add') AS active FROM e GROUP BY ALL),
      i AS (SELECT *, lead(listed_on) OVER (PARTITION BY list, kind, pattern ORDER BY listed_on) AS ends FROM days),
      m AS (SELECT DISTINCT page_id, url, fetched_on, i.list FROM c JOIN i ON i.active AND fetched_on >= listed_on AND (ends IS NULL OR fetched_on < ends)
            AND c.host <> '' AND ((kind = 'url' AND pattern = bare) OR (kind = 'host' AND (pattern = c.host OR
            (contains(pattern, '.') AND ends_with(c.host, '.' || pattern))))))
      SELECT c.page_id, c.url, c.fetched_on, count(list) > 0 AS blocked, coalesce(string_agg(list, ',' ORDER BY list), '') AS lists
      FROM (SELECT DISTINCT page_id, url, fetched_on FROM c) c LEFT JOIN m ON c.page_id IS NOT DISTINCT FROM m.page_id
      AND c.url IS NOT DISTINCT FROM m.url AND c.fetched_on = m.fetched_on GROUP BY ALL"""
