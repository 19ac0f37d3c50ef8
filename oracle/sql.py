"""DuckDB SQL for the registered queries, over the sample tables (mapping: FIXTURES.md).

The statements are put together from shared WITH parts. Wherever the engines differ, the text is explicit: null order,
``||`` for joining text, BIGINT around sums, and halves rounded before a cast to integer.
"""

from __future__ import annotations

from webmart.functions.categories import CATEGORY_RULES
from webmart.functions.paths import WHITE_SPACE
from webmart.operators.quality import NO_CATEGORY
from webmart.sources import sample



def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _pick(values: tuple, number: str) -> str:
    items = ", ".join(f"CAST({_text(value)} AS VARCHAR)" for value in values)
    return f"list_extract([{items}], CAST(({number}) % {len(values)} AS INTEGER) + 1)"


def _trimmed(url: str) -> str:
    return f"trim(lower({url}), '{WHITE_SPACE}')"


def _bare(path: str) -> str:
    return f"coalesce(nullif(rtrim({path}, '/'), ''), '/')"


def event_path(url: str) -> str:
    return _bare(f"regexp_extract({_trimmed(url)}, 'https?://[^/]+(/[^?#]*)', 1)")


def keyword_path(url: str) -> str:
    path = rf"regexp_extract({_trimmed(url)}, '^(?:[a-z][a-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    return _bare(f"regexp_replace({path}, ';[^/]*$', '')")


def stripped(path: str) -> str:
    prefix = sample.SETTINGS.site_prefix
    return (
        f"CASE WHEN {path} = '{prefix}' THEN '/' WHEN starts_with({path}, '{prefix}/') "
        f"THEN substr({path}, {len(prefix) + 1}) ELSE {path} END"
    )


def event_category(path: str) -> str:
    arms = []
    for pattern, category in CATEGORY_RULES:
        test = f"regexp_matches({path}, '{pattern}')"
        if "cap(?!e)" in pattern:
            rest = pattern.replace("|cap(?!e)", "")
            test = f"(regexp_matches({path}, '{rest}') OR ({path} LIKE '%cap%' AND {path} NOT LIKE '%cape%'))"
        arms.append(f"WHEN {test} THEN '{category}'")
    return "CASE " + " ".join(arms) + " END"


def keyword_category(path: str) -> str:
    arms = [f"WHEN {path} LIKE '/product/%' OR regexp_matches({path}, '-[a-z0-9]{{4,}}\\.html$') THEN NULL"]
    for pattern, category in CATEGORY_RULES:
        arms.append(f"WHEN regexp_matches({path}, '{pattern.replace('cap(?!e)', 'cap([^e]|$)')}') THEN '{category}'")
    return "CASE " + " ".join(arms) + " END"


def channel_group(medium: str) -> str:
    return (
        f"CASE lower({medium}) WHEN 'organic' THEN 'organic search' WHEN 'cpc' THEN 'paid search' WHEN 'ppc' THEN "
        "'paid search' WHEN 'paid' THEN 'paid search' WHEN 'paidsearch' THEN 'paid search' WHEN 'email' THEN 'email' "
        "WHEN 'e-mail' THEN 'email' WHEN 'newsletter' THEN 'email' WHEN 'social' THEN 'social' WHEN 'social-network' "
        "THEN 'social' WHEN 'social-media' THEN 'social' WHEN 'sm' THEN 'social' WHEN '(none)' THEN 'direct' WHEN "
        "'direct' THEN 'direct' WHEN 'referral' THEN 'referral' ELSE 'other' END"
    )


def rank_bucket(position: str) -> str:
    return (
        f"CASE WHEN {position} IS NULL OR {position} < 1 THEN '6 — No SEO Data' WHEN {position} > 50 THEN '5 — 51+' "
        f"WHEN {position} > 20 THEN '4 — Top 50' WHEN {position} > 10 THEN '3 — Top 20' "
        f"WHEN {position} > 3 THEN '2 — Top 10' ELSE '1 — Top 3' END"
    )


def _money(amount: str) -> str:
    return f"CAST(sum(CAST({amount} AS DECIMAL(38,9))) AS DOUBLE)"


def _days(period: tuple) -> str:
    return f"BETWEEN DATE '{period[0]}' AND DATE '{period[1]}'"


_FLAT = f"""
flat AS (
  SELECT CAST(user_id AS VARCHAR) AS user_pseudo_id,
         CASE WHEN event_id % 97 <> 5 THEN CAST(strftime(ts, '%Y%m%d') AS BIGINT) END AS ga_session_id,
         strftime(ts, '%Y%m%d') AS event_date,
         CASE event_type WHEN 'signup' THEN 'session_start' WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'page_view'
              WHEN 'purchase' THEN 'purchase' ELSE 'user_engagement' END AS event_name,
         epoch_us(ts) AS event_timestamp,
         {_pick(sample.MEDIA, "user_id")} AS medium,
         {_pick(sample.TRAFFIC_SOURCES, "user_id")} AS source,
         {_pick(sample.DEVICES, "user_id")} AS device_category,
         CASE WHEN user_id % 29 <> 3 THEN 'NATION_' || CAST(user_id % 25 AS VARCHAR) END AS country,
         CASE WHEN event_id % 11 <> 0 THEN value END AS purchase_revenue,
         {_pick(sample.PAGE_LOCATIONS, "event_id")} AS page_location,
         CASE WHEN event_id % 5 <> 0 THEN CASE WHEN value >= 50 THEN '1' ELSE '0' END END AS session_engaged,
         CASE WHEN event_id % 13 <> 0 THEN CASE WHEN event_id % 50 = 7 THEN 2500 ELSE event_id * 37 % 90000 END
         END AS engagement_time_msec
  FROM events
  WHERE strftime(ts, '%Y%m%d') BETWEEN '{sample.SETTINGS.event_days[0]}' AND '{sample.SETTINGS.event_days[1]}'
)"""

_RAW_KEYWORDS = f"""
raw_kw AS (
  SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS kw,
         CASE WHEN p_partkey % 37 <> 11 THEN p_size * 2 - 1 END AS pos,
         CASE WHEN p_partkey % 41 <> 7 THEN p_partkey * 7919 % 100000 END AS vol,
         p_retailprice / 1000 AS cpc,
         (p_partkey * 31 % 1000) / 10.0::DOUBLE AS traffic,
         (p_partkey % 100) / 100.0::DOUBLE AS competition,
         {_pick(sample.KEYWORD_URLS, "p_partkey")} AS url,
         {_pick(sample.KEYWORD_DOMAINS, "p_partkey // 20")} AS domain,
         CASE WHEN (p_partkey // 100) % 3 < 2 THEN 'organic' ELSE 'paid' END AS source
  FROM part
),
pathed_kw AS (SELECT *, {keyword_path("url")} AS page_path FROM raw_kw),
kw AS (SELECT *, {keyword_category("page_path")} AS join_category FROM pathed_kw),
target_kw AS (SELECT * FROM kw WHERE domain = 'merch.google' AND source = 'organic')"""

_LOOKUPS = r"""
path_lookup AS (
  SELECT regexp_replace(page_path, '\.html$', '') AS stripped_path,
         arg_min(page_path, (-length(page_path), page_path)) AS keyword_page_path
  FROM target_kw WHERE page_path IS NOT NULL GROUP BY 1
),
category_lookup AS (
  SELECT join_category, keyword_page_path FROM (
    SELECT join_category, page_path AS keyword_page_path,
           row_number() OVER (PARTITION BY join_category
                              ORDER BY coalesce(vol, 0) DESC, page_path ASC NULLS FIRST) AS place
    FROM target_kw WHERE join_category IS NOT NULL)
  WHERE place = 1
),
best_keyword AS (
  SELECT page_path, join_category, kw AS keyword, CAST(pos AS BIGINT) AS organic_position,
         CAST(vol AS BIGINT) AS search_volume
  FROM (SELECT *, row_number() OVER (PARTITION BY page_path
                  ORDER BY pos ASC NULLS FIRST, vol DESC NULLS LAST, kw ASC NULLS FIRST) AS place
        FROM target_kw WHERE page_path IS NOT NULL)
  WHERE place = 1
)"""

_ATTRS = f"""
attrs AS (
  SELECT user_pseudo_id, ga_session_id, CAST(strptime(event_date, '%Y%m%d') AS DATE) AS session_date,
         coalesce(medium, '(none)') AS channel, coalesce(source, '(direct)') AS source,
         coalesce(device_category, 'unknown') AS device_category, coalesce(country, 'unknown') AS country,
         {event_path("page_location")} AS landing_page_path,
         coalesce(session_engaged, '0') = '1' AS engaged_session,
         coalesce(engagement_time_msec, 0) / 1000.0::DOUBLE AS session_duration_sec
  FROM (SELECT *, row_number() OVER (PARTITION BY user_pseudo_id, ga_session_id
                                     ORDER BY event_timestamp ASC NULLS FIRST) AS place
        FROM flat WHERE event_name = 'session_start')
  WHERE place = 1
)"""

_VIEWS = f"""
views AS (
  SELECT user_pseudo_id, ga_session_id, {event_path("page_location")} AS raw_page_path
  FROM (SELECT *, row_number() OVER (PARTITION BY user_pseudo_id, ga_session_id
                                     ORDER BY event_timestamp ASC NULLS FIRST) AS place
        FROM flat WHERE event_name = 'page_view')
  WHERE place = 1
),
first_views AS (SELECT *, {stripped("raw_page_path")} AS stripped_path FROM views)"""

_RESOLVED = f"""
categorised AS (SELECT *, {event_category("stripped_path")} AS wanted FROM first_views),
resolved AS (
  SELECT c.user_pseudo_id, c.ga_session_id, c.raw_page_path, c.stripped_path,
         coalesce(p.keyword_page_path, k.keyword_page_path, c.stripped_path) AS page_path
  FROM categorised c
  LEFT JOIN path_lookup p ON c.stripped_path = p.stripped_path
  LEFT JOIN category_lookup k ON c.wanted = k.join_category
)"""

_METRICS = f"""
metrics AS (
  SELECT user_pseudo_id, ga_session_id,
         count(*) FILTER (WHERE event_name = 'page_view') AS page_views,
         count(*) FILTER (WHERE event_name = 'purchase') AS purchases,
         bool_or(session_engaged = '1') AS engaged_session,
         {_money("CASE WHEN event_name = 'purchase' THEN coalesce(purchase_revenue, 0) ELSE 0 END")} AS revenue
  FROM flat WHERE ga_session_id IS NOT NULL GROUP BY 1, 2
)"""

_SESSIONS = """
sessions AS (
  SELECT a.user_pseudo_id || '_' || CAST(a.ga_session_id AS VARCHAR) AS session_id, a.user_pseudo_id, a.ga_session_id,
         a.session_date, a.channel, a.source, a.device_category, a.country,
         coalesce(r.page_path, '/') AS page_path, a.landing_page_path,
         coalesce(m.engaged_session, FALSE) AS engaged_session,
         CAST(round(a.session_duration_sec) AS BIGINT) AS session_duration_sec,
         coalesce(m.page_views, 0) AS page_views, coalesce(m.purchases, 0) AS purchases,
         coalesce(m.revenue, 0) AS revenue
  FROM attrs a
  LEFT JOIN resolved r ON a.user_pseudo_id = r.user_pseudo_id AND a.ga_session_id = r.ga_session_id
  LEFT JOIN metrics m ON a.user_pseudo_id = m.user_pseudo_id AND a.ga_session_id = m.ga_session_id
)"""


def _calendar(first: str, last: str) -> str:
    return f"""
  SELECT CAST(d AS DATE) AS date_id, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month,
         monthname(d) AS month_name, CAST(strftime(d, '%U') AS BIGINT) AS week_of_year,
         CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week, dayname(d) AS day_name,
         dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d)"""


_first, _last = sample.SETTINGS.calendar
_DIMENSIONS = f"""
dim_date AS ({_calendar(f"TIMESTAMP '{_first}'", f"TIMESTAMP '{_last}'")}),
dim_channel AS (
  SELECT channel, source, {channel_group("channel")} AS channel_group FROM sessions GROUP BY channel, source
),
page_universe AS (
  SELECT coalesce(p.keyword_page_path, v.stripped_path) AS page_path
  FROM (SELECT {stripped("raw_page_path")} AS stripped_path
        FROM (SELECT {event_path("page_location")} AS raw_page_path FROM flat WHERE event_name = 'page_view')) v
  LEFT JOIN path_lookup p ON v.stripped_path = p.stripped_path
  UNION
  SELECT page_path FROM sessions
),
dim_page AS (
  SELECT u.page_path, b.join_category AS page_category, b.keyword AS top_keyword, b.organic_position, b.search_volume,
         b.page_path IS NOT NULL AS has_seo_data
  FROM page_universe u LEFT JOIN best_keyword b ON u.page_path = b.page_path
)"""

_RANKS = f"""
domain_ranks AS (
  SELECT CASE WHEN s_suppkey < 4 THEN {_pick(tuple(sample.SETTINGS.domains.values()), "s_suppkey")}
              ELSE 'shop-' || CAST(s_suppkey AS VARCHAR) || '.example' END AS domain,
         CAST(s_suppkey + 1 AS BIGINT) AS semrush_rank, CAST(floor(s_acctbal) AS BIGINT) AS organic_keywords,
         CAST(floor(s_acctbal) * 10 AS BIGINT) AS organic_traffic, CAST(s_nationkey AS BIGINT) AS organic_cost,
         CASE WHEN s_suppkey <> 2 THEN CAST(s_nationkey * 2 AS BIGINT) END AS paid_keywords,
         CAST(0 AS BIGINT) AS paid_traffic, CAST(0 AS BIGINT) AS paid_cost, CAST(0 AS BIGINT) AS pla_keywords,
         CAST(0 AS BIGINT) AS pla_uniques, DATE '{sample.SETTINGS.snapshot_date}' AS snapshot_date
  FROM supplier
),
dim_competitor AS (
  SELECT domain, semrush_rank, organic_keywords, organic_traffic, organic_cost, paid_keywords,
         domain = 'merch.google' AS is_target
  FROM domain_ranks
)"""

_FACT = """
fact AS (
  SELECT s.session_id, s.user_pseudo_id, s.ga_session_id, s.session_date, d.date_id, s.channel, s.source,
         coalesce(c.channel_group, 'other') AS channel_group, s.device_category, s.country, s.page_path,
         p.page_category, p.organic_position, p.has_seo_data, s.landing_page_path, s.engaged_session,
         s.session_duration_sec, s.page_views, s.purchases, s.revenue
  FROM sessions s
  LEFT JOIN dim_date d ON s.session_date = d.date_id
  LEFT JOIN dim_channel c ON s.channel = c.channel AND s.source = c.source
  LEFT JOIN dim_page p ON s.page_path = p.page_path
)"""

_ENRICHED = f"""
enriched AS (
  SELECT f.session_id, f.user_pseudo_id, f.ga_session_id, f.session_date, d.year, d.month, d.month_name,
         d.week_of_year, d.day_name, d.is_weekend, f.channel, f.source, f.channel_group, f.device_category,
         CASE WHEN lower(f.device_category) IN ('mobile', 'tablet') THEN 'Mobile' ELSE 'Desktop' END AS device_group,
         f.country, f.page_path, f.page_category, f.landing_page_path, f.has_seo_data, f.organic_position,
         p.top_keyword, p.search_volume, {rank_bucket("f.organic_position")} AS seo_rank_bucket,
         f.session_duration_sec, f.page_views, f.purchases, f.revenue,
         f.engaged_session AS is_engaged, f.purchases > 0 AS is_converted
  FROM fact f
  LEFT JOIN dim_date d ON f.date_id = d.date_id
  LEFT JOIN dim_page p ON f.page_path = p.page_path
)"""

_VOLUME = f"""count(session_id) AS sessions, count(*) FILTER (WHERE is_engaged) AS engaged_sessions,
         count(*) FILTER (WHERE is_converted) AS conversions, {_money("revenue")} AS revenue,
         count(*) FILTER (WHERE is_engaged) / nullif(count(session_id), 0) AS engagement_rate,
         count(*) FILTER (WHERE is_converted) / nullif(count(session_id), 0) AS conversion_rate,
         {_money("revenue")} / nullif(count(session_id), 0) AS revenue_per_session"""
_PAGE_VIEWS = "CAST(sum(page_views) AS DOUBLE) / nullif(count(session_id), 0) AS avg_page_views"

_REPORTS = f"""
rpt_channel AS (
  SELECT session_date, channel_group, device_group, {_VOLUME},
         CAST(sum(session_duration_sec) AS DOUBLE) / nullif(count(session_id), 0) AS avg_session_duration_sec,
         {_PAGE_VIEWS}
  FROM enriched GROUP BY ALL
),
rpt_seo AS (
  SELECT session_date, seo_rank_bucket, page_category, min(organic_position) AS best_organic_position,
         avg(CAST(search_volume AS DOUBLE)) AS avg_search_volume, {_VOLUME}
  FROM enriched GROUP BY ALL
),
rpt_landing AS (
  SELECT session_date, landing_page_path, page_category, has_seo_data, organic_position, search_volume, top_keyword,
         {rank_bucket("organic_position")} AS seo_rank_bucket, {_VOLUME}, {_PAGE_VIEWS}
  FROM (SELECT e.session_date, e.landing_page_path, e.session_id, e.is_engaged, e.is_converted, e.revenue, e.page_views,
               p.page_category, p.has_seo_data, p.organic_position, p.search_volume, p.top_keyword
        FROM enriched e LEFT JOIN dim_page p ON e.landing_page_path = p.page_path)
  GROUP BY ALL
)"""


def _period(name: str, days: tuple) -> str:
    return f"""
{name} AS (
  SELECT g AS channel_group, count(DISTINCT session_id) AS sessions,
         count(*) FILTER (WHERE purchases > 0) AS conversions,
         round(count(*) FILTER (WHERE purchases > 0) / nullif(count(DISTINCT session_id), 0) * 100, 2)
           AS conversion_rate,
         round({_money("coalesce(revenue, 0)")}, 2) AS revenue,
         round({_money("coalesce(revenue, 0)")} / nullif(count(DISTINCT session_id), 0), 2) AS avg_revenue_per_session
  FROM (SELECT f.*, coalesce(c.channel_group, 'other') AS g
        FROM fact f LEFT JOIN dim_channel c ON f.channel = c.channel AND f.source = c.source)
  WHERE session_date {_days(days)} GROUP BY g
)"""


_SUMMARY = f"""{_period("cur", sample.SETTINGS.current_period)},{_period("prev", sample.SETTINGS.previous_period)},
channel_summary AS (
  SELECT c.channel_group, c.sessions, c.conversions, c.conversion_rate, c.revenue, c.avg_revenue_per_session,
         coalesce(p.sessions, 0) AS prev_sessions, coalesce(p.conversions, 0) AS prev_conversions,
         coalesce(p.conversion_rate, 0) AS prev_conversion_rate, coalesce(p.revenue, 0) AS prev_revenue,
         coalesce(p.avg_revenue_per_session, 0) AS prev_avg_revenue_per_session
  FROM cur c LEFT JOIN prev p ON c.channel_group = p.channel_group
),
brief AS (
  SELECT channel_group, revenue, concat_ws(chr(10),
         'Channel: ' || channel_group,
         '  Sessions: ' || format('{{:,}}', sessions),
         '  Conversions: ' || format('{{:,}}', conversions),
         '  Conversion Rate: ' || CAST(conversion_rate AS VARCHAR) || '% (Previous: '
           || CAST(prev_conversion_rate AS VARCHAR)
           || '%, Change: ' || printf('%+.2f', conversion_rate - prev_conversion_rate) || '%)',
         '  Revenue: $' || format('{{:,.2f}}', revenue) || ' (Previous: $' || format('{{:,.2f}}', prev_revenue)
           || ', Change: $' || CASE WHEN revenue - prev_revenue < 0 THEN '-' ELSE '+' END
           || format('{{:,.2f}}', abs(revenue - prev_revenue)) || ')') AS brief
  FROM channel_summary
)"""

_KW = (_RAW_KEYWORDS, _LOOKUPS)
_STAGED = (_FLAT, *_KW, _ATTRS, _VIEWS, _RESOLVED, _METRICS, _SESSIONS)
_REPEATED = """
SELECT param, count(*) FILTER (WHERE has) AS event_count, count(*) FILTER (WHERE has AND first AND again) AS repeated_count
FROM (
  SELECT event_timestamp // 1000000 % 7 = 0 AS again, unnest([
    {'param': 'ga_session_id', 'has': ga_session_id IS NOT NULL, 'first': true},
    {'param': 'page_location', 'has': page_location IS NOT NULL, 'first': ga_session_id IS NULL},
    {'param': 'session_engaged', 'has': session_engaged IS NOT NULL, 'first': ga_session_id IS NULL AND page_location IS NULL},
    {'param': 'engagement_time_msec', 'has': engagement_time_msec IS NOT NULL,
     'first': ga_session_id IS NULL AND page_location IS NULL AND session_engaged IS NULL}], recursive := true)
  FROM flat)
GROUP BY param"""

_FLAWED = """
flawed AS (
  SELECT *, source || '_keywords_' || replace(domain, '.', '_') AS export,
         CASE WHEN p_partkey % 17 = 3 THEN 'n/a' ELSE CAST(pos AS VARCHAR) END AS bad_pos,
         CASE WHEN p_partkey % 19 = 4 THEN replace(CAST(cpc AS VARCHAR), '.', ',') ELSE CAST(cpc AS VARCHAR) END AS bad_cpc
  FROM (SELECT *, CAST(regexp_extract(kw, '([0-9]+)$', 1) AS BIGINT) AS p_partkey FROM kw)
  WHERE NOT (source = 'paid' AND domain = 'zazzle.com')
)"""

_REJECTS = """
SELECT export, kw AS keyword, 'Position' AS "column", bad_pos AS text FROM flawed
WHERE p_partkey % 23 <> 5 AND p_partkey % 17 = 3
UNION ALL
SELECT export, kw, 'CPC', bad_cpc FROM flawed WHERE p_partkey % 23 <> 5 AND p_partkey % 19 = 4
UNION ALL
SELECT export, kw, NULL,
       kw || ';' || coalesce(bad_pos, '') || ';' || coalesce(CAST(vol AS VARCHAR), '') || ';' || bad_cpc || ';'
       || CAST(traffic AS VARCHAR) || ';' || CAST(competition AS VARCHAR) || ';'
       || coalesce(CASE WHEN contains(url, ';') THEN '"' || url || '"' ELSE url END, '') || ';'
       || CASE WHEN source = 'paid' THEN kw ELSE coalesce(CAST(pos AS VARCHAR), '') END || ';surplus'
FROM flawed WHERE p_partkey % 23 = 5"""

_CHECKED = """
SELECT export, true AS accepted, source AS family,
       CASE source WHEN 'organic' THEN 'Position Difference,Traffic Cost (%),Number of Results,Trends'
                   ELSE 'Traffic Cost (%),Description' END AS missing,
       '' AS extra,
       CASE source WHEN 'organic' THEN 'Previous Position,Search Volume,CPC,Url,Traffic (%),Competition' ELSE '' END AS moved,
       count(*) AS row_count
FROM flawed GROUP BY export, source
UNION ALL SELECT 'paid_keywords_zazzle_com', false, NULL, NULL, NULL, NULL, 1"""

_REBUILT = """
SELECT step, domain, source, count(*) AS row_count, CAST(sum(vol) AS BIGINT) AS search_volume
FROM kw, (VALUES ('first'), ('failed'), ('whole')) AS steps(step)
WHERE source = 'organic' OR step = 'whole'
GROUP BY ALL"""

_MART = (*_STAGED, _DIMENSIONS, _RANKS, _FACT, _ENRICHED, _REPORTS, _SUMMARY)


def _with(parts: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _counts(label: str, tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) AS row_count FROM {table}" for name, table in tables.items()
    )


_PREPARED = f"""SELECT domain, source, '{sample.SETTINGS.snapshot_date}' AS snapshot_date, kw AS "Keyword",
  CAST(pos AS VARCHAR) AS "Position", CAST(vol AS VARCHAR) AS "Search Volume", CAST(cpc AS VARCHAR) AS "CPC",
  CAST(traffic AS VARCHAR) AS "Traffic (%)", CAST(competition AS VARCHAR) AS "Competition", url AS "Url", page_path,
  join_category, domain = 'merch.google' AND join_category IS NOT NULL AS joinable_to_ga4 FROM kw"""
_LOADED = f"""SELECT domain, source, DATE '{sample.SETTINGS.snapshot_date}' AS snapshot_date, kw AS "Keyword",
  CAST(pos AS BIGINT) AS "Position", CAST(vol AS BIGINT) AS "Search_Volume", cpc AS "CPC", traffic AS "Traffic_pct",
  competition AS "Competition", url AS "Url", page_path, join_category,
  domain = 'merch.google' AND join_category IS NOT NULL AS joinable_to_ga4 FROM kw"""
_EXPORTED = """SELECT domain, source, kw AS "Keyword", CAST(pos AS VARCHAR) AS "Position",
  CAST(vol AS VARCHAR) AS "Search Volume", CAST(cpc AS VARCHAR) AS "CPC", CAST(traffic AS VARCHAR) AS "Traffic (%)",
  CAST(competition AS VARCHAR) AS "Competition", url AS "Url"{extra} FROM raw_kw"""
_EVENT_KEYS = "user_pseudo_id, event_timestamp, page_location"
_PATHED = f"pathed AS (SELECT *, {event_path('page_location')} AS page_path FROM flat)"


def statements() -> dict[str, str]:
    top = f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY domain, source
      ORDER BY "Traffic_pct" DESC NULLS LAST, "Keyword" ASC NULLS FIRST, "Url" ASC NULLS FIRST) AS place
      FROM ({_LOADED})) WHERE place <= 500"""
    phrases = ", ".join(_text(phrase) for phrase in sample.SAMPLE_PHRASES)
    share = "CAST(count(*) FILTER (WHERE {}) AS DOUBLE) / nullif(count(*), 0) * 100"
    joinable = "domain = 'merch.google' AND join_category IS NOT NULL"
    product = "starts_with(page_path, '/product/')"
    other = f"count(*) FILTER (WHERE join_category IS NULL) - count(*) FILTER (WHERE {product})"
    return {
        "ga4_events_scan": _with(
            (_FLAT,),
            "SELECT user_pseudo_id, event_date, event_name, event_timestamp, medium, source, device_category, country, "
            "purchase_revenue FROM flat",
        ),
        "ga4_params": _with((_FLAT,), "SELECT * FROM flat"),
        "path_normalize": _with((_FLAT, _PATHED), f"SELECT {_EVENT_KEYS}, page_path FROM pathed"),
        "path_normalize_kw": _with(
            (_RAW_KEYWORDS,), 'SELECT kw AS "Keyword", url AS "Url", page_path FROM pathed_kw'
        ),
        "path_normalize_pages": (
            f"SELECT page_id, url, {event_path('url')} AS event_path, {keyword_path('url')} AS keyword_path FROM pages"
        ),
        "prefix_strip": _with(
            (_FLAT, _PATHED), f"SELECT {_EVENT_KEYS}, {stripped('page_path')} AS stripped_path FROM pathed"
        ),
        "category_ga4": _with(
            (_FLAT, _PATHED, f"cut AS (SELECT *, {stripped('page_path')} AS stripped_path FROM pathed)"),
            f"SELECT {_EVENT_KEYS}, stripped_path, {event_category('stripped_path')} AS category FROM cut",
        ),
        "category_kw": _with((_RAW_KEYWORDS,), 'SELECT kw AS "Keyword", page_path, join_category FROM kw'),
        "keyword_csv_scan": _with((_RAW_KEYWORDS,), _EXPORTED.format(extra="")),
        "keyword_union": _with(
            (_RAW_KEYWORDS,),
            _EXPORTED.format(
                extra=", CASE WHEN source = 'organic' THEN CAST(pos AS VARCHAR) END AS \"Previous Position\", "
                "CASE WHEN source = 'paid' THEN kw END AS \"Title\""
            ),
        ),
        "keyword_rejects": _with((_RAW_KEYWORDS, _FLAWED), _REJECTS),
        "export_error_check": _with((_RAW_KEYWORDS, _FLAWED), _CHECKED),
        "domain_ranks_scan": _with((_RANKS,), "SELECT * FROM domain_ranks"),
        "ga4_day_shards": _with(
            (_FLAT,),
            "SELECT user_pseudo_id, event_date, event_name, event_timestamp, CAST(CAST(ga_session_id IS NOT NULL AS INTEGER) "
            "+ CAST(page_location IS NOT NULL AS INTEGER) + CAST(session_engaged IS NOT NULL AS INTEGER) "
            "+ CAST(engagement_time_msec IS NOT NULL AS INTEGER) AS INTEGER) AS n_params "
            "FROM flat WHERE event_date IN ('20240104', '20240106')",
        ),
        "ga4_param_repeats": _with((_FLAT,), _REPEATED),
        "keyword_union_partial": _with(
            (_RAW_KEYWORDS,),
            'SELECT domain, source, kw AS "Keyword", url AS "Url" FROM raw_kw '
            "WHERE source = 'organic' AND domain IN ('merch.google', 'zazzle.com')",
        ),
        "keyword_load_kept_text": _with(
            (_RAW_KEYWORDS,),
            'SELECT domain, kw AS "Keyword", CAST(pos AS BIGINT) AS "Position", cpc AS "CPC", '
            "coalesce(join_category, '') AS join_category, coalesce(url, '') AS \"Url\", "
            f"{joinable} AS joinable_to_ga4 FROM kw",
        ),
        "keyword_snapshot_today": _with(
            (_RAW_KEYWORDS,), "SELECT domain, count(*) AS row_count, true AS is_today FROM kw GROUP BY domain"
        ),
        "top_3000_keywords_per_domain": _with((_RAW_KEYWORDS,), top.replace("<= 500", "<= 3000")),
        "insights_table": _with(
            _MART,
            "SELECT 'channel_recommendation' AS insight_type, d AS generated_date, "
            "'Channel Performance Summary (2024-01-16 to 2024-01-30):' || chr(10) || chr(10) || "
            "string_agg(brief || chr(10), chr(10) ORDER BY revenue DESC, channel_group) AS insight_text "
            "FROM brief, (VALUES (DATE '2024-02-01'), (DATE '2024-02-02')) AS days(d) GROUP BY d",
        ),
        "v_channel_summary_view": _with(_MART, "SELECT * FROM channel_summary"),
        "dim_page_one_scan": _with(_MART, "SELECT * FROM dim_page"),
        "table_rebuild": _with((_RAW_KEYWORDS,), _REBUILT),
        "keyword_prepare": _with((_RAW_KEYWORDS,), _PREPARED),
        "keyword_load": _with((_RAW_KEYWORDS,), _LOADED),
        "kw_path_lookup": _with(_KW, "SELECT * FROM path_lookup"),
        "kw_category_lookup": _with(_KW, "SELECT * FROM category_lookup"),
        "best_keyword": _with(_KW, "SELECT * FROM best_keyword"),
        "top_keywords_per_domain": _with((_RAW_KEYWORDS,), top),
        "known_keyword_lookup": _with(
            (_RAW_KEYWORDS,), f'SELECT * FROM ({_LOADED}) WHERE "Keyword" IN ({phrases})'
        ),
        "session_attrs": _with((_FLAT, _ATTRS), "SELECT * FROM attrs"),
        "first_page_view": _with((_FLAT, _VIEWS), "SELECT * FROM first_views"),
        "session_metrics": _with((_FLAT, _METRICS), "SELECT * FROM metrics"),
        "page_resolve": _with((_FLAT, *_KW, _VIEWS, _RESOLVED), "SELECT * FROM resolved"),
        "stg_sessions": _with(_STAGED, "SELECT * FROM sessions"),
        "domain_ranks": _with((_RANKS,), "SELECT * FROM domain_ranks"),
        "dim_date": "WITH span AS (SELECT date_trunc('day', min(ts)) AS a, date_trunc('day', max(ts)) AS b FROM events)"
        + _calendar("(SELECT a FROM span)", "(SELECT b FROM span)"),
        "dim_channel": _with(_MART, "SELECT * FROM dim_channel"),
        "page_universe": _with(_MART, "SELECT * FROM page_universe"),
        "dim_page": _with(_MART, "SELECT * FROM dim_page"),
        "dim_competitor": _with((_RANKS,), "SELECT * FROM dim_competitor"),
        "fact_sessions": _with(_MART, "SELECT * FROM fact"),
        "rpt_sessions_enriched": _with(_MART, "SELECT * FROM enriched"),
        "rpt_channel_performance": _with(_MART, "SELECT * FROM rpt_channel"),
        "rpt_seo_performance": _with(_MART, "SELECT * FROM rpt_seo"),
        "rpt_landing_page_performance": _with(_MART, "SELECT * FROM rpt_landing"),
        "v_channel_summary": _with(_MART, "SELECT * FROM channel_summary ORDER BY revenue DESC, channel_group"),
        "channel_brief": _with(_MART, "SELECT channel_group, revenue, brief FROM brief"),
        "insights_append": _with(
            _MART,
            "SELECT '2024-02-01 06:00:00' AS generated_at, 'channel_recommendation' AS insight_type, "
            "'Channel Performance Summary (2024-01-16 to 2024-01-30):' || chr(10) || chr(10) || "
            "string_agg(brief || chr(10), chr(10) ORDER BY revenue DESC, channel_group) AS insight_text, "
            "DATE '2024-02-01' AS generated_date FROM brief",
        ),
        "val_keyword_counts": _with(
            (_RAW_KEYWORDS,), "SELECT domain, source, count(*) AS row_count FROM kw GROUP BY ALL ORDER BY 1, 2"
        ),
        "val_sessions": _with(
            _STAGED,
            "SELECT count(*) AS row_count, min(session_date) AS earliest_date, max(session_date) AS latest_date, "
            "count(*) FILTER (WHERE purchases > 0) AS sessions_with_purchases FROM sessions",
        ),
        "val_marts": _with(
            _MART,
            _counts(
                "table_name",
                {
                    "dim_date": "dim_date",
                    "dim_channel": "dim_channel",
                    "dim_page": "dim_page",
                    "dim_competitor": "dim_competitor",
                    "fact_sessions": "fact",
                },
            ),
        ),
        "val_reporting": _with(
            _MART,
            _counts(
                "view_name",
                {
                    "rpt_sessions_enriched": "enriched",
                    "rpt_channel_performance": "rpt_channel",
                    "rpt_seo_performance": "rpt_seo",
                    "rpt_landing_page_performance": "rpt_landing",
                },
            ),
        ),
        "prep_summary": _with(
            (_RAW_KEYWORDS,),
            f"SELECT count(*) AS total_rows, count(*) FILTER (WHERE {joinable}) AS joinable, "
            f"count(*) FILTER (WHERE {product}) AS product_pages, {other} AS other_non_joinable, "
            f"{share.format(joinable)} AS joinable_pct, {share.format(product)} AS product_pages_pct, "
            f"CAST({other} AS DOUBLE) / nullif(count(*), 0) * 100 AS other_non_joinable_pct FROM kw",
        ),
        "prep_category_breakdown": _with(
            (_RAW_KEYWORDS,),
            f"SELECT coalesce(join_category, '{NO_CATEGORY}') AS category, count(*) AS row_count FROM kw "
            "WHERE domain = 'merch.google' GROUP BY 1 ORDER BY 2 DESC, 1",
        ),
        "prep_domain_joinable": _with(
            (_RAW_KEYWORDS,),
            f"SELECT domain, count(*) AS row_count, CAST(count(*) FILTER (WHERE {joinable}) AS DOUBLE) / count(*) "
            "AS joinable_share FROM kw GROUP BY 1",
        ),
    }
