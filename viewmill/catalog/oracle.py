"""The queries of :mod:`viewmill.catalog.queries` in SQL over the same tables."""

from __future__ import annotations

from viewmill.catalog.queries import FIRST_LOAD_UNTIL, QUERIES
from viewmill.functions.device import BROWSER_RULES, OS_RULES, Rules
from viewmill.functions.network import IPV4
from viewmill.functions.text import URL_AUTHORITY
from viewmill.operators.enrich import SOCIAL_KEYWORDS
from viewmill.schemas import DIMENSIONS, EVENT_FIELDS, FACT, FACT_KEYS, LOCATION_FIELDS, SURROGATE_KEYS, TABLES
from viewmill.sources.testdata import INTERNAL_KEYWORDS, REFERRERS, RESOLUTIONS, USER_AGENTS


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _in_turn(number: str, choices) -> str:
    cases = " ".join(f"WHEN {i} THEN {_text(c)}" for i, c in enumerate(choices))
    return f"CASE {number} % {len(choices)} {cases} END"


def _device(rules: Rules) -> str:
    cases = " ".join(f"WHEN regexp_matches(user_agent, {_text(p)}) THEN {_text(n)}" for p, n in rules)
    return f"CASE WHEN coalesce(user_agent, '') = '' THEN 'UNKNOWN' {cases} ELSE 'Other' END"


def _authority(url: str) -> str:
    return f"regexp_extract(translate({url}, chr(9) || chr(13) || chr(10), ''), {_text(URL_AUTHORITY)}, 1)"


def _any_word(words) -> str:
    return "(" + " OR ".join(f"contains(lower(referrer_domain), {_text(w)})" for w in words) + ")"


def _place(name: str) -> str:
    return f"""CASE WHEN coalesce(ip, '') = '' THEN 'UNKNOWN'
        WHEN ip_number IS NULL AND NOT contains(ip, ':') THEN 'ERROR'
        WHEN ip_from IS NULL OR {name} = '-' THEN 'UNKNOWN' ELSE {name} END AS {name}"""


def _key(name: str) -> str:
    parts = SURROGATE_KEYS[name]
    return f"md5({parts[0]})" if len(parts) == 1 else f"md5(concat_ws('_', {', '.join(parts)}))"


def _first_per_key(table: str, columns, keys, order=()) -> str:
    """One row per key by an explicit sort, NULLs first as in Spark."""
    rank = [*order, *[c for c in columns if c not in keys and c not in order]]
    sort = ", ".join(f"{c} NULLS FIRST" for c in rank) or keys[0]
    return f"""SELECT {', '.join(columns)} FROM (
        SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {sort}) AS copy FROM {table}
    ) WHERE copy = 1"""


def _dimension(name: str, source: str) -> str:
    return _first_per_key(source, DIMENSIONS[name].columns, DIMENSIONS[name].key)


def _fact(source: str) -> str:
    return _first_per_key(source, FACT_KEYS, ["view_id"], ["local_time"])


def _star_sql(source: str, suffix: str = "") -> dict[str, str]:
    tables = {f"{name}{suffix}": _dimension(name, source) for name in DIMENSIONS}
    return tables | {f"fact{suffix}": _fact(source)}


# Each step may use those before it.
STEPS: dict[str, str] = {
    "raw_views": f"""
        SELECT CAST(event_id AS VARCHAR) AS id,
            '10.' || (user_id % 27) || '.' || (event_id % 256) || '.' || (user_id % 256) AS ip,
            {_in_turn('event_id', USER_AGENTS)} AS user_agent,
            {_in_turn('user_id', RESOLUTIONS)} AS resolution,
            CAST(user_id % 5 AS VARCHAR) AS store_id,
            strftime(ts, '%Y-%m-%d %H:%M:%S') AS local_time,
            url AS current_url,
            {_in_turn('event_id', REFERRERS)} AS referrer_url,
            CASE WHEN event_type = 'view' THEN 'view_product_detail' ELSE event_type END AS collection,
            json_extract_string(props, '$.k') AS product_id
        FROM events LEFT JOIN pages ON page_id = event_id % (SELECT greatest(count(*), 1) FROM pages)""",
    "ip_ranges": """
        SELECT (2560 + n_nationkey) * 65536::BIGINT AS ip_from,
            (2560 + n_nationkey) * 65536::BIGINT + 65535 AS ip_to,
            n_name AS country_code, n_name AS country_name, r_name AS region_name, '-' AS city_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "device": f"SELECT *, {_device(OS_RULES)} AS os, {_device(BROWSER_RULES)} AS browser FROM raw_views",
    "domains": f"""
        SELECT *,
            CASE WHEN coalesce(current_url, '') = '' THEN 'UNKNOWN' ELSE {_authority('current_url')} END AS domain,
            CASE WHEN coalesce(referrer_url, '') = '' THEN 'DIRECT'
                WHEN {_authority('referrer_url')} = '' THEN 'UNKNOWN'
                ELSE {_authority('referrer_url')} END AS referrer_domain
        FROM device""",
    "traffic": f"""
        SELECT *,
            CASE WHEN coalesce(referrer_url, '') = '' THEN 'Direct'
                WHEN {_any_word(SOCIAL_KEYWORDS)} THEN 'Social/Search'
                WHEN {_any_word(INTERNAL_KEYWORDS)} THEN 'Internal' ELSE 'Referral' END AS traffic_type
        FROM domains""",
    "numbered": f"""
        SELECT *, CASE WHEN regexp_matches(ip, {_text(IPV4)}) THEN
            split_part(ip, '.', 1)::BIGINT * 16777216 + split_part(ip, '.', 2)::BIGINT * 65536
            + split_part(ip, '.', 3)::BIGINT * 256 + split_part(ip, '.', 4)::BIGINT END AS ip_number
        FROM traffic""",
    "located": f"""
        SELECT numbered.*, {', '.join(_place(c) for c in LOCATION_FIELDS)}
        FROM numbered LEFT JOIN ip_ranges ON ip_number BETWEEN ip_from AND ip_to""",
    "timed": """
        SELECT *, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_obj,
            CAST(strftime(t, '%Y%m%d') AS INTEGER) AS sk_date, strftime(t, '%Y-%m-%d') AS full_date,
            CAST(day(t) AS INTEGER) AS day, CAST(month(t) AS INTEGER) AS month,
            CAST(year(t) AS INTEGER) AS year, CAST(strftime(t, '%H%M') AS INTEGER) AS sk_time,
            CAST(hour(t) AS INTEGER) AS hour, CAST(minute(t) AS INTEGER) AS minute
        FROM (SELECT *, try_strptime(local_time, '%Y-%m-%d %H:%M:%S') AS t FROM located)""",
    "events_enriched": f"SELECT *, {', '.join(f'{_key(k)} AS {k}' for k in SURROGATE_KEYS)} FROM timed",
    "enriched": """
        SELECT id AS view_id, * EXCLUDE (id, t, ip_number) FROM events_enriched
        WHERE collection = 'view_product_detail'""",
    "early": f"SELECT * FROM enriched WHERE local_time < {_text(FIRST_LOAD_UNTIL)}",
    **_star_sql("enriched"),
    **_star_sql("early", "_early"),
    "top_by_day": """
        SELECT f.sk_date, p.product_id, count(*) AS view_count,
            CAST(row_number() OVER (PARTITION BY f.sk_date ORDER BY count(*) DESC, p.product_id) AS INTEGER)
                AS rank
        FROM fact f JOIN dim_product p USING (sk_product) GROUP BY f.sk_date, p.product_id""",
    "breakdown": """
        SELECT sk_date, coalesce(traffic_type, 'UNKNOWN') AS traffic_type, count(*) AS view_count
        FROM fact LEFT JOIN dim_traffic_source USING (sk_traffic) GROUP BY ALL""",
}


def _with_steps(body: str) -> str:
    """``body`` preceded by those steps it needs, directly or through other steps."""
    needed: set[str] = set()
    pending = body
    for name in reversed(STEPS):
        if _mentions(pending, name):
            needed.add(name)
            pending += STEPS[name]
    steps = [f"{name} AS ({STEPS[name]})" for name in STEPS if name in needed]
    return f"WITH {', '.join(steps)} {body}" if steps else body


def _mentions(sql: str, name: str) -> bool:
    words = "".join(c if c.isalnum() or c == "_" else " " for c in sql).split()
    return name in words


def _inserted(name: str, key: str, columns) -> str:
    listed = ", ".join(columns)
    return f"""SELECT {listed}, 1 AS load FROM {name}_early
        UNION ALL SELECT {listed}, 2 AS load FROM {name}
        WHERE {key} NOT IN (SELECT {key} FROM {name}_early)"""


_STAR_ROWS = """
    SELECT f.*, product_id, store_id, domain, city_name, region_name, country_name, country_code,
        os, browser, resolution, referrer_domain, traffic_type, full_date, day, month, year, hour, minute
    FROM fact f JOIN dim_product USING (sk_product) JOIN dim_store USING (sk_store)
        JOIN dim_location USING (sk_location) JOIN dim_device USING (sk_device)
        JOIN dim_traffic_source USING (sk_traffic) JOIN dim_date USING (sk_date)
        JOIN dim_time USING (sk_time)"""

_EVENT = ", ".join(EVENT_FIELDS)
_VIEW = ", ".join("view_id" if c == "id" else c for c in EVENT_FIELDS)
_PLACE = ", ".join(LOCATION_FIELDS)
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"]

_LINES_INSERTED = f"""
    WITH open AS ({_first_per_key("(SELECT * FROM lineitem WHERE l_linestatus = 'O')", _LINE, _LINE[:2])}),
        lines AS ({_first_per_key("lineitem", _LINE, _LINE[:2])})
    SELECT {', '.join(_LINE)}, 1 AS load FROM open
    UNION ALL SELECT {', '.join(_LINE)}, 2 AS load FROM lines
    WHERE NOT EXISTS (SELECT 1 FROM open WHERE open.l_orderkey = lines.l_orderkey
        AND open.l_linenumber = lines.l_linenumber)"""

_BODIES: dict[str, str] = {
    "filter_product_views": f"""
        SELECT id AS view_id, {_EVENT.removeprefix('id, ')} FROM raw_views
        WHERE collection = 'view_product_detail'""",
    "time_dims": """
        SELECT id, timestamp_obj, sk_date, full_date, day, month, year, sk_time, hour, minute FROM timed""",
    "surrogate_keys": f"SELECT view_id, {', '.join(SURROGATE_KEYS)} FROM enriched",
    **{name: f"SELECT * FROM {name}" for name in DIMENSIONS},
    "fact_views": "SELECT * FROM fact",
    "fact_for_day": "SELECT * FROM fact WHERE sk_date = 20240105",
    "fact_join_product": "SELECT view_id, sk_date, product_id FROM fact JOIN dim_product USING (sk_product)",
    "fact_join_location": f"""
        SELECT view_id, sk_date, {_PLACE} FROM fact LEFT JOIN dim_location USING (sk_location)""",
    "fact_join_traffic": """
        SELECT view_id, sk_date, referrer_domain, traffic_type
        FROM fact LEFT JOIN dim_traffic_source USING (sk_traffic)""",
    "count_by_group": "SELECT sk_date, sk_traffic, count(*) AS view_count FROM fact GROUP BY ALL",
    "distinct_products": """
        SELECT sk_date, count(DISTINCT sk_product) AS unique_products FROM fact GROUP BY sk_date""",
    "product_rank": "SELECT * FROM top_by_day",
    "top_products": """
        SELECT * FROM (
            SELECT sk_date, concat_ws('/', collection, product_id) AS item, count(*) AS events,
                CAST(row_number() OVER (PARTITION BY sk_date ORDER BY count(*) DESC,
                    concat_ws('/', collection, product_id)) AS INTEGER) AS rank
            FROM timed GROUP BY 1, 2
        ) WHERE rank <= 10""",
    "daily_top_products": "SELECT * FROM top_by_day WHERE rank <= 50",
    "daily_views_by_country": """
        SELECT sk_date, coalesce(country_code, 'UNKNOWN') AS country_code,
            coalesce(country_name, 'UNKNOWN') AS country_name,
            count(*) AS view_count, count(DISTINCT sk_product) AS unique_products
        FROM fact LEFT JOIN dim_location USING (sk_location) GROUP BY 1, 2, 3""",
    "daily_traffic_breakdown": "SELECT * FROM breakdown",
    "rollup_sql": "SELECT * FROM top_by_day WHERE rank <= 50 AND sk_date = 20240105",
    "url_domain": f"SELECT page_id, {_authority('url')} AS domain FROM pages",
    "traffic_source": "SELECT id, domain, referrer_domain, traffic_type FROM traffic",
    "geo_lookup": f"SELECT id, {_PLACE} FROM located",
    "geo_lookup_shuffled": f"SELECT id, {_PLACE} FROM located",
    # An address of either family lies in the range of the country that its second part counts, if there is one.
    "geo_lookup_families": f"""
        SELECT id, {', '.join(f"CASE WHEN {c} = '-' THEN 'UNKNOWN' ELSE coalesce({c}, 'UNKNOWN') END AS {c}" for c in LOCATION_FIELDS)}
        FROM raw_views LEFT JOIN ip_ranges
            ON ip_from = (2560 + CAST(split_part(ip, '.', 2) AS BIGINT)) * 65536""",
    "device_dims": "SELECT id, os, browser FROM device",
    "enriched_views": "SELECT * FROM enriched",
    **{
        f"{name}_insert_if_absent": _inserted(name, table.key[0], table.columns)
        for name, table in DIMENSIONS.items()
    },
    "fact_insert_if_absent": _inserted("fact", "view_id", FACT_KEYS),
    "lineitem_insert_if_absent": _LINES_INSERTED,
    "lineitem_insert_bucketed": _LINES_INSERTED,
    "mart_upsert": "SELECT * FROM breakdown",
    "backfill_inserted_at": "SELECT *, '2024-02-01 00:00:00.000000' AS inserted_at FROM fact",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "rejected_views": """
        SELECT * FROM (
            SELECT view_id, concat_ws('; ',
                CASE WHEN user_agent IS NULL THEN 'user_agent is null' END,
                CASE WHEN referrer_url IS NULL THEN 'referrer_url is null' END,
                CASE WHEN length(current_url) > 45 THEN 'current_url exceeds 45' END) AS reason
            FROM enriched
        ) WHERE reason <> ''""",
    "fk_orphans": """
        SELECT view_id, sk_time FROM fact WHERE sk_time NOT IN (SELECT sk_time FROM dim_time_early)""",
    "overlong_values": """
        SELECT doc_id, 'text' AS column_name, CAST(length(text) AS INTEGER) AS length, 1000 AS max_length
        FROM documents WHERE length(text) > 1000
        UNION ALL SELECT doc_id, 'source', CAST(length(source) AS INTEGER), 5
        FROM documents WHERE length(source) > 5""",
    "freshness": """
        SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen, count(*) AS total,
            CAST(floor(date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31') / 1000000) AS BIGINT)
                AS lag_seconds,
            CASE WHEN max(ts) IS NULL THEN 'EMPTY'
                WHEN TIMESTAMP '2024-01-31' - max(ts) > INTERVAL 10 MINUTE THEN 'STALE' ELSE 'OK' END AS status
        FROM events""",
    "sk_date_for": """
        SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS ds, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS sk_date
        FROM events""",
    "decode_payload": "SELECT event_id, props AS json_payload FROM events",
    "parse_event_json": f"SELECT {', '.join(f'{c} AS data_{c}' for c in EVENT_FIELDS)} FROM raw_views",
    "flatten_event": "SELECT * FROM raw_views",
    "views_from_json": f"SELECT {_VIEW} FROM enriched",
    "preview_events": "SELECT event_id, event_type, props FROM events ORDER BY event_id LIMIT 5",
    "stream_star_load": _STAR_ROWS,
    "stream_replay": _STAR_ROWS,
    "stream_remembering": _STAR_ROWS,
    "refreshed_top_products": "SELECT * FROM top_by_day WHERE rank <= 50",
    "refreshed_traffic_breakdown": "SELECT * FROM breakdown",
    "merged_distinct_products": """
        SELECT sk_date, count(*) AS view_count, count(DISTINCT sk_product) AS unique_products
        FROM fact GROUP BY sk_date""",
    "loads_log": """
        SELECT 'early' AS load_id, (SELECT count(*) FROM early) AS views, count(*) AS facts,
            '2024-01-30 23:52:30.000000' AS last_inserted_at, CAST(count(DISTINCT sk_date) AS INTEGER) AS days,
            min(view_id) AS low_id, max(view_id) AS high_id
        FROM fact_early
        UNION ALL
        SELECT 'later', (SELECT count(*) FROM enriched), count(*), '2024-01-30 23:53:20.000000',
            CAST(count(DISTINCT sk_date) AS INTEGER), min(view_id), max(view_id)
        FROM fact WHERE view_id NOT IN (SELECT view_id FROM fact_early)""",
    "freshness_of_loads": """
        SELECT '2024-01-30 23:53:20.000000' AS last_seen, count(*) AS total, CAST(400 AS BIGINT) AS lag_seconds,
            'OK' AS status
        FROM fact""",
    "known_view_ids": "SELECT view_id FROM fact",
    "merged_star_rows": _STAR_ROWS,
}
_BODIES["refreshed_views_by_country"] = _BODIES["daily_views_by_country"]


def _constraints() -> str:
    """One SELECT per constraint, over the facts and the early dimensions."""
    sources = {name: f"{name}_early" for name in DIMENSIONS} | {FACT.name: "fact"}
    parts = []
    for name, source in sources.items():
        table = TABLES[name]
        columns = FACT_KEYS if name == FACT.name else table.columns
        rules = [(f"{c} is null", f"{c} IS NULL") for c in table.required if c in columns]
        rules += [(f"{c} exceeds {n}", f"length({c}) > {n}") for c, n in table.max_length.items() if c in columns]
        if name != FACT.name:
            rules_of_fact = f"{table.key[0]} IS NOT NULL AND {table.key[0]} NOT IN (SELECT {table.key[0]} FROM {source})"
            parts.append((FACT.name, f"{table.key[0]} points to nothing", f"FROM fact WHERE {rules_of_fact}"))
        parts += [(name, rule, f"FROM {source} WHERE {test}") for rule, test in rules]
        key = ", ".join(table.key)
        parts.append((name, "key is not unique", f"FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)"))
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{r}' AS rule, count(*) AS violations {rest}" for t, r, rest in parts
    )


_BODIES["star_constraints"] = _constraints()

ORACLE_SQL: dict[str, str] = {name: _with_steps(_BODIES[name]) for name in QUERIES}
