"""SQL texts equivalent to the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

from marketlake.schemas import DISTRICTS, TOTAL_AREA, TOTAL_DISTRICT

_LISTED = ", ".join(f"'{a}'" for a in DISTRICTS)
_FIRST_TEN = ", ".join(f"'{a}'" for a in list(DISTRICTS)[:10])
_DIM = ", ".join(
    "('{}', '{}')".format(a, d.replace("'", "''")) for a, d in [*DISTRICTS.items(), (TOTAL_AREA, TOTAL_DISTRICT)]
)


def _postcode(key: str) -> str:
    return (
        f"CASE WHEN {key} % 11 <> 0 THEN 'SW' || CAST({key} % 25 + 1 AS VARCHAR)"
        f" || CASE WHEN {key} % 25 = 0 THEN 'A' ELSE '' END || ' ' || CAST({key} % 9 AS VARCHAR) || 'AA' END"
    )


def _latitude(key: str) -> str:
    return f"(CAST(51.4 AS DOUBLE) + ({key} % 100) / CAST(1000 AS DOUBLE))"


def _longitude(key: str) -> str:
    return f"(CAST(-0.2 AS DOUBLE) + ({key} % 77) / CAST(1000 AS DOUBLE))"


_NORMAL = "nullif(regexp_extract(split_part(postcode, ' ', 1), '^([A-Z]{1,2}[0-9]+)', 1), '')"


def _dedupe_properties(source: str, area: str = "split_part(postcode, ' ', 1)") -> str:
    return f"""
    SELECT prop_id, address, latitude, longitude, postcode, CAST(scraped_at AS DATE) AS last_seen,
           CAST(first_at AS DATE) AS first_seen, {area} AS area_code
    FROM (SELECT *, row_number() OVER (PARTITION BY prop_id ORDER BY scraped_at DESC NULLS LAST,
                   address DESC NULLS LAST, latitude DESC, longitude DESC, postcode DESC NULLS LAST) AS rn,
                 min(scraped_at) OVER (PARTITION BY prop_id) AS first_at
          FROM {source})
    WHERE rn = 1"""


def _dedupe_prices(source: str) -> str:
    return f"""
    SELECT prop_id, price, date
    FROM (SELECT *, row_number() OVER (PARTITION BY prop_id, date
                   ORDER BY scraped_at DESC NULLS LAST, price DESC NULLS LAST) AS rn FROM {source})
    WHERE rn = 1"""


def _fact(prices: str, props: str, listed: str = _LISTED, date: str = "date") -> str:
    measures = (
        "CAST(trunc(avg(price)) AS INTEGER) AS avg_price,"
        " CAST(quantile_disc(price, 0.5) AS INTEGER) AS median_price, count(*) AS num_properties"
    )
    return f"""
    SELECT *, strftime(date, '%B') AS month, strftime(date, '%Y') AS year FROM (
      SELECT p.{date} AS date, area_code, {measures}
      FROM {prices} p JOIN {props} q ON p.prop_id = q.prop_id WHERE area_code IN ({listed})
      GROUP BY p.{date}, area_code
      UNION ALL
      SELECT {date} AS date, '{TOTAL_AREA}' AS area_code, {measures} FROM {prices} GROUP BY {date})"""


def _merge(late: bool = False) -> str:
    older = "least(t.first_seen, s.first_seen)" if late else "t.first_seen"

    def pick(column: str, newer: str) -> str:
        return (
            f"CASE WHEN t.prop_id IS NULL THEN s.{column} WHEN s.last_seen > t.last_seen THEN {newer}"
            f" ELSE t.{column} END AS {column}"
        )

    plain = ", ".join(pick(c, f"s.{c}") for c in ("address", "latitude", "longitude"))
    return f"""
    SELECT coalesce(t.prop_id, s.prop_id) AS prop_id, {plain},
           {pick('postcode', 'coalesce(s.postcode, t.postcode)')},
           {pick('last_seen', 's.last_seen')},
           CASE WHEN t.prop_id IS NULL THEN s.first_seen
                WHEN s.last_seen > t.last_seen THEN least(t.first_seen, s.first_seen)
                WHEN s.prop_id IS NOT NULL THEN {older} ELSE t.first_seen END AS first_seen,
           {pick('area_code', 'coalesce(s.area_code, t.area_code)')}
    FROM props_1 t FULL OUTER JOIN props_2 s ON t.prop_id = s.prop_id"""


# Named subqueries; a text gets those it names, directly or through others.
_CTES = {
    "raw": f"""
    SELECT event_id, user_id AS prop_id, CAST(event_id AS VARCHAR) || ' Test Street' AS address,
           {_latitude('user_id')} AS latitude, {_longitude('user_id')} AS longitude, ts AS scraped_at,
           {_postcode('user_id')} AS postcode, CAST(ts AS DATE) AS date,
           CAST(floor(value * 100) AS INTEGER) AS price
    FROM events""",
    "raw_index": """
    SELECT CAST(o_orderdate AS DATE) AS date, round(o_totalprice, 2) AS close,
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS loaded_at
    FROM orders""",
    "trusted": "SELECT * FROM raw WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0",
    "props": _dedupe_properties("raw"),
    "props_norm": _dedupe_properties("raw", _NORMAL),
    "prices": _dedupe_prices("raw"),
    "index_rows": """
    SELECT date, close, loaded_at
    FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY loaded_at DESC, close DESC) AS rn FROM raw_index)
    WHERE rn = 1""",
    "legacy_prices": """
    SELECT prop_id, price, scraped_at FROM (
      SELECT prop_id, price - 500 AS price, date AS scraped_at,
             row_number() OVER (PARTITION BY prop_id, date ORDER BY r.scraped_at DESC, price DESC) AS rn
      FROM raw r WHERE price - 500 > 0)
    WHERE rn = 1""",
    "fact": _fact("prices", "props"),
    "fact_norm": _fact("prices", "props_norm"),
    "current_rows": f"""
    SELECT q.prop_id, address, postcode, latitude, longitude, area_code, price, date
    FROM prices p JOIN props q ON p.prop_id = q.prop_id
    WHERE date = (SELECT max(date) FROM prices) AND area_code IN ({_LISTED})""",
    "merged_fact": _fact("merged_prices", "merged_props"),
    "merged_current": f"""
    SELECT q.prop_id, area_code, price FROM merged_prices p JOIN merged_props q ON p.prop_id = q.prop_id
    WHERE date = (SELECT max(date) FROM merged_prices) AND area_code IN ({_LISTED})""",
    "dim": f"SELECT * FROM (VALUES {_DIM}) AS v(area_code, district)",
    "summary": """
    SELECT f.area_code, district, avg_price, median_price, num_properties
    FROM fact f JOIN dim d ON f.area_code = d.area_code
    WHERE f.area_code <> 'all' AND date = (SELECT max(date) FROM fact WHERE area_code <> 'all')""",
    "large_prices": """
    SELECT l_partkey AS prop_id, CAST(date_trunc('year', l_shipdate) AS DATE) AS date,
           CAST(floor(l_extendedprice) AS INTEGER) AS price
    FROM lineitem""",
    "large_props": f"""
    SELECT prop_id, split_part(postcode, ' ', 1) AS area_code
    FROM (SELECT p_partkey AS prop_id, {_postcode('p_partkey')} AS postcode FROM part)""",
    "marked": """
    SELECT * REPLACE (CASE WHEN event_id % 5 <> 0 THEN postcode END AS postcode),
           prop_id % 7 <> 0 AND CASE WHEN prop_id % 5 = 0 THEN day(scraped_at) > 10
             ELSE day(scraped_at) <= 20 AND event_id % 2 = 0 END AS early
    FROM raw""",
    "marked_1": "SELECT * FROM marked WHERE early",
    "marked_2": "SELECT * FROM marked WHERE NOT early",
    "props_1": _dedupe_properties("marked_1"),
    "props_2": _dedupe_properties("marked_2"),
    "prices_1": _dedupe_prices("marked_1"),
    "prices_2": _dedupe_prices("marked_2"),
    "merged_prices": """
    SELECT * FROM prices_1
    UNION ALL
    SELECT * FROM prices_2 s
    WHERE NOT EXISTS (SELECT 1 FROM prices_1 t WHERE t.prop_id = s.prop_id AND t.date = s.date)""",
    "merged_props": _merge(),
    "globe_points": """
    SELECT c_custkey AS prop_id,
           CASE WHEN c_custkey % 50 <> 0 THEN CASE WHEN c_custkey % 7 = 0 THEN 88.1::DOUBLE + (c_custkey * 13 % 181) / 100.0::DOUBLE
             ELSE (c_custkey * 61 % 1777) / 10.0::DOUBLE - 88 END END AS latitude,
           CASE WHEN c_custkey % 4 = 0 THEN 179.5::DOUBLE + (c_custkey * 17 % 101) / 100.0::DOUBLE
             ELSE (c_custkey * 97 % 3607) / 10.0::DOUBLE - 180 END AS longitude FROM customer""",
    "globe_sites": """
    SELECT s_suppkey AS site_id, (s_suppkey * 811 % 17903) / 100.0::DOUBLE - 89.3::DOUBLE AS latitude,
           (s_suppkey * 1237 % 36013) / 100.0::DOUBLE - 180.3::DOUBLE AS longitude FROM supplier""",
    "points": """
    SELECT c_custkey AS prop_id,
           CASE WHEN c_custkey % 50 <> 0 THEN CAST(51.3 AS DOUBLE) + (c_custkey * 37 % 1000) / CAST(2500 AS DOUBLE)
           END AS latitude,
           CAST(-0.5 AS DOUBLE) + (c_custkey * 91 % 997) / CAST(1500 AS DOUBLE) AS longitude
    FROM customer""",
    "sites": """
    SELECT s_suppkey AS site_id, CAST(51.3 AS DOUBLE) + (s_suppkey * 53 % 101) / CAST(250 AS DOUBLE) AS latitude,
           CAST(-0.5 AS DOUBLE) + (s_suppkey * 29 % 89) / CAST(130 AS DOUBLE) AS longitude,
           'SW' || CAST(s_suppkey % 20 + 1 AS VARCHAR) || ' 1AA' AS postcode
    FROM supplier""",
    "measured": """
    SELECT prop_id, site_id, s.postcode,
           (p.longitude * CAST(0.62 AS DOUBLE) - s.longitude * CAST(0.62 AS DOUBLE))
             * (p.longitude * CAST(0.62 AS DOUBLE) - s.longitude * CAST(0.62 AS DOUBLE))
           + (p.latitude - s.latitude) * (p.latitude - s.latitude) AS d2
    FROM points p, sites s WHERE p.latitude IS NOT NULL""",
    "nearest": """
    SELECT prop_id, site_id, postcode, sqrt(d2) AS distance
    FROM (SELECT *, row_number() OVER (PARTITION BY prop_id ORDER BY d2, site_id) AS rn FROM measured)
    WHERE rn = 1""",
    "numbered": """
    SELECT *, event_id * 5 + i AS number,
           event_id % 31 <> 0 AND event_id % 29 <> 0 AND event_id % 23 <> 0 AS readable
    FROM raw, range(0, 5) AS r(i) WHERE event_id % 10 <> 0""",
    "good": f"""
    SELECT number AS prop_id, CAST(number AS VARCHAR) || ' High Street' AS address,
           round({_latitude('number')}, 8) AS latitude, round({_longitude('number')}, 8) AS longitude,
           strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') ||
             CASE WHEN strftime(scraped_at, '%f') = '000000' THEN '' ELSE '.' || strftime(scraped_at, '%f') END
             AS scraped_at,
           CAST(date AS VARCHAR) AS date, price + i AS price
    FROM numbered WHERE readable AND number % 37 <> 0""",
}

_FACT_COLUMNS = "date, area_code, avg_price, median_price, num_properties, month, year"


# Name of the rule, query of its metric, comparison, threshold.
_Rule = tuple[str, str, str, float]


def _rules(table: str, rules: list[_Rule]) -> str:
    def one(name: str, metric: str, op: str, threshold: float) -> str:
        value = f"CAST(({metric}) AS DOUBLE)"
        return (
            f"SELECT '{table}' AS \"table\", '{name}' AS rule, {value} AS metric,"
            f" CAST({threshold} AS DOUBLE) AS threshold, coalesce({value} {op} {threshold}, false) AS passed"
        )

    return "\nUNION ALL\n".join(one(*r) for r in rules)


def _count(source: str, bad: str = "true") -> str:
    return f"SELECT count(*) FROM {source} WHERE {bad}"


def _share(source: str, good: str) -> str:
    return f"SELECT CASE WHEN count(*) = 0 THEN NULL ELSE count(*) FILTER (WHERE {good}) * 1.0 / count(*) END FROM {source}"


def _duplicates(source: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
    )


def _complete(source: str, *columns: str) -> list[tuple[str, str, str, float]]:
    return [(f"IsComplete {c}", _count(source, f"{c} IS NULL"), "<=", 0) for c in columns]


def _outside(source: str, column: str, low: int, high: int) -> tuple[str, str, str, float]:
    bad = f"NOT coalesce({column} > {low} AND {column} < {high}, false)"
    return (f"ColumnValues {column} between {low} and {high}", _count(source, bad), "<=", 0)


def _not_above(source: str, column: str) -> tuple[str, str, str, float]:
    return (f"ColumnValues {column} > 0", _count(source, f"NOT coalesce({column} > 0, false)"), "<=", 0)


def _rulesets(props: str, prices: str, index: str, current: str, fact: str) -> dict[str, list[_Rule]]:
    return {
        "silver_properties": [
            ("RowCount > 500", _count(props), ">", 500),
            *_complete(props, "prop_id", "address", "latitude", "longitude"),
            ("IsUnique prop_id", _duplicates(props, "prop_id"), "<=", 0),
            ("Completeness postcode >= 0.9", _share(props, "postcode IS NOT NULL"), ">=", 0.9),
            ("share outside SW < 0.1", _share(props, "area_code IS NULL OR area_code NOT LIKE 'SW%'"), "<", 0.1),
        ],
        "silver_prices": [
            ("RowCount > 500", _count(prices), ">", 500),
            *_complete(prices, "prop_id", "price", "date"),
            _outside(prices, "price", 100, 50000),
        ],
        "silver_spy_prices": [
            ("RowCount > 0", _count(index), ">", 0),
            *_complete(index, "date", "close"),
            _not_above(index, "close"),
            ("IsUnique date", _duplicates(index, "date"), "<=", 0),
        ],
        "gold_current_properties": [
            ("RowCount > 400", _count(current), ">", 400),
            *_complete(current, "prop_id", "price", "area_code"),
            _outside(current, "price", 100, 50000),
        ],
        "gold_property_fact": [
            ("RowCount > 0", _count(fact), ">", 0),
            *_complete(fact, "area_code", "avg_price"),
            _outside(fact, "avg_price", 500, 20000),
            _not_above(fact, "num_properties"),
        ],
    }


_RULES = _rulesets("props", "prices", "index_rows", "current_rows", "fact")
_MERGED_RULES = _rulesets("merged_props", "merged_prices", "index_rows", "merged_current", "merged_fact")

_RAW_RULES = [
    ("RowCount > 0", _count("raw"), ">", 0),
    ("IsUnique prop_id", _duplicates("raw", "prop_id"), "<=", 0),
    ("IsUnique event_id", _duplicates("raw", "event_id"), "<=", 0),
    ("Completeness postcode >= 0.95", f"SELECT round(({_share('raw', 'postcode IS NOT NULL')}), 9)", ">=", 0.95),
    ("ColumnValues price between 100 and 50000",
     _count("raw", "NOT coalesce(price BETWEEN 100 AND 50000, false)"), "<=", 0),
    ("share over 100 pounds", f"SELECT round(({_share('raw', 'price > 10000')}), 9)", "<", 0.05),
]

_CHOSEN = "'SW2', 'SW7', 'SW11'"
_TREND = (
    "SELECT date, median(median_price) AS median_price, CAST(sum(num_properties) AS BIGINT) AS num_properties"
    " FROM fact WHERE area_code IN ({}) GROUP BY date"
)
_HISTOGRAM = """
SELECT bin, min(lo + bin * (hi - lo) / 40) AS bin_start, count(*) AS num_properties
FROM (SELECT lo, hi, CAST(least(coalesce(floor((price - lo) * 40 / nullif(hi - lo, 0)), 0), 39) AS INTEGER) AS bin
      FROM {0}, (SELECT CAST(min(price) AS DOUBLE) AS lo, CAST(max(price) AS DOUBLE) AS hi FROM {0}))
GROUP BY bin"""

_TEXTS = {
    "silver_properties": "SELECT * FROM props",
    "silver_properties_normalised_area": "SELECT prop_id, postcode, area_code FROM props_norm",
    "silver_prices": "SELECT * FROM prices",
    "silver_spy_prices": "SELECT date, close FROM index_rows",
    "legacy_silver_properties":
        "SELECT prop_id, address, latitude, longitude, last_seen AS scraped_at, postcode,"
        " first_seen AS first_scraped_at, area_code FROM props",
    "legacy_silver_prices": "SELECT * FROM legacy_prices",
    "legacy_silver_spy_prices": "SELECT * FROM index_rows",
    "dedupe_latest_with_ties": """
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day, o_orderkey, o_orderstatus, o_totalprice, first_day
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC,
                       o_orderkey DESC) AS rn,
                     min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS first_day FROM orders)
        WHERE rn = 1""",
    "gold_area_dim": """
        SELECT d.area_code, district, count(p.prop_id) AS num_properties
        FROM dim d LEFT JOIN props p ON d.area_code = p.area_code GROUP BY d.area_code, district""",
    "gold_property_fact": f"SELECT {_FACT_COLUMNS} FROM fact",
    "gold_property_fact_normalised_area": f"SELECT {_FACT_COLUMNS} FROM fact_norm",
    "gold_property_fact_approx_median": f"SELECT {_FACT_COLUMNS} FROM fact",
    "gold_property_fact_large_groups": _fact("large_prices", "large_props"),
    "gold_property_fact_unmatched": _fact("prices", "(SELECT * FROM props WHERE postcode IS NOT NULL)", _FIRST_TEN),
    "legacy_gold_property_fact": _fact("legacy_prices", "props", date="scraped_at"),
    "legacy_gold_current_properties": f"""
        SELECT q.prop_id, address, postcode, latitude, longitude,
               CASE WHEN area_code IN ({_LISTED}) THEN area_code END AS area_code, price, scraped_at
        FROM legacy_prices p JOIN props q ON p.prop_id = q.prop_id
        WHERE scraped_at = (SELECT max(scraped_at) FROM legacy_prices)""",
    "gold_current_properties": "SELECT * FROM current_rows",
    "gold_current_properties_reference_types":
        "SELECT CAST(prop_id AS INTEGER) AS prop_id, address, postcode, area_code, price, date,"
        " CAST(round(CAST(latitude AS FLOAT) * 10000) AS BIGINT) AS latitude,"
        " CAST(round(CAST(longitude AS FLOAT) * 10000) AS BIGINT) AS longitude FROM current_rows",
    "serve_area_summary": "SELECT * FROM summary",
    "serve_area_options": "SELECT DISTINCT area_code FROM fact WHERE area_code <> 'all'",
    "serve_default_areas":
        "SELECT DISTINCT area_code FROM fact WHERE area_code <> 'all' ORDER BY area_code LIMIT 5",
    "serve_trend": _TREND.format(_CHOSEN),
    "serve_trend_default_areas": _TREND.format(
        "SELECT DISTINCT area_code FROM fact WHERE area_code <> 'all' ORDER BY area_code LIMIT 5"
    ),
    "serve_price_lines": f"SELECT date, area_code, avg_price FROM fact WHERE area_code IN ({_CHOSEN})",
    "serve_headline_all":
        "SELECT count(*) AS properties, CAST(median(price) AS DOUBLE) AS median_price FROM current_rows",
    "serve_headline_chosen":
        "SELECT count(*) AS properties, CAST(median(price) AS DOUBLE) AS median_price"
        f" FROM current_rows WHERE area_code IN ({_CHOSEN})",
    "serve_headline_text":
        "SELECT format('{:,}', count(*)) AS properties, '£' || format('{:,.0f}', median(price)) || ' pcm'"
        " AS median_price FROM current_rows",
    "serve_headline_large":
        "SELECT count(*) AS properties, CAST(median(price) AS DOUBLE) AS median_price FROM large_prices",
    "serve_histogram": _HISTOGRAM.format("current_rows"),
    "serve_histogram_large": _HISTOGRAM.format("large_prices"),
    "serve_map_points":
        f"SELECT latitude, longitude, price, address, area_code FROM current_rows WHERE area_code IN ({_CHOSEN})",
    "serve_last_updated": "SELECT max(date) AS last_updated FROM current_rows",
    "serve_views":
        "SELECT date, close, (SELECT count(*) FROM dim WHERE area_code <> 'all') AS listed_areas FROM index_rows",
    "filter_nothing_chosen":
        "SELECT count(*) AS num_rows, 'all' AS reading FROM props UNION ALL SELECT 0 AS num_rows, 'none' AS reading",
    "filter_by_summary_rows":
        "SELECT prop_id, area_code, price FROM current_rows"
        " WHERE area_code IN (SELECT area_code FROM summary WHERE median_price >= 3000)",
    "filter_date_range":
        "SELECT date, close FROM index_rows WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'",
    "close_series_last_days": """
        SELECT CAST(date AS VARCHAR) AS date, close, '1998-06-30' AS loaded_at
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, round(arg_max(o_totalprice, o_orderkey), 2) AS close
              FROM orders GROUP BY CAST(o_orderdate AS DATE))
        WHERE date > DATE '1998-06-30' - 90 AND date <= DATE '1998-06-30'""",
    "merge_upsert_properties": "SELECT * FROM merged_props",
    "merge_upsert_late_first_seen": f"SELECT prop_id, first_seen, last_seen FROM ({_merge(late=True)})",
    "merge_insert_only_prices": "SELECT * FROM merged_prices",
    "merge_insert_only_index": """
        SELECT date, CASE WHEN month(date) <= 6 THEN close ELSE close + 1 END AS close FROM index_rows""",
    "needs_postcode": """
        SELECT prop_id, postcode, last_seen FROM props_2
        WHERE NOT EXISTS (SELECT 1 FROM props_1 t WHERE t.prop_id = props_2.prop_id AND t.postcode IS NOT NULL)""",
    "request_batches": """
        SELECT c_custkey AS prop_id, CAST(c_nationkey % 4 AS INTEGER) AS bucket,
               CAST((row_number() OVER (PARTITION BY c_nationkey % 4 ORDER BY c_custkey) - 1) // 100 AS INTEGER) AS batch_no
        FROM customer""",
    "nearest_site_great_circle": """
        SELECT prop_id, site_id, round(distance, 3) AS distance FROM (
          SELECT p.prop_id, site_id, distance,
                 row_number() OVER (PARTITION BY p.prop_id ORDER BY distance, site_id) AS turn
          FROM globe_points p LEFT JOIN (
            SELECT p.prop_id, s.site_id, 2 * 6371.0088::DOUBLE * asin(least(1, sqrt(
                     pow(sin(radians(s.latitude - p.latitude) / 2), 2)
                     + cos(radians(p.latitude)) * cos(radians(s.latitude)) * pow(sin(radians(s.longitude - p.longitude) / 2), 2)
                   ))) AS distance
            FROM globe_points p, globe_sites s WHERE p.latitude IS NOT NULL) d ON p.prop_id = d.prop_id)
        WHERE turn = 1""",
    "ingest_postcode_gate": """
        SELECT 'named' AS "case", 'passed' AS verdict, 'SW1 1AA' AS postcode, count(*) AS num_rows
        FROM customer, range(0, 10) AS r(i)
        WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND (c_custkey % 2 = 0 OR (i < 9 AND c_custkey % 3 = 0))
          AND (i <> 4 OR c_custkey % 3 = 0)
        UNION ALL SELECT 'blank', 'refused', '', 0""",
    "postcode_for_new_properties": """
        SELECT p.prop_id, coalesce(p.postcode, b.postcode) AS postcode,
               split_part(coalesce(p.postcode, b.postcode), ' ', 1) AS area_code
        FROM props_2 p LEFT JOIN (
          SELECT prop_id, postcode FROM (
            SELECT q.prop_id, n.postcode, row_number() OVER (PARTITION BY q.prop_id ORDER BY
                     (q.longitude - n.longitude) * (q.longitude - n.longitude)
                     + (q.latitude - n.latitude) * (q.latitude - n.latitude), n.postcode) AS rn
            FROM props_2 q, (SELECT postcode, min(latitude) AS latitude, min(longitude) AS longitude
                             FROM sites GROUP BY postcode) n
            WHERE q.postcode IS NULL
              AND NOT EXISTS (SELECT 1 FROM props_1 t WHERE t.prop_id = q.prop_id AND t.postcode IS NOT NULL))
          WHERE rn = 1) b ON p.prop_id = b.prop_id""",
    "nearest_site": """
        SELECT p.prop_id, n.site_id, round(n.distance, 9) AS distance
        FROM points p LEFT JOIN nearest n ON p.prop_id = n.prop_id""",
    "postcode_by_nearest_site": f"""
        SELECT p.prop_id, coalesce(CASE WHEN p.prop_id % 3 = 0 THEN {_postcode('p.prop_id')} END, n.postcode) AS postcode
        FROM points p LEFT JOIN nearest n ON p.prop_id = n.prop_id""",
    "postcode_from_geocode_answer": """
        SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN 'N' || CAST(c_custkey % 20 + 1 AS VARCHAR) || ' 1AA' END
               AS postcode FROM customer""",
    "area_code_forms": f"""
        SELECT c_custkey, split_part(postcode, ' ', 1) AS area, {_NORMAL} AS normalised
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'EC1A ' || code
                                     WHEN c_custkey % 4 = 1 THEN ' ' || code ELSE code END AS postcode
              FROM (SELECT c_custkey, {_postcode('c_custkey')} AS code FROM customer))""",
    "page_properties": "SELECT prop_id, address, latitude, longitude, scraped_at FROM good",
    "page_prices": "SELECT prop_id, date, CAST(price AS BIGINT) AS price, scraped_at FROM good",
    "page_status": """
        SELECT event_id AS page_id, CASE WHEN event_id % 23 = 0 THEN 'no_script' WHEN event_id % 31 = 0 THEN 'no_path'
               WHEN event_id % 29 = 0 THEN 'bad_json' ELSE 'ok' END AS status FROM events""",
    "page_failure_rate": """
        SELECT e.event_id AS page_id, count(number) AS total, count(number) FILTER (WHERE number % 37 = 0) AS failures,
               CASE WHEN count(number) > 0 THEN count(number) FILTER (WHERE number % 37 = 0)
                    / CAST(count(number) AS DOUBLE) END AS rate
        FROM events e LEFT JOIN (SELECT * FROM numbered WHERE readable) n ON e.event_id = n.event_id
        GROUP BY e.event_id""",
    "page_index_list": """
        SELECT event_id AS page_id, CAST(CASE WHEN found THEN event_id % 4 + 1 ELSE 1 END AS INTEGER) AS total,
               CASE WHEN found THEN array_to_string([i * 24 FOR i IN range(1, event_id % 4 + 1)], ',') ELSE '' END AS indices,
               CASE WHEN found THEN 'ok' ELSE 'no_results' END AS status
        FROM (SELECT event_id, event_id % 31 <> 0 AND event_id % 29 <> 0 AND event_id % 23 <> 0 AS found FROM events)""",
    "web_page_listings": """
        SELECT page_id, page_id % 3 <> 0 AS is_listing, CASE WHEN page_id % 3 <> 0 THEN page_id END AS prop_id,
               CASE WHEN page_id % 3 <> 0 THEN page_id % 3000 + 500 END AS price, CAST(NULL AS VARCHAR) AS address,
               CASE WHEN page_id % 3 <> 0 THEN CAST(51.5 AS DOUBLE) END AS latitude,
               CASE WHEN page_id % 3 <> 0 THEN CAST(-0.1 AS DOUBLE) END AS longitude, false AS is_bad
        FROM pages""",
    "rates_in_range": """
        SELECT CAST(day AS VARCHAR) AS date, count(*) AS num_rates,
               CAST(sum(CAST(rate AS DECIMAL(12, 2))) AS DOUBLE) AS sum_rate
        FROM (SELECT CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS day,
                     (o_orderkey + i) % 1000 / CAST(100 AS DOUBLE) AS rate
              FROM orders, range(0, 3) AS r(i) WHERE (o_orderkey + i) % 4 <> 0 AND o_orderkey % 50 <> 0)
        WHERE day BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY day""",
    "html_table_rates": """
        SELECT o_orderkey, CAST(i + 1 AS INTEGER) AS position,
               CAST(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS VARCHAR) AS date,
               (o_orderkey + i) % 1000 / CAST(100 AS DOUBLE) AS rate, '2024-01-01' AS loaded_at
        FROM orders, range(0, 3) AS r(i) WHERE (o_orderkey + i) % 4 <> 0 AND o_orderkey % 50 <> 0""",
    **{f"quality_{table}": _rules(table, rules) for table, rules in _RULES.items()},
    "quality_from_batches": _rules(
        "raw_listings", [*_RAW_RULES[:-1], ("share over 100 pounds < 0.05", *_RAW_RULES[-1][1:])]),
    "quality_raw_listings": _rules("raw_listings", _RAW_RULES),
    "end_to_end_quality":
        'SELECT "table", rule, round(metric, 9) AS metric, threshold, passed FROM ('
        + " UNION ALL ".join(_rules(table, rules) for table, rules in _MERGED_RULES.items()) + ")",
    "expectations_on_properties": """
        SELECT 'postcode_present' AS "check", count(*) FILTER (WHERE postcode IS NULL) AS violations,
               count(*) AS num_rows FROM props
        UNION ALL SELECT 'valid_prop_id', count(*) FILTER (WHERE prop_id IS NULL), count(*) FROM props
        UNION ALL SELECT 'valid_coordinates', count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL), count(*)
        FROM props""",
    "expect_or_drop_prices": """
        SELECT date, count(*) AS kept, CAST(sum(price - 500) AS BIGINT) AS sum_price
        FROM raw WHERE prop_id % 13 <> 0 AND price - 500 > 0 GROUP BY date""",
    "missing_postcode_rate": """
        SELECT count(*) AS total, count(*) FILTER (WHERE postcode IS NULL OR prop_id % 17 = 0) AS failures,
               round(count(*) FILTER (WHERE postcode IS NULL OR prop_id % 17 = 0) / CAST(count(*) AS DOUBLE), 9) AS rate
        FROM raw""",
    "failure_rate_by_day": """
        SELECT date, count(*) AS total, count(*) FILTER (WHERE postcode IS NULL) AS failures,
               round(count(*) FILTER (WHERE postcode IS NULL) / CAST(count(*) AS DOUBLE), 9) AS rate
        FROM raw GROUP BY date""",
    "landing_written_by_day": """
        SELECT CAST(date AS VARCHAR) AS date, strftime(date, 'year=%Y/month=%m/day=%d') AS folder,
               count(*) AS num_rows,
               CAST(sum(CASE WHEN date = DATE '2024-01-05' THEN 1 ELSE price END) AS BIGINT) AS sum_price
        FROM raw GROUP BY date""",
    "incremental_silver_properties": "SELECT * FROM merged_props",
    "incremental_silver_prices": "SELECT * FROM merged_prices",
    "incremental_late_file": "SELECT * FROM merged_prices",
    "incremental_untrusted_prices": _dedupe_prices("trusted"),
    "incremental_replayed_batch": _dedupe_prices("trusted"),
    "incremental_rejects": """
        SELECT CASE WHEN event_id % 19 = 0 THEN 'bad date' WHEN event_id % 17 = 0 THEN 'no prop_id'
               ELSE 'bad price' END AS reason, count(*) AS num_rows
        FROM raw WHERE event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 GROUP BY 1""",
    "ingest_pages": """
        SELECT c_custkey * 10 + i AS prop_id, '2024-02-01' AS date, (c_custkey * 10 + i) % 5000 + 300 AS price,
               '2024-02-01T12:00:00' AS scraped_at
        FROM customer, range(0, 10) AS r(i)
        WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND (c_custkey % 2 = 0 OR (i < 9 AND c_custkey % 3 = 0))
          AND (i <> 4 OR c_custkey % 3 = 0)""",
    "ingest_gate_verdicts": """
        SELECT page_id, total, failures, round(failures / nullif(CAST(total AS DOUBLE), 0), 9) AS rate,
               CASE WHEN page_id % 13 = 0 THEN 'no_script' WHEN total = 0 THEN 'no listings'
                    WHEN failures * 10 > total THEN 'too many failures' ELSE 'ok' END AS verdict
        FROM (SELECT c_custkey AS page_id,
                     CAST(CASE WHEN c_custkey % 13 = 0 OR c_custkey % 11 = 0 THEN 0
                               ELSE 10 - c_custkey % 2 END AS BIGINT) AS total,
                     CAST(CASE WHEN c_custkey % 13 = 0 OR c_custkey % 11 = 0 OR c_custkey % 3 = 0 THEN 0
                               ELSE 1 END AS BIGINT) AS failures FROM customer)""",
    "landing_preview": """
        SELECT count(*) AS num_rows, count(*) AS previewed, min({'a': prop_id, 'b': date, 'c': price}).a AS prop_id,
               min({'a': prop_id, 'b': date, 'c': price}).b AS date FROM raw""",
    "catalog_table_of_prices": "SELECT * FROM prices",
    "end_to_end_large_ids": "SELECT prop_id + 3000000000 AS prop_id, area_code, price FROM merged_current",
    "legacy_expectation_counts": """
        SELECT 'silver_properties' AS "table", 'postcode_present' AS "check",
               count(*) FILTER (WHERE postcode IS NULL) AS violations, count(*) AS num_rows FROM props
        UNION ALL SELECT 'silver_properties', 'valid_prop_id', count(*) FILTER (WHERE prop_id IS NULL), count(*) FROM props
        UNION ALL SELECT 'silver_properties', 'valid_coordinates',
                         count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL), count(*) FROM props
        UNION ALL SELECT 'silver_prices', 'valid_price', count(*) FILTER (WHERE price - 500 <= 0), count(*) FROM raw""",
    "gold_property_fact_wide_values": """
        SELECT date, area_code, CAST(trunc(avg(price)) AS BIGINT) AS avg_price,
               CAST(quantile_disc(price, 0.5) AS BIGINT) AS median_price, count(*) AS num_properties,
               strftime(date, '%B') AS month, strftime(date, '%Y') AS year
        FROM (SELECT p.date, p.price * CAST(100000 AS BIGINT) AS price, unnest(CASE WHEN area_code IN (LISTED)
                       THEN [area_code, 'all'] ELSE ['all'] END) AS area_code
              FROM prices p LEFT JOIN props q ON p.prop_id = q.prop_id) GROUP BY date, area_code""".replace("LISTED", _LISTED),
    "html_table_skipped_rows": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE 4 END AS num_rows,
               CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE 1 END AS no_date,
               CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE CAST((o_orderkey % 4 = 0)::INT + ((o_orderkey + 1) % 4 = 0)::INT
                 + ((o_orderkey + 2) % 4 = 0)::INT AS INTEGER) END AS no_number FROM orders""",
    "incremental_gold_property_fact": _fact("merged_prices", "merged_props"),
    "change_feed_in_batches": """
        SELECT prop_id, address, price, date FROM (
          SELECT *, row_number() OVER (PARTITION BY prop_id ORDER BY event_id DESC) AS turn FROM raw)
        WHERE turn = 1 AND event_id % 11 <> 0""",
    "stream_latest_per_key": """
        SELECT user_id AS prop_id, CAST(ts AS DATE) AS date, event_id, event_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS turn
          FROM events) WHERE turn = 1""",
    "end_to_end_gold_property_fact": _fact("merged_prices", "merged_props"),
    "end_to_end_metrics": f"""
        SELECT 'properties' AS dataset, 'silver' AS stage,
               (SELECT count(*) FROM props_1) + (SELECT count(*) FROM merged_props) AS rows
        UNION ALL SELECT 'prices', 'silver', count(*) FROM merged_prices
        UNION ALL SELECT 'properties', 'rejected', 0
        UNION ALL SELECT 'prices', 'rejected', 0
        UNION ALL SELECT 'gold_area_dim', 'gold', count(*) FROM dim
        UNION ALL SELECT 'gold_property_fact', 'gold', count(*) FROM ({_fact('merged_prices', 'merged_props')})
        UNION ALL SELECT 'gold_current_properties', 'gold', count(*)
        FROM merged_prices p JOIN merged_props q ON p.prop_id = q.prop_id
        WHERE date = (SELECT max(date) FROM merged_prices) AND area_code IN ({_LISTED})""",
    "median_of_wide_values": """
        SELECT l_returnflag, count(*) AS num_rows, max(value) FILTER (WHERE r = (n + 1) // 2) AS median_low,
               (max(value) FILTER (WHERE r = (n + 1) // 2)::DOUBLE + max(value) FILTER (WHERE r = n // 2 + 1)) / 2 AS median
        FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY value) AS r,
                     count(*) OVER (PARTITION BY l_returnflag) AS n
              FROM (SELECT unnest([l_returnflag, 'all']) AS l_returnflag,
                           (((l_orderkey * 8 + l_linenumber)::HUGEINT * 1234567890123457) % 9223372036854775807)::BIGINT
                           * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS value FROM lineitem))
        GROUP BY l_returnflag""",
    "median_by_month_from_sketches": """
        SELECT year(l_shipdate)::INTEGER AS year, area_code, count(*) AS num_rows, true AS close
        FROM lineitem JOIN (SELECT p_partkey, AREA AS area_code FROM part) ON l_partkey = p_partkey
        WHERE area_code IS NOT NULL GROUP BY ALL""".replace("AREA", f"split_part({_postcode('p_partkey')}, ' ', 1)"),
    "serve_round_histogram": """
        SELECT * FROM (WITH cases AS (
          SELECT unnest(['prices', 'around zero', 'tiny', 'equal']) AS "case",
                 unnest([price::HUGEINT * 10000000000, (price - 25000)::HUGEINT * 10000000000, price::HUGEINT * 1000,
                         70000000000::HUGEINT]) AS v FROM raw
        ), steps AS (SELECT m * (10::HUGEINT ** e)::HUGEINT AS s FROM (VALUES (1), (2), (5)) t(m), range(28) u(e)),
        chosen AS (
          SELECT "case", CASE WHEN min(low) = min(high) THEN 10000000000 ELSE min(s) FILTER (
                 (high - ((high % s) + s) % s) - (low - ((low % s) + s) % s) <= s * 39) END AS s
          FROM (SELECT "case", min(v) AS low, max(v) AS high FROM cases GROUP BY "case"), steps GROUP BY "case"
        )
        SELECT "case", (v - ((v % s) + s) % s)::DOUBLE / 1e10 AS bin_start, (v - ((v % s) + s) % s + s)::DOUBLE / 1e10 AS bin_end,
               count(*) AS num_rows FROM cases JOIN chosen USING ("case") GROUP BY ALL)""",
    "broken_table_share": """
        SELECT count(*) AS num_pages, count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderkey % 50 <> 0) AS num_irregular,
               round(count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderkey % 50 <> 0) / count(*)::DOUBLE, 9) AS share FROM orders""",
    "date_layouts_of_sources": """
        SELECT source, CASE WHEN source < 4 THEN 'd/M/yyyy' WHEN source < 7 THEN 'M/d/yyyy' WHEN source = 7 THEN 'yyyyMMdd'
                 WHEN source = 8 THEN 'd/M/yyyy' WHEN source = 9 THEN 'd-M-yyyy' END AS layout,
               CASE WHEN source < 8 THEN 'one' WHEN source = 8 THEN 'ambiguous' WHEN source = 9 THEN 'same'
                 WHEN source = 10 THEN 'mixed' ELSE 'none' END AS status,
               count(*) AS num_cells, count(*) FILTER (o_orderkey % 40 <> 0 AND source < 11) AS num_read
        FROM (SELECT o_orderkey, CAST(o_custkey % 12 AS INTEGER) AS source FROM orders) GROUP BY source""",
    "dates_by_source_layout": """
        SELECT o_orderkey, CAST(o_custkey % 12 AS INTEGER) AS source,
               CASE WHEN o_orderkey % 40 = 0 OR o_custkey % 12 IN (8, 10, 11) THEN NULL
                    WHEN o_custkey % 12 = 9 THEN make_date(year(o_orderdate), month(o_orderdate), month(o_orderdate))
                    ELSE CAST(o_orderdate AS DATE) END AS date FROM orders""",
    "stream_first_per_day": "SELECT DISTINCT user_id AS prop_id, CAST(ts AS DATE) AS date FROM events",
    "replace_current_table": f"SELECT prop_id, area_code, last_seen FROM props WHERE area_code IN ({_CHOSEN})",
}


def _needed(text: str) -> list[str]:
    """Named subqueries the text uses, each after those it uses itself."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in _CTES:
            if name not in ordered and re.search(rf"(?:\bFROM|\bJOIN|,)\s+{name}\b", sql):
                visit(_CTES[name])
                ordered.append(name)

    visit(text)
    return ordered


def _complete_text(text: str) -> str:
    needed = _needed(text)
    if not needed:
        return text
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in needed) + "\n" + text


_TEXTS["broken_table_rates"] = _TEXTS["html_table_rates"]

ORACLE = {name: _complete_text(text) for name, text in _TEXTS.items()}
