"""SQL over the given tables that each query must agree with."""

from __future__ import annotations

TEXT = "'%Y-%m-%d %H:%M:%S'"
LATE_MS, PARTS, SOURCES = 216_000_000, 4, 3

AREA = "'AREA_' || (user_id % 5)"


def _report(unit: str, time: str = "") -> str:
    """Counts per window of one ``unit`` (minute or day)."""
    end = f"strftime(date_trunc('{unit}', ts) + INTERVAL 1 {unit}, {TEXT})"
    return f"""
        SELECT {time or end} AS time, event_type AS type, {AREA} AS area, count(*) AS "count"
        FROM events GROUP BY date_trunc('{unit}', ts), event_type, {AREA}"""


def _last_event(unit: str, delay_ms: int) -> str:
    arrival = f"epoch_us(ts) + CASE WHEN event_id % 7 = 0 THEN {delay_ms * 1000} ELSE 0 END"
    second = "date_trunc('second', ts)"
    return _report(unit, f"strftime(arg_max({second}, ({arrival}, {second})), {TEXT})")


def _doc_columns(source: str, extra: str = "") -> str:
    return f"""
        SELECT replace(time, ' ', '_') || '-' || type || '-' || area AS doc_id, time, type, area, "count"{extra}
        FROM ({source})"""


def _docs(unit: str) -> str:
    document = """, '{"time":"' || time || '","type":"' || type || '","area":"' || area || '","count":' || "count" || '}' AS document"""
    return _doc_columns(_report(unit), document)


def _sorted_times(unit: str) -> str:
    return f"""
        WITH numbered AS (
            SELECT date_trunc('{unit}', ts) AS start, event_type AS type, {AREA} AS area, date_trunc('second', ts) AS moment,
                   row_number() OVER (PARTITION BY date_trunc('{unit}', ts), event_type, {AREA} ORDER BY ts) AS position
            FROM events)
        SELECT strftime(start + INTERVAL 1 {unit}, {TEXT}) AS time, type, area, strftime(moment, {TEXT}) AS event_time,
               count(*) AS copies, min(position) AS position
        FROM numbered GROUP BY start, type, area, moment"""


def _lateness(width_ms: int, delay_ms: int, lateness_ms: int, held_ms: int, sources: int = 1) -> str:
    """``classes``: each event with its window end, the running maximum it met (of ``sources`` by user, the least), and its class."""

    def newest(frame: str) -> str:
        each = [f"coalesce(max(ms) FILTER (WHERE source = {n}) OVER ({frame}), 0)" for n in range(sources)]
        return f"least({', '.join(each)})"

    return f"""
        WITH arrived AS (
            SELECT event_id, user_id % {sources} AS source, event_type AS type, {AREA} AS area, epoch_ms(date_trunc('second', ts)) AS ms,
                   epoch_us(ts) + CASE WHEN event_id % 7 = 0 THEN {held_ms * 1000} ELSE 0 END AS arrival
            FROM events),
        met AS (
            SELECT *, (ms // {width_ms} + 1) * {width_ms} AS we,
                   {newest("ORDER BY arrival RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")} - {delay_ms} AS wm,
                   {newest("")} - {delay_ms} AS last_wm
            FROM arrived),
        classes AS (
            SELECT *, strftime(epoch_ms(we), {TEXT}) AS time, we - 1 <= last_wm AS fired,
                   CASE WHEN we - 1 + {lateness_ms} <= wm THEN 'late' WHEN we - 1 <= wm THEN 'refire' ELSE 'ontime' END AS lateness
            FROM met)"""


def _classes(rules: str) -> str:
    return f"{rules} SELECT event_id, time, lateness FROM classes"


def _final_counts(rules: str) -> str:
    return f"""{rules}
        SELECT time, type, area, count(*) AS "count", fired FROM classes WHERE lateness <> 'late' GROUP BY time, type, area, fired"""


def _final_last_event(rules: str) -> str:
    return f"""{rules}
        SELECT strftime(epoch_ms(arg_max(ms, (arrival, ms))), {TEXT}) AS time, type, area, count(*) AS "count", fired
        FROM classes WHERE lateness <> 'late' GROUP BY we, type, area, fired"""


def _late(rules: str) -> str:
    return f"""{rules} SELECT ms || chr(9) || type || chr(9) || area AS value FROM classes WHERE lateness = 'late'"""


def _upsert(rules: str) -> str:
    counted = f"""
        SELECT time, type, area, count(*) AS "count" FROM classes WHERE lateness <> 'late' AND fired GROUP BY time, type, area"""
    return rules + _doc_columns(counted)


def _changelog(rules: str, width_ms: int, delay_ms: int) -> str:
    """First firing per window when its end passes the watermark, then one row per refire."""
    counted = f"""
        SELECT time, type, area, "count", emitted_at FROM (
            SELECT time, type, area, count(*) AS "count",
                   (SELECT min(arrival) FROM classes later WHERE later.ms - {delay_ms} >= ontime.we - 1) AS emitted_at
            FROM classes ontime WHERE lateness = 'ontime' AND fired GROUP BY time, we, type, area
            UNION ALL
            SELECT time, type, area, running AS "count", arrival AS emitted_at FROM (
                SELECT *, count(*) OVER (PARTITION BY we, type, area ORDER BY arrival) AS running
                FROM (SELECT * FROM classes WHERE lateness <> 'late' AND fired))
            WHERE lateness = 'refire')"""
    return rules + _doc_columns(counted, ", emitted_at")


def _stream_emissions(rules: str, delay_ms: int) -> str:
    """Per part of the arrivals: windows that fired in it, or had fired and took more rows in it."""
    parts = f"""{rules},
        spans AS (SELECT min(arrival) AS low, max(arrival) - min(arrival) + 1 AS span FROM classes),
        parted AS (SELECT classes.*, ((arrival - low) * {PARTS}) // span AS part FROM classes, spans),
        ends AS (
            SELECT part, max(newest) OVER (ORDER BY part) - {delay_ms} AS wm
            FROM (SELECT part, max(ms) AS newest FROM parted GROUP BY part)),
        kept AS (
            SELECT time, we, type, area, part, count(*) AS added FROM parted WHERE lateness <> 'late' GROUP BY time, we, type, area, part),
        steps AS (
            SELECT time, we, type, area, ends.part, wm,
                   coalesce(lag(wm) OVER (PARTITION BY we, type, area ORDER BY ends.part), -{delay_ms}) AS wm_before,
                   coalesce(added, 0) AS added,
                   sum(coalesce(added, 0)) OVER (PARTITION BY we, type, area ORDER BY ends.part) AS so_far
            FROM (SELECT DISTINCT time, we, type, area FROM kept) windows CROSS JOIN ends
            LEFT JOIN kept USING (time, we, type, area, part))"""
    emitted = """
        SELECT time, type, area, so_far::BIGINT AS "count", part AS batch_id
        FROM steps WHERE so_far > 0 AND we - 1 <= wm AND (added > 0 OR we - 1 > wm_before)"""
    return parts + _doc_columns(emitted, ", batch_id")


def _stream_builtin_late(rules: str, kept_ms: int) -> str:
    """Spark's rule: a row is late if its window had ended by the newest event time of the parts before, less the allowance."""
    return f"""{rules},
        spans AS (SELECT min(arrival) AS low, max(arrival) - min(arrival) + 1 AS span FROM classes),
        parted AS (SELECT classes.*, ((arrival - low) * {PARTS}) // span AS part FROM classes, spans),
        before AS (
            SELECT part, max(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
            FROM (SELECT part, max(ms) AS newest FROM parted GROUP BY part))
        SELECT time, type, area, count(*) AS "count" FROM parted JOIN before USING (part)
        WHERE newest IS NULL OR we > newest - {kept_ms} GROUP BY time, type, area"""


# Audit texts with the ten defects put in.
DAMAGED = f"""
    WITH fields AS (
        SELECT event_id, user_id::VARCHAR AS username, event_id % 13 AS kind, date_trunc('second', ts) AS moment,
               CASE event_id % 13 WHEN 0 THEN 'bad' WHEN 3 THEN '1970-01-01 00:00:00' WHEN 4 THEN '1969-12-31 23:59:59'
                    WHEN 5 THEN '2024-13-01 00:00:00' ELSE strftime(ts, {TEXT}) END AS dt,
               CASE WHEN event_id % 13 <> 6 THEN event_type END AS type,
               CASE WHEN event_id % 13 <> 2 THEN {AREA} END AS area
        FROM events),
    texts AS (
        SELECT *, '{{"dt":"' || dt || '"' || coalesce(',"type":"' || type || '"', '') || ',"username":"' || username || '"'
               || coalesce(',"area":"' || area || '"', '') || '}}' AS whole
        FROM fields)"""

AUDIT_BAD = f"""{DAMAGED}
    SELECT CASE kind WHEN 1 THEN left(whole, 30) WHEN 7 THEN whole || whole WHEN 8 THEN whole || ' zzz' WHEN 9 THEN whole || ']'
                ELSE whole END AS value,
           CASE kind WHEN 0 THEN 'bad_time' WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'no_area' WHEN 3 THEN 'excluded_time'
                WHEN 4 THEN 'excluded_time' WHEN 5 THEN 'bad_time' WHEN 6 THEN 'no_type' ELSE 'malformed_json' END AS reason
    FROM texts WHERE kind <= 9"""

AUDIT_LENIENT = f"""
    SELECT event_id, CASE WHEN event_id % 8 <> 7 THEN epoch_ms(date_trunc('second', ts)) END AS event_ms, event_type AS type, {AREA} AS area,
           CASE WHEN event_id % 8 = 7 THEN 'bad_time' END AS reason
    FROM events"""

AUDIT_POSITIVE = f"{DAMAGED} SELECT event_id, epoch_ms(moment) AS event_ms, type, area FROM texts WHERE kind > 9"

AUDIT_NONZERO = f"""{DAMAGED}
    SELECT event_id, CASE WHEN kind = 4 THEN -1000 ELSE epoch_ms(moment) END AS event_ms, type, area
    FROM texts WHERE kind > 9 OR kind = 4"""

AREAS = "SELECT n_name AS country_code, r_name AS area FROM nation JOIN region ON n_regionkey = r_regionkey"

AREAS_MOVED = """
    WITH placed AS (
        SELECT r_regionkey, r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS place, count(*) OVER () AS n FROM region)
    SELECT n_name AS country_code, next.r_name AS area
    FROM nation JOIN placed ON n_regionkey = placed.r_regionkey JOIN placed next ON next.place = (placed.place + 1) % placed.n"""

ITEM = "l_returnflag AS type, l_discount AS score, l_linestatus AS level"
ITEMS = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
ORDERED = f"strftime(o_orderdate, {TEXT})"
CODE = "CASE WHEN o_orderkey % 10 = 0 THEN 'NOWHERE' ELSE n_name END"


def _clean(area: str, extra: str = "", areas: str = AREAS) -> str:
    return f"""
        SELECT {ITEM}, {area} AS area, {ORDERED} AS dt{extra}
        FROM {ITEMS} LEFT JOIN ({areas}) areas ON country_code = {CODE}"""


CLEAN_OPEN = _clean(
    "areas.area",
    """, l_linenumber AS line, CASE WHEN l_linenumber > 3 THEN l_suppkey END AS supplier, l_quantity > 25 AS bulk,
       l_partkey AS part, l_linestatus || l_returnflag AS flags,
       '[123456789012345678901234567890123456789012345,0.30,1.5e400,{"x":null}]' AS raw""",
)

ENVELOPE_SIZES = f"""
    SELECT {ORDERED} AS dt, {CODE} AS countryCode, count(l_orderkey) AS items
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, 1, 2"""


def _clean_bad(wrong_type: str) -> str:
    """Outcomes of the damaged envelopes: three kinds are malformed, three have one item more."""
    return f"""
        WITH sized AS (
            SELECT o_orderkey % 11 AS kind, count(l_orderkey) AS items
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
        outcomes AS (
            SELECT 'malformed_json' AS outcome, count(*) AS n FROM sized WHERE kind < 3
            UNION ALL SELECT 'record', sum(items) FROM sized WHERE kind >= 3
            UNION ALL SELECT 'record', count(*) FROM sized WHERE kind = 3
            UNION ALL SELECT '{wrong_type}', count(*) FROM sized WHERE kind = 4
            UNION ALL SELECT 'bad_item', count(*) FROM sized WHERE kind = 5)
        SELECT outcome, sum(n)::BIGINT AS n FROM outcomes GROUP BY outcome"""


DIM_REPLACEMENT = f"""
    {_clean("areas.area")} WHERE o_orderdate < DATE '1999-01-01'
    UNION ALL
    {_clean("areas.area", areas=AREAS_MOVED)} WHERE o_orderdate >= DATE '1999-01-01'"""

# Refresh n of ten, a year after the one before, moves the nations n regions on; refreshes 4 and 9 find nothing.
DIM_AS_OF = f"""
    WITH placed AS (
        SELECT r_regionkey, r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS place, count(*) OVER () AS n FROM region),
    refreshes AS (
        SELECT i, make_timestamp(1993 + i, 7, 1, 0, 0, 0.0) AS since FROM (SELECT unnest(range(0, 10)) AS i) WHERE i % 5 <> 4),
    spans AS (SELECT i, since, lead(since) OVER (ORDER BY since) AS until FROM refreshes),
    versions AS (
        SELECT since, until, n_name AS country_code, moved.r_name AS area
        FROM spans, nation JOIN placed ON n_regionkey = placed.r_regionkey
        JOIN placed moved ON moved.place = (placed.place + spans.i) % placed.n)
    SELECT {ITEM}, versions.area AS area, {ORDERED} AS dt
    FROM {ITEMS} LEFT JOIN versions ON country_code = {CODE} AND o_orderdate >= since AND (until IS NULL OR o_orderdate < until)"""

JSON_GET = "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"
# All that the text holds stays as it is written.
JSON_PUT = """
    SELECT event_id, left(props, length(props) - 1) || ',"area":"' || event_type || '"}' AS props FROM events"""

TIMES = f"""
    SELECT event_id, strftime(ts, {TEXT}) AS dt, epoch_ms(date_trunc('second', ts)) AS event_ms, strftime(ts, {TEXT}) AS printed FROM events"""

DAY = (86_400_000, 7_200_000, 86_400_000, LATE_MS)
MINUTE = (60_000, 10_000, 30_000, 300_000)

ORACLES: dict[str, str] = {
    "area_dim_inverted": AREAS,
    "audit_bad_rows": AUDIT_BAD,
    "audit_rows_lenient": AUDIT_LENIENT,
    "audit_rows_nonzero": AUDIT_NONZERO,
    "audit_rows_positive": AUDIT_POSITIVE,
    "clean_bad_rows": _clean_bad("bad_item"),
    "clean_bad_rows_open": _clean_bad("record"),
    "clean_envelope_sizes": ENVELOPE_SIZES,
    "clean_items_null": _clean("areas.area"),
    "clean_items_other": _clean("coalesce(areas.area, 'other')"),
    "clean_items_other_shuffled": _clean("coalesce(areas.area, 'other')"),
    "clean_json_roundtrip": _clean("areas.area"),
    "clean_open_schema": CLEAN_OPEN,
    "dim_as_of": DIM_AS_OF,
    "dim_as_of_shuffled": DIM_AS_OF,
    "dim_replacement": DIM_REPLACEMENT,
    "json_get": JSON_GET,
    "json_put": JSON_PUT,
    "stream_clean": _clean("areas.area"),
    "stream_delivered_once": _clean("areas.area"),
    "stream_report_builtin": _report("minute"),
    "stream_report_builtin_1d": _report("day"),
    "lateness_classes_shuffled_1d": _classes(_lateness(*DAY)),
    "stream_report_builtin_late_1d": _stream_builtin_late(_lateness(*DAY), DAY[1] + DAY[2]),
    "stream_report_emissions": _stream_emissions(_lateness(*DAY), DAY[1]),
    "stream_report_exact": _upsert(_lateness(*DAY)),
    "stream_report_late": _late(_lateness(*DAY)),
    # However the stream is cut: the changelog of the whole.
    "stream_report_refires": f"SELECT * EXCLUDE (emitted_at) FROM ({_changelog(_lateness(*DAY), *DAY[:2])})",
    "stream_report_upsert_sink": _upsert(_lateness(*DAY)),
    "time_text": TIMES,
}

for _suffix, _unit, _rules in (("", "minute", MINUTE), ("_1d", "day", DAY)):
    _latest = f"strftime(date_trunc('second', max(ts)), {TEXT})"
    ORACLES |= {
        f"late_rows_tsv{_suffix}": _late(_lateness(*_rules)),
        f"lateness_classes{_suffix}": _classes(_lateness(*_rules)),
        f"lateness_classes_by_source{_suffix}": _classes(_lateness(*_rules, SOURCES)),
        f"report_docs{_suffix}": _docs(_unit),
        f"report_docs_upsert{_suffix}": _upsert(_lateness(*_rules)),
        f"report_docs_upsert_by_source{_suffix}": _upsert(_lateness(*_rules, SOURCES)),
        f"report_final_counts{_suffix}": _final_counts(_lateness(*_rules)),
        f"report_final_counts_last_event{_suffix}": _final_last_event(_lateness(*_rules)),
        f"report_last_event_label{_suffix}": _last_event(_unit, _rules[3]),
        f"report_max_event_label{_suffix}": _report(_unit, _latest),
        f"report_refire_changelog{_suffix}": _changelog(_lateness(*_rules), *_rules[:2]),
        f"report_window_counts{_suffix}": _report(_unit),
        f"window_event_times_sorted{_suffix}": _sorted_times(_unit),
    }
