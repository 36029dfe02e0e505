"""The registered queries as DuckDB SQL, joins and windows spelled out in full.

Types, thresholds, labels and times are stated here anew rather than taken from the rules.
"""

from __future__ import annotations

from typing import NamedTuple


class Side(NamedTuple):
    metric: str
    metric_type: str
    output: str
    threshold: float


class Job(NamedTuple):
    name: str
    left: Side
    right: Side
    aggregate: str
    both_label: str
    left_label: str
    right_label: str


CPU_MEM = Job(
    "cpu_mem",
    Side("cpu_pct", "FLOAT", "avg_cpu", 75.69),
    Side("mem_pct", "FLOAT", "avg_mem", 74.28),
    "avg",
    "High CPU + Memory stress",
    "CPU spike suspected",
    "Memory saturation suspected",
)
NET_DISK = Job(
    "net_disk",
    Side("net_in", "DOUBLE", "max_net_in", 6477.4),
    Side("disk_io", "DOUBLE", "max_disk_io", 1176.57),
    "max",
    "Network flood + Disk thrash suspected",
    "Possible DDoS",
    "Disk thrash suspected",
)
# Metrics and types by topic.
TOPICS = {
    "topic-cpu": {"cpu_pct": "FLOAT"},
    "topic-mem": {"mem_pct": "FLOAT"},
    "topic-net": {"net_in": "DOUBLE", "net_out": "DOUBLE"},
    "topic-disk": {"disk_io": "DOUBLE"},
}

_WIDE_COLUMNS = """
    'server_' || (user_id % 20) AS server_id,
    least(value, 100.0) AS cpu_pct,
    (props::json->>'k')::DOUBLE AS mem_pct,
    value * 100 AS net_in,
    value * 10 AS net_out,
    (props::json->>'k')::DOUBLE * 16 AS disk_io"""
_CLOCK = "strftime(ts, '%H:%M:%S')"
_WIDE = f"SELECT {_CLOCK} AS ts, {_WIDE_COLUMNS} FROM events"
_WIDE_STAMPED = f"SELECT date_trunc('second', ts) AS ts, {_WIDE_COLUMNS} FROM events"


def _round2(value: str) -> str:
    """Decimal rounding of a double's shortest text, ties away from zero."""
    exact = f"round({value}::VARCHAR::DECIMAL(38, 18), 2)::DOUBLE"
    return f"CASE WHEN isfinite({value}) THEN {exact} ELSE {value} END"


def _metric(side: Side) -> str:
    return f"{side.metric}::{side.metric_type}"


def _joined(rule: Job, wide: str) -> str:
    return f"""
        wide AS ({wide}),
        l AS (SELECT ts, server_id, {_metric(rule.left)} AS a FROM wide),
        r AS (SELECT ts, server_id, {_metric(rule.right)} AS b FROM wide),
        joined AS (SELECT ts, server_id, a, b FROM l JOIN r USING (ts, server_id))"""


def _windows(rule: Job, stamped: bool = False, wide: str | None = None) -> str:
    """CTEs ending in ``windows``: server, window start and both raw aggregates."""
    time = "ts" if stamped else "('1970-01-01 ' || ts)::TIMESTAMP"
    start = f"(floor(epoch({time}) / 10)::BIGINT * 10 - o.k) * 1000000"
    return f"""{_joined(rule, wide or (_WIDE_STAMPED if stamped else _WIDE))},
        windows AS (
            SELECT server_id, make_timestamp({start}) AS s,
                   {rule.aggregate}(a) AS a, {rule.aggregate}(b) AS b
            FROM joined CROSS JOIN (VALUES (0), (10), (20)) o(k)
            GROUP BY ALL)"""


_KEPT = "strftime(s, '%H:%M:%S') >= '20:53:00'"


def _alerts(rule: Job, stamped: bool = False) -> str:
    left, right = rule.left, rule.right
    end = "s + INTERVAL 30 SECOND"
    return f"""
        WITH {_windows(rule, stamped)},
        rounded AS (
            SELECT server_id, s, {_round2('a')} AS a, {_round2('b')} AS b
            FROM windows WHERE {_KEPT})
        SELECT server_id, strftime(s, '%H:%M:%S') AS window_start,
               strftime({end}, '%H:%M:%S') AS window_end,
               a AS {left.output}, b AS {right.output},
               CASE WHEN a > {left.threshold} AND b > {right.threshold} THEN '{rule.both_label}'
                    WHEN a > {left.threshold} AND b <= {right.threshold} THEN '{rule.left_label}'
                    WHEN a <= {left.threshold} AND b > {right.threshold} THEN '{rule.right_label}'
                    ELSE '' END AS alert
        FROM rounded"""


def _with_thresholds(rule: Job, left: float, right: float) -> Job:
    return rule._replace(
        left=rule.left._replace(threshold=left), right=rule.right._replace(threshold=right)
    )


def _split(topic: str) -> str:
    columns = ", ".join(
        f"{name}::{kind} AS {name}" for name, kind in TOPICS[topic].items()
    )
    return f"SELECT ts, server_id, {columns} FROM ({_WIDE})"


def _join(rule: Job) -> str:
    return f"""
        WITH {_joined(rule, _WIDE)}
        SELECT ts, server_id, count(*) AS joined_rows, {rule.aggregate}(a) AS left_value,
               {rule.aggregate}(b) AS right_value
        FROM joined GROUP BY ts, server_id"""


def _all_windows(rule: Job) -> str:
    stamp = "'%Y-%m-%d %H:%M:%S'"
    end = "s + INTERVAL 30 SECOND"
    return f"""
        WITH {_windows(rule)}
        SELECT server_id, strftime(s, {stamp}) AS window_start,
               strftime({end}, {stamp}) AS window_end,
               epoch({end} - s)::BIGINT AS seconds,
               a::DOUBLE AS left_raw, b::DOUBLE AS right_raw
        FROM windows"""


def _roundtrip() -> str:
    parts = [
        f"SELECT '{topic}' AS topic, ts, server_id, '{name}' AS metric, "
        f"{name}::{kind}::DOUBLE AS value FROM wide"
        for topic, metrics in TOPICS.items()
        for name, kind in metrics.items()
    ]
    return f"WITH wide AS ({_WIDE}) " + " UNION ALL ".join(parts)


def _distinct_roundtrip() -> str:
    """Per topic, records that are equal in all of their fields count once."""
    parts = []
    for topic, metrics in TOPICS.items():
        names = ", ".join(f"{name}::{kind} AS {name}" for name, kind in metrics.items())
        parts += [
            f"SELECT '{topic}' AS topic, ts, server_id, '{name}' AS metric, {name}::DOUBLE AS value "
            f"FROM (SELECT DISTINCT ts, server_id, {names} FROM wide)"
            for name in metrics
        ]
    return f"WITH wide AS ({_WIDE}) " + " UNION ALL ".join(parts)


def _pipeline_counts() -> str:
    parts = []
    for rule in (CPU_MEM, NET_DISK):
        stages = {
            "left_records": "SELECT count(*) FROM events",
            "right_records": "SELECT count(*) FROM events",
            "joined_records": f"WITH {_joined(rule, _WIDE)} SELECT count(*) FROM joined",
            "windows": f"WITH {_windows(rule)} SELECT count(*) FROM windows WHERE {_KEPT}",
        }
        parts += [
            f"SELECT '{rule.name}' AS job, '{stage}' AS stage, ({sql})::BIGINT AS n"
            for stage, sql in stages.items()
        ]
    return " UNION ALL ".join(parts)


def _earliest(rule: Job) -> str:
    return f"WITH {_joined(rule, _WIDE)} SELECT min(ts) AS earliest FROM joined"


def _windows_cutoff(rule: Job) -> str:
    return f"""
        WITH {_windows(rule)}
        SELECT server_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
               a::DOUBLE AS left_raw, b::DOUBLE AS right_raw
        FROM windows WHERE {_KEPT}"""


def _job_report(rule: Job) -> str:
    """Three events in ten have no readable time: they are counted and join nothing."""
    damaged = f"{_WIDE} WHERE event_id % 10 > 2"
    return f"""
        SELECT '{rule.name}' AS job,
            (SELECT count(*) FROM events) AS left_records,
            (SELECT count(*) FROM events) AS right_records,
            (SELECT count(*) FROM events WHERE event_id % 10 <= 2) AS left_bad_times,
            (SELECT count(*) FROM events WHERE event_id % 10 <= 2) AS right_bad_times,
            (WITH {_joined(rule, damaged)} SELECT count(*) FROM joined) AS joined_records,
            (WITH {_joined(rule, damaged)} SELECT min(ts) FROM joined) AS earliest,
            (WITH {_windows(rule, wide=damaged)}
                SELECT count(*) FROM windows WHERE {_KEPT}) AS windows"""


_SERVER = "'server_' || (user_id % 20)"
_LINE = f"{_CLOCK} || ',' || {_SERVER} || ',' || event_id"
_LINES = f"""
    SELECT CASE WHEN event_id % 10 IN (0, 1) THEN 'field_count' ELSE 'not_a_number' END AS problem,
        CASE event_id % 10
            WHEN 0 THEN {_LINE} || ',1e2,0.10,+5,7,1'
            WHEN 1 THEN {_LINE} || ',1e2'
            WHEN 2 THEN {_LINE} || ',1e2,0.10,abc,7'
            ELSE '  ' || {_LINE} || ',1e2,,0.10, 5' END AS raw
    FROM events WHERE event_id % 10 <= 3"""

# Blanks around an object are fine (3 and 4); all other spellings but the plain one are refused.
_RECORDS = f"""
    SELECT event_id,
        CASE WHEN event_id % 10 IN (3, 4, 9) THEN {_CLOCK} END AS ts,
        CASE WHEN event_id % 10 IN (3, 4, 9) THEN {_SERVER} END AS server_id,
        CASE WHEN event_id % 10 IN (3, 4, 9) THEN 1.5::FLOAT END AS cpu_pct,
        CASE WHEN event_id % 10 NOT IN (3, 4, 9) THEN 'undecodable' END AS problem
    FROM events"""

_SPELLED = f"""
    SELECT event_id, CASE event_id % 7
        WHEN 0 THEN strftime(ts, '%-H:%M:%S')
        WHEN 1 THEN strftime(ts, '%H:%M')
        WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
        WHEN 3 THEN '24:' || strftime(ts, '%M:%S')
        WHEN 4 THEN ''
        ELSE {_CLOCK} END AS text
    FROM events"""

# Lines damaged as 4 and 5 are headers and blanks: skipped without being refused.
_QUARANTINE = """
    WITH kinds AS (SELECT event_id % 10 AS kind FROM events),
    checks AS (
        SELECT 'line' AS stage, CASE WHEN kind IN (0, 1) THEN 'field_count'
            WHEN kind = 2 THEN 'not_a_number' ELSE 'ok' END AS problem
        FROM kinds WHERE kind NOT IN (4, 5)
        UNION ALL
        SELECT 'time', CASE WHEN kind = 3 THEN 'bad_time' ELSE 'ok' END
        FROM kinds WHERE kind IN (3, 6, 7, 8, 9)
        UNION ALL
        SELECT 'record', CASE WHEN kind IN (0, 1, 2) THEN 'undecodable' ELSE 'ok' END FROM kinds)
    SELECT stage, problem, count(*) AS n FROM checks GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "wide_metrics": _WIDE,
    "wide_csv_scan": _WIDE,
    "wide_csv_skip_first": f"""{_WIDE} WHERE event_id NOT IN (
        SELECT min(event_id) FROM events GROUP BY event_id % 5)""",
    "split_cpu": _split("topic-cpu"),
    "split_mem": _split("topic-mem"),
    "split_net": _split("topic-net"),
    "split_disk": _split("topic-disk"),
    "topic_roundtrip": _roundtrip(),
    "topic_counts": " UNION ALL ".join(
        f"SELECT '{topic}' AS topic, count(*) AS n FROM events" for topic in TOPICS
    ),
    "parse_time_of_day": f"""
        SELECT event_id, text, CASE
            WHEN regexp_full_match(text, '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') THEN text
            END AS parsed
        FROM ({_SPELLED})""",
    "quarantine_counts": _QUARANTINE,
    "quarantined_lines": _LINES,
    "decoded_records": _RECORDS,
    "cpu_mem_join": _join(CPU_MEM),
    "net_disk_join": _join(NET_DISK),
    "min_event_time": _earliest(CPU_MEM),
    "net_disk_min_event_time": _earliest(NET_DISK),
    "job_report_counts": f"{_job_report(CPU_MEM)} UNION ALL {_job_report(NET_DISK)}",
    "pipeline_counts": _pipeline_counts(),
    "cpu_mem_windows": _all_windows(CPU_MEM),
    "net_disk_windows": _all_windows(NET_DISK),
    "cpu_mem_windows_cutoff": _windows_cutoff(CPU_MEM),
    "net_disk_windows_cutoff": _windows_cutoff(NET_DISK),
    "cpu_mem_alerts": _alerts(CPU_MEM),
    "net_disk_alerts": _alerts(NET_DISK),
    "cpu_mem_alerts_timestamped": _alerts(CPU_MEM, stamped=True),
    "net_disk_alerts_timestamped": _alerts(NET_DISK, stamped=True),
    "input_preview": f"SELECT * FROM ({_split('topic-cpu')}) ORDER BY ALL LIMIT 5",
    "alerts_preview": f"SELECT * FROM ({_alerts(CPU_MEM)}) ORDER BY ALL LIMIT 20",
    "alerts_csv_roundtrip": _alerts(CPU_MEM),
    "net_disk_alerts_csv_roundtrip": _alerts(NET_DISK),
    "cpu_mem_command_line": _alerts(_with_thresholds(CPU_MEM, 60.5, 45.0)),
    "net_disk_command_line": _alerts(_with_thresholds(NET_DISK, 5000.25, 45.0)),
    "alerts_published": _alerts(NET_DISK),
    "alerts_single_file": _alerts(NET_DISK),
    "landed_deduplicated": _distinct_roundtrip(),
    "message_counts": """
        SELECT (event_id % 2)::INT AS run, 4 * count(*) AS messages FROM events GROUP BY ALL""",
    "landed_distinct": _distinct_roundtrip(),
    "landed_compacted": _roundtrip(),
    "incremental_cpu_mem_alerts": _alerts(CPU_MEM),
    "incremental_net_disk_alerts": _alerts(NET_DISK),
    "layout_cpu_mem_alerts": _alerts(CPU_MEM),
    "layout_net_disk_alerts": _alerts(NET_DISK),
    "stream_landing": _roundtrip(),
    "stream_cpu_mem_alerts": _alerts(CPU_MEM, stamped=True),
    "stream_net_disk_alerts": _alerts(NET_DISK, stamped=True),
    "stream_cpu_mem_corrected": _alerts(CPU_MEM, stamped=True),
    "stream_net_disk_corrected": _alerts(NET_DISK, stamped=True),
}
