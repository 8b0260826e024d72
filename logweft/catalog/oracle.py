"""For each named query, SQL over the same tables that gives the same rows."""

from __future__ import annotations



def _records(prefix: str, lines: int) -> dict[str, str]:
    """Steps for records of that many lines, with labels, and for the sequences of anomalous ones."""
    return {
        f"{prefix}records": f"""
        SELECT BlockId, (seq_num - 1) // {lines} AS segment,
          string_agg(EventId, ',' ORDER BY seq_num) AS events,
          string_agg(CAST(interval_seconds AS VARCHAR), ',' ORDER BY seq_num) AS intervals,
          CAST(sum(interval_seconds) AS BIGINT) AS latency,
          string_agg(level, ',' ORDER BY seq_num) AS levels,
          string_agg(component, ',' ORDER BY seq_num) AS components,
          string_agg(pid, ',' ORDER BY seq_num) AS pids
        FROM timed GROUP BY 1, 2""",
        f"{prefix}labelled": f"""
        SELECT r.*, b.Label FROM {prefix}records r LEFT JOIN block_labels b ON r.BlockId = b.BlockId""",
        f"{prefix}sequences": f"""
        SELECT sequence_id, segment AS part, events AS event_sequence, count(*) AS "count"
        FROM (SELECT *, concat_ws('-', count(*) OVER b, sum(('0x' || substr(digest, 1, 15))::BIGINT::HUGEINT) OVER b,
                  sum(('0x' || substr(digest, 16, 15))::BIGINT::HUGEINT) OVER b) AS sequence_id
              FROM (SELECT *, sha256(segment || chr(10) || events) AS digest FROM {prefix}records)
              WINDOW b AS (PARTITION BY BlockId)) s
        JOIN block_labels l ON s.BlockId = l.BlockId WHERE l.Label = 1 GROUP BY 1, 2, 3""",
    }


# Named steps; a query sees those up to the one it names.
STEPS = {
    "lines": r"""
        SELECT event_id AS line_no, event_type,
          CASE WHEN event_id % 101 = 0 THEN 'malformed ' || blk
            ELSE strftime(ts, '%y%m%d %H%M%S') || ' ' || regexp_extract(props, '([0-9]+)', 1) || ' '
              || CASE WHEN event_id % 53 = 0 THEN 'DEBUG' WHEN event_id % 59 = 0 THEN 'FATAL'
                   WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'WARN' ELSE 'INFO' END
              || ' svc.Node' || (user_id + event_id) % 7 || ': ' || verb
              || CASE WHEN event_id % 97 = 0 THEN 'none' ELSE blk END END AS value
        FROM (SELECT *, 'blk_' || CASE WHEN b % 2 = 1 THEN '-' ELSE '' END || b AS blk,
              CASE event_type WHEN 'view' THEN 'Fetch started for ' WHEN 'click' THEN 'Fetch finished for '
                WHEN 'signup' THEN 'BLOCK* allocate ' WHEN 'purchase' THEN 'Verify ok for '
                ELSE 'Exception while serving ' END AS verb
              FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 5 = 0 THEN 2 + event_id % 4
                      ELSE event_id // 3 END AS b FROM events))""",
    "label_texts": r"""
        SELECT 'blk_' || CASE WHEN doc_id % 2 = 1 THEN '-' ELSE '' END || doc_id AS BlockId,
          CASE WHEN doc_id % 13 = 6 THEN 'Doubtful' WHEN toxic = 1 OR quality = 0 THEN 'Anomaly'
            ELSE 'Normal' END AS LabelText, 2 * doc_id AS label_order FROM labels
        UNION ALL
        SELECT 'blk_' || CASE WHEN doc_id % 2 = 1 THEN '-' ELSE '' END || doc_id,
          CASE WHEN toxic = 1 OR quality = 0 THEN 'Normal' ELSE 'Anomaly' END, 2 * doc_id + 1
        FROM labels WHERE doc_id % 11 = 4""",
    "block_labels": r"""
        SELECT BlockId, LabelText, label_order, CASE LabelText WHEN 'Anomaly' THEN 1
          WHEN 'Normal' THEN 0 END AS Label FROM label_texts""",
    "templates": r"""
        SELECT event_type || '-' || node AS EventId, 'svc.Node' || node || ': '
          || CASE event_type WHEN 'view' THEN 'Fetch started for ' WHEN 'click' THEN 'Fetch finished for '
               WHEN 'signup' THEN 'BLOCK* allocate ' WHEN 'purchase' THEN 'Verify ok for '
               ELSE 'Exception while serving ' END || '[*]' AS EventTemplate,
          row_number() OVER (ORDER BY first) AS priority
        FROM (SELECT event_type, (user_id + event_id) % 7 AS node, min(event_id) AS first FROM events GROUP BY 1, 2)""",
    "pid_templates": r"""
        SELECT *, 'svc.Node' || node || ':' AS w2, event_type || '-' || node || '-' || pid AS EventId,
          CASE event_type WHEN 'view' THEN 'started' WHEN 'click' THEN 'finished' WHEN 'signup' THEN 'BLOCK*'
            WHEN 'purchase' THEN 'Verify' ELSE 'Exception' END AS w3,
          CASE event_type WHEN 'view' THEN 'Fetch' WHEN 'click' THEN 'Fetch' WHEN 'signup' THEN 'allocate'
            WHEN 'purchase' THEN 'ok' ELSE 'while' END AS w4,
          CASE event_type WHEN 'signup' THEN '' WHEN 'error' THEN 'serving' ELSE 'for' END AS w5
        FROM (SELECT event_type, (user_id + event_id) % 7 AS node, regexp_extract(props, '([0-9]+)', 1) AS pid,
                min(event_id) AS priority FROM events GROUP BY 1, 2, 3)""",
    "truth": r"""
        SELECT event_id // 3 AS block, list(CASE WHEN event_id % 202 = 0 THEN 'E9' WHEN event_id % 101 = 0 THEN 'Unknown'
          WHEN event_type = 'view' THEN 'E1' WHEN event_type = 'click' THEN 'E2'
          WHEN event_type = 'signup' THEN 'E3' WHEN event_type = 'purchase' THEN 'E4'
          ELSE 'E5' END) AS events FROM events GROUP BY 1""",
    "fields": r"""
        SELECT *, regexp_extract(value, '^(\d{6} \d{6})', 1) AS date_time,
          regexp_extract(value, '^(?:\d{6} \d{6}) (\d+)', 1) AS pid,
          regexp_extract(value, '^(?:\d{6} \d{6}) (?:\d+) (\w+)', 1) AS level,
          regexp_extract(value, '^(?:\d{6} \d{6}) (?:\d+) (?:\w+) ([^:]+)', 1) AS component,
          regexp_extract(value, '(blk_-?\d+)', 1) AS BlockId FROM lines""",
    "parsed": r"""
        SELECT *, try_strptime(date_time, '%y%m%d %H%M%S') AS timestamp,
          CASE WHEN contains(value, 'Fetch') AND contains(value, 'started') THEN 'E1'
            WHEN contains(value, 'Fetch') THEN 'E2'
            WHEN contains(value, 'BLOCK*') AND contains(value, 'allocate') THEN 'E3'
            WHEN contains(value, 'Verify') AND contains(value, 'ok') THEN 'E4'
            WHEN contains(value, 'Exception') AND contains(value, 'while') THEN 'E5'
            ELSE 'Unknown' END AS EventId FROM fields""",
    "kept": "SELECT * FROM parsed WHERE BlockId <> ''",
    "placed": r"""
        SELECT *, row_number() OVER w AS seq_num, lag(timestamp) OVER w AS prev_timestamp FROM kept
        WINDOW w AS (PARTITION BY BlockId ORDER BY timestamp NULLS FIRST, line_no)""",
    "timed": r"""
        SELECT *, coalesce(CAST(epoch(timestamp) - epoch(prev_timestamp) AS BIGINT), 0)
          AS interval_seconds FROM placed""",
    "latencies": r"""
        SELECT BlockId, CAST(sum(interval_seconds) AS BIGINT) AS latency FROM timed GROUP BY 1""",
    "block_rows": r"""
        SELECT l.*, b.Label FROM latencies l LEFT JOIN block_labels b ON l.BlockId = b.BlockId""",
    **_records("", 100000),
    **_records("short_", 64),
    "level_shares": r"""
        SELECT component, level, count(*) AS "count",
          CAST(sum(count(*)) OVER (PARTITION BY component) AS BIGINT) AS total,
          100.0 * count(*) / sum(count(*)) OVER (PARTITION BY component) AS percentage
        FROM parsed GROUP BY 1, 2""",
    "busiest": r"""
        SELECT component, count(*) AS "count" FROM parsed GROUP BY 1
        ORDER BY "count" DESC, component LIMIT 10""",
    "top_shares": "SELECT * FROM level_shares WHERE component IN (SELECT component FROM busiest)",
    "wide": r"""
        SELECT component, sum(CASE WHEN level = '' THEN percentage ELSE 0 END) AS BLANK,
          sum(CASE WHEN level = 'ERROR' THEN percentage ELSE 0 END) AS ERROR,
          sum(CASE WHEN level = 'INFO' THEN percentage ELSE 0 END) AS INFO,
          sum(CASE WHEN level = 'WARN' THEN percentage ELSE 0 END) AS WARN
        FROM top_shares GROUP BY 1""",
    "long": r"""
        SELECT component, CASE WHEN level = '' THEN 'BLANK' ELSE level END AS level,
          coalesce(percentage, 0) AS percentage
        FROM (SELECT DISTINCT component FROM top_shares) CROSS JOIN (SELECT DISTINCT level FROM top_shares)
          LEFT JOIN top_shares USING (component, level)""",
    "errors": r"""
        SELECT component, level, count(*) AS "count" FROM parsed
        WHERE level IN ('ERROR', 'WARN') GROUP BY 1, 2""",
    "hours": r"""
        SELECT CAST(hour(timestamp) AS INTEGER) AS hour, count(*) AS "count" FROM parsed GROUP BY 1""",
    "by_label": r"""
        SELECT CASE Label WHEN 1 THEN 'anomaly' ELSE 'normal' END AS type, component,
          count(*) AS "count"
        FROM kept k JOIN block_labels b ON k.BlockId = b.BlockId WHERE Label IS NOT NULL GROUP BY 1, 2""",
    "ratios": r"""
        SELECT component, anomaly, normal, anomaly / CAST(anomaly + normal AS DOUBLE) AS anomaly_ratio
        FROM (SELECT component,
                CAST(sum(CASE WHEN type = 'anomaly' THEN "count" ELSE 0 END) AS BIGINT) AS anomaly,
                CAST(sum(CASE WHEN type = 'normal' THEN "count" ELSE 0 END) AS BIGINT) AS normal
              FROM by_label GROUP BY 1)""",
    "slowness": r"""
        SELECT component, avg(latency) AS avg_latency
        FROM (SELECT DISTINCT BlockId, component FROM kept) k
        JOIN block_rows l ON k.BlockId = l.BlockId GROUP BY 1""",
}


def _query(last: str, select: str) -> str:
    names = list(STEPS)
    steps = names[: names.index(last) + 1]
    return "WITH " + ",\n".join(f"{name} AS ({STEPS[name]})" for name in steps) + "\n" + select


_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_RATIO = "component, anomaly, normal, round(anomaly_ratio, 6) AS anomaly_ratio"
_SLOW = "SELECT component, round(avg_latency, 6) AS avg_latency FROM slowness"

ORACLE = {
    "log_scan": _query("lines", "SELECT value FROM lines"),
    "line_numbers": _query("lines", "SELECT row_number() OVER (ORDER BY line_no) - 1 AS line_number, value FROM lines"),
    "template_scan": _query("templates", "SELECT EventId, EventTemplate, priority FROM templates"),
    "label_scan": _query(
        "block_labels",
        "SELECT BlockId, LabelText AS Label FROM block_labels",
    ),
    "truth_event_counts": _query(
        "truth",
        "SELECT EventId, count(*) AS expected FROM (SELECT unnest(events) AS EventId FROM truth) GROUP BY 1",
    ),
    "parse_fields": _query(
        "fields", "SELECT line_no, date_time, pid, level, component, BlockId FROM fields"
    ),
    "parse_timestamp": _query(
        "parsed", f"SELECT line_no, date_time, {_TIME.format('timestamp')} FROM parsed"
    ),
    "template_markers": _query(
        "templates",
        r"""SELECT EventId, array_to_string(list_transform(
              regexp_extract_all(replace(EventTemplate, '[*]', chr(10)), '[\w.:]+'),
              lambda w: CASE WHEN w = 'BLOCK' THEN 'BLOCK*' ELSE w END), ',') AS markers
            FROM templates""",
    ),
    "classify_events": _query("parsed", "SELECT line_no, EventId FROM parsed"),
    "classify_events_join": _query("parsed", "SELECT line_no, EventId FROM parsed"),
    "classify_events_indexed": _query(
        "fields",
        """SELECT line_no, coalesce(min_by(t.EventId, t.priority), 'Unknown') AS EventId
           FROM lines l LEFT JOIN pid_templates t ON contains(value, w2) AND contains(value, w3)
             AND contains(value, w4) AND contains(value, w5) AND contains(value, pid) GROUP BY 1""",
    ),
    "encode_labels": _query("block_labels", "SELECT BlockId, Label, LabelText FROM block_labels"),
    "drop_missing_blocks": _query("kept", "SELECT line_no, BlockId FROM kept"),
    "event_counts": _query("parsed", 'SELECT EventId, count(*) AS "count" FROM parsed GROUP BY 1'),
    "validate_event_counts": _query(
        "parsed",
        """SELECT t.EventId, expected, coalesce(actual, 0) AS actual,
             expected = coalesce(actual, 0) AS matches
           FROM (SELECT EventId, count(*) AS expected
                 FROM (SELECT unnest(events) AS EventId FROM truth) GROUP BY 1) t
           LEFT JOIN (SELECT EventId, count(*) AS actual FROM parsed GROUP BY 1) p
             ON t.EventId = p.EventId""",
    ),
    "validate_on_write": _query(
        "parsed",
        """SELECT t.EventId, expected, coalesce(actual, 0) AS actual, expected = coalesce(actual, 0) AS matches
           FROM (SELECT EventId, count(*) AS expected
                 FROM (SELECT unnest(events) AS EventId FROM truth) GROUP BY 1) t
           LEFT JOIN (SELECT EventId, count(*) AS actual FROM parsed GROUP BY 1) p ON t.EventId = p.EventId
           UNION ALL SELECT 'lines without a block', 0, count(*), count(*) = 0 FROM parsed WHERE BlockId = ''""",
    ),
    "validate_missing_blocks": _query(
        "parsed",
        """SELECT count(*) AS lines, count(*) FILTER (WHERE BlockId IS NULL OR BlockId = '') AS missing
           FROM parsed""",
    ),
    "sequence_events": _query(
        "placed",
        f"""SELECT BlockId, line_no, EventId, seq_num, {_TIME.format('timestamp')},
              {_TIME.format('prev_timestamp')} FROM placed""",
    ),
    "event_intervals": _query("timed", "SELECT BlockId, seq_num, interval_seconds FROM timed"),
    "block_records": _query("labelled", "SELECT * FROM labelled"),
    "block_records_default0": _query(
        "records",
        """SELECT r.*, coalesce(b.Label, 0) AS Label FROM records r
           LEFT JOIN (SELECT BlockId, Label FROM block_labels
                      QUALIFY row_number() OVER (PARTITION BY BlockId ORDER BY label_order) = 1) b
             ON r.BlockId = b.BlockId""",
    ),
    "event_intervals_hot": _query(
        "timed", "SELECT BlockId, line_no, seq_num, interval_seconds FROM timed"
    ),
    "block_records_segments": _query("short_labelled", "SELECT * FROM short_labelled"),
    "anomaly_sequences_segments": _query("short_sequences", "SELECT * FROM short_sequences"),
    "block_latency": _query("latencies", "SELECT * FROM latencies"),
    "array_to_string": _query(
        "truth", "SELECT block, array_to_string(list_sort(events), ',') AS events FROM truth"
    ),
    "layout_shuffle_width": _query(
        "latencies",
        """SELECT BlockId, latency, width FROM latencies,
             (VALUES (1), (2), (4), (8), (16), (32), (64)) w(width)""",
    ),
    **{
        f"layout_{name}": _query("latencies", "SELECT * FROM latencies")
        for name in ("repartition", "up", "down", "coalesce")
    },
    "stored_block_latency": _query("latencies", "SELECT * FROM latencies"),
    "stored_block_records": _query("labelled", "SELECT * FROM labelled"),
    "stored_component_latency": _query("slowness", _SLOW),
    "error_frequencies": _query("errors", "SELECT * FROM errors"),
    "error_frequencies_top10": _query(
        "errors", 'SELECT * FROM errors ORDER BY "count" DESC, component, level LIMIT 10'
    ),
    "top_error_components": _query(
        "errors",
        """SELECT component, CAST(sum("count") AS BIGINT) AS "count" FROM errors GROUP BY 1
           ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
    "hourly_activity": _query("hours", "SELECT * FROM hours"),
    "peak_hours": _query(
        "hours", 'SELECT * FROM hours ORDER BY "count" DESC, hour NULLS LAST LIMIT 3'
    ),
    "level_distribution": _query(
        "level_shares",
        'SELECT component, level, "count", total, round(percentage, 6) AS percentage FROM level_shares',
    ),
    "level_distribution_top10": _query(
        "top_shares",
        'SELECT component, level, "count", total, round(percentage, 6) AS percentage FROM top_shares',
    ),
    "top_components": _query("busiest", "SELECT * FROM busiest"),
    "distinct_components": _query("parsed", "SELECT DISTINCT component FROM parsed"),
    "level_pivot": _query(
        "long",
        "SELECT component, "
        + ", ".join(
            f"round(sum(CASE WHEN level = '{level}' THEN percentage ELSE 0 END), 6) AS {level}"
            for level in ("BLANK", "DEBUG", "ERROR", "FATAL", "INFO", "WARN")
        )
        + " FROM long GROUP BY 1",
    ),
    "level_unpivot": _query(
        "long", "SELECT component, level, round(percentage, 6) AS percentage FROM long"
    ),
    "level_stack": _query(
        "long",
        """SELECT component, level, round(percentage, 6) AS percentage,
             round(coalesce(sum(percentage) OVER (PARTITION BY component ORDER BY level
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS base FROM long""",
    ),
    "level_maps": _query(
        "top_shares",
        """SELECT component, string_agg(CASE WHEN level = '' THEN 'BLANK' ELSE level END || '='
             || CAST(CAST(percentage AS DECIMAL(18, 6)) AS VARCHAR), ','
             ORDER BY CASE WHEN level = '' THEN 'BLANK' ELSE level END) AS levels FROM top_shares GROUP BY 1""",
    ),
    "level_map_stack": _query(
        "top_shares",
        """SELECT component, level, round(percentage, 6) AS percentage, round(coalesce(sum(percentage) OVER
             (PARTITION BY component ORDER BY level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS base
           FROM (SELECT component, CASE WHEN level = '' THEN 'BLANK' ELSE level END AS level, percentage FROM top_shares)""",
    ),
    "lines_one_pass": _query(
        "hours",
        """SELECT 'errors' AS analysis, component AS subject, level, "count" FROM errors
           UNION ALL SELECT 'hours', CAST(hour AS VARCHAR), NULL, "count" FROM hours
           UNION ALL SELECT 'levels', component, level, "count" FROM level_shares
           UNION ALL SELECT 'busiest', component, NULL, "count" FROM busiest
           UNION ALL (SELECT 'severe', component, NULL, CAST(sum("count") AS BIGINT) AS n FROM errors GROUP BY component
             ORDER BY n DESC, component LIMIT 10)""",
    ),
    "label_summary": _query(
        "block_rows",
        """SELECT normal, anomaly, normal + anomaly AS total,
             round(100.0 * normal / nullif(normal + anomaly, 0), 6) AS normal_pct,
             round(100.0 * anomaly / nullif(normal + anomaly, 0), 6) AS anomaly_pct
           FROM (SELECT count(*) FILTER (WHERE Label = 0) AS normal,
                   count(*) FILTER (WHERE Label = 1) AS anomaly FROM block_rows)""",
    ),
    "anomaly_sequences": _query("sequences", "SELECT * FROM sequences"),
    "anomaly_sequences_top5": _query(
        "sequences",
        """SELECT * FROM sequences WHERE sequence_id IN (SELECT sequence_id FROM sequences WHERE part = 0
             ORDER BY "count" DESC, sequence_id LIMIT 5)""",
    ),
    "component_by_label": _query(
        "by_label",
        """SELECT type, component, "count",
             round(100.0 * "count" / sum("count") OVER (PARTITION BY type), 6) AS percentage
           FROM by_label""",
    ),
    "component_anomaly_ratio": _query("ratios", f"SELECT {_RATIO} FROM ratios"),
    "component_anomaly_ratio_top10": _query(
        "ratios", f"SELECT {_RATIO} FROM ratios ORDER BY ratios.anomaly_ratio DESC, component LIMIT 10"
    ),
    "latency_stats": _query(
        "block_rows",
        """SELECT min(latency) AS min_latency, max(latency) AS max_latency,
             round(avg(latency), 6) AS avg_latency,
             round(quantile_cont(latency, 0.5), 6) AS median_latency,
             round(quantile_cont(latency, 0.95), 6) AS p95_latency FROM block_rows""",
    ),
    "component_latency": _query("slowness", _SLOW),
    "component_latency_bits": _query("slowness", _SLOW),
    "component_latency_top10": _query(
        "slowness", f"{_SLOW} ORDER BY slowness.avg_latency DESC, component LIMIT 10"
    ),
    "component_latency_top15": _query(
        "slowness", f"{_SLOW} ORDER BY slowness.avg_latency DESC, component LIMIT 15"
    ),
    "latency_top5_other": _query(
        "slowness",
        """SELECT component, round(avg_latency, 6) AS avg_latency,
             round(100.0 * avg_latency / sum(avg_latency) OVER (), 6) AS share
           FROM (SELECT component, avg_latency FROM
                   (SELECT *, row_number() OVER (ORDER BY avg_latency DESC, component) AS place
                    FROM slowness) WHERE place <= 5
                 UNION ALL
                 SELECT 'Other Components', coalesce(sum(avg_latency), 0) FROM
                   (SELECT *, row_number() OVER (ORDER BY avg_latency DESC, component) AS place
                    FROM slowness) WHERE place > 5)""",
    ),
    "blocks_with_component": _query(
        "latencies",
        """SELECT * FROM latencies
           WHERE BlockId IN (SELECT BlockId FROM kept WHERE component = 'svc.Node3')""",
    ),
    "key_findings": _query(
        "slowness",
        """, severe AS (SELECT CASE WHEN count(*) FILTER (WHERE level = 'ERROR') > 0 THEN 'ERROR'
                          ELSE 'WARN' END AS level FROM top_shares)
           SELECT finding, subject, round(value, 6) AS value FROM (
             (SELECT 'most_issues' AS finding, component AS subject, CAST(sum("count") AS DOUBLE) AS value
              FROM errors GROUP BY component ORDER BY 3 DESC, 2 LIMIT 1)
             UNION ALL (SELECT 'peak_hour', CAST(hour AS VARCHAR), CAST("count" AS DOUBLE) FROM hours
              ORDER BY "count" DESC, hour NULLS LAST LIMIT 1)
             UNION ALL (SELECT 'highest_anomaly_ratio', component, anomaly_ratio FROM ratios
              ORDER BY anomaly_ratio DESC, component LIMIT 1)
             UNION ALL (SELECT 'most_info', component, INFO FROM wide ORDER BY INFO DESC, component LIMIT 1)
             UNION ALL (SELECT 'most_severe', component, share FROM
               (SELECT component, sum(CASE WHEN level = (SELECT level FROM severe) THEN percentage
                  ELSE 0 END) AS share FROM top_shares GROUP BY 1) ORDER BY share DESC, component LIMIT 1)
             UNION ALL (SELECT 'slowest', component, avg_latency FROM slowness
              ORDER BY avg_latency DESC, component LIMIT 1))""",
    ),
}
