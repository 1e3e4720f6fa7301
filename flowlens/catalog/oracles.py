"""The catalog's queries in plain SQL, for an independent engine over the same tables."""

from __future__ import annotations

# Flows, cleaned flows, features and fixed predictions, as in `queries`.
BASE = """
WITH flows AS (
  SELECT event_id AS uid,
         epoch_us(ts) / 1e6 AS ts,
         concat('10.0.0.', user_id) AS orig_h,
         CAST(20000 + event_id % 30000 AS DOUBLE) AS orig_p,
         concat('10.1.0.', event_id % 16) AS resp_h,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS resp_p,
         CASE WHEN event_type IN ('click', 'view') THEN 'udp'
              WHEN event_type = 'purchase' THEN 'icmp' ELSE 'tcp' END AS proto,
         CASE WHEN event_id % 7 = 0 THEN '-'
              ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS duration,
         CASE WHEN event_id % 7 = 0 THEN '-'
              ELSE CAST(user_id * event_id % 1000 AS VARCHAR) END AS orig_bytes,
         CASE WHEN event_id % 5 = 0 THEN '-'
              ELSE CAST(event_id % 4096 AS VARCHAR) END AS resp_bytes,
         CASE event_type WHEN 'error' THEN 'S0' WHEN 'signup' THEN 'REJ' ELSE 'SF' END
           AS conn_state,
         CASE WHEN event_id % 101 = 0 THEN NULL
              WHEN event_type = 'error'
                OR CAST(json_extract_string(props, '$.k') AS INTEGER) >= 90
              THEN 'Malicious' ELSE 'Benign' END AS label,
         event_type AS detailed_label
  FROM events
), cleaned AS (
  SELECT uid, ts, orig_h, orig_p, resp_h, resp_p, proto, conn_state, label, detailed_label,
         coalesce(TRY_CAST(duration AS DOUBLE), 0) AS duration,
         coalesce(TRY_CAST(orig_bytes AS BIGINT), 0) AS orig_bytes,
         coalesce(TRY_CAST(resp_bytes AS BIGINT), 0) AS resp_bytes,
         CAST(orig_p AS INTEGER) AS orig_port, CAST(resp_p AS INTEGER) AS resp_port
  FROM flows
), timed AS (
  SELECT *, make_timestamp(CAST(floor(ts) AS BIGINT) * 1000000) AS "timestamp",
         orig_bytes + resp_bytes AS total_bytes
  FROM cleaned
), featured AS (
  SELECT *, CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
         CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week,
         total_bytes / (duration + CAST(0.001 AS DOUBLE)) AS bytes_per_sec
  FROM timed
), predicted AS (
  SELECT *, "timestamp" AS processing_time,
         CASE WHEN uid % 50 = 0 THEN 'Unknown'
              WHEN resp_p >= 80 OR conn_state = 'S0' THEN 'Malicious'
              ELSE 'Benign' END AS predicted_label
  FROM featured
), predictions AS (
  SELECT * FROM predicted WHERE label IS NOT NULL
)
"""

CLOCK = "'%Y-%m-%d %H:%M:%S'"

# Rank of each value by frequency, ties by value, over labelled flows.
RANKS = """
, proto_rank AS (
  SELECT proto, row_number() OVER (ORDER BY count(*) DESC, proto) - 1 AS i
  FROM featured WHERE label IS NOT NULL AND proto IS NOT NULL GROUP BY proto
), state_rank AS (
  SELECT conn_state, row_number() OVER (ORDER BY count(*) DESC, conn_state) - 1 AS i
  FROM featured WHERE label IS NOT NULL AND conn_state IS NOT NULL GROUP BY conn_state
), label_rank AS (
  SELECT label, row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS i
  FROM featured WHERE label IS NOT NULL GROUP BY label
)
"""

# The order of the parts of a feature vector, stated here once more so that the SQL
# does not depend on the code it checks.
NUMERIC = [
    "duration", "orig_bytes", "resp_bytes", "orig_port", "resp_port", "total_bytes",
    "bytes_per_sec", "hour_of_day", "day_of_week",
]


def _slot(table: str, number: int) -> str:
    return f"CAST(CASE WHEN {table}.i = {number} THEN 1 ELSE 0 END AS DOUBLE)"


VECTOR = (
    [f"CAST(f.{c} AS DOUBLE)" for c in NUMERIC]
    + [_slot("p", n) for n in range(3)]
    + [_slot("s", n) for n in range(3)]
)
RANKED_FLOWS = (
    "featured f JOIN proto_rank p ON f.proto = p.proto "
    "JOIN state_rank s ON f.conn_state = s.conn_state WHERE f.label IS NOT NULL"
)


def _vector(name: str, expressions: list[str]) -> str:
    return ", ".join(f"{e} AS {name}_{n}" for n, e in enumerate(expressions))


SCALED = ", ".join(
    f"round((x_{n} - avg(x_{n}) OVER ()) / stddev_samp(x_{n}) OVER (), 6) AS features_{n}"
    for n in range(len(VECTOR))
)

SIGNATURES = """
, bad AS (
  SELECT resp_port, {proto} AS proto, count(*) AS malicious_count
  FROM cleaned WHERE label LIKE '%Malicious%' GROUP BY 1, 2
), good AS (
  SELECT resp_port, {proto} AS proto, count(*) AS benign_count
  FROM cleaned WHERE label NOT LIKE '%Malicious%' GROUP BY 1, 2
), signatures AS (
  SELECT resp_port, proto, malicious_count, coalesce(benign_count, 0) AS benign_count,
         malicious_count / (coalesce(benign_count, 0) + 1) AS risk_ratio
  FROM bad LEFT JOIN good USING (resp_port, proto)
)
"""
BY_PROTO = SIGNATURES.format(proto="proto")
BY_SPARSE_PROTO = SIGNATURES.format(proto="CASE WHEN uid % 3 <> 0 THEN proto END")

REPORT = """
, seen AS (
  SELECT label AS class FROM predictions UNION SELECT predicted_label FROM predictions
), per_class AS (
  SELECT class,
         (SELECT count(*) FROM predictions WHERE label = class) AS support,
         (SELECT count(*) FROM predictions WHERE predicted_label = class) AS total,
         (SELECT count(*) FROM predictions WHERE label = class AND predicted_label = class) AS tp
  FROM seen
), ratios AS (
  SELECT class, support, tp,
         CASE WHEN total = 0 THEN 0 ELSE tp / total END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall
  FROM per_class
), scores AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0
                 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM ratios
)
"""

PERCENTILE = "quantile_cont({c}, {q})"
STATISTICS = {
    "count": "CAST(count({c}) AS DOUBLE)",
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "min": "min({c})",
    "25%": PERCENTILE.format(c="{c}", q=0.25),
    "50%": PERCENTILE.format(c="{c}", q=0.5),
    "75%": PERCENTILE.format(c="{c}", q=0.75),
    "max": "max({c})",
}


def _summary(columns: list[str]) -> str:
    rows = []
    for name, formula in STATISTICS.items():
        cells = ", ".join(f"round({formula.format(c=c)}, 6) AS {c}" for c in columns)
        rows.append(f"SELECT '{name}' AS statistic, {cells} FROM batches")
    return " UNION ALL ".join(rows)


def _counts(*keys: str) -> str:
    names = ", ".join(keys)
    return f'{BASE} SELECT {names}, count(*) AS "count" FROM cleaned GROUP BY {names}'


def _dimension(name: str, value: str, label: str = "CAST(NULL AS VARCHAR)") -> str:
    return (
        f"SELECT '{name}' AS dimension, {value} AS value, {label} AS label, "
        f'count(*) AS "count" FROM cleaned GROUP BY ALL'
    )


MEASURED = ["duration", "total_bytes", "bytes_per_sec"]
SHARES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]

# Time since the source's flow before.
GAPS = """
, gaps AS (
  SELECT uid, orig_h, label, ts - lag(ts) OVER (PARTITION BY orig_h ORDER BY ts, uid) AS gap
  FROM flows
)
"""


def _quantiles(table: str, measures: list[str]) -> str:
    """Quantiles of each measure by label."""
    parts = [
        f"""SELECT '{m}' AS "column", label, CAST(f AS DOUBLE) AS fraction,
                   round(list_extract(q, i), 6) AS value
            FROM (SELECT label, quantile_cont(CAST({m} AS DOUBLE), {SHARES}) AS q
                  FROM {table} WHERE {m} IS NOT NULL GROUP BY label),
                 (SELECT unnest({SHARES}) AS f, unnest(range(1, {len(SHARES) + 1})) AS i)"""
        for m in measures
    ]
    return " UNION ALL ".join(parts)


def _port_ranges(gap: int, least: int, ratio: float) -> str:
    """Islands of ports that malicious flows hit."""
    return f"""{BASE}
        , ports AS (
          SELECT proto, resp_port,
                 count(*) FILTER (label LIKE '%Malicious%') AS bad,
                 count(*) FILTER (label NOT LIKE '%Malicious%') AS good
          FROM cleaned GROUP BY proto, resp_port
        ), risky AS (
          SELECT *, resp_port - lag(resp_port) OVER (PARTITION BY proto ORDER BY resp_port) AS step
          FROM ports WHERE bad >= {least} AND bad / (good + 1) >= {ratio}
        ), islands AS (
          SELECT *, count(*) FILTER (step IS NULL OR step > {gap})
                      OVER (PARTITION BY proto ORDER BY resp_port) AS island
          FROM risky)
        SELECT proto, min(resp_port) AS first_port, max(resp_port) AS last_port,
               count(*) AS ports, CAST(sum(bad) AS BIGINT) AS malicious_count,
               CAST(sum(good) AS BIGINT) AS benign_count,
               CAST(sum(bad) AS BIGINT) / (CAST(sum(good) AS BIGINT) + 1) AS risk_ratio
        FROM islands GROUP BY proto, island"""


ORACLES = {
    "src1_topic_read": f"{BASE} SELECT CAST(uid AS VARCHAR) AS uid, ts, duration, label FROM flows",
    "src2_topic_stream": f"{BASE} SELECT CAST(uid AS VARCHAR) AS uid, ts, duration, label FROM flows",
    "src3_limited_stream": f"{BASE} SELECT CAST(uid AS VARCHAR) AS uid, proto, label FROM flows",
    "src4_delimited_read": f"""{BASE}
        SELECT uid, ts, orig_h, orig_port, resp_port, duration, orig_bytes, resp_bytes,
               '-' AS service FROM cleaned""",
    "src5_newest_for_report": f"""{BASE}
        SELECT uid, strftime(processing_time, {CLOCK}) AS processing_time, predicted_label
        FROM (SELECT * FROM predictions ORDER BY processing_time DESC, uid LIMIT 20000)""",
    "src5_newest_by_processing_time": f"""{BASE}
        SELECT uid, strftime(processing_time, {CLOCK}) AS processing_time, predicted_label
        FROM (SELECT * FROM predictions ORDER BY processing_time DESC, uid LIMIT 100)""",
    "src5_newest_by_timestamp": f"""{BASE}
        SELECT uid, strftime("timestamp", {CLOCK}) AS "timestamp", predicted_label
        FROM (SELECT * FROM predictions ORDER BY "timestamp" DESC, uid LIMIT 100)""",
    "src5_newest_by_original_ts": f"""{BASE}
        SELECT uid, ts AS original_ts, predicted_label
        FROM (SELECT * FROM predictions ORDER BY ts DESC, uid LIMIT 100)""",
    "src5_newest_for_dashboard": f"""{BASE}
        SELECT uid, strftime("timestamp", {CLOCK}) AS "timestamp", predicted_label
        FROM (SELECT * FROM predictions ORDER BY "timestamp" DESC, uid LIMIT 8000)""",
    "par1_decode": f"{BASE} SELECT * FROM flows",
    "par1_pruned_report": f"""{BASE}
        SELECT proto, conn_state, hour_of_day, count(*) AS "count"
        FROM featured GROUP BY ALL""",
    "par2_quarantine": f"""{BASE}
        SELECT uid, CASE WHEN uid % 13 <> 0 THEN label END AS label, uid % 13 <> 0 AS decoded
        FROM flows""",
    "par3_encode": f"""{BASE}
        SELECT CAST(uid AS VARCHAR) AS uid, orig_h, detailed_label, label, true AS has_clock
        FROM flows""",
    "par4_text_time": f"""{BASE}
        SELECT uid, CASE WHEN uid % 17 <> 0 THEN strftime("timestamp", {CLOCK}) END
          AS processing_time FROM predictions""",
    "par4_epoch_time": f"{BASE} SELECT uid, CAST(trunc(ts * 1e6) AS BIGINT) AS micros FROM predictions",
    "par5_derived_label": f"""{BASE} {RANKS}
        SELECT uid, number AS prediction, coalesce(r.label, 'Unknown') AS predicted_label
        FROM (SELECT uid, CAST(CASE predicted_label WHEN 'Benign' THEN 0 WHEN 'Malicious' THEN 1
                ELSE 2 END AS DOUBLE) AS number FROM predictions) n
        LEFT JOIN label_rank r ON n.number = r.i""",
    "prj1_cast_measures": f"""{BASE}
        SELECT uid, TRY_CAST(duration AS DOUBLE) AS duration,
               TRY_CAST(orig_bytes AS BIGINT) AS orig_bytes,
               TRY_CAST(resp_bytes AS BIGINT) AS resp_bytes FROM flows""",
    "prj2_ports": f"{BASE} SELECT uid, orig_port, resp_port FROM cleaned",
    "prj3_fill_missing": f"{BASE} SELECT uid, duration, orig_bytes, resp_bytes FROM cleaned",
    "prj4_labelled": f"{BASE} SELECT uid, label FROM cleaned WHERE label IS NOT NULL",
    "prj5_rename": f"""{BASE}
        SELECT uid, orig_h, orig_h AS orig_ip, resp_h AS resp_ip FROM flows""",
    "prj6_malicious": f"""{BASE}
        SELECT uid, label, resp_port FROM cleaned WHERE label LIKE '%Malicious%'""",
    "prj6_not_malicious": f"""{BASE}
        SELECT uid, label, resp_port FROM cleaned WHERE label NOT LIKE '%Malicious%'""",
    "prj7_stored_columns": f"""{BASE}
        SELECT uid, strftime("timestamp", {CLOCK}) AS "timestamp", orig_h AS id_orig_h,
               orig_p AS id_orig_p, resp_h AS id_resp_h, resp_p AS id_resp_p, proto,
               CAST(0 AS DOUBLE) AS prediction, predicted_label, label, detailed_label,
               CAST(7 AS BIGINT) AS batch_id FROM predictions""",
    "prj8_evaluable": f"""{BASE}
        SELECT uid, label, predicted_label FROM predictions WHERE predicted_label <> 'Unknown'""",
    "fea1_timestamp": f"""{BASE}
        SELECT uid, strftime("timestamp", {CLOCK}) AS "timestamp" FROM featured""",
    "fea2_hour_of_day": f"{BASE} SELECT uid, hour_of_day FROM featured",
    "fea3_day_of_week": f"{BASE} SELECT uid, day_of_week FROM featured",
    "fea4_total_bytes": f"{BASE} SELECT uid, total_bytes FROM featured",
    "fea5_bytes_per_sec": f"{BASE} SELECT uid, bytes_per_sec FROM featured",
    "fea6_bytes_per_sec_small_epsilon": f"""{BASE}
        SELECT uid, total_bytes / (duration + CAST(1e-6 AS DOUBLE)) AS bytes_per_sec
        FROM featured""",
    "fea7_orig_bytes_ratio": f"""{BASE}
        SELECT uid, orig_bytes / (total_bytes + CAST(1e-6 AS DOUBLE)) AS orig_bytes_ratio
        FROM featured""",
    "agg0_row_count": f'{BASE} SELECT count(*) AS "count" FROM cleaned',
    "agg1_label_counts": _counts("label"),
    "agg2_detailed_label_counts": _counts("detailed_label"),
    "agg3_proto_counts": _counts("proto"),
    "agg4_proto_label_counts": _counts("proto", "label"),
    "agg5_conn_state_counts": _counts("conn_state"),
    "agg1_to_5_in_one_scan": BASE
    + " UNION ALL ".join(
        [
            _dimension("label", "cleaned.label"),
            _dimension("detailed_label", "detailed_label"),
            _dimension("proto", "proto"),
            _dimension("conn_state", "conn_state"),
            _dimension("proto_label", "proto", "cleaned.label"),
        ]
    ),
    "agg6_label_statistics": f"""{BASE}
        SELECT label, round(avg(duration), 6) AS avg_duration,
               round(stddev_samp(duration), 6) AS std_duration,
               round(avg(orig_bytes), 6) AS avg_orig_bytes,
               round(avg(resp_bytes), 6) AS avg_resp_bytes
        FROM cleaned GROUP BY label""",
    "agg7_top_malicious_ports": f"""{BASE}
        SELECT resp_port, proto, count(*) AS "count" FROM cleaned
        WHERE label LIKE '%Malicious%' GROUP BY resp_port, proto
        ORDER BY "count" DESC, resp_port NULLS FIRST, proto NULLS FIRST LIMIT 10""",
    "agg8_recall": f"""{BASE}
        SELECT label, CAST(sum(CASE WHEN predicted_label = label THEN 1 ELSE 0 END) AS BIGINT)
                 AS tp,
               count(*) AS support,
               sum(CASE WHEN predicted_label = label THEN 1 ELSE 0 END) / count(*) AS recall
        FROM predictions GROUP BY label""",
    "agg9_precision": f"""{BASE}
        SELECT predicted_label,
               CAST(sum(CASE WHEN predicted_label = label THEN 1 ELSE 0 END) AS BIGINT) AS tp,
               count(*) AS predicted_total,
               sum(CASE WHEN predicted_label = label THEN 1 ELSE 0 END) / count(*) AS precision
        FROM predictions GROUP BY predicted_label""",
    "agg10_confusion_counts": f"""{BASE}
        SELECT label, predicted_label, count(*) AS "count"
        FROM predictions GROUP BY label, predicted_label""",
    "agg11_confusion_matrix": f"""{BASE}
        SELECT c.label,
               count(*) FILTER (p.predicted_label = 'Benign') AS "Pred_Benign",
               count(*) FILTER (p.predicted_label = 'Malicious') AS "Pred_Malicious"
        FROM (VALUES ('Benign'), ('Malicious')) c(label)
        LEFT JOIN predictions p ON p.label = c.label GROUP BY c.label""",
    "agg12_classification_report": f"""{BASE} {REPORT}
        SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
               round(f1, 6) AS f1, support FROM scores
        UNION ALL
        SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
               round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
        UNION ALL
        SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6),
               round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM scores
        UNION ALL
        SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
               round(sum(recall * support) / sum(support), 6),
               round(sum(f1 * support) / sum(support), 6),
               CAST(sum(support) AS BIGINT) FROM scores""",
    "agg13_prediction_total": f"""{BASE}
        SELECT label, count(*) AS flows, true AS counts_agree
        FROM flows WHERE label IS NOT NULL GROUP BY label""",
    "agg14_predicted_label_counts": f"""{BASE}
        SELECT predicted_label, count(*) AS "count" FROM predictions
        WHERE predicted_label <> 'Unknown' GROUP BY predicted_label""",
    "agg15_label_index_pairs": f"""{BASE} {RANKS}
        SELECT label, CAST(i AS DOUBLE) AS label_index FROM label_rank""",
    "agg16_metric_summary": f"""{BASE}
        , batches AS (
          SELECT count(*) AS input_rows, CAST(sum(duration) AS BIGINT) AS proc_time,
                 count(*) / 3600 AS rows_per_second
          FROM featured GROUP BY floor(epoch("timestamp") / 3600))
        {_summary(["input_rows", "proc_time", "rows_per_second"])}""",
    "joi1_signatures_by_join": f"{BASE} {BY_PROTO} SELECT * FROM signatures",
    "joi2_null_keys": f"{BASE} {BY_SPARSE_PROTO} SELECT * FROM signatures",
    "sig1_port_signatures": f"{BASE} {BY_PROTO} SELECT * FROM signatures",
    "sig2_rules": f"""{BASE} {BY_PROTO}
        SELECT printf('IF dest_port == %d AND proto == ''%s'' THEN POTENTIAL MALWARE '
                      '(Risk Ratio: %.2f)', resp_port, proto, risk_ratio) AS rule,
               risk_ratio, resp_port, proto
        FROM signatures ORDER BY risk_ratio DESC, resp_port, proto LIMIT 5""",
    "sig3_flagged_flows": f"""{BASE} {BY_PROTO}
        SELECT f.uid, f.resp_port, f.proto, s.risk_ratio, s.risk_ratio IS NOT NULL AS flagged
        FROM cleaned f LEFT JOIN signatures s
          ON f.resp_port = s.resp_port AND f.proto = s.proto AND s.risk_ratio >= 3""",
    "tim1_per_minute": f"""{BASE}
        , minutes AS (
          SELECT date_trunc('minute', processing_time) AS m, count(*) AS n
          FROM predictions GROUP BY 1
        ), spine AS (
          SELECT unnest(generate_series((SELECT min(m) FROM minutes),
                                        (SELECT max(m) FROM minutes), INTERVAL 1 MINUTE)) AS m)
        SELECT strftime(spine.m, {CLOCK}) AS processing_time, coalesce(n, 0) AS "count"
        FROM spine LEFT JOIN minutes ON spine.m = minutes.m""",
    "tim2_stream_per_minute": f"""{BASE}
        SELECT strftime(m, {CLOCK}) AS start, predicted_label, count(*) AS "count"
        FROM (SELECT date_trunc('minute', "timestamp") AS m, predicted_label FROM predictions)
        GROUP BY m, predicted_label""",
    "alr1_alert": f"""{BASE}
        SELECT total, malicious, malicious / total AS rate,
               total >= 10 AND malicious / total > 0.2 AS alert
        FROM (SELECT count(*) AS total,
                     count(*) FILTER (predicted_label = 'Malicious') AS malicious
              FROM predictions
              WHERE processing_time >= (SELECT max(processing_time) - INTERVAL 1 DAY
                                        FROM predictions))""",
    "alr2_alert_rows": f"""{BASE}
        SELECT uid, strftime(processing_time, {CLOCK}) AS processing_time, predicted_label
        FROM (SELECT * FROM predictions
              WHERE predicted_label = 'Malicious'
                AND processing_time >= (SELECT max(processing_time) - INTERVAL 1 DAY
                                        FROM predictions)
              ORDER BY processing_time, uid LIMIT 20)""",
    "alr3_stream_alerts": f"""{BASE}
        , shifted AS (
          SELECT floor(epoch("timestamp") / 21600) * 21600 - 21600 * n AS start_second,
                 predicted_label
          FROM predictions, unnest([0, 1, 2, 3]) AS shifts(n)
        ), windows AS (
          SELECT to_timestamp(start_second) AT TIME ZONE 'UTC' AS start, count(*) AS total,
                 count(*) FILTER (predicted_label = 'Malicious') AS malicious
          FROM shifted GROUP BY start_second)
        SELECT strftime(start, {CLOCK}) AS start,
               strftime(start + INTERVAL 1 DAY, {CLOCK}) AS "end", total, malicious,
               malicious / total AS rate
        FROM windows
        WHERE total >= 10 AND malicious / total > 0.35""",
    "mlf1_category_index": f"""{BASE} {RANKS}
        SELECT f.uid, CAST(coalesce(p.i, (SELECT count(*) FROM proto_rank)) AS DOUBLE)
                 AS proto_index,
               CAST(coalesce(s.i, (SELECT count(*) FROM state_rank)) AS DOUBLE)
                 AS conn_state_index
        FROM featured f LEFT JOIN proto_rank p ON f.proto = p.proto
        LEFT JOIN state_rank s ON f.conn_state = s.conn_state AND f.uid % 9 <> 0""",
    "mlf2_label_index": f"""{BASE} {RANKS}
        SELECT f.uid, CAST(r.i AS DOUBLE) AS label_index
        FROM featured f JOIN label_rank r ON f.label = r.label""",
    "mlf3_one_hot": f"""{BASE} {RANKS}
        SELECT f.uid, {_vector("proto_vec", VECTOR[9:12])},
               {_vector("conn_state_vec", VECTOR[12:15])} FROM {RANKED_FLOWS}""",
    "mlf4_assembled": f"""{BASE} {RANKS}
        SELECT f.uid, {_vector("features_raw", VECTOR)} FROM {RANKED_FLOWS}""",
    "mlf5_scaled": f"""{BASE} {RANKS}
        SELECT uid, {SCALED}
        FROM (SELECT f.uid, {_vector("x", VECTOR)} FROM {RANKED_FLOWS})""",
    "mlf6_stages_equal_steps": f"{BASE} SELECT uid, true AS same FROM predictions",
    "mlm1_split": f"""{BASE}
        SELECT uid, CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS part, bucket
        FROM (SELECT uid, CAST(('0x' || substr(md5(CAST(uid AS VARCHAR)), 1, 8)) AS BIGINT)
                % 100 AS bucket FROM predictions)""",
    "mlm4_accuracy_and_f1": f"""{BASE} {REPORT}
        SELECT round(sum(tp) / sum(support), 6) AS accuracy,
               round(sum(f1 * support) / sum(support), 6) AS f1 FROM scores""",
    "mlm7_class_weights": f"""{BASE}
        SELECT label, round((SELECT count(*) FROM predictions)
                 / ((SELECT count(DISTINCT label) FROM predictions) * count(*)), 6) AS weight
        FROM predictions GROUP BY label""",
    "str2_str6_batch_progress": f"""{BASE}
        SELECT count(*) AS rows, CAST(3 AS BIGINT) AS batches FROM flows""",
    "str3_repartitioned_stream": f"""{BASE}
        SELECT CAST(uid AS VARCHAR) AS uid, conn_state FROM flows""",
    "str5_batch_written_twice": f"""{BASE}
        SELECT uid, CAST(uid % 2 AS BIGINT) AS batch_id, predicted_label FROM predictions""",
    "snk2_memory_table": f"""{BASE}
        SELECT label, CASE WHEN uid % 11 = 0 THEN 'incomplete' END AS reason,
               count(*) AS rows, true AS class_recalled
        FROM flows GROUP BY 1, 2""",
    "snk3_snapshot": f"""{BASE}
        SELECT uid, '0.25 0.75' AS probability, predicted_label
        FROM predictions""",
    "snk4_offline_scoring": f"""{BASE}
        SELECT CASE WHEN uid % 11 <> 0 THEN label END AS label, count(*) AS flows,
               true AS counts_agree
        FROM flows WHERE label IS NOT NULL GROUP BY 1""",
    "sig4_refreshed_rules": f"""{BASE} {BY_PROTO}
        SELECT uid, resp_port, proto, CASE WHEN hit THEN risk_ratio END AS risk_ratio,
               hit AS flagged, CAST(uid % 2 + 1 AS BIGINT) AS rule_version
        FROM (SELECT c.uid, c.resp_port, c.proto, s.risk_ratio,
                     coalesce((s.risk_ratio >= 3.0) = (c.uid % 2 = 0), false) AS hit
              FROM cleaned c LEFT JOIN signatures s USING (resp_port, proto))""",
    "rng1_port_ranges": _port_ranges(1, 1, 0.0),
    "rng2_risky_port_ranges": _port_ranges(2, 2, 0.5),
    "dis1_size_and_time_by_label": f"{BASE} {_quantiles('featured', MEASURED)}",
    "dis2_gaps_by_label": f"{BASE} {GAPS} {_quantiles('gaps', ['gap'])}",
    "dis3_gap_of_each_flow": f"""{BASE} {GAPS}
        SELECT uid, orig_h, round(gap, 6) AS gap FROM gaps""",
    "dis4_stream_sketches": f"""{BASE}
        SELECT m AS "column", label, count(*) AS n, CAST(f AS DOUBLE) AS fraction,
               true AS not_above, true AS not_below
        FROM predictions, unnest({MEASURED}) AS a(m), unnest({SHARES}) AS b(f) GROUP BY ALL""",
    "ded1_replayed_topic": f"""{BASE}
        , sent AS (SELECT * FROM featured UNION ALL SELECT * FROM featured)
        SELECT DISTINCT ON (uid) uid, conn_state, label, total_bytes FROM sent""",
    "ded2_newest_of_each_record": f"""{BASE}
        , sent AS (
          SELECT uid, ts, conn_state, label FROM flows
          UNION ALL SELECT uid, ts + 60, 'RSTO', label FROM flows WHERE uid % 3 = 0
          UNION ALL SELECT uid, ts, conn_state, label FROM flows WHERE uid % 5 = 0)
        SELECT DISTINCT ON (uid) uid, round(ts, 6) AS ts, conn_state, label
        FROM sent ORDER BY uid, ts DESC""",
    "alr4_alert_after_each_batch": f"""{BASE}
        , arrived AS (
          SELECT *, CAST(list_position([2, 0, 3, 1], uid % 4) - 1 AS BIGINT) AS arrival
          FROM predictions
        ), seen AS (
          SELECT b AS batch_id, a."timestamp" AS moment, a.predicted_label AS label
          FROM unnest([0, 1, 2, 3]) AS t(b) JOIN arrived a ON a.arrival <= b
        ), kept AS (
          SELECT *, max(moment) OVER (PARTITION BY batch_id) AS newest FROM seen
        ), counted AS (
          SELECT batch_id, newest, count(*) AS total,
                 count(*) FILTER (label = 'Malicious') AS malicious
          FROM kept WHERE moment >= newest - INTERVAL 1 DAY GROUP BY batch_id, newest)
        SELECT CAST(batch_id AS BIGINT) AS batch_id, strftime(newest, {CLOCK}) AS newest, total,
               malicious, malicious / total AS rate,
               total >= 10 AND malicious / total > 0.35 AS alert
        FROM counted""",
    "tim3_archived_counts": f"""{BASE}
        SELECT strftime(h, {CLOCK}) AS start, predicted_label, count(*) AS "count"
        FROM (SELECT date_trunc('hour', "timestamp") AS h, predicted_label FROM predictions)
        GROUP BY h, predicted_label""",
    "snk1_archive_and_batches": f"""{BASE}
        SELECT uid, CAST(uid % 3 AS BIGINT) AS batch_id, predicted_label FROM predictions""",
    "str4_empty_batch": f"{BASE} SELECT uid, label FROM flows",
    "snk5_cached_exploration": f"""{BASE}
        SELECT 'proto' AS dimension, proto AS value, count(*) AS "count"
        FROM cleaned GROUP BY proto
        UNION ALL
        SELECT 'conn_state', conn_state, count(*) FROM cleaned GROUP BY conn_state""",
    "explored_without_cache": _counts("proto", "label"),
}

# What every scored flow must satisfy, with the model's rows named independently of it.
CHECKED = (
    "true AS label_known, true AS label_matches_index, true AS probability_complete, "
    "true AS class_recalled"
)
BUCKET = "CAST(('0x' || substr(md5(CAST(uid AS VARCHAR)), 1, 8)) AS BIGINT) % 100"
TEST_PART = f"""predictions
        WHERE {BUCKET} >= 80"""

# Scaling by the moments of the training part, applied to all flows.
MOMENTS = ", ".join(
    f"avg(x_{n}) FILTER (train) OVER () AS m_{n}, stddev_samp(x_{n}) FILTER (train) OVER () AS d_{n}"
    for n in range(len(VECTOR))
)
SCALED_BY_TRAINING = ", ".join(
    f"round((x_{n} - m_{n}) / d_{n}, 6) AS features_{n}" for n in range(len(VECTOR))
)
TRAIN_RANKS = """
, learned AS (SELECT * FROM featured WHERE label IS NOT NULL AND {bucket} < 80)
, proto_rank AS (
  SELECT proto, row_number() OVER (ORDER BY count(*) DESC, proto) - 1 AS i
  FROM learned GROUP BY proto
), state_rank AS (
  SELECT conn_state, row_number() OVER (ORDER BY count(*) DESC, conn_state) - 1 AS i
  FROM learned GROUP BY conn_state
), label_rank AS (
  SELECT label, row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS i
  FROM learned GROUP BY label
)
""".format(bucket=BUCKET)

ORACLES |= {
    "mlm2_random_forest": f"{BASE} SELECT uid, {CHECKED} FROM {TEST_PART}",
    "mlm3_boosted_trees": f"{BASE} SELECT uid, {CHECKED} FROM {TEST_PART}",
    "mlm6_saved_model": f"{BASE} SELECT uid, true AS same FROM {TEST_PART}",
    "sco1_features_on_stream": f"""{BASE} {TRAIN_RANKS}
        , slots AS (
          SELECT f.uid, f.label IS NOT NULL AND {BUCKET} < 80 AS train, {_vector("x", VECTOR)}
          FROM featured f JOIN proto_rank p ON f.proto = p.proto
          JOIN state_rank s ON f.conn_state = s.conn_state
        ), moments AS (SELECT *, {MOMENTS} FROM slots)
        SELECT uid, {SCALED_BY_TRAINING} FROM moments""",
    "sco2_scored_flows": f"""{BASE}
        SELECT uid, CASE WHEN uid % 11 <> 0 THEN true END AS label_known,
               CASE WHEN uid % 11 <> 0 THEN true END AS label_matches_index,
               CASE WHEN uid % 11 <> 0 THEN true END AS probability_complete,
               true AS class_recalled, CASE WHEN uid % 11 = 0 THEN 'incomplete' END AS reason
        FROM flows""",
    "sco3_decoded_labels": f"""{BASE} {TRAIN_RANKS}
        SELECT CAST(i AS DOUBLE) AS prediction, label FROM label_rank""",
    "mlm5_evaluators": f"""{BASE}
        , scored AS (
          SELECT CASE label WHEN 'Malicious' THEN 1 ELSE 0 END AS y,
                 CASE predicted_label WHEN 'Malicious' THEN 1 ELSE 0 END AS p,
                 total_bytes % 997 AS s
          FROM predictions WHERE predicted_label <> 'Unknown'
        ), ranked AS (
          SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r
          FROM scored
        ), area AS (
          SELECT (sum(r) FILTER (y = 1) - n1 * (n1 + 1) / 2) / (n1 * n0) AS auc
          FROM ranked, (SELECT CAST(sum(y) AS DOUBLE) AS n1,
                               CAST(count(*) - sum(y) AS DOUBLE) AS n0 FROM scored)
          GROUP BY n1, n0
        ), per_class AS (
          SELECT c, count(*) FILTER (y = c) AS support, count(*) FILTER (p = c) AS said,
                 count(*) FILTER (y = c AND p = c) AS hit
          FROM scored, (VALUES (0), (1)) AS classes(c) GROUP BY c
        )
        SELECT 'accuracy' AS metric, round(sum(hit) / sum(support), 6) AS value FROM per_class
        UNION ALL
        SELECT 'auc', round(auc, 6) FROM area
        UNION ALL
        SELECT 'f1', round(sum(support * CASE WHEN hit = 0 THEN 0 ELSE 2 * hit / (support + said) END)
                           / sum(support), 6) FROM per_class""",
    "mlm8_importances": f"""{BASE}
        SELECT unnest(list_concat(
                 [{", ".join(f"'{c}'" for c in NUMERIC)}],
                 (SELECT list('proto=' || proto) FROM (SELECT DISTINCT proto FROM featured)),
                 (SELECT list('conn_state=' || conn_state)
                  FROM (SELECT DISTINCT conn_state FROM featured)))) AS feature,
               true AS none_negative, true AS sum_is_one, true AS top_explains""",
    "str1_stream_scoring": f"""{BASE}
        SELECT uid, {CHECKED}, label, detailed_label, orig_h AS id_orig_h FROM flows""",
}
