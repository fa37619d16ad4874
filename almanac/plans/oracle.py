"""The same results as ANSI SQL over the given tables, for DuckDB."""

from __future__ import annotations

_DAILY = "(SELECT user_id AS station, CAST(ts AS DATE) AS date, max(value) AS tmax FROM events GROUP BY 1, 2)"

_LAGGED = f"""(
    SELECT t.station, t.date, t.tmax, y.tmax AS yesterday_tmax
    FROM {_DAILY} t JOIN {_DAILY} y ON t.date - 1 = y.date AND t.station = y.station)"""

_RUNS = """(
    SELECT user_id, event_id, ts,
           CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'success' END AS state
    FROM events)"""

_LONG = """(
    SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS pos,
           CAST(unnest(embedding) AS DOUBLE) AS x
    FROM embeddings)"""


_THIN = f"(SELECT vec_id, label, pos, CASE WHEN abs(x) < 0.05 THEN 0.0::DOUBLE ELSE x END AS x FROM {_LONG} JOIN embeddings USING (vec_id))"


def _hex(digest: str, digits: int) -> str:
    return f"CAST(('0x' || substr({digest}, 1, {digits})) AS BIGINT)"


def _slots(every: str) -> str:
    return f"time_bucket(INTERVAL '{every}', ts, TIMESTAMP '1970-01-01')"


_POSITIONS = """(
    SELECT vec_id, label, row_number() OVER (ORDER BY md5('0:' || CAST(vec_id AS VARCHAR))) - 1 AS pos,
           count(*) OVER () AS n
    FROM embeddings)"""

_OBSERVATIONS = f"""
    SELECT CAST(station AS VARCHAR) AS station, date, CAST(c_nationkey AS FLOAT) AS latitude,
           CAST(length(c_mktsegment) AS FLOAT) AS longitude, CAST(c_acctbal AS FLOAT) AS elevation,
           CAST(tmax AS FLOAT) AS tmax
    FROM {_DAILY} d JOIN customer c ON d.station = c.c_custkey"""

def _forest(observed: str, features: tuple[str, ...]) -> str:
    """Tables ``routed`` (leaf of each row and tree), ``nodes`` and ``forecast`` of a histogram forest, level by level.

    3 trees of depth 4, 32 bins, a third of the features (rounded up) at each node, seed 15, labels in 2^-20.
    """
    bounds = (1580030169, 3160060337, 3950075422, 4213413783, 4279248374, 4292415292, 4294609778, 4294923276)
    looked_at = -(-len(features) // 3)
    long_form = " UNION ALL ".join(
        f"SELECT id, {f} AS feature, CAST({name} AS DOUBLE) AS x, in_train FROM obs" for f, name in enumerate(features)
    )
    levels = ""
    for d in range(4):
        levels += f""", hist{d} AS (
            SELECT r.tree, r.node, c.feature, b.bin, sum(w) AS n, sum(w * y) AS total
            FROM at{d} r JOIN choice c ON c.tree = r.tree AND c.node = r.node JOIN binned b ON b.id = r.id AND b.feature = c.feature
            WHERE r.w > 0 AND r.node >= {1 << d} GROUP BY ALL
        ), upto{d} AS (
            SELECT *, sum(n) OVER upto AS ln, sum(total) OVER upto AS ls, sum(n) OVER whole AS an, sum(total) OVER whole AS asum
            FROM hist{d} WINDOW upto AS (PARTITION BY tree, node, feature ORDER BY bin), whole AS (PARTITION BY tree, node, feature)
        ), scored{d} AS (
            SELECT tree, node, feature, bin, ls::DOUBLE * ls::DOUBLE / ln + (asum - ls)::DOUBLE * (asum - ls)::DOUBLE / (an - ln) AS score,
                asum::DOUBLE * asum::DOUBLE / an AS unsplit
            FROM upto{d} WHERE ln < an
        ), split{d} AS (
            SELECT tree, node, feature, bin FROM scored{d} WHERE score > unsplit
            QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, feature, bin) = 1
        ), at{d + 1} AS (
            SELECT r.tree, r.id, r.w, r.y, CASE WHEN s.node IS NULL THEN r.node ELSE 2 * r.node + (b.bin > s.bin)::INT END AS node
            FROM at{d} r LEFT JOIN split{d} s ON s.tree = r.tree AND s.node = r.node LEFT JOIN binned b ON b.id = r.id AND b.feature = s.feature
        )"""
    all_nodes = " UNION ALL ".join(
        f"SELECT tree, node, sum(w) AS n, sum(w * y) AS total FROM at{d} WHERE w > 0 AND node >= {1 << d} GROUP BY ALL" for d in range(5)
    )
    all_splits = " UNION ALL ".join(f"SELECT * FROM split{d}" for d in range(4))
    draw = _hex("md5('15:' || tree || ':' || station || ':' || CAST(date AS VARCHAR))", 8)
    return f"""WITH obs AS (
        SELECT *, row_number() OVER () AS id, CAST(dayofyear(date) AS INT) AS day_of_year,
            {_hex("md5('15:' || station || ':' || CAST(date AS VARCHAR))", 8)} < 3221225472 AS in_train
        FROM ({observed})
    ), long_form AS (
        {long_form}
    ), placed AS (
        SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) AS i, count(*) OVER (PARTITION BY feature) AS n,
            max(x) OVER (PARTITION BY feature) AS most
        FROM long_form WHERE in_train AND x IS NOT NULL
    ), cut AS (
        SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS place
        FROM (SELECT DISTINCT feature, x FROM placed JOIN range(1, 32) AS parts(j) ON i = (j * n + 31) // 32 WHERE x < most)
    ), binned AS (
        SELECT id, l.feature, count(c.x) AS bin FROM long_form l LEFT JOIN cut c ON c.feature = l.feature AND c.x < l.x GROUP BY ALL
    ), choice AS (
        SELECT tree, node, feature FROM range(3) AS t(tree), range(1, 16) AS n(node), range({len(features)}) AS f(feature)
        QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY md5('15:' || tree || ':' || node || ':' || feature)) <= {looked_at}
    ), at0 AS (
        SELECT tree, id, y, 1 AS node, CASE WHEN in_train THEN {" + ".join(f"(draw >= {b})::INT" for b in bounds)} ELSE 0 END AS w
        FROM (SELECT tree, id, in_train, CAST(round(CAST(tmax AS DOUBLE) * 1048576) AS BIGINT) AS y, {draw} AS draw FROM obs, range(3) AS t(tree))
    ){levels}, nodes AS (
        SELECT tree, node, n, total::DOUBLE / n / 1048576 AS mean FROM ({all_nodes})
    ), splits AS (
        SELECT a.tree, a.node, a.feature, c.x AS threshold FROM ({all_splits}) a JOIN cut c ON c.feature = a.feature AND c.place = a.bin
    ), forecast AS (
        SELECT station, date, tmax, (list_sum([m0, m1]) + m2) / 3 AS prediction
        FROM (
            SELECT id, max(mean) FILTER (r.tree = 0) AS m0, max(mean) FILTER (r.tree = 1) AS m1, max(mean) FILTER (r.tree = 2) AS m2
            FROM at4 r JOIN nodes n ON n.tree = r.tree AND n.node = r.node GROUP BY id
        ) JOIN obs USING (id) WHERE NOT in_train
    )"""


_SEASON = ("latitude", "longitude", "elevation", "day_of_year")
_LAG = (*_SEASON[:3], "yesterday_tmax")
_LAGGED_OBSERVATIONS = f"""
    SELECT t.*, y.tmax AS yesterday_tmax FROM ({_OBSERVATIONS}) t JOIN ({_OBSERVATIONS}) y ON t.date - 1 = y.date AND t.station = y.station"""

ORACLE: dict[str, str] = {
    "daily_max": f"SELECT * FROM {_DAILY}",
    "day_of_year_features": f"""
        SELECT station, tmax, CAST(dayofyear(date) AS INT) AS day_of_year FROM {_DAILY}""",
    "yesterday_join": f"SELECT * FROM {_LAGGED}",
    "regression_metrics": f"""
        SELECT round(sqrt(avg(power(tmax - yesterday_tmax, 2))), 6) AS rmse,
               round(avg(abs(tmax - yesterday_tmax)), 6) AS mae,
               round(1 - sum(power(tmax - yesterday_tmax, 2)) / (count(*) * var_pop(tmax)), 6) AS r2
        FROM {_LAGGED}""",
    "align_features_labels": """
        SELECT d.doc_id, n_chars, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "concat_tables": """
        SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
        UNION ALL
        SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""",
    "parse_dates": """
        SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS d FROM orders""",
    "sql_over_this": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1",
    "head_rows": "SELECT event_id, ts FROM events ORDER BY event_id LIMIT 5",
    "array_to_columns": "SELECT vec_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS p{i}" for i in range(64))
    + " FROM embeddings",
    "columns_to_array": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings",
    "assemble_features": """
        SELECT c_custkey, [CAST(c_nationkey AS DOUBLE), c_acctbal] AS features FROM customer""",
    "row_index": """
        SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS idx FROM orders""",
    "permute_rows": f"SELECT vec_id, CAST(pos AS BIGINT) AS pos FROM {_POSITIONS}",
    "weighted_split": f"""
        SELECT o_orderkey,
               CASE WHEN {_hex("md5('7:' || CAST(o_orderkey AS VARCHAR))", 8)} < 3221225472
                    THEN 'train' ELSE 'validation' END AS part
        FROM orders""",
    "exact_split": f"""
        SELECT vec_id, label, CASE WHEN pos < floor(n * 0.25) THEN 'train' ELSE 'test' END AS part
        FROM {_POSITIONS} WHERE pos < floor(n * 0.25) + ceil(n * 0.5)""",
    "route_by_minute": """
        SELECT event_id,
               CASE WHEN minute(ts) % 2 = 0 THEN 'dummy_task_1' ELSE 'dummy_task_2' END AS branch
        FROM events""",
    "random_branch": f"""
        SELECT event_id,
               (['branch_a', 'branch_b', 'branch_c', 'branch_d'])[{_hex("md5('42:' || CAST(event_id AS VARCHAR))", 8)} % 4 + 1] AS branch
        FROM events""",
    "gate_if": """
        SELECT o.*, g.g
        FROM orders o CROSS JOIN (
            SELECT 'open' AS g, count(*) > 0 AS ok FROM events
            UNION ALL SELECT 'closed', count(*) < 0 FROM events
            UNION ALL SELECT 'nonempty', count(*) > 0 FROM events) g
        WHERE g.ok""",
    "build_payload": """
        SELECT event_id, CAST(json_object('message', event_type) AS VARCHAR) AS conf
        FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) > 50""",
    "trigger_rules": f"""
        SELECT user_id, CAST(ts AS DATE) AS day, bool_and(state = 'success') AS all_success,
               bool_or(state = 'success') AS one_success,
               bool_and(state IN ('success', 'failed', 'skipped')) AS all_done, count(*) AS n
        FROM {_RUNS} GROUP BY 1, 2""",
    "depends_on_past": f"""
        SELECT user_id, event_id,
               coalesce(bool_and(state <> 'failed') OVER (
                   PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS eligible
        FROM {_RUNS}""",
    "latest_only": f"""
        SELECT event_id, ts FROM events
        WHERE {_slots('4 hours')} = (SELECT max({_slots('4 hours')}) FROM events)""",
    "schedule_grid": f"""
        SELECT s AS slot, count(event_id) AS n
        FROM (SELECT unnest(generate_series(min({_slots('4 hours')}), max({_slots('4 hours')}),
                                            INTERVAL 4 HOURS)) AS s FROM events) g
        LEFT JOIN events ON ts >= s AND ts < s + INTERVAL 4 HOURS
        GROUP BY s""",
    "schedule_last_slot": f"""
        SELECT {_slots('10 minutes')} AS slot, count(event_id) AS n FROM events
        WHERE {_slots('10 minutes')} = (SELECT max({_slots('10 minutes')}) FROM events) GROUP BY 1""",
    "latest_per_key": """
        SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,
               arg_max([value], (ts, event_id)) AS latest_values
        FROM events GROUP BY user_id""",
    "date_macros": """
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS ds, CAST(CAST(ts AS DATE) + 7 AS VARCHAR) AS ds_add_7,
               CAST(r.range AS INT) AS i
        FROM events CROSS JOIN range(5) r""",
    "json_field_default": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
               coalesce(json_extract_string(props, '$.message'), '') AS message
        FROM events""",
    "json_check": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) = 5 AS ok FROM events""",
    "text_check": "SELECT page_id, contains(html, 'track(') AS ok FROM pages",
    "url_params": """
        SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
               nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
               nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
               nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source
        FROM pages""",
    "render_message": """
        SELECT event_id, format('Remotely received value of {} for key=message', event_type) AS message FROM events""",
    "surrogate_keys": f"""
        SELECT event_id,
               CAST({_hex('md5(CAST(event_id AS VARCHAR))', 8)} % 123456789 AS INT) AS custom_id,
               substr(md5(CAST(event_id AS VARCHAR)), 1, 10) AS user_token
        FROM events""",
    "feature_stats": f"""
        SELECT pos, round(avg(x), 6) AS m, round(stddev_pop(x), 6) AS sd FROM {_LONG} GROUP BY pos""",
    "standardize": f"""
        SELECT vec_id, pos, round((x - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS z
        FROM {_LONG} e JOIN (SELECT pos, avg(x) AS m, stddev_pop(x) AS sd FROM {_LONG} GROUP BY pos) s
        USING (pos)""",
    "cached_shares": """
        SELECT event_type, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share
        FROM events GROUP BY event_type""",
    "zero_share": f"""
        SELECT pos, round(avg(CASE WHEN abs(x) < 0.05 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS zero_pct
        FROM {_LONG} GROUP BY pos""",
    "sparse_feature_stats": f"""
        SELECT pos, round(avg(x), 6) AS m, round(stddev_pop(x), 6) AS sd FROM {_THIN} GROUP BY pos""",
    "sparse_zero_share": f"""
        SELECT pos, round(avg(CASE WHEN x = 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS zero_pct FROM {_THIN} GROUP BY pos""",
    "sparse_products": f"""
        SELECT vec_id AS id, round(sum((x - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END / (pos + 1)), 6) AS product
        FROM {_THIN} JOIN (SELECT pos, avg(x) AS m, stddev_pop(x) AS sd FROM {_THIN} GROUP BY pos) USING (pos)
        GROUP BY vec_id""",
    "sparse_csv": f"SELECT vec_id AS id, label, pos, x FROM {_THIN} WHERE x <> 0",
    "streamed_slots": f"""
        WITH arrived AS (
            SELECT {_slots('4 hours')} AS slot, event_type IS NULL OR event_type = 'error' AS second FROM events WHERE ts IS NOT NULL
        ), judged AS (
            SELECT slot, second AND slot + INTERVAL 4 HOURS
                   <= (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 10 DAY AS late
            FROM arrived
        )
        SELECT slot, count(*) FILTER (NOT coalesce(late, false)) AS n, count(*) FILTER (late) AS late
        FROM judged GROUP BY slot""",
    "accuracy": """
        SELECT round(avg(CASE WHEN doc_id % 2 = quality THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS acc,
               count(*) AS n
        FROM labels""",
    "compare_predictors": """
        SELECT model, round(avg(CASE WHEN pred = quality THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS acc,
               count(*) AS n
        FROM (SELECT 'parity' AS model, doc_id % 2 AS pred, quality FROM labels
              UNION ALL SELECT 'one', 1, quality FROM labels)
        GROUP BY model""",
    "station_csv": _OBSERVATIONS,
    "typed_csv": _OBSERVATIONS,
    "indexed_csv": """
        SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS idx, o_orderkey, o_totalprice
        FROM orders""",
    "matrix_csv": """
        SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings""",
    "not_null_violations": "\n        UNION ALL ".join(
        f"SELECT 'orders' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS violations FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    )
    + """
        UNION ALL SELECT 'messages', 'event_id', count(*) - count(event_id) FROM events
        UNION ALL SELECT 'messages', 'message', count(*) - count(json_extract_string(props, '$.message'))
        FROM events""",
    "append_rows": f"""
        SELECT CAST({_hex('md5(CAST(event_id AS VARCHAR))', 8)} % 123456789 AS INT) AS custom_id,
               ts AS timestamp, substr(md5(CAST(event_id AS VARCHAR)), 1, 10) AS user_id
        FROM events""",
    "directory_listener": "SELECT event_id, user_id, event_type, value, true AS named FROM events",
    "lagged_features": f"""
        SELECT t.station, t.date, t.latitude, t.longitude, t.elevation, CAST(dayofyear(t.date) AS INT) AS day_of_year,
               t.tmax, y.tmax AS yesterday_tmax
        FROM ({_OBSERVATIONS}) t JOIN ({_OBSERVATIONS}) y ON t.station = y.station AND t.date - 1 = y.date""",
    "latest_map": """
        SELECT user_id, arg_max(event_type, (ts, event_id)) AS name, arg_max(CAST(value AS VARCHAR), (ts, event_id)) AS value
        FROM events GROUP BY user_id""",
    "form_fields": """
        SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
               nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref
        FROM pages""",
    "flatten_vectors": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings",
    "date_rejects": """
        SELECT page_id AS key, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), 'none') AS d, false AS is_date
        FROM pages
        UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), true FROM orders""",
    "model_scaler": f"""
        SELECT pos, round(avg(x), 6) AS m, round(stddev_pop(x), 6) AS sd
        FROM {_LONG} e JOIN (SELECT vec_id FROM {_POSITIONS} WHERE pos < floor(n * 0.75)) USING (vec_id) GROUP BY pos""",
    "forest_forecast": _forest(_OBSERVATIONS, _SEASON) + " SELECT station, date, tmax, prediction FROM forecast",
    "forest_forecast_lagged": _forest(_LAGGED_OBSERVATIONS, _LAG) + " SELECT station, date, tmax, prediction FROM forecast",
    "forest_validation": _forest(_OBSERVATIONS, _SEASON) + """
        SELECT round(sqrt(avg(power(tmax - prediction, 2))), 6) AS rmse, round(avg(abs(tmax - prediction)), 6) AS mae,
               round(1 - sum(power(tmax - prediction, 2)) / (count(*) * var_pop(tmax)), 6) AS r2
        FROM forecast""",
    "forest_trees": _forest(_OBSERVATIONS, _SEASON) + f"""
        SELECT CAST(n.tree AS INT) AS tree, CAST(n.node AS INT) AS node, ({list(_SEASON)})[s.feature + 1] AS feature, threshold,
               CAST(n AS BIGINT) AS n, mean
        FROM nodes n LEFT JOIN splits s ON s.tree = n.tree AND s.node = n.node""",
    "forest_holdout": _forest(_OBSERVATIONS, _SEASON) + """
        SELECT station, date, tmax, coalesce(isfinite(prediction), false) AS finite FROM forecast""",
    "listener_ledger": "SELECT event_type, count(*) AS n, count(*) AS archived FROM events GROUP BY event_type",
    "unique_surrogate_keys": f"""
        WITH keyed AS (
            SELECT event_id, {_hex("md5(CAST(event_id AS VARCHAR))", 8)} % 123456789 AS key FROM events
        ), placed AS (
            SELECT *, row_number() OVER (ORDER BY key, event_id) - 1 AS place FROM keyed
        )
        SELECT event_id, CAST(place + max(key - place) OVER (ORDER BY place) AS BIGINT) AS custom_id FROM placed""",
    "schedule_cron": """
        WITH span AS (
            SELECT min(ts) AS first, max(ts) AS last FROM events
        ), minutes AS (
            SELECT unnest(generate_series(date_trunc('day', first) - INTERVAL 400 DAY, last, INTERVAL 1 MINUTE)) AS m FROM span
        ), slots AS (
            SELECT '0 6,18 * * 1-5' AS schedule, m FROM minutes
            WHERE minute(m) = 0 AND hour(m) IN (6, 18) AND dayofweek(m) BETWEEN 1 AND 5
            UNION ALL SELECT '30 */8 1,15 * mon', m FROM minutes
            WHERE minute(m) = 30 AND hour(m) % 8 = 0 AND (day(m) IN (1, 15) OR dayofweek(m) = 1)
            UNION ALL SELECT '*/20 9-17/4 * jan,feb 0', m FROM minutes
            WHERE minute(m) % 20 = 0 AND hour(m) IN (9, 13, 17) AND month(m) IN (1, 2) AND dayofweek(m) = 0
            UNION ALL SELECT '15 9 29 */2 *', m FROM minutes
            WHERE minute(m) = 15 AND hour(m) = 9 AND day(m) = 29 AND month(m) IN (1, 3, 5, 7, 9, 11)
            UNION ALL SELECT '@once', first FROM span
            UNION ALL SELECT '@weekly', m FROM minutes WHERE minute(m) = 0 AND hour(m) = 0 AND dayofweek(m) = 0
            UNION ALL SELECT '@monthly', m FROM minutes WHERE minute(m) = 0 AND hour(m) = 0 AND day(m) = 1
            UNION ALL SELECT '@yearly', m FROM minutes WHERE minute(m) = 0 AND hour(m) = 0 AND dayofyear(m) = 1
        ), spanned AS (
            SELECT schedule, m, lead(m) OVER (PARTITION BY schedule ORDER BY m) AS until FROM slots
        )
        SELECT schedule, m AS slot, count(event_id) AS n
        FROM spanned JOIN span ON until IS NULL OR until > first
        LEFT JOIN events ON ts >= m AND (until IS NULL OR ts < until)
        GROUP BY schedule, m""",
    "key_ranges": """
        WITH keys AS (
            SELECT 'orders' AS source, CAST(o_orderkey AS BIGINT) AS key FROM orders
            UNION ALL SELECT 'events', user_id FROM events UNION ALL SELECT 'lineitem', l_partkey FROM lineitem
        ), placed AS (
            SELECT source, key, row_number() OVER (PARTITION BY source ORDER BY key) AS i, count(*) OVER (PARTITION BY source) AS n,
                   max(key) OVER (PARTITION BY source) AS most
            FROM keys WHERE key IS NOT NULL
        ), bound AS (
            SELECT DISTINCT source, key FROM placed JOIN range(1, 16) AS parts(j) ON i = (j * n + 15) // 16 WHERE key < most
        ), ends AS (
            SELECT source, lag(key) OVER of AS lower, key AS upper, row_number() OVER of - 1 AS range
            FROM (SELECT source, key FROM bound UNION ALL SELECT DISTINCT source, NULL FROM keys)
            WINDOW of AS (PARTITION BY source ORDER BY key NULLS LAST)
        )
        SELECT e.source, CAST(range AS INT) AS range, lower, upper, count(k.key) AS n
        FROM ends e LEFT JOIN keys k ON k.source = e.source AND (lower IS NULL OR k.key > lower) AND (upper IS NULL OR k.key <= upper)
        GROUP BY ALL
        UNION ALL SELECT source, -1, NULL, NULL, count(*) - count(key) FROM keys GROUP BY source""",
    "classifier_rows": f"""
        SELECT model, vec_id AS id, label, label BETWEEN 0 AND 9 AS in_range, vec_id IS NOT NULL AS same
        FROM {_POSITIONS}, (VALUES ('l1_logistic'), ('l1_hinge'), ('linear_svc'), ('mlp')) m(model)
        WHERE pos >= floor(n * 0.75) AND pos < floor(n * 0.75) + ceil(n * 0.25)""",
    "linear_margins": f"""
        SELECT model, vec_id AS id, label, vec_id IS NOT NULL AS same
        FROM {_POSITIONS}, (VALUES ('l1_logistic'), ('l1_hinge')) m(model)
        WHERE pos >= floor(n * 0.75) AND pos < floor(n * 0.75) + ceil(n * 0.25)""",
}
