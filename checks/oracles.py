"""Independent SQL for the registered queries, in the dialect of DuckDB.

Each statement is assembled from named common table expressions over the ``events`` view; ``_sql`` adds the ones a body
mentions, in order.
"""

from __future__ import annotations

import re

from checks import forest_sql

_C256 = "(2e0*(ln(255e0)+0.5772156649015329e0)-2e0*255e0/256e0)"
_S = ["temperature", "humidity", "pressure", "gas_resistance"]
_NOW = "TIMESTAMP '2024-01-30 12:34:00'"
_SPLIT = "TIMESTAMP '2024-01-24 00:00:00'"


def _iaq(gas: str, humidity: str, base: str) -> str:
    return f"""round(least(500e0,
      CASE WHEN {gas} >= {base} THEN 0e0 ELSE (1e0 - {gas}/{base})*300e0 END
      + CASE WHEN {humidity} BETWEEN 30 AND 60 THEN 0e0
             WHEN {humidity} < 30 THEN (30e0-{humidity})*5e0 ELSE ({humidity}-60e0)*5e0 END), 2)"""


def _any_rule(iaq: str, limits: tuple) -> str:
    top, tmax, tmin, hmax, hmin = limits
    return f"""CAST(({iaq} > {top} OR temperature > {tmax} OR temperature < {tmin}
      OR humidity > {hmax} OR humidity < {hmin}) AS INTEGER)"""


_LIMITS = ("150e0", "33e0", "28e0", "70e0", "60e0")

def _half_up(x: str) -> str:
    """4 decimals, exact halves away from zero."""
    return f"CAST(round(CAST({x} AS DECIMAL(18,10)), 4) AS DOUBLE)"


_CTES = {
    "readings": f"""SELECT event_id, ts, 'dev-' || CAST(user_id % 8 AS VARCHAR) AS device_id,
      31.0e0 + ((event_id*7919) % 401 - 200)/200.0e0 + CASE WHEN event_id % 41 = 0 THEN 4.0e0 ELSE 0e0 END
        + CASE WHEN ts >= {_SPLIT} THEN 0.5e0 ELSE 0e0 END AS temperature,
      65.0e0 + ((event_id*104729) % 601 - 300)/100.0e0 AS humidity,
      CASE WHEN event_id % 101 = 0 THEN 1500.0e0
           ELSE 1004.0e0 + ((event_id*1299709) % 401 - 200)/100.0e0 END AS pressure,
      CASE WHEN event_id % 37 = 0 THEN 3000.0e0 + (event_id*31) % 12000
           ELSE 45000.0e0 + (event_id*15485863) % 20001 END AS gas_resistance
      FROM events""",
    "bronze": """SELECT event_id, 0 AS copy_no, ts, device_id, temperature,
        CASE WHEN event_id % 97 = 0 THEN NULL ELSE humidity END AS humidity, pressure, gas_resistance FROM readings
      UNION ALL SELECT event_id, 1, ts, device_id, temperature + 0.25e0, humidity, pressure, gas_resistance
      FROM readings WHERE event_id % 53 = 0""",
    "nonnull": f"""SELECT * FROM bronze WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*_S, 'ts'])}""",
    "valid": """SELECT * FROM nonnull WHERE temperature BETWEEN 0 AND 85 AND humidity BETWEEN 0 AND 100
      AND pressure BETWEEN 800 AND 1200 AND gas_resistance BETWEEN 100 AND 500000""",
    "clean": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ts, device_id
      ORDER BY copy_no DESC, event_id DESC) AS rn FROM valid) WHERE rn = 1""",
    "scored": f"""SELECT *, {_iaq('gas_resistance', 'humidity', 'gas_baseline')} AS iaq_score FROM (
      SELECT *, (SELECT quantile_cont(gas_resistance, 0.75) FROM clean) AS gas_baseline FROM clean)""",
    "labelled": f"SELECT *, {_any_rule('iaq_score', _LIMITS)} AS is_anomaly FROM scored",
    "fixed55": f"SELECT *, {_iaq('gas_resistance', 'humidity', '55000e0')} AS iaq_score FROM readings",
    "boxes": """SELECT * FROM (VALUES
      (1,1,-1e9,33e0,-1e9,20000e0,2e0),(1,2,-1e9,33e0,20000e0,1e9,6e0),(1,3,33e0,1e9,-1e9,1e9,1e0),
      (2,1,-1e9,1e9,-1e9,16000e0,1e0),(2,2,-1e9,1e9,16000e0,1e9,5e0),
      (3,1,-1e9,32.5e0,-1e9,1e9,6e0),(3,2,32.5e0,1e9,-1e9,1e9,1e0)) AS b(tree,leaf,t_lo,t_hi,g_lo,g_hi,path)""",
    "models": "SELECT * FROM (VALUES ('champion',2,0.03e0),('challenger',3,0.06e0)) AS m(model,last_tree,share)",
    "plain_scores": f"""SELECT model, event_id, -pow(2e0, -avg(path)/{_C256}) AS score FROM readings, boxes, models
      WHERE tree <= last_tree AND temperature > t_lo AND temperature <= t_hi AND gas_resistance > g_lo
        AND gas_resistance <= g_hi GROUP BY model, event_id""",
    "cuts": """SELECT p.model, CASE p.model WHEN 'champion' THEN quantile_cont(score, 0.03)
      ELSE quantile_cont(score, 0.06) END AS cut FROM plain_scores p GROUP BY p.model""",
    "label_scores": f"""SELECT model, event_id, copy_no, -pow(2e0, -avg(path)/{_C256}) AS score
      FROM labelled, boxes, models WHERE tree <= last_tree AND temperature > t_lo AND temperature <= t_hi
        AND gas_resistance > g_lo AND gas_resistance <= g_hi GROUP BY model, event_id, copy_no""",
    "model_rows": """SELECT s.model, s.event_id, l.ts, l.is_anomaly, CAST(s.score < c.cut AS INTEGER) AS predicted,
      -s.score AS outlierness FROM label_scores s JOIN labelled l USING (event_id, copy_no) JOIN cuts c USING (model)""",
    "gold": f"""SELECT l.* EXCLUDE (is_anomaly), s.score AS anomaly_score,
      s.score + pow(2e0, -2e0/{_C256}) AS decision_score,
      CASE WHEN s.score + pow(2e0, -2e0/{_C256}) < 0 THEN -1 ELSE 1 END AS prediction,
      CAST(s.score + pow(2e0, -2e0/{_C256}) < 0 AS INTEGER) AS is_anomaly
      FROM labelled l JOIN label_scores s USING (event_id, copy_no) WHERE s.model = 'champion'""",
    "sides": f"SELECT *, CASE WHEN ts < {_SPLIT} THEN 'reference' ELSE 'production' END AS side FROM readings",
    "long": " UNION ALL ".join(f"SELECT side, '{c}' AS feature, {c} AS x FROM sides" for c in _S),
    "value_counts": """SELECT feature, x, count(*) FILTER (side='reference') AS e,
      count(*) FILTER (side='production') AS a FROM long GROUP BY feature, x""",
    "sizes": """SELECT feature, min(x) AS lo, max(x) AS hi, sum(e) AS n_e, sum(a) AS n_a FROM value_counts
      GROUP BY feature""",
    "hist": """SELECT g.feature, g.bin, g.n_e, g.n_a, coalesce(sum(v.e),0) AS e, coalesce(sum(v.a),0) AS a
      FROM (SELECT *, unnest(range(1,21)) AS bin FROM sizes) g
      LEFT JOIN (SELECT c.*, 1 + len(list_filter(range(1,20), lambda i: s.lo + i*((s.hi-s.lo)/20) <= c.x)) AS bin
        FROM value_counts c JOIN sizes s USING (feature)) v USING (feature, bin)
      GROUP BY g.feature, g.bin, g.n_e, g.n_a""",
    "divergence": """SELECT feature, sum((a1-e1)*ln(a1/e1)) AS psi, greatest(sum(a2*ln(a2/e2)), 0e0) AS kl FROM (
      SELECT feature, (e/n_e+1e-6)/sum(e/n_e+1e-6) OVER w AS e1, (a/n_a+1e-6)/sum(a/n_a+1e-6) OVER w AS a1,
        (e/n_e+1e-8)/sum(e/n_e+1e-8) OVER w AS e2, (a/n_a+1e-8)/sum(a/n_a+1e-8) OVER w AS a2
      FROM hist WINDOW w AS (PARTITION BY feature)) GROUP BY feature""",
    "ks": """SELECT feature, n_e, n_a, max(abs(e_run/n_e - a_run/n_a)) AS d FROM (
      SELECT v.feature, s.n_e, s.n_a, sum(v.e) OVER w AS e_run, sum(v.a) OVER w AS a_run
      FROM value_counts v JOIN sizes s USING (feature) WINDOW w AS (PARTITION BY v.feature ORDER BY v.x))
      GROUP BY feature, n_e, n_a""",
    "once": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ts, device_id ORDER BY gas_resistance DESC, temperature DESC, humidity DESC, pressure DESC) AS rn
      FROM readings WHERE temperature BETWEEN 0 AND 85 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 800 AND 1200 AND gas_resistance BETWEEN 100 AND 500000) WHERE rn = 1""",
    "hour_scored": f"""SELECT *, {_iaq('gas_resistance', 'humidity', 'gas_baseline')} AS iaq_score, CAST(ts AS VARCHAR) AS ts_text FROM once
      JOIN (SELECT date_trunc('hour', ts) AS h, quantile_cont(gas_resistance, 0.75) AS gas_baseline FROM once GROUP BY 1) ON h = date_trunc('hour', ts)""",
    "device_long": " UNION ALL ".join(f"SELECT device_id || '.{c}' AS feature, {c} AS x, (side='reference')::INT AS e, (side='production')::INT AS a FROM sides" for c in _S),
    "device_ks": """SELECT feature, n_e::BIGINT AS n_e, n_a::BIGINT AS n_a, least(n_e, n_a)::BIGINT AS n, greatest(n_e, n_a)::BIGINT AS m, max(abs(e_run/n_e - a_run/n_a)) AS d, max(abs(e_run*n_a - a_run*n_e))::BIGINT AS gap
      FROM (SELECT feature, sum(e) OVER w AS e_run, sum(a) OVER w AS a_run, sum(e) OVER f AS n_e, sum(a) OVER f AS n_a FROM device_long
        WINDOW w AS (PARTITION BY feature ORDER BY x), f AS (PARTITION BY feature)) GROUP BY feature, n_e, n_a""",
    "device_paths": """SELECT * FROM (WITH RECURSIVE step AS (
        SELECT feature, n, m, gap, 0::BIGINT AS k, list_transform(range(0, n + 1), lambda i: CASE WHEN i = 0 THEN 1e0 ELSE 0e0 END) AS inside
        FROM device_ks WHERE greatest(n_e, n_a) <= 10000
        UNION ALL SELECT feature, n, m, gap, k + 1, list_transform(range(0, n + 1), lambda i: CASE WHEN i > k + 1 OR k + 1 - i > m OR abs(i*(n + m) - (k + 1)*n) >= gap THEN 0e0
          ELSE (CASE WHEN i = 0 THEN 0e0 ELSE inside[i]*i END + inside[i + 1]*(k + 1 - i))/(k + 1) END)
        FROM step WHERE k < n + m) SELECT * FROM step WHERE k = n + m)""",
    # the alternating series needs about 4 / lambda terms
    "ksp": """SELECT feature, d, least(1e0, greatest(0e0, list_sum(list_transform(range(1,5001), lambda k:
      2e0*(CASE WHEN k%2=1 THEN 1e0 ELSE -1e0 END)*exp(-2e0*k*k*d*d*(CAST(n_e AS DOUBLE)*n_a/(n_e+n_a))))))) AS p FROM ks""",
    "describe_": """SELECT side, feature, count(*) AS count, avg(x) AS mean, stddev_pop(x) AS std, min(x) AS min,
      quantile_cont(x,0.05) AS p05, quantile_cont(x,0.25) AS p25, quantile_cont(x,0.5) AS median,
      quantile_cont(x,0.75) AS p75, quantile_cont(x,0.95) AS p95, max(x) AS max FROM long GROUP BY side, feature""",
    "report": """SELECT k.feature, round(v.psi,6) AS psi, round(v.kl,6) AS kl_divergence, round(k.d,6) AS ks_statistic,
      round(k.p,6) AS ks_pvalue, v.psi > 0.20e0 AS psi_flag, k.p < 0.05e0 AS ks_flag,
      round(b.mean - r.mean, 4) AS mean_shift, round(b.std - r.std, 4) AS std_shift, r.count AS n_ref, b.count AS n_prod,
      CASE k.feature WHEN 'temperature' THEN 1 WHEN 'humidity' THEN 2 WHEN 'pressure' THEN 3 ELSE 4 END AS place
      FROM ksp k JOIN divergence v USING (feature)
      JOIN describe_ r ON r.feature=k.feature AND r.side='reference'
      JOIN describe_ b ON b.feature=k.feature AND b.side='production' WHERE r.count >= 10 AND b.count >= 10""",
    "summary": """SELECT bool_or(psi_flag) OR count(*) FILTER (ks_flag) >= 2 OR avg(kl_divergence) > 0.15e0 AS overall_drift,
      bool_or(psi_flag) AS drift_by_psi, count(*) FILTER (ks_flag) >= 2 AS drift_by_ks,
      avg(kl_divergence) > 0.15e0 AS drift_by_kl,
      coalesce(string_agg(feature, ',' ORDER BY place) FILTER (psi_flag), '') AS psi_violations,
      coalesce(string_agg(feature, ',' ORDER BY place) FILTER (ks_flag), '') AS ks_violations,
      round(avg(kl_divergence),6) AS kl_mean, max(n_ref) AS reference_count, max(n_prod) AS production_count FROM report""",
    "msg_parts": """SELECT event_id, ts,
      '{"temperature":' || CAST(3100 + (event_id*7919) % 201 - 100 AS VARCHAR) || 'e-2,"humidity":'
        || CAST(6500 + (event_id*104729) % 601 - 300 AS VARCHAR) || 'e-2,"pressure":1004' AS head,
      CAST(45000 + (event_id*15485863) % 20001 AS VARCHAR) AS g FROM events""",
    "msg_flat": """SELECT *, head || ',"gas_resistance":' || g || '}' AS flat FROM msg_parts""",
    "messages": """SELECT event_id, ts, CASE event_id % 10
      WHEN 0 THEN '{"device_id":"dev-0","version":"1","sensors":' || flat || '}'
      WHEN 1 THEN flat
      WHEN 2 THEN '{"Type":"Notification","Message":"' || replace(flat, '"', chr(92) || '"') || '"}'
      WHEN 3 THEN '{"Message":"' || replace(flat, '"', chr(92) || '"') || '"}'
      WHEN 4 THEN '"' || replace(flat, '"', chr(92) || '"') || '"'
      WHEN 5 THEN head || ',"gas_resistance":null}'
      WHEN 6 THEN head || '}'
      WHEN 7 THEN head || ',"gas_resistance":"' || g || '"}'
      WHEN 8 THEN 'not json' ELSE '[1,2]' END AS body FROM msg_flat""",
    "opened": """SELECT *, CASE WHEN j IS NULL THEN 'unreadable'
        WHEN json_type(j)='OBJECT' AND json_extract_string(j,'$.Type')='Notification'
          THEN CASE WHEN json_type(j,'$.Message') IS NULL THEN 'plain' ELSE 'notification' END
        WHEN json_type(j)='OBJECT' AND json_type(j,'$.Message')='VARCHAR'
          AND json_valid(json_extract_string(j,'$.Message')) THEN 'message'
        WHEN json_type(j)='VARCHAR' THEN 'text' ELSE 'plain' END AS envelope
      FROM (SELECT *, TRY_CAST(CASE WHEN json_valid(body) THEN body END AS JSON) AS j FROM messages)""",
    "docs": """SELECT *, CASE envelope WHEN 'plain' THEN j
        WHEN 'notification' THEN TRY_CAST(json_extract_string(j,'$.Message') AS JSON)
        WHEN 'message' THEN TRY_CAST(json_extract_string(j,'$.Message') AS JSON)
        WHEN 'text' THEN TRY_CAST(json_extract_string(j,'$') AS JSON) END AS doc FROM opened""",
    "payloads": """SELECT *, CASE WHEN json_type(doc,'$.sensors') IS NOT NULL THEN json_extract(doc,'$.sensors')
      ELSE doc END AS payload FROM docs""",
    "parsed": f"""SELECT *, CASE WHEN doc IS NULL THEN 'bad_json' WHEN json_type(doc) <> 'OBJECT' THEN 'not_object'
        WHEN json_type(payload) <> 'OBJECT' THEN 'bad_sensors' WHEN missing <> '' THEN 'missing_fields'
        WHEN {' OR '.join(f'{c} IS NULL' for c in _S)} THEN 'bad_number' ELSE 'valid' END AS reason FROM (
      SELECT *, concat_ws(',', {', '.join(f"CASE WHEN coalesce(json_type(payload,'$.{c}'),'NULL')='NULL' THEN '{c}' END" for c in _S)}) AS missing,
        {', '.join(f"TRY_CAST(json_extract_string(payload,'$.{c}') AS DOUBLE) AS {c}" for c in _S)},
        CASE WHEN json_type(doc,'$.sensors') IS NOT NULL THEN 'nested' ELSE 'flat' END AS layout,
        json_extract_string(doc,'$.device_id') AS device_id, json_extract_string(doc,'$.version') AS version
      FROM payloads)""",
    "scorer_text": """SELECT event_id, CAST(CAST(round(temperature*100) AS BIGINT) AS VARCHAR) || 'e-2' AS t,
      CAST(CAST(round(humidity*100) AS BIGINT) AS VARCHAR) || 'e-2' AS h,
      CAST(CAST(gas_resistance AS BIGINT) AS VARCHAR) AS g FROM readings""",
    "scorer_docs": """SELECT event_id, CASE WHEN json_type(j,'$.body') IS NOT NULL THEN json_extract(j,'$.body') ELSE j END AS b
      FROM (SELECT event_id, CAST(CASE event_id % 8
        WHEN 0 THEN '{"temperature":' || t || ',"humidity":' || h || ',"pressure":1004,"gas_resistance":' || g || '}'
        WHEN 1 THEN '{"T":' || t || ',"H":' || h || ',"P":1004,"G":' || g || '}'
        WHEN 2 THEN '{"T":0,"temperature":' || t || ',"H":' || h || ',"P":1004,"G":' || g || '}'
        WHEN 3 THEN '{"body":{"T":' || t || ',"H":' || h || ',"P":1004,"G":' || g || '}}'
        WHEN 4 THEN '{"T":' || t || ',"H":' || h || ',"G":' || g || '}'
        WHEN 5 THEN '{"T":' || t || ',"H":null,"P":1004,"G":' || g || '}'
        WHEN 6 THEN '{"T":' || t || ',"H":"damp","P":1004,"G":' || g || '}'
        ELSE '{"T":"' || t || '","H":' || h || ',"P":1004,"G":' || g || '}' END AS JSON) AS j FROM scorer_text)""",
    "spread": """SELECT event_id, 15.0e0 + event_id % 23 AS t, 20.0e0 + event_id % 61 AS h, 995.0e0 + event_id % 21 AS p,
      CASE WHEN event_id % 3 = 0 THEN 160000.0e0 ELSE 10000.0e0 + (event_id * 7919) % 150000 END AS g FROM events""",
    "challenger_scores": f"""SELECT event_id, -pow(2e0, -avg(path)/{_C256}) AS score FROM readings, boxes
      WHERE temperature > t_lo AND temperature <= t_hi AND gas_resistance > g_lo AND gas_resistance <= g_hi
      GROUP BY event_id""",
    "versions": """SELECT CASE WHEN event_id % 3 = 0 THEN 'model-hot'
        ELSE 'model-' || CAST(event_id % 2503 AS VARCHAR) END AS model_name, event_id AS version,
      CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'signup' THEN 'Staging' WHEN 'view' THEN 'None'
        ELSE 'Archived' END AS stage, 'r' || CAST(event_id AS VARCHAR) AS run_id FROM events""",
    "runs": """SELECT 'r' || CAST(event_id AS VARCHAR) AS run_id, CAST(ts AS DATE) AS training_date,
      0.5e0 + ((event_id*7919) % 501)/1000.0e0 AS roc_auc, 0.3e0 + ((event_id*104729) % 701)/1000.0e0 AS precision,
      0.2e0 + ((event_id*1299709) % 801)/1000.0e0 AS recall, 0.2e0 + ((event_id*15485863) % 801)/1000.0e0 AS f1
      FROM events WHERE event_id % 11 <> 0""",
    "ranked_versions": """SELECT *, row_number() OVER (PARTITION BY model_name, stage ORDER BY version DESC) AS rn
      FROM versions""",
    "in_stage": """SELECT model_name, max(version) FILTER (stage='Production') AS prod,
      max(version) FILTER (stage='Staging') AS stag FROM versions GROUP BY model_name""",
    "fallback": """SELECT v.model_name, i.stag, max(v.version) AS version FROM versions v JOIN in_stage i USING (model_name)
      WHERE i.prod IS NULL AND i.stag IS NOT NULL AND v.version <> i.stag GROUP BY v.model_name, i.stag""",
    "artifacts": """SELECT model_name, max(version) AS artifact_version FROM versions WHERE version % 7 <> 0
      GROUP BY model_name""",
    "quota": """SELECT is_anomaly, base + CASE WHEN rnk <= need THEN 1 ELSE 0 END AS quota FROM (
      SELECT *, row_number() OVER (ORDER BY exact - base DESC, is_anomaly) AS rnk,
        CAST(round(sum(exact) OVER () - sum(base) OVER ()) AS BIGINT) AS need FROM (
      SELECT is_anomaly, n * ceil(0.2e0 * sum(n) OVER ()) / sum(n) OVER () AS exact,
        CAST(floor(n * ceil(0.2e0 * sum(n) OVER ()) / sum(n) OVER ()) AS BIGINT) AS base
      FROM (SELECT is_anomaly, count(*) AS n FROM labelled GROUP BY is_anomaly)))""",
    "splits": """SELECT l.*, CASE WHEN row_number() OVER (PARTITION BY l.is_anomaly
        ORDER BY (l.event_id*7919+42)%100003, l.event_id) <= q.quota THEN 'test' ELSE 'train' END AS split
      FROM labelled l JOIN quota q USING (is_anomaly)""",
    "auc_rows": f"""SELECT {_any_rule('iaq_score', _LIMITS)} AS y, iaq_score + abs(temperature - 31e0) AS s FROM fixed55""",
    "model_auc": """SELECT model, (sum(r) FILTER (is_anomaly=1) - max(p)*(max(p)+1)/2)/(max(p)*(count(*)-max(p))) AS roc_auc FROM (
      SELECT model, is_anomaly, rank() OVER (PARTITION BY model ORDER BY outlierness)
        + (count(*) OVER (PARTITION BY model, outlierness) - 1)/2e0 AS r,
        CAST(sum(is_anomaly) OVER (PARTITION BY model) AS DOUBLE) AS p FROM model_rows) GROUP BY model""",
    "model_cells": """SELECT model, count(*) FILTER (is_anomaly=0 AND predicted=0) AS tn,
      count(*) FILTER (is_anomaly=0 AND predicted=1) AS fp, count(*) FILTER (is_anomaly=1 AND predicted=0) AS fn,
      count(*) FILTER (is_anomaly=1 AND predicted=1) AS tp FROM model_rows GROUP BY model""",
    "model_rates": """SELECT *, (tp+tn)/(tp+tn+fp+fn) AS accuracy,
      CASE WHEN tp+fp=0 THEN 0e0 ELSE tp/(tp+fp) END AS precision, CASE WHEN tp+fn=0 THEN 0e0 ELSE tp/(tp+fn) END AS recall,
      CASE WHEN 2*tp+fp+fn=0 THEN 0e0 ELSE 2*tp/(2*tp+fp+fn) END AS f1,
      (tp+fp)/(tp+tn+fp+fn) AS anomaly_rate_predicted, (tp+fn)/(tp+tn+fp+fn) AS anomaly_rate_true FROM model_cells""",
    "model_stats": """SELECT model, round(avg(outlierness),4) AS mean, round(stddev_pop(outlierness),4) AS std,
      round(quantile_cont(outlierness,0.5),4) AS p50, round(quantile_cont(outlierness,0.95),4) AS p95,
      round(quantile_cont(outlierness,0.99),4) AS p99, count(*) AS n_eval FROM model_rows GROUP BY model""",
    "evaluated": """SELECT r.model AS side, round(a.roc_auc,4) AS roc_auc, round(precision,4) AS precision,
      round(recall,4) AS recall, round(f1,4) AS f1, round(accuracy,4) AS accuracy,
      round(anomaly_rate_predicted,4) AS anomaly_rate_predicted, round(anomaly_rate_true,4) AS anomaly_rate_true,
      tn, fp, fn, tp, mean, std, p50, p95, p99, n_eval, tp+fn < 10 AS few_anomalies
      FROM model_rates r JOIN model_auc a USING (model) JOIN model_stats s USING (model)""",
    "deltas": """SELECT metric, max(v) FILTER (side='champion') AS champion, max(v) FILTER (side='challenger') AS challenger
      FROM (UNPIVOT (SELECT side, roc_auc, precision, recall, f1, accuracy FROM evaluated)
        ON roc_auc, precision, recall, f1, accuracy INTO NAME metric VALUE v) GROUP BY metric""",
    "day_rows": "SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM model_rows",
    "day_auc": """SELECT day, model, CASE WHEN max(p)=0 OR max(p)=count(*) THEN 0e0 ELSE
      (sum(r) FILTER (is_anomaly=1) - max(p)*(max(p)+1)/2)/(max(p)*(count(*)-max(p))) END AS roc_auc FROM (
      SELECT day, model, is_anomaly, rank() OVER (PARTITION BY day, model ORDER BY outlierness)
        + (count(*) OVER (PARTITION BY day, model, outlierness) - 1)/2e0 AS r,
        CAST(sum(is_anomaly) OVER (PARTITION BY day, model) AS DOUBLE) AS p FROM day_rows) GROUP BY day, model""",
    "day_cells": """SELECT day, model, count(*) FILTER (is_anomaly=0 AND predicted=1) AS fp,
      count(*) FILTER (is_anomaly=1 AND predicted=0) AS fn, count(*) FILTER (is_anomaly=1 AND predicted=1) AS tp
      FROM day_rows GROUP BY day, model""",
    "day_metrics": """SELECT day, model, round(roc_auc,4) AS roc_auc,
      round(CASE WHEN tp+fp=0 THEN 0e0 ELSE tp/(tp+fp) END,4) AS precision,
      round(CASE WHEN tp+fn=0 THEN 0e0 ELSE tp/(tp+fn) END,4) AS recall,
      round(CASE WHEN 2*tp+fp+fn=0 THEN 0e0 ELSE 2*tp/(2*tp+fp+fn) END,4) AS f1
      FROM day_cells JOIN day_auc USING (day, model)""",
    "seats": """SELECT * FROM (VALUES ('forward','champion','challenger'),('reverse','challenger','champion'),
      ('self','champion','champion')) AS s(matchup, a, b)""",
    "pairs": """SELECT day, matchup, x.recall*0.40e0 + x.roc_auc*0.35e0 + x.precision*0.15e0 + x.f1*0.10e0 AS sa,
      y.recall*0.40e0 + y.roc_auc*0.35e0 + y.precision*0.15e0 + y.f1*0.10e0 AS sb,
      round(y.recall-x.recall,4) AS dr, round(y.roc_auc-x.roc_auc,4) AS da, round(y.precision-x.precision,4) AS dp
      FROM seats JOIN day_metrics x ON x.model=a JOIN day_metrics y USING (day) WHERE y.model=b""",
    "points": f"""SELECT *, {_half_up('sb-sa')} AS ds,
      concat_ws(',', CASE WHEN dr>0.02e0 THEN 'recall_up' WHEN dr>=-0.02e0 THEN 'recall_stable' END,
        CASE WHEN da>0.01e0 THEN 'roc_auc_up' END, CASE WHEN dp>0.02e0 THEN 'precision_up' END) AS analysis_points,
      concat_ws(',', CASE WHEN dr<-0.02e0 THEN 'recall_down' END, CASE WHEN da<-0.01e0 THEN 'roc_auc_down' END,
        CASE WHEN dp<-0.05e0 THEN 'precision_down' END) AS risk_points,
      CAST(dr<-0.02e0 AS INT)+CAST(da<-0.01e0 AS INT)+CAST(dp<-0.05e0 AS INT) AS n_risks FROM pairs""",
    "verdicts": """SELECT *, CASE WHEN dr<-0.03e0 OR k='c' THEN 'KEEP' WHEN k IN ('p','m') THEN 'PROMOTE' ELSE 'REVIEW' END AS verdict,
      CASE WHEN dr<-0.03e0 THEN 'HIGH' WHEN k='m' THEN 'MEDIUM' WHEN k='r' THEN 'LOW' ELSE 'HIGH' END AS confidence,
      CASE WHEN dr<-0.03e0 THEN 'recall_drop' WHEN k='p' THEN 'clear_gain' WHEN k='m' THEN 'small_gain'
        WHEN k='c' THEN 'champion_better' ELSE 'near_equal' END AS reason
      FROM (SELECT *, CASE WHEN ds>0.01e0 AND n_risks=0 THEN 'p' WHEN ds>0 AND n_risks<=1 THEN 'm'
        WHEN ds<-0.005e0 THEN 'c' ELSE 'r' END AS k FROM points)""",
    "importance": """SELECT CASE side WHEN 'reference' THEN 'champion' ELSE 'challenger' END AS side, feature,
      stddev_samp(x) AS importance FROM long GROUP BY side, feature""",
}


def _needed(text: str) -> set[str]:
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in words & (_CTES.keys() - found):
            if name in words:
                found.add(name)
                todo.append(_CTES[name])
    return found


def _sql(body: str) -> str:
    used = _needed(body)
    parts = [f"{name} AS ({text})" for name, text in _CTES.items() if name in used]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _rolled(order: str, partition: str, suffixes: tuple[str, ...]) -> str:
    columns = []
    for c in ("temperature", "humidity", "iaq_score"):
        if "mean" in suffixes:
            columns.append(f"round(avg({c}) OVER w, 6) AS {c}_rolling_mean")
        if "std" in suffixes:
            columns.append(f"round(coalesce(stddev_samp({c}) OVER w, 0e0), 6) AS {c}_rolling_std")
    return f"""SELECT event_id, {', '.join(columns)} FROM fixed55
      WINDOW w AS ({partition} ORDER BY {order} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""


def _hours(first: str, last: str) -> str:
    return f"date_trunc('hour', ts) BETWEEN TIMESTAMP '{first}' AND TIMESTAMP '{last}'"


def _days(first: str, last: str) -> str:
    return f"CAST(ts AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'"


_BAND = """CASE WHEN d > 0 THEN 'deep_normal' WHEN d > -0.05e0 THEN 'near_boundary' WHEN d > -0.10e0 THEN 'anomalous'
  WHEN d > -0.20e0 THEN 'severe' ELSE 'extreme' END"""
_LABEL = """CASE WHEN i <= 50 THEN 'Excellent' WHEN i <= 100 THEN 'Good' WHEN i <= 150 THEN 'Lightly Polluted'
  WHEN i <= 200 THEN 'Moderately Polluted' WHEN i <= 300 THEN 'Heavily Polluted' ELSE 'Severely Polluted' END"""


def _iaq2(g: str, h: str) -> str:
    return f"""CAST(trunc(least(500e0, greatest(0e0, (1e0 - (
      (CASE WHEN {h} - 40e0 > 0 THEN 0.25e0 ELSE 0.75e0 END)/100e0*({h}-40e0)*-1
      + (least(greatest({g},10000e0),250000e0)-10000e0)/240000e0*0.75e0)*100)*500/100))) AS INTEGER)"""


def _factors(t: str, h: str, g: str) -> str:
    return f"""concat_ws(',', CASE WHEN {t}>=35 THEN 'temperature_critical' WHEN {t}>=33 THEN 'temperature_high' END,
      CASE WHEN {t}<=20 THEN 'temperature_low' END, CASE WHEN {h}>=75 THEN 'humidity_high' END,
      CASE WHEN {h}<=30 THEN 'humidity_low' END,
      CASE WHEN {g}<=20000 THEN 'gas_very_low' WHEN {g}<=50000 THEN 'gas_low' END,
      CASE WHEN {g}>=150000 THEN 'gas_clean' END)"""


def _rule(t: str, h: str, p: str, g: str, picks: dict[str, str]) -> str:
    """Rule number by CASE, then the wanted text per number."""
    return f"""CASE WHEN {t}>=35 AND {g}<=20000 THEN '{picks['fire']}' WHEN {t}>=33 AND {g}<=50000 THEN '{picks['heat']}'
      WHEN {g}<=20000 THEN '{picks['chem']}' WHEN {g}<=50000 THEN '{picks['poll']}'
      WHEN {h}>=75 AND {p}<1005 THEN '{picks['storm']}' WHEN {t}<=20 AND {h}<=30 THEN '{picks['dry']}'
      WHEN {t}>=33 OR {t}<=20 OR {h}>=75 OR {h}<=30 THEN '{picks['any']}' ELSE '{picks['none']}' END"""


_TYPES = {"fire": "FIRE_RISK", "heat": "HEAT_SOURCE", "chem": "CHEMICAL_VOC", "poll": "AIR_POLLUTION",
          "storm": "WEATHER_CHANGE", "dry": "DRY_COLD", "any": "GENERAL_ANOMALY", "none": "NORMAL"}
_GRADES = {"fire": "CRITICAL", "heat": "HIGH", "chem": "CRITICAL", "poll": "MEDIUM", "storm": "LOW", "dry": "LOW",
           "any": "MEDIUM", "none": "NONE"}

_ROUND_SILVER = ", ".join(f"round({c},6) AS {c}" for c in _S)


def _alias(name: str, letter: str) -> str:
    return f"""CASE WHEN json_type(b,'$.{name}') IS NOT NULL THEN TRY_CAST(json_extract_string(b,'$.{name}') AS DOUBLE)
      ELSE TRY_CAST(json_extract_string(b,'$.{letter}') AS DOUBLE) END"""


def _alias_status() -> str:
    parts = []
    for name, letter in zip(_S, "THPG"):
        kind = f"coalesce(json_type(b,'$.{name}'), json_type(b,'$.{letter}'))"
        parts.append(f"WHEN {kind} IS NULL THEN 400")
        parts.append(f"WHEN {_alias(name, letter)} IS NULL THEN CASE WHEN {kind}='VARCHAR' THEN 400 ELSE 500 END")
    return f"CASE {' '.join(parts)} ELSE 200 END"


_CTES |= {
    "scorer_values": f"SELECT event_id, {_alias_status()} AS status, "
    + ", ".join(f"{_alias(n, a)} AS {a.lower()}" for n, a in zip(_S, "THPG")) + " FROM scorer_docs",
    "scorer_scores": f"""SELECT event_id, -pow(2e0, -avg(path)/{_C256}) + 0.75e0 AS d FROM scorer_values, boxes
      WHERE t > t_lo AND t <= t_hi AND g > g_lo AND g <= g_hi GROUP BY event_id""",
}

_BODIES = {
    "silver_anomaly_rate": """SELECT device_id, count(*) AS rows, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
      round(avg(iaq_score),6) AS mean_iaq, round(avg(is_anomaly),6) AS rate FROM labelled GROUP BY device_id""",
    "silver_features": f"""SELECT event_id, copy_no, ts, device_id, {_ROUND_SILVER},
      round(gas_baseline,6) AS gas_baseline, round(iaq_score,6) AS iaq_score, CAST(hour(ts) AS INTEGER) AS hour,
      CAST(isodow(ts)-1 AS INTEGER) AS day_of_week, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
      round(temperature/(humidity+1e-6),6) AS temp_humidity_ratio,
      round(gas_resistance/(pressure+1e-6),6) AS gas_pressure_ratio,
      {', '.join(f"round(avg({c}) OVER w,6) AS {c}_rolling_mean, round(coalesce(stddev_samp({c}) OVER w,0e0),6) AS {c}_rolling_std" for c in ("temperature", "humidity", "iaq_score"))}
      FROM scored WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    "scan_lookback_hours": f"SELECT event_id, ts FROM readings WHERE {_hours('2024-01-30 11:00:00', '2024-01-30 12:00:00')}",
    "scan_backfill": f"SELECT event_id, ts FROM readings WHERE {_hours('2024-01-28 06:00:00', '2024-01-30 12:00:00')}",
    "scan_day_windows": f"""SELECT 'training' AS window, count(*) AS rows FROM readings WHERE {_days('2024-01-24', '2024-01-30')}
      UNION ALL SELECT 'reference', count(*) FROM readings WHERE {_days('2023-12-31', '2024-01-29')}
      UNION ALL SELECT 'production', count(*) FROM readings WHERE {_days('2024-01-24', '2024-01-30')}
      UNION ALL SELECT 'evaluation', count(*) FROM readings WHERE {_days('2024-01-23', '2024-01-29')}""",
    "scan_latest_hour": f"""SELECT event_id, ts FROM readings WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts))
      FROM readings WHERE {_hours('2024-01-30 11:00:00', '2024-01-30 12:00:00')})""",
    "bronze_partition_counts": """SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS partition_key, count(*) AS rows
      FROM parsed WHERE reason = 'valid' GROUP BY 1""",
    "bronze_layer": """SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS partition_key, count(*) AS rows, round(sum(temperature),3) AS sum_temperature
      FROM readings WHERE event_id % 10 <> 8 GROUP BY 1""",
    "silver_two_runs": """SELECT ts_text AS timestamp, device_id, round(temperature,6) AS temperature, round(gas_baseline,6) AS gas_baseline, iaq_score,
      round(avg(temperature) OVER w,6) AS temperature_rolling_mean, round(coalesce(stddev_samp(temperature) OVER w,0e0),6) AS temperature_rolling_std,
      round(avg(iaq_score) OVER w,6) AS iaq_score_rolling_mean, round(coalesce(stddev_samp(iaq_score) OVER w,0e0),6) AS iaq_score_rolling_std
      FROM hour_scored WINDOW w AS (PARTITION BY device_id ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    "layer_lookback": f"""SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS partition_key, count(*) AS rows, round(sum(temperature),3) AS sum_temperature
      FROM readings WHERE date_trunc('hour', ts) BETWEEN date_trunc('hour', {_NOW}) - INTERVAL 23 HOUR AND {_NOW} GROUP BY 1""",
    "tolerant_scan": """SELECT key AS partition_key, CAST(sum(CASE WHEN spoiled THEN 0 ELSE 1 END) AS BIGINT) AS rows,
      CASE WHEN bool_or(spoiled) THEN 'unreadable' ELSE 'whole' END AS status FROM (
      SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS key, date_trunc('hour', ts) = TIMESTAMP '2024-01-17 05:00:00' AS spoiled
      FROM readings) GROUP BY 1""",
    "stream_bronze": """SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS partition_key, count(*) AS rows, round(sum(temperature),3) AS sum_temperature,
      'valid' AS reason FROM bronze WHERE event_id % 7 <> 6 AND humidity IS NOT NULL GROUP BY 1
      UNION ALL SELECT NULL, count(*), NULL, CASE WHEN event_id % 7 = 6 THEN 'bad_json' ELSE 'missing_fields' END AS why FROM bronze
      WHERE event_id % 7 = 6 OR humidity IS NULL GROUP BY why""",
    "stream_silver": """SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS partition_key,
      count(DISTINCT strftime(ts, '%Y-%m-%d %H:%M:%S ') || device_id) AS rows FROM valid WHERE event_id % 7 <> 6 GROUP BY 1""",
    "stream_hourly_rate": """SELECT date_trunc('hour',ts) AS hour_start, count(*) AS total,
      CAST(sum(is_anomaly) AS BIGINT) AS anomalies, round(avg(is_anomaly),6) AS rate FROM gold GROUP BY 1
      HAVING date_trunc('hour',ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM gold) - INTERVAL 2 HOUR""",
    "partition_key_modes": """SELECT event_id, strftime(coalesce(TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'soon'
        WHEN event_id % 7 <> 0 THEN CAST(ts AS VARCHAR) END AS TIMESTAMP), TIMESTAMP '2024-02-01 03:04:05'),
        'year=%Y/month=%m/day=%d/hour=%H') AS by_message_time,
      'year=2024/month=02/day=01/hour=03' AS by_processing_time FROM readings""",
    "union_by_name": f"""SELECT event_id, round(temperature,6) AS temperature, CAST(NULL AS DOUBLE) AS humidity FROM readings
      WHERE ts < {_SPLIT} UNION ALL SELECT event_id, NULL, round(humidity,6) FROM readings WHERE ts >= {_SPLIT}""",
    "parse_envelopes": """SELECT event_id, envelope, TRY_CAST(json_extract_string(doc,'$.pressure') AS DOUBLE) AS pressure
      FROM docs""",
    "parse_flat_nested": "SELECT event_id, layout, device_id, version, gas_resistance FROM parsed",
    "missing_fields": "SELECT event_id, missing FROM parsed",
    "bronze_parse": f"SELECT event_id, {_ROUND_SILVER} FROM parsed WHERE reason = 'valid'",
    "ingest_quality": "SELECT reason, count(*) AS messages FROM parsed GROUP BY reason",
    "alias_fields": f"""SELECT event_id, {_alias_status()} AS status,
      {', '.join(f"round({_alias(n, a)},6) AS {n}" for n, a in zip(_S, 'THPG'))} FROM scorer_docs""",
    "silver_nulls": "SELECT event_id, copy_no, round(humidity,6) AS humidity FROM nonnull",
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM bronze" for c in [*_S, "ts"]
    ),
    "silver_valid": "SELECT event_id, copy_no, round(pressure,6) AS pressure FROM valid",
    "range_violations": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} < {lo} OR {c} > {hi}) AS out_of_range FROM nonnull"
        for c, lo, hi in zip(_S, (0, 0, 800, 100), (85, 100, 1200, 500000))
    ),
    "silver_dedup": f"SELECT event_id, copy_no, ts, device_id, {_ROUND_SILVER} FROM clean",
    "quality_metrics": """SELECT total_in, clean_rows, clean_out, total_in - clean_rows AS dropped,
      round(clean_rows/total_in,6) AS quality_score, clean_rows/total_in < 0.8e0 AS low_quality FROM (
      SELECT (SELECT count(*) FROM bronze) AS total_in, (SELECT count(*) FROM valid) AS clean_rows,
        (SELECT count(*) FROM clean) AS clean_out)""",
    "iaq_v1": "SELECT event_id, iaq_score FROM fixed55",
    "iaq_v2": f"SELECT event_id, {_iaq2('gas_resistance', 'humidity')} AS iaq_v2 FROM readings",
    "air_label": f"""SELECT {_LABEL} AS label, count(*) AS rows, min(i) AS low, max(i) AS high
      FROM (SELECT CAST(event_id % 351 AS INTEGER) AS i FROM events) GROUP BY 1""",
    "score_band": f"""SELECT {_BAND} AS band, count(*) AS rows, round(min(d),6) AS low
      FROM (SELECT (event_id % 61 - 50)/200e0 AS d FROM events) GROUP BY 1""",
    "factor_arrays": f"SELECT event_id, {_factors('t', 'h', 'g')} AS factors FROM spread",
    "correlation_rules": f"""SELECT event_id, {_rule('t', 'h', 'p', 'g', _TYPES)} AS anomaly_type,
      {_rule('t', 'h', 'p', 'g', _GRADES)} AS severity FROM spread""",
    "rule_override": f"""SELECT event_id, event_id % 2 = 0 OR a IN ('FIRE_RISK','CHEMICAL_VOC') AS is_anomaly,
      CASE WHEN event_id % 2 = 0 AND a = 'NORMAL' THEN 'STATISTICAL_ANOMALY' ELSE a END AS anomaly_type,
      CASE WHEN event_id % 2 = 0 AND a = 'NORMAL' THEN 'MEDIUM' ELSE s END AS severity FROM (
      SELECT event_id, {_rule('t', 'h', 'p', 'g', _TYPES)} AS a, {_rule('t', 'h', 'p', 'g', _GRADES)} AS s FROM spread)""",
    "score_readings": f"""SELECT event_id, d < 0 OR a IN ('FIRE_RISK','CHEMICAL_VOC') AS is_anomaly,
      CASE WHEN d < 0 AND a = 'NORMAL' THEN 'STATISTICAL_ANOMALY' ELSE a END AS anomaly_type,
      CASE WHEN d < 0 AND a = 'NORMAL' THEN 'MEDIUM' ELSE s END AS severity, i AS iaq_v2, {_LABEL} AS air_quality,
      contributing_factors, round(d,4) AS decision_score, {_BAND} AS score_meaning FROM (
      SELECT r.event_id, c.score + 0.75e0 AS d, {_iaq2('gas_resistance', 'humidity')} AS i,
        {_factors('temperature', 'humidity', 'gas_resistance')} AS contributing_factors,
        {_rule('temperature', 'humidity', 'pressure', 'gas_resistance', _TYPES)} AS a,
        {_rule('temperature', 'humidity', 'pressure', 'gas_resistance', _GRADES)} AS s
      FROM readings r JOIN challenger_scores c USING (event_id))""",
    "scorer_responses": f"""SELECT event_id, status, CAST(d < 0 OR a IN ('FIRE_RISK','CHEMICAL_VOC') AS VARCHAR) AS is_anomaly,
      CASE WHEN d < 0 AND a = 'NORMAL' THEN 'STATISTICAL_ANOMALY' ELSE a END AS anomaly_type,
      CASE WHEN d < 0 AND a = 'NORMAL' THEN 'MEDIUM' ELSE s END AS severity, CAST(i AS VARCHAR) AS iaq_score, {_LABEL} AS air_quality,
      contributing_factors, round(d,4) AS decision_score, {_BAND} AS score_meaning, CAST(NULL AS VARCHAR) AS error FROM (
      SELECT event_id, status, d, {_iaq2('g', 'h')} AS i, {_factors('t', 'h', 'g')} AS contributing_factors,
        {_rule('t', 'h', 'p', 'g', _TYPES)} AS a, {_rule('t', 'h', 'p', 'g', _GRADES)} AS s
      FROM scorer_values JOIN scorer_scores USING (event_id) WHERE status = 200)
      UNION ALL SELECT event_id, status, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'unusable_field:' || CASE
        WHEN t IS NULL THEN 'temperature' WHEN h IS NULL THEN 'humidity' WHEN p IS NULL THEN 'pressure' ELSE 'gas_resistance' END
      FROM scorer_values WHERE status <> 200""",
    "ratio_features": """SELECT event_id, round(temperature/(humidity+1e-6),6) AS temp_humidity_ratio,
      round(gas_resistance/(pressure+1e-6),6) AS gas_pressure_ratio FROM readings""",
    "time_features": """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts)-1 AS INTEGER) AS day_of_week,
      CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend FROM readings""",
    "parse_ts": """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 2 = 0 THEN date_trunc('second', ts)
      ELSE ts END AS event_ts FROM readings""",
    "clip_values": "SELECT event_id, round(least(greatest(temperature,28e0),33e0),6) AS temperature FROM readings",
    "domain_label": "SELECT event_id, is_anomaly FROM labelled",
    "label_rate_preview": f"""SELECT count(*) AS total, CAST(sum(y) AS BIGINT) AS anomalies, round(avg(y),6) AS anomaly_rate,
      CASE WHEN avg(y)=0 THEN 'none' WHEN avg(y)>0.2e0 THEN 'frequent' WHEN avg(y)<0.01e0 THEN 'rare' ELSE 'ok' END AS band
      FROM (SELECT {_any_rule('iaq_score', ('150e0', '32e0', '29.5e0', '68e0', '62e0'))} AS y FROM fixed55)""",
    "scale_features": "SELECT event_id, " + ", ".join(
        f"round(({c} - avg({c}) OVER ())/stddev_pop({c}) OVER (), 6) AS {c}_scaled" for c in _S) + " FROM readings",
    "gas_baseline": """SELECT round(CASE WHEN count(*) >= 10 THEN quantile_cont(gas_resistance,0.75) ELSE 80000e0 END,6)
      AS gas_baseline FROM readings""",
    "silver_iaq": """SELECT event_id, copy_no, round(gas_baseline,6) AS gas_baseline, round(iaq_score,6) AS iaq_score
      FROM scored""",
    "gas_summary": """SELECT min(gas_resistance) AS gas_min, max(gas_resistance) AS gas_max,
      round(avg(gas_resistance),6) AS gas_mean FROM readings""",
    "sensor_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(min({c}),6) AS min, round(avg({c}),6) AS mean, round(max({c}),6) AS max,
        round(quantile_cont({c},0.02),6) AS p02, round(quantile_cont({c},0.98),6) AS p98 FROM scored"""
        for c in [*_S, "iaq_score"]),
    "anomaly_rate": """SELECT count(*) AS total, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
      round(avg(is_anomaly),6) AS anomaly_rate, CASE WHEN avg(is_anomaly)=0 THEN 'none' WHEN avg(is_anomaly)>0.2e0
      THEN 'frequent' WHEN avg(is_anomaly)<0.01e0 THEN 'rare' ELSE 'ok' END AS band FROM labelled""",
    "rule_breakdown": " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER ({t}) AS matches FROM scored"
        for n, t in {"iaq_high": "iaq_score > 150", "temperature_high": "temperature > 33",
                     "temperature_low": "temperature < 28", "humidity_high": "humidity > 70",
                     "humidity_low": "humidity < 60"}.items()),
    "rolling_mean": _rolled("ts, event_id", "PARTITION BY device_id", ("mean",)),
    "rolling_std": _rolled("ts, event_id", "PARTITION BY device_id", ("std",)),
    "rolling_global": _rolled("ts, event_id", "", ("mean", "std")),
    "rolling_device_blocks": _rolled("ts, event_id", "PARTITION BY device_id", ("mean",)),
    "describe_distribution": "SELECT side, feature, count, " + ", ".join(
        f"round({c},6) AS {c}" for c in ("mean", "std", "min", "p05", "p25", "median", "p75", "p95", "max")) + " FROM describe_",
    "feature_summary": """SELECT side, feature, round(avg(x),6) AS mean, round(stddev_samp(x),6) AS std,
      round(min(x),6) AS min, round(max(x),6) AS max FROM long GROUP BY side, feature""",
    "feature_histogram": """SELECT feature, CAST(bin AS INTEGER) AS bin, CAST(e AS BIGINT) AS reference,
      CAST(a AS BIGINT) AS production FROM hist""",
    "psi": "SELECT feature, round(psi,6) AS psi FROM divergence",
    "kl_divergence": "SELECT feature, round(kl,6) AS kl_divergence FROM divergence",
    "ks_statistic": "SELECT feature, round(d,6) AS ks_statistic FROM ks",
    "describe_offset_channel": """SELECT side, count(*) AS count, round(avg(x),6) AS mean, round(stddev_pop(x),6) AS std,
      round(min(x),6) AS min, round(max(x),6) AS max FROM (SELECT 1e5 + (event_id*7919 % 41 - 20)/2000e0 AS x,
      CASE WHEN ts < TIMESTAMP '2024-01-24 00:00:00' THEN 'reference' ELSE 'production' END AS side FROM readings) GROUP BY side""",
    "ks_statistic_ranges": "SELECT feature, round(d,6) AS ks_statistic FROM ks",
    # share of lattice paths inside the band, diagonal by diagonal
    "ks_pvalue_exact": """SELECT c.feature, c.n_e, c.n_a, round(c.d, 6) AS ks_statistic, round(CASE WHEN greatest(c.n_e, c.n_a) > 10000
        THEN least(1e0, greatest(0e0, list_sum(list_transform(range(1,1001), lambda k: 2e0*(CASE WHEN k%2=1 THEN 1e0 ELSE -1e0 END)*exp(-2e0*k*k*d*d*(c.n_e::DOUBLE*c.n_a/(c.n_e+c.n_a)))))))
        WHEN c.gap = 0 THEN 1e0 ELSE least(1e0, greatest(0e0, 1e0 - p.inside[c.n + 1])) END, 6) AS ks_pvalue
      FROM device_ks c LEFT JOIN device_paths p ON p.feature = c.feature AND p.k = c.n + c.m""",
    "ks_pvalue": "SELECT feature, round(p,6) AS ks_pvalue FROM ksp",
    "mean_std_shift": "SELECT feature, mean_shift, std_shift FROM report",
    "drift_features": "SELECT * EXCLUDE (n_ref, n_prod, place) FROM report",
    "drift_summary": "SELECT * FROM summary",
    "retrain_decision": """SELECT model_name, overall_drift, stag IS NOT NULL AS staging_waiting,
      CASE WHEN NOT overall_drift THEN 'no_drift' WHEN stag IS NOT NULL THEN 'wait_for_review' ELSE 'retrain' END AS action
      FROM in_stage, summary""",
    "drift_report_json": """SELECT overall_drift, (SELECT psi FROM report WHERE feature='temperature') AS temperature_psi,
      0.2e0 AS psi_limit FROM summary""",
    "fit_scaler": " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS feature, round(avg({c}),8) AS mean, round(stddev_pop({c}),8) AS scale,
        count(*) AS rows FROM readings""" for i, c in enumerate(_S)),
    "stratified_split": "SELECT event_id, is_anomaly, split FROM splits",
    "split_balance": """SELECT split, count(*) AS rows, CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
      round(avg(is_anomaly),6) AS rate, split='test' AND sum(is_anomaly) < 5 AS few_anomalies FROM splits GROUP BY split""",
    "training_set": f"SELECT {_ROUND_SILVER}, is_anomaly, ts FROM labelled",
    "label_thresholds": """SELECT 150e0 AS iaq_score_max, 33e0 AS temperature_max, 28e0 AS temperature_min,
      70e0 AS humidity_max, 60e0 AS humidity_min, round(avg(is_anomaly),6) AS anomaly_rate FROM labelled""",
    "confusion_matrix": "SELECT model, tn, fp, fn, tp FROM model_cells",
    "confusion_share": """SELECT model, cell, rows, round(rows/sum(rows) OVER (PARTITION BY model),6) AS share FROM (
      UNPIVOT model_cells ON tn, fp, fn, tp INTO NAME cell VALUE rows)""",
    "classification_metrics": """SELECT model, tn, fp, fn, tp, round(accuracy,6) AS accuracy, round(precision,6) AS precision,
      round(recall,6) AS recall, round(f1,6) AS f1, round(anomaly_rate_predicted,6) AS anomaly_rate_predicted,
      round(anomaly_rate_true,6) AS anomaly_rate_true, tp+fn < 10 AS few_anomalies FROM model_rates""",
    "roc_auc": (_AUC := """SELECT round((sum(r) FILTER (y=1) - max(p)*(max(p)+1)/2)/(max(p)*(count(*)-max(p))),6) AS roc_auc
      FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1)/2e0 AS r,
        CAST(sum(y) OVER () AS DOUBLE) AS p FROM auc_rows)"""),
    "roc_auc_ranges": _AUC,
    "score_stats": "SELECT side, mean, std, p50, p95, p99 FROM evaluated",
    "eval_rates": "SELECT side, anomaly_rate_predicted, anomaly_rate_true FROM evaluated",
    "evaluate_models": "SELECT * FROM evaluated",
    "train_test_metrics": """SELECT split, tn, fp, fn, tp, round((tp+tn)/(tp+tn+fp+fn),6) AS accuracy,
      round(CASE WHEN tp+fp=0 THEN 0e0 ELSE tp/(tp+fp) END,6) AS precision,
      round(CASE WHEN tp+fn=0 THEN 0e0 ELSE tp/(tp+fn) END,6) AS recall,
      round(CASE WHEN 2*tp+fp+fn=0 THEN 0e0 ELSE 2*tp/(2*tp+fp+fn) END,6) AS f1,
      round((tp+fp)/(tp+tn+fp+fn),6) AS anomaly_rate_predicted, round((tp+fn)/(tp+tn+fp+fn),6) AS anomaly_rate_true,
      round((pos_rank - p*(p+1)/2)/(p*(n-p)),6) AS roc_auc FROM (
      SELECT split, count(*) FILTER (is_anomaly=0 AND predicted=0) AS tn, count(*) FILTER (is_anomaly=0 AND predicted=1) AS fp,
        count(*) FILTER (is_anomaly=1 AND predicted=0) AS fn, count(*) FILTER (is_anomaly=1 AND predicted=1) AS tp,
        CAST(sum(is_anomaly) AS DOUBLE) AS p, count(*) AS n, sum(r) FILTER (is_anomaly=1) AS pos_rank FROM (
      SELECT split, m.is_anomaly, predicted, rank() OVER (PARTITION BY split ORDER BY outlierness)
        + (count(*) OVER (PARTITION BY split, outlierness) - 1)/2e0 AS r
      FROM model_rows m JOIN splits s USING (event_id) WHERE model='champion') GROUP BY split)""",
    "eval_set": f"""SELECT event_id, {_ROUND_SILVER}, is_anomaly FROM labelled WHERE {_days('2024-01-23', '2024-01-29')}""",
    "forest_score_boxes": "SELECT event_id, round(score,6) AS anomaly_score FROM challenger_scores",
    "anomaly_cutoff": 'SELECT round(quantile_cont(score,0.06),6) AS "offset" FROM challenger_scores',
    "gold": """SELECT event_id, copy_no, round(anomaly_score,6) AS anomaly_score, round(decision_score,6) AS decision_score,
      prediction, is_anomaly FROM gold""",
    "gold_rate": """SELECT count(*) AS total_records, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count,
      round(avg(is_anomaly),6) AS anomaly_rate FROM gold""",
    "anomaly_extract": """SELECT strftime(ts,'%Y-%m-%dT%H:%M:%S') AS timestamp, device_id, round(temperature,6) AS temperature,
      round(humidity,6) AS humidity, round(iaq_score,6) AS iaq_score, round(anomaly_score,6) AS anomaly_score
      FROM gold WHERE is_anomaly=1""",
    "alert_top5": """SELECT event_id, ts, device_id, round(temperature,6) AS temperature, round(iaq_score,6) AS iaq_score,
      round(anomaly_score,6) AS anomaly_score FROM gold WHERE is_anomaly=1 ORDER BY ts, event_id LIMIT 5""",
    "hourly_anomaly_rate": """SELECT date_trunc('hour',ts) AS hour_start, count(*) AS total,
      CAST(sum(is_anomaly) AS BIGINT) AS anomalies, round(avg(is_anomaly),6) AS rate FROM gold GROUP BY 1""",
    "latest_by_stage": "SELECT model_name, stage, version, run_id FROM ranked_versions WHERE rn = 1",
    "champion_fallback": """SELECT f.model_name, f.stag AS challenger_version, f.version AS champion_version,
      v.stage AS champion_stage, v.run_id AS champion_run_id FROM fallback f JOIN versions v USING (model_name, version)""",
    "champion_challenger": """SELECT i.model_name, CAST(coalesce(i.prod, f.version) AS VARCHAR) AS champion_version,
      CAST(i.stag AS VARCHAR) AS challenger_version, i.prod IS NULL AND f.version IS NOT NULL AS used_fallback,
      CASE WHEN i.stag IS NULL THEN 'no_staging' WHEN coalesce(i.prod, f.version) IS NULL THEN 'single_version'
        WHEN coalesce(i.prod, f.version) = i.stag THEN 'same_version'
        WHEN i.stag < coalesce(i.prod, f.version) THEN 'challenger_not_newer' ELSE 'ok' END AS status
      FROM in_stage i LEFT JOIN fallback f USING (model_name)""",
    "usable_model": """SELECT model_name, CAST(version AS VARCHAR) AS version, stage, CASE WHEN status='ok' THEN 'r' || CAST(version AS VARCHAR)
        WHEN status='artifact_mismatch' THEN 'r' || CAST(artifact_version AS VARCHAR) END AS run_id, status FROM (
      SELECT i.model_name, coalesce(prod, stag) AS version, artifact_version,
        CASE WHEN prod IS NOT NULL THEN 'Production' WHEN stag IS NOT NULL THEN 'Staging' END AS stage,
        CASE WHEN coalesce(prod, stag) IS NULL THEN 'no_model' WHEN artifact_version IS NULL THEN 'no_artifact'
          WHEN artifact_version <> coalesce(prod, stag) THEN 'artifact_mismatch' ELSE 'ok' END AS status
      FROM in_stage i LEFT JOIN artifacts a USING (model_name))""",
    "registration_gate": """SELECT run_id, failed, failed='' AS registered,
      CASE WHEN failed='' THEN 'register_model' ELSE 'skip_registration' END AS branch FROM (
      SELECT run_id, concat_ws(',', CASE WHEN roc_auc < 0.75e0 THEN 'roc_auc' END,
        CASE WHEN precision < 0.60e0 THEN 'precision' END, CASE WHEN recall < 0.50e0 THEN 'recall' END) AS failed FROM runs)""",
    "stage_assignment": """SELECT c.model_name, c.version, c.run_id, CASE WHEN EXISTS (SELECT 1 FROM versions o
        WHERE o.version % 2 = 0 AND o.stage='Production' AND o.model_name=c.model_name) OR EXISTS (SELECT 1 FROM versions o
        WHERE o.version % 2 = 1 AND o.version < c.version AND o.model_name=c.model_name) THEN 'Staging'
        ELSE 'Production' END AS stage FROM versions c WHERE c.version % 2 = 1""",
    "version_metrics": """SELECT v.run_id, model_name, version, stage,
      coalesce(CAST(training_date AS VARCHAR),'unknown') AS training_date, round(roc_auc,6) AS roc_auc,
      round(precision,6) AS precision, round(recall,6) AS recall, round(f1,6) AS f1
      FROM versions v LEFT JOIN runs r USING (run_id)""",
    "metric_deltas": """SELECT metric, champion, challenger, round(challenger-champion,4) AS delta,
      CASE WHEN round(challenger-champion,4)>0 THEN 'challenger' WHEN round(challenger-champion,4)=0 THEN 'equal'
        ELSE 'champion' END AS better FROM deltas""",
    "weighted_score": f"""SELECT day, matchup, {_half_up('sa')} AS champion_score, {_half_up('sb')} AS challenger_score,
      ds AS score_delta FROM points""",
    "risk_points": "SELECT day, matchup, analysis_points, risk_points FROM points",
    "verdict": "SELECT day, matchup, verdict, confidence, reason FROM verdicts",
    "recommendation": f"""SELECT day, matchup, {_half_up('sa')} AS champion_score, {_half_up('sb')} AS challenger_score,
      ds AS score_delta, analysis_points, risk_points, verdict, confidence, reason,
      'recall=0.40,roc_auc=0.35,precision=0.15,f1=0.10' AS weights_used FROM verdicts""",
    "importance_compare": """SELECT feature, round(max(importance) FILTER (side='champion'),6) AS champion,
      round(coalesce(max(importance) FILTER (side='challenger' AND feature IN ('temperature','humidity')),0e0),6) AS challenger
      FROM importance GROUP BY feature""",
    "latest_drift_context": """SELECT side, recall, run_ts, production_count, overall_drift FROM evaluated, (
      SELECT strftime(ts, '%Y-%m-%d') AS run_ts, count(*) AS production_count, avg(temperature) > 31.4e0 AS overall_drift
      FROM readings GROUP BY 1 ORDER BY 1 DESC LIMIT 1)""",
    "comparison_summary": """SELECT '2024-01-31 00:00 UTC' AS generated_at, champion AS champion_recall,
      challenger AS challenger_recall, round(challenger-champion,4) AS recall_delta,
      CASE WHEN challenger-champion < -0.03e0 THEN 'KEEP' ELSE 'PROMOTE' END AS verdict, 'HIGH' AS confidence
      FROM deltas WHERE metric='recall'""",
    "report_metadata": """SELECT i.model_name, x.side, x.version, v.stage,
      coalesce(CAST(r.training_date AS VARCHAR),'unknown') AS training_date, round(r.roc_auc,6) AS roc_auc,
      round(r.precision,6) AS precision, round(r.recall,6) AS recall, round(r.f1,6) AS f1 FROM (
      SELECT model_name, prod AS c, stag FROM in_stage WHERE prod IS NOT NULL AND stag > prod
      UNION ALL SELECT model_name, version, stag FROM fallback WHERE stag > version) i,
      LATERAL (VALUES ('champion', i.c), ('challenger', i.stag)) AS x(side, version)
      JOIN versions v ON v.version = x.version LEFT JOIN runs r ON r.run_id = v.run_id""",
    "report_tables": """SELECT 'metrics' AS section, item, champion, challenger, round(challenger-champion,4) AS delta FROM (
        SELECT item, max(v) FILTER (side='champion') AS champion, max(v) FILTER (side='challenger') AS challenger FROM (
        UNPIVOT (SELECT side, roc_auc, precision, recall, f1, accuracy, anomaly_rate_predicted FROM evaluated)
        ON roc_auc, precision, recall, f1, accuracy, anomaly_rate_predicted INTO NAME item VALUE v) GROUP BY item)
      UNION ALL SELECT 'confusion', item, champion, challenger, round(challenger-champion,4) FROM (
        SELECT item, max(v) FILTER (side='champion') AS champion, max(v) FILTER (side='challenger') AS challenger FROM (
        UNPIVOT (SELECT side, CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn,
          CAST(tp AS DOUBLE) AS tp FROM evaluated) ON tn, fp, fn, tp INTO NAME item VALUE v) GROUP BY item)
      UNION ALL SELECT 'score_stats', item, champion, challenger, round(challenger-champion,4) FROM (
        SELECT item, max(v) FILTER (side='champion') AS champion, max(v) FILTER (side='challenger') AS challenger FROM (
        UNPIVOT (SELECT side, mean, std, p50, p95, p99 FROM evaluated) ON mean, std, p50, p95, p99
        INTO NAME item VALUE v) GROUP BY item)
      UNION ALL SELECT 'importance', feature, a, b, round(b-a,4) FROM (
        SELECT feature, max(round(importance,4)) FILTER (side='champion') AS a,
          max(round(importance,4)) FILTER (side='challenger') AS b FROM importance GROUP BY feature)
      UNION ALL SELECT 'drift', feature || '.' || m, NULL, v, NULL FROM (
        UNPIVOT (SELECT feature, psi, kl_divergence, ks_pvalue, mean_shift FROM report)
        ON psi, kl_divergence, ks_pvalue, mean_shift INTO NAME m VALUE v)""",
}


_CTES |= forest_sql.CTES
_BODIES |= forest_sql.BODIES


def oracle_sql() -> dict[str, str]:
    return {name: _sql(body) for name, body in _BODIES.items()}
