"""The queries as SQL on the natural keys' text, where the operators use hashes."""

from __future__ import annotations

from sparkrekey.plans.fixtures import cte, values

_EOT = "TIMESTAMP '9999-12-31'"
_LC = "lc AS (SELECT old_sk, upper(trim(nk, ' ')) AS k FROM legacy_customer)"
_TC = "tc AS (SELECT new_sk, upper(trim(nk, ' ')) AS k FROM target_customer)"
_FILLED = f"{_LC}, {_TC}, f AS (SELECT o.*, t.k, t.new_sk FROM fact_orders o LEFT JOIN lc l ON l.old_sk = o.fk LEFT JOIN tc t ON t.k = l.k)"
_FILLED_A = "fa AS (SELECT o.*, t.nk AS k, t.s AS version, t.new_sk FROM fact_a o LEFT JOIN legacy_a l ON l.old_sk = o.fk LEFT JOIN target_a t ON t.nk = l.nk AND t.s = l.s)"
_HIT = f"l.s < coalesce(t.e, {_EOT}) AND t.s < coalesce(l.e, {_EOT})"
_MAP_B = f"""mb AS (SELECT l.nk AS natural_key, coalesce(t.s, l.s) AS effectiveStartDate, t.e AS effectiveEndDate, l.old_sk, t.new_sk,
  CASE WHEN t.new_sk IS NULL THEN 'ORPHAN_OLD' WHEN count(t.new_sk) OVER (PARTITION BY l.old_sk) > 1 THEN 'AMBIGUOUS' ELSE 'MATCHED' END AS map_status
  FROM legacy_b l LEFT JOIN target_b t ON l.nk = t.nk AND {_HIT}
  UNION ALL SELECT nk, s, e, NULL, new_sk, 'ORPHAN_NEW' FROM target_b WHERE nk NOT IN (SELECT nk FROM legacy_b))"""
_FILLED_B = f"{_MAP_B}, fb AS (SELECT o.*, m.natural_key AS k FROM fact_b o LEFT JOIN (SELECT DISTINCT old_sk, natural_key FROM mb WHERE map_status IN ('MATCHED', 'AMBIGUOUS')) m ON m.old_sk = o.fk)"
_HITS_B = f"hb AS (SELECT fb.o_orderkey, fb.l_linenumber, fb.fk, fb.k, fb.event, count(t.new_sk) AS n, max(t.new_sk) AS new_sk FROM fb LEFT JOIN target_b t ON t.nk = fb.k AND fb.event >= t.s AND fb.event < coalesce(t.e, {_EOT}) GROUP BY ALL)"
_STATUS = "CASE WHEN {l} IS NOT NULL AND {t} IS NOT NULL THEN 'MATCHED' WHEN {l} IS NOT NULL THEN 'ORPHAN_OLD' ELSE 'ORPHAN_NEW' END"
_PATH_A = "SELECT coalesce(t.nk, l.nk) AS natural_key, coalesce(t.s, l.s) AS effectiveStartDate, t.e AS effectiveEndDate, l.old_sk, t.new_sk, " + _STATUS.format(l="l.nk", t="t.nk") + " AS map_status FROM legacy_a l FULL JOIN target_a t ON l.nk = t.nk AND l.s = t.s"
_VERDICT = "SELECT '{name}' AS check_name, count(*)::BIGINT AS violations, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict"
_GATE = "SELECT '{name}' AS gate, count(*)::BIGINT AS violations, count(*) = 0 AS passed FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1)"
_FMT = "strftime({c}, '%Y-%m-%d{t}')"
_DIAGNOSTIC = """d_{p} AS (SELECT CASE WHEN l.nk IS NOT NULL AND t.nk IS NOT NULL THEN 'MATCHED' WHEN l.nk IS NOT NULL THEN 'ONLY_LEGACY' ELSE 'ONLY_TARGET' END AS status
  FROM (SELECT DISTINCT nk, s FROM legacy_{p}) l FULL JOIN (SELECT DISTINCT nk, s FROM target_{p}) t ON l.nk = t.nk AND l.s = t.s),
e_{p} AS (SELECT '{p}' AS pair, status, count(*)::BIGINT AS version_rows, round((SELECT count(*) FILTER (status = 'MATCHED') / count(*) FILTER (status <> 'ONLY_TARGET') FROM d_{p}), 9) AS matched_pct FROM d_{p} GROUP BY status)"""
_OVERLAP = "SELECT '{name}' AS gate, count(DISTINCT a.nk)::BIGINT AS violations, count(DISTINCT a.nk) = 0 AS passed FROM {t} a JOIN {t} b ON a.nk = b.nk AND a.new_sk < b.new_sk AND a.s < coalesce(b.e, " + _EOT + ") AND b.s < coalesce(a.e, " + _EOT + ")"
_SWEPT = "CASE WHEN k IS NOT NULL AND fk <> new_sk THEN new_sk ELSE fk END"


def _rows(body: str, *names: str) -> str:
    return "WITH " + ", ".join(values(n) for n in names) + "\n" + body


def _sql(body: str, *parts: str) -> str:
    return ",\n".join([cte(), *parts]) + "\n" + body


ORACLES = {
    "normalize_nk": _sql(f"SELECT up, o_custkey::VARCHAR || '||' || {_FMT.format(c='s', t='')} || '||' || coalesce({_FMT.format(c='e', t=' %H:%M:%S')}, '~NULL~') AS natural_key FROM versions"),
    "normalize_nk_lenient": _sql("SELECT new_sk, upper(trim(nk, ' ')) || '||' || upper(trim(coalesce(status, ''), ' ')) AS natural_key FROM target_customer"),
    "status_class": _sql("SELECT new_sk, CASE WHEN upper(trim(status, ' ')) IN ('D', 'DEL', 'DELETED', 'LOGICALLY_DELETED') THEN 'DELETED' ELSE 'ACTIVE' END AS status_class FROM target_customer"),
    "provider_hash": _sql("SELECT t.new_sk, l.old_sk FROM tc t LEFT JOIN lc l ON t.new_sk % 2 <> 0 AND l.k = t.k", _LC, _TC),
    "gate_collision": _sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, 'hash_collision' AS gate, count(*)::BIGINT AS violations, count(*) = 0 AS passed FROM (SELECT 1 FROM {t} GROUP BY {h} HAVING count(DISTINCT k) > 1)" for n, t, h in (("legacy", "lc", "k"), ("target", "tc", "k"), ("planted", "tc", "regexp_replace(k, '[0-9]$', '')"))), _LC, _TC),
    "snapshot_scd1": _sql("SELECT old_sk, k AS natural_key FROM lc", _LC),
    "snapshot_scd2": _sql("SELECT old_sk, nk AS natural_key, s, e, 'ACTIVE' AS status_class FROM legacy_a"),
    "keymap_scd1": _sql("SELECT coalesce(t.k, l.k) AS natural_key, l.old_sk, t.new_sk, " + _STATUS.format(l="l.k", t="t.k") + " AS map_status FROM lc l FULL JOIN tc t ON l.k = t.k", _LC, _TC),
    "keymap_path_a": _sql(_PATH_A),
    "keymap_path_a_tiebreak": _sql(_PATH_A + " AND (l.nk::BIGINT % 5 = 0) = (t.nk::BIGINT % 10 = 0)"),
    "keymap_path_b": _sql("SELECT * FROM mb", _MAP_B),
    "keymap_pairwise": _sql(
        "SELECT coalesce(s.k, t.k) AS natural_key, s.old_sk, t.new_sk, coalesce(s.n, 0)::BIGINT AS source_row_count, coalesce(t.n, 0)::BIGINT AS target_row_count, CASE WHEN coalesce(s.n, 0) > 1 OR coalesce(t.n, 0) > 1 THEN 'DUPLICATE' ELSE "
        + _STATUS.format(l="s.old_sk", t="t.new_sk") + " END AS map_status FROM s FULL JOIN t ON s.k = t.k AND s.i = t.i",
        *(f"{a} AS (SELECT *, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY {sk}) AS i FROM (SELECT {sk}, upper(trim(regexp_replace(trim(lower(nk), ' '), '[0-9]$', ''), ' ')) AS k FROM {t}))" for a, sk, t in (("s", "old_sk", "legacy_customer"), ("t", "new_sk", "target_customer"))),
    ),
    "keymap_audit": _sql("SELECT map_status, count(*)::BIGINT AS cnt, round(count(*) / sum(count(*)) OVER (), 9) AS share, map_status = 'ORPHAN_OLD' AND count(*) / sum(count(*)) OVER () > 0.01 AS warning FROM mb GROUP BY map_status", _MAP_B),
    "version_diagnostic": _sql("SELECT *, CASE WHEN matched_pct >= 0.99 THEN 'A' ELSE 'B' END AS suggested_path FROM (SELECT * FROM e_a UNION ALL SELECT * FROM e_b)", _DIAGNOSTIC.format(p="a"), _DIAGNOSTIC.format(p="b")),
    "gate_scd1_unique": _sql(_GATE.format(name="nk_hash_unique", table="tc", keys="k"), _TC),
    "gate_nk_start": _sql(_GATE.format(name="nk_start_unique", table="fact_orders", keys="fk, event")),
    "gate_nk_start_status": _sql(_GATE.format(name="nk_start_status_unique", table="fact_orders", keys="fk, event, o_orderkey % 2")),
    "gate_ver_unique": _sql(_GATE.format(name="ver_hash_unique", table="target_a", keys="nk, s")),
    "overlap_gate": _sql(_OVERLAP.format(name="window_overlap", t="late") + " UNION ALL " + _OVERLAP.format(name="window_overlap_plain", t="target_b"), "late AS (SELECT new_sk, nk, s, CASE WHEN nk::BIGINT % 7 = 0 THEN e + INTERVAL 400 DAY ELSE e END AS e FROM target_b)"),
    "discover_consumers": _rows("SELECT c.table_name AS consumer_table, c.column_name AS fk_col, p.provider_table, h.effective_start_col AS event_date_col FROM catalogue c JOIN providers p ON lower(c.column_name) = lower(p.sk_col) AND lower(c.table_name) <> lower(p.provider_table) LEFT JOIN providers h ON h.archetype = 'HUB_SCD2' AND lower(h.provider_table) = lower(c.table_name) WHERE NOT EXISTS (SELECT 1 FROM registered r WHERE lower(r.consumer_table) = lower(c.table_name) AND lower(r.fk_col) = lower(c.column_name))", "catalogue", "providers", "registered"),
    "discover_edge_cases": _rows("SELECT p.provider_table, p.sk_col, c.table_name AS candidate_table, c.column_name AS candidate_column, 'REVIEW' AS status FROM catalogue c JOIN (SELECT *, regexp_replace(regexp_replace(lower(sk_col), '^(key|sk|id)_?', ''), '_?(key|sk|id)$', '') AS stem FROM providers) p ON length(stem) >= 4 AND contains(lower(c.column_name), stem) AND regexp_matches(lower(c.column_name), '(^|_)(key|sk|id)|(key|sk|id)$') AND lower(c.column_name) <> lower(p.sk_col) AND lower(c.table_name) <> lower(p.provider_table) WHERE NOT EXISTS (SELECT 1 FROM registered r WHERE lower(r.consumer_table) = lower(c.table_name) AND lower(r.fk_col) = lower(c.column_name))", "catalogue", "providers", "registered"),
    "detect_sk": _sql("SELECT count(new_sk)::BIGINT AS keys, max(new_sk) AS largest FROM target_customer"),
    "classify_evidence": _sql(
        "SELECT consumer_table, map_status, cnt, CASE WHEN 1 - o >= 0.95 THEN 'LEGACY_KEYED?' WHEN o >= 0.95 THEN 'RELOADED?' ELSE 'MIXED?' END AS suggested FROM (SELECT *, coalesce(sum(cnt) FILTER (map_status = 'NOT_IN_LEGACY_DIM') OVER (PARTITION BY consumer_table), 0) / sum(cnt) OVER (PARTITION BY consumer_table) AS o FROM n)",
        _LC, _TC, "n AS (SELECT consumer_table, CASE WHEN l.k IS NULL THEN 'NOT_IN_LEGACY_DIM' WHEN t.k IS NULL THEN 'ORPHAN_OLD' ELSE 'MATCHED' END AS map_status, count(*)::BIGINT AS cnt FROM (SELECT 'fact_orders' AS consumer_table, fk FROM fact_orders UNION ALL SELECT 'fact_mixed', fk FROM fact_mixed) f LEFT JOIN lc l ON l.old_sk = f.fk LEFT JOIN tc t ON t.k = l.k GROUP BY ALL)",
    ),
    "populate_legacy_scd1": _sql("SELECT o_orderkey, fk, k AS resolved FROM f", _FILLED),
    "populate_path_a": _sql("SELECT o_orderkey, fk, version, k IS NOT NULL AS member FROM fa", _FILLED_A),
    "populate_path_b": _sql("SELECT o_orderkey, l_linenumber, fk, k AS resolved FROM fb", _FILLED_B),
    "populate_reloaded": _sql("SELECT o_orderkey, fk, k AS resolved FROM fact_reloaded LEFT JOIN tc ON new_sk = fk", _TC),
    "validate_coverage": _sql("SELECT 'coverage_null_hash' AS check_name, count(*)::BIGINT AS violations, 'INFO' AS verdict FROM f WHERE k IS NULL", _FILLED),
    "validate_member_ri": _sql(_VERDICT.format(name="member_ri") + " FROM f WHERE new_sk % 100 = 5", _FILLED),
    "validate_version_ri_a": _sql(_VERDICT.format(name="version_ri_pathA") + " FROM fa WHERE new_sk % 100 = 5", _FILLED_A),
    "validate_ver_coverage": _sql(_VERDICT.format(name="ver_hash_coverage") + " FROM fa WHERE k IS NOT NULL AND version IS NULL", _FILLED_A),
    "validate_version_ri_b": _sql(_VERDICT.format(name="version_ri_pathB_window") + " FROM hb WHERE k IS NOT NULL AND n = 0", _FILLED_B, _HITS_B),
    "validate_event_nulls": _sql(_VERDICT.format(name="event_date_nulls") + " FROM fb WHERE k IS NOT NULL AND o_orderkey % 10 = 0", _FILLED_B),
    "validate_exactly_one_window": _sql("SELECT CASE n WHEN 0 THEN 'none' WHEN 1 THEN 'one' ELSE 'several' END AS windows, count(*)::BIGINT AS cnt FROM hb WHERE k IS NOT NULL GROUP BY 1", _FILLED_B, _HITS_B),
    "measure_recon": _sql(_VERDICT.format(name="measure_reconciliation") + " FROM (SELECT 1 FROM f WHERE k IS NOT NULL GROUP BY k HAVING count(*) FILTER (o_orderkey % 997 = 0) > 0)", _FILLED),
    "hub_consistency": _sql("SELECT count(*) FILTER (k IS NULL OR o_orderkey % 3 = 0)::BIGINT AS unresolved, count(*) FILTER ((k IS NULL) <> (o_orderkey % 3 = 0))::BIGINT AS partly FROM f", _FILLED),
    "sweep_order": _rows("SELECT row_number() OVER (ORDER BY level, consumer_table, fk_col) AS position, * FROM (SELECT consumer_table, fk_col, coalesce(topo_level, 1000000)::BIGINT AS level FROM roles LEFT JOIN hubs h ON lower(h.provider_table) = lower(consumer_table))", "roles", "hubs"),
    "sweep_gate": _rows("SELECT reason, count(*) AS cnt FROM (SELECT 'failed' AS reason FROM last JOIN roles USING (consumer_table, fk_col) WHERE verdict = 'FAIL' UNION ALL SELECT 'not validated' FROM roles ANTI JOIN last USING (consumer_table, fk_col)) GROUP BY 1", "results", "roles").replace("\nSELECT", ", last AS (SELECT * FROM results WHERE run_id = (SELECT arg_max(run_id, run_at) FROM results))\nSELECT", 1),
    "sweep_scd1": _sql(f"SELECT o_orderkey, {_SWEPT} AS fk FROM f", _FILLED),
    "sweep_path_a": _sql(f"SELECT o_orderkey, {_SWEPT} AS fk FROM fa", _FILLED_A),
    "sweep_path_b": _sql("SELECT o_orderkey, l_linenumber, CASE WHEN n = 1 AND k IS NOT NULL THEN new_sk ELSE fk END AS fk FROM hb", _FILLED_B, _HITS_B),
    "sweep_multi_role": _sql("SELECT f.o_orderkey, CASE WHEN f.k IS NULL THEN -1 ELSE f.new_sk END AS fk, CASE WHEN tc.k IS NULL THEN -1 ELSE r.fk END AS fk2 FROM f JOIN fact_reloaded r USING (o_orderkey) LEFT JOIN tc ON tc.new_sk = r.fk", _FILLED),
    "sweep_idempotent": _sql(f"SELECT o_orderkey, {_SWEPT} AS fk FROM f", _FILLED),
    "sweep_metrics": _sql("SELECT count(*) FILTER (k IS NOT NULL AND fk <> new_sk)::BIGINT AS rows_updated, count(*)::BIGINT AS rows FROM f", _FILLED),
    "orphan_assign": _sql("SELECT o_orderkey, CASE WHEN k IS NULL THEN -1 ELSE new_sk END AS fk FROM f", _FILLED),
    "post_sweep_ri": _sql(f"{_VERDICT.format(name='sk_ri')} FROM g WHERE fk NOT IN (SELECT new_sk FROM target_customer) UNION ALL {_VERDICT.format(name='unresolved_hash')} FROM g WHERE k IS NULL", _FILLED, f"g AS (SELECT o_orderkey, k, {_SWEPT} AS fk FROM f)"),
    "promote_merge": _sql(f"SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 4 THEN {_SWEPT} ELSE fk END AS fk, price, CASE WHEN o_orderkey % 10 <> 4 THEN k IS NOT NULL END AS resolved FROM f", _FILLED),
    "promote_drift": _sql("SELECT o_orderkey FROM fact_orders WHERE o_orderkey % 10 = 4"),
    "promote_swap": _sql(f"SELECT o_orderkey, {_SWEPT} AS fk, fk AS old FROM f", _FILLED),
    "promote_view": _sql(f"SELECT o_orderkey, {_SWEPT} AS fk FROM f", _FILLED),
    "asof_lookup": _sql(f"SELECT o_orderkey, new_sk FROM fact_orders o LEFT JOIN target_b t ON t.nk = (o.fk - 1)::VARCHAR AND o.event >= t.s AND o.event < coalesce(t.e, {_EOT})"),
    "overlap_lookup": _sql(f"SELECT l.old_sk, t.new_sk FROM legacy_b l JOIN target_b t ON l.nk = t.nk AND {_HIT}"),
    "registry_review": _rows("SELECT r.*, p.archetype FROM roles r LEFT JOIN providers p ON lower(p.provider_table) = lower(r.provider_table)", "roles", "providers"),
    "keymap_policy": _sql(
        "SELECT 'customer' AS provider_table, 'none-scd1' AS version_match, map_status, count(*) AS cnt FROM (SELECT " + _STATUS.format(l="l.k", t="t.k") + " AS map_status FROM lc l FULL JOIN tc t ON l.k = t.k) GROUP BY map_status UNION ALL SELECT 'version', 'B-event-date', map_status, count(*) FROM mb GROUP BY map_status",
        _LC, _TC, _MAP_B,
    ),
    "validate_battery": _sql(
        "SELECT 'r1' AS run_id, c.*, CASE WHEN check_name = 'coverage_null_hash' THEN 'INFO' WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM checks c",
        _FILLED, _FILLED_B, _HITS_B,
        """checks AS (SELECT 'fact' AS consumer_table, 'new_sk' AS fk_col, 'coverage_null_hash' AS check_name, count(*) FILTER (k IS NULL) AS violations FROM f
  UNION ALL SELECT 'fact', 'new_sk', 'member_ri', count(*) FILTER (k IS NOT NULL AND new_sk IS NULL) FROM f
  UNION ALL SELECT 'fact', 'new_sk', 'measure_reconciliation', count(*) FROM (SELECT l.k FROM fact_orders o JOIN lc l ON l.old_sk = o.fk JOIN tc USING (k) GROUP BY 1 HAVING abs(sum(price) - (SELECT sum(price) FROM f WHERE f.k = l.k)) > 0.01)
  UNION ALL SELECT 'fact_b', 'new_sk2', 'coverage_null_hash', count(*) FILTER (k IS NULL) FROM fb
  UNION ALL SELECT 'fact_b', 'new_sk2', 'member_ri', count(*) FILTER (k IS NOT NULL AND k NOT IN (SELECT nk FROM target_b)) FROM fb
  UNION ALL SELECT 'fact_b', 'new_sk2', 'version_ri_pathB_window', count(*) FILTER (k IS NOT NULL AND n = 0) FROM hb
  UNION ALL SELECT 'fact_b', 'new_sk2', 'event_date_nulls', count(*) FILTER (k IS NOT NULL AND event IS NULL) FROM fb)""",
    ),
    "sweep_results": _sql(
        """SELECT 'r1' AS run_id, 'fact' AS consumer_table, 'new_sk' AS fk_col, 'SWEPT' AS action, count(*) FILTER (k IS NOT NULL AND fk <> new_sk) AS rows_updated, count(*) FILTER (k IS NOT NULL AND coalesce(new_sk, fk) NOT IN (SELECT new_sk FROM target_customer)) AS post_check_violations FROM f
  UNION ALL SELECT 'r1', 'fact_b', 'new_sk2', 'SWEPT', count(*) FILTER (k IS NOT NULL AND n = 1 AND fk <> new_sk), count(*) FILTER (k IS NOT NULL AND CASE WHEN n = 1 THEN new_sk ELSE fk END NOT IN (SELECT new_sk FROM target_b)) FROM hb""",
        _FILLED, _FILLED_B, _HITS_B,
    ),
    "promoted_fact": _sql("SELECT o_orderkey, CASE WHEN k IS NULL THEN -1 ELSE new_sk END AS new_sk FROM f", _FILLED),
}
