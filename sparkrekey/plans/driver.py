"""A repair run end to end: discovery, snapshots, clones, key-maps, hashes, validation, sweep and promotion on a table store."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkrekey.functions.keys import nk_hash, nk_string, status_class, ver_hash
from sparkrekey.model import AUDIT, CLONES, MATCHES, MATCH_PROPERTY, ConsumerRole, ProviderSpec
from sparkrekey.operators import consumers as C
from sparkrekey.operators import keymap as K
from sparkrekey.operators import merge as M
from sparkrekey.plans import registry as R
from sparkrekey.sources.store import TableStore, wip_name

_EMPTY = "check_name string, violations long, verdict string, detail string"


def _detailed(checks: DataFrame, detail: str = "") -> DataFrame:
    return checks.withColumn("detail", F.lit(detail))


def _stated(spark: SparkSession, name: str, detail: str) -> DataFrame:
    return spark.createDataFrame([(name, 1, "FAIL", detail)], _EMPTY)


def battery(table: DataFrame, role: ConsumerRole, provider: ProviderSpec | None, current: DataFrame | None, legacy: DataFrame | None = None, members: DataFrame | None = None, tolerance: float = 0.01) -> DataFrame:
    """check_name, violations, verdict, detail of all checks that apply to a role.

    current is the provider's snapshot on the new keys; legacy the old consumer table and members the key-map, for a role with measures on the old keys."""
    spark = table.sparkSession
    if provider is None:
        return _stated(spark, "provider_configured", f"{role.provider_table} is not configured")
    nk, ver = role.hash_cols
    have = {c.lower() for c in table.columns}
    if nk.lower() not in have:
        return _stated(spark, "hash_column_present", f"{nk} is missing: populate first")
    out = [_detailed(C.coverage(table, role.fk_col, nk), "compare with the orphans expected"), _detailed(C.member_ri(table, nk, current))]
    if provider.versioned and provider.version_match_path == "A":
        if ver.lower() in have:
            out.append(_detailed(C.member_ri(table, ver, current, "ver_hash", "version_ri_pathA")))
            out.append(_detailed(C.check("ver_hash_coverage", table.filter(F.col(nk).isNotNull() & F.col(ver).isNull()).agg(F.count(F.lit(1)))), "a member's hash without its version's"))
        else:
            out.append(_stated(spark, "version_ri_pathA", f"{ver} is missing: populate first"))
    elif provider.versioned:
        if role.event_date_col:
            out.append(_detailed(C.version_ri_b(table, nk, role.event_date_col, current), "events in no window"))
            out.append(_detailed(C.event_nulls(table, nk, role.event_date_col), "no event date to choose a version by"))
        else:
            out.append(_stated(spark, "version_ri_pathB", "path B needs an event date column"))
    if role.measure_cols and role.classification == "LEGACY_KEYED" and legacy is not None:
        out.append(_detailed(C.measure_recon(legacy, role.fk_col, members, table, nk, list(role.measure_cols), tolerance), "members whose sums differ"))
    return reduce(DataFrame.unionByName, out)


class Repair:
    """One run. Tables lie in a TableStore: prod (current), source (old generation), and what the stages make. With dry_run, nothing but the configuration is written;
    `planned` then lists what would be."""

    def __init__(self, spark: SparkSession, store: TableStore, given: dict[str, str] | None = None, source: Callable[[str], DataFrame] | None = None, run_id: str | None = None, now: dt.datetime | None = None):
        self.spark, self.store = spark, store
        if given is not None:
            R.activate(store, given)
        self.settings = R.active(store)
        self.run_id, self.now = run_id or f"run-{uuid.uuid4().hex[:12]}", now or dt.datetime.now(dt.timezone.utc)
        self.source = source or (lambda table: store.read("source", table))
        self.dry, self.planned, self.gate_failed, self.errors = self.settings["dry_run"] == "true", [], set(), []
        self.providers = {p.provider_table.lower(): p for p in R.providers(self.settings["providers_json"]) if p.enabled and R.in_scope(p.provider_table, self.settings["provider_filter"])}
        self.registry = R.Registry({}, self.settings["repair_mode"])

    # ------------------------------------------------------------ writing
    def record(self, name: str, rows: DataFrame) -> None:
        """Appends rows to an audit table, stamped with the run and its time; no rows, no write."""
        stamp = "found_at" if name == "discovery_edge_cases" else "run_at"
        schema = self.spark.createDataFrame([], AUDIT[name]).schema
        rows = rows.withColumns({"run_id": F.lit(self.run_id), stamp: F.lit(self.now).cast("timestamp")})
        self.store.append("config", name, rows.select(*(F.col(f.name).cast(f.dataType) for f in schema)))

    def write(self, kind: str, table: str, df: DataFrame, properties: dict | None = None) -> None:
        self.planned.append(f"write {kind}.{table}")
        if not self.dry:
            self.store.write(kind, table, df, properties)

    @property
    def kind(self) -> str:
        return "wip" if self.settings["repair_target_mode"] == "wip_clone" else "prod"

    def name(self, table: str) -> str:
        return wip_name(table, self.run_id) if self.kind == "wip" else table

    def table(self, table: str) -> DataFrame:
        """The table that this run works on: its clone, if there is one."""
        if self.kind == "wip" and self.store.exists("wip", self.name(table)):
            return self.store.read("wip", self.name(table))
        return self.store.read("prod", table)

    def current(self, p: ProviderSpec) -> DataFrame:
        return K.snapshot(self.table(p.provider_table), p, "new_sk")

    def roles(self, purpose: str = "repair") -> list[ConsumerRole]:
        return [r for r in self.registry.eligible(purpose) if R.in_scope(r.consumer_table, self.settings["consumer_filter"])]

    # ------------------------------------------------------------ stages
    def discover(self) -> None:
        """Consumers by column name, those given by hand, exclusions and overrides; candidates whose names only resemble a key go to discovery_edge_cases."""
        s, columns = self.settings, self.store.columns()
        rows = [(p.provider_table, p.sk_col, p.archetype, p.effective_start_col) for p in self.providers.values()]
        providers = self.spark.createDataFrame(rows, "provider_table string, sk_col string, archetype string, effective_start_col string")
        none = self.spark.createDataFrame([], "consumer_table string, fk_col string")
        manual = [ConsumerRole(**{**d, "measure_cols": tuple(d.get("measure_cols") or ())}) for d in R.documents(s["manual_consumers_json"])]
        found = [ConsumerRole(r.consumer_table, r.fk_col, r.provider_table, r.event_date_col) for r in C.discover_consumers(columns, providers, none).collect()]  # a catalogue's columns
        self.registry.discover([*manual, *found])
        for d in R.documents(s["consumer_overrides_json"]):
            key = f"{d['consumer_table']}::{d['fk_col']}"
            changes = {k: tuple(v) if k == "measure_cols" else v for k, v in d.items() if k in ("event_date_col", "measure_cols", "excluded", "exclusion_reason")}
            self.registry._set(key, **changes)
        for d in R.documents(s["exclude_consumers_json"]):
            self.registry.exclude(f"{d['consumer_table']}::{d['fk_col']}", d.get("reason", ""))
        known = self.spark.createDataFrame([(r.consumer_table, r.fk_col) for r in self.registry.roles.values()], none.schema)
        self.record("discovery_edge_cases", C.discover_edge_cases(columns, providers, known))

    def triage(self) -> None:
        chosen = R.documents(self.settings["repair_selection_json"])
        self.registry.triage([f"{d['consumer_table']}::{d['fk_col']}" for d in chosen if d.get("repair_status", "SELECTED") == "SELECTED"])
        for d in chosen:
            if d.get("repair_status", "SELECTED") != "SELECTED":
                self.registry.status(f"{d['consumer_table']}::{d['fk_col']}", d["repair_status"])

    def snapshot(self) -> None:
        """Old generations' keys into staging (kept if they are there, unless a refresh is asked for), collision gates on both generations, and each versioned provider's path."""
        for p in self.providers.values():
            name = f"legacy_{p.provider_table}"
            if not self.store.exists("staging", name) or self.settings["refresh_snapshots"] == "true":
                self.write("staging", name, K.snapshot(self.source(p.provider_table), p, "old_sk").withColumn("snapshot_at", F.lit(self.now).cast("timestamp")))
            sides = [(name, self.legacy(p)), (p.provider_table, K.snapshot(self.store.read("prod", p.provider_table), p, "new_sk"))]
            for table, df in sides:
                self._gate(p, table, K.collision_gate(df))
            if p.versioned:
                found = K.version_diagnostic(sides[0][1], sides[1][1], float(self.settings["path_a_threshold"]))
                self.record("version_diagnostics", found.withColumn("provider_table", F.lit(p.provider_table)))
                suggested = next((r.suggested_path for r in found.limit(1).collect()), "B")
                if p.version_match_path is None and self.settings["auto_set_path"] == "true":
                    self.providers[p.provider_table.lower()] = replace(p, version_match_path=suggested)
                elif p.version_match_path not in (None, suggested):
                    self.planned.append(f"note: {p.provider_table} is set to path {p.version_match_path}, the diagnostic suggests {suggested}")

    def legacy(self, p: ProviderSpec) -> DataFrame:
        name = f"legacy_{p.provider_table}"
        return self.store.read("staging", name).drop("snapshot_at") if self.store.exists("staging", name) else K.snapshot(self.source(p.provider_table), p, "old_sk")

    def _gate(self, p: ProviderSpec, table: str, gate: DataFrame) -> None:
        row = gate.first()
        self.record("gate_results", self.spark.createDataFrame([(table, row.gate, row.violations, row.passed)], "table_name string, gate string, violations long, passed boolean"))
        if not row.passed:
            self.gate_failed.add(p.provider_table.lower())
            self.errors.append(f"{table}: {row.gate} has {row.violations} violations")

    def clone(self) -> None:
        """Clones of the providers and the eligible consumers, each table once; older active clones of them are superseded."""
        if self.kind != "wip":
            return
        tables = {p.provider_table.lower(): ("PROVIDER", p.provider_table) for p in self.providers.values()}
        for r in self.roles():
            tables.setdefault(r.consumer_table.lower(), ("CONSUMER", r.consumer_table))
        self.planned += [f"clone {t}" for _, t in tables.values()]
        if self.dry:
            return
        keys = {k.lower(): v for k, v in R.row_keys(self.settings["wip_row_keys_json"]).items()}
        rows = []
        for kind, t in tables.values():
            self.store.clone("prod", t, "wip", self.name(t))
            rows.append((self.run_id, t, kind, self.name(t), "ACTIVE", keys.get(t.lower()) or self._own_key(t), self.now, None, None, None))
        self._clones(F.lower("logical_table").isin(*tables), {"clone_status": F.lit("SUPERSEDED"), "notes": F.concat_ws(" | ", "notes", F.lit(f"superseded by {self.run_id}"))})
        self.store.append("config", "wip_clones", self.spark.createDataFrame(rows, CLONES))

    def _own_key(self, table: str) -> list[str] | None:
        p = self.providers.get(table.lower())
        return [p.sk_col] if p else None

    def _clones(self, where, changes: dict) -> None:
        """Changes the active clones that meet the condition."""
        if self.store.exists("config", "wip_clones"):
            hit = where & (F.col("clone_status") == "ACTIVE")
            old = self.store.read("config", "wip_clones")
            self.store.write("config", "wip_clones", old.select(*(F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in old.columns)))

    def provider_hash(self) -> None:
        """The providers' hashes, their gates, and, for those that pass, the key-maps with their audit."""
        for p in self.providers.values():
            t, text = p.provider_table, nk_string(list(p.nk_cols), p.nk_type_overrides)
            if p.versioned and p.version_match_path is None:
                self.gate_failed.add(t.lower())
                self.errors.append(f"{t}: no version path is set")
                continue
            again = self.settings["recompute_hashes"] == "true"
            df = M.ensure_columns(self.table(t), {"nk_hash": "bigint", **({"ver_hash": "bigint"} if p.version_match_path == "A" else {})})
            df = C.null_guard(df, "nk_hash", nk_hash(text), again)
            if p.version_match_path == "A":
                status = status_class(p.record_status_col) if p.use_status_tiebreaker and p.record_status_col else None
                df = C.null_guard(df, "ver_hash", ver_hash(text, p.effective_start_col, status), again)
            self.write(self.kind, self.name(t), df)
            now = self.current(p)
            if not p.versioned:
                self._gate(p, t, K.duplicate_groups(now, ["nk_hash"], "nk_hash_unique"))
            else:
                key = ["nk_hash", "s", *(["status_class"] if p.use_status_tiebreaker else [])]
                self._gate(p, t, K.duplicate_groups(now, key, "nk_start_status_unique" if p.use_status_tiebreaker else "nk_start_unique"))
                if p.version_match_path == "A":
                    self._gate(p, t, K.duplicate_groups(now, ["ver_hash"], "ver_hash_unique"))
                if p.effective_end_col:
                    self._gate(p, t, K.overlap_gate(now))
            if t.lower() not in self.gate_failed and self.settings["build_keymaps"] == "true":
                self._keymap(p, now)

    def _keymap(self, p: ProviderSpec, now: DataFrame) -> None:
        old = self.legacy(p)
        if not p.versioned:
            km = K.keymap_scd1(old, now)
        elif p.version_match_path == "A":
            km = K.keymap_path_a(old, now, p.use_status_tiebreaker)
        else:
            km = K.keymap_path_b(old, now)
        self.write("keymap", p.provider_table, km.withColumn("created_at", F.lit(self.now).cast("timestamp")), {MATCH_PROPERTY: MATCHES[p.version_match_path if p.versioned else "SCD1"]})
        if not self.dry:
            self.record("keymap_audit", K.audit(self.store.read("keymap", p.provider_table)).withColumn("provider_table", F.lit(p.provider_table)))

    def classify(self) -> None:
        """Evidence for each role, and the classifications that someone has attested."""
        for r in self.roles():
            if self.store.exists("keymap", r.provider_table):
                found = C.classify_evidence(self.table(r.consumer_table), r.fk_col, self.store.read("keymap", r.provider_table), float(self.settings["suggest_threshold"]))
                self.record("classification_evidence", found.withColumns({"consumer_table": F.lit(r.consumer_table), "fk_col": F.lit(r.fk_col), "provider_table": F.lit(r.provider_table)}))
        for d in R.documents(self.settings["classifications_json"]):
            self.registry.classify(f"{d['consumer_table']}::{d['fk_col']}", d["classification"], d.get("note") or "attested")

    def populate(self) -> None:
        """Hashes into the consumers: one rewrite a table, whatever its roles."""
        for t in dict.fromkeys(r.consumer_table for r in self.roles()):
            df, done = self.table(t), False
            for r in self.roles():
                p = self.providers.get(r.provider_table.lower())
                if r.consumer_table != t or p is None or r.classification not in ("LEGACY_KEYED", "RELOADED"):
                    continue
                if r.classification == "LEGACY_KEYED":
                    df, done = C.populate_legacy(df, r, self.store.read("keymap", r.provider_table), p.version_match_path), True
                else:
                    df, done = C.populate_reloaded(df, r, self.current(p), "new_sk", p.version_match_path), True
            if done:
                self.write(self.kind, self.name(t), df)

    def validate(self) -> None:
        """The battery for each role, hubs' rows as a whole, and the roles' new states."""
        verdicts: dict[str, list[str]] = {}
        for r in self.roles("validate"):
            p = self.providers.get(r.provider_table.lower())
            checked = r.measure_cols and r.classification == "LEGACY_KEYED" and self.store.exists("source", r.consumer_table)
            members = self.store.read("keymap", r.provider_table) if checked else None
            rows = battery(self.table(r.consumer_table), r, p, self.current(p) if p else None, self.source(r.consumer_table) if checked else None, members, float(self.settings["measure_tolerance"])).collect()  # a few checks
            self._validated(r, rows)
            verdicts[r.key] = [x.verdict for x in rows]
        for t in {r.consumer_table for r in self.roles("validate")} & {p.provider_table for p in self.providers.values()}:
            roles = [r for r in self.roles("validate") if r.consumer_table == t and r.hash_cols[0] in self.table(t).columns]
            if roles:
                found = C.hub_consistency(self.table(t), roles).first()
                self._validated(replace(roles[0], fk_col="*ALL_ROLES*"), [("hub_row_consistency", found.unresolved, "INFO", "rows with an unresolved role")])
        self.registry.validated(verdicts)

    def _validated(self, role: ConsumerRole, rows: list) -> None:
        found = self.spark.createDataFrame([tuple(x) for x in rows], _EMPTY)
        self.record("validation_results", found.withColumns({"consumer_table": F.lit(role.consumer_table), "fk_col": F.lit(role.fk_col), "provider_table": F.lit(role.provider_table)}))

    def sweep(self) -> None:
        """New keys for the roles on old keys, hubs first, after the newest validation has let them pass; each sweep's rows are counted as it is written."""
        roles = self.roles()
        named = self.spark.createDataFrame([(r.consumer_table, r.fk_col) for r in roles], "consumer_table string, fk_col string")
        if self.settings["require_validation"] == "true":
            held = C.sweep_gate(self.store.read("config", "validation_results"), named).collect() if self.store.exists("config", "validation_results") else ["not validated"]
            if held:
                raise RuntimeError(f"not fit for a sweep: {held}")
        hubs = self.spark.createDataFrame([(p.provider_table, p.topo_level) for p in self.providers.values()], "provider_table string, topo_level int")
        by_key = {r.key: r for r in roles}
        for row in C.sweep_order(named, hubs).orderBy("position").collect():  # a row for each role
            r = by_key[f"{row.consumer_table}::{row.fk_col}"]
            if r.classification == "RELOADED":
                continue
            if r.classification != "LEGACY_KEYED":
                self.errors.append(f"{r.key}: classification {r.classification} can't be swept")
                continue
            p = self.providers[r.provider_table.lower()]
            if p.versioned and p.version_match_path != "A" and not r.event_date_col:
                self.errors.append(f"{r.key}: path B needs an event date column")
                continue
            self._sweep(r, p)

    def _sweep(self, r: ConsumerRole, p: ProviderSpec) -> None:
        metrics, now, (nk, ver) = Observation(), self.current(p), r.hash_cols
        if p.versioned and p.version_match_path == "A":
            df = C.sweep_equi(self.table(r.consumer_table), r.fk_col, ver, now, "ver_hash", metrics)
        elif p.versioned:
            df = C.sweep_asof(self.table(r.consumer_table), r.fk_col, nk, r.event_date_col, now, metrics)
        else:
            df = C.sweep_equi(self.table(r.consumer_table), r.fk_col, nk, now, metrics=metrics)
        orphan = int(self.settings["orphan_sk"])
        if self.settings["apply_orphan_sk"] == "true":
            df = C.assign_orphans(df, r.fk_col, nk, orphan)
        self.write(self.kind, self.name(r.consumer_table), df)
        if self.dry:
            return
        left = C.post_sweep(self.table(r.consumer_table), r.fk_col, nk, now, orphan).filter("check_name = 'sk_ri'").first().violations
        if left:
            self.errors.append(f"{r.key}: {left} keys have no provider row after the sweep")
        found = [(r.consumer_table, r.fk_col, r.provider_table, "SWEPT", metrics.get["rows_updated"], left)]
        self.record("sweep_results", self.spark.createDataFrame(found, "consumer_table string, fk_col string, provider_table string, action string, rows_updated long, post_check_violations long"))
        self.registry.swept(r.key, left)

    def promote(self) -> None:
        """This run's active clones into production, by columns, by swap or by view; each is marked PROMOTED."""
        if self.kind != "wip" or self.dry:
            self.planned.append("promote")
            return
        mode = self.settings["promote_mode"]
        clones = self.store.read("config", "wip_clones").filter((F.col("run_id") == self.run_id) & (F.col("clone_status") == "ACTIVE")).orderBy("table_kind", "logical_table").collect()  # a row for each table
        if not clones:
            raise RuntimeError(f"no active clones of {self.run_id}")
        for c in clones:
            t, wip = c.logical_table, self.store.read("wip", c.wip_table_name)
            if mode == "merge_columns":
                p = self.providers.get(t.lower())
                own = ["nk_hash", *(["ver_hash"] if p.versioned else [])] if p else []
                columns = C.promote_columns(own, [r for r in self.roles("promote") if r.consumer_table.lower() == t.lower()], wip.columns)
                if not c.row_key_cols or not columns:
                    self.errors.append(f"{t}: {'no row key' if columns else 'no columns to promote'}")
                    continue
                self.store.write("prod", t, C.promote_merge(self.store.read("prod", t), wip, list(c.row_key_cols), [x for x in columns if x not in c.row_key_cols]))
            elif mode == "swap_table":
                self.store.swap("prod", t, "wip", c.wip_table_name)
            else:
                self.store.view("wip", c.wip_table_name, self.settings["promote_view_prefix"] + t)
            self._clones((F.col("run_id") == self.run_id) & (F.col("logical_table") == t), {
                "clone_status": F.lit("PROMOTED"), "promoted_at": F.lit(self.now).cast("timestamp"), "promote_mode": F.lit(mode), "notes": F.concat_ws(" | ", "notes", F.lit(f"promoted by {self.run_id}")),
            })

    def run(self) -> list[str]:
        """The profile's stages in order; returns what went wrong without stopping the run."""
        for stage in R.stages(self.settings["setup_profile"]):
            getattr(self, stage)()
        return self.errors
