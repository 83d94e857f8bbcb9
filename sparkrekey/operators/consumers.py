"""Consumers of keys: discovery, evidence, filling hashes, validation, sweeping, promotion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrekey.functions.keys import fk_like, sk_stem, window_end
from sparkrekey.model import SUGGEST_SHARE, TOLERANCE, ConsumerRole
from sparkrekey.operators.merge import asof_hits, ensure_columns, guarded_update, guarded_update_asof


# ---------------------------------------------------------------- discovery
def discover_consumers(columns: DataFrame, providers: DataFrame, registered: DataFrame) -> DataFrame:
    """columns (table_name, column_name) that bear a provider's key name in another table and aren't registered yet.

    providers: provider_table, sk_col, archetype, effective_start_col; a hub consumer's event date is its own start."""
    hubs = providers.filter("archetype = 'HUB_SCD2'").select(F.lower("provider_table").alias("_hub"), F.col("effective_start_col").alias("event_date_col"))
    found = columns.join(providers.select("provider_table", "sk_col"), (F.lower("column_name") == F.lower("sk_col")) & (F.lower("table_name") != F.lower("provider_table")))
    known = registered.select(F.lower("consumer_table").alias("_t"), F.lower("fk_col").alias("_c"))
    fresh = found.join(known, (F.lower("table_name") == F.col("_t")) & (F.lower("column_name") == F.col("_c")), "left_anti")
    return fresh.join(hubs, F.lower("table_name") == F.col("_hub"), "left").select(F.col("table_name").alias("consumer_table"), F.col("column_name").alias("fk_col"), "provider_table", "event_date_col")


def discover_edge_cases(columns: DataFrame, providers: DataFrame, registered: DataFrame) -> DataFrame:
    """Columns whose names only resemble a provider's key (its stem of four letters or more, and a key marker). A catalogue is small, so the pairing by name parts may be a nested loop."""
    p = providers.select("provider_table", "sk_col", sk_stem(F.col("sk_col")).alias("_stem")).filter("length(_stem) >= 4")
    found = columns.join(p, fk_like(F.col("column_name"), F.col("_stem")) & (F.lower("column_name") != F.lower("sk_col")) & (F.lower("table_name") != F.lower("provider_table")))
    known = registered.select(F.lower("consumer_table").alias("_t"), F.lower("fk_col").alias("_c"))
    found = found.join(known, (F.lower("table_name") == F.col("_t")) & (F.lower("column_name") == F.col("_c")), "left_anti")
    reason = F.concat(F.lit("name holds '"), F.col("_stem"), F.lit("' and a key marker"))
    return found.select("provider_table", "sk_col", F.col("table_name").alias("candidate_table"), F.col("column_name").alias("candidate_column"), reason.alias("reason"), F.lit("REVIEW").alias("status"))


def detect_sk(df: DataFrame, nk_cols: list[str], override: str | None = None) -> str:
    """The key column: the override, else the only whole-number column named key... that is no part of the natural key."""
    if override:
        match = [c for c in df.columns if c.lower() == override.lower()]
        if not match:
            raise ValueError(f"no column {override}")
        return match[0]
    nk = {c.lower() for c in nk_cols}
    whole = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    found = [f.name for f in df.schema if f.name.lower().startswith("key") and f.name.lower() not in nk and isinstance(f.dataType, whole)]
    if len(found) != 1:
        raise ValueError(f"{len(found)} key columns found: {found}")
    return found[0]


# ---------------------------------------------------------------- evidence
def classify_evidence(consumer: DataFrame, fk: str, keymap: DataFrame, threshold: float = SUGGEST_SHARE) -> DataFrame:
    """Non-null keys by the status that the key-map gives them, and what that suggests. Keys are counted before the join."""
    known = keymap.filter("old_sk IS NOT NULL").groupBy("old_sk").agg(F.min("map_status").alias("map_status"))
    keys = consumer.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("n"))
    n = keys.join(known, F.col("_fk") == F.col("old_sk"), "left").groupBy(F.coalesce("map_status", F.lit("NOT_IN_LEGACY_DIM")).alias("map_status")).agg(F.sum("n").alias("cnt"))
    every = Window.partitionBy()  # a row for each status
    outside = F.coalesce(F.sum(F.when(F.col("map_status") == "NOT_IN_LEGACY_DIM", F.col("cnt"))).over(every), F.lit(0)) / F.sum("cnt").over(every)
    suggested = F.when(1 - F.col("_out") >= threshold, "LEGACY_KEYED?").when(F.col("_out") >= threshold, "RELOADED?").otherwise("MIXED?")
    return n.withColumn("_out", outside).withColumn("suggested", suggested).drop("_out")


# ---------------------------------------------------------------- filling hashes
def populate_legacy(consumer: DataFrame, role: ConsumerRole, keymap: DataFrame, path: str | None) -> DataFrame:
    """Hashes for keys of the old generation; the keys stay. Path A gives the version's hash too; else members count once, ambiguous ones included."""
    nk, ver = role.hash_cols
    out = ensure_columns(consumer, {nk: "bigint", ver: "bigint"})
    if path == "A":
        source = keymap.filter("map_status = 'MATCHED'").select("old_sk", "nk_hash", "ver_hash")
        filled = guarded_update(out, source, {role.fk_col: "old_sk"}, {nk: "nk_hash", ver: "ver_hash"})
    else:
        source = keymap.filter("map_status IN ('MATCHED', 'AMBIGUOUS')").select("old_sk", "nk_hash").distinct()
        filled = guarded_update(out, source, {role.fk_col: "old_sk"}, {nk: "nk_hash"})
    return filled


def populate_reloaded(consumer: DataFrame, role: ConsumerRole, provider: DataFrame, sk: str, path: str | None = None) -> DataFrame:
    """Hashes for keys of the new generation, from the provider itself."""
    nk, ver = role.hash_cols
    out = ensure_columns(consumer, {nk: "bigint", ver: "bigint"})
    values = {nk: "nk_hash", **({ver: "ver_hash"} if path == "A" else {})}
    return guarded_update(out, provider.select(sk, *values.values()), {role.fk_col: sk}, values)


# ---------------------------------------------------------------- validation
def check(name: str, violations: DataFrame, info: bool = False) -> DataFrame:
    """check_name, violations, verdict of a one-row count."""
    v = violations.toDF("violations")
    verdict = F.lit("INFO") if info else F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    return v.select(F.lit(name).alias("check_name"), F.col("violations").cast("long").alias("violations"), verdict.alias("verdict"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)))


def coverage(df: DataFrame, fk: str, hashed: str) -> DataFrame:
    return check("coverage_null_hash", _count(df.filter(F.col(hashed).isNull() & F.col(fk).isNotNull())), True)


def member_ri(df: DataFrame, hashed: str, provider: DataFrame, key: str = "nk_hash", name: str = "member_ri") -> DataFrame:
    """Rows whose hash no provider row has."""
    known = provider.select(F.col(key).alias("_k")).distinct()
    return check(name, _count(df.filter(F.col(hashed).isNotNull()).join(known, F.col(hashed) == F.col("_k"), "left_anti")))


def version_ri_b(df: DataFrame, hashed: str, event: str, provider: DataFrame) -> DataFrame:
    """Rows whose event no window of their member holds."""
    hits = asof_hits(df.filter(F.col(hashed).isNotNull() & F.col(event).isNotNull()), provider, (hashed, "nk_hash"), event, "s", "e", ["new_sk"])
    return check("version_ri_pathB_window", _count(hits.filter(F.coalesce(F.size("_hits") <= 0, F.lit(True)))))


def exactly_one_window(df: DataFrame, hashed: str, event: str, provider: DataFrame) -> DataFrame:
    """Rows by how many windows hold their event: none, one, several."""
    hits = asof_hits(df.filter(F.col(hashed).isNotNull() & F.col(event).isNotNull()), provider, (hashed, "nk_hash"), event, "s", "e", ["new_sk"])
    n = F.greatest(F.coalesce(F.size("_hits"), F.lit(0)), F.lit(0))
    return hits.groupBy(F.when(n == 0, "none").when(n == 1, "one").otherwise("several").alias("windows")).agg(F.count(F.lit(1)).alias("cnt"))


def event_nulls(df: DataFrame, hashed: str, event: str) -> DataFrame:
    return check("event_date_nulls", _count(df.filter(F.col(hashed).isNotNull() & F.col(event).isNull())))


def measure_recon(legacy_fact: DataFrame, legacy_fk: str, members: DataFrame, fact: DataFrame, hashed: str, measures: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """Members whose measures differ between the old fact, by its keys, and the new, by its hashes; members that were orphans already are counted apart."""
    one = members.filter("map_status IN ('MATCHED', 'AMBIGUOUS')").select("old_sk", "nk_hash").distinct()
    old = legacy_fact.groupBy(F.col(legacy_fk).alias("old_sk")).agg(*(F.sum(m).alias(m) for m in measures)).join(one, "old_sk").groupBy("nk_hash").agg(*(F.sum(m).alias(f"l_{m}") for m in measures))
    new = fact.filter(F.col(hashed).isNotNull()).groupBy(F.col(hashed).alias("nk_hash")).agg(*(F.sum(m).alias(f"t_{m}") for m in measures))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    off = reduce(lambda a, b: a | b, [F.abs(zero(f"l_{m}") - zero(f"t_{m}")) > tolerance for m in measures])
    return check("measure_reconciliation", _count(old.join(new, "nk_hash", "full_outer").filter(off)))


def hub_consistency(df: DataFrame, roles: list[ConsumerRole]) -> DataFrame:
    """Rows with an unresolved role, and those with both resolved and unresolved ones."""
    bad = [(F.col(r.fk_col).isNotNull() & F.col(r.hash_cols[0]).isNull()).cast("int") for r in roles]
    n = reduce(lambda a, b: a + b, bad)
    return df.agg(F.count_if(n > 0).alias("unresolved"), F.count_if((n > 0) & (n < len(roles))).alias("partly"))


def sweep_gate(results: DataFrame, roles: DataFrame) -> DataFrame:
    """reason, cnt: what the newest validation run holds against a sweep; nothing if it is fit."""
    newest = results.groupBy("run_id").agg(F.max("run_at").alias("at")).agg(F.max_by("run_id", "at").alias("run_id"))
    last = results.join(newest, "run_id")
    failed = last.filter("verdict = 'FAIL'").join(roles, ["consumer_table", "fk_col"], "left_semi").select(F.lit("failed").alias("reason"))
    absent = roles.join(last, ["consumer_table", "fk_col"], "left_anti").select(F.lit("not validated").alias("reason"))
    return failed.unionByName(absent).groupBy("reason").agg(F.count(F.lit(1)).alias("cnt"))


# ---------------------------------------------------------------- sweeping
def sweep_order(roles: DataFrame, hubs: DataFrame) -> DataFrame:
    """position, consumer_table, fk_col: hubs by level, then facts."""
    level = F.coalesce("topo_level", F.lit(1_000_000))
    out = roles.join(hubs.select(F.col("provider_table").alias("_t"), "topo_level"), F.lower("consumer_table") == F.lower("_t"), "left").withColumn("level", level)
    return out.select(F.row_number().over(Window.orderBy("level", "consumer_table", "fk_col")).cast("long").alias("position"), "consumer_table", "fk_col", F.col("level").cast("long").alias("level"))


def sweep_equi(df: DataFrame, fk: str, hashed: str, provider: DataFrame, key: str = "nk_hash", metrics: Observation | None = None) -> DataFrame:
    """New keys by hash; a row whose key is right already, or null, isn't touched."""
    return guarded_update(df, provider.select(key, "new_sk"), {hashed: key}, {fk: "new_sk"}, lambda s: F.col(fk) != s["new_sk"], metrics)


def sweep_asof(df: DataFrame, fk: str, hashed: str, event: str, provider: DataFrame, metrics: Observation | None = None) -> DataFrame:
    return guarded_update_asof(df, provider, (hashed, "nk_hash"), event, "s", "e", {fk: "new_sk"}, metrics)


def assign_orphans(df: DataFrame, fk: str, hashed: str, orphan_sk: int = -1) -> DataFrame:
    return df.withColumn(fk, F.when(F.col(hashed).isNull() & F.col(fk).isNotNull(), F.lit(orphan_sk)).otherwise(F.col(fk)))


def post_sweep(df: DataFrame, fk: str, hashed: str, provider: DataFrame, orphan_sk: int = -1) -> DataFrame:
    """Keys that no provider row has, and rows that stayed on an old key for want of a hash (their number may be another member's new key)."""
    known = provider.select(F.col("new_sk").alias("_k")).distinct()
    live = df.filter(F.col(fk).isNotNull() & (F.col(fk) != orphan_sk))
    return check("sk_ri", _count(live.join(known, F.col(fk) == F.col("_k"), "left_anti"))).unionByName(check("unresolved_hash", _count(live.filter(F.col(hashed).isNull()))))


# ---------------------------------------------------------------- promotion
def drift(prod: DataFrame, wip: DataFrame, row_key: list[str]) -> DataFrame:
    return prod.join(wip.select(*row_key), row_key, "left_anti")


def promote_columns(provider_cols: list[str], roles: list[ConsumerRole], columns: list[str]) -> list[str]:
    """What a promotion carries over: a provider's hashes, and each role's key and hashes; a hub has both."""
    wanted = [*provider_cols, *(c for r in roles for c in (r.fk_col, *r.hash_cols))]
    return [c for c in dict.fromkeys(wanted) if c in columns]


def promote_merge(prod: DataFrame, wip: DataFrame, row_key: list[str], columns: list[str]) -> DataFrame:
    """prod with the columns taken from wip's row of equal key; columns that prod lacks are added first."""
    types = {f.name: f.dataType.simpleString() for f in wip.schema}
    return guarded_update(ensure_columns(prod, {c: types[c] for c in columns}), wip.select(*row_key, *columns), row_key, {c: c for c in columns})


def asof_lookup(df: DataFrame, key: str, event: str, windows: DataFrame, value: str = "new_sk") -> DataFrame:
    """df with the value of the key's window that holds the event, null if none does."""
    return asof_hits(df, windows, (key, "nk_hash"), event, "s", "e", [value]).withColumn(value, F.get("_hits", F.lit(0))["v"][value]).drop("_hits")


def overlap_lookup(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of equal nk_hash whose windows overlap."""
    a = left.select(*(F.col(c).alias(f"l_{c}") for c in left.columns))
    b = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    return a.join(b, (F.col("l_nk_hash") == F.col("r_nk_hash")) & (F.col("l_s") < window_end("r_e")) & (F.col("r_s") < window_end("l_e")))


def null_guard(df: DataFrame, hashed: str, value: Column, recompute: bool = False) -> DataFrame:
    """hashed filled where it is null (everywhere on recompute)."""
    return df.withColumn(hashed, value if recompute else F.coalesce(F.col(hashed), value))
