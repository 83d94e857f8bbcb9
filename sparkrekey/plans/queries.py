"""A query for each operator, on the fixtures."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkrekey.functions import keys
from sparkrekey.model import ConsumerRole, ProviderSpec
from sparkrekey.operators import consumers as C
from sparkrekey.operators import keymap as K
from sparkrekey.plans import driver
from sparkrekey.plans import registry as R
from sparkrekey.plans.fixtures import fixture, rows, shared_folder
from sparkrekey.sources.store import TableStore

CUSTOMER = ProviderSpec("dim_customer", "SCD1", "old_sk", ("nk",))
VERSION = ProviderSpec("dim_version", "SCD2", "old_sk", ("nk",), effective_start_col="s", effective_end_col="e")
ROLE = ConsumerRole("fact_orders", "fk", "dim_customer", measure_cols=("price",))
NK, VER = ROLE.hash_cols
QUERIES: dict = {}


def _named(spark, d, name):
    return fixture(spark, d, name)


def _snap(spark: SparkSession, d: str, name: str) -> DataFrame:
    sk = "old_sk" if name.startswith("legacy") else "new_sk"
    p = CUSTOMER if name.endswith("customer") else VERSION
    return K.snapshot(_named(spark, d, name), ProviderSpec(**{**p.__dict__, "sk_col": sk}), sk)


def query(f):
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- keys
@query
def normalize_nk(spark, d):
    return _named(spark, d, "versions").select("up", keys.nk_string(["o_custkey", "s", "e"], {"o_custkey": "bigint", "s": "date", "e": "timestamp"}).alias("natural_key"))


@query
def normalize_nk_lenient(spark, d):
    return _named(spark, d, "target_customer").select("new_sk", F.concat_ws("||", keys.normalized_leniently("nk"), keys.normalized_leniently("status")).alias("natural_key"))


@query
def status_class(spark, d):
    return _named(spark, d, "target_customer").select("new_sk", keys.status_class("status").alias("status_class"))


@query
def provider_hash(spark, d):
    """Hashes filled where they are null, and the old member that each then meets; those that had another value keep it and meet none."""
    t = _named(spark, d, "target_customer").withColumn("nk_hash", F.when(F.col("new_sk") % 2 == 0, F.lit(0).cast("long")))
    done = C.null_guard(t, "nk_hash", keys.nk_hash(keys.nk_string(["nk"])))
    return done.join(_snap(spark, d, "legacy_customer").select("nk_hash", "old_sk"), "nk_hash", "left").select("new_sk", "old_sk")


@query
def gate_collision(spark, d):
    """The gate on either generation, and on one whose hashes leave out the key's last digit."""
    planted = _snap(spark, d, "target_customer").withColumn("nk_hash", F.xxhash64(F.regexp_replace("natural_key", "[0-9]$", "")))
    sides = [("legacy", _snap(spark, d, "legacy_customer")), ("target", _snap(spark, d, "target_customer")), ("planted", planted)]
    return reduce(DataFrame.unionByName, [K.collision_gate(df).withColumn("table_name", F.lit(name)) for name, df in sides])


# ---------------------------------------------------------------- maps
@query
def snapshot_scd1(spark, d):
    return _snap(spark, d, "legacy_customer").drop("nk_hash")


@query
def snapshot_scd2(spark, d):
    return _snap(spark, d, "legacy_a").drop("nk_hash", "ver_hash")


def _maps(df):
    return df.drop("nk_hash", "ver_hash")


@query
def keymap_scd1(spark, d):
    return _maps(K.keymap_scd1(_snap(spark, d, "legacy_customer"), _snap(spark, d, "target_customer"))).drop("effectiveStartDate", "effectiveEndDate")


@query
def keymap_path_a(spark, d):
    return _maps(K.keymap_path_a(_snap(spark, d, "legacy_a"), _snap(spark, d, "target_a")))


@query
def keymap_path_a_tiebreak(spark, d):
    sides = [_snap(spark, d, n).withColumn("status_class", F.when(F.col("natural_key").cast("long") % m == 0, "DELETED").otherwise("ACTIVE")) for n, m in (("legacy_a", 5), ("target_a", 10))]
    return _maps(K.keymap_path_a(*sides, tiebreak=True))


@query
def keymap_path_b(spark, d):
    return _maps(K.keymap_path_b(_snap(spark, d, "legacy_b"), _snap(spark, d, "target_b")))


@query
def keymap_pairwise(spark, d):
    both = [_named(spark, d, n).withColumn("nk", F.regexp_replace(F.trim(F.lower("nk")), "[0-9]$", "")) for n in ("legacy_customer", "target_customer")]
    return K.keymap_pairwise(*both, ["nk"], "old_sk", "new_sk").drop("match_hash", "effectiveStartDate", "effectiveEndDate")


@query
def keymap_audit(spark, d):
    return K.audit(keymap_path_b(spark, d)).withColumn("share", F.round("share", 9))


@query
def version_diagnostic(spark, d):
    return reduce(DataFrame.unionByName, [K.version_diagnostic(_snap(spark, d, f"legacy_{p}"), _snap(spark, d, f"target_{p}")).select(F.lit(p).alias("pair"), "status", "version_rows", F.round("matched_pct", 9).alias("matched_pct"), "suggested_path") for p in "ab"])


# ---------------------------------------------------------------- gates
@query
def gate_scd1_unique(spark, d):
    return K.duplicate_groups(_snap(spark, d, "target_customer"), ["nk_hash"], "nk_hash_unique")


@query
def gate_nk_start(spark, d):
    rows = _named(spark, d, "fact_orders").select("fk", "event")
    return K.duplicate_groups(rows, ["fk", "event"], "nk_start_unique")


@query
def gate_nk_start_status(spark, d):
    rows = _named(spark, d, "fact_orders").select("fk", "event", (F.col("o_orderkey") % 2).alias("status"))
    return K.duplicate_groups(rows, ["fk", "event", "status"], "nk_start_status_unique")


@query
def gate_ver_unique(spark, d):
    return K.duplicate_groups(_snap(spark, d, "target_a"), ["ver_hash"], "ver_hash_unique")


@query
def overlap_gate(spark, d):
    t = _snap(spark, d, "target_b")
    late = t.withColumn("e", F.when(F.col("natural_key").cast("long") % 7 == 0, F.col("e") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("e")))
    return K.overlap_gate(late).unionByName(K.overlap_gate(t).withColumn("gate", F.lit("window_overlap_plain")))


# ---------------------------------------------------------------- consumers
@query
def discover_consumers(spark, d):
    return C.discover_consumers(rows(spark, "catalogue"), rows(spark, "providers"), rows(spark, "registered"))


@query
def discover_edge_cases(spark, d):
    return C.discover_edge_cases(rows(spark, "catalogue"), rows(spark, "providers"), rows(spark, "registered")).drop("reason")


@query
def registry_review(spark, d):
    return R.review(rows(spark, "roles"), rows(spark, "providers"))


@query
def detect_sk(spark, d):
    t = _named(spark, d, "target_customer").withColumnRenamed("new_sk", "key_customer")
    name = C.detect_sk(t, ["nk"])
    return t.agg(F.count(F.col(name)).alias("keys"), F.max(F.col(name)).alias("largest"))


@query
def classify_evidence(spark, d):
    km = K.keymap_scd1(_snap(spark, d, "legacy_customer"), _snap(spark, d, "target_customer"))
    return reduce(DataFrame.unionByName, [C.classify_evidence(_named(spark, d, t), "fk", km).withColumn("consumer_table", F.lit(t)) for t in ("fact_orders", "fact_mixed")])


def _dim(spark, d, name="target_customer"):
    return _snap(spark, d, name)


def _filled(spark, d):
    km = K.keymap_scd1(_snap(spark, d, "legacy_customer"), _dim(spark, d))
    return C.populate_legacy(_named(spark, d, "fact_orders"), ROLE, km, None)


def _back(df, dim, on, *columns):
    """The natural key behind a filled hash, for a comparison without hashes."""
    known = dim.select(F.col("nk_hash").alias("_h"), F.col("natural_key").alias("resolved")).distinct()
    return df.join(known, F.col(on) == F.col("_h"), "left").select(*columns, "resolved")


@query
def populate_legacy_scd1(spark, d):
    return _back(_filled(spark, d), _dim(spark, d), NK, "o_orderkey", "fk")


def _filled_a(spark, d):
    km = K.keymap_path_a(_snap(spark, d, "legacy_a"), _snap(spark, d, "target_a"))
    return C.populate_legacy(_named(spark, d, "fact_a"), ROLE, km, "A")


@query
def populate_path_a(spark, d):
    known = _snap(spark, d, "target_a").select(F.col("ver_hash").alias("_v"), F.col("s").alias("version"))
    return _filled_a(spark, d).join(known, F.col(VER) == F.col("_v"), "left").select("o_orderkey", "fk", "version", F.col(NK).isNotNull().alias("member"))


def _filled_b(spark, d):
    km = K.keymap_path_b(_snap(spark, d, "legacy_b"), _snap(spark, d, "target_b"))
    return C.populate_legacy(_named(spark, d, "fact_b"), ROLE, km, "B")


@query
def populate_path_b(spark, d):
    return _back(_filled_b(spark, d), _snap(spark, d, "target_b"), NK, "o_orderkey", "l_linenumber", "fk")


@query
def populate_reloaded(spark, d):
    done = C.populate_reloaded(_named(spark, d, "fact_reloaded"), ROLE, _dim(spark, d), "new_sk")
    return _back(done, _dim(spark, d), NK, "o_orderkey", "fk")


# ---------------------------------------------------------------- validation
@query
def validate_coverage(spark, d):
    return C.coverage(_filled(spark, d), "fk", NK)


@query
def validate_member_ri(spark, d):
    return C.member_ri(_filled(spark, d), NK, _dim(spark, d).filter("new_sk % 100 <> 5"))


@query
def validate_version_ri_a(spark, d):
    return C.member_ri(_filled_a(spark, d), VER, _snap(spark, d, "target_a").filter("new_sk % 100 <> 5"), "ver_hash", "version_ri_pathA")


@query
def validate_ver_coverage(spark, d):
    f = _filled_a(spark, d)
    return C.check("ver_hash_coverage", f.filter(F.col(NK).isNotNull() & F.col(VER).isNull()).agg(F.count(F.lit(1))))


@query
def validate_version_ri_b(spark, d):
    return C.version_ri_b(_filled_b(spark, d), NK, "event", _snap(spark, d, "target_b"))


@query
def validate_event_nulls(spark, d):
    f = _filled_b(spark, d).withColumn("event", F.when(F.col("o_orderkey") % 10 != 0, F.col("event")))
    return C.event_nulls(f, NK, "event")


@query
def validate_exactly_one_window(spark, d):
    return C.exactly_one_window(_filled_b(spark, d), NK, "event", _snap(spark, d, "target_b"))


@query
def measure_recon(spark, d):
    km = K.keymap_scd1(_snap(spark, d, "legacy_customer"), _dim(spark, d))
    off = _filled(spark, d).withColumn("price", F.when(F.col("o_orderkey") % 997 == 0, F.col("price") + 5).otherwise(F.col("price")))
    return C.measure_recon(_named(spark, d, "fact_orders"), "fk", km, off, NK, ["price"])


@query
def hub_consistency(spark, d):
    other = ConsumerRole("fact_orders", "fk2", "dim_customer")
    f = _filled(spark, d).withColumn("fk2", F.col("o_orderkey")).withColumn(other.hash_cols[0], F.when(F.col("o_orderkey") % 3 != 0, F.lit(1)))
    return C.hub_consistency(f, [ROLE, other])


# ---------------------------------------------------------------- sweep
@query
def sweep_order(spark, d):
    return C.sweep_order(rows(spark, "roles"), rows(spark, "hubs"))


@query
def sweep_gate(spark, d):
    return C.sweep_gate(rows(spark, "results"), rows(spark, "roles").select("consumer_table", "fk_col"))


def _swept(spark, d):
    return C.sweep_equi(_filled(spark, d), "fk", NK, _dim(spark, d))


@query
def sweep_scd1(spark, d):
    return _swept(spark, d).select("o_orderkey", "fk")


@query
def sweep_path_a(spark, d):
    return C.sweep_equi(_filled_a(spark, d), "fk", VER, _snap(spark, d, "target_a"), "ver_hash").select("o_orderkey", "fk")


@query
def sweep_path_b(spark, d):
    return C.sweep_asof(_filled_b(spark, d), "fk", NK, "event", _snap(spark, d, "target_b")).select("o_orderkey", "l_linenumber", "fk")


@query
def sweep_multi_role(spark, d):
    """Two roles in one rewrite: the updates fuse into one job."""
    f = _filled(spark, d)
    two = ConsumerRole("fact_orders", "fk2", "dim_customer")
    f = f.join(_named(spark, d, "fact_reloaded").withColumnRenamed("fk", "fk2"), "o_orderkey")
    f = C.populate_reloaded(f, two, _dim(spark, d), "new_sk").withColumn("fk2", F.col("fk2") + 0)
    out = C.sweep_equi(C.sweep_equi(f, "fk", NK, _dim(spark, d)), "fk2", two.hash_cols[0], _dim(spark, d))
    return C.assign_orphans(C.assign_orphans(out, "fk", NK), "fk2", two.hash_cols[0]).select("o_orderkey", "fk", "fk2")


@query
def sweep_idempotent(spark, d):
    once = _swept(spark, d)
    return C.sweep_equi(once, "fk", NK, _dim(spark, d)).select("o_orderkey", "fk")


@query
def sweep_metrics(spark, d):
    """Rows that a sweep updates, and all rows, as observed while the sweep is written."""
    metrics = Observation()
    C.sweep_equi(_filled(spark, d), "fk", NK, _dim(spark, d), metrics=metrics).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(metrics.get["rows_updated"], metrics.get["rows"])], "rows_updated long, rows long")


@query
def orphan_assign(spark, d):
    return C.assign_orphans(_swept(spark, d), "fk", NK).select("o_orderkey", "fk")


@query
def post_sweep_ri(spark, d):
    return C.post_sweep(_swept(spark, d), "fk", NK, _dim(spark, d))


# ---------------------------------------------------------------- promotion
@query
def promote_merge(spark, d):
    prod = _named(spark, d, "fact_orders")
    wip = _swept(spark, d).filter("o_orderkey % 10 <> 4").withColumn("resolved", F.col(NK).isNotNull())
    return C.promote_merge(prod, wip, ["o_orderkey"], ["fk", "resolved"]).select("o_orderkey", "fk", "price", "resolved")


@query
def promote_drift(spark, d):
    prod = _named(spark, d, "fact_orders")
    return C.drift(prod, prod.filter("o_orderkey % 10 <> 4"), ["o_orderkey"]).select("o_orderkey")


def _promoted(spark, d, how):
    store = TableStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    store.write("prod", "fact_orders", _named(spark, d, "fact_orders").select("o_orderkey", "fk"))
    store.clone("prod", "fact_orders", "wip", "fact_orders__r1")
    store.write("wip", "fact_orders__r1", _swept(spark, d).select("o_orderkey", "fk"))
    if how == "swap":
        store.swap("prod", "fact_orders", "wip", "fact_orders__r1")
        old = store.read("prod", "fact_orders", back=1).withColumnRenamed("fk", "old")
        return store.read("prod", "fact_orders").join(old, "o_orderkey")
    store.view("wip", "fact_orders__r1", "v_fact_orders")
    return store.read("view", "v_fact_orders")


@query
def promote_swap(spark, d):
    return _promoted(spark, d, "swap")


@query
def promote_view(spark, d):
    return _promoted(spark, d, "view")


# ---------------------------------------------------------------- a whole run
GIVEN = {
    "setup_profile": "full", "repair_mode": "opt_out", "apply_orphan_sk": "true", "repair_target_mode": "wip_clone", "require_validation": "false",
    "providers_json": '[{"provider_table": "customer", "archetype": "SCD1", "sk_col": "new_sk", "nk_cols": ["nk"]}, {"provider_table": "version", "archetype": "SCD2", "sk_col": "new_sk2", "nk_cols": ["nk"], "effective_start_col": "s", "effective_end_col": "e"}]',
    "consumer_overrides_json": '[{"consumer_table": "fact", "fk_col": "new_sk", "measure_cols": ["price"]}, {"consumer_table": "fact_b", "fk_col": "new_sk2", "event_date_col": "event"}]',
    "classifications_json": '[{"consumer_table": "fact", "fk_col": "new_sk", "classification": "LEGACY_KEYED"}, {"consumer_table": "fact_b", "fk_col": "new_sk2", "classification": "LEGACY_KEYED"}]',
    "wip_row_keys_json": '[{"table": "fact", "row_key_cols": ["o_orderkey"]}, {"table": "fact_b", "row_key_cols": ["o_orderkey", "l_linenumber"]}]',
}
_runs: dict = {}


def _run(spark, d) -> driver.Repair:
    """A run from discovery to promotion on the fixtures, once in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _runs:
        store = TableStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
        for kind, side, sk, one in (("source", "legacy", "old_sk", 1), ("prod", "target", "new_sk", 0)):
            store.write(kind, "customer", _named(spark, d, f"{side}_customer").select(F.col(sk).alias("new_sk"), "nk"))
            store.write(kind, "version", _named(spark, d, f"{side}_b").select(F.col(sk).alias("new_sk2"), "nk", "s", "e"))
            store.write(kind, "fact", _named(spark, d, "fact_orders").select("o_orderkey", F.col("fk").alias("new_sk"), "price"))
            store.write(kind, "fact_b", _named(spark, d, "fact_b").withColumnRenamed("fk", "new_sk2"))
        run = driver.Repair(spark, store, GIVEN, run_id="r1", now=dt.datetime(2024, 1, 1))
        run.run()
        _runs[key] = run
    return _runs[key]


@query
def keymap_policy(spark, d):
    """How the run's key-maps say that versions meet, and their rows by status."""
    run = _run(spark, d)
    policy = [(t, run.store.properties("keymap", t)["ri_repair.version_match"]) for t in ("customer", "version")]
    counts = run.store.read("config", "keymap_audit").select("provider_table", "map_status", "cnt")
    return counts.join(spark.createDataFrame(policy, "provider_table string, version_match string"), "provider_table")


@query
def validate_battery(spark, d):
    return _run(spark, d).store.read("config", "validation_results").select("run_id", "consumer_table", "fk_col", "check_name", "violations", "verdict")


@query
def sweep_results(spark, d):
    return _run(spark, d).store.read("config", "sweep_results").select("run_id", "consumer_table", "fk_col", "action", "rows_updated", "post_check_violations")


@query
def promoted_fact(spark, d):
    return _run(spark, d).store.read("prod", "fact").select("o_orderkey", "new_sk")


# ---------------------------------------------------------------- generic lookups
@query
def asof_lookup(spark, d):
    f = _named(spark, d, "fact_orders").withColumn("h", keys.nk_hash((F.col("fk") - 1).cast("string")))
    return C.asof_lookup(f, "h", "event", _snap(spark, d, "target_b")).select("o_orderkey", "new_sk")


@query
def overlap_lookup(spark, d):
    return C.overlap_lookup(_snap(spark, d, "legacy_b"), _snap(spark, d, "target_b")).select(F.col("l_old_sk").alias("old_sk"), F.col("r_new_sk").alias("new_sk"))
