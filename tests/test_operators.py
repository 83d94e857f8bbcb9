import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparkrekey.functions import keys
from sparkrekey.model import ConsumerRole, ProviderSpec
from sparkrekey.operators import consumers as C
from sparkrekey.operators import keymap as K
from sparkrekey.operators import merge as M
from sparkrekey.plans import registry as R
from sparkrekey.sources.store import TableStore, wip_name

T0 = dt.datetime(2020, 1, 1)


def day(n):
    return None if n is None else T0 + dt.timedelta(days=n)


def test_keys(spark):
    df = spark.createDataFrame([(" a ", "b||c", None, "12x"), ("\ta", "~null~", "é", "7")], "a string, b string, c string, n string")
    got = [r[0] for r in df.select(keys.nk_string(["a", "b", "c", "n"], {"n": "bigint"})).collect()]
    assert got == ["A||B||C||~NULL~||~NULL~", "\tA||~NULL~||É||7"]
    assert [r[0] for r in df.select(keys.bad_numbers("n", "bigint")).collect()] == [1, 0]
    assert len({r[0] for r in spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "a string, b string").select(keys.nk_string(["a", "b"], lengths=True)).collect()}) == 2
    with pytest.raises(ValueError):
        keys.normalized("a", "float16")
    with pytest.raises(ValueError):
        keys.nk_string([])


def test_version_hash_of_null_start(spark):
    df = spark.createDataFrame([("x", None), ("x", T0)], "k string, s timestamp_ntz")
    assert [r[0] is None for r in df.select(keys.ver_hash(F.col("k"), "s")).collect()] == [True, False]


def test_guarded_update(spark):
    t = spark.createDataFrame([(1, 10), (2, 20), (3, None), (None, 40)], "k long, v long")
    s = spark.createDataFrame([(1, 11), (2, 20), (3, 33), (None, 44)], "k long, n long")
    when = lambda r: F.col("v") != r["n"]
    once = M.guarded_update(t, s, ["k"], {"v": "n"}, when)
    assert sorted(map(tuple, once.collect()), key=str) == [(1, 11), (2, 20), (3, None), (None, 40)]
    assert sorted(M.guarded_update(once, s, ["k"], {"v": "n"}, when).collect(), key=str) == sorted(once.collect(), key=str)
    twice = s.unionByName(spark.createDataFrame([(1, 12), (9, 1), (9, 2)], s.schema))
    with pytest.raises(Exception, match="several source rows"):
        M.guarded_update(t, twice, ["k"], {"v": "n"}).collect()
    assert M.guarded_update(t.filter("k = 2"), twice, ["k"], {"v": "n"}).count() == 1  # keys that nobody holds may repeat


def test_guarded_update_asof(spark):
    w = spark.createDataFrame([(1, day(0), day(5), 100), (1, day(5), None, 101), (2, day(0), day(9), 200), (2, day(3), day(4), 201)], "k long, s timestamp_ntz, e timestamp_ntz, n long")
    t = spark.createDataFrame([(1, day(5), 7), (1, day(-1), 7), (2, day(1), 7), (3, day(1), 7), (1, None, 7)], "h long, ev timestamp_ntz, v long")
    got = M.guarded_update_asof(t, w, ("h", "k"), "ev", "s", "e", {"v": "n"}).collect()
    assert sorted((r.h, r.v) for r in got) == [(1, 7), (1, 7), (1, 101), (2, 200), (3, 7)]
    with pytest.raises(Exception, match="several windows"):
        M.guarded_update_asof(spark.createDataFrame([(2, day(3), 7)], t.schema), w, ("h", "k"), "ev", "s", "e", {"v": "n"}).collect()


def test_overlap_gate_equals_the_self_join(spark):
    r = random.Random(4)
    rows = [(k % 40, k, day(s), day(s + r.randint(-1, 6)) if r.random() < 0.8 else None) for k in range(160) for s in [r.randint(0, 60)]]
    df = spark.createDataFrame(rows, "nk_hash long, new_sk long, s timestamp_ntz, e timestamp_ntz")
    end = lambda e: e or dt.datetime(9999, 12, 31)
    want = {a[0] for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] < end(b[3]) and b[2] < end(a[3])}
    assert K.overlap_gate(df).first()["violations"] == len(want)


def test_keymap_covers_every_key(spark):
    rows = lambda col, n, m: spark.createDataFrame([(i, f"k{i * m % 7}", i * m % 7) for i in range(n)], f"{col} long, natural_key string, nk_hash long")
    km = K.keymap_scd1(rows("old_sk", 9, 1), rows("new_sk", 5, 2))
    assert {r.old_sk for r in km.collect() if r.old_sk is not None} == set(range(9))
    assert {r.new_sk for r in km.collect() if r.new_sk is not None} == set(range(5))


def test_detect_sk(spark):
    df = spark.createDataFrame([(1, 2, "a")], "key_a long, key_b long, nk string")
    with pytest.raises(ValueError):
        C.detect_sk(df, ["nk"])
    assert C.detect_sk(df, ["KEY_B"]) == "key_a" and C.detect_sk(df, ["nk"], "KEY_B") == "key_b"


def test_evidence_can_say_mixed(spark):
    km = spark.createDataFrame([(i, "MATCHED") for i in range(10)], "old_sk long, map_status string")
    fact = spark.createDataFrame([(i,) for i in range(20)] + [(None,)], "fk long")
    assert {r.suggested for r in C.classify_evidence(fact, "fk", km).collect()} == {"MIXED?"}
    assert C.classify_evidence(fact.filter("false"), "fk", km).count() == 0


def test_specs():
    with pytest.raises(ValueError):
        ProviderSpec("t", "SCD2", "sk", ("nk",))
    with pytest.raises(ValueError):
        ProviderSpec("t", "SCD9", "sk", ("nk",))


def test_store(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}")
    store.write("prod", "T", spark.range(3), {"policy": "A"})
    store.clone("prod", "t", "wip", wip_name("t", "2020 x"))
    store.write("wip", "t__2020_x", store.read("wip", "t__2020_x").filter("id > 0"))  # a table that is being read
    assert store.read("prod", "t").count() == 3 and store.read("wip", "t__2020_x").count() == 2
    store.swap("prod", "t", "wip", "t__2020_x")
    assert store.read("prod", "t").count() == 2 and store.read("prod", "t", back=1).count() == 3
    store.rollback("prod", "t")
    assert store.read("prod", "t").count() == 3 and store.properties("prod", "t")["policy"] == "A"
    store.append("config", "audit", spark.range(1))
    assert store.append("config", "audit", spark.range(1)).count() == 2
    assert [tuple(r) for r in store.columns().collect()] == [("t", "id")]


def test_registry():
    roles = [ConsumerRole("f", c, "d") for c in "abc"]
    reg = R.Registry({})
    reg.discover(roles)
    reg.triage(["F::A"], skip_others=True)
    assert [r.repair_status for r in reg.roles.values()] == ["SELECTED", "SKIPPED", "SKIPPED"]
    reg.classify("f::a", "LEGACY_KEYED")
    reg.validated({"f::a": ["PASS", "INFO"]})
    reg.swept("f::a", 0)
    assert reg.roles["f::a"].repair_status == "FIXED" and not reg.eligible() and len(reg.eligible("promote")) == 1
    with pytest.raises(KeyError):
        reg.triage(["f::z"])
    with pytest.raises(ValueError):
        R.settings({"mode": "x"})
    assert "snapshot" not in R.stages("fact_consumer") and R.in_scope("A", " a, b") and not R.in_scope("c", "a")


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([("A", 1, "x"), ("b", 2, "y")], "k string, v int, p string")
    new = spark.createDataFrame([("a", 5, None), ("c", 6, "z")], old.schema)
    assert {(r.k, r.v, r.p) for r in M.upsert(old, new, "k").collect()} == {("a", 5, "x"), ("b", 2, "y"), ("c", 6, "z")}
    assert {r.k for r in M.insert_only(old, new, ["k"]).collect()} == {"A", "b", "c"}


def test_stamp_stream(spark, tmp_path):
    from sparkrekey.streaming.stamp import stamp

    spark.createDataFrame([(" a ",), ("b",)], "nk string").write.parquet(str(tmp_path / "in"))
    stream = stamp(spark.readStream.schema("nk string").parquet(str(tmp_path / "in")), ["nk"])
    q = stream.writeStream.format("memory").queryName("stamped").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("stamped").filter(F.col("nk_hash") == F.xxhash64(F.upper(F.trim("nk")))).count() == 2


def test_guarded_update_names_and_ambiguity(spark):
    t = spark.createDataFrame([(1, 9, 0), (None, 5, 0), (None, 6, 0), (3, 1, 0)], "k long, v long, _rows long").withColumns({c: F.lit(7) for c in ("_source", "_on_0", "_hit", "_hits", "_key", "_low")})
    s = spark.createDataFrame([(1, 5), (1, 9)], "k long, n long")
    when = lambda r: F.col("v") != r["n"]
    with pytest.raises(Exception, match="several source rows"):
        M.guarded_update(t, s, ["k"], {"v": "n"}, when).collect()
    with pytest.raises(Exception, match="several source rows"):
        M.guarded_update(t, s.unionByName(spark.createDataFrame([(1, 7)], s.schema)), ["k"], {"v": "n"}, lambda r: r["n"] == 7).collect()
    same = spark.createDataFrame([(1, 9), (1, 9)], s.schema)
    got = M.guarded_update(t, same, ["k"], {"v": "n"}, when)
    assert got.columns == t.columns and sorted((r.v for r in got.collect())) == [1, 5, 6, 9]
    w = spark.createDataFrame([(1, day(0), None, 2)], "h long, s timestamp_ntz, e timestamp_ntz, n long")
    asof = M.guarded_update_asof(t.withColumn("ev", F.lit(day(1)).cast("timestamp_ntz")), w, ("k", "h"), "ev", "s", "e", {"v": "n"})
    assert sorted(r.v for r in asof.collect()) == [1, 2, 5, 6]


def test_hashes_against_another_library(spark):
    import struct

    import xxhash

    signed = lambda b: struct.unpack("<q", struct.pack("<Q", xxhash.xxh64(b, seed=42).intdigest()))[0]
    df = spark.createDataFrame([(" ab ", T0)], "k string, s timestamp_ntz")
    text = keys.nk_string(["k"])
    got = df.select(keys.nk_hash(text), keys.ver_hash(text, "s"), keys.ver_hash(text, "s", F.lit("ACTIVE"))).first()
    assert list(got) == [signed(b"AB"), signed(b"AB||2020-01-01 00:00:00"), signed(b"AB||2020-01-01 00:00:00||ACTIVE")]


def test_planted_collisions_are_found(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("c", 2), ("d", 3), ("e", 3), ("f", 3)], "natural_key string, nk_hash long")
    assert tuple(K.collision_gate(df).first()) == ("hash_collision", 2, False)
    assert K.collision_gate(df.filter("nk_hash = 2")).first()["passed"]


def test_settings_store(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}")
    with pytest.raises(ValueError):
        R.active(store)
    R.activate(store, {"orphan_sk": "-7"})
    R.activate(store, {"orphan_sk": "-8", "setup_profile": "fact_consumer"})
    assert R.active(store)["orphan_sk"] == "-8" and R.active(store)["build_keymaps"] == "false" and store.read("config", "package_settings").count() == 2
    store.append("config", "package_settings", spark.createDataFrame([("{}", True)], "settings string, active boolean"))
    with pytest.raises(ValueError, match="several"):
        R.active(store)
    with pytest.raises(ValueError):
        R.settings({"setup_profile": "hub"})


def test_appends_keep_files_and_views_follow(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}")
    store.append("prod", "t", spark.range(2))
    before = store._state("prod", "t")["generations"][-1]
    store.append("prod", "t", spark.range(3).withColumn("x", F.lit("new")))
    store.append("prod", "t", spark.range(0))
    assert store._state("prod", "t")["generations"][-1][:1] == before and len(store._state("prod", "t")["generations"]) == 2
    assert store.read("prod", "t").filter("x IS NULL").count() == 2 and store.read("prod", "t").count() == 5
    store.view("prod", "t", "v_t")
    store.write("prod", "t", spark.range(1))
    assert TableStore(spark, f"file://{tmp_path}").read("view", "v_t").count() == 1


PROVIDERS = """[{"provider_table": "dim_customer", "archetype": "SCD1", "sk_col": "sk_customer", "nk_cols": ["nk"]},
 {"provider_table": "dim_version", "archetype": "SCD2", "sk_col": "sk_version", "nk_cols": ["nk"], "effective_start_col": "s", "effective_end_col": "e"}]"""
ROLES = """[{"consumer_table": "fact", "fk_col": "sk_customer", "classification": "LEGACY_KEYED"}, {"consumer_table": "fact", "fk_col": "sk_version", "classification": "LEGACY_KEYED"}, {"consumer_table": "fact2", "fk_col": "sk_customer", "classification": "RELOADED"}]"""
GIVEN = {
    "setup_profile": "full", "providers_json": PROVIDERS, "classifications_json": ROLES, "repair_mode": "opt_out", "apply_orphan_sk": "true", "wip_row_keys_json": '[{"table": "fact", "row_key_cols": ["id"]}, {"logical_table": "fact2", "row_keys": ["id"]}]',
    "consumer_overrides_json": '[{"consumer_table": "fact", "fk_col": "sk_version", "event_date_col": "event"}, {"consumer_table": "fact", "fk_col": "sk_customer", "measure_cols": ["price"]}]',
}


def warehouse(spark, root):
    """Ten customers whose keys are reversed, members with two versions each, facts on the old keys, one of them an orphan."""
    store = TableStore(spark, f"file://{root}")
    dim = lambda key: spark.createDataFrame([(key(i), f"c{i}") for i in range(10)], "sk_customer long, nk string")
    versions = lambda key, cut: spark.createDataFrame([(key(2 * i + j), f"m{i}", day(0 if not j else cut), day(cut if not j else None)) for i in range(5) for j in (0, 1)], "sk_version long, nk string, s timestamp_ntz, e timestamp_ntz")
    store.write("source", "dim_customer", dim(lambda i: i + 1))
    store.write("prod", "dim_customer", dim(lambda i: 10 - i))
    store.write("source", "dim_version", versions(lambda i: i + 100, 50))
    store.write("prod", "dim_version", versions(lambda i: 109 - i, 60))
    fact = spark.createDataFrame([(i, i % 10 + 1, 100 + i % 10, day(10 if i % 2 == 0 else 70), float(i)) for i in range(40)] + [(99, 55, None, day(1), 1.0)], "id long, sk_customer long, sk_version long, event timestamp_ntz, price double")
    store.write("source", "fact", fact)
    store.write("prod", "fact", fact)
    store.write("prod", "fact2", spark.createDataFrame([(i, 10 - i % 10) for i in range(20)], "id long, sk_customer long"))
    return store


@pytest.mark.parametrize("mode", ["merge_columns", "swap_table", "repoint_view"])
def test_a_run_from_discovery_to_promotion(spark, tmp_path, mode):
    from sparkrekey.plans.driver import Repair

    store = warehouse(spark, tmp_path)
    run = Repair(spark, store, {**GIVEN, "promote_mode": mode}, run_id="r1", now=T0)
    assert run.run() == []
    assert {r.key: r.repair_status for r in run.registry.roles.values()} == {"fact::sk_customer": "FIXED", "fact::sk_version": "FIXED", "fact2::sk_customer": "FIXED"}
    assert run.providers["dim_version"].version_match_path == "B"
    assert [store.properties("keymap", t)["ri_repair.version_match"] for t in ("dim_customer", "dim_version")] == ["none-scd1", "B-event-date"]
    done = {r.id: r for r in (store.read("view", "v_fact") if mode == "repoint_view" else store.read("prod", "fact")).collect()}
    assert all((r.sk_customer, r.sk_version) == (10 - i % 10, 109 - (i % 10 // 2 * 2 + (i % 2))) for i, r in done.items() if i < 40) and done[99].sk_customer == -1
    assert {r.sk_customer for r in store.read("prod", "fact2").collect()} == set(range(1, 11))
    swept = {r.fk_col: r for r in store.read("config", "sweep_results").collect()}
    assert {k: r.post_check_violations for k, r in swept.items()} == {"sk_customer": 0, "sk_version": 0} and swept["sk_customer"].rows_updated == 40
    assert all(r.run_id == "r1" for t in ("gate_results", "version_diagnostics", "keymap_audit", "classification_evidence", "validation_results") for r in store.read("config", t).collect())
    checks = {r.check_name for r in store.read("config", "validation_results").collect()}
    assert checks == {"coverage_null_hash", "member_ri", "version_ri_pathB_window", "event_date_nulls", "measure_reconciliation"}
    assert {r.clone_status for r in store.read("config", "wip_clones").collect()} == {"PROMOTED"}


def test_later_runs_supersede_and_dry_runs_write_nothing(spark, tmp_path):
    from sparkrekey.plans.driver import Repair

    store = warehouse(spark, tmp_path)
    dry = Repair(spark, store, {**GIVEN, "dry_run": "true"}, run_id="r0", now=T0)
    for stage in ("discover", "triage", "snapshot", "clone"):
        getattr(dry, stage)()
    assert "clone fact" in dry.planned and not store.exists("wip", "fact__r0") and not store.exists("staging", "legacy_dim_customer") and not store.exists("config", "wip_clones")
    for run_id in ("r1", "r2"):
        run = Repair(spark, store, GIVEN, run_id=run_id, now=T0)
        for stage in ("discover", "triage", "snapshot", "clone"):
            getattr(run, stage)()
    states = {(r.run_id, r.clone_status) for r in store.read("config", "wip_clones").collect()}
    assert states == {("r1", "SUPERSEDED"), ("r2", "ACTIVE")}
    with pytest.raises(RuntimeError, match="not fit"):
        run.sweep()


def test_a_failed_gate_stops_the_key_map(spark, tmp_path):
    from sparkrekey.plans.driver import Repair

    store = warehouse(spark, tmp_path)
    store.write("prod", "dim_customer", store.read("prod", "dim_customer").unionByName(spark.createDataFrame([(77, "c3")], "sk_customer long, nk string")))
    run = Repair(spark, store, GIVEN, run_id="r1", now=T0)
    for stage in ("discover", "triage", "snapshot", "clone", "provider_hash", "classify"):
        getattr(run, stage)()
    assert not store.exists("keymap", "dim_customer") and store.exists("keymap", "dim_version") and any("nk_hash_unique" in e for e in run.errors)


def test_battery_without_provider_or_hash(spark):
    from sparkrekey.plans.driver import battery

    role, t = ConsumerRole("f", "fk", "d"), spark.range(1).withColumn("fk", F.lit(1))
    assert battery(t, role, None, None).first()["check_name"] == "provider_configured"
    assert battery(t, role, ProviderSpec("d", "SCD1", "sk", ("nk",)), None).first()["check_name"] == "hash_column_present"
    assert R.review(spark.createDataFrame([("f", "fk", "D", "SELECTED")], "consumer_table string, fk_col string, provider_table string, repair_status string"), spark.createDataFrame([("d", "SCD1")], "provider_table string, archetype string")).first()["archetype"] == "SCD1"


def test_lookup_stream(spark, tmp_path):
    from sparkrekey.streaming.stamp import lookup

    spark.createDataFrame([(1,), (2,), (None,)], "fk long").write.parquet(str(tmp_path / "in"))
    km = spark.createDataFrame([(1, 10, "MATCHED"), (2, 20, "AMBIGUOUS")], "old_sk long, new_sk long, map_status string")
    q = lookup(spark.readStream.schema("fk long").parquet(str(tmp_path / "in")), km, "fk").writeStream.format("memory").queryName("looked_up").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.fk, r.new_sk) for r in spark.table("looked_up").collect()} == {(1, 10), (2, None), (None, None)}
