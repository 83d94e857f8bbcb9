"""Snapshots, diagnostics and key-maps: old key, natural key, new key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrekey.functions.keys import multi_hash, nk_hash, nk_string, normalized_leniently, overlaps, status_class, ver_hash, window_end
from sparkrekey.model import ORPHAN_WARNING, PATH_A_SHARE, ProviderSpec


def snapshot(table: DataFrame, p: ProviderSpec, key: str = "old_sk") -> DataFrame:
    """Key, natural key and hash (and window, status) of a provider: only these columns are read."""
    text = nk_string(list(p.nk_cols), p.nk_type_overrides)
    status = status_class(p.record_status_col) if p.record_status_col else F.lit("ACTIVE")
    out = [F.col(p.sk_col).cast("long").alias(key), text.alias("natural_key"), nk_hash(text).alias("nk_hash")]
    if p.versioned:
        end = F.col(p.effective_end_col) if p.effective_end_col else F.lit(None).cast("timestamp_ntz")
        out += [F.col(p.effective_start_col).alias("s"), end.alias("e"), status.alias("status_class"), ver_hash(text, p.effective_start_col, status if p.use_status_tiebreaker else None).alias("ver_hash")]
    return table.select(*out)


def three_way(left: Column, right: Column) -> Column:
    return F.when(left.isNotNull() & right.isNotNull(), "MATCHED").when(left.isNotNull(), "ORPHAN_OLD").otherwise("ORPHAN_NEW")


def _sides(legacy: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    old = legacy.select(*(F.col(c).alias(f"l_{c}") for c in legacy.columns))
    new = target.select(*(F.col(c).alias(f"t_{c}") for c in target.columns))
    return old.join(new, [F.col(f"l_{k}") == F.col(f"t_{k}") for k in keys], "full_outer")


def _keymap(joined: DataFrame, versioned: bool) -> DataFrame:
    either = lambda c: F.coalesce(f"t_{c}", f"l_{c}").alias(c)
    none = lambda t: F.lit(None).cast(t)
    return joined.select(
        either("natural_key"), either("nk_hash"), (either("s") if versioned else none("timestamp_ntz")).alias("effectiveStartDate"), (F.col("t_e") if versioned else none("timestamp_ntz")).alias("effectiveEndDate"),
        (either("ver_hash") if versioned else none("long")).alias("ver_hash"), F.col("l_old_sk").alias("old_sk"), F.col("t_new_sk").alias("new_sk"), three_way(F.col("l_nk_hash"), F.col("t_nk_hash")).alias("map_status"),
    )


def keymap_scd1(legacy: DataFrame, target: DataFrame) -> DataFrame:
    """One shuffle a side on the hash."""
    return _keymap(_sides(legacy, target, ["nk_hash"]), False)


def keymap_path_a(legacy: DataFrame, target: DataFrame, tiebreak: bool = False) -> DataFrame:
    """Versions meet by natural key and start, and by status class if that tells them apart."""
    return _keymap(_sides(legacy, target, ["nk_hash", "s", *(["status_class"] if tiebreak else [])]), True)


def keymap_path_b(legacy: DataFrame, target: DataFrame) -> DataFrame:
    """Versions meet where their windows overlap; an old key with several new ones is AMBIGUOUS; members that only the target has follow.

    The equi-join on the member's hash carries the overlap as a residual condition, so rows multiply by a member's versions only."""
    old = legacy.select(*(F.col(c).alias(f"l_{c}") for c in legacy.columns))
    new = target.select(*(F.col(c).alias(f"t_{c}") for c in target.columns))
    hit = old.join(new, (F.col("l_nk_hash") == F.col("t_nk_hash")) & overlaps("l_s", "l_e", "t_s", "t_e"), "left")
    many = F.count("t_new_sk").over(Window.partitionBy("l_old_sk"))
    status = F.when(F.col("t_new_sk").isNull(), "ORPHAN_OLD").when(many > 1, "AMBIGUOUS").otherwise("MATCHED")
    none = F.lit(None).cast("long").alias("ver_hash")
    first = hit.select(F.col("l_natural_key").alias("natural_key"), F.col("l_nk_hash").alias("nk_hash"), F.coalesce("t_s", "l_s").alias("effectiveStartDate"), F.col("t_e").alias("effectiveEndDate"), none, F.col("l_old_sk").alias("old_sk"), F.col("t_new_sk").alias("new_sk"), status.alias("map_status"))
    fresh = target.join(legacy.select("nk_hash").distinct(), "nk_hash", "left_anti")
    rest = fresh.select("natural_key", "nk_hash", F.col("s").alias("effectiveStartDate"), F.col("e").alias("effectiveEndDate"), none, F.lit(None).cast("long").alias("old_sk"), "new_sk", F.lit("ORPHAN_NEW").alias("map_status"))
    return first.unionByName(rest)


def keymap_pairwise(source: DataFrame, target: DataFrame, nk_cols: list[str], source_sk: str, target_sk: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Two tables side by side: rows of a key pair up by ordinal; a key that either side has twice is DUPLICATE."""
    if not nk_cols:
        raise ValueError("a natural key needs a column")

    def side(df, sk, p):
        text = F.concat_ws("||", *(normalized_leniently(c) for c in nk_cols))
        key = Window.partitionBy("h")
        df = df.withColumn("k", text).withColumn("h", multi_hash(nk_cols, start))
        none = F.lit(None).cast("timestamp_ntz")
        return df.select(
            F.col("h").alias(f"{p}h"), F.col("k").alias(f"{p}k"), F.col(sk).cast("long").alias(f"{p}_sk"), (F.col(start) if start else none).alias(f"{p}s"), (F.col(end) if end else none).alias(f"{p}e"),
            F.count(F.lit(1)).over(key).alias(f"{p}n"), F.row_number().over(key.orderBy(F.col(sk).asc_nulls_last(), "k")).alias(f"{p}i"),
        )

    j = side(source, source_sk, "s").join(side(target, target_sk, "t"), (F.col("sh") == F.col("th")) & (F.col("si") == F.col("ti")), "full_outer")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    status = F.when((count("sn") > 1) | (count("tn") > 1), "DUPLICATE").when(F.col("s_sk").isNotNull() & F.col("t_sk").isNotNull(), "MATCHED").when(F.col("s_sk").isNotNull(), "ORPHAN_OLD").otherwise("ORPHAN_NEW")
    return j.select(
        F.coalesce("sk", "tk").alias("natural_key"), F.coalesce("sh", "th").alias("match_hash"), F.coalesce("ss", "ts").alias("effectiveStartDate"), F.coalesce("se", "te").alias("effectiveEndDate"),
        F.col("s_sk").alias("old_sk"), F.col("t_sk").alias("new_sk"), count("sn").alias("source_row_count"), count("tn").alias("target_row_count"), status.alias("map_status"),
    )


def audit(keymap: DataFrame) -> DataFrame:
    """Rows by status, their share, and whether there are more old orphans than usual."""
    n = keymap.groupBy("map_status").agg(F.count(F.lit(1)).alias("cnt"))
    share = F.col("cnt") / F.sum("cnt").over(Window.partitionBy())
    return n.withColumn("share", share).withColumn("warning", (F.col("map_status") == "ORPHAN_OLD") & (F.col("share") > ORPHAN_WARNING))


def version_diagnostic(legacy: DataFrame, target: DataFrame, threshold: float = PATH_A_SHARE) -> DataFrame:
    """(natural key, start) versions by side, the share of legacy ones that survived, and the path it suggests."""
    a = legacy.groupBy("nk_hash", "s").agg(F.count(F.lit(1)).alias("l"))
    b = target.groupBy("nk_hash", "s").agg(F.count(F.lit(1)).alias("t"))
    status = F.when(F.col("l").isNotNull() & F.col("t").isNotNull(), "MATCHED").when(F.col("l").isNotNull(), "ONLY_LEGACY").otherwise("ONLY_TARGET")
    n = a.join(b, ["nk_hash", "s"], "full_outer").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("version_rows"))
    every = Window.partitionBy()  # three rows at most
    matched = F.coalesce(F.sum(F.when(F.col("status") == "MATCHED", F.col("version_rows"))).over(every), F.lit(0))
    known = F.coalesce(F.sum(F.when(F.col("status") != "ONLY_TARGET", F.col("version_rows"))).over(every), F.lit(0))
    out = n.withColumn("matched_pct", F.when(known > 0, matched / known).otherwise(F.lit(0.0)))
    return out.withColumn("suggested_path", F.when(F.col("matched_pct") >= threshold, "A").otherwise("B"))


def duplicate_groups(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """gate, violations: groups of equal keys with more than one row."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _gate(n, name)


def _gate(bad: DataFrame, name: str) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("gate"), "violations", (F.col("violations") == 0).alias("passed"))


def collision_gate(df: DataFrame, text: str = "natural_key", hashed: str = "nk_hash") -> DataFrame:
    """Hashes that more than one text has."""
    return _gate(df.groupBy(hashed).agg(F.countDistinct(text).alias("n")).filter("n > 1"), "hash_collision")


def overlap_gate(df: DataFrame, key: str = "nk_hash", sk: str = "new_sk", start: str = "s", end: str = "e") -> DataFrame:
    """Members with two windows that overlap: one sort by start, each start compared with the latest end so far.

    That equals the self-join for windows with start < end; a member with an empty, reversed or startless window, or a repeated key, is compared pair by pair."""
    odd = df.filter(F.col(start).isNull() | (F.col(start) >= window_end(end)) | F.col(sk).isNull()).select(key)
    twice = df.groupBy(key, sk).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    odd = odd.unionByName(twice).distinct()
    before = Window.partitionBy(key).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    plain = df.filter(F.col(key).isNotNull()).join(odd, key, "left_anti").withColumn("_end", F.max(window_end(end)).over(before))
    bad = plain.filter(F.col(start) < F.col("_end")).select(key).distinct()
    rest = df.join(odd, key, "left_semi")
    a, b = (rest.select(F.col(key).alias(f"{p}k"), F.col(sk).alias(f"{p}sk"), F.col(start).alias(f"{p}s"), F.col(end).alias(f"{p}e")) for p in "ab")
    pairs = a.join(b, (F.col("ak") == F.col("bk")) & (F.col("ask") < F.col("bsk")) & overlaps("as", "ae", "bs", "be")).select(F.col("ak").alias(key)).distinct()
    return _gate(bad.unionByName(pairs), "window_overlap")
