"""Updates of a table by another, as joins: parquet has no MERGE."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sparkrekey.functions.keys import in_window


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where df has a column so called (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _updated(joined: DataFrame, columns: list[str], hit: Column, new: dict[str, Column], metrics: Observation | None) -> DataFrame:
    """The columns, those of `new` replaced where hit is true; metrics gets rows_updated and rows."""
    (flag,) = fresh(joined, "_hit")
    joined = joined.withColumn(flag, hit)
    if metrics is not None:
        joined = joined.observe(metrics, F.count(F.when(F.col(flag), 1)).alias("rows_updated"), F.count(F.lit(1)).alias("rows"))
    return joined.select(*(F.when(F.col(flag), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in columns))


def guarded_update(target: DataFrame, source: DataFrame, on: dict[str, str] | list[str], set: dict[str, str], when: Callable[[Column], Column] | None = None, metrics: Observation | None = None, seen: tuple[str, ...] = ()) -> DataFrame:
    """target with the columns of `set` (target column: source column) taken from the one source row of equal key, where `when` of that row is true.

    on: target column to source column, or names that both have. `when` sees the source columns of `set` and those named in `seen`. No match, or a `when` that is false or null, changes nothing; several source rows for a key
    that a row would be updated by are an error: of two, if the guard holds for either; of more that differ, always. Rows are neither added nor lost; a null key matches nothing, and such rows
    are spread over the tasks. The source is summed up to one row a key before the join, so a hot key in the target meets a single row. metrics gets rows_updated."""
    on = {k: k for k in on} if isinstance(on, list) else on
    rows, low, high, spread, *keys = fresh(target, "_rows", "_low", "_high", "_spread", *(f"_on_{i}" for i in range(len(on))))
    row = F.struct(*sorted({*set.values(), *seen}))
    known = source.filter(" AND ".join(f"`{s}` IS NOT NULL" for s in on.values()))
    known = known.groupBy(*(F.col(s).alias(k) for k, s in zip(keys, on.values()))).agg(F.count(F.lit(1)).alias(rows), F.min(row).alias(low), F.max(row).alias(high))
    empty = F.lit(False)
    for t in on:
        empty = empty | F.col(t).isNull()
    wide = target.withColumn(spread, F.when(empty, F.xxhash64(*target.columns)).otherwise(F.lit(0).cast("long")))
    match = [F.col(t) == F.col(k) for t, k in zip(on, keys)] + [F.col(spread) == F.col(f"{spread}0")]
    joined = wide.join(known.withColumn(f"{spread}0", F.lit(0).cast("long")), match, "left")
    hit = F.col(rows).isNotNull()
    if when is not None:
        either = F.coalesce(when(F.col(low)), F.lit(False)) | F.coalesce(when(F.col(high)), F.lit(False))
        hit = hit & (either | ((F.col(rows) > 2) & (F.col(low) != F.col(high))))
    hit = F.when(hit & (F.col(rows) > 1), F.raise_error(F.lit("several source rows match a key")).cast("boolean")).otherwise(hit)
    return _updated(joined, target.columns, hit, {t: F.col(high)[s] for t, s in set.items()}, metrics)


def window_lists(windows: DataFrame, key: str, start: str, end: str, values: list[str], names: tuple[str, str]) -> DataFrame:
    """One row a key with its windows in an array: as many as the key has versions."""
    row = F.struct(F.col(start).alias("s"), F.col(end).alias("e"), F.struct(*values).alias("v"))
    return windows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(names[0])).agg(F.sort_array(F.collect_list(row)).alias(names[1]))


def asof_hits(target: DataFrame, windows: DataFrame, key: tuple[str, str], event: str, start: str, end: str, values: list[str], hits: str = "_hits") -> DataFrame:
    """target with `hits`, the windows of its key that hold the event (each with its values as v): an equi-join to one row a key, so no rows multiply. Ranges are filtered in the row."""
    names = tuple(fresh(target, "_key", "_windows"))
    joined = target.join(window_lists(windows, key[1], start, end, values, names), F.col(key[0]) == F.col(names[0]), "left")
    return joined.withColumn(hits, F.filter(F.col(names[1]), lambda w: in_window(F.col(event), w["s"], w["e"]))).drop(*names)


def guarded_update_asof(target: DataFrame, windows: DataFrame, key: tuple[str, str], event: str, start: str, end: str, set: dict[str, str], metrics: Observation | None = None, only_changes: bool = True) -> DataFrame:
    """guarded_update where the source row is the key's window that holds the event; two such windows are an error."""
    (hits,) = fresh(target, "_hits")
    joined = asof_hits(target, windows, key, event, start, end, sorted({*set.values()}), hits)
    number = F.coalesce(F.size(hits), F.lit(0))
    one = lambda s: F.get(hits, F.lit(0))["v"][s]
    hit = number > 0
    if only_changes:
        changed = F.lit(False)
        for t, s in set.items():
            changed = changed | F.exists(F.coalesce(F.col(hits), F.array().cast(joined.schema[hits].dataType)), lambda w: F.coalesce(F.col(t) != w["v"][s], F.lit(False)))
        hit = hit & changed
    hit = F.when(hit & (number > 1), F.raise_error(F.lit("several windows hold an event")).cast("boolean")).otherwise(hit)
    return _updated(joined, target.columns, hit, {t: one(s) for t, s in set.items()}, metrics)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with new's rows in place of those with the same key, whatever its case; columns that new leaves null keep old's value."""
    k = F.lower(F.trim(F.col(key)))
    before = old.withColumn("_k", k).select("_k", *(F.col(c).alias(f"_old_{c}") for c in old.columns))
    after = new.withColumn("_k", k)
    kept = old.withColumn("_k", k).join(after.select("_k"), "_k", "left_anti").drop("_k")
    merged = after.join(before, "_k", "left").select(*(F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) if c in new.columns else F.col(f"_old_{c}").alias(c) for c in old.columns))
    return kept.unionByName(merged)


def insert_only(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with those of new's rows whose keys, whatever their case, it doesn't have."""
    k = [F.lower(F.col(c)).alias(f"_{i}") for i, c in enumerate(keys)]
    names = [f"_{i}" for i in range(len(keys))]
    fresh = new.select("*", *k).join(old.select(*k).distinct(), names, "left_anti").drop(*names)
    return old.unionByName(fresh, allowMissingColumns=True)


def ensure_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c.lower() not in have})
