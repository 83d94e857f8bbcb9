"""Hashes for arriving rows, so that a later repair needs no snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sparkrekey.functions.keys import nk_hash, nk_string, ver_hash


def stamp(rows: DataFrame, nk_cols: list[str], start_col: str | None = None, formats: dict[str, str] | None = None) -> DataFrame:
    """rows (a stream or not) with nk_hash, and ver_hash if start_col is given: stateless, so no watermark is needed."""
    text = nk_string(nk_cols, formats)
    out = rows.withColumn("nk_hash", nk_hash(text))
    return out.withColumn("ver_hash", ver_hash(text, start_col)) if start_col else out


def lookup(stream: DataFrame, keymap: DataFrame, fk_col: str) -> DataFrame:
    """The stream with the key-map's new_sk for its old key: a stream-static left join."""
    known = keymap.filter("map_status = 'MATCHED'").select("old_sk", "new_sk")
    return stream.join(known, stream[fk_col] == known["old_sk"], "left").drop("old_sk")
