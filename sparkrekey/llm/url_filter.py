"""URL rules behind a blocked Bloom filter."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read

#: verdict, host, path: a rule fits its host, all subdomains, and all paths that begin with its path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits for a key, and the largest filter that is broadcast (16 MB: some 8 million rules); a larger one stays distributed and meets the keys block by block.
BITS_PER_KEY, MOST_BYTES = 16, 16 << 20
#: Odd numbers that pick a bit in each of a block's eight 32-bit words.
WORDS = [f"w{i}" for i in range(8)]
SALTS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


class BlockedBloom:
    """A Bloom filter whose blocks are eight 32-bit words; a key sets one bit in each word of one block."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def blocks_for(keys: int) -> int:
        return max(1, -(-keys * BITS_PER_KEY // 256))

    @staticmethod
    def places(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
        keys = keys.view(np.uint64)
        block = ((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        with np.errstate(over="ignore"):
            bits = (low[:, None] * np.array(SALTS, np.uint32)[None, :]) >> np.uint32(27)
        return block.astype(np.int64), np.uint32(1) << bits

    def test(self, keys: np.ndarray) -> np.ndarray:
        block, masks = self.places(keys, len(self.words))
        return ((self.words[block] & masks) == masks).all(axis=1)

    @classmethod
    def rows(cls, keys: DataFrame, blocks: int, *carried: str) -> DataFrame:
        """b (block) and w0 to w7 (the bits that the column `k` sets in it), after the carried columns."""

        def bits(batches):
            for batch in batches:
                block, masks = cls.places(batch.column("k").to_numpy(zero_copy_only=False).astype(np.int64), blocks)
                columns = [batch.column(c) for c in carried] + [pa.array(block)] + [pa.array(masks[:, i].astype(np.int64)) for i in range(8)]
                yield pa.RecordBatch.from_arrays(columns, [*carried, "b", *WORDS])

        types = dict(keys.dtypes)
        return keys.mapInArrow(bits, ", ".join([*(f"{c} {types[c]}" for c in carried), "b long", *(f"{w} long" for w in WORDS)]))

    @classmethod
    def table(cls, keys: DataFrame, blocks: int) -> DataFrame:
        """The filter as a row for each block in use."""
        return cls.rows(keys.select("k"), blocks).groupBy("b").agg(*(F.bit_or(w).alias(w) for w in WORDS))


def passing(wanted: DataFrame, rules: DataFrame, count: int, most: int = MOST_BYTES) -> DataFrame:
    """The rows of wanted (with a hash `k`) that may be among the rules' `count` hashes `k`: a filter of up to `most` bytes is broadcast, a larger one joins by its blocks."""
    blocks = BlockedBloom.blocks_for(count)
    table = BlockedBloom.table(rules, blocks)
    if 32 * blocks > most:
        tested = BlockedBloom.rows(wanted, blocks, *wanted.columns).join(table.select("b", *(F.col(w).alias(f"f{w}") for w in WORDS)).hint("merge"), "b")
        return tested.filter(" AND ".join(f"(f{w} & {w}) = {w}" for w in WORDS)).select(*wanted.columns)
    words = np.zeros((blocks, 8), np.uint32)
    for row in table.collect():  # at most `most` bytes
        words[row["b"]] = row[1:]
    bloom = wanted.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf(T.BooleanType())
    def may_be(k: pd.Series) -> pd.Series:
        return pd.Series(BlockedBloom(bloom.value).test(k.to_numpy(np.int64)))

    return wanted.filter(may_be("k"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow", most: int = MOST_BYTES) -> DataFrame:
    """One row for each row of pages: id, host, path, rule (its host and path, or null) and verdict.

    rules: verdict, host, path (canonical: lower-case host); a rule with a null is left out, repeated (host, path) count once
    (a block wins over an allow). The longest rule that fits wins, the longer host at a tie; if none fits, `otherwise`. Every suffix of the url's host
    with every prefix of its path of a length that some rule has is a candidate key; those that pass the Bloom filter meet
    the rules in a hash join on the keys' texts, which removes false positives. Null urls, and those without "://", have
    an empty host and path, which no rule with a host fits. Repeated rows and null ids are kept, each on its own; an empty table, or one without rules, is no error; other columns are not looked at."""
    rules = rules.dropna(subset=["verdict", "host", "path"]).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    sizes = rules.agg(F.count(F.lit(1)), F.sort_array(F.collect_set(F.length("path")))).first()  # lengths: fewer than the longest path has characters
    parts = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url")).select("_id", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
    lengths = F.array(*(F.lit(n) for n in sizes[1])).cast("array<int>")
    labels = F.split("_host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(F.filter(lengths, lambda n: n <= F.length("_path")), lambda n: F.struct(h.alias("host"), F.substring(F.col("_path"), F.lit(1), n).alias("path")))))
    wanted = parts.filter("_host <> ''").select("_host", "_path").distinct()
    wanted = wanted.select("_host", "_path", F.explode(keys).alias("c")).select("_host", "_path", "c.host", "c.path")
    hashed = lambda df: df.withColumn("k", key_of(F.col("host"), F.col("path")))
    wanted = passing(hashed(wanted), hashed(rules), sizes[0], most)
    rank = F.struct(F.length("host") + F.length("path"), F.length("host"), F.concat("host", "path").alias("rule"), "verdict")
    best = wanted.join(rules, ["host", "path"]).groupBy("_host", "_path").agg(F.max(rank).alias("best"))
    # urls without a host meet nothing, and equal urls may be many: only the others are joined, in a way that cuts a hot url's rows
    found = parts.filter("_host <> ''").join(best.hint("merge"), ["_host", "_path"], "left").select("_id", "_host", "_path", "best")
    out = found.unionByName(parts.filter("_host = ''").withColumn("best", F.lit(None).cast(best.schema["best"].dataType)))
    return out.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "verdict string, host string, path string")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), rules_table(spark))


ORACLE = rf"""
WITH rules(verdict, host, path) AS (VALUES {", ".join(map(str, RULES))}),
p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
        coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
hits AS (SELECT p.page_id, max_by({{'rule': r.host || r.path, 'verdict': r.verdict}}, length(r.host) + length(r.path)) AS best
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY 1)
SELECT p.page_id, p.host, p.path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM p LEFT JOIN hits USING (page_id)
"""
