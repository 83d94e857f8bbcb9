"""Token counts by a separator scan over flat, unindexed token files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces, read, work_folder, written
from .tokens import encoder, vocabulary

#: Ids in a block of a token file, and blocks in a group of the prefix scan.
BLOCK, GROUP = 1 << 16, 1 << 10
#: Bytes of a token file that its writer and its readers hold at once.
HELD = 8 << 20
#: Bytes of a raw token file that a task reads.
PART = 64 << 20
END = 50256
BLOCKS = "file string, block long, ids binary"


def token_files(docs: DataFrame, path: str, end: int = END, block: int = BLOCK) -> DataFrame:
    """The documents' ids, each followed by the separator, as flat token files: file, block, ids (little-endian, 32 bits).

    One file for each partition of docs, cut at every `block` ids without regard to documents. The separator's string in a text is ordinary text here,
    so the id only ends documents. What else a row has is `roster`: the ids of the documents in the file's order, in the file's first row."""

    def work(batches):
        from pyspark import TaskContext

        name, number = f"tokens-{TaskContext.get().partitionId():06d}", 0
        ids_of, mark, size = encoder(path, True).ids, end.to_bytes(4, "little"), 4 * block
        kept, roster = bytearray(), []

        def row(ids):
            nonlocal number
            out = pa.RecordBatch.from_pydict({"file": pa.array([name]), "block": pa.array([number], pa.int64()), "ids": pa.array([bytes(ids)], pa.binary()), "roster": pa.array([roster[:]], pa.list_(pa.int64()))})
            number += 1
            roster.clear()
            return out

        for batch in pieces(batches, "_text"):
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kept += ids_of(text or "") + mark
                roster.append(i)
                while len(kept) >= size:
                    yield row(kept[:size])
                    del kept[:size]
        if kept or roster:
            yield row(kept)

    slim = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    return slim.mapInArrow(work, BLOCKS + ", roster array<long>")


def read_blocks(spark: SparkSession, path: str, block: int = BLOCK, part: int = PART) -> DataFrame:
    """file, block, ids of raw token files (little-endian, 32 bits) of any size below a path: `part` bytes of a file are read by a task, block by block.

    Only names and lengths are listed first; executors then open the files by byte range, so the path must be of a file system that pyarrow knows
    (local, hdfs, s3, gs). An empty file has no blocks; bytes after a file's last whole id are left out."""
    size = 4 * block
    part = max(size, part // size * size)
    files = spark.read.format("binaryFile").load(path).filter("length >= 4").select("path", "length")
    parts = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(part).cast("long"))).alias("low"))
    number = files.agg(F.sum(F.ceil(F.col("length") / part))).first()[0] or 1

    def cut(batches: Iterator[pa.RecordBatch]):
        from pyarrow import fs

        for b in batches:
            for name, length, low in zip(*(c.to_pylist() for c in b.columns)):
                store, place = fs.FileSystem.from_uri(name.replace("file:/", "file:///", 1) if name.startswith("file:/") and not name.startswith("file://") else name)
                with store.open_input_file(place) as content:
                    for at in range(low, min(length, low + part) // 4 * 4, size):
                        ids = content.read_at(min(size, length // 4 * 4 - at), at)
                        yield pa.RecordBatch.from_pydict({"file": pa.array([name]), "block": pa.array([at // size], pa.int64()), "ids": pa.array([ids], pa.binary())})

    return parts.repartition(min(int(number), 100_000)).mapInArrow(cut, BLOCKS)


def _scan(end: int):
    def work(batches):
        for b in batches:
            places, priors, sizes = [], [], []
            for ids in b.column("ids"):
                view = np.frombuffer(ids.as_buffer(), "<u4")
                places.append(np.flatnonzero(view == end).astype(np.int32))
                priors.append(np.concatenate([[-1], places[-1][:-1]]).astype(np.int32)[: len(places[-1])])
                sizes.append(len(view))
            yield pa.RecordBatch.from_pydict({
                "file": b.column("file"), "block": b.column("block"), "ids": pa.array(sizes, pa.int64()),
                "places": pa.array(places, pa.list_(pa.int32())), "priors": pa.array(priors, pa.list_(pa.int32())),
            })

    return work


def separator_scan(blocks: DataFrame, end: int = END) -> DataFrame:
    """One row for each document of the files: file, ordinal (from 0), start (ids before it in its file), n_tokens, ended (false: the file ends without a separator).

    Each block is searched on its own for separators; a prefix scan over the blocks' sums (ids, separators, place of the last separator), in groups and then over the
    groups, gives what lies before each block, so a document that spans blocks comes out whole. An empty file, block or table gives no rows;
    two separators in a row are an empty document; a null block counts as empty. Of repeated (file, block) rows one counts (the longest, and of these the greatest separators); other columns are not looked at."""
    found = blocks.select("file", "block", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(_scan(end), "file string, block long, ids long, places array<int>, priors array<int>")
    found = found.groupBy("file", "block").agg(F.max(F.struct("ids", "places", "priors")).alias("x")).select("file", "block", "x.*")
    found = written(found, work_folder(blocks.sparkSession), "separators")
    sums = found.select("file", "block", F.floor(F.col("block") / GROUP).alias("group"), "ids", F.size("places").cast("long").alias("n"), F.when(F.size("places") > 0, F.array_max("places").cast("long")).alias("last"))
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"b_ids": F.coalesce(F.sum("ids").over(inside), F.lit(0)), "b_n": F.coalesce(F.sum("n").over(inside), F.lit(0))})
    sums = sums.withColumn("b_last", F.max(F.col("b_ids") + F.col("last")).over(inside))
    groups = sums.groupBy("file", "group").agg(F.sum("ids").alias("g_ids"), F.sum("n").alias("g_n"), F.max(F.col("b_ids") + F.col("last")).alias("g_last"))
    before = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumns({"a_ids": F.coalesce(F.sum("g_ids").over(before), F.lit(0)), "a_n": F.coalesce(F.sum("g_n").over(before), F.lit(0))})
    groups = groups.withColumn("a_last", F.max(F.col("a_ids") + F.col("g_last")).over(before)).drop("g_ids", "g_n", "g_last")
    at = sums.join(groups, ["file", "group"]).select("file", "block", (F.col("a_ids") + F.col("b_ids")).alias("base"), (F.col("a_n") + F.col("b_n")).alias("seen"), F.coalesce(F.greatest(F.col("a_ids") + F.col("b_last"), F.col("a_last")), F.lit(-1)).alias("prior"))
    spans = found.filter(F.size("places") > 0).select("file", "block", F.arrays_zip("places", "priors").alias("both")).join(at, ["file", "block"])
    docs = spans.select("file", "base", "seen", "prior", F.posexplode("both").alias("i", "s")).select("*", F.col("s.places").alias("place"))
    start = F.when(F.col("i") == 0, F.col("prior")).otherwise(F.col("base") + F.col("s.priors")) + 1
    ended = docs.select("file", (F.col("seen") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("base") + F.col("place") - start).alias("n_tokens"), F.lit(True).alias("ended"))
    open_ = sums.join(groups, ["file", "group"]).groupBy("file").agg(F.sum("ids").alias("ids"), F.sum("n").alias("n"), F.coalesce(F.max(F.col("a_ids") + F.col("b_ids") + F.col("last")), F.lit(-1)).alias("last"))
    open_ = open_.filter("ids > last + 1").select("file", F.col("n").alias("ordinal"), (F.col("last") + 1).alias("start"), (F.col("ids") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(open_)


def count_tokens(docs: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens, file, ordinal, start for each row of docs: its token files are written, scanned, and matched to the rosters by place.

    A null text has 0 tokens; repeated rows are counted each; a null doc_id stays null; other columns are not looked at."""
    made = written(token_files(docs, path, END, block), work_folder(docs.sparkSession), "tokens", **{"parquet.block.size": HELD, "parquet.enable.dictionary": "false"})
    ordered = made.select("file", "block", F.size("roster").cast("long").alias("n"))
    before = ordered.withColumn("first", F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n"))
    listed = made.select("file", "block", F.posexplode("roster").alias("i", "doc_id")).join(before, ["file", "block"])
    listed = listed.select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    return listed.join(separator_scan(made), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")


def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), vocabulary())
