"""Shared helpers: working folders, text columns, connected components and vectorised word hashes."""

from __future__ import annotations

import atexit
import ctypes
import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters between words: space and 0x09 to 0x0D.
SPACES = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Most bytes of text that the vectorised helpers look at in one go.
CHUNK = 1 << 20

_made: set[str] = set()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which the whole cluster shares; it goes when the driver ends.

    Where that setting is missing (tests), a folder of this machine is used, and only with a local master."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or ""
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = "file://" + tempfile.gettempdir()
    path = f"{top.rstrip('/')}/work-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clear, spark)
    _made.add(path)
    return path


def _clear(spark: SparkSession) -> None:
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except AttributeError:  # the session has been stopped already
        return
    for path in _made:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def written(df: DataFrame, folder: str, name: str, **options) -> DataFrame:
    """df, computed once and read back from the shared folder, so that a lost executor costs nothing done before; options go to the writer."""
    df.write.mode("overwrite").options(**options).parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


#: Most bytes of an Arrow batch between an executor and its workers. Spark's default is 64 MB, and a batch costs an executor several times its size outside the heap.
BATCH = 4 << 20


def bounded(df: DataFrame) -> DataFrame:
    """df; its session's Arrow batches hold at most about BATCH bytes from now on (a longer row comes alone), unless the session has a setting of its own."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in conf.getAll:
        conf.set(name, str(BATCH))
    return df


def let(value, body):
    """body(value) with value evaluated once for each row, whatever the optimizer makes of the projection."""
    return F.transform(F.array(value), body)[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 * CHUNK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about `most` bytes of text (a longer text comes alone); when they end, unused memory is released."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(text_sizes(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right"))
            to = max(to, at + 1)
            yield batch.slice(at, to - at)
            at = to
    release()


def release() -> None:
    """Gives unused memory of this worker process, which lives on for later stages, back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc, which has no such call
        pass


def text_sizes(column: pa.Array) -> np.ndarray:
    return np.diff(flat_text(column)[1])


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins (one more at the end). Null: empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.empty(0, np.uint8)
    return flat, off - off[0]


#: Odd numbers of the hashes of words and windows; any odd ones do.
_LANE, _FOLD = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03), 0x100000001B3
#: Spans of more bytes than this are hashed one by one with BLAKE2b; shorter ones eight bytes at a time, all together.
LONG = 64
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_is_space = np.zeros(256, bool)
_is_space[[ord(c) for c in SPACES]] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (a published finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_spans(flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words begin and end, and for each text the number of words before it (one more at the end)."""
    inside = ~_is_space[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < len(flat)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = off[1:][off[1:] > 0] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True, lanes: int = 1) -> np.ndarray:
    """Hashes of the bytes of each span, 64 bits a lane: one array, or a row for each of several independent lanes. Spans are in order. lower: A-Z count as a-z.

    A span's eight-byte words go through a chain of bijections, one after the other, from its length and the lane on; so spans of up to eight bytes and
    equal length never collide, and no structure of a text (as repeats have) makes longer ones do so."""
    out = np.empty((lanes, len(starts)), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + CHUNK, "right")))
        part = flat[low : ends[to - 1]]
        padded = np.zeros(len(part) + 8, np.uint8)
        padded[: len(part)] = _lower[part] if lower else part
        eights = np.ndarray(len(part) + 1, "<u8", padded, strides=(1,))
        b, size = starts[at:to] - low, ends[at:to] - starts[at:to]
        for lane in range(lanes):
            h = mixed(size.astype(np.uint64) * np.uint64(_FOLD) + np.uint64(_LANE[lane]))
            on, done = np.flatnonzero((size > 0) & (size <= LONG)), 0
            while len(on):
                left = size[on] - done
                h[on] = mixed(h[on] ^ (eights[b[on] + done] & _KEEP[np.minimum(left, 8)]))
                on, done = on[left > 8], done + 8
            out[lane, at:to] = h
        for k in np.flatnonzero(size > LONG).tolist():
            digest = hashlib.blake2b(padded[b[k] : b[k] + size[k]], digest_size=8 * lanes).digest()
            out[:, at + k] = np.frombuffer(digest, "<u8")
        at = to
    return out[0] if lanes == 1 else out


def folded(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each place on (too near the end: of what follows); twice as many words with each step."""
    with np.errstate(over="ignore"):
        h, done, power, have = None, 0, words, 1
        while True:
            if k & have:
                h, done = (power, have) if h is None else (mixed(h * np.uint64(_FOLD) + _ahead(power, done)), done + have)
            if have * 2 > k:
                return h
            power, have = mixed(power * np.uint64(_FOLD) + _ahead(power, have)), have * 2


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def windows(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k words in each text, in order, and the number before each text (one more at the end).

    A text of 1 to k-1 words has one window, all its words; a text without words has none."""
    n = np.diff(counts)
    many = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    before = np.concatenate([[0], np.cumsum(many)])
    at = np.repeat(counts[:-1] - before[:-1], many) + np.arange(before[-1])
    out = folded(words, k)[at] if len(words) else np.empty(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        h, left = mixed(n[short].astype(np.uint64)), n[short]
        with np.errstate(over="ignore"):
            for j in range(int(left.max())):
                on = left > j
                h[on] = mixed(h[on] * np.uint64(_FOLD) + words[counts[short[on]] + j])
        out[before[short]] = h
    return out, before


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where df has a column so called (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def components(links: DataFrame, folder: str, name: str, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of the links (a, b) can reach.

    Alternating large-star and small-star steps, each written to the shared folder; the links stay distributed, and
    a hub's row count never exceeds its number of neighbours."""
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = written(edges, folder, f"{name}-0")
    sums = None
    for i in range(1, rounds + 1):
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        edges = written(small, folder, f"{name}-{i}")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == sums:
            break
        sums = now
    else:
        raise RuntimeError("connected components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


#: Most rows of ids (8 bytes each) that are broadcast; with more, the same join shuffles.
FEW = 2_000_000


def only(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose column is among the distinct values of ids' only column; ids must be written already, so counting them is cheap."""
    (name,) = fresh(rows, "_wanted")
    wanted = ids.toDF(name).distinct()
    if ids.count() <= FEW:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, F.col(column) == F.col(name), "left_semi")


#: Places that a salted join deals the rows of a key to.
SALTS = 16


def salted(rows: DataFrame, few: DataFrame, key: str, by: str) -> DataFrame:
    """rows joined with few (a row for each key). The rows of a key are dealt to SALTS places by the hash of `by`, and few's row is repeated in each, so a hot key
    spans many tasks; both sides come right from a shuffle, so adaptive execution can cut them further."""
    (salt,) = fresh(rows, "_salt")
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    every = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(every.hint("merge"), [key, salt]).drop(salt)


def list_array(values: np.ndarray, before: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(values))
