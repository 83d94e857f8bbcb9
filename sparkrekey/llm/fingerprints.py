"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CHUNK, flat_text, mixed, pieces, read, span_hashes, windows, word_spans

#: Numbers of the identity part (modulo 2^64 each, all drawn from the paragraph's bytes) and of the likeness part (modulo 2^32 each, more than a text has windows).
IDENTITY, LIKENESS = 8, 256
#: Words in the windows whose signed votes make a paragraph's likeness vector.
WINDOW = 3
#: A byte's bits, from the lowest, as the bytes of a number.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
_VOTES = np.arange(1, LIKENESS // 64 + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)


def paragraph_spans(flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the \\n-split paragraphs, empty ones included, of each text that has a byte; the texts' first paragraphs."""
    breaks = np.flatnonzero(flat == 10)
    full = off[1:] > off[:-1]
    starts = np.sort(np.concatenate([off[:-1][full], breaks + 1]))
    # a \n that ends a text begins an empty paragraph there, as the next text's start also is in the list
    ends = np.sort(np.concatenate([off[1:][full], breaks]))
    before = np.concatenate([[0], np.cumsum(full + np.diff(np.searchsorted(breaks, off)))])
    return starts, ends, before


def _sums(rows: np.ndarray, before: np.ndarray, width: int, add) -> np.ndarray:
    """For each text, the sum of its rows' vectors, in slices of bounded size; add(rows, edges) gives the sums between the edges."""
    out = np.zeros((len(before) - 1, width), np.uint64)
    step = max(1, CHUNK // width)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(rows):
            to = min(len(rows), at + step)
            first, last = np.searchsorted(before, at, "right") - 1, np.searchsorted(before, to, "left")
            edges = np.maximum(before[first:last], at) - at
            some = np.flatnonzero(np.diff(np.append(edges, to - at)) > 0)
            out[first + some] += add(rows[at:to], edges[some])
            at = to
    return out


def identity_of(paragraph: bytes) -> bytes:
    """IDENTITY numbers as bytes: a wide hash of the paragraph itself, so that no two paragraphs share them, however they are made."""
    return hashlib.blake2b(paragraph, digest_size=8 * IDENTITY).digest()


def _identity_sums(flat: np.ndarray):
    content = memoryview(np.ascontiguousarray(flat))

    def add(spans: np.ndarray, edges: np.ndarray) -> np.ndarray:
        wide = b"".join([identity_of(content[a:b]) for a, b in spans.tolist()])
        return np.add.reduceat(np.frombuffer(wide, "<u8").reshape(-1, IDENTITY), edges, axis=0)

    return add


def _likeness_sums(h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of +1 and -1 by the hashes' bits: eight bits are counted as the bytes of one number, in runs of 255 rows at most."""
    bits = mixed(h[:, None] ^ _VOTES[None, :])
    runs = np.union1d(edges, np.arange(0, len(h), 255))
    ones = np.add.reduceat(_SPREAD[bits.view(np.uint8)], runs, axis=0).view(np.uint8)
    ones = np.add.reduceat(ones.astype(np.uint64), np.searchsorted(runs, edges), axis=0)
    return ones * np.uint64(2) - np.diff(np.append(edges, len(h))).astype(np.uint64)[:, None]


def vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The two parts of each text's fingerprint. Null: empty, all zeros.

    A paragraph's vector has IDENTITY numbers hashed from its bytes (a hash of 512 bits) and LIKENESS numbers that add +1 or -1 for each of its word
    windows; a text's is the sum over its paragraphs, modulo 2^64 and 2^32. So the order of paragraphs doesn't count, and a
    paragraph is put in or taken out by adding or subtracting its vector (see insert)."""
    flat, off = flat_text(texts)
    starts, ends, before = paragraph_spans(flat, off)
    # paragraphs as texts of their own give the windows, which thus never cross a paragraph's end
    edges = np.append(starts, len(flat))
    w_starts, w_ends, counts = word_spans(flat, edges)
    wins, of_paragraph = windows(span_hashes(flat, w_starts, w_ends, lower=False), counts, WINDOW)
    return _sums(np.column_stack([starts, np.maximum(ends, starts)]), before, IDENTITY, _identity_sums(flat)), _sums(wins, of_paragraph[before], LIKENESS, _likeness_sums).astype(np.uint32)


def insert(fingerprint: str, paragraph: str, times: int = 1) -> str:
    """The fingerprint with the paragraph `times` more (negative: fewer) in the multiset."""
    a, b = parse(fingerprint)
    # a text with this one paragraph; the empty paragraph is what "\n" has twice
    if paragraph:
        x, y = vectors(pa.array([paragraph]))
    else:
        x, y = vectors(pa.array(["\n"]))
        x = np.frombuffer(identity_of(b""), "<u8").reshape(1, -1)
    with np.errstate(over="ignore"):
        return text_of(a + x[0] * np.uint64(times % (1 << 64)), b + y[0] * np.uint32(times % (1 << 32)))


def text_of(identity: np.ndarray, likeness: np.ndarray) -> str:
    return identity.astype("<u8").tobytes().hex() + likeness.astype("<u4").tobytes().hex()


def parse(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw[: 8 * IDENTITY], "<u8"), np.frombuffer(raw[8 * IDENTITY :], "<u4")


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 for each row of two pairs of vectors: 1 if equal, else the cosine of the likeness parts, 0 if that is negative."""
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    x, y = (v[1].view(np.int32).astype(np.float64) for v in (a, b))
    size = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.divide((x * y).sum(axis=1), size, out=np.zeros(len(x)), where=size > 0)
    return np.where(same, 1.0, np.clip(cosine, 0.0, 1.0))


#: Characters of text that a range of doc_id holds, about, and most ranges: their first keys, some 20 bytes each, are broadcast. Beyond RANGE * RANGES characters
#: (0.5 TB) ranges grow, which costs no memory: they are sorted with spilling and read batch by batch.
RANGE, RANGES = 8 << 20, 1 << 16


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The rows are dealt by ranges of (doc_id, hash of the text), nulls first, and sorted, so each task finds next texts in the next rows; the
    first row of each range (of the table, for the last) also goes to the range before it. Ids and hashes alone give the
    ranges' first keys, RANGES at most, which are broadcast; the texts move once. A null text is empty, with a fingerprint of
    zeros; the next of a single row is itself; repeated rows follow each other; an empty table gives no rows; other columns are not looked at."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
    order = [F.col("_id").asc_nulls_first(), F.col("_hash").asc()]
    total = docs.select(F.sum(F.length(text))).first()[0] or 0
    dealt = rows.select("_id", "_hash").repartitionByRange(min(total // RANGE + 1, RANGES), *order)
    found = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(F.col("_id").isNotNull().alias("some"), "_id", "_hash")).alias("k")).collect()
    firsts = sorted((r["k"]["some"], r["k"]["_id"] or 0, r["k"]["_hash"]) for r in found)
    bounds = spark.sparkContext.broadcast(firsts)

    @F.pandas_udf("array<int>")
    def ranges(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        """The row's range, and the range before it if the row is the first of its own."""
        out = []
        for some, i, h in zip(ids.notna(), ids.fillna(0), hashes):
            key = (bool(some), int(i), int(h))
            at = bisect.bisect_right(bounds.value, key) - 1
            out.append([at, (at - 1) % len(bounds.value)] if bounds.value[at] == key else [at])
        return pd.Series(out)

    # ids as decimals: a column of longs with nulls would come as floats
    told = rows.withColumn("_r", ranges(F.col("_id").cast("decimal(20,0)"), F.col("_hash")))
    wide = told.select("_id", "_text", "_hash", F.posexplode("_r").alias("_extra", "_range"))
    parts = wide.repartition(max(1, len(firsts)), "_range").sortWithinPartitions("_range", "_extra", *order)
    return parts.select("_id", "_text", "_range", "_extra").mapInArrow(_digest, SCHEMA)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kept = None
    for batch in pieces(batches, "_text"):
        rows = pa.Table.from_batches([batch] if kept is None else [kept, batch.cast(kept.schema)]).combine_chunks()
        kept = rows.slice(rows.num_rows - 1).combine_chunks().to_batches()[0]
        texts = rows.column("_text").to_pylist()
        extra = rows.column("_extra").to_pylist()
        # the last row waits for the next batch; a repeat of a range's first row may stand in several times, and only one is needed
        at = np.array([i for i in range(rows.num_rows - 1) if not extra[i]], np.int64)
        if not len(at):
            continue
        own, following = [texts[i] for i in at], [texts[i + 1] for i in at]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(own, following)]
        every = vectors(pa.array(texts, pa.large_string()))
        a, c = tuple(v[at] for v in every), tuple(v[at + 1] for v in every)
        b = vectors(pa.array(edited, pa.large_string()))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("_id").take(pa.array(at)).combine_chunks(), pa.array([len(t) for t in own], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array([text_of(x, y) for x, y in zip(*a)]), pa.array([text_of(x, y) for x, y in zip(*b)]), pa.array(likeness(a, b)), pa.array(likeness(a, c)),
            ], names)


def op5_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))
