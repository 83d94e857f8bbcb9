"""Quality classifier: ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, flat_text, mixed, pieces, read, release, span_hashes, word_spans

#: log2 of the number of weights; most labelled documents that the fit reads (those with the least hash of doc_id).
BITS, SAMPLE = 18, 8192
#: A feature counts if it is in LEAST documents of the sample, and if its share of poor grades is SCREEN standard deviations off the sample's;
#: steps, step size and ridge of the fit.
LEAST, SCREEN, STEPS, RATE, RIDGE = 6, 6.0, 200, 0.1, 1e-4
#: A document is kept if the probability of this grade or a better one is at least CHANCE.
GRADE, CHANCE = 2, 0.5
#: A document's weight in the fit: its grade's number of documents to the power -BALANCE.
BALANCE = 0.25
#: Shares of a text's words at which a shape counts as frequent.
SHARES = (1 / 64, 1 / 16, 1 / 4, 1 / 2)
_KINDS = 8
#: Bytes of text that a worker looks at in one go, as its arrays hold some 40 times as much.
PIECE = 1 << 20


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct hashed features in the batch, sorted, and the texts' word counts.

    Features: each lower-cased word; the last two bytes of a word, when one is not a letter, with the share of words that end
    so; the shares of repeated words, of words in capitals and of words with letters only, as steps."""
    flat, off = flat_text(texts)
    starts, ends, counts = word_spans(flat, off)
    n = np.diff(counts)
    doc = np.repeat(np.arange(len(n)), n)
    hashes = span_hashes(flat, starts, ends)
    keys = [(doc.astype(np.uint64) << np.uint64(BITS)) | (hashes >> np.uint64(64 - BITS))]
    if len(starts):
        lower = (flat >= 97) & (flat <= 122) | (flat >= 128)
        upper = (flat >= 65) & (flat <= 90)
        last, second = flat[ends - 1], flat[np.maximum(ends - 2, starts)]
        plain = (lower | upper)[ends - 1]
        tail = np.where(plain, 0, last.astype(np.uint64) << np.uint64(8) | np.where((lower | upper)[np.maximum(ends - 2, starts)], 0, second).astype(np.uint64))
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
        capital = upper[starts] & upper[np.minimum(starts + 1, ends - 1)] & (ends - starts > 1)
        shapes = [tail, np.where(again, 1 << 20, 0).astype(np.uint64), np.where(capital, 1 << 21, 0).astype(np.uint64), np.where(ends - starts == 1, 1 << 22, 0).astype(np.uint64)]
        for shape in shapes:
            some = shape > 0
            pair, count = np.unique((doc[some].astype(np.uint64) << np.uint64(32)) | shape[some], return_counts=True)
            owner = (pair >> np.uint64(32)).astype(np.int64)
            for i, share in enumerate(SHARES):
                often = count >= share * n[owner]
                bucket = mixed((pair[often] & np.uint64(0xFFFFFFFF)) * np.uint64(_KINDS) + np.uint64(i + 1)) >> np.uint64(64 - BITS)
                keys.append((owner[often].astype(np.uint64) << np.uint64(BITS)) | bucket)
    key = np.unique(np.concatenate(keys))
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64), n


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def penalised_loss(params: np.ndarray, doc: np.ndarray, column: np.ndarray, grade: np.ndarray, each: np.ndarray, levels: int) -> tuple[float, np.ndarray]:
    """The weighted negative log-likelihood with its ridge, and its gradient. params: weights, the first threshold, and the logarithms of the gaps between thresholds, which keep them in order."""
    used = len(params) - levels + 1
    w, gaps = params[:used], np.exp(params[used + 1 :])
    theta = np.concatenate([[params[used]], params[used] + np.cumsum(gaps)])
    s = np.bincount(doc, weights=w[column], minlength=len(grade))
    edges = np.concatenate([[-np.inf], theta, [np.inf]])
    high, low = _sigmoid(edges[grade + 1] - s), _sigmoid(edges[grade] - s)
    p = np.maximum(high - low, 1e-9)
    d_high, d_low = high * (1 - high) / p * each, low * (1 - low) / p * each
    g_w = np.bincount(column, weights=(d_high - d_low)[doc], minlength=used) + RIDGE * w
    g_edge = np.zeros(levels + 1)
    np.add.at(g_edge, grade + 1, -d_high)
    np.add.at(g_edge, grade, d_low)
    g_theta = g_edge[1:-1]
    g = np.concatenate([g_w, [g_theta.sum()], np.cumsum(g_theta[::-1])[::-1][1:] * gaps])
    return float(-(each * np.log(p)).sum() + RIDGE / 2 * (w * w).sum()), g


@dataclass
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - weights . x): one weight for each feature, whatever the grade, and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def grades(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The expected grade, and the probability of GRADE or better."""
        above = 1 - _sigmoid(self.thresholds[None, :] - scores[:, None])  # P(grade > k)
        return above.sum(axis=1), above[:, GRADE - 1]

    @classmethod
    def fit(cls, doc: np.ndarray, bucket: np.ndarray, grade: np.ndarray, levels: int = 3) -> OrdinalModel:
        """Likelihood with a ridge, by full-batch steps of Adam; rare grades count more (BALANCE). Without rows every text gets the best grade."""
        weights, gaps = np.zeros(1 << BITS), np.ones(levels - 1)
        gaps[0] = -1.0
        if not len(grade):
            return cls(weights, np.linspace(-3, -2, levels - 1))
        used, column, spread = np.unique(bucket, return_inverse=True, return_counts=True)
        often = spread >= LEAST
        strong = np.zeros(len(used), bool)
        for k in range(1, levels):
            rate = (grade < k).mean()
            found = np.bincount(column, weights=(grade < k)[doc], minlength=len(used))
            strong |= np.abs(found - spread * rate) > SCREEN * np.sqrt(spread * rate * (1 - rate))
        often &= strong
        keep = often[column]
        doc, column, used = doc[keep], (np.cumsum(often) - 1)[column[keep]], used[often]
        share = np.bincount(grade, minlength=levels)
        each = (np.maximum(share, 1.0) ** -BALANCE)[grade]
        each /= each.sum()
        params, m, v = np.concatenate([np.zeros(len(used)), gaps]), 0, 0
        for t in range(1, STEPS + 1):
            _, g = penalised_loss(params, doc, column, grade, each, levels)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            params = params - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        weights[used] = params[: len(used)]
        first = params[len(used)]
        return cls(weights, np.concatenate([[first], first + np.cumsum(np.exp(params[len(used) + 1 :]))]))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade: 0 for poor quality, 1 for good but toxic, 2 for good. Rows with a null don't count; of repeated rows the worst does."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2).alias("grade"), "quality", "toxic").dropna()
    return rows.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> OrdinalModel:
    """Fitted on at most `sample` rated documents, those with the least hash of doc_id; rows that repeat an id train once, with the text of the least hash. Only the
    documents' bucket numbers come to the driver: the distinct ones of each text, so at most 2^BITS of 4 bytes for a text of any length."""
    chosen = ratings.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = bounded(docs).select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    rows = rows.join(F.broadcast(chosen), F.col("_id") == F.col("doc_id")).groupBy("_id").agg(F.min("grade").alias("grade"), F.min_by("_text", F.xxhash64("_text")).alias("_text"))

    def work(batches):
        for b in pieces(batches, "_text", PIECE):
            doc, bucket, n = features(b.column("_text"))
            lists = np.split(bucket.astype(np.int32), np.searchsorted(doc, np.arange(1, len(n))))
            yield pa.RecordBatch.from_pydict({"id": b.column("_id"), "grade": b.column("grade"), "buckets": pa.array(lists, pa.list_(pa.int32()))})

    got = rows.mapInArrow(work, "id long, grade int, buckets array<int>").toArrow().sort_by("id").combine_chunks()
    lists = got.column("buckets").chunk(0) if got.num_rows else pa.array([], pa.list_(pa.int32()))
    doc, bucket = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy().astype(np.int64)
    grade = got.column("grade").to_numpy().astype(np.int64)
    del got, lists
    model = OrdinalModel.fit(doc, bucket, grade)
    del doc, bucket
    release()
    return model


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """doc (the row of docs as a struct), grade (expected, 0 to 2), tail (probability of GRADE or better) and kept. A null text or one without words has 0, 0 and false; repeated rows are judged alike; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    @F.arrow_udf("grade double, tail double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, thresholds = shared.value
        now = OrdinalModel(weights, thresholds)
        for texts in batches:
            out = [np.empty((2, 0))]
            for b in pieces(iter([pa.RecordBatch.from_arrays([texts], ["t"])]), "t", PIECE):
                doc, bucket, n = features(b.column("t"))
                found = now.grades(np.bincount(doc, weights=weights[bucket], minlength=len(n)))
                out.append(np.where(n > 0, found, 0.0))
            grade, tail = np.concatenate(out, axis=1)
            yield pa.StructArray.from_arrays([pa.array(grade), pa.array(tail)], ["grade", "tail"])

    judged = bounded(docs).select(F.struct(*docs.columns).alias("doc"), judge(F.col(text_col).cast("string")).alias("x"))
    return judged.select("doc", "x.grade", "x.tail", (F.col("x.tail") >= CHANCE).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the model fitted on the labelled ones keeps, with all their columns as they are; see classify for odd rows."""
    good = score(docs, fit(docs, graded(labels))).filter("kept")
    return good.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, expected_grade, tail_probability, kept.

    Null and wordless texts are rejected; null ids are judged but never train; repeated rows are judged alike; without usable
    labels every text with a word is kept; an empty table gives no rows; other columns are not looked at."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = score(slim, fit(docs, graded(labels)))
    return out.select("doc.doc_id", F.col("grade").alias("expected_grade"), F.col("tail").alias("tail_probability"), "kept")


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
