"""Harmonic packing of token sequences."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bounded, pieces, read
from .tokens import encoder, vocabulary

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class HarmonicPacker:
    """Packs (key, ids) of one worker into sequences of `capacity` ids; each worker does so on its own.

    A document's ids are cut into whole sequences and a tail. A tail of length in (capacity/(k+1), capacity/k] belongs to class
    k, whose bins take exactly k tails; the places that a full bin has left are filled with ids cut from the filler, which is
    the next whole sequence (or tail, while there is none) that comes. What remains at the end is laid out in one stream, cut at
    the capacity, and its last rest at powers of two; so nothing is padded. Open bins hold less than capacity ids for each of
    capacity classes; `capacity` must be a power of two for the last cuts to end within it."""

    def __init__(self, capacity: int):
        self.size = 4 * capacity
        self.open: dict[int, list] = defaultdict(list)
        self.filler: list = []  # fewer than two sequences' ids, in pieces (key, start, ids)

    def add(self, key, ids: bytes) -> Iterator[list]:
        """Sequences, as lists of (key, start, ids), that this document closes."""
        for at in range(0, len(ids), self.size):
            piece = (key, at // 4, ids[at : at + self.size])
            if len(piece[2]) < self.size:
                yield from self._tail(piece)
            elif self.filler:
                yield [piece]
            else:
                self.filler.append(piece)

    def _tail(self, piece) -> Iterator[list]:
        k = self.size // len(piece[2])
        bin_ = self.open[k]
        if len(bin_) < k - 1:
            bin_.append(piece)
            return
        gap = self.size - sum(len(x[2]) for x in bin_) - len(piece[2])
        if gap > sum(len(x[2]) for x in self.filler):
            self.filler.append(piece)  # the bin waits for the class's next tail
        else:
            self.open[k] = []
            yield [*bin_, piece, *self._cut(self.filler, gap)]

    @staticmethod
    def _cut(stream: list, size: int) -> list:
        """The stream's first `size` bytes, which leave it."""
        out = []
        while size:
            key, start, ids = stream[0]
            out.append((key, start, ids[:size]))
            if len(ids) > size:
                stream[0] = (key, start + size // 4, ids[size:])
            else:
                stream.pop(0)
            size -= len(out[-1][2])
        return out

    def end(self) -> Iterator[list]:
        rest = [x for k in sorted(self.open) for x in self.open[k]] + self.filler
        left = sum(len(x[2]) for x in rest)
        while left:
            size = min(self.size, 4 << ((left // 4).bit_length() - 1))
            yield self._cut(rest, size)
            left -= size


def pack(docs: DataFrame, path: str, capacity: int = 1024, separator: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    A document is the ids of its text (null: none) and the separator; special tokens' strings in the text become their ids.
    Workers pack their partitions independently, so nothing is shuffled; a sequence is padded by nobody, see HarmonicPacker.
    sequence_id is the worker's number times 2^33 plus a running number. Repeated rows are packed each, a null id stays null,
    and an empty table gives no rows. Other columns are not looked at."""

    def work(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        ids_of, packer, number = encoder(path).ids, HarmonicPacker(capacity), 0
        end = separator.to_bytes(4, "little")
        rows: list[tuple] = []

        def place(sequences):
            nonlocal number
            for sequence in sequences:
                at = 0
                for (key, total), start, ids in sequence:
                    rows.append((key, start, len(ids) // 4, zlib.crc32(ids), total, base + number, at, *([ids] if with_ids else [])))
                    at += len(ids) // 4
                number += 1

        names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids
        types = [pa.int64()] * 7 + [pa.binary()] * with_ids

        def out():
            columns = list(zip(*rows)) or [[]] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in pieces(batches, "_text"):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ids_of(text or "") + end
                place(packer.add((key, len(ids) // 4), ids))
                if len(rows) >= 4096:
                    yield out()
        place(packer.end())
        yield out()

    slim = bounded(docs).select(docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("_text"))
    return slim.mapInArrow(work, SCHEMA + ", ids binary" * with_ids)


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), vocabulary())
