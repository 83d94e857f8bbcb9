"""Near duplicates by circulant MinHash, banding and exact Jaccard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FEW, bounded, components, flat_text, fresh, list_array, mixed, only, pieces, read, salted, span_hashes, windows, word_spans, work_folder, written

#: Rows of a band and bands: a pair with Jaccard 0.8 shares no band with a probability of (1 - 0.8^6)^48 = 4.6e-7.
ROWS, BANDS = 6, 48
#: Buckets of more documents than this are linked through hubs; what hubs leave open is compared in blocks, whose chunks hold this much (shingles, and PER for each document).
CROWD, CHUNK, PER = 16, 200_000, 400
#: Bytes of text that a worker looks at in one go, as its arrays hold some 30 times as much.
PIECE = 1 << 20
#: Odd numbers of the bijection of 32-bit numbers that serves as the second permutation.
_FIRST, _SECOND = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sorted distinct shingle hashes of each text in two independent lanes of 64 bits; words are lower-cased in A-Z."""
    flat, off = flat_text(column)
    starts, ends, counts = word_spans(flat, off)
    lanes = [windows(h, counts, width) for h in span_hashes(flat, starts, ends, lanes=2)]
    before = lanes[0][1]
    for i in range(len(column)):
        yield tuple(np.unique(h[before[i] : before[i + 1]]) for h, _ in lanes)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set.

    The hash's upper half is the first permutation's place of a shingle on a circle of 2^32; coordinate k is the least value that
    the second permutation has on the places turned by k. Two permutations thus give any number of coordinates."""
    place = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty(coordinates, np.uint32)
    step = max(1, (1 << 16) // len(place))
    for k in range(0, coordinates, step):
        turns = np.arange(k, min(coordinates, k + step), dtype=np.uint32)
        x = np.add.outer(turns, place)
        x *= _FIRST
        x ^= x >> np.uint32(15)
        x *= _SECOND
        out[k : k + len(turns)] = x.min(axis=1)
    return out


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, h1 and h2 (which together name the set), bands."""

    def work(batches):
        numbers = np.arange(1, BANDS + 1, dtype=np.uint64)
        for b in pieces(batches, "_text", PIECE):
            size, one, two, bands = [], [], [], []
            for s, other in shingle_sets(b.column("_text"), width):
                size.append(max(len(s), len(other)))
                one.append(mixed(s).sum(dtype=np.uint64))
                two.append(mixed(other).sum(dtype=np.uint64))
                if len(s):
                    rows = signature(s, ROWS * BANDS).reshape(BANDS, ROWS).astype(np.uint64)
                    key = numbers
                    for r in range(ROWS):
                        key = mixed(key * np.uint64(0x100000001B3) + rows[:, r])
                    bands.append(key)
            before = np.cumsum([0] + [BANDS * (n > 0) for n in size])
            flat = np.concatenate(bands).view(np.int64) if bands else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column("_id"), pa.array(size, pa.int64()), pa.array(np.array(one, np.uint64).view(np.int64)), pa.array(np.array(two, np.uint64).view(np.int64)), list_array(flat, before),
            ], ["doc_id", "n", "h1", "h2", "bands"])

    return _slim(docs).mapInArrow(work, "doc_id long, n long, h1 long, h2 long, bands array<long>")


def _slim(docs: DataFrame) -> DataFrame:
    return bounded(docs).select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))


def sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """doc_id and its set in both lanes, for the documents among ids; computed again rather than kept, as a set is larger than its text."""

    def work(batches):
        for b in pieces(batches, "_text", PIECE):
            found = list(shingle_sets(b.column("_text"), width))
            columns = [list_array(np.concatenate(lane).view(np.int64), np.cumsum([0] + [len(s) for s in lane])) for lane in zip(*found)]
            yield pa.RecordBatch.from_arrays([b.column("_id"), *columns], ["doc_id", "set", "other"])

    return only(_slim(docs).filter("_id IS NOT NULL"), "_id", ids).mapInArrow(work, "doc_id long, set array<long>, other array<long>")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share: products of 0-1 matrices over slices of the elements that two sets have."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    some = times[column] > 1
    owner, column = owner[some], (np.cumsum(times > 1) - 1)[column[some]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[a:b], column[a:b] - low] = 1
        both += m @ m.T
    return both.astype(np.int64)


def block_links(sets: list[np.ndarray], others: list[np.ndarray], sides: np.ndarray, roots: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Indices (i, j) of exact links, counted in both lanes, that join documents of different roots: as few as join what all links would. sides: 0 or 1, and only 0-1 pairs count if there are both."""
    sizes = np.maximum([len(s) for s in sets], [len(s) for s in others])
    shared = np.minimum(shared_counts(sets), shared_counts(others))
    linked = np.triu(100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared), 1)
    if sides.any() and not sides.all():
        linked &= sides[:, None] != sides[None, :]
    _, label = np.unique(roots, return_inverse=True)
    linked &= label[:, None] != label[None, :]
    out, top = [], list(range(len(label)))

    def find(x):
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
        one, two = find(label[i]), find(label[j])
        if one != two:
            top[one] = two
            out.append((i, j))
    return out


def linked_pairs(docs: DataFrame, pairs: DataFrame, width: int, percent: int, folder: str, name: str) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are alike, in both lanes. The joins merge, so that adaptive execution cuts the rows of a hot hub `a`."""
    pairs = written(pairs.distinct(), folder, f"{name}-pairs")
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), folder, f"{name}-ids")
    sets = written(sets_of(docs, ids, width), folder, f"{name}-sets")
    one, two = (sets.select(F.col("doc_id").alias(c), F.col("set").alias(f"s{c}"), F.col("other").alias(f"o{c}")) for c in "ba")
    tested = pairs.join(one.hint("merge"), "b").join(two.hint("merge"), "a")
    shared = F.least(F.size(F.array_intersect("sa", "sb")), F.size(F.array_intersect("oa", "ob")))
    either = F.greatest(F.size("sa"), F.size("oa")) + F.greatest(F.size("sb"), F.size("ob")) - shared
    return written(tested.filter(100 * shared >= percent * either).select("a", "b"), folder, f"{name}-links")


def crowd_links(docs: DataFrame, crowd: DataFrame, links: DataFrame, width: int, percent: int, folder: str) -> DataFrame:
    """links, and links among the members (key, doc_id, n, hub) of crowded buckets, so that all exact links inside a bucket lie within one component.

    First each document is checked with the least of its buckets' hubs, then with the hubs of another component: a few pairs for each document. A bucket whose members are
    in one component is done. The others are open: those with the same largest component make a unit, in which the documents outside that component are compared with all, in blocks of
    two chunks of bounded size; a document counts once for a unit, in however many of its buckets it is. That is exact, and quadratic only in the chunks of the documents that no hub is like."""
    nearest = crowd.filter("hub < doc_id").groupBy("doc_id").agg(F.min("hub").alias("a")).select("a", F.col("doc_id").alias("b"))
    links = links.unionByName(linked_pairs(docs, nearest, width, percent, folder, "nearest"))

    def rooted(step):
        roots = written(components(links, folder, f"roots-{step}"), folder, f"roots-{step}")
        known = crowd.join(roots.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
        return written(known, folder, f"members-{step}")

    members = rooted("nearest")
    hubs = members.filter("doc_id = hub").groupBy("key").agg(F.min("root").alias("hub_root"))
    apart = salted(members, hubs, "key", "doc_id").filter("root <> hub_root").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    links = links.unionByName(linked_pairs(docs, apart, width, percent, folder, "hubs"))
    members = rooted("hubs")
    shares = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
    state = shares.groupBy("key").agg(F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("m", "root")).alias("unit")).filter("roots > 1").select("key", "unit")
    unit = written(salted(members, state, "key", "doc_id").select("unit", "doc_id", "n", "root").distinct(), folder, "units")
    weight = F.col("n") + PER
    chunks = lambda w: F.ceil(F.sum(w) / CHUNK).cast("int")
    sizes = unit.groupBy("unit").agg(chunks(weight).alias("all"), chunks(F.when(F.col("root") != F.col("unit"), weight)).alias("few"))
    dealt = sets_of(docs, unit.select("doc_id"), width).join(salted(unit, sizes, "unit", "doc_id").hint("merge"), "doc_id")
    own = lambda c: F.pmod(F.xxhash64("doc_id"), F.col(c)).cast("int")
    asks = F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda j: F.struct(F.lit(0).alias("side"), own("few").alias("i"), j.alias("j")))
    answers = F.transform(F.sequence(F.lit(0), F.col("few") - 1), lambda i: F.struct(F.lit(1).alias("side"), i.alias("i"), own("all").alias("j")))
    block = F.explode(F.when(F.col("root") != F.col("unit"), F.concat(asks, answers)).otherwise(answers)).alias("block")
    dealt = dealt.select("unit", "doc_id", "root", "set", "other", block).select("unit", "doc_id", "root", "set", "other", "block.*")

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        lanes = []
        for name in ("set", "other"):
            column = table.column(name).combine_chunks()
            flat, off = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
            lanes.append([flat[off[i] : off[i + 1]] for i in range(len(ids))])
        forest = block_links(*lanes, table.column("side").to_numpy(), table.column("root").to_numpy(), percent)
        return pa.table({"a": pa.array([ids[i] for i, _ in forest], pa.int64()), "b": pa.array([ids[j] for _, j in forest], pa.int64())})

    return links.unionByName(dealt.groupBy("unit", "i", "j").applyInArrow(compare, "a long, b long"))


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * shared shingles >= percent * shingles of either; a component is what links reach, named by its
    least doc_id, which alone is kept. A text of fewer than `width` words has all of them as its one shingle. Null and wordless texts have no shingles
    and no links. A null doc_id has no component (null) and is kept; rows that repeat a doc_id are one document with all their links; an
    empty table gives no rows; other columns are not looked at.

    Equal sets (128 bits of hash) form classes, of which only the least document goes on. Bands of the circulant MinHash propose pairs: in buckets of up to CROWD documents each
    pair is checked on the full sets, in two independent lanes of 64 bits a shingle; crowded buckets are linked through hubs, see crowd_links, so a group of m copies is checked in some m pairs and never in m * m."""
    folder = work_folder(docs.sparkSession)
    sig = written(signatures(docs, width), folder, "signatures")
    live = sig.filter("n > 0 AND doc_id IS NOT NULL")
    name = ["n", "h1", "h2"]
    classes = written(live.groupBy(*name).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members")), folder, "classes")
    copies = live.join(classes.filter("members > 1").hint("merge"), name).filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    one = live.join(classes.select(F.col("rep").alias("doc_id"), *name), ["doc_id", *name])
    entries = one.select("doc_id", "n", F.explode("bands").alias("key"))
    full = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("hub")).filter("members > 1")
    met = written(salted(entries, full, "key", "doc_id"), folder, "buckets")

    few = met.filter(F.col("members") <= CROWD)
    a, b = (few.select("key", F.col("doc_id").alias(c), F.col("n").alias(f"n{c}")) for c in "ab")
    alike = (F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    links = linked_pairs(docs, a.join(b, "key").filter(alike).select("a", "b"), width, percent, folder, "few")
    crowd = met.filter(F.col("members") > CROWD).select("key", "doc_id", "n", "hub")
    if not crowd.isEmpty():
        links = crowd_links(docs, crowd, links, width, percent, folder)
    found = written(copies.unionByName(links), folder, "links")
    roots = components(found, folder, "components")
    out = sig.select("doc_id", F.col("n").alias("n_shingles")).join(roots, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"), F.coalesce(F.coalesce("root", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs without the rows of documents that are not their component's least; of rows with the same doc_id (or none) and text one stays.

    Rows that share a doc_id and have other texts all stay or go. Null and wordless texts have no near duplicates and stay, once for each doc_id; an empty
    table gives none; any other columns pass through as they are."""
    folder = work_folder(docs.sparkSession)
    key, hashed = fresh(docs, "id_", "row_")
    gone = written(near_groups(docs, width, percent).filter("NOT kept").select(F.col("doc_id").alias(key)).distinct(), folder, "gone")
    few = F.broadcast(gone) if gone.count() <= FEW else gone
    left = docs.join(few, F.col("doc_id").cast("long") == F.col(key), "left_anti")
    row = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull(), F.coalesce(F.col("text").cast("string"), F.lit("")))
    again = written(left.groupBy(row.alias(key)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), folder, "again")
    n = again.count()
    if not n:
        return left
    again = F.broadcast(again) if n <= FEW else again
    once = left.withColumn(hashed, row).join(again, F.col(hashed) == F.col(key), "left_semi").dropDuplicates([hashed]).select(*docs.columns)
    return left.join(again, row == F.col(key), "left_anti").unionByName(once)


def op6_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "documents"), width=2)


_W = r"[^\x20\x09-\x0D]+"
ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.root)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1) c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
