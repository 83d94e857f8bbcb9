"""Fuzzy repeated passages: shared seeds, collinear chains, alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat_text, folded, list_array, mixed, only, pieces, read, release, span_hashes, word_spans, work_folder, written

#: Words of a seed. A seed counts if the least hash of its words is its first's or its last's (a closed syncmer): that depends on its words alone, so documents that share it
#: agree, some 2 / SEED of all count, and among any SEED - 1 that follow each other one does; so equal runs of 2 * SEED - 2 = 14 words share a seed.
SEED = 8
#: A seed at which a whole passage of words that repeat with one of these periods begins has a hash of its own, lest it meets a shorter run only.
PERIODS = (1, 2, 3)
#: Words of the shortest passage reported, and of the shortest part of one.
PASSAGE, PART = 50, 20
#: What a word skipped on either side costs a chain, which gains WORTH for each seed.
GAP_COST, WORTH = 0.05, 6.0
#: Words beyond a chain's ends that the alignment sees at first; one that goes on to this edge is repeated with the next number, at last with the whole texts. Passages of a text that are JOIN words apart are one.
MARGINS, JOIN = (32, 512, None), 5
#: Least share of equal words in an aligned part, and words that are compared in one go as it grows.
ALIKE, STRIDE = 0.8, 32
#: Words that growth may skip on either side at a time, and equal words that must follow.
HOP, AGAIN = 6, 5


def sampled_seeds(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, place) of the seeds that count in each text, at each of their places; texts too short for a passage have none."""
    n = np.diff(counts)
    many = np.where(n >= PASSAGE, n - SEED + 1, 0)
    owner = np.repeat(np.arange(len(n)), many)
    at = np.repeat(counts[:-1] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    if not len(at):
        return owner, np.empty(0, np.uint64), at
    least = np.lib.stride_tricks.sliding_window_view(words, SEED).min(axis=1)[at]
    some = (words[at] == least) | (words[at + SEED - 1] == least)
    owner, at = owner[some], at[some]
    found = folded(words, SEED)[at]
    for period in PERIODS:
        # how many words from a place on repeat with the period, which no seed alone can tell
        here = np.arange(len(words) - period)
        stop = np.where((words[:-period] == words[period:]) & (np.searchsorted(counts, here, "right") == np.searchsorted(counts, here + period, "right")), len(words), here)
        stop = np.append(np.minimum.accumulate(stop[::-1])[::-1], np.arange(len(words) - period, len(words)))
        long = np.minimum(stop, len(words) - period)[at] + period - at >= PASSAGE
        found[long] ^= mixed(np.uint64(period))
    return owner, found, at - counts[owner]


def word_lists(column: pa.Array) -> Iterator[np.ndarray]:
    flat, off = flat_text(column)
    starts, ends, counts = word_spans(flat, off)
    hashes = span_hashes(flat, starts, ends)
    for i in range(len(column)):
        yield hashes[counts[i] : counts[i + 1]]


def _slim(docs: DataFrame) -> DataFrame:
    """_id, _version, _text of the rows with an id. Rows of one id with other texts are documents of their own, told apart by a hash of the text; where no id repeats, that is 0."""
    slim = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text")).filter("_id IS NOT NULL")
    once = slim.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    return slim.select("_id", F.lit(0).cast("long").alias("_version") if once else F.xxhash64("_text").alias("_version"), "_text")


def seeds(slim: DataFrame) -> DataFrame:
    """seed, doc_id, version, place."""

    def work(batches):
        for b in pieces(batches, "_text"):
            flat, off = flat_text(b.column("_text"))
            starts, ends, counts = word_spans(flat, off)
            owner, found, place = sampled_seeds(span_hashes(flat, starts, ends), counts)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), b.column("_id").take(at), b.column("_version").take(at), pa.array(place, pa.int32())], ["seed", "doc_id", "version", "place"])

    return slim.mapInArrow(work, "seed long, doc_id long, version long, place int")


def chains(p: np.ndarray, q: np.ndarray) -> list[list[int]]:
    """Chains of matches (p[i], q[i]), both rising, best first; each match is in one chain at most.

    score(i) = WORTH + max(0, max over j before i in both of score(j) - GAP_COST * (distance in p + distance in q)). The cost splits into a
    part of i and one of j, so a Fenwick tree over q's ranks that keeps maxima finds the best j in logarithmic time."""
    n = len(p)
    order = np.lexsort((-q, p))
    rank = np.unique(q, return_inverse=True)[1] + 1
    size = int(rank.max()) + 1
    best, who = [-np.inf] * size, [-1] * size
    score, back = np.zeros(n), np.full(n, -1)
    ps, qs, ranks = p.tolist(), q.tolist(), rank.tolist()
    for i in order.tolist():
        here = GAP_COST * (ps[i] + qs[i])
        top, prior, k = -np.inf, -1, ranks[i] - 1
        while k > 0:
            if best[k] > top:
                top, prior = best[k], who[k]
            k -= k & -k
        s = WORTH
        if top - here > 0:
            s += top - here
            back[i] = prior
        score[i] = s
        value, k = s + here, ranks[i]
        while k < size:
            if value > best[k]:
                best[k], who[k] = value, i
            k += k & -k
    out, used = [], np.zeros(n, bool)
    for i in np.argsort(-score, kind="stable").tolist():
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = int(back[i])
        if chain:
            out.append(chain[::-1])
    return out


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches a few rows at a time, as each row has lists."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    release()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a document's matches, its chains with each partner, best first: doc_id, version, partner, partner_version, p, q (the chains' matches, one after the other), sizes (matches in each)."""
    for b in _sliced(batches):
        rows = []
        for doc, version, found in zip(b.column("doc_id").to_pylist(), b.column("version").to_pylist(), b.column("found")):
            flat = found.values
            partner, other, q, p = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4))
            order = np.lexsort((p, q, other, partner))
            key = np.column_stack([partner, other, q, p])[order]
            order = order[np.append(True, (key[1:] != key[:-1]).any(axis=1))]  # rows that repeat a document bring each match again
            turns = np.flatnonzero((np.diff(partner[order]) != 0) | (np.diff(other[order]) != 0)) + 1
            for part in np.split(order, turns):
                every = chains(p[part], q[part])
                at = part[np.concatenate(every)]
                rows.append((doc, version, int(partner[at[0]]), int(other[at[0]]), p[at], q[at], [len(c) for c in every]))
        types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["doc_id", "version", "partner", "partner_version", "p", "q", "sizes"])


def equal_in_gap(x: np.ndarray, y: np.ndarray) -> int:
    """Most words of x and y that can be matched in order (the longest common subsequence), a bit for each word of y."""
    if not len(x) or not len(y):
        return 0
    at: dict[int, int] = {}
    for k, w in enumerate(y.tolist()):
        at[w] = at.get(w, 0) | 1 << k
    full = (1 << len(y)) - 1
    row = full
    for w in x.tolist():
        if hit := at.get(w):
            both = row & hit
            row = (row + both | row - both) & full
    return len(y) - row.bit_count()


def _run(x: np.ndarray, y: np.ndarray) -> int:
    """How far equal words go on, single unequal ones included while two thirds of the last six are equal."""
    n = min(len(x), len(y))
    end = at = 0
    while at < n:
        low, high = max(0, at - 5), min(n, at + STRIDE)
        same = (x[low:high] == y[low:high]).tolist()
        for k in range(at - low, len(same)):
            if same[k]:
                end = low + k + 1
            elif sum(same[max(0, k - 5) : k + 1]) < 4:
                return end
        at = high
    return end


def _hop(x: list[int], y: list[int]) -> tuple[int, int] | None:
    """The fewest words to skip on either side, up to HOP each, before AGAIN equal words."""
    for s in range(1, 2 * HOP + 1):
        for i in range(max(0, s - HOP), min(HOP, s) + 1):
            if x[i : i + 1] == y[s - i : s - i + 1] and len(part := x[i : i + AGAIN]) == AGAIN and part == y[s - i : s - i + AGAIN]:
                return i, s - i
    return None


def _grow(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Steps (words of x, words of y, equal words) along equal words from the texts' starts, with short skips; the last step is an equal word."""
    a = b = 0
    out = [np.empty((0, 3), np.int64)]
    while True:
        n = _run(x[a:], y[b:])
        out.append(_diagonal(x[a : a + n], y[b : b + n]))
        a, b = a + n, b + n
        hop = _hop(x[a : a + HOP + AGAIN].tolist(), y[b : b + HOP + AGAIN].tolist())
        if hop is None:
            return np.concatenate(out)
        out.append(np.array([[*hop, 0]]))
        a, b = a + hop[0], b + hop[1]


def _gap(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Steps (words of x, words of y, equal words) over what lies between two matches: equal words at both ends one by one, the rest as one step."""
    n = min(len(x), len(y))
    same = x[:n] == y[:n]
    head = n if same.all() else int(same.argmin())
    same = x[len(x) - n + head :][::-1] == y[len(y) - n + head :][::-1]
    tail = n - head if same.all() else int(same.argmin())
    u, v = x[head : len(x) - tail], y[head : len(y) - tail]
    return [np.ones((head, 3), np.int64), np.array([[len(u), len(v), equal_in_gap(u, v)]]), np.ones((tail, 3), np.int64)]


def _diagonal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones((len(x), 2), np.int64), x == y])


def alike_parts(steps: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of the steps (words of x, words of y, equal words) with at least ALIKE of the words of either side equal: all of them if they are, or else the longest, then the longest left and right of it, and so on."""
    at = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(steps, axis=0)])
    if at[-1, 2] >= ALIKE * at[-1, :2].max() - 1e-9:
        return [(0, len(steps))] if at[-1, 0] >= PART else []
    over = at[:, 2:] - ALIKE * at[:, :2]
    full = (steps[:, 0] == steps[:, 2]) & (steps[:, 1] == steps[:, 2])
    # parts begin where equal words begin and end where they end
    begins, ends = np.flatnonzero(full & ~np.append(False, full[:-1])), np.flatnonzero(full & ~np.append(full[1:], False)) + 1
    out, todo = [], [(0, len(steps))]
    while todo:
        low, high = todo.pop()
        i, j = begins[(begins >= low) & (begins < high)], ends[(ends > low) & (ends <= high)]
        if not len(i) or at[j[-1], 0] - at[i[0], 0] < PART:
            continue
        low, high = (low, high) if (low, high) == (0, len(steps)) else (int(i[0]), int(j[-1]))
        if (over[high] >= over[low] - 1e-9).all():
            out.append((low, high))
            continue
        # a step after which no sum comes up to the least before it is in no part
        most, least = np.maximum.accumulate(over[j][::-1])[::-1], np.minimum.accumulate(over[i])
        dead = np.flatnonzero((most[1:] < least[:-1] - 1e-9).any(axis=1))
        if len(dead):
            todo += list(zip([low, *i[dead + 1].tolist()], [*j[dead].tolist(), high]))
            continue
        best = (0, 0, 0)
        for k in range(len(i)):
            last = j[k + int(np.flatnonzero((over[j[k:]] >= over[i[k]] - 1e-9).all(axis=1))[-1])]
            best = max(best, (int(at[last, 0] - at[i[k], 0]), int(i[k]), int(last)))
        out.append(best[1:])
        todo += [(low, best[1]), (best[2], high)]
    return sorted(out)


def _lists(column: pa.ListArray):
    """A function that returns the k-th list as an array."""
    values, off = column.values.to_numpy(), column.offsets.to_numpy()
    return lambda k: values[off[k] : off[k + 1]]


def align(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(x begin, x end, y begin, y end, equal words) of the alike parts around a chain of matches x[p:p+SEED] = y[q:q+SEED].

    The chain is cut at stretches that bring the equal share below ALIKE; the pieces grow into the cuts as far as they stay alike."""
    left = _grow(x[: p[0]][::-1], y[: q[0]][::-1])[::-1]
    x0, y0, _ = (np.array([p[0], q[0], 0]) - left.sum(axis=0)).tolist()
    steps, a, b = [left], p[0], q[0]
    for run in np.split(np.arange(len(p)), np.flatnonzero(np.diff(p - q)) + 1):
        s, t = p[run[0]], q[run[0]]
        if s < a or t < b:  # it overlaps what is aligned already
            skip = max(a - s, b - t)
            s, t = s + skip, t + skip
        e = max(s, p[run[-1]] + SEED)
        f = t + (e - s)
        steps += [*_gap(x[a:s], y[b:t]), _diagonal(x[s:e], y[t:f])]
        a, b = e, f
    steps = np.concatenate([*steps, _grow(x[a:], y[b:])])
    steps = steps[steps[:, :2].any(axis=1)]
    if int(steps[:, 0].sum()) < PART:
        return []
    at = np.concatenate([[[x0, y0, 0]], np.cumsum(steps, axis=0) + [x0, y0, 0]])
    out, (c, d) = [], (0, 0)
    found = alike_parts(steps)
    if found == [(0, len(steps))]:
        return [(int(x0), int(at[-1, 0]), int(y0), int(at[-1, 1]), int(at[-1, 2]))]
    for k, (i, j) in enumerate(found):
        (a, b, _), (e, f, _) = at[i], at[j]
        u, v = at[found[k + 1][0], :2] if k + 1 < len(found) else (len(x), len(y))
        same = at[j, 2] - at[i, 2]
        more = _grow(x[c:a][::-1], y[d:b][::-1]).sum(axis=0) if i else (0, 0, 0)
        if same + more[2] >= ALIKE * max(e - a + more[0], f - b + more[1]):
            a, b, same = a - more[0], b - more[1], same + more[2]
        more = _grow(x[e:u], y[f:v]).sum(axis=0) if j < len(steps) else (0, 0, 0)
        if same + more[2] >= ALIKE * max(e - a + more[0], f - b + more[1]):
            e, f, same = e + more[0], f + more[1], same + more[2]
        c, d = e, f
        out.append((int(a), int(e), int(b), int(f), int(same)))
    return out


def align_pair(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray, sizes: np.ndarray, low: tuple[bool, bool], high: tuple[bool, bool]) -> tuple[list[tuple[int, int, int, int, int]], bool]:
    """The alike parts around the chains of two documents, best chains first, and whether one came to an edge of x or y though both texts go on there (low, high: whether each does).

    A chain that lies in a stretch of x which is aligned already adds nothing and is passed over, so a text that repeats itself costs in proportion to its length."""
    out, edge, covered, at = [], False, np.zeros(len(x), bool), 0
    for size in sizes.tolist():
        u, v = p[at : at + size], q[at : at + size]
        at += size
        if covered[u[0] : u[-1] + SEED].all():
            continue
        for a, e, c, f, same in align(x, y, u, v):
            edge |= (a == 0 and low[0] and (c > 0 or low[1])) or (c == 0 and low[1] and (a > 0 or low[0]))
            edge |= (e == len(x) and high[0] and (f < len(y) or high[1])) or (f == len(y) and high[1] and (e < len(x) or high[0]))
            if e - a >= PART:
                covered[a:e] = True
                out.append((a, e, c, f, same))
    return out, edge


def _aligned_once(slim: DataFrame, found: DataFrame, margin: int | None, folder: str, name: str) -> DataFrame:
    """The aligned parts of each pair of documents, and a row with a null start_word for a pair of which an alignment came to the edge of what it saw.

    A pair sees what its chains span and `margin` words on both sides (None: the whole texts)."""
    ids = written(found.select(F.explode(F.array("doc_id", "partner")).alias("id")).distinct(), folder, f"{name}-ids")
    ends = lambda c: (F.greatest(F.lit(0), F.array_min(c) - margin).alias("low"), (F.array_max(c) + SEED + margin).alias("high")) if margin is not None else (F.lit(0).cast("long").alias("low"), F.lit((1 << 31) - 1).cast("long").alias("high"))
    sides = found.select("pair", F.lit(0).alias("side"), "doc_id", "version", *ends("p")).unionByName(found.select("pair", F.lit(1).alias("side"), F.col("partner").alias("doc_id"), F.col("partner_version").alias("version"), *ends("q")))

    def listed(batches):
        for b in pieces(batches, "_text"):
            lists = list(word_lists(b.column("_text")))
            before = np.cumsum([0] + [len(w) for w in lists])
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_version"), list_array((np.concatenate(lists) >> np.uint64(32)).astype(np.uint32).view(np.int32), before)], ["doc_id", "version", "words"])

    words = only(slim, "_id", ids).mapInArrow(listed, "doc_id long, version long, words array<int>")
    size = F.size("words").cast("long")
    cut = F.slice("words", F.col("low").cast("int") + 1, F.greatest(F.lit(0), F.least(F.col("high"), size) - F.col("low")).cast("int"))
    views = sides.join(words.hint("merge"), ["doc_id", "version"]).select("pair", "side", F.col("low"), size.alias("size"), cut.alias("view"))
    pick = lambda side, c: F.max(F.when(F.col("side") == side, F.struct("low", "size", "view")))[c].alias(f"{c}{side}")
    both = views.groupBy("pair").agg(*(pick(side, c) for side in (0, 1) for c in ("low", "size", "view"))).join(found, "pair")

    def aligned(batches):
        for b in _sliced(batches):
            rows = []
            keys = zip(*(b.column(n).to_pylist() for n in ("pair", "doc_id", "version", "partner", "low0", "size0", "low1", "size1")))
            view0, view1, p, q, sizes = (_lists(b.column(n)) for n in ("view0", "view1", "p", "q", "sizes"))
            for k, (pair, doc, version, partner, x0, n0, y0, n1) in enumerate(keys):
                parts, edge = align_pair(view0(k), view1(k), p(k) - x0, q(k) - y0, sizes(k), (x0 > 0, y0 > 0), (x0 + len(view0(k)) < n0, y0 + len(view1(k)) < n1))
                if edge:
                    rows.append((pair, doc, version, None, None, partner, None, None, None))
                else:
                    rows += [(pair, doc, version, a + x0, e + x0, partner, c + y0, f + y0, same) for a, e, c, f, same in parts]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(9)], ["pair", "doc_id", "version", *_FIELDS])

    out = both.select("pair", "doc_id", "version", "partner", "p", "q", "sizes", "low0", "size0", "view0", "low1", "size1", "view1")
    return written(out.mapInArrow(aligned, ", ".join(f"{c} long" for c in ["pair", "doc_id", "version", *_FIELDS])), folder, f"{name}-parts")


_FIELDS = ["start_word", "end_word", "partner_id", "partner_start", "partner_end", "equal_words"]


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _sliced(batches):
        rows = []
        for doc, parts in zip(b.column("doc_id").to_pylist(), b.column("parts").to_pylist()):
            group, end = [], -1
            for part in [*parts, None]:
                if part is None or (group and part["start_word"] > end + JOIN):
                    if group and end - group[0]["start_word"] >= PASSAGE:
                        rows += [(doc, *x.values(), group[0]["start_word"], end) for x in group]
                    group, end = [], -1
                if part is not None:
                    group.append(part)
                    end = max(end, part["end_word"])
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(9)], ["doc_id", *_FIELDS, "passage_start", "passage_end"])


def repeated_passages(docs: DataFrame, within: bool = False) -> DataFrame:
    """doc_id, start_word, end_word, partner_id, partner_start, partner_end, equal_words, passage_start, passage_end: aligned parts of passages that other documents have too.

    A part is a stretch of a document that aligns with one of an earlier document (a smaller doc_id), at least ALIKE of its words equal; with `within`, also with an earlier
    stretch of the same document. Parts of a document that meet or overlap make a passage, and passages of PASSAGE words or more are returned. Each seed is joined with its
    first document only, so the rows grow with the corpus whatever the number of copies; a third document with the same passage
    has a row of its own. Words are lower-cased in A-Z. Null, short and wordless texts, and null ids, have no rows, nor has an empty table; rows that repeat a doc_id with the same text are one
    document, with other texts each a document of its own; a document's repeated seed counts at each of its places, each met with the first place in the partner, so later copies of a passage are found too;
    a stretch is aligned with the same partner once, by the best of its chains; other columns are not looked at."""
    folder = work_folder(docs.sparkSession)
    slim = _slim(docs)
    every = seeds(slim)
    least = every.groupBy("seed").agg(F.max(F.struct("doc_id", "version", *(["place"] if within else []))).alias("last"), F.min(F.struct("doc_id", "version", "place")).alias("first"))
    least = least.filter("last > first" if within else "last.doc_id > first.doc_id OR last.version > first.version")
    anchors = written(least.select("seed", F.col("first.doc_id").alias("partner"), F.col("first.version").alias("partner_version"), F.col("first.place").alias("q")), folder, "anchors")
    other = "(doc_id <> partner OR version <> partner_version)"
    matches = every.join(anchors, "seed").filter(f"{other} OR place > q" if within else other)
    lists = matches.groupBy("doc_id", "version").agg(F.collect_list(F.struct("partner", "partner_version", "q", F.col("place").alias("p"))).alias("found"))  # at most a document's own seeds
    found = lists.mapInArrow(_chained, "doc_id long, version long, partner long, partner_version long, p array<long>, q array<long>, sizes array<long>")
    found = written(found.withColumn("pair", F.monotonically_increasing_id()), folder, "chains")

    parts = None
    for k, margin in enumerate(MARGINS):
        now = _aligned_once(slim, found, margin, folder, f"{k}")
        parts = now.filter("start_word IS NOT NULL") if parts is None else parts.unionByName(now.filter("start_word IS NOT NULL"))
        open_ = now.filter("start_word IS NULL").select("pair")
        if open_.isEmpty():
            break
        found = written(found.join(open_, "pair", "left_semi"), folder, f"{k}-open")
    lists = parts.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(F.struct(*_FIELDS))).alias("parts"))  # at most a document's own chains
    return lists.mapInArrow(_passages, ", ".join(f"{c} long" for c in ["doc_id", *_FIELDS, "passage_start", "passage_end"]))


def op9_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))
