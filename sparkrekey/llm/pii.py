"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, pieces, read

KINDS = ["email", "ip", "card", "phone"]

# ---------------------------------------------------------------- base patterns
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches of the pattern, from each @ outwards, so that long runs without one cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Each four parts of a dotted chain of digits, from its left; only those with parts of at most 255."""
    for chain in _DOTTED.finditer(text):
        if "." in chain[0]:
            parts = [(chain.start() + m.start(), chain.start() + m.end()) for m in _DIGITS.finditer(chain[0])]
            for i in range(0, len(parts) - 3, 4):
                if all(len(p := text[a:b].lstrip("0")) < 4 and int(p or 0) <= 255 for a, b in parts[i : i + 4]):
                    yield parts[i][0], parts[i + 3][1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns, by start, then kind."""
    out = []
    if "@" in text:
        out += [(a, b, 0) for a, b in emails(text)]
    if _DIGITS.search(text):
        out += [(a, b, 1) for a, b in addresses(text)]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


# ---------------------------------------------------------------- the model
#: Most tokens in an entity, and log2 of the number of weights for each kind.
LONGEST, BITS = 20, 14
#: Tokens whose segments are scored at a time.
STEP = 512
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s|.", re.S)
#: Tokens before a segment, and after it, that its features look at.
BEFORE, AFTER = 4, 1
#: A segment can only be an entity if it holds a digit, an @ or an "at" after an opening bracket; all else is outside, whatever the weights.
_TRIGGER = re.compile(r"[0-9@]+|[\[(](?:[0-9]+|[\W\d_])?at(?![^\W\d_])", re.I)


def _back(text: str, at: int, low: int, count: int) -> int:
    """Where the last `count` tokens before `at` begin, or low. Tokens are the same read backwards."""
    size = 256
    while True:
        ends = [m.end() for m in itertools.islice(_TOKEN.finditer(text[max(low, at - size) : at][::-1]), count + 1)]
        if len(ends) > count:
            return at - ends[count - 1]
        if at - size <= low:
            return low
        size *= 4


def _ahead(text: str, at: int, high: int, count: int) -> int:
    for m in itertools.islice(_TOKEN.finditer(text, at, high), count):
        at = m.end()
    return at


def islands(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Stretches around triggers outside the taken spans: LONGEST tokens to both sides and those that features look at, merged if they meet.

    Every segment that may be an entity lies in one of them with all that its features see, so decoding them alone is decoding the text between taken spans."""
    low = 0
    for high, after in [*((a, b) for a, b, _ in sorted(taken)), (len(text), len(text))]:
        start = end = -1
        for m in _TRIGGER.finditer(text, low, high) if low < high else ():
            left = start if m.start() < end else _back(text, m.start(), low, LONGEST + BEFORE)
            if end >= 0 and left > end:
                yield start, end
                start = -1
            start = left if start < 0 else start
            end = max(end, _ahead(text, m.end(), high, LONGEST + AFTER))
        if end >= 0:
            yield start, end
        low = max(low, after)


def _hash(x: tuple) -> int:
    return int.from_bytes(hashlib.blake2b(repr(x).encode(), digest_size=4).digest(), "little") >> (32 - BITS)


@functools.lru_cache(1 << 16)
def _place(x: tuple) -> int:
    return _hash(x)


_AT, _DOT = (re.compile(r"[\[(]\s?%s\s?[\])]" % w, re.I) for w in ("at", "dot"))
_NAME = re.compile(r"[\w.%+-]+")


def form(text: str) -> str:
    """An address with its names as w, its at as @ and its bracketed dots as &: 'w @ w & w' holds one name on each side, 'w w @ w' a word too many."""
    return _NAME.sub("w", _DOT.sub("&", _AT.sub("@", text)))


def span_features(tokens: list[str], i: int, j: int, before: str) -> list[int]:
    """Features of the whole segment tokens[i:j]: its shape, its digits and their checks, its ends and the words around it."""
    part = tokens[i:j]
    text = "".join(part)
    digits = "".join(t for t in part if t[0].isdigit() and t.isascii())
    shape = "".join(f"d{min(len(t), 7)}" if t[0].isdigit() else "a" if t[0].isalpha() else " " if t.isspace() else t for t in part)
    groups = tuple(len(t) for t in part if t[0].isdigit())
    marks = "".join(sorted({t for t in part if not t[0].isalnum()}))
    numbers = [t for t in part if t[0].isdigit()]
    dotted = len(numbers) == 4 and len(part) == 7 and all(t == "." for t in part[1::2])
    word = next((t.lower() for t in reversed(tokens[max(0, i - 4) : i]) if t[0].isalpha()), before)
    left = tokens[i - 1][0] if i else " "
    right = tokens[j][0] if j < len(tokens) else " "
    edge = tuple("a" if c.isalpha() else "d" if c.isdigit() else " " if c.isspace() else c for c in (left, right))
    at = "@" in part or re.search(r"[\[(]\s?at\s?[\])]", text, re.I) is not None
    return [
        _place(("shape", re.sub(r"(a[. ]?)+", "a", shape) if at else shape)),
        _place(("digits", len(digits), groups if len(groups) < 6 else len(groups))),
        _place(("luhn", 12 <= len(digits) <= 19 and luhn(digits), marks, any(t[0].isalpha() for t in part))),
        _place(("dotted", dotted and all(len(t) < 4 and int(t) <= 255 for t in numbers), len(part))) if dotted else _place(("marks", marks)),
        _place(("at", at, bool(re.search(r"(\.|[\[(]\s?dot\s?[\])]\s?)[A-Za-z]{2,}$", text, re.I)), text.count("@"), " " in text and "@" in part)),
        _place(("form", form(text) if at else "")),
        _place(("ends", part[0] if part[0] in "+([" else shape[:1], shape[-2:-1] + shape[-1:] if part[-1][0].isdigit() else part[-1] if not part[-1].isalpha() else "a")),
        _place(("edge", edge)),
        _place(("word", word if word in HINTS else "")),
        _place(("word and digits", word if word in HINTS else "", len(digits))),
    ]


#: Words before an entity that the features name (all others are alike).
HINTS = frozenset(["tel", "phone", "call", "fax", "mobile", "card", "visa", "account", "ip", "host", "server", "mail", "email", "contact", "version", "section", "page", "token", "year", "isbn", "order"])


class SemiMarkov:
    """Scores of segments by kind; one weight for outside tokens is held at 0, so the others are relative to it.

    Segments of up to LONGEST tokens compete; forward sums give the likelihood's gradient, forward maxima the best segmentation."""

    def __init__(self):
        self.weights = np.zeros((len(KINDS), 1 << BITS))

    def segments(self, tokens: list[str], before: str, low: int = 0, high: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, features) of every segment that may be an entity and ends after token low, up to token high; sorted by end."""
        high, first = len(tokens) if high is None else high, max(0, low + 1 - LONGEST)
        hot = [t[0].isdigit() and t.isascii() or t == "@" for t in tokens[first:high]]
        for k in range(first, min(high, len(tokens) - 2)):
            if tokens[k] in "[(" and "at" in (tokens[k + 1].lower(), tokens[k + 2].lower()):
                hot[k - first] = True
        seen = np.concatenate([[0], np.cumsum(hot)])
        spans = [(i, j) for j in range(low + 1, high + 1) for i in range(max(0, j - LONGEST), j) if seen[j - first] > seen[i - first] and not tokens[i].isspace() and not tokens[j - 1].isspace()]
        return np.array([s[0] for s in spans], int), np.array([s[1] for s in spans], int), np.array([span_features(tokens, i, j, before) for i, j in spans], int)

    def scores(self, found: np.ndarray) -> np.ndarray:
        return self.weights[:, found].sum(axis=2)

    def fit(self, examples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 6, rate: float = 0.2, ridge: float = 1e-4) -> SemiMarkov:
        """Stochastic steps (AdaGrad) on the conditional log-likelihood of labelled texts."""
        grown = np.full(self.weights.shape, 1e-2)
        ready = []
        for text, spans in examples:
            tokens, edges = tokens_of(text)
            at = {e: k for k, e in enumerate(edges)}
            starts, ends, found = self.segments(tokens, "")
            if len(starts):
                gold = {(at[a], at[b]): k for a, b, k in spans}
                ready.append((len(tokens), starts, ends, found, np.array([gold.get((i, j), -1) for i, j in zip(starts, ends)])))
        order = random.Random(5)
        for _ in range(rounds):
            order.shuffle(ready)
            for n, starts, ends, found, gold in ready:
                s = self.scores(found)
                g = -marginals(n, starts, ends, s)
                some = np.flatnonzero(gold >= 0)
                g[gold[some], some] += 1
                busy = np.flatnonzero(np.abs(g).max(axis=0) > 1e-3)
                for k in range(len(KINDS)):
                    step = np.zeros(1 << BITS)
                    np.add.at(step, found[busy].ravel(), np.repeat(g[k, busy], found.shape[1]))
                    on = np.flatnonzero(step)
                    step = step[on] - ridge * self.weights[k, on]
                    grown[k, on] += step * step
                    self.weights[k, on] += rate * step / np.sqrt(grown[k, on])
        return self

    def decode(self, text: str, before: str = "") -> list[tuple[int, int, int]]:
        """The best segmentation's entities as (start, end, kind) in characters; STEP tokens at a time, so that memory grows with the tokens alone."""
        tokens, edges = tokens_of(text)
        good = [0.0] * (len(tokens) + 1)
        back: list[tuple | None] = [None] * (len(tokens) + 1)
        for low in range(0, len(tokens), STEP):
            high = min(len(tokens), low + STEP)
            starts, ends, found = self.segments(tokens, before, low, high)
            s = self.scores(found) if len(starts) else np.empty((len(KINDS), 0))
            kind, best = (s.argmax(axis=0), s.max(axis=0)) if len(starts) else ([], [])
            at = 0
            for j in range(low + 1, high + 1):
                good[j] = good[j - 1]
                while at < len(ends) and ends[at] == j:
                    if best[at] > 0 and good[starts[at]] + best[at] > good[j]:
                        good[j], back[j] = good[starts[at]] + best[at], (starts[at], kind[at])
                    at += 1
        out, j = [], len(tokens)
        while j > 0:
            if back[j]:
                i, k = back[j]
                out.append((edges[i], edges[j], int(k)))
                j = int(i)
            else:
                j -= 1
        return out[::-1]


def tokens_of(text: str) -> tuple[list[str], list[int]]:
    found = list(_TOKEN.finditer(text))
    return [m[0] for m in found], [*(m.start() for m in found), len(text)]


def marginals(n: int, starts: np.ndarray, ends: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Probability of each segment and kind."""
    forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    forward[0] = backward[n] = 0.0
    all_ = np.logaddexp.reduce(s, axis=0)
    by_end = np.searchsorted(ends, np.arange(n + 2))
    for j in range(1, n + 1):
        a, b = by_end[j], by_end[j + 1]
        forward[j] = np.logaddexp.reduce(np.concatenate([[forward[j - 1]], forward[starts[a:b]] + all_[a:b]]))
    order = np.argsort(starts, kind="stable")
    by_start = np.searchsorted(starts[order], np.arange(n + 2))
    for i in range(n - 1, -1, -1):
        o = order[by_start[i] : by_start[i + 1]]
        backward[i] = np.logaddexp.reduce(np.concatenate([[backward[i + 1]], backward[ends[o]] + all_[o]]))
    return np.exp(s + (forward[starts] + backward[ends])[None, :] - forward[n])


# ---------------------------------------------------------------- examples to learn from
def _with_luhn(r: random.Random, n: int, good: bool = True) -> str:
    body = "".join(r.choice("0123456789") for _ in range(n - 1))
    check = next(c for c in "0123456789" if luhn(body + c))
    return body + (check if good else str((int(check) + r.randint(1, 9)) % 10))


def examples(count: int = 700, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Made-up labelled lines: entities as people write them, and numbers that are none."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioulnrstdmkp") for _ in range(r.randint(2, 7)))
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    part = lambda: str(r.randint(0, 255))

    def email():
        name = r.choice([word() + r.choice([".", "_", ""]) + word(), word() + num(2), word() + "." + num(2)])
        host, end = r.choice([word(), "mail" + num(1) + "." + word()]), r.choice(["com", "org", "net", "de", "co.uk"])
        style = r.random()
        if style < 0.5:
            return f"{name}@{host}.{end}"
        a, d = r.choice([("[at]", "[dot]"), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" (at) ", "."), ("[at]", ".")])
        return f"{name}{a}{host}{d}{end.split('.')[0]}"

    def phone():
        a, b, c = num(3), num(3), num(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{num(2)} {num(3)} {num(7)}", f"00{num(2)} {num(3)} {num(7)}", f"1-{a}-{b}-{c}"])

    def card():
        digits, gap = _with_luhn(r, 16), r.choice(["", " ", "-", ".", "_"])
        return gap.join(digits[i : i + 4] for i in range(0, 16, 4))

    def ip():
        parts = [part() for _ in range(4)]
        return r.choice([".".join(parts), "[.]".join(parts), " . ".join(parts)])

    makers = [email, ip, card, phone]
    hints = [["mail", "email", "contact"], ["ip", "host", "server"], ["card", "visa", "account"], ["tel", "phone", "call", "fax", "mobile"]]
    other = [
        lambda: f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: f"{r.randint(1, 12)}/{r.randint(1, 28)}/{r.randint(1900, 2030)}", lambda: num(r.randint(1, 11)), lambda: f"{num(1)}.{num(1)}",
        lambda: f"v{num(1)}.{num(2)}.{num(1)}", lambda: _with_luhn(r, 16, False), lambda: f"token = \"{''.join(r.choice('0123456789abcdef') for _ in range(40))}\"", lambda: f"{num(3)},{num(3)}.{num(2)}",
        lambda: f"version {num(1)}.{num(1)}.", lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: f"{word()}{num(2)}", lambda: f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}", lambda: f"@{word()}", lambda: f"{num(3)}.{num(3)}.{r.randint(256, 999)}.{num(3)}",
        lambda: f"section {num(1)}.{num(1)}.{num(1)}", lambda: "".join(r.choice("0123456789abcdef") for _ in range(32)), lambda: f"{num(2)}%", lambda: f"${num(2)}.{num(2)}", lambda: f"({num(4)})", lambda: f"[{num(2)}]", lambda: f"4.0.{num(1)}",
    ]
    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(r.randint(1, 2)):
            text += word() + " "
            if r.random() < 0.5:
                k = r.randrange(4)
                if r.random() < 0.4:
                    text += r.choice(hints[k]) + r.choice([": ", " ", "="])
                made = makers[k]()
                spans.append((len(text), len(text) + len(made), k))
                text += made
            else:
                text += r.choice(other)()
            text += r.choice(["", "", ".", ",", "!!", "&&&", " |"]) + " "
        out.append((text + word(), spans))
    return out


@functools.lru_cache(1)
def trained() -> np.ndarray:
    """The weights; every run learns the same ones from examples()."""
    return SemiMarkov().fit(examples()).weights


# ---------------------------------------------------------------- the operator
class Finder:
    """Base spans, and the model's in the islands between them."""

    #: Characters of islands whose spans are kept for the next text, and of the longest one kept.
    KEPT, WIDEST = 1 << 21, 500

    def __init__(self, weights: np.ndarray):
        self.model = SemiMarkov()
        self.model.weights = weights
        self.known: dict[tuple[str, str], list] = {}
        self.held = 0

    def _decoded(self, word: str, island: str) -> list[tuple[int, int, int]]:
        found = self.known.get((word, island))
        if found is None:
            found = self.model.decode(island, word)
            if len(island) <= self.WIDEST:
                self.held += len(island)
                if self.held > self.KEPT:
                    self.known, self.held = {}, len(island)
                self.known[word, island] = found
        return found

    def added(self, text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The model's spans; islands lie between the taken spans, so none overlaps one."""
        out, ends = [], {y for _, y, _ in taken}
        for a, b in islands(text, taken):
            # only after a taken span may a segment's word lie before the island
            word = re.search(r"([^\W\d_]+)\W*\Z", text[max(0, a - 24) : a]) if a in ends else None
            out += [(a + i, a + j, k) for i, j, k in self._decoded(word[1].lower() if word else "", text[a:b])]
        return out

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        base = base_spans(text)
        return base, self.added(text, base)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_pii(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, the base spans' counts by kind, the digest of their list, all spans, and how many the model added.

    Offsets are in code points. A null or empty text has no spans; repeated rows are searched each; a null id stays null; an empty
    table gives no rows; other columns are not looked at. Long texts cost in proportion to their length."""
    weights = docs.sparkSession.sparkContext.broadcast(trained().astype(np.float32))

    def work(batches):
        finder = Finder(weights.value)
        for b in pieces(batches, "_text"):
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                base, more = finder.spans(text or "")
                counts = [sum(s[2] == k for s in base) for k in range(4)]
                rows.append((i, *counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more), len(more)))
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return bounded(docs).select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text")).mapInArrow(work, SCHEMA)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with each span in the text replaced by its kind in angle brackets (of overlapping ones, by the first); n_chars follows, if there is one.

    A null text stays null, an empty one empty; repeated rows are redacted each; an empty table gives no rows; other columns pass through as they are."""
    weights = docs.sparkSession.sparkContext.broadcast(trained().astype(np.float32))

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(weights.value)
        for texts in batches:
            out = []
            for text in texts:
                if text is None:
                    out.append(None)
                    continue
                base, more = finder.spans(text)
                done, at = [], 0
                for a, b, k in sorted(base + more, key=lambda s: (s[0], s[2])):
                    if a >= at:
                        done += [text[at:a], f"<{KINDS[k]}>"]
                    at = max(at, b)
                out.append("".join([*done, text[at:]]))
            yield pd.Series(out, dtype=object)

    made = bounded(docs).withColumn(text_col, clean(F.col(text_col).cast("string")))
    return made.withColumn("n_chars", F.length(text_col).cast("long")) if "n_chars" in docs.columns else made


def op2_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read(spark, sf_dir, "documents"))
