"""Natural keys as text and hashes, and validity windows."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK, DELIMITER = "~NULL~", "||"
DELETED = ("D", "DEL", "DELETED", "LOGICALLY_DELETED")
PATTERNS = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: str | Column, fmt: str | None = None) -> Column:
    """The value as text in the format; a number that can't be read is null (see bad_numbers). Unknown formats raise."""
    c, fmt = _col(c), (fmt or "string").lower().strip()
    if fmt == "string":
        return c.cast("string")
    if fmt in PATTERNS:
        return F.date_format(c, PATTERNS[fmt])
    if fmt in ("bigint", "int") or re.fullmatch(r"decimal\(\d+,\s*\d+\)", fmt):
        return c.cast("string").try_cast(fmt).cast("string")
    raise ValueError(f"unknown key format: {fmt}")


def normalized(c: str | Column, fmt: str | None = None) -> Column:
    """Blanks trimmed (blanks only), upper case, a mark for null."""
    return F.coalesce(F.upper(F.trim(as_text(c, fmt))), F.lit(NULL_MARK))


def normalized_leniently(c: str | Column) -> Column:
    """Null counts as the empty text."""
    return F.upper(F.trim(F.coalesce(_col(c).cast("string"), F.lit(""))))


def bad_numbers(c: str | Column, fmt: str) -> Column:
    """1 where the value is there but has no text in the format."""
    return (_col(c).isNotNull() & as_text(c, fmt).isNull()).cast("int")


def nk_string(cols: list[str], formats: dict[str, str] | None = None, lengths: bool = False) -> Column:
    """The normalised parts in the order given, delimited; lengths: each with its length before it, so that no text can pass for two."""
    if not cols:
        raise ValueError("a natural key needs a column")
    parts = [normalized(c, (formats or {}).get(c)) for c in cols]
    if lengths:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.concat_ws(DELIMITER, *parts)


def nk_hash(text: Column) -> Column:
    return F.xxhash64(text)


def ver_hash(text: Column, start: str | Column, status: Column | None = None) -> Column:
    """Of the key, the start to the second, and the status class if versions are told apart by it; null if the start is."""
    parts = [text, F.date_format(_col(start), PATTERNS["timestamp"]), *([status] if status is not None else [])]
    return F.when(_col(start).isNotNull(), F.xxhash64(F.concat_ws(DELIMITER, *parts)))


def multi_hash(cols: list[str], start: str | None = None) -> Column:
    """The pairwise builder's hash of the lenient parts as separate arguments; another value than nk_hash has."""
    return F.xxhash64(*(normalized_leniently(c) for c in cols), *([F.col(start)] if start else []))


def status_class(c: str | Column) -> Column:
    return F.when(F.upper(F.trim(_col(c).cast("string"))).isin(*DELETED), "DELETED").otherwise("ACTIVE")


def window_end(c: str | Column) -> Column:
    """The end of a validity window; null is open."""
    return F.coalesce(_col(c), F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))


def in_window(event: str | Column, start: str | Column, end: str | Column) -> Column:
    """start <= event < end."""
    return (_col(event) >= _col(start)) & (_col(event) < window_end(end))


def overlaps(s1, e1, s2, e2) -> Column:
    return (_col(s1) < window_end(e2)) & (_col(s2) < window_end(e1))


def sk_stem(name: Column) -> Column:
    """A key column's name without one leading and one trailing key, sk or id."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"^(key|sk|id)_?", ""), r"_?(key|sk|id)$", "")


def fk_like(column: Column, stem: Column) -> Column:
    """Whether a column name holds the stem and a key marker."""
    return F.lower(column).contains(stem) & F.lower(column).rlike(r"(^|_)(key|sk|id)|(key|sk|id)$")
