"""Quality rules: counts over a text, and how many documents of a host share its lines. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FEW, GAP, SPACES, let, read, work_folder, written

SYMBOLS = "#*$%&|<>"
#: A line is removed from a host's documents if more than LEAST documents of the host have it, and more than SHARE of them.
LEAST, SHARE = 10, 0.01
#: A document is depleted if over half of its words go, or fewer than FEWEST stay.
DEPLETED, FEWEST = 0.5, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def repeat_words(words: Column, k: int = 5) -> Column:
    """How many words are in a window of k words that is found twice or more in the array.

    The windows' hashes are compared as a set first; only texts with a repeat sort them with their places."""

    def covered(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(pairs, lambda s: F.transform(F.filter(s, lambda x, j: ((j > 0) & (x["h"] == F.get(s, j - 1)["h"])) | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))), lambda x: x["i"]))
        start = F.struct(F.lit(-k).alias("last"), F.lit(0).alias("sum"))
        return F.aggregate(F.sort_array(twice), start, lambda a, i: F.struct(i.alias("last"), (a["sum"] + F.least(F.lit(k), i - a["last"])).alias("sum")), lambda a: a["sum"])

    def windows(w):
        return F.when(F.size(w) <= k, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - k)), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k)))))

    hashes = let(F.transform(words, lambda x: F.xxhash64(x)), windows)
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def lines_of(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)


def normal_line(line: Column) -> Column:
    return F.translate(F.regexp_replace(F.trim(line, F.lit(SPACES)), GAP, " "), UPPER + "123456789", LOWER + "0" * 9)


def line_list(text: Column) -> Column:
    """For each \\n-split line its normalised form's hash (null for a line without a word) and its number of words."""

    def one(line):
        return let(normal_line(line), lambda n: F.when(n != "", F.struct(F.xxhash64(n).alias("key"), (F.length(n) - F.length(F.translate(n, " ", "")) + 1).alias("words"))).otherwise(F.struct(F.lit(None).cast("long").alias("key"), F.lit(0).alias("words"))))

    return F.transform(F.split(text, "\n"), one)


def without(text: Column, places: Column) -> Column:
    """The text without its \\n-split lines at these places; null places: as it is."""
    lines = F.split(text, "\n")
    rest = let(lines, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), places), lambda i: F.get(x, i)), "\n"))
    return F.when(places.isNull(), text).otherwise(rest)


def _keyed(docs: DataFrame, id_col: str, host_col: str) -> list[Column]:
    """The columns id, host, text (null: empty) and row, a hash of the three by which rows meet what was found for them; equal rows are judged alike."""
    text, host = F.coalesce(docs["text"].cast("string"), F.lit("")), F.coalesce(docs[host_col].cast("string"), F.lit(""))
    return [docs[id_col].cast("long").alias("id"), host.alias("host"), text.alias("text"), F.xxhash64(docs[id_col].cast("long"), host, F.xxhash64(text)).alias("row")]


def _judged(docs: DataFrame, id_col: str, host_col: str) -> DataFrame:
    """judge_lines' columns with the id as id, the row, and the places of the row's common lines.

    The texts are read once: what the counts need, and each line's hash and words, are written and all else works on them."""
    folder = work_folder(docs.sparkSession)
    text = F.col("text")
    doc = F.xxhash64("id", F.when(F.col("id").isNull(), F.xxhash64("text")))
    rows = docs.select(*_keyed(docs, id_col, host_col)).select(
        "id", "row", F.xxhash64("host").alias("host"), doc.alias("doc"), F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"), (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).cast("long").alias("r"))).alias("w"), line_list(text).alias("lines"),
    )
    rows = written(rows, folder, "lines")
    seen = rows.select("host", "doc", F.explode(F.array_distinct("lines.key")).alias("key")).filter("key IS NOT NULL").distinct()
    counts = seen.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LEAST)
    hosts = rows.select("host", "doc").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    limits = hosts.select("host", F.greatest(F.lit(float(LEAST)), F.col("documents") * SHARE).alias("limit"))
    common = written(counts.join(limits, "host").filter("n > limit").select("host", "key"), folder, "common")
    common = F.broadcast(common) if common.count() <= FEW else common.hint("merge")
    lines = rows.select("row", "host", F.posexplode("lines").alias("place", "line")).select("row", "host", "place", "line.key", "line.words")
    gone = lines.join(common, ["host", "key"]).groupBy("row", "place").agg(F.first("words").alias("words"))  # equal rows bring each line again
    gone = gone.groupBy("row").agg(F.collect_list("place").alias("places"), F.sum("words").alias("removed_words"))  # at most a document's own lines
    out = rows.drop("lines", "host", "doc").join(gone.hint("merge"), "row", "left")
    out = out.select("id", "row", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.r").alias("n_repeat_words"), "places", F.coalesce("removed_words", F.lit(0)).cast("long").alias("removed_words"))
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    depleted = (F.col("removed_words") > F.col("n_words") * DEPLETED) | (F.col("n_words") - F.col("removed_words") < FEWEST)
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge_lines(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source") -> DataFrame:
    """One row for each row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, removed_words.

    The method: lines are normalised (blanks collapsed, A-Z lower-cased, digits 0) and hashed; the host's distinct documents (ids; a row without an id counts
    by its text) that have a line are counted, exact copies under other ids included; lines above the limit are removed; a depleted document is rejected. Counts are in two steps,
    so that a line or host found everywhere is summed up before it moves. A null text is empty (0 words, base_failed), a null
    host is the host '', repeated rows are judged alike, a null id stays null, an empty table gives no rows; other columns are not looked at. removed_words counts
    what clean_lines' text has lost."""
    return _judged(docs, id_col, host_col).select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept")


def clean_lines(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source") -> DataFrame:
    """The rows of docs that judge_lines keeps, their texts without the common lines; n_chars follows, if there is one."""
    kept = _judged(docs, id_col, host_col).filter("kept").select("row", "places").dropDuplicates(["row"])
    rows = docs.select(F.struct(*docs.columns).alias("doc"), *_keyed(docs, id_col, host_col)[2:])
    out = rows.join(kept.hint("merge"), "row").withColumn("clean", without(F.col("text"), F.col("places")))
    made = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return out.select(*(made.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_lines(read(spark, sf_dir, "documents"))


_W = r"[^\x20\x09-\x0D]+"
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, host, regexp_extract_all(text, '{_W}') AS w, string_split(text, chr(10)) AS l FROM d),
l AS (SELECT doc_id, host, text, unnest(l) AS line FROM w),
l2 AS (SELECT doc_id, host, text, line, len(regexp_extract_all(line, '{_W}')) AS words,
    translate(regexp_replace(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g'), '{UPPER}123456789', '{LOWER}000000000') AS norm
    FROM l WHERE regexp_matches(line, '{_W}')),
hosts AS (SELECT host, count(DISTINCT doc_id) AS documents FROM d GROUP BY 1),
common AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT doc_id) AS n FROM l2 GROUP BY ALL) JOIN hosts USING (host) WHERE n > {LEAST} AND n > greatest({LEAST}.0, documents * {SHARE})),
gone AS (SELECT doc_id, sum(words)::BIGINT AS removed FROM l2 JOIN common USING (host, norm) GROUP BY 1),
dup AS (SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM l2 GROUP BY 1),
win AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) > 4),
win2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS n FROM win),
rep AS (SELECT doc_id, count(DISTINCT i + o)::BIGINT AS n_repeat_words FROM win2, range(5) r(o) WHERE n > 1 GROUP BY 1),
base AS (SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed, 0) AS removed_words
    FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND NOT (removed_words > n_words * {DEPLETED} OR n_words - removed_words < {FEWEST}) AS kept FROM j
"""
