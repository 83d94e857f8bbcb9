"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import GAP, SPACES, let, read, work_folder, written

#: Words in a block, slots in an output shard, and most passes over a source.
BLOCK, SHARD, PASSES = 32, 1 << 12, 3
#: Indices that one task ranks, about, and the bits of the hash that ranks them.
GROUP, BITS = 1 << 16, 60
#: Bits after the point in a source's expected slots of a shard, and of the whole mix.
SHARE, FIXED = 40, 20
#: Most sources whose shares are broadcast (40 bytes each); with more, the same join shuffles.
SOURCES = 100_000


def n_words(text: Column) -> Column:
    """The number of words; null: 0."""
    return let(F.split(F.rtrim(F.coalesce(text, F.lit("")), F.lit(SPACES)), GAP), lambda w: F.size(w) - (w[0] == "").cast("int")).cast("long")


def ranked(indices: DataFrame, key: list[str], size: Column, label: str, by: list[str]) -> DataFrame:
    """indices (rows of rank, i: 0 to size-1 for each `key`) with `pos`, i's place in the key's pseudorandom permutation: by the hash of
    label, rank and i, then by i.

    The hash's upper bits deal each key's rows to groups of some GROUP rows that keep its order, so a hot key spans many tasks;
    the groups' counts, a row for each, give their first places; the rows lie sorted by group already, so the merge join costs no shuffle of theirs and no broadcast."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(label), "rank", "i")), 1, BITS // 4), 16, 10).cast("long")
    groups = F.floor((size - 1) / GROUP).cast("long") + 1
    rows = indices.withColumn("h", h).withColumn("part", F.shiftright(F.shiftright("h", BITS // 2) * groups, BITS // 2))
    counts = rows.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n"))
    firsts = counts.select(*key, "part", (F.sum("n").over(Window.partitionBy(*key).orderBy("part")) - F.col("n")).alias("before"))
    rows = rows.withColumn("inside", F.row_number().over(Window.partitionBy(*key, "part").orderBy("h", *by)) - 1)
    return rows.join(firsts.hint("merge"), [*key, "part"]).withColumn("pos", F.col("before") + F.col("inside")).drop("h", "part", "before", "inside")


def numbered(plan: DataFrame, column: str, total: int) -> DataFrame:
    """plan's columns, a row for each i below `column`; a source's row is first cut into groups, so a hot source spans many tasks."""
    cut = plan.filter(F.col(column) > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(column) - 1) / GROUP).cast("long"))).alias("c"))
    cut = cut.repartition(max(1, min(2 * (total // GROUP), 100_000)), "rank", "c")
    low = F.col("c") * GROUP
    return cut.select(*plan.columns, F.explode(F.sequence(low, F.least(low + GROUP, F.col(column)) - 1)).alias("i"))


def source_plan(sized: DataFrame, block: int = BLOCK, passes: int = PASSES, shard: int = SHARD) -> DataFrame:
    """A row for each source: source, rank, source_size, target, blocks, slots that meet its target (in units of 2^-FIXED), all_slots and shards of the mix, and the
    slots that it expects in a full shard and in the last one (in units of 2^-SHARE; a shard's add up to its slots exactly).

    By code point, null last, sources weigh 1, 2, 3, 1, ... and share the sum of all sizes; a target stops at `passes` times its
    source's size and the excess is shared by weight among the others, until none is above. Sorted by limit / weight, the
    sources before some point are at their limits and the rest share one rate, so two running sums solve it. One row for each source is handled in one task."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_ratio", "rank")
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(by_name).cast("long"))
    s = s.withColumn("weight", (F.col("rank") - 1) % 3 + 1).withColumn("limit_ratio", F.col("source_size") * passes / F.col("weight"))
    s = s.withColumn("total", F.sum("source_size").over(everything))
    s = s.withColumn("above", F.coalesce(F.sum(F.col("source_size") * passes).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("rate", (F.col("total") - F.col("above")) / F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("rate", F.min(F.when(F.col("rate") <= F.col("limit_ratio"), F.struct("limit_ratio", "rank", "rate"))).over(everything)["rate"])
    s = s.withColumn("target", F.least((F.col("source_size") * passes).cast("double"), F.coalesce(F.col("rate") * F.col("weight"), F.lit(0.0))))
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    s = s.withColumn("slots", F.when(F.col("source_size") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("source_size") * (1 << FIXED) + 0.5).cast("long")).otherwise(F.lit(0).cast("long")))
    total = F.sum("slots").over(everything)
    s = s.withColumn("total", total).withColumn("before", F.sum("slots").over(by_name.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("all_slots", F.shiftright(F.col("total") + (1 << FIXED - 1), FIXED)).withColumn("shards", F.ceil(F.col("all_slots") / shard).cast("long"))
    for name, n in (("full", F.lit(shard)), ("last", F.col("all_slots") - (F.col("shards") - 1) * shard)):
        upto = F.when(F.col("before") == F.col("total"), n.cast("long") * (1 << SHARE)).otherwise(F.floor(F.col("before").cast("double") * n / F.col("total").cast("double") * (1 << SHARE) + 0.5).cast("long"))
        s = s.withColumn("upto", F.when(F.col("total") > 0, upto).otherwise(0)).withColumn(name, F.col("upto") - F.coalesce(F.lag("upto").over(by_name), F.lit(0)))
    return s.select("source", "rank", "source_size", "target", "blocks", "slots", "all_slots", "shards", "full", "last")


def placed(sized: DataFrame, folder: str, plan: DataFrame) -> DataFrame:
    """Each row with the number of its source's words before it, in the order of doc_id.

    A running sum in two steps: rows are dealt by ranges of (source, doc_id), so a hot source spans many tasks; the
    sums of each range and source are few and give the ranges' first words."""
    dealt = sized.repartitionByRange(F.col("source").asc_nulls_last(), F.col("doc_id"), F.col("size"), F.col("spread"))
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), folder, "placed")
    within = Window.partitionBy("part", "source").orderBy(F.col("doc_id").asc_nulls_first(), "size", "spread")
    parts = dealt.groupBy("part", "source").agg(F.sum("size").alias("part_size"))
    parts = parts.withColumn("before", F.sum("part_size").over(Window.partitionBy("source").orderBy("part")) - F.col("part_size"))
    parts = parts.join(plan.withColumnRenamed("source", "_name"), F.col("source").eqNullSafe(F.col("_name")))
    parts = parts.select(F.col("part").alias("_part"), F.col("source").alias("_source"), "before", "rank", "source_size", "target")
    out = dealt.withColumn("inside", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    out = out.join(parts, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
    return out.select("doc_id", "source", "size", "spread", "rank", "source_size", "target", (F.col("before") + F.col("inside")).alias("start"))


def shard_draws(plan: DataFrame, shards: int) -> DataFrame:
    """rank, shard: the multinomial draw of each shard, a row for each drawn slot (see draw).

    `rest` is the part of a source's expected slots beyond the whole ones; the rests of a shard add up to a whole number of slots, and each of these falls to
    a source with a probability in proportion to its rest. A drawn number's upper part is the bucket of a hash join with the sources' ranges, of which each meets two buckets at most."""
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), (F.col(c) % (1 << SHARE)).alias("rest")) for k, c in enumerate(("full", "last"))))).alias("k")
    ranges = plan.select("rank", kinds).select("rank", "k.*").withColumn("high", F.sum("rest").over(Window.partitionBy("kind").orderBy("rank")))
    ranges = ranges.withColumn("low", F.col("high") - F.col("rest")).filter("rest > 0")
    counts = {r["kind"]: r["n"] for r in ranges.groupBy("kind").agg(F.shiftright(F.max("high"), SHARE).alias("n")).collect()}  # two rows
    kind = (F.col("shard") == shards - 1).cast("int")
    dealt = plan.sparkSession.range(shards, numPartitions=max(1, min(shards * counts.get(0, 0) >> 16, 100_000))).select(F.col("id").alias("shard"))
    dealt = dealt.select("shard", kind.alias("kind"), F.when(kind == 1, counts.get(1, 0)).otherwise(counts.get(0, 0)).alias("number"))
    slots = dealt.filter("number > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("number") - 1)).alias("slot"))
    digest = F.md5(F.concat_ws(":", F.lit("draw"), "shard", "slot"))
    hex_ = lambda start, digits: F.conv(F.substring(digest, start, digits), 16, 10).cast("long")
    drawn = slots.select("shard", "kind", (hex_(11, 12) % F.col("number")).alias("bucket"), hex_(1, SHARE // 4).alias("fine"))
    drawn = drawn.withColumn("v", F.col("bucket") * (1 << SHARE) + F.col("fine"))
    wide = ranges.select("rank", "kind", "low", "high", F.explode(F.sequence(F.shiftright("low", SHARE), F.shiftright(F.col("high") - 1, SHARE))).alias("bucket"))
    wide = F.broadcast(wide) if plan.count() <= SOURCES else wide.hint("merge")
    return drawn.join(wide, ["kind", "bucket"]).filter("low <= v AND v < high").select("rank", "shard")


def draw(plan: DataFrame, passes: int = PASSES) -> DataFrame:
    """rank, j, pass, block, shard: the blocks that the mix takes, a row for each slot.

    Each output shard draws its sources' counts as a residual multinomial, a function of its number alone: of the slots that a source expects in a shard, the whole ones are
    certain and the rests are drawn, so counts have the multinomial's means with less spread, and every source's total comes within some slots of its target. The
    certain slots of a source are numbered shard by shard, the drawn ones after them by running sums over the shards, in groups and then over the groups. Slot j of a source is
    block j mod blocks of pass j div blocks, mapped through the source's own permutation. Where a source is at its limit, slots beyond its last pass stay empty."""
    # The optimizer takes the exploded rows for as few as the plan's, so joins with them name their kind.
    shards, blocks = plan.agg(F.coalesce(F.max("shards"), F.lit(0)), F.coalesce(F.sum("blocks"), F.lit(0))).first()
    plan = plan.withColumn("each", F.shiftright("full", SHARE)).withColumn("certain", F.col("each") * max(0, shards - 1) + F.shiftright("last", SHARE))
    certain = plan.agg(F.coalesce(F.sum("certain"), F.lit(0))).first()[0]
    slots = numbered(plan.select("rank", "blocks", "each", "certain"), "certain", certain)
    slots = slots.select("rank", "blocks", F.col("i").alias("j"), F.when(F.col("each") > 0, F.least(F.floor(F.col("i") / F.col("each")), F.lit(shards - 1))).otherwise(shards - 1).cast("long").alias("shard"))
    extra = shard_draws(plan, shards).groupBy("rank", "shard").agg(F.count(F.lit(1)).alias("n")).withColumn("g", F.shiftright("shard", 12))
    sums = extra.groupBy("rank", "g").agg(F.sum("n").alias("gn"))
    sums = sums.withColumn("before", F.sum("gn").over(Window.partitionBy("rank").orderBy("g")) - F.col("gn")).select("rank", "g", "before")
    extra = extra.withColumn("inside", F.sum("n").over(Window.partitionBy("rank", "g").orderBy("shard")) - F.col("n")).join(sums.hint("merge"), ["rank", "g"])
    first = F.col("certain") + F.col("before") + F.col("inside")
    extra = extra.join(F.broadcast(plan.select("rank", "blocks", "certain")) if plan.count() <= SOURCES else plan.select("rank", "blocks", "certain"), "rank")
    extra = extra.select("rank", "blocks", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("j"), "shard")
    slots = slots.unionByName(extra).filter(F.col("j") < F.col("blocks") * passes)
    slots = slots.select("rank", "shard", "j", F.floor(F.col("j") / F.col("blocks")).cast("long").alias("pass"), (F.col("j") % F.col("blocks")).alias("pos"))
    places = ranked(numbered(plan.select("rank", "blocks"), "blocks", blocks), ["rank"], F.col("blocks"), "block", ["i"])
    return slots.join(places.select("rank", "pos", F.col("i").alias("block")).hint("merge"), ["rank", "pos"]).select("rank", "j", "pass", "block", "shard")


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and a hash that spreads rows of one doc_id; extra columns are not looked at."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(text).alias("size"), F.xxhash64(text).alias("spread"))


def mix_sizes(docs: DataFrame, block: int = BLOCK, passes: int = PASSES, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(rows, blocks): each row of docs with its place, and the mix's slots; see placed and draw."""
    folder = work_folder(docs.sparkSession)
    sized = written(sized_rows(docs), folder, "sized")
    plan = written(source_plan(sized, block, passes, shard), folder, "plan")
    rows = placed(sized, folder, plan)
    return rows, draw(plan, passes)


def block_rows(rows: DataFrame, block: int) -> DataFrame:
    """A row for each block that a row of docs has words in: rank, block, start, and the words low..high-1 of the row."""
    b = F.explode(F.sequence(F.floor(F.col("start") / block).cast("long"), F.floor((F.col("start") + F.col("size") - 1) / block).cast("long")))
    out = rows.filter("size > 0").select("rank", "start", "size", b.alias("block"))
    return out.select("rank", "start", "block", F.greatest(F.lit(0), F.col("block") * block - F.col("start")).alias("low"), F.least("size", (F.col("block") + 1) * block - F.col("start")).alias("high"))


def mix(docs: DataFrame, block: int = BLOCK, passes: int = PASSES, shard: int = SHARD) -> DataFrame:
    """One row for each row of docs: doc_id, source, size (words), source_size, target, taken (words that the mix takes, repeats counted), first_shard (of the output shards that hold words of it; null if none does).

    A null source is a source of its own, the last; a null or wordless text has size 0 and is never taken; repeated rows count
    each; a null doc_id comes first in its source; an empty table gives no rows; other columns are not looked at. Reruns agree: all draws are functions of the sizes."""
    rows, drawn = mix_sizes(docs, block, passes, shard)
    uses = drawn.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("uses"), F.min("shard").alias("shard"))
    taken = block_rows(rows, block).join(uses.hint("merge"), ["rank", "block"]).groupBy("rank", "start").agg(F.sum(F.col("uses") * (F.col("high") - F.col("low"))).alias("taken"), F.min("shard").alias("first_shard"))
    taken = taken.withColumn("some", F.lit(True))
    out = rows.withColumn("some", F.col("size") > 0).join(taken.hint("merge"), ["rank", "start", "some"], "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")


def _cut_texts(docs: DataFrame, rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """doc (the row of docs as a struct) and cut (of `cuts`: rank, start and a list `cuts` of structs with parts, a list of low and high), with the text of the cut's words, each with the white space after it."""
    name = ["doc_id", "source", "size", "spread"]
    again = Window.partitionBy(*name).orderBy("start")
    keyed = rows.filter("size > 0").join(cuts.hint("merge"), ["rank", "start"]).withColumn("again", F.row_number().over(again)).select(*(F.col(c).alias(f"k_{c}") for c in name), "again", "cuts")
    text = F.col("text").cast("string")
    wide = docs.select(F.struct(*docs.columns).alias("doc"), text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(text).alias("size"), F.xxhash64(text).alias("spread"))
    wide = wide.filter("size > 0").withColumn("n", F.row_number().over(Window.partitionBy(*name).orderBy(F.lit(1))))
    same = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in name] + [F.col("n") == F.col("again")]
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), 1)
    part = lambda w, c: F.array_join(F.slice(w, c["low"].cast("int") + 1, (c["high"] - c["low"]).cast("int")), "")
    texts = let(words, lambda w: F.transform("cuts", lambda cut: F.struct(cut.alias("cut"), F.array_join(F.transform(cut["parts"], lambda c: part(w, c)), "").alias("text"))))
    return wide.join(keyed.hint("merge"), same).select("doc", F.explode(texts).alias("x")).select("doc", "x.cut", "x.text")


def mixed_documents(docs: DataFrame, block: int = BLOCK, passes: int = PASSES, shard: int = SHARD) -> DataFrame:
    """The mix as documents, with docs' columns: for each pass a row of a document with the words that its taken blocks hold, each with
    the white space after it; n_chars follows the text. A row that no pass takes words of is left out, as null and wordless texts are; repeated rows have their own words each; an empty table gives none."""
    rows, drawn = mix_sizes(docs, block, passes, shard)
    cuts = block_rows(rows, block).join(drawn.hint("merge"), ["rank", "block"]).groupBy("rank", "start", "pass").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("parts"))
    cuts = cuts.groupBy("rank", "start").agg(F.collect_list(F.struct("parts")).alias("cuts"))  # `passes` at most
    made = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return _cut_texts(docs, rows, cuts).select(*(made.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def mixed_shards(docs: DataFrame, block: int = BLOCK, passes: int = PASSES, shard: int = SHARD) -> DataFrame:
    """The mix as output shards: shard, place (of the slot in it, gapless from 0), pass, block, doc_id, source, low, text. A slot has a row for each document that its block holds words of,
    low being the first word's number in the document; a shard's slots are ordered by a hash, so that its sources are mixed."""
    rows, drawn = mix_sizes(docs, block, passes, shard)
    order = Window.partitionBy("shard").orderBy(F.md5(F.concat_ws(":", F.lit("place"), "rank", "j")), "rank", "j")  # a shard's slots
    drawn = drawn.withColumn("place", (F.row_number().over(order) - 1).cast("long"))
    slot = F.struct("shard", "place", "pass", "block", "low", F.array(F.struct("low", "high")).alias("parts"))
    cuts = block_rows(rows, block).join(drawn.hint("merge"), ["rank", "block"]).groupBy("rank", "start").agg(F.collect_list(slot).alias("cuts"))  # at most `passes` for each block of the document
    out = _cut_texts(docs, rows, cuts)
    return out.select("cut.shard", "cut.place", "cut.pass", "cut.block", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.source").cast("string").alias("source"), "cut.low", "text")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).drop("source")


ORACLE = rf"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s1 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY 1),
s2 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST)::BIGINT AS rank, sum(source_size) OVER ()::BIGINT AS total FROM s1),
s3 AS (SELECT *, (rank - 1) % 3 + 1 AS weight, {PASSES} * source_size AS most FROM s2),
s4 AS (SELECT *, most::DOUBLE / weight AS ratio, (total - coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY most::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate FROM s3),
s5 AS (SELECT *, (SELECT arg_min(rate, {{'a': ratio, 'b': rank}}) FROM s4 WHERE rate <= ratio) AS fill FROM s4),
s6 AS (SELECT source, rank, source_size, least(most::DOUBLE, coalesce(fill * weight, 0)) AS target, ceil(source_size / {BLOCK})::BIGINT AS blocks FROM s5),
units AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target * blocks / source_size * {1 << FIXED} + 0.5)::BIGINT ELSE 0 END AS slots FROM s6),
sums AS (SELECT *, (sum(slots) OVER (ORDER BY rank))::BIGINT AS before, (sum(slots) OVER ())::BIGINT AS total FROM units),
size_ AS (SELECT all_slots, ceil(all_slots / {SHARD})::BIGINT AS shards FROM (SELECT (sum(slots)::BIGINT + {1 << FIXED - 1}) // {1 << FIXED} AS all_slots FROM units)),
shard_ AS (SELECT unnest(range(shards)) AS shard, shards FROM size_),
n AS (SELECT shard, CASE WHEN shard = shards - 1 THEN all_slots - (shards - 1) * {SHARD} ELSE {SHARD} END AS n FROM shard_ JOIN size_ USING (shards)),
upto AS (SELECT shard, rank, blocks, CASE WHEN before = total THEN n * {1 << SHARE} ELSE floor(before::DOUBLE * n / total::DOUBLE * {1 << SHARE} + 0.5)::BIGINT END AS upto FROM n, sums),
shares AS (SELECT shard, rank, blocks, upto - coalesce(lag(upto) OVER (PARTITION BY shard ORDER BY rank), 0) AS share FROM upto),
expected AS (SELECT shard, rank, blocks, share // {1 << SHARE} AS whole, share % {1 << SHARE} AS rest FROM shares),
ranges AS (SELECT shard, rank, sum(rest) OVER (PARTITION BY shard ORDER BY rank) - rest AS low, sum(rest) OVER (PARTITION BY shard ORDER BY rank) AS high FROM expected),
number AS (SELECT shard, (sum(rest) // {1 << SHARE})::BIGINT AS number FROM expected GROUP BY 1),
slot AS (SELECT shard, number, unnest(range(number)) AS slot FROM number),
drawn AS (SELECT shard, md5('draw:' || shard || ':' || slot) AS h, number FROM slot),
v AS (SELECT shard, ('0x' || h[11:22])::BIGINT % number * {1 << SHARE} + ('0x' || h[1:{SHARE // 4}])::BIGINT AS v FROM drawn),
extra AS (SELECT v.shard, rank, count(*) AS extra FROM v JOIN ranges r ON r.shard = v.shard AND r.low <= v.v AND v.v < r.high GROUP BY ALL),
counts AS (SELECT e.shard, e.rank, e.blocks, e.whole, coalesce(x.extra, 0) AS extra FROM expected e LEFT JOIN extra x ON e.shard = x.shard AND e.rank = x.rank),
firsts AS (SELECT *, sum(whole) OVER (PARTITION BY rank ORDER BY shard) - whole AS first, sum(whole) OVER (PARTITION BY rank) + sum(extra) OVER (PARTITION BY rank ORDER BY shard) - extra AS drawn FROM counts),
js AS (SELECT rank, blocks, shard, unnest(range(first::BIGINT, (first + whole)::BIGINT)) AS j FROM firsts UNION ALL SELECT rank, blocks, shard, unnest(range(drawn::BIGINT, (drawn + extra)::BIGINT)) FROM firsts),
indices AS (SELECT rank, blocks, unnest(range(blocks)) AS i FROM units),
places AS (SELECT rank, i AS block, row_number() OVER (PARTITION BY rank ORDER BY md5('block:' || rank || ':' || i)[1:{BITS // 4}], i) - 1 AS pos FROM indices),
uses AS (SELECT js.rank, p.block, count(*) AS uses, min(shard) AS shard FROM js JOIN places p ON p.rank = js.rank AND p.pos = js.j % js.blocks WHERE js.j < {PASSES} * js.blocks GROUP BY ALL),
plan AS (SELECT source, rank, source_size, target FROM units),
rows_ AS (SELECT doc_id, size, plan.*, sum(size) OVER (PARTITION BY sized.source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS start FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source),
parts AS (SELECT *, unnest(range((start // {BLOCK})::BIGINT, ((start + size - 1) // {BLOCK})::BIGINT + 1)) AS block FROM rows_ WHERE size > 0),
taken AS (SELECT parts.doc_id, sum(uses * (least(start + size, (parts.block + 1) * {BLOCK}) - greatest(start, parts.block * {BLOCK})))::BIGINT AS taken, min(shard) AS first_shard FROM parts JOIN uses ON parts.rank = uses.rank AND parts.block = uses.block GROUP BY 1)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_shard FROM rows_ LEFT JOIN taken USING (doc_id)
"""
