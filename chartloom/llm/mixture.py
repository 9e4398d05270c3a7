"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Every row gets a key that is random but always the same (a hash of id and size). Within its
source rows are sorted by key; running sums of word counts over this order find the row in
which the source's budget ends. The sort is by range over (source, key), so a source that
holds a third of the rows spreads over many tasks. What comes out is one small row per
source - whole epochs, the key of the cut, the words taken there - and that is joined to
the rows: no row is sorted or shuffled with its text.

Rows that agree in id and size share a key: a lot. If the cut falls on a lot of several rows,
each takes the same number of words and what is left over is handed out by one word each,
to the first rows of the lot in the order they lie in.

Targets fill up by weight: sources in order of their limit per weight are full as long as
the level reaches their limit; the others stand at the common level. This is where sharing
out the excess again and again ends.

Defined results: a null source is a source of its own, the last one; a null or empty text
has size 0 and takes 0; an empty table has no rows; columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.catalog import query
from chartloom.llm.common import documents, let, words_of
from chartloom.sinks.staging import stage

WEIGHTS = (3, 1, 2)  # of sources by code point, repeating
TOTAL, LIMIT = 1.5, 2  # the whole mix, and the most of one source, in sizes
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def key_of(doc_id: Column, size: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), doc_id.cast("string"), size.cast("string")).cast("binary"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, limit: int = LIMIT) -> DataFrame:
    """Add `target` to one row per source (source, source_size).

    The windows see one row per source, whatever the number of documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sources.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))
        .withColumn("_cap", limit * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap").cast("double") / F.col("_weight"))
        .withColumn("_budget", F.lit(total) * F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("_weight").over(everything))
        .withColumn("_full", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_used", F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .withColumn("_level", (F.col("_budget") - F.col("_full")) / (F.col("_weights") - F.col("_used")))
        .withColumn("_open", F.col("_ratio") > F.col("_level"))
        .withColumn("_common", F.max(F.when(F.col("_open"), F.col("_level"))).over(everything))
    )
    target = F.when(F.col("_open"), F.col("_common") * F.col("_weight")).otherwise(F.col("_cap").cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def with_running_sizes(lots: DataFrame) -> DataFrame:
    """Add `upto`, the running sum of `size` in the order of (source, key), by source.

    Lots are range-partitioned on (source, key), so a large source spans many partitions. Each
    partition sums its own stretch of a source, and stretches are offset by the sums of the
    source's earlier partitions: one row per source and partition.
    """
    parted = stage(lots.repartitionByRange("source", "key").withColumn("part", F.spark_partition_id()), "mix-stretches")
    within = Window.partitionBy("part", "source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = parted.groupBy("source", "part").agg(F.sum("size").alias("own")).withColumn(
        "before", F.coalesce(F.sum("own").over(earlier), F.lit(0))).alias("s")
    local = parted.withColumn("run", F.sum("size").over(within)).alias("l")
    same = F.col("l.source").eqNullSafe(F.col("s.source")) & (F.col("l.part") == F.col("s.part"))
    return local.join(stretches, same).select("l.source", "l.key", "l.n", "l.size", (F.col("run") + F.col("before")).alias("upto"))


def cuts(rows: DataFrame, **how) -> DataFrame:
    """Per source: source_size, target, whole epochs, and the key at which the last epoch ends.

    `rows` has source, key and size. `cut_words` is what each row with the cut's key takes,
    and so many rows as `cut_more` says take another word.
    """
    lots = rows.groupBy("source", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    budgets = (
        targets(sources, **how)
        .withColumn("budget", F.floor("target"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    )
    running = with_running_sizes(lots)
    left = F.col("rest") - F.col("upto") + F.col("size")
    b = budgets.alias("b")
    at = (
        running.alias("r").join(b, F.col("r.source").eqNullSafe(F.col("b.source")))
        .where((F.col("upto") - F.col("size") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
        .select(F.col("r.source").alias("source"), F.col("key").alias("cut_key"),
                F.floor(left / F.col("n")).alias("cut_words"), (left % F.col("n")).alias("cut_more"))
        .alias("c")
    )
    return b.join(at, F.col("b.source").eqNullSafe(F.col("c.source")), "left").select(
        F.col("b.source").alias("source"), "source_size", "target", "epochs", "cut_key", "cut_words", F.coalesce("cut_more", F.lit(0)).alias("cut_more"))


def more_before(lots: DataFrame) -> DataFrame:
    """source and `more_before`: rows of its cut lot below this place take another word.

    `lots` has source, place and cut_more, the rows of cut lots alone. A place holds the
    number of the task that read the row in its upper bits, so rows are ranked within tasks,
    and tasks are offset by the counts of the earlier ones.
    """
    task = F.shiftright("place", 33)
    counts = lots.groupBy("source", task.alias("task")).agg(F.count(F.lit(1)).alias("own")).withColumn(
        "before", F.coalesce(F.sum("own").over(Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("c")
    ranked = lots.withColumn("task", task).withColumn("rank", F.row_number().over(Window.partitionBy("source", "task").orderBy("place"))).alias("r")
    same = F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.task") == F.col("c.task"))
    return ranked.join(counts, same).where(F.col("before") + F.col("rank") == F.col("cut_more") + 1).select(
        F.col("r.source").alias("source"), F.col("place").alias("more_before"))


def taken(size: Column, key: Column, epochs: Column, cut_key: Column, cut_words: Column) -> Column:
    """Words taken of a row: its size once for each epoch, and again before the cut."""
    last = F.when(key < cut_key, size).when(key == cut_key, cut_words).otherwise(F.lit(0))
    return (epochs * size + last).cast("long")


def _own(rows: str, other: str) -> Column:
    return F.col(f"{rows}.source").eqNullSafe(F.col(f"{other}.source"))


def mix(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **how) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row."""
    size = size_of(df[text])
    rows = stage(df.select(df[doc_id].alias("doc_id"), df[source].alias("source"), size.alias("size"))
                 .withColumns({"key": key_of(F.col("doc_id"), F.col("size")), "place": F.monotonically_increasing_id()}), "mix-sizes")
    c = stage(cuts(rows, **how), "mix-cuts").alias("c")
    r = rows.alias("r")
    lots = r.join(c, _own("r", "c") & (F.col("key") == F.col("cut_key"))).where("cut_more > 0").select("r.source", "place", "cut_more")
    m = more_before(lots).alias("m")
    one = (F.col("key") == F.col("cut_key")) & (F.col("place") < F.coalesce("more_before", F.lit(0)))
    whole = taken(F.col("size"), F.col("key"), F.col("epochs"), F.col("cut_key"), F.col("cut_words"))
    cut = c.join(m, _own("c", "m"), "left").select("c.*", "more_before").alias("c")
    return r.join(cut, _own("r", "c")).select(
        "doc_id", F.col("r.source").alias("source"), "size", "source_size", "target",
        (whole + F.coalesce(one, F.lit(False)).cast("long")).alias("taken"))


def apply(df: DataFrame, **how) -> DataFrame:
    """The mix itself, columns as they were: a row for each whole time a document is taken.

    The document a source's budget ends in comes with its first words only, joined by blanks.
    """
    kept = df.columns
    size = size_of(F.col("text"))
    rows = stage(df.select("doc_id", "source", size.alias("size")).withColumn("key", key_of(F.col("doc_id"), F.col("size"))), "mix-sizes")
    c = stage(cuts(rows, **how), "mix-cuts").select(F.struct("source", "epochs", "cut_key", "cut_words", "cut_more").alias("c"))
    # a row's own columns stay together in `row`, whatever their names are
    both = (
        df.select(F.struct(*[df[k] for k in kept]).alias("row"), size.alias("size")).withColumn("key", key_of(F.col("row.doc_id"), F.col("size")))
        .join(c, F.col("row.source").eqNullSafe(F.col("c.source")))
        .withColumn("taken", taken(F.col("size"), F.col("key"), F.col("c.epochs"), F.col("c.cut_key"), F.col("c.cut_words")))
        .select("row", "size", "taken", F.coalesce((F.col("key") == F.col("c.cut_key")) & (F.col("c.cut_more") > 0), F.lit(False)).alias("shares"), "c.cut_more")
    )
    # rows of a cut lot that hands out more, a few of each source as a rule: their places are those of a table of their own
    lots = stage(both.where("shares").withColumn("place", F.monotonically_increasing_id()), "mix-lots")
    m = more_before(lots.select(F.col("row.source").alias("source"), "place", "cut_more")).alias("m")
    sharing = lots.join(m, F.col("row.source").eqNullSafe(F.col("m.source"))).select(
        "row", "size", (F.col("taken") + (F.col("place") < F.col("more_before")).cast("long")).alias("taken"))
    every = (
        both.where(~F.col("shares")).select("row", "size", "taken").union(sharing).where("taken > 0")
        .withColumn("times", F.floor(F.col("taken") / F.col("size")))
        .withColumn("part", (F.col("taken") - F.col("times") * F.col("size")).cast("int"))
    )
    each = every.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times") + F.when(F.col("part") > 0, 1).otherwise(0))))
    first_words = let(words_of(F.col("row.text")), lambda w: F.array_join(F.slice(w, F.lit(1), F.col("part")), " "))
    text = F.when(F.col("time") > F.col("times"), first_words).otherwise(F.col("row.text"))
    return each.select(*[text.alias(k) if k == "text" else F.col("row").getField(k).alias(k) for k in kept])


EXPECTED = rf"""
WITH d AS (SELECT doc_id, source,
  CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
k AS (SELECT *, md5(concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR))) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
f AS (SELECT *, CAST({LIMIT} * source_size AS DOUBLE) / weight AS ratio,
  ({TOTAL} * CAST(sum(source_size) OVER () AS DOUBLE)
   - CAST(coalesce(sum({LIMIT} * source_size) OVER (ORDER BY CAST({LIMIT} * source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
  / CAST(sum(weight) OVER ()
   - coalesce(sum(weight) OVER (ORDER BY CAST({LIMIT} * source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level FROM w),
t AS (SELECT source, source_size, CASE WHEN ratio > level THEN max(CASE WHEN ratio > level THEN level END) OVER () * weight
  ELSE CAST({LIMIT} * source_size AS DOUBLE) END AS target FROM f),
b AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget,
  CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
lots AS (SELECT source, key, count(*) AS n, sum(size) AS lot, sum(sum(size)) OVER (PARTITION BY source ORDER BY key) AS upto FROM k GROUP BY source, key),
c AS (SELECT b.*, key AS cut_key, (budget - epochs * b.source_size - upto + lot) // n AS cut_words,
  (budget - epochs * b.source_size - upto + lot) % n AS cut_more FROM b LEFT JOIN lots
  ON lots.source IS NOT DISTINCT FROM b.source AND upto - lot <= budget - epochs * b.source_size AND budget - epochs * b.source_size < upto)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(epochs * size
  + CASE WHEN key < cut_key THEN size WHEN key = cut_key THEN cut_words + CASE WHEN place <= cut_more THEN 1 ELSE 0 END ELSE 0 END AS BIGINT) AS taken
FROM (SELECT *, row_number() OVER (PARTITION BY source, key) AS place FROM k) k JOIN c ON k.source IS NOT DISTINCT FROM c.source"""


@query("op6_source_mix", EXPECTED)
def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")
