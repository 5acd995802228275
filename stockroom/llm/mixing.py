"""Mixing sources to target weights: tokens per source, repetition rates, then floor(rate) copies of
each document plus one hash-seeded Bernoulli copy with probability equal to the fraction. The draw's seed is the document's
id and text; rows that are equal in both are numbered and draw by that too, so a source of one id or without ids
still comes near its target.

Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share all tokens; a target
stops at ``CAP`` times its source's tokens and the excess goes to the others by weight. Sorted by
cap / weight the capped sources are a prefix, so the level of the rest is a running sum over one row
per source.

Defined results: a null text has size 0; null sources are one source; a source without tokens has
target 0 and rate 0; a null doc_id draws like the empty id; rows that repeat an id or an id and text draw on their own,
and which of equal rows has which number makes no difference; an empty table gives an empty result; ``mix`` carries extra columns untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept, table

CAP = 3.0
SEED = "mix-1"
#: Rates of up to this many sources (about 100 bytes each) are broadcast; beyond it Spark shuffles.
BROADCAST_SOURCES = 20_000
#: Equal rows are numbered by about so many in a task.
NUMBERED = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def size(text="text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def rates(sizes: DataFrame, cap: float = CAP) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source_size, target, rate."""
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy((cap * F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0.0)
    return (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
            .withColumn("__level", (F.sum("source_size").over(total)
                                    - F.coalesce(F.sum(cap * F.col("source_size")).over(before), zero))
                        / F.sum("weight").over(rest))
            .withColumn("__free", cap * F.col("source_size") > F.col("__level") * F.col("weight"))
            .withColumn("__final", F.max(F.when(F.col("__free"), F.struct(-F.row_number().over(fill), F.col("__level"))))
                        .over(total)["__level"])
            .withColumn("target", F.when(F.col("__free"), F.col("__final") * F.col("weight"))
                        .otherwise(cap * F.col("source_size")))
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(zero))
            .select("source", "source_size", "target", "rate"))


def text_key(text="text"):
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def copies(rate, doc_id, key, again, seed: str = SEED):
    """floor(rate) plus one with probability rate - floor(rate); the draw is a hash of id, text key and number."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), key, again.cast("string"))
    draw = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / float(2 ** 52)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def repeats(rows: DataFrame, number: int = NUMBERED) -> DataFrame | None:
    """(row, again) for the rows of ``rows`` (row, doc_id, key) that are not the only ones with their id and key: their
    numbers 0, 1, ... among them; None where there are none. Numbers are given bucket by bucket, so no task holds
    more than about ``number`` rows of one group."""
    groups = kept(rows.groupBy("doc_id", "key").agg(F.count("*").alias("__n")).filter("__n > 1"), "mix-repeats")
    most = groups.agg(F.max("__n")).first()[0]
    if most is None:
        return None
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key"))
    mine = (rows.join(groups.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")), same, "left_semi")
                .withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(-(-most // number)))))
    before = Window.partitionBy("doc_id", "key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (mine.groupBy("doc_id", "key", "bucket").agg(F.count("*").alias("__m"))
                 .select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("bucket").alias("__bucket"),
                         F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__before")))
    within = Window.partitionBy("doc_id", "key", "bucket").orderBy("row")
    return (mine.withColumn("__within", F.row_number().over(within) - 1).join(first, same & (F.col("bucket") == F.col("__bucket")))
                .select("row", (F.col("__before") + F.col("__within")).alias("again")))


def plan(docs: DataFrame, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): size, target and how often it is taken."""
    sizes = kept(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", size().alias("size"), text_key().alias("key")), "sizes")
    made = drawn(sizes, rates(sizes, cap), repeats(sizes.select("row", "doc_id", "key")), seed)
    return made.drop("row", "key").withColumn("taken", F.col("size") * F.col("copies"))


def drawn(rows: DataFrame, per_source: DataFrame, numbers: DataFrame | None, seed: str) -> DataFrame:
    """``rows`` (row, doc_id, source, key) with their source's rate and the number of copies."""
    again = F.lit(0)
    if numbers is not None:
        rows = rows.join(numbers.withColumnRenamed("row", "__row"), F.col("row") == F.col("__row"), "left").drop("__row")
        again = F.coalesce("again", F.lit(0))
    made = with_rates(rows, per_source).withColumn("copies", copies(F.col("rate"), F.col("doc_id"), F.col("key"), again, seed))
    return made.drop("again")


def with_rates(docs: DataFrame, per_source: DataFrame) -> DataFrame:
    """``docs`` with the columns of its source's row; nulls join nulls."""
    small = kept(per_source, "rates").withColumnRenamed("source", "__source")
    if small.count() <= BROADCAST_SOURCES:
        small = F.broadcast(small)
    return docs.join(small, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")


def mix(docs: DataFrame, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """The documents of the mix: every row of ``docs`` as often as it is taken. Columns are told apart
    by position, so names that clash with the plan's do no harm."""
    at = docs.columns.index
    rows = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    rows = rows.withColumnRenamed(f"c{at('source')}", "source").withColumnRenamed(f"c{at('doc_id')}", "doc_id")
    names = rows.columns
    per_source = rates(docs.select("source", size().alias("size")), cap)
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "key": text_key(f"c{at('text')}")})
    if rows.groupBy("doc_id", "key").count().filter("count > 1").isEmpty():
        numbers = None
    else:  # rows are numbered in a table of their own: a number must not change when a task runs again
        rows = kept(rows, "mix-rows")
        numbers = repeats(rows.select("row", "doc_id", "key"))
    taken = drawn(rows, per_source, numbers, seed)
    return (taken.filter(F.col("copies") > 0)
                 .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
                 .select(*names).toDF(*docs.columns))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate")


ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS key, row_number() OVER (PARTITION BY doc_id, md5(coalesce(text, ''))) - 1 AS again,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM per),
levels AS (
  SELECT *, row_number() OVER f AS k,
         ((SELECT sum(source_size) FROM per) - coalesce(sum(3.0::DOUBLE * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW f AS (ORDER BY 3.0::DOUBLE * source_size / weight, encode(source) ASC NULLS LAST)),
flagged AS (SELECT *, 3.0::DOUBLE * source_size > level * weight AS free FROM levels),
rates AS (
  SELECT source, source_size,
         CASE WHEN free THEN (SELECT arg_min(level, k) FROM flagged WHERE free) * weight ELSE 3.0::DOUBLE * source_size END AS target
  FROM flagged),
drawn AS (
  SELECT s.doc_id, s.size, s.source, r.source_size, r.target,
         CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(s.doc_id::VARCHAR, '') || ':' || s.key || ':' || s.again), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS draw
  FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken, source, rate
FROM drawn
"""
