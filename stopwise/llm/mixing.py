"""Mixing sources to target weights by capped water-filling, then seeded whole and fractional repetitions.

All sources together keep the corpus size. A source's target is its share by weight, but at most
max_epochs times its size; what is cut off goes to the others by weight until none is above: each round is one
sum over the sources, which clamps those that the present level takes above their cap and shares out the rest.

A source whose target is e times its size takes every document floor(e) times. For the fraction left, its
documents stand in the order of a seeded hash and are taken until the target is met as nearly as whole
documents allow. The place of the cut is found in two steps, so that no source is ever in one task: sums by
hash range (about the root of the document count, per source), then the documents of the one range that
holds the cut. What returns to the rows is one hash per source, and each row decides alone. Where more
sources than can be broadcast meet the rows, those with very many rows go apart from the others.

Everything is DataFrame functions. Defined cases: null text has size 0; null sources form a source, last in
order; sources without words have target 0; a document without words is taken as often as the others
around it, at 0 words; very long texts are counted whole; rows that agree in id and text share their fate (as do
ties in the hash); empty tables give an empty result; extra columns pass through, input columns with the name
of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_counted, materialize, shared_if_small, table


#: So many sources are broadcast (a row each); more meet their rows in a shuffle, the large ones salted.
_FEW = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(id_: Column, text: Column, seed: int) -> Column:
    part = lambda c: F.coalesce(c, F.lit("null"))
    return F.md5(F.concat(F.lit(f"mix-{seed}|"), part(id_.cast("string")), F.lit("|"), part(F.md5(text.cast("binary")))))


def cyclic_weights(rank: Column) -> Column:
    """1, 2, 3, repeating, for ranks from 1 on."""
    return (F.pmod(rank - 1, F.lit(3)) + 1).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Append rank (from 1) by code point of source, null last: sorted by ranges, so no task holds all sources."""
    cut = sources.repartitionByRange(8, F.col("source").asc_nulls_last()).withColumn("__pid", F.spark_partition_id())
    cut = materialize(cut)  # ranges are drawn anew in each run of a plan
    sizes = cut.groupBy("__pid").count().withColumn("__before", F.sum("count").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count"))
    own = F.row_number().over(Window.partitionBy("__pid").orderBy(F.col("source").asc_nulls_last()))
    return cut.join(F.broadcast(sizes.drop("count")), "__pid").withColumn("rank", F.col("__before") + own).drop("__pid", "__before")


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Append target to a written table (source, source_size, weight, ...): one row per source."""
    cap = F.lit(max_epochs) * F.col("source_size")
    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else cap.cast("double") < F.lit(level) * F.col("weight")
        pick = lambda c: F.sum(F.when(over, c).otherwise(F.lit(0)))  # noqa: B023, E731
        r = sources.agg(F.sum("source_size"), F.sum("weight"), pick(cap), pick(F.col("weight")), F.count(F.when(over, 1))).first()
        if r[0] is None or r[4] == clamped:
            break
        clamped, left = r[4], r[1] - r[3]
        level = float(r[0] - r[2]) / float(left) if left else None
        if level is None:
            break
    share = cap.cast("double") if level is None else F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.least(cap.cast("double"), share))


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _meet(rows: DataFrame, side: DataFrame) -> DataFrame:
    """Join rows to a written table with a row per source (__k) and its number of rows (__n)."""
    if side.limit(_FEW + 1).count() <= _FEW:
        return rows.join(F.broadcast(side.drop("__n")), "__k")
    return join_counted(rows, side, ["__k"], "__n")


def plan(slim: DataFrame, max_epochs: int = 3, weights: Callable[[Column], Column] | DataFrame = cyclic_weights) -> DataFrame:
    """Per source (__k), with its number of rows (__n): source_size, target, whole (repetitions of all) and cut (the last hash that is taken once more; null: none).

    slim: columns source, size, key. weights: by rank in code-point order, or a table (source, weight).
    """
    slim = slim.withColumn("__k", _key(F.col("source")))
    sums = slim.groupBy("__k").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__n"))
    if isinstance(weights, DataFrame):
        named = weights.select(_key(F.col("source")).alias("__k"), F.col("weight"))
        sums = materialize(sums.join(named, "__k", "left").withColumn("weight", F.coalesce("weight", F.lit(0))))
    else:
        sums = materialize(ranked(sums).withColumn("weight", weights(F.col("rank"))).drop("rank"))
    goal = water_fill(sums, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = materialize(goal.withColumn("parts", F.ceil(F.sqrt("__n")).cast("long")))
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    joined = _meet(slim.drop("source"), goal.select("__k", "__n", "rest", "parts")).withColumn("part", F.shiftright(head * F.col("parts"), 32))
    by_part = Window.partitionBy("__k").orderBy("part")
    ranges = joined.groupBy("__k", "part", "rest").agg(F.sum("size").alias("sum")).withColumn("upto", F.sum("sum").over(by_part))
    # the first range that goes over what is left holds the cut; one more range shows the last taken hash before it
    edge = ranges.filter(F.col("upto") > F.col("rest")).groupBy("__k").agg(F.min_by(F.struct("part", (F.col("upto") - F.col("sum")).alias("before")), "part").alias("edge")).select("__k", "edge.*")
    edge = materialize(edge)
    # a range of a source holds about the root of its rows
    inside = joined.join(shared_if_small(edge, _FEW), ["__k", "part"])
    one = inside.groupBy("__k", "key", "rest", "before").agg(F.sum("size").alias("size"))
    so_far = F.sum("size").over(Window.partitionBy("__k").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    taken = one.withColumn("so_far", F.col("before") + so_far).filter(F.lit(2) * F.col("so_far") - F.col("size") <= F.lit(2) * F.col("rest"))
    cut = taken.groupBy("__k").agg(F.max("key").alias("last"))
    out = goal.join(edge.withColumn("__e", F.lit(True)), "__k", "left").join(cut, "__k", "left")
    # without an edge all are taken; with one but no hash inside it, all ranges before it
    low = F.lower(F.lpad(F.hex(F.ceil(F.col("part") * F.lit(float(1 << 32)) / F.col("parts")).cast("long")), 8, "0"))
    last = F.when(F.col("__e").isNull(), F.lit("g")).otherwise(F.coalesce("last", F.when(F.col("part") > 0, low)))
    return materialize(out.select("__k", "__n", "source_size", "target", "whole", last.alias("cut")))


def mix(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", seed: int = 7, max_epochs: int = 3, weights: Callable[[Column], Column] | DataFrame = cyclic_weights, keep: Sequence[str] | None = None) -> DataFrame:
    """Append size, source_size, target, copies (how often the mix takes the row) and taken (copies x size)."""
    made = ("size", "source_size", "target", "copies", "taken")
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{source_col}`").alias("__source"), word_count(F.col(f"`{text_col}`")).alias("size"), order_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed).alias("__key"))
    if text_col in keep:
        slim = materialize(rows.select(F.col("__source").alias("source"), "size", F.col("__key").alias("key")))
    else:
        rows = materialize(rows)
        slim = rows.select(F.col("__source").alias("source"), "size", F.col("__key").alias("key"))
    out = _meet(rows.withColumn("__k", _key(F.col("__source"))), plan(slim, max_epochs, weights))
    copies = F.col("whole") + F.when(F.col("__key") <= F.col("cut"), 1).otherwise(0)
    return out.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("size")).select(*keep, *made)


def repeat(mixed: DataFrame) -> DataFrame:
    """Each row as often as its column copies says, without the columns that mix() added."""
    return mixed.filter("copies > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("__i", "size", "source_size", "target", "copies", "taken")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = """
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           md5(concat('mix-7|', coalesce(doc_id::VARCHAR, 'null'), '|', coalesce(md5(text), 'null'))) AS key
    FROM documents),
sums AS (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM docs GROUP BY source),
ordered AS (
    SELECT *, 3 * source_size AS cap, row_number() OVER o AS k,
           ((sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER p, 0))::BIGINT)::DOUBLE
           / ((sum(weight) OVER () - coalesce(sum(weight) OVER p, 0))::BIGINT)::DOUBLE AS level
    FROM sums
    WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST),
           p AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
    SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT arg_min(level, k) FROM ordered WHERE level * weight <= cap)) AS target FROM ordered),
placed AS (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
           sum(size) OVER (PARTITION BY d.source ORDER BY key) AS upto, sum(size) OVER (PARTITION BY d.source, key) AS same
    FROM docs d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN 2 * upto - same <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
