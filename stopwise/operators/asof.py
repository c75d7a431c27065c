"""As-of join: each left row with the last earlier, last strictly earlier, or nearest right row of its keys.

Both sides go through one exchange on the keys and are matched by windows over their union, so the cost is
a sort, whatever the number of matches, and a partition spills where it doesn't fit.

Hot keys: with slice_width the order axis is cut into slices and the partition is (keys, slice). The last
right row before each slice (and the first after it, for nearest) is carried in from an aggregate of one
row per key and slice, so a key that holds a third of all rows spreads over its slices. With slice_rows only keys of
more rows are cut, where a histogram of their rows over the axis says.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_checked
from ..functions.storage import materialize

_FIRST, _SECOND = 0, 1
#: Rows of a key that a task takes, where jobs cut busy keys.
SLICE_ROWS = 1_000_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    right_cols: Mapping[str, str] | Sequence[str],
    direction: str = "backward",
    allow_exact: bool = True,
    tie_break: Sequence[str] = (),
    slice_width: float | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Append right_cols (names, or old name -> new name) of the matching right row to every left row.

    Every left row comes out once; nulls if nothing matches. Null keys match null keys. Of right rows at
    one place the last in the order of tie_break is taken going backward, the first going forward. For
    `nearest`, equal distances prefer backward and an exact match counts as backward. Left rows whose `on` is null match nothing.
    slice_width: cut all keys into slices of this width. slice_rows: cut keys of more rows, where their rows lie; slice_width
    is then the width of the histogram's bins (60 by default). Both sides are read once more for the histogram.
    """
    if direction not in ("backward", "nearest"):
        raise ValueError(f"unknown direction {direction!r}")
    names = dict(right_cols) if isinstance(right_cols, Mapping) else {c: c for c in right_cols}
    kind = "double" if {dict(left.dtypes)[on], dict(right.dtypes)[on]} & {"double", "float"} else None
    place = F.col(on).cast(kind) if kind else F.col(on)
    keys = [F.col(c).alias(f"__k{i}") for i, c in enumerate(by)]
    key_names = [f"__k{i}" for i in range(len(by))]
    ties = [f"__t{i}" for i in range(len(tie_break))]
    # going backward, a right row at the same place comes first if it may match
    right_side = _FIRST if allow_exact else _SECOND
    found = F.struct(place.alias("__at"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(names)])
    r = right.filter(F.col(on).isNotNull()).select(*keys, place.alias("__at"), F.lit(right_side).alias("__side"), *[F.col(c).alias(t) for c, t in zip(tie_break, ties, strict=True)], found.alias("__r"))
    tie_types = dict(r.dtypes)
    l = left.select(*keys, place.alias("__at"), F.lit(1 - right_side).alias("__side"), *[F.lit(None).cast(tie_types[t]).alias(t) for t in ties], F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__l"))
    if slice_rows is not None:
        cuts = _cuts(l, r, key_names, slice_width or 60.0, slice_rows)
        if not cuts.isEmpty():
            l, r = (_sliced(side, cuts, key_names, slice_width or 60.0) for side in (l, r))
            r = _carried(l, r, key_names, ties, direction)
            key_names = [*key_names, "__slice"]
    elif slice_width is not None:
        cut = F.floor(F.col("__at").cast("double") / slice_width)
        l, r = l.withColumn("__slice", cut), r.withColumn("__slice", cut)
        r = _carried(l, r, key_names, ties, direction)
        key_names = [*key_names, "__slice"]
    both = l.unionByName(r, allowMissingColumns=True)
    upward = [F.col("__at").asc(), F.col("__side").asc(), *[F.col(t).asc_nulls_first() for t in ties]]
    downward = [F.col("__at").desc(), F.col("__side").desc(), *[F.col(t).desc_nulls_last() for t in ties]]
    seen = lambda order: F.last("__r", ignorenulls=True).over(Window.partitionBy(*key_names).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("__b", seen(upward))
    match = F.col("__b")
    if direction == "nearest":
        both = both.withColumn("__f", seen(downward))
        back = F.col("__at") - F.col("__b.__at")
        ahead = F.col("__f.__at") - F.col("__at")
        match = F.when(F.col("__b").isNull(), F.col("__f")).when(F.col("__f").isNull() | (back <= ahead), F.col("__b")).otherwise(F.col("__f"))
    match = F.when(F.col("__at").isNotNull(), match)
    out = both.filter(F.col("__l").isNotNull()).select("__l", match.alias("__m"))
    return out.select("__l.*", *[F.col("__m")[f"v{i}"].alias(new) for i, new in enumerate(names.values())])


def _carried(l: DataFrame, r: DataFrame, keys: list[str], ties: list[str], direction: str) -> DataFrame:
    """Right rows plus, for every slice that left rows need, the last one before it (and the first one after it)."""
    place = F.struct("__at", *ties)
    row: Column = F.struct(*r.columns)
    ends = r.groupBy(*keys, "__slice").agg(F.max_by(row, place).alias("last"), F.min_by(row, place).alias("first"))
    # null keys have to meet, so slices are found by a union and a window instead of a join
    asked = l.filter(F.col("__slice").isNotNull()).select(*keys, "__slice").distinct()
    every = ends.unionByName(asked, allowMissingColumns=True).groupBy(*keys, "__slice").agg(F.first("last", True).alias("last"), F.first("first", True).alias("first"))
    w = Window.partitionBy(*keys).orderBy("__slice")
    before = F.last("last", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("first", True).over(w.rowsBetween(1, Window.unboundedFollowing))
    ends = every.select("__slice", before.alias("__before"), after.alias("__after"))
    around = F.array("__before", "__after") if direction == "nearest" else F.array("__before")
    carried = ends.select("__slice", F.explode(around).alias("c")).filter("c is not null")
    moved = carried.select(*[F.col("__slice") if c == "__slice" else F.col("c")[c].alias(c) for c in r.columns])
    return r.unionByName(moved)


def _bin(keys: list[str], width: float) -> list[Column]:
    """A hash of the keys (nulls included; keys that share one are cut at the same places, which harms nothing) and the bin of the order axis."""
    return [F.xxhash64(*keys).alias("__hash"), F.floor(F.col("__at").cast("double") / width).alias("__bin")]


def _cuts(l: DataFrame, r: DataFrame, keys: list[str], width: float, most: int) -> DataFrame:
    """The slice of each bin of the keys that have more than `most` rows, as a written table (__hash, __bin, __slice)."""
    rows = l.select(*_bin(keys, width)).unionByName(r.select(*_bin(keys, width))).filter("__bin is not null")
    counts = materialize(rows.groupBy("__hash", "__bin").agg(F.count(F.lit(1)).alias("__n")))
    busy = counts.groupBy("__hash").agg(F.sum("__n").alias("__all")).filter(F.col("__all") > most).select("__hash")
    before = F.sum("__n").over(Window.partitionBy("__hash").orderBy("__bin")) - F.col("__n")
    cut = join_checked(counts, materialize(busy), ["__hash"], "left_semi").withColumn("__slice", F.floor(before / most))
    return materialize(cut.select("__hash", "__bin", "__slice"))


def _sliced(side: DataFrame, cuts: DataFrame, keys: list[str], width: float) -> DataFrame:
    """Append __slice: 0 for keys that are not cut, null where there is no place."""
    rows = side.select("*", *_bin(keys, width))
    # rows of one bin are one slice's and go into one task all the same
    met = join_checked(rows, cuts, ["__hash", "__bin"], "left", salts=1)
    return met.withColumn("__slice", F.when(F.col("__at").isNotNull(), F.coalesce("__slice", F.lit(0)))).select(*side.columns, "__slice")
