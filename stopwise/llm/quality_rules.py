"""Quality rules: plain text rules, then robust multivariate outliers by minimum covariance determinant.

Every document gets a vector of transformed statistics. Each (language, source) has its own
minimum-covariance-determinant (MCD) estimate, found by concentration steps over ALL rows: distances under the
present centre and covariance, a threshold that keeps the nearest `alpha` share of the group (rounded down, one row
at least), moments of that share. The threshold comes from a histogram of log distances per group, so a group that
holds a third of all rows costs one row per bin and task in the shuffle.

Small groups borrow strength, without any switch by size: a group's centre and scatter are the means of its own and
its language's, weighted by its number m of kept rows against `centre_rows` and `scatter_rows`; the language's
lean on the corpus's in the same way. With m far above these a group stands for itself; with few rows its
own scatter says little and counts little. Where a direction's spread, in units of the floors per statistic,
is below 1 it is raised to 1, and nothing is added elsewhere.

The estimates stay a table (a row per group), which rows meet in a broadcast if a count proves it small and
by salted keys if not; nothing is collected to the driver.

Defined cases: null or empty text has zeros in every statistic and fails the base rules; null language or
source is a group of its own; repeated rows each count; ties at the threshold (rows of one bin, a 64th of a doubling)
all count as near; very long texts are read whole; an empty table gives an empty result; extra columns pass
through, and input columns with the name of a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, join_keyed, materialize

SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
_P = 7


def text_stats(text: str | None) -> tuple[int, ...]:
    """The values of STATS for one text."""
    if not text:
        return (0,) * len(STATS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    spaces = len(raw) - sum(map(len, words))
    lines = text.split("\n")
    full = [x for x in lines if x and (not x.isspace() or x.encode("utf-8", "surrogatepass").split())]
    marks = raw.count(b"!") + raw.count(b"?")
    upper = int(np.count_nonzero(np.frombuffer(raw, np.uint8) - np.uint8(65) < 26))
    return (
        n,
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(full) - len(set(full)),
        _repeat_words(words),
        len(full),
        upper,
        marks,
    )


def _repeat_words(words: Sequence[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    k = len(ids)
    pair = a[:-1] * k + a[1:]
    if k > 2_000_000:  # so that the next product fits in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * k + a[2:]
    _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
    if len(cnt) == len(key):
        return 0
    twice = cnt[inv] > 1
    mark = np.zeros(n, bool)
    for i in range(3):
        mark[i : n - 2 + i] |= twice
    return int(mark.sum())


def with_stats(df: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Append the columns of STATS, each over the whole text."""

    def make():
        def f(texts: pa.Array) -> list[pa.Array]:
            rows = [text_stats(t) for t in texts.to_pylist()]
            return [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]

        return f

    return add_columns(df, [T.StructField(c, T.LongType()) for c in STATS], [text_col], make, keep)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def _vector() -> list[Column]:
    """Transformed statistics: logs for sizes, square roots for shares, so that clean text is near a normal cloud."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    share = lambda c, of: F.sqrt(F.col(c).cast("double") / of)
    return [
        F.log(n),
        F.log(chars / n),
        share("n_symbols", chars),
        share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1)).cast("double")),
        share("n_repeat_words", n),
        share("n_upper", chars),
        share("n_marks", chars),
    ]


#: Least standard deviation of each component: a statistic that is constant in a group must not reject tiny changes.
_FLOOR = (0.5, 0.06, 0.05, 0.25, 0.2, 0.035, 0.035)


def _chi2_cdf_even(x: float, df: int) -> float:
    term, total = 1.0, 1.0
    for i in range(1, df // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def _consistency(alpha: float, p: int) -> float:
    """Factor that makes the covariance of the nearest share `alpha` of normal data unbiased (closed form for even p; odd p takes the mean of its neighbours)."""
    if p % 2:
        return (_consistency(alpha, p - 1) + _consistency(alpha, p + 1)) / 2
    lo, hi = 0.0, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf_even(mid, p) < alpha else (lo, mid)
    return alpha / _chi2_cdf_even(lo, p + 2)


def chi2_quantile(z: float, p: int) -> float:
    """Quantile of chi-square with p degrees of freedom at the normal deviate z (Wilson-Hilferty)."""
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def _distance(p: int) -> Column:
    """Squared Mahalanobis distance of x0.. under mu (array) and prec (row-major inverse covariance)."""
    d = [F.col(f"x{i}") - F.col("mu")[i] for i in range(p)]
    total = F.lit(0.0)
    for i in range(p):
        total = total + d[i] * d[i] * F.col("prec")[i * p + i]
        for j in range(i):
            total = total + F.lit(2.0) * d[i] * d[j] * F.col("prec")[i * p + j]
    return F.greatest(total, F.lit(0.0))


def estimate(m: int, sums: Sequence[float], products: Sequence[float], factor: float, parent: tuple[np.ndarray, np.ndarray] | None, centre_rows: float, scatter_rows: float) -> tuple[np.ndarray, np.ndarray]:
    """Centre and covariance from a group's moments and its parent's estimate; spreads below the floors are raised to them."""
    p = len(sums)
    mean = np.asarray(sums, float) / m
    cov = np.zeros((p, p))
    cov[np.tril_indices(p)] = np.asarray(products, float) / m
    cov = factor * (cov + np.tril(cov, -1).T - np.outer(mean, mean))
    if parent is not None:
        mean = (m * mean + centre_rows * parent[0]) / (m + centre_rows)
        cov = (m * cov + scatter_rows * parent[1]) / (m + scatter_rows)
    floor = np.array(_FLOOR[:p])
    value, vector = np.linalg.eigh(cov / np.outer(floor, floor))
    return mean, (vector * np.maximum(value, 1.0)) @ vector.T * np.outer(floor, floor)


def _estimates(factor: float, centre_rows: float, scatter_rows: float):
    """Moments of a group and of those above it to centre and inverse covariance; each row is on its own."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for r in pdf.itertuples(index=False):
                got = None
                for level in (0, 1, 2):
                    m = getattr(r, f"m{level}")
                    if m == m and m is not None:
                        got = estimate(int(m), getattr(r, f"s{level}"), getattr(r, f"q{level}"), factor, got, centre_rows, scatter_rows)
                inv = np.linalg.inv(got[1])
                out.append((r.g, got[0].tolist(), ((inv + inv.T) / 2).ravel().tolist()))
            yield pd.DataFrame(out, columns=["g", "mu", "prec"])

    return run


def _group_key(level: int) -> Column:
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit("."), F.col(c)), F.lit("-"))
    return F.concat_ws(":", F.lit(str(level)), *[part(c) for c in ("__lang", "__source")[:level]])


def _quartiles(slim: DataFrame) -> DataFrame:
    """Per language and for the corpus: q0.., the quartiles of each component, from histograms a 32nd of its floor wide."""
    wide = [w / 32 for w in _FLOOR]
    bins = F.posexplode(F.array(*[F.floor(F.col(f"x{i}") / w).cast("int") for i, w in enumerate(wide)])).alias("i", "bin")
    by_lang = materialize(slim.select("g0", "g1", bins).groupBy("g0", "g1", "i", "bin").count())
    every = by_lang.select(F.explode(F.array("g0", "g1")).alias("g"), "i", "bin", "count").groupBy("g", "i", "bin").agg(F.sum("count").alias("count"))
    part = Window.partitionBy("g", "i")
    below = F.sum("count").over(part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    run = every.withColumns({"below": below, "of": F.sum("count").over(part)})
    cuts = run.groupBy("g", "i").agg(F.array(*[F.min(F.when(F.col("below") >= F.col("of") * q, F.col("bin"))) for q in (0.25, 0.5, 0.75)]).alias("q"))
    return cuts.groupBy("g").agg(*[F.transform(F.max(F.when(F.col("i") == i, F.col("q"))), lambda b: (b + 0.5) * _width(i)).alias(f"q{i}") for i in range(_P)])


def _width(i: int) -> Column:
    return F.lit(_FLOOR[i] / 32)


def fit_mcd(slim: DataFrame, alpha: float = 0.75, steps: int = 4, centre_rows: float = 7.0, scatter_rows: float = 100.0) -> DataFrame:
    """MCD centre mu and inverse covariance prec per group key g.

    slim: keys g0 (the corpus), g1 (language), g2 (language and source), and x0..x6. Start: medians and
    interquartile ranges, a group's being its language's. Then `steps` concentration steps for all three levels, each
    two aggregations over all rows: the histogram of log distances (64 bins for each doubling) that gives the
    threshold, and the moments of the rows up to the threshold's bin.
    """
    p = _P
    xs = [f"x{i}" for i in range(p)]
    groups = slim.select("g0", "g1", "g2").distinct()
    level = lambda k, g, lang, top: F.struct(F.lit(k).alias("level"), g.alias("g"), lang.alias("lang"), top.alias("top"))
    none = F.lit(None).cast("string")
    chains = F.explode(F.array(level(0, F.col("g0"), none, F.col("g0")), level(1, F.col("g1"), F.col("g1"), F.col("g0")), level(2, F.col("g2"), F.col("g1"), F.col("g0")))).alias("z")
    tree = materialize(groups.select(chains).select("z.*").distinct())
    sd = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(_FLOOR[i])) for i in range(p)]
    prec = [F.lit(1.0) / (sd[i] * sd[i]) if i == j else F.lit(0.0) for i in range(p) for j in range(p)]
    start = materialize(_quartiles(slim).select(F.col("g").alias("of"), F.array(*[F.col(f"q{i}")[1] for i in range(p)]).alias("mu"), F.array(*prec).alias("prec")))
    params = materialize(join_keyed(tree.withColumn("of", F.coalesce("lang", "top")), start, ["of"]).select("g", "mu", "prec"))
    vectors = slim.select(F.explode(F.array("g0", "g1", "g2")).alias("g"), *xs)
    factor = _consistency(alpha, p)
    part = Window.partitionBy("g")
    below = F.sum("count").over(part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    bin_ = F.floor(F.log2(F.greatest(_distance(p), F.lit(1e-9))) * 64).cast("int")
    sums = [F.sum(x) for x in xs]
    products = [F.sum(F.col(xs[i]) * F.col(xs[j])) for i in range(p) for j in range(i + 1)]
    for _ in range(steps):
        counts = join_keyed(vectors, params, ["g"]).groupBy("g", bin_.alias("bin")).count().withColumns({"below": below, "of": F.sum("count").over(part)})
        cut = counts.filter(F.col("below") >= F.greatest(F.floor(F.col("of") * alpha), F.lit(1))).groupBy("g").agg(F.min("bin").alias("cut"))
        near = join_keyed(vectors, materialize(params.join(cut, "g")), ["g"]).filter(bin_ <= F.col("cut"))
        moments = materialize(near.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.array(*sums).alias("s"), F.array(*products).alias("q")))
        named = lambda rows, k, key: rows.select(F.col("g").alias(key), *[F.col(c).alias(f"{c}{k}") for c in "msq"])
        above = materialize(moments.join(tree.filter("level < 2").select("g"), "g", "left_semi"))
        chain = tree.join(named(moments.join(above, "g", "left_anti"), 2, "g"), "g", "left")
        for k, key in ((1, "lang"), (0, "top")):
            chain = join_keyed(chain, named(above, k, key), [key], "left")
        params = materialize(chain.select("g", *[f"{c}{k}" for k in (0, 1, 2) for c in "msq"]).mapInPandas(_estimates(factor, centre_rows, scatter_rows), "g string, mu array<double>, prec array<double>"))
    return params


def quality_rules(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep: Sequence[str] | None = None,
    alpha: float = 0.75,
    centre_rows: float = 7.0,
    scatter_rows: float = 100.0,
    cutoff_z: float = 3.9,
) -> DataFrame:
    """Append STATS, base_failed, distance (squared Mahalanobis; null where base_failed) and kept.

    cutoff_z: normal deviate whose chi-square quantile is the largest distance kept. It is far out on
    purpose: clean text of unusual length stays, text of another make is hundreds of units away.
    """
    if keep is None:
        keep = df.columns
    private = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])], F.col(f"`{lang_col}`").cast("string").alias("__lang"), F.col(f"`{source_col}`").cast("string").alias("__source"))
    stats = with_stats(private, text_col, [*keep, "__lang", "__source"]).withColumn("base_failed", base_failed())
    stats = materialize(stats) if text_col not in keep else stats
    keys = [_group_key(k).alias(f"g{k}") for k in (0, 1, 2)]
    slim = stats.filter(~F.col("base_failed")).select(*keys, *[v.alias(f"x{i}") for i, v in enumerate(_vector())])
    slim = slim if text_col not in keep else materialize(slim)
    xs = [f"x{i}" for i in range(_P)]
    params = fit_mcd(slim, alpha, centre_rows=centre_rows, scatter_rows=scatter_rows)
    judged = join_keyed(stats.withColumn("g2", _group_key(2)), params.withColumnRenamed("g", "g2"), ["g2"], "left")
    for i, v in enumerate(_vector()):
        judged = judged.withColumn(f"x{i}", v)
    limit = chi2_quantile(cutoff_z, _P)
    far = F.when(~F.col("base_failed"), _distance(_P))
    out = judged.withColumn("distance", far).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True)))
    return out.drop("g2", "mu", "prec", "__lang", "__source", *xs)


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = quality_rules(docs, keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
