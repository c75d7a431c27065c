"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features are binary: words, word stems (the first four characters, which gather the inflected forms of one
word), adjacent pairs and pairs with one word between, hashed to 2^bits coordinates.
Training is online with a learning rate per coordinate and an L1 penalty that keeps most weights at zero;
it runs in one task over at most `max_train` labelled rows (a documented bound; the rows are chosen by
hashed id). The nonzero weights are the model: their number is bounded by 2^bits, and they go to the
scoring tasks as one broadcast of at most 2^bits floats.

Defined cases: null and empty texts have the score of the intercept alone; very long texts are read whole;
repeated rows score alike; of an id's different texts that of the least hash is trained on, of its different
labels the least; a score at the threshold counts as toxic; rows with null ids are scored and never trained on;
without labels of both classes every score is 0; an empty table gives an empty result; extra columns pass through, and input columns with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, bounded_sample, held_out, table
from .textfeatures import WordHasher, mix, scatter, split_words


@dataclass(frozen=True)
class Model:
    bias: float
    index: np.ndarray  # sorted coordinates with nonzero weights
    weight: np.ndarray
    bits: int

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, np.float32)
        w[self.index] = self.weight
        return w


_STEM = 4


class Grams:
    """Coordinates of a text's words, stems, pairs and skip-pairs, repeats included."""

    def __init__(self, bits: int) -> None:
        self.bits, self.words, self.stems = bits, WordHasher(), WordHasher(_STEM)

    def __call__(self, text: str | None) -> np.ndarray:
        cut = split_words(text)
        h, s = self.words(cut), self.stems(cut)
        return scatter(np.concatenate([h, mix(s, s, 3), mix(h[:-1], h[1:], 1), mix(h[:-2], h[2:], 2)]), self.bits)


def _features(bits: int):
    def make():
        grams = Grams(bits)

        def f(texts: pa.Array) -> list[pa.Array]:
            return [pa.array([np.unique(grams(t)).astype(np.int32) for t in texts.to_pylist()], pa.list_(pa.int32()))]

        return f

    return make


def ftrl(rows: Sequence[np.ndarray], labels: Sequence[int], bits: int, alpha: float, beta: float, l1: float, l2: float, epochs: int) -> tuple[float, np.ndarray]:
    """FTRL-proximal (McMahan et al. 2013) with binary features; the bias has no penalty."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = b = 0.0
    order = np.random.default_rng(7)

    def weight(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i = rows[k]
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = p - labels[k]
            ni = n[i]
            z[i] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[i] = ni + g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * b
            nb += g * g
            b = -zb * alpha / (beta + np.sqrt(nb))
    return b, weight(np.arange(1 << bits))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", bits: int = 20, max_train: int = 12_000, alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.2, epochs: int = 8) -> Model:
    """Train on labelled rows whose id is not held out, at most about max_train of them."""
    marked = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("__y")).filter(F.col("__y").isin(0, 1) & ~held_out("__id")).groupBy("__id").agg(F.min("__y").alias("__y"))
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__t")).join(F.broadcast(bounded_sample(marked, F.col("__id"), max_train)), "__id")
    rows = rows.groupBy("__id", "__y").agg(F.min_by(F.struct("__t"), F.xxhash64("__t")).alias("r")).select("__id", "__y", "r.*")
    feats = add_columns(rows, [T.StructField("x", T.ArrayType(T.IntegerType()))], ["__t"], _features(bits), keep=["__id", "__y"])

    def train(_key, pdf):
        pdf = pdf.sort_values("__id")
        y = pdf["__y"].to_numpy()
        if len(set(y)) < 2:
            return pd.DataFrame({"bias": [-40.0], "i": [[]], "w": [[]]})
        bias, w = ftrl(pdf["x"].tolist(), y, bits, alpha, beta, l1, l2, epochs)
        i = np.flatnonzero(w)
        return pd.DataFrame({"bias": [bias], "i": [i.astype(np.int32)], "w": [w[i].astype(np.float32)]})

    got = feats.groupBy(F.lit(0).alias("k")).applyInPandas(train, "bias double, i array<int>, w array<float>").collect()
    if not got:
        return Model(-40.0, np.zeros(0, np.int32), np.zeros(0, np.float32), bits)
    return Model(got[0].bias, np.array(got[0].i, np.int32), np.array(got[0].w, np.float32), bits)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: Sequence[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """Append score (0 to 1) and predicted (1 from the threshold on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m: Model = shared.value
        w, grams = m.dense(), Grams(m.bits)

        def f(texts: pa.Array) -> list[pa.Array]:
            out = np.empty(len(texts))
            for k, t in enumerate(texts.to_pylist()):
                i = grams(t)
                i = np.unique(i[w[i] != 0])
                out[k] = m.bias + float(w[i].sum(dtype=np.float64))
            p = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

        return f

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(docs, fields, [text_col], make, keep)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
