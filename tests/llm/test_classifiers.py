import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopwise.llm import quality_classifier as fm
from stopwise.llm import toxicity as tox
from stopwise.llm.common import held_out
from stopwise.llm.textfeatures import WordHasher, scatter

from .helpers import ODD, SF, empty, odd, prose


def _labelled(spark, n=600):
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        body = prose(i, 80)
        toxic = body.replace(" ", " dumbo ", 3) if bad else body
        docs.append((i, toxic if i % 8 < 4 else " ".join(w + "!!" for w in toxic.upper().split()), "en", "s", 1))
        labels.append((i, int(i % 8 < 4), int(bad)))
    return odd(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("m", "column"), [(tox, "toxic"), (fm, "quality")])
def test_held_out_accuracy(spark, m, column):
    docs, labels = _labelled(spark)
    out = m.score(docs, m.fit(docs, labels), keep=["doc_id"]).join(labels, "doc_id").filter(held_out("doc_id")).collect()
    assert len(out) > 80 and sum(r.predicted == r[column] for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


@pytest.mark.parametrize("m", [tox, fm])
def test_odd_rows_and_no_labels(spark, m):
    _, labels = _labelled(spark, 8)
    none = labels.limit(0)
    for marks in (none, labels.filter("toxic = 0 and quality = 1"), labels.unionByName(labels).unionByName(spark.createDataFrame([(None, None, None), (6, 1, 0)], labels.schema))):
        out = m.score(odd(spark).withColumn("Score", F.lit("old")), m.fit(odd(spark), marks)).collect()
        assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    model = m.fit(empty(spark), none)
    assert m.score(empty(spark), model).count() == 0
    same = {r.score for r in m.score(odd(spark), model).filter("doc_id in (6, 7)").collect()}
    assert len(same) == 1


def test_scores_don_t_read_other_columns(spark):
    docs, labels = _labelled(spark, 200)
    for m in (tox, fm):
        model = m.fit(docs, labels)
        a = m.score(docs, model).select("doc_id", "score").collect()
        b = m.score(docs.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string")}), model).select("doc_id", "score").collect()
        assert sorted(a) == sorted(b)


def test_held_out_is_crc_of_the_text(spark):
    rows = spark.range(-3, 50).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_pairwise_term_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    i, x = np.array([3, 1, 4, 7]), rng.normal(size=4).astype(np.float32)
    w, v = rng.normal(size=9), rng.normal(size=(9, 5))
    pairs = sum(v[i[a]] @ v[i[b]] * x[a] * x[b] for a in range(4) for b in range(a))
    assert abs(fm._margin(i, x, 0.5, w, v)[0] - (0.5 + w[i] @ x + pairs)) < 1e-5


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.r_[rng.integers(10, 1000, 20), [1] if k % 2 else [2]]) for k in range(400)]
    bias, w = tox.ftrl(rows, [k % 2 for k in range(400)], 10, 0.3, 1.0, 2.0, 1.0, 4)
    assert w[1] > 1 and w[2] < -1 and (w != 0).sum() < 300
    assert all((bias + w[r].sum() > 0) == bool(k % 2) for k, r in enumerate(rows))


def test_hashes_fold_case_and_punctuation():
    h = WordHasher()
    assert len(set(h([b"word", b"word!!", b"(word)"]).tolist())) == 1
    assert WordHasher(4)([b"wordy", b"words"]).tolist()[0] == WordHasher(4)([b"words"]).tolist()[0]
    assert scatter(h([b"a", b"b"]), 10).max() < 1024


M64 = 2**64 - 1
PUNCT = ".,;:!?\"'()[]{}*#$%&|<>/\\-_=+~`^@"


def plain_hash(word, stem=0):
    bare = word.strip(PUNCT) or word
    return zlib.crc32((bare[:stem] if stem and len(bare.encode()) > stem else bare).encode())


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


def plain_bucket(h, bits):
    return (h * 0xD6E8FEB86659FD93 & M64) >> (64 - bits)


def plain_mix(a, b, salt):
    h = a * 0x9E3779B97F4A7C15 + salt & M64
    h ^= h >> 29
    h = (h + b) * 0xBF58476D1CE4E5B9 & M64
    return h ^ h >> 32


def _given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "n_chars").unionByName(odd(spark).select("doc_id", "text", "n_chars"))
    return docs.cache(), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_scores_by_plain_python(spark):
    docs, labels = _given(spark)
    model = tox.fit(docs, labels)
    weight = dict(zip(model.index.tolist(), model.weight.tolist(), strict=True))
    for r in tox.score(docs, model).collect():
        words = plain_words(r.text)
        h, s = [plain_hash(w) for w in words], [plain_hash(w, 4) for w in words]
        grams = h + [plain_mix(x, x, 3) for x in s] + [plain_mix(a, b, 1) for a, b in zip(h, h[1:], strict=False)] + [plain_mix(a, b, 2) for a, b in zip(h, h[2:], strict=False)]
        margin = model.bias + sum(weight.get(i, 0.0) for i in {plain_bucket(x, model.bits) for x in grams})
        want = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        assert abs(r.score - want) < 1e-6 and r.predicted == int(r.score >= 0.5)


def test_quality_scores_by_all_pairs(spark):
    docs, labels = _given(spark)
    model = fm.fit(docs, labels)
    for r in fm.score(docs, model).collect():
        first = fm.structure(r.text, r.n_chars).tolist()
        counts = {}
        for w in plain_words(r.text):
            i = len(fm._STRUCTURE) * fm._BINS + plain_bucket(plain_hash(w), model.bits)
            counts[i] = counts.get(i, 0) + 1
        value = {i: np.log1p(c) for i, c in counts.items()}
        length = sum(x * x for x in value.values()) ** 0.5
        i = np.array(first + list(value))
        x = np.array([1.0] * len(first) + [v / length for v in value.values()])
        pairs = (model.v[i].astype(float) @ model.v[i].astype(float).T) * np.outer(x, x)  # every two features
        margin = model.w0 + model.w[i].astype(float) @ x + np.triu(pairs, 1).sum()
        want = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        assert abs(r.score - want) < 1e-4 and r.predicted == int(r.score >= 0.3)
