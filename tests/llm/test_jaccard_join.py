import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stopwise.llm import jaccard_join as j

from .helpers import ODD, SF, empty, odd, prose, words


def shingled(text, width=5):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(rows, similarity=80):
    """doc_id -> (n_shingles, component_id); rows: (doc_id, text)."""
    sets = [shingled(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if min(len(sets[a]), len(sets[b])) * 100 >= similarity * max(len(sets[a]), len(sets[b])) > 0:
                both = len(sets[a] & sets[b])
                if 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                    root[top(a)] = top(b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[top(i)] = min(doc, low.get(top(i), doc))
    return sorted(((doc, len(s), low.get(top(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def family(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def planted(seed):
    """Families around borderline similarity, shared passages, documents made of passages alone, a large family, sets of every small size."""
    rng = random.Random(seed)
    texts = []
    passages = [prose(1000 + i, 60).split() for i in range(4)]
    for f in range(10):
        base = prose(seed * 100 + f, rng.choice([6, 8, 12, 30, 70, 200])).split()
        texts += [family(rng, base, rng.randint(0, max(1, len(base) // 30))) for _ in range(rng.choice([2, 3, 5, 12]))]
    for _ in range(25):  # a common passage in documents that differ
        texts.append(prose(rng.randrange(10**6), rng.choice([20, 60])).split() + rng.choice(passages))
    for _ in range(20):  # nothing but passages
        texts.append(sum(rng.sample(passages, 2), []))
    base = prose(seed, 80).split()
    texts += [family(rng, base, rng.choice([0, 1, 1, 2, 4])) for _ in range(25)]
    for n in range(1, 12):
        short = prose(7, n).split()
        texts += [short, short[:-1], [*short, "more"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"classes": ((2, 1), (8, 2), (1 << 62, 3)), "small": 3, "heads": 6, "shard": 200, "most": 5, "held": 600, "members": 4})])
def test_planted(spark, seed, options):
    rows = planted(seed)
    assert got(j.join(spark.createDataFrame(rows, "doc_id long, text string"), **options)) == brute(rows)


def test_signatures_of_similar_sets_meet():
    """Whatever the frequencies, two sets at the border share a signature."""
    rng = np.random.default_rng(5)
    seen = {}
    for trial in range(4000):
        n = int(rng.integers(4, 90))
        x = rng.integers(-(2**63), 2**63, n)
        e = int(rng.integers(0, n // 5 + 1))
        y = np.unique(np.r_[rng.permutation(x)[: n - e], rng.integers(-(2**63), 2**63, int(rng.integers(0, 3)))])
        x = np.unique(x)
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        every = np.union1d(x, y)
        share = rng.choice([0, 0.5, 0.9, 1])
        for v in every[every >= 0].tolist():
            seen[v >> 27] = int(rng.choice([3, 30])) if rng.random() < share else 0
        found = []
        for s in (x, y):
            hot = np.array([v >> 27 for v in s[s >= 0].tolist() if seen[v >> 27]], np.int64)
            tokens, k = j.ordered(s, hot, np.array([seen[h] for h in hot.tolist()], np.int64), ((2, 1), (8, 2), (1 << 62, 3)), 27)
            assert sorted(tokens) == sorted(s)
            found.append({v for b in j.bands(len(s), 80) for v in j.signatures(tokens, k, b, 80).tolist()})
        assert found[0] & found[1] or np.array_equal(x, y)


@pytest.mark.parametrize("options", [{"size": 1 << 22, "members": 256}, {"size": 600, "members": 7}])
def test_groups_of_one_family_send_a_pair_once(spark, options):
    """A family of sets that are similar in pairs, in 40 groups: each pair becomes one row, not one for each group."""
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(-(2**63), 2**63, 100))
    sets = [np.unique(np.r_[np.delete(base, rng.integers(0, len(base), 2)), rng.integers(-(2**63), 2**63, 1)]) for _ in range(30)]
    fps = [j._hash(x) for x in sets]
    rows = [(int(sig), fp, len(x), fp, i % 3 > 0, 30, 20, 101) for sig in rng.integers(0, 2**62, 40) for i, (fp, x) in enumerate(zip(fps, sets, strict=True)) if rng.random() < 0.9 or i < 2]
    rows = spark.createDataFrame(rows, "sig long, fp long, size int, root_fp long, head boolean, of long, left long, most int")
    bits = spark.createDataFrame([(fp, bytearray(j.parity(x))) for fp, x in zip(fps, sets, strict=True)], "fp long, bits binary")
    out = [tuple(r) for r in j._met(rows, bits, 80, 20, **options).collect()]
    head = dict(zip(fps, (i % 3 > 0 for i in range(30)), strict=True))
    assert set(out) == {(max(a, b), min(a, b)) for a in fps for b in fps if a != b and (head[a] or head[b])}
    assert len(out) < 2 * len(set(out))


def test_parity_bits_rule_out_no_similar_pair():
    rng = np.random.default_rng(6)
    ruled = 0
    for trial in range(500):
        x = np.unique(rng.integers(-(2**63), 2**63, int(rng.integers(1, 300))))
        y = np.unique(np.r_[rng.permutation(x)[: int(len(x) * rng.random()) + 1], rng.integers(-(2**63), 2**63, int(rng.integers(0, 100)))])
        both = len(np.intersect1d(x, y))
        batch = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "n": [len(x)], "bits": [j.parity(x)], "m": [len(y)], "marks": [j.parity(y)]})
        kept = next(j._near(80)([batch])).num_rows
        similar = 100 * both >= 80 * (len(x) + len(y) - both)
        assert kept or not similar
        ruled += not kept
    assert ruled > 200


def test_odd_rows(spark):
    want = brute([r[:2] for r in ODD])
    assert got(j.join(odd(spark))) == want
    assert got(j.join(odd(spark).withColumns({"fp": F.lit(1), "set": F.lit("x"), "n": F.lit(None), "h": F.lit(3)}))) == want
    assert got(j.join(empty(spark))) == []


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(j.op11_jaccard_join(spark, SF)) == brute(rows)
