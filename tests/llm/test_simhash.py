import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stopwise.llm import simhash as s

from .helpers import ODD, empty, odd, prose, words


def brute_fingerprint(text):
    w = [x.lower() for x in words(text)]
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def brute_components(fps):
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(fps))]


def test_fingerprints():
    for text in [r[1] for r in ODD] + [prose(i, n) for i, n in enumerate((1, 2, 3, 4, 50, 300))] + ["A b", "a B", "Ä b c d"]:
        assert s.simhash(text) == brute_fingerprint(text)


def test_gray_rank():
    x = np.arange(1024, dtype=np.uint64)
    assert (s.gray_rank(x ^ (x >> np.uint64(1))) == x).all()


def _values(seed, n=400):
    rng = random.Random(seed)
    out = {0}
    for _ in range(n):
        base = rng.getrandbits(64) if rng.random() < 0.3 else rng.choice(list(out))
        for _ in range(rng.randint(0, 5)):
            base ^= 1 << rng.randrange(64)
        out.add(base)
    return sorted(out)


@pytest.mark.parametrize("seed", range(5))
def test_index_finds_every_link(seed):
    v = np.array(_values(seed), np.uint64)
    group = np.arange(len(v)) * 3 // len(v)
    order = np.lexsort((s.gray_rank(v), group))
    v, group = v[order], group[order]
    got = {(a, b) for x, y in s.GrayIndex(v, group).links(3, 64) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    want = {(i, j) for j in range(len(v)) for i in range(j) if group[i] == group[j] and int(v[i] ^ v[j]).bit_count() <= 3}
    assert got == want


@pytest.mark.parametrize("cap", [8192, 40, 5])
def test_components_however_small_groups_are_cut(spark, cap):
    v = _values(11)
    signed = [x - (1 << 64) if x >> 63 else x for x in v]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in s.components(s.near_links(df, group_cap=cap)).collect()}
    want = brute_components(v)
    got = [roots.get(x, x) for x in signed]
    assert len(set(want)) == len(set(got)) and len(set(zip(want, got, strict=True))) == len(set(want))


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in s.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {1000 + i: 1000 for i in range(1, 50)}


def test_odd_rows(spark):
    out = s.near_duplicates(odd(spark).withColumn("Fingerprint", F.lit("old"))).collect()
    assert len(out) == len(ODD)
    by = {}
    for r in out:
        assert r.fingerprint == f"{brute_fingerprint(r.text):016x}"
        by.setdefault(r.fingerprint, set()).add(r.component_id)
    assert by["0" * 16] == {1} and all(len(x) == 1 for x in by.values())
    assert {r.component_id for r in out if r.text == "a row without an id"} == {None}
    assert s.near_duplicates(empty(spark)).count() == 0


def test_keep_one(spark):
    kept = s.keep_one(odd(spark)).collect()
    left = {r.doc_id for r in kept}
    assert len(kept) == len(left) and {1, 4, 5, 6, 8, None} == left and kept[0].asDict().keys() == odd(spark).first().asDict().keys()
    plain = odd(spark, [r for i, r in enumerate(ODD) if r[0] is not None and i != 6])
    assert {r.doc_id for r in s.keep_one(plain).collect()} == {1, 4, 5, 6, 8}
    assert s.keep_one(empty(spark)).count() == 0


def _copies(seed, n=60):
    """Texts, and copies with more and more words changed, some of a copy."""
    rng, out = random.Random(seed), []
    for i in range(n):
        text = prose(f"{seed} {i}", rng.choice((3, 5, 12, 60, 200))).split() if i % 6 == 0 else list(out[rng.randrange(max(0, len(out) - 6), len(out))])
        for _ in range(rng.randint(0, 3) if i % 6 else 0):
            text[rng.randrange(len(text))] = f"w{rng.randrange(1000)}"
        out.append(text)
    return [" ".join(t) for t in out] + ["", "one", "One"]


def brute_similar(texts, least=0.8):
    sets = []
    for t in texts:
        w = [x.lower() for x in words(t)]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= least * len(a | b):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    return root


def test_stage_links_by_similarity_of_five_words(spark):
    texts = _copies(3)
    got = {r.doc_id for r in s.keep_one(odd(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).collect()}
    assert got == set(brute_similar(texts))
    # neither the texts of one component nor the components are those of three bits
    assert got != set(brute_components([brute_fingerprint(t) for t in texts]))


def test_large_buckets_lose_no_link(spark):
    base = prose("family", 100).split()
    texts = [" ".join([*base[:i], f"w{i}", *base[i + 1 :]]) for i in range(0, 100, 3)] + [" ".join(base[: 80 + i]) for i in range(0, 20, 4)] + [prose("other", 100)]
    texts += [" ".join([*base[:40], *prose(f"half {i}", 60).split()]) for i in range(12)]
    df = odd(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    rows = s._with_set(df.withColumn("__text", F.xxhash64("text")), "text", ["doc_id", "__text"], bands=True)
    fps = {r.doc_id: r["__fp"] for r in rows.collect()}
    want = brute_similar(texts)
    # buckets within a task, by sets and by words too large for one, and dealt by ranges from the start
    for small, cap, most_words, one_in in ((2, 2, 1 << 22, 32), (8, 8, 1 << 22, 32), (8, 2048, 1 << 22, 32), (8, 2048, 100, 32), (8, 8, 1 << 22, 1)):
        # one bucket holds all sets
        one = rows.withColumn("__bands", F.array(F.lit(1).cast("long")))
        root = {r.node: r.root for r in s.components(s.similar_links(df, one, "text", small=small, cap=cap, most_words=most_words, one_in=one_in)).collect()}
        got = [root.get(fps[i], fps[i]) for i in range(len(texts))]
        assert len(set(want)) == len(set(got)) == len(set(zip(want, got, strict=True)))
    with pytest.raises(ValueError):
        s.similar_links(df, rows, "text", similarity=0.7)


def test_stage_links_by_simhash(spark):
    """Without min-hashes the Gray index over SimHashes of 5-word shingles finds the near copies within 3 bits, and whole sets verify them."""
    texts = [prose(f"long {i}", 300).split() for i in range(12)]
    texts += [[*t[:150], f"w{k}", *t[151:]] for k in range(4) for t in texts[:6]]
    texts = [" ".join(t) for t in texts]
    df = odd(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    rows = s._with_set(df.withColumn("__text", F.xxhash64("text")), "text", ["doc_id", "__text"], bands=True)
    fps, sims = ({r.doc_id: r[c] for r in rows.collect()} for c in ("__fp", "__sim"))
    bare = rows.withColumn("__bands", F.array().cast("array<long>"))
    got = {(r.a, r.b) for r in s.similar_links(df, bare, "text").collect()}
    root = {r.node: r.root for r in s.components(spark.createDataFrame(list(got), "a long, b long")).collect()}
    want = brute_components([sims[i] % 2**64 for i in range(len(texts))])
    assert len(set(want)) < len(texts) - 12
    assert len(set(want)) == len({root.get(fps[i], fps[i]) for i in fps}) == len({(want[i], root.get(fps[i], fps[i])) for i in fps})
    # texts that merely share a SimHash are not linked
    assert s.similar_links(df.filter("doc_id < 12"), bare.filter("doc_id < 12").withColumn("__sim", F.lit(7).cast("long")), "text").count() == 0


def test_direct_links_are_within_the_radius_and_span(spark):
    v = _values(11)
    signed = [x - (1 << 64) if x >> 63 else x for x in v]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = [(r.a, r.b) for r in s.near_links(df, direct=True).collect()]
    assert all(((a ^ b) % 2**64).bit_count() <= 3 for a, b in links)
    root = {r.node: r.root for r in s.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want, got = brute_components(v), [root.get(x, x) for x in signed]
    assert len(set(want)) == len(set(got)) == len(set(zip(want, got, strict=True)))
