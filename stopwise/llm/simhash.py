"""Near-duplicates and their components, by SimHash or by the similarity of word shingles.

By SimHash (op4): all links within 3 bits, through a Gray-order hierarchical index. By similarity (the
pipeline's stage): SimHash of 5-word shingles and the same index propose the first links, verified on whole sets; what
three bits don't reach is found by min-hashes, so that all links of a Jaccard similarity of 0.8 or more are there, see `similar_links`.

Fingerprints: 3-word shingles of the lower-cased text, XXH64, majority of each bit.

Search. Copies of a fingerprint are one row from the start. With 4 blocks of 16 bits, two fingerprints
that differ in 3 bits at most agree in a block, so each goes to 4 groups keyed by (block, its bits); a
shuffle brings a group's fingerprints together, ordered by the Gray rank of the bits. Within a task the
sorted fingerprints are the leaves of a tree: each upper node keeps the mask of bits on which all below it
agree and that are not fixed further up, with their values. A query adds up its differences on the way
down and drops a whole node as soon as they exceed the radius.

Hot groups. A group of more than `group_cap` fingerprints (one block value shared by a large family of
near copies) is not given to one task: its members are keyed again by a further block of the remaining
bits, 4 ways (the same pigeonhole argument, so no link is lost), up to three times; then 44 bits are shared
and the distinct fingerprints of a group can differ in 20 only.

Links. Per group only a spanning forest leaves the task (at most members - 1 links), so a family of m
near copies gives fewer than 4m rows, not m^2. Components come from min-label rounds over the links
(large-star and small-star), whose tables are written to the shared folder each round.

Defined cases: null and empty texts have fingerprint zero and link like any other; rows with a null id take
no part in naming components (component_id is the smallest id that is not null; null if there is none);
repeated rows share a component; very long texts are read whole; ties can't arise (a component has one smallest id);
an empty table gives an empty result; extra columns pass through, input
columns with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, join_counted, join_keyed, materialize, shared_if_small, table

RADIUS = 3
SIMILARITY = 0.8
WORDS = 5
#: Bands of min-hashes, rows of each: a pair of similarity 0.8 agrees in no band with a chance of (1 - 0.8^6)^40, 5 in a million.
BANDS, ROWS = 40, 6
_BITS_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)  # [byte, bit]


def simhash(text: str | None) -> int:
    """The 64-bit fingerprint of a text (0 without words)."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    one = b" ".join(words)
    if n <= 3:
        return xxhash.xxh64_intdigest(one, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.r_[0, ends[:-3] + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(one[a:b], 42) for a, b in zip(starts, ends[2:].tolist(), strict=True)], np.uint64, n - 2)
    return majority(h)


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes (0 without any)."""
    # how often each byte value stands in each of the 8 byte places, then how often each bit is set
    seen = np.bincount((h.view(np.uint8).reshape(-1, 8) + (np.arange(8) << 8)).ravel(), minlength=2048).reshape(8, 256)
    over = (seen @ _BITS_OF_BYTE).ravel() * 2 > len(h)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text_col: str = "text", fp_col: str = "fp", keep: Sequence[str] | None = None) -> DataFrame:
    """Append the fingerprint as a long (its 64 bits read as signed)."""

    def make():
        def f(texts: pa.Array) -> list[pa.Array]:
            return [pa.array(np.array([simhash(t) for t in texts.to_pylist()], np.uint64).view(np.int64))]

        return f

    return add_columns(df, [T.StructField(fp_col, T.LongType())], [text_col], make, keep)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the reflected Gray code."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Hierarchical Hamming index of sorted fingerprints, several groups side by side.

    values: fingerprints, ordered by (group, Gray rank); group: number of each one's group, 0, 1, ...
    Level 0 holds nodes of up to `fan` neighbours of one group, each upper level joins `fan` nodes of one
    group; every group ends in one root.
    """

    def __init__(self, values: np.ndarray, group: np.ndarray, fan: int = 8) -> None:
        self.values = values
        self.levels: list[tuple[np.ndarray, ...]] = []  # first child, end of children, mask, pattern
        ones, zeros, owner = values, ~values, group
        while True:
            first_of = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[first_of, len(owner)])
            cut = np.flatnonzero((np.arange(len(owner)) - np.repeat(first_of, size)) % fan == 0)
            ones, zeros, owner = np.bitwise_and.reduceat(ones, cut), np.bitwise_and.reduceat(zeros, cut), owner[cut]
            self.levels.append((cut, np.r_[cut[1:], size.sum()], ones | zeros, ones))
            if len(cut) == len(first_of):
                break
        # a child's mask without what its parent has fixed already
        for k in range(len(self.levels) - 1):
            first, end, mask, pattern = self.levels[k]
            up = self.levels[k + 1]
            self.levels[k] = (first, end, mask & ~np.repeat(up[2], up[1] - up[0]), pattern)
        # from here on masks are the rests; leaves need the full one of their node
        rest = self.levels[-1][2]
        for k in range(len(self.levels) - 1, 0, -1):
            up = self.levels[k]
            rest = np.repeat(rest, up[1] - up[0]) | self.levels[k - 1][2]
        self.full = rest
        self.root = np.repeat(np.arange(len(self.levels[-1][0])), np.bincount(group))

    def links(self, radius: int, chunk: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions (i < j) of one group that differ in at most radius bits, in chunks."""
        n = len(self.values)
        for lo in range(0, n, chunk):
            q = np.arange(lo, min(n, lo + chunk))
            node = self.root[q]
            _, _, mask, pattern = self.levels[-1]
            far = np.bitwise_count((self.values[q] ^ pattern[node]) & mask[node])
            for k in range(len(self.levels) - 1, -1, -1):
                ok = far <= radius
                q, node, far = q[ok], node[ok], far[ok]
                first, end = self.levels[k][0][node], self.levels[k][1][node]
                w = end - first
                child = np.repeat(first - (np.cumsum(w) - w), w) + np.arange(w.sum())
                q, far, parent = np.repeat(q, w), np.repeat(far, w), np.repeat(node, w)
                if k:
                    _, _, mask, pattern = self.levels[k - 1]
                    far = far + np.bitwise_count((self.values[q] ^ pattern[child]) & mask[child])
                else:
                    later = child > q
                    q, child, far, parent = q[later], child[later], far[later], parent[later]
                    far = far + np.bitwise_count((self.values[q] ^ self.values[child]) & ~self.full[parent])
                    ok = far <= radius
                    yield q[ok], child[ok]
                node = child


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]], used: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """For each of n positions the smallest one that it reaches. used: takes those of the links that make a spanning forest."""
    label = np.arange(n)
    for a, b in links:
        while len(a):
            la, lb = label[a], label[b]
            open_ = la != lb
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            if not len(a):
                break
            high, low = np.maximum(la, lb), np.minimum(la, lb)
            np.minimum.at(label, high, low)
            if used is not None:
                joins = np.flatnonzero(label[high] == low)
                joins = joins[np.unique(high[joins], return_index=True)[1]]
                used.append((a[joins], b[joins]))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _search(radius: int, most: int, direct: bool):
    """Over a partition that holds whole groups in order: link each fingerprint to the first of its part of the group (direct: by links within the radius)."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["fp"].to_numpy().view(np.uint64)
        key = pdf["key"].to_numpy()
        group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
        order = np.lexsort((gray_rank(v), group))
        v, group = v[order], group[order]
        used: list[tuple[np.ndarray, np.ndarray]] = [(np.array([], np.int64),) * 2]
        top = forest(len(v), GrayIndex(v, group).links(radius), used)
        own = np.flatnonzero(top != np.arange(len(v)))
        i, j = (np.concatenate(x) for x in zip(*used, strict=True)) if direct else (own, top[own])
        a, b = v[i].view(np.int64), v[j].view(np.int64)
        return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for pdf in parts:
            if not len(pdf):
                continue
            held.append(pdf)
            size += len(pdf)
            if size >= most:  # all but the last group, which may go on
                pdf = pd.concat(held, ignore_index=True)
                cut = int(np.searchsorted(pdf["key"].to_numpy(), pdf["key"].iloc[-1]))
                if cut:
                    yield solve(pdf.iloc[:cut])
                held, size = [pdf.iloc[cut:]], len(pdf) - cut
        if size:
            yield solve(pd.concat(held, ignore_index=True))

    return run


def _blocks(fp: str, shifts: Sequence[tuple[int, int]]):
    return [F.shiftrightunsigned(F.col(fp), s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in shifts]


#: The cut of 64 bits in 4 blocks of 16 (place of the lowest bit, width).
_OUTER = tuple((s, 16) for s in (0, 16, 32, 48))


def _split(fixed: tuple[int, ...]) -> list[tuple[tuple[int, int], ...]]:
    """Blocks of the bits that the fixed ones leave, cut in 4 (each a tuple of (place, width) runs)."""
    rest = [b for b in range(64) if b not in fixed]
    cuts = [round(i * len(rest) / 4) for i in range(5)]
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        runs: list[list[int]] = []
        for x in rest[a:b]:
            if runs and runs[-1][0] + runs[-1][1] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        out.append(tuple((s, w) for s, w in runs))
    return out


def _key(path: Sequence[int]):
    """A hash of the values of the blocks along a path of block numbers (the path itself goes in, too)."""
    fixed: tuple[int, ...] = ()
    cols = []
    for depth, i in enumerate(path):
        runs = _split(fixed)[i] if depth else (_OUTER[i],)
        cols += _blocks("fp", runs)
        fixed += tuple(b for s, w in runs for b in range(s, s + w))
    return F.xxhash64(F.lit(",".join(map(str, path))), *cols)


def near_links(fps: DataFrame, radius: int = RADIUS, group_cap: int = 8192, max_depth: int = 4, direct: bool = False) -> DataFrame:
    """Links (a, b: fingerprints, a > b) that connect all distinct fingerprints within radius bits (3 at most).

    direct: each link itself is within the radius, else it may stand for a chain of such.
    fps: one column fp of distinct longs. Groups at max_depth 4 share 44 bits, so they have at most 2^20 members.
    Keys are 64-bit hashes: if two groups share one, they are searched together, which costs time and loses nothing.
    """
    if radius > 3:
        raise ValueError("four blocks find links within 3 bits")
    fps = fps.select("fp")
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(str(i)).alias("path"), _key([i]).alias("key")) for i in range(4)])).alias("k")).select("fp", "k.path", "k.key")
    ready = []
    for depth in range(1, max_depth + 1):
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        if depth < max_depth:
            hot = materialize(sizes.filter(F.col("size") > group_cap).select("key"))
            if hot.isEmpty():
                ready.append(keyed.select("key", "fp"))
                break
            ready.append(join_keyed(keyed, hot, ["key"], "left_anti").select("key", "fp"))
            again = join_keyed(keyed, hot, ["key"], "left_semi")
            paths = [p for p in _paths(depth)]
            deeper = F.coalesce(*[F.when(F.col("path") == ",".join(map(str, p)), F.array(*[F.struct(F.lit(",".join(map(str, [*p, i]))).alias("path"), _key([*p, i]).alias("key")) for i in range(4)])) for p in paths])
            keyed = materialize(again.select("fp", F.explode(deeper).alias("k")).select("fp", "k.path", "k.key"))
        else:
            ready.append(keyed.select("key", "fp"))
    every = ready[0]
    for r in ready[1:]:
        every = every.unionByName(r)
    found = every.repartition("key").sortWithinPartitions("key").mapInPandas(_search(radius, 200_000, direct), "a long, b long")
    return found.distinct()


def _paths(depth: int) -> list[list[int]]:
    out: list[list[int]] = [[]]
    for _ in range(depth):
        out = [[*p, i] for p in out for i in range(4)]
    return out


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of links (a, b; longs): rows (node, root), root the smallest node reached.

    Alternating large-star and small-star rounds (Kiveris et al. 2014), until the links no longer change.
    Each is a minimum per node and a join back, so a node with many neighbours is never gathered.
    """
    edges = materialize(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = _join_least(both.filter(F.col("b") > F.col("a")), low).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = materialize(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = _join_least(large, low).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a != b").distinct()
        edges = materialize(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()
        if now == state or now[0] == now[2] and edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty():
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _named(slim: DataFrame) -> DataFrame:
    """Rows (__fp, component_id, __root, __n) for all fingerprints of slim (__id, __fp), __n the rows that have it."""
    nodes = materialize(slim.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("low"), F.count(F.lit(1)).alias("n")))
    return _named_by(nodes, components(near_links(nodes)))


def _named_by(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    member = materialize(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = materialize(member.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("members")))
    return join_counted(member, least, ["root"], "members").select(F.col("fp").alias("__fp"), "component_id", F.col("root").alias("__root"), F.col("n").alias("__n"))


def _slim(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return materialize(with_fingerprint(df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")), "__text", "__fp", ["__id"]))


def _join_least(edges: DataFrame, low: DataFrame, busy: int = 100_000) -> DataFrame:
    """Join edges (a, b) with low (a, m, n: the number of edges): nodes with very many edges apart from the others, salted or broadcast."""
    return join_counted(edges, materialize(low), ["a"], "n", busy)


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """The distinct hashed shingles of a text, ordered (one of all words where there are fewer than width; none without words)."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))] if words else [], np.uint64))


def _bands(h: np.ndarray, mult: np.ndarray, add: np.ndarray) -> list[int]:
    """One signed hash per band of min-hashes (none for an empty set)."""
    import xxhash

    if not len(h):
        return []
    h = (h >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(mult), np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(h), 512):
        x = np.multiply.outer(mult, h[i : i + 512])
        x += add[:, None]
        np.minimum(low, x.min(axis=1), out=low)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(low.reshape(BANDS, ROWS))], np.uint64).view(np.int64).tolist()


def _with_set(df: DataFrame, text_col: str, keep: Sequence[str] | None = None, bands: bool = False) -> DataFrame:
    """Append __fp, a hash of the whole set of shingles (0: empty), and with bands __n, its size, __sim, its SimHash, and __bands."""

    def make():
        import xxhash

        rng = np.random.default_rng(42)
        mult, add = rng.integers(0, 2**32, (2, BANDS * ROWS), np.uint32)
        mult |= np.uint32(1)

        def f(texts: pa.Array) -> list[pa.Array]:
            sets = [shingles(t) for t in texts.to_pylist()]
            fp = pa.array(np.array([xxhash.xxh64_intdigest(h.tobytes(), 1) if len(h) else 0 for h in sets], np.uint64).view(np.int64))
            sims = pa.array(np.array([majority(h) for h in sets] if bands else [], np.uint64).view(np.int64))
            return [fp, pa.array([len(h) for h in sets], pa.int32()), sims, pa.array([_bands(h, mult, add) for h in sets], pa.list_(pa.int64()))] if bands else [fp]

        return f

    more = [T.StructField("__n", T.IntegerType()), T.StructField("__sim", T.LongType()), T.StructField("__bands", T.ArrayType(T.LongType()))]
    return add_columns(df, [T.StructField("__fp", T.LongType()), *(more if bands else [])], [text_col], make, keep)


def _set_column(df: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
    """Append __set, the ordered shingles."""

    def make():
        def f(texts: pa.Array) -> list[pa.Array]:
            return [pa.array([shingles(t).view(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))]

        return f

    return add_columns(df, [T.StructField("__set", T.ArrayType(T.LongType()))], [text_col], make, keep)


_BUCKETS = "kind int, a long, b long, n int, place int"


def _first_pairs(small: int, cap: int, most_words: int, similarity: float, most: int):
    """Over a partition that holds whole buckets in order: all pairs (kind 0) of buckets of up to `small` sets; else the sets (key, set) with their place (kind 1; above `cap` sets or most_words shingles kind 2, and the first set with each)."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        key, fp, n = pdf["key"].to_numpy(), pdf["fp"].to_numpy(), pdf["n"].to_numpy()
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[first, len(key)])
        large = np.repeat((size > small) & ((size > cap) | (np.add.reduceat(n.astype(np.int64), first) > most_words)), size)
        start, size = np.repeat(first, size), np.repeat(size, size)
        at = np.arange(len(key))
        place = at - start
        left, right = [start[large & (place > 0)]], [at[large & (place > 0)]]
        for d in range(1, small):
            j = at[(size <= small) & (place >= d)]
            left.append(j - d)
            right.append(j)
        i, j = np.concatenate(left), np.concatenate(right)
        ok = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
        pairs = pd.DataFrame({"kind": 0, "a": fp[i[ok]], "b": fp[j[ok]], "n": 0, "place": 0}).drop_duplicates()
        big = size > small
        return pd.concat([pairs, pd.DataFrame({"kind": np.where(large[big], 2, 1), "a": key[big], "b": fp[big], "n": n[big], "place": place[big]})], ignore_index=True)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for pdf in parts:
            if not len(pdf):
                continue
            held.append(pdf)
            size += len(pdf)
            if size >= most:  # all but the last bucket, which may go on
                pdf = pd.concat(held, ignore_index=True)
                cut = int(np.searchsorted(pdf["key"].to_numpy(), pdf["key"].iloc[-1]))
                if cut:
                    yield solve(pdf.iloc[:cut])
                held, size = [pdf.iloc[cut:]], len(pdf) - cut
        if size:
            yield solve(pd.concat(held, ignore_index=True))

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, col, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, col = owner[seen[col] > 1], col[seen[col] > 1]
    col = np.unique(col, return_inverse=True)[1]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        x = np.zeros((len(sets), width), np.float32)
        x[owner[a:b], col[a:b] - lo] = 1
        out += x @ x.T
    return out


def _bucket_links(similarity: float):
    """Over a partition that holds whole buckets in order: link each set to the first one of its part of the bucket."""

    def solve(fp: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        n = np.array([len(x) for x in sets])
        both = _overlaps(sets).astype(np.float64)
        i, j = np.nonzero(np.triu(both >= similarity * (n[:, None] + n - both) - 1e-9, 1))
        top = forest(len(fp), [(i, j)])
        own = np.flatnonzero(top != np.arange(len(fp)))
        a, b = fp[own], fp[top[own]]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fps, sets = None, [], []
        for batch in batches:
            key, fp, held = batch.column("key").to_pylist(), batch.column("__fp").to_pylist(), batch.column("__set")
            for i, k in enumerate(key):
                if k != now and fps:
                    yield solve(np.array(fps, np.int64), sets)
                    fps, sets = [], []
                now = k
                fps.append(fp[i])
                sets.append(held[i].values.to_numpy(zero_copy_only=False).copy())
        if fps:
            yield solve(np.array(fps, np.int64), sets)

    return run


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float, busy: int = 500) -> DataFrame:
    """Those of the pairs (a, b) whose sets reach the similarity; sets in very many pairs apart from the others."""
    pairs = materialize(pairs)
    left = sets.select(F.col("__fp").alias("a"), F.col("__set").alias("__sa"))
    hot = materialize(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > busy).select("a"))
    met = pairs.join(left, "a")
    if not hot.isEmpty():
        met = join_keyed(pairs, hot, ["a"], "left_anti").join(left, "a").unionByName(join_keyed(pairs, hot.join(left, "a"), ["a"], max_rows=2_000))
    met = met.join(sets.select(F.col("__fp").alias("b"), F.col("__set").alias("__sb")), "b")
    both = F.size(F.array_intersect("__sa", "__sb"))
    return materialize(met.filter(both >= F.lit(similarity) * (F.size("__sa") + F.size("__sb") - both) - 1e-9).select("a", "b"))


def _crowded(keyed: DataFrame, cap: int, one_in: int) -> DataFrame:
    """Keys (key) of buckets far above cap, told by one set in one_in (only how a bucket is dealt hangs on this, not what is found in it)."""
    some = keyed.filter(F.pmod("fp", F.lit(one_in)) == 0)
    return materialize(some.groupBy("key").agg(F.count(F.lit(1)).alias("seen")).filter(F.col("seen") * one_in > 2 * cap).select("key"))


def _placed(rows: DataFrame) -> DataFrame:
    """Append place (from 0, in the order of fp) to the rows of large buckets: sorted by ranges, so a bucket spreads over tasks."""
    cut = materialize(rows.repartitionByRange("key", "fp").withColumn("pid", F.spark_partition_id()))
    sizes = cut.groupBy("key", "pid").count()
    sizes = materialize(sizes.withColumn("before", F.sum("count").over(Window.partitionBy("key").orderBy("pid")) - F.col("count")).drop("count"))
    own = F.row_number().over(Window.partitionBy("key", "pid").orderBy("fp")) - 1
    return materialize(join_keyed(cut.withColumn("own", own), sizes, ["key", "pid"]).select("key", "fp", "n", (F.col("before") + F.col("own")).alias("place")))


def print_pairs(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b: hashes of sets, __fp) to verify: sets of one SimHash (__sim) and its first set, and first sets of SimHashes that the Gray index links within radius bits."""
    sets = nodes.filter("__n > 0").select(F.col("__fp").alias("b"), "__sim")
    prints = materialize(sets.groupBy("__sim").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n")))
    pairs = join_counted(sets, prints, ["__sim"], "n").filter("a <> b").select("a", "b")
    links = materialize(near_links(prints.select(F.col("__sim").alias("fp")), radius, direct=True).select(F.col("a").alias("left"), F.col("b").alias("right")))
    for c in ("left", "right"):
        own = links.groupBy(c).agg(F.count(F.lit(1)).alias("n")).join(prints.select(F.col("__sim").alias(c), F.col("a").alias(f"of_{c}")), c)
        links = materialize(join_counted(links, materialize(own), [c], "n"))
    return materialize(pairs.unionByName(links.select(F.col("of_left").alias("a"), F.col("of_right").alias("b"))))


def _rooted(rows: DataFrame, roots: DataFrame, c: str) -> DataFrame:
    """Append the root (root_<c>) of the set that column c names; a set in very many rows apart from the others."""
    own = rows.groupBy(c).agg(F.count(F.lit(1)).alias("n")).join(roots.select(F.col("node").alias(c), F.col("root")), c, "left")
    return join_counted(rows, materialize(own.select(c, "n", F.coalesce("root", c).alias(f"root_{c}"))), [c], "n")


def similar_links(df: DataFrame, nodes: DataFrame, text_col: str, similarity: float = SIMILARITY, small: int = 8, cap: int = 2048, most_words: int = 1 << 22, one_in: int = 32) -> DataFrame:
    """Links (a, b: hashes of sets) that connect all distinct sets of shingles with a Jaccard similarity of `similarity` (0.8 at least).

    nodes: __fp, __n, __sim, __bands, __text (a hash of a text with that set). SimHashes within 3 bits, found by the Gray index, propose the
    first links. Three bits don't reach down to the similarity (pairs at 0.8 differ by ten, about), so
    sets that agree in a band of min-hashes share a bucket, too, where those that are not in one component yet are compared;
    candidates are verified on the whole sets: pairs of buckets of up to `small` sets by joins, buckets of
    up to `cap` sets and most_words shingles within a task, which sends a spanning forest. Larger buckets, of which those far
    above `cap` are dealt by ranges over tasks, go on in rounds, each
    with twice as many further members held against all later ones, but only where these are not in one
    component yet: a family of m near copies gives rows in proportion to m, and no pair of two components is left out.
    """
    if similarity < 0.8:
        raise ValueError("the bands find links of a similarity of 0.8 or more")
    keyed = nodes.select(F.col("__fp").alias("fp"), F.col("__n").alias("n"), F.explode("__bands").alias("key"))
    crowded = _crowded(keyed, cap, one_in)
    crowd = None if crowded.isEmpty() else _placed(join_keyed(keyed, crowded, ["key"]))
    others = keyed if crowd is None else join_keyed(keyed, crowded, ["key"], "left_anti")
    found = materialize(others.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(_first_pairs(small, cap, most_words, similarity, 200_000), _BUCKETS))
    pairs = found.filter("kind = 0").select("a", "b")
    many = found.filter("kind > 0").select("kind", F.col("a").alias("key"), F.col("b").alias("fp"), "n", "place")
    if crowd is not None:
        heads = materialize(crowd.filter("place = 0").select("key", F.col("fp").alias("a"), F.col("n").alias("na")))
        near = F.least("n", "na") >= F.lit(similarity) * F.greatest("n", "na") - 1e-9
        pairs = pairs.unionByName(join_keyed(crowd.filter("place > 0"), heads, ["key"]).filter(near).select("a", F.col("fp").alias("b")))
        many = many.unionByName(crowd.select(F.lit(2).alias("kind"), "key", "fp", "n", "place"))
    pairs = materialize(pairs.distinct())
    prints = print_pairs(nodes)
    big = many.filter("kind = 2").drop("kind")
    # sets are made again from the texts, and only those that any candidate needs
    wanted = pairs.unionByName(prints).select(F.explode(F.array("a", "b")).alias("__fp")).unionByName(many.select(F.col("fp").alias("__fp"))).distinct()
    wanted = materialize(nodes.select("__fp", "__text").join(wanted, "__fp"))
    texts = df.select(F.col(f"`{text_col}`").alias("__t"), F.xxhash64(f"`{text_col}`").alias("__text"))
    sets = materialize(_set_column(join_keyed(texts, wanted, ["__text"], max_rows=500_000).select("__fp", "__t").dropDuplicates(["__fp"]), "__t", ["__fp"]))
    links = _verified(prints, sets, similarity)
    roots = materialize(components(links))
    pairs = _rooted(_rooted(pairs, roots, "a"), roots, "b").filter("root_a <> root_b").select("a", "b")
    members = materialize(_rooted(many.filter("kind = 1").select("key", "fp"), roots, "fp"))
    mixed = members.groupBy("key").agg(F.min("root_fp").alias("lo"), F.max("root_fp").alias("hi")).filter("lo <> hi").select("key")
    members = members.join(mixed, "key").select("key", F.col("fp").alias("__fp")).join(sets, "__fp")
    inner = members.repartition("key").sortWithinPartitions("key").mapInArrow(_bucket_links(similarity), "a long, b long").distinct()
    links = links.unionByName(_verified(pairs, sets, similarity)).unionByName(materialize(inner))
    low, high = 1, 3
    while True:
        left = big.filter(F.col("place") >= low)
        if left.isEmpty():
            return links
        left = left.join(components(links).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        left = materialize(left)
        mixed = left.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
        big = materialize(join_keyed(left, materialize(mixed), ["key"], "left_semi"))
        heads = big.filter(F.col("place") < high).groupBy("key").agg(F.collect_list(F.struct("fp", "n", "place", "root")).alias("heads"))
        near = F.least("n", "head.n") >= F.lit(similarity) * F.greatest("n", "head.n") - 1e-9
        pairs = join_keyed(big, materialize(heads), ["key"]).withColumn("head", F.explode("heads")).filter((F.col("place") > F.col("head.place")) & (F.col("root") != F.col("head.root")) & near)
        links = links.unionByName(_verified(pairs.select(F.col("head.fp").alias("a"), F.col("fp").alias("b")).distinct(), sets, similarity))
        big = big.select("key", "fp", "n", "place")
        low, high = high, 2 * high + 1


def _slim_and_named(df: DataFrame, text_col: str, id_col: str, similarity: float | None) -> tuple[DataFrame, DataFrame]:
    """Rows (__id, __fp) of df, and rows (__fp, component_id, __root); __fp is the fingerprint or, with a similarity, the hash of the set."""
    if similarity is None:
        slim = _slim(df, text_col, id_col)
        return slim, materialize(_named(slim))
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__t"), F.xxhash64(f"`{text_col}`").alias("__text"))
    rows = materialize(_with_set(rows, "__t", ["__id", "__text"], bands=True))
    nodes = materialize(rows.groupBy("__fp").agg(F.min("__id").alias("low"), F.min("__text").alias("__text"), F.first("__n").alias("__n"), F.first("__sim").alias("__sim"), F.first("__bands").alias("__bands"), F.count(F.lit(1)).alias("n")))
    roots = components(similar_links(df, nodes, text_col, similarity))
    return rows.select("__id", "__fp"), materialize(_named_by(nodes.select(F.col("__fp").alias("fp"), "low", "n"), roots))


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: Sequence[str] | None = None, similarity: float | None = SIMILARITY) -> DataFrame:
    """Append fingerprint (16 hex digits) and component_id (the smallest id of the component).

    Components: of texts whose 5-word shingles have the similarity; None: of fingerprints within 3 bits.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("fingerprint", "component_id")]
    if similarity is not None:
        rows = _with_set(with_fingerprint(df.withColumn("__id", F.col(f"`{id_col}`")), text_col, "__print", [*dict.fromkeys([*keep, text_col])]), text_col, [*keep, "__print"])
        out = join_counted(rows, _slim_and_named(df, text_col, id_col, similarity)[1], ["__fp"], "__n")
        return out.withColumn("fingerprint", F.lower(F.lpad(F.hex("__print"), 16, "0"))).select(*[F.col(f"`{c}`") for c in keep], "fingerprint", "component_id")
    rows = with_fingerprint(df.withColumn("__id", F.col(f"`{id_col}`")), text_col, "__fp", [*keep, "__id"])
    if text_col in keep:  # texts are not written again: fingerprints are computed once for the search and once for the result
        slim = _slim(df, text_col, id_col)
    else:
        rows = slim = materialize(rows)
    out = join_counted(rows, materialize(_named(slim)), ["__fp"], "__n")
    return out.withColumn("fingerprint", F.lower(F.lpad(F.hex("__fp"), 16, "0"))).select(*keep, "fingerprint", "component_id")


def keep_one(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", small: int = 1_000_000, similarity: float | None = SIMILARITY) -> DataFrame:
    """One row of each component (as near_duplicates has them): that with the smallest id (any, where no row has an id, or where rows repeat that id)."""
    slim, named = _slim_and_named(df, text_col, id_col, similarity)
    repeated = slim.groupBy("__id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or __id is null")
    if repeated.isEmpty():
        # ids name rows, so only the ids that go meet the texts
        gone = materialize(join_counted(slim, named, ["__fp"], "__n").filter("__id <> component_id").select(F.col("__id").alias("__gone")))
        return df.join(shared_if_small(gone, small), F.col(f"`{id_col}`") == F.col("__gone"), "left_anti")
    rows = with_fingerprint(df, text_col, "__fp") if similarity is None else _with_set(df, text_col)
    rows = join_counted(rows, named, ["__fp"], "__n").filter(F.col(f"`{id_col}`").eqNullSafe(F.col("component_id")))
    return rows.dropDuplicates(["__root"]).select(*[F.col(f"`{c}`") for c in df.columns])


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"], similarity=None)
