"""Jaccard join over word shingles: token-combination prefixes, exact at any similarity that is given.

Equal sets of shingles are one node. Tokens (hashed shingles) get a fixed order, and two sets that reach the
similarity must agree in a prefix of it. How a token is indexed depends on how many sets have it: a rare one alone, a
frequent one only together with k - 1 others of its class. The classes of frequent tokens are cut by hash, in numbers that
follow the size of a set, so a class holds few tokens of any set. A prefix goes on until
its tokens, less k - 1 for each class, outnumber what a similar set may lack: then some class shares k tokens.

Frequencies are counted exactly for half of the tokens (those with a hash of 0 or more, which come first in the order;
the others, which few sets need, count as rare). Counting and indexing move blocks of numbers to hash shards, a batch of sets
at a time; shards are as many as the tokens ask for. Sets are made from the texts again in each pass instead of being stored,
but for those that have a candidate. The members of one signature meet in one task, with 16 bytes each.

Candidates. In a shard equal signatures form a group. All members meet the group's first one; of groups of up to
`small` members all other pairs wait; larger groups wait as rows. What waits is looked at again with the components of
the links found so far: only members of different components still have to meet. Of a large group those outside its
largest component meet all others, more of them in each round, until it is in one component or all of them had their turn: a task holds a bounded
portion of them and streams a portion of the members past it, and only pairs that sizes and parity bits allow become rows.
Groups of one family have the same pairs. A pair becomes a row in the first group that both sets have, in the order of signatures: each row
carries some of its set's first groups, and where two sets are known to share an earlier one they wait for that. What isn't known costs a repeated row and no pair.
So a family of m near copies costs rows in proportion to m, no group is gathered as a whole, and no link between two components is lost.
Parity bits are some bits of each set; where two sets' bits differ too often they can't be similar. What they allow is
verified on whole sets: a task holds one set of a group and streams the others past it.

Defined cases: a text without words has an empty set (n_shingles 0) and is its own component; with fewer words than a shingle the
whole sequence is one; repeated rows and equal texts share a node; rows with a null id take no part in naming (component_id
null if no row of the component has an id); very long texts are read whole; an empty table gives an empty result; ties can't
arise (one smallest id); other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, join_counted, join_keyed, materialize, slices, table
from .simhash import _named_by, components

WIDTH, SIMILARITY = 5, 80
#: Tokens in up to so many sets are indexed in combinations of so many.
CLASSES = ((16, 1), (1 << 20, 2), (1 << 62, 3))
SMALL, HEADS = 8, 8
#: What a task holds of a large group: bytes of heads, and members that it streams past them.
HELD, MEMBERS = 1 << 22, 256
#: First groups of a set that its rows carry, one for each remainder of a hash.
FIRSTS = 8
#: Numbers that a shard of the index holds, about.
SHARD = 1 << 21
#: Frequent tokens (16 bytes each) that are given to all tasks.
MOST = 1 << 21
_MEMO = 300_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hashes of words, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word, 42)
        return h


class Shingler:
    """Texts to ordered arrays of distinct hashed shingles (signed). Hashes of words are remembered, in a bounded table."""

    def __init__(self, width: int = WIDTH) -> None:
        self.width = width
        self.memo = _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if len(words) < self.width:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), 7)] if words else [], np.uint64).view(np.int64)
        memo = self.memo
        if len(memo) > _MEMO:
            memo.clear()
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        n = len(words) - self.width + 1
        out = h[:n].copy()
        for i in range(1, self.width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        return np.unique(mixed(out).view(np.int64))


def _hash(s: np.ndarray) -> int:
    """A signed hash of a whole set (0: empty)."""
    import xxhash

    h = xxhash.xxh64_intdigest(s.tobytes(), 1) if len(s) else 0
    return h - (1 << 64) if h >> 63 else h


def _with_set(df: DataFrame, keep: Sequence[str], width: int, whole: bool) -> DataFrame:
    """Append fp, a hash of the set of shingles of text (0: empty), and n, its size; with `whole` also the set and its parity bits."""

    def make():
        shingler = Shingler(width)

        def f(texts: pa.Array) -> list[pa.Array]:
            sets = [shingler(t) for t in texts.to_pylist()]
            out = [pa.array(map(_hash, sets), pa.int64()), pa.array(map(len, sets), pa.int32())]
            return [*out, pa.array(sets, pa.list_(pa.int64())), pa.array(map(parity, sets), pa.binary())] if whole else out

        return f

    more = [T.StructField("set", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType())] if whole else []
    return add_columns(df, [T.StructField("fp", T.LongType()), T.StructField("n", T.IntegerType()), *more], ["text"], make, keep)


def parity(s: np.ndarray) -> bytes:
    """Bits that tell of each part of the hashes whether an odd number of a set's tokens has it; two bits for each token, about, and a power of two of them.

    Where two sets' bits differ they have at least so many tokens that the other lacks.
    """
    size = max(64, 1 << (2 * len(s) - 1).bit_length()) if len(s) else 64
    odd = np.bincount((s.view(np.uint64) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Parity bits (a row of 64-bit words for each set) of fewer parts: halves of the hashes' last bits meet."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, width), axis=1) if bits.shape[1] > width else bits


class _Bits:
    """Parity bits of some sets, together by width."""

    def __init__(self, bits: list[bytes]) -> None:
        width = np.array([len(b) // 8 for b in bits], np.int64)
        self.width, self.place, self.words = width, np.zeros(len(bits), np.int64), {}
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            self.place[own] = np.arange(len(own))
            self.words[w] = np.frombuffer(b"".join([bits[i] for i in own.tolist()]), np.uint64).reshape(len(own), w)

    def apart(self, other: _Bits, i: np.ndarray, j: np.ndarray, size: int = 1 << 21) -> np.ndarray:
        """How many bits differ between set i here and set j of the other, for each pair of numbers."""
        out = np.zeros(len(i), np.int64)
        widths = self.width[i] << 32 | other.width[j]
        for key in np.unique(widths).tolist():
            w, v = key >> 32, key & 0xFFFFFFFF
            both, pairs = min(w, v), np.flatnonzero(widths == key)
            left, right = _folded(self.words[w], both), _folded(other.words[v], both)
            step = max(1, size // both)
            for lo in range(0, len(pairs), step):
                at = pairs[lo : lo + step]
                out[at] = np.bitwise_count(left[self.place[i[at]]] ^ right[other.place[j[at]]]).sum(axis=1, dtype=np.int64)
        return out


def _possible(n: np.ndarray, m: np.ndarray, apart: np.ndarray | int, similarity: int) -> np.ndarray:
    """Whether sets of n and m tokens can be similar that have `apart` tokens at least in one of them only: the union has (n + m + apart) / 2 at least."""
    return 100 * (n + m - apart) >= similarity * (n + m + apart)


def _near(similarity: int):
    """Pairs (a, b, n, bits, m, marks) that the parity bits don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 8192):
            n, m = (part.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
            left, right = (_Bits(part.column(c).to_pylist()) for c in ("bits", "marks"))
            at = np.arange(len(n))
            keep = _possible(n, m, left.apart(right, at, at), similarity)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def near(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Those of the pairs (a, b) whose parity bits allow the similarity: an exact test to rule out, on a few bytes for each set."""
    left, right = sets.select(F.col("fp").alias("a"), "n", "bits"), sets.select(F.col("fp").alias("b"), F.col("n").alias("m"), F.col("bits").alias("marks"))
    return materialize(pairs.select("a", "b").distinct().join(left, "a").join(right, "b").mapInArrow(_near(similarity), "a long, b long"))


def _sets(texts: DataFrame, wanted: DataFrame, width: int, small: int = 500_000) -> DataFrame:
    """The sets (fp, n, set, bits) of wanted (key, fp), made again from the texts (text, key); a written table."""
    named = wanted.select("key", F.col("fp").alias("__want"))
    own = _with_set(join_keyed(texts, named, ["key"], max_rows=small), ["__want"], width, True).filter("fp = __want").drop("__want")
    own = materialize(own)
    # only rows that repeat an id and a text make a set come twice
    return own if own.count() == wanted.count() else materialize(own.dropDuplicates(["fp"]))


def _distinct(part: pa.RecordBatch, shingler: Shingler) -> dict[int, np.ndarray]:
    """The sets of a batch of texts by their hash."""
    sets = (shingler(t) for t in part.column("text").to_pylist())
    return {_hash(x): x for x in sets if len(x)}


_BLOCK = "shard int, marks binary, lens binary, fps binary, sizes binary"


def _lists(c: pa.Array) -> list[np.ndarray]:
    at, values = c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _deal(rows: list[tuple[int, int, np.ndarray]], bits: int) -> pa.RecordBatch:
    """(fp, size, numbers of 0 or more) to a block a shard: the first `bits` bits of a number are its shard, the next 32 its mark."""
    owner = np.repeat(np.arange(len(rows)), [len(v) for _, _, v in rows])
    values = np.concatenate([v for _, _, v in rows]).astype(np.uint64)
    shard = (values >> np.uint64(63 - bits)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    shard, owner = shard[order], owner[order]
    marks = (values[order] >> np.uint64(31 - bits)).astype(np.uint32)
    fps, sizes = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int32)
    cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    out: list[list] = [[], [], [], [], []]
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(shard)], strict=True):
        own = owner[a:b]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        for column, value in zip(out, (int(shard[a]), marks[a:b].tobytes(), np.diff(np.r_[first, b - a]).astype(np.uint32).tobytes(), fps[own[first]].tobytes(), sizes[own[first]].tobytes()), strict=True):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *[pa.array(c, pa.binary()) for c in out[1:]]], names=["shard", "marks", "lens", "fps", "sizes"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks ordered by shard to (shard, marks, fps, sizes) of whole shards, a row for each mark."""

    def joined(now: int, held: list[tuple]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        lens = np.concatenate([np.frombuffer(x[1], np.uint32) for x in held])
        return (
            now,
            np.concatenate([np.frombuffer(x[0], np.uint32) for x in held]),
            np.repeat(np.concatenate([np.frombuffer(x[2], np.int64) for x in held]), lens),
            np.repeat(np.concatenate([np.frombuffer(x[3], np.int32) for x in held]), lens),
        )

    now, held = None, []
    for part in batches:
        for shard, *block in zip(*[part.column(c).to_pylist() for c in ("shard", "marks", "lens", "fps", "sizes")], strict=True):
            if shard != now and held:
                yield joined(now, held)
                held = []
            now = shard
            held.append(block)
    if held:
        yield joined(now, held)


def _first_half(bits: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for part in slices(batches):
            rows = [(fp, len(x), x[np.searchsorted(x, 0) :]) for fp, x in _distinct(part, shingler).items()]
            if rows := [r for r in rows if len(r[2])]:
                yield _deal(rows, bits)

    return run


def _frequent(rare: int, by_set: bool):
    """Blocks of a shard to its tokens that more than `rare` sets have, and how many have each: (token, seen), or by set (fp, tokens, seen)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, marks, fps, _ in _shards(batches):
            order = np.lexsort((fps, marks))
            marks, fps = marks[order], fps[order]
            new = np.r_[True, (marks[1:] != marks[:-1]) | (fps[1:] != fps[:-1])]
            marks, fps = marks[new], fps[new]
            first = np.flatnonzero(np.r_[True, marks[1:] != marks[:-1]])
            size = np.diff(np.r_[first, len(marks)])
            if not by_set:
                tokens = marks[first].astype(np.uint64) | np.uint64(shard << 32)
                yield pa.RecordBatch.from_arrays([pa.array(tokens[size > rare].view(np.int64)), pa.array(size[size > rare])], names=["token", "seen"])
                continue
            seen = np.repeat(size, size)
            hot = seen > rare
            tokens, seen, fps = marks[hot].astype(np.uint64) | np.uint64(shard << 32), seen[hot], fps[hot]
            order = np.argsort(fps, kind="stable")
            tokens, seen, fps = tokens[order], seen[order], fps[order]
            cut = np.flatnonzero(np.r_[True, fps[1:] != fps[:-1]]) if len(fps) else np.array([], np.int64)
            offsets = pa.array(np.r_[cut, len(fps)].astype(np.int32))
            for lo in range(0, len(cut), 20_000):
                some = slice(lo, min(len(cut), lo + 20_000))
                at = offsets.slice(lo, some.stop - lo + 1)
                yield pa.RecordBatch.from_arrays([pa.array(fps[cut[some]]), pa.ListArray.from_arrays(at, pa.array(tokens.view(np.int64))), pa.ListArray.from_arrays(at, pa.array(seen.astype(np.int64)))], names=["fp", "tokens", "seen"])

    return run


def bands(n: int, similarity: int) -> list[int]:
    """The bands of sizes (powers of 4) in which a set of n tokens is indexed: its own, and the next one where similar sets may lie."""
    own = (n.bit_length() - 1) // 2
    return [own, own + 1] if 100 * n >= similarity * 4 ** (own + 1) else [own]


def signatures(tokens: np.ndarray, k: np.ndarray, band: int, similarity: int) -> np.ndarray:
    """Signatures of a set: tokens in their order, in combinations of how many each is indexed (k). Two similar sets of a band share one."""
    n = len(tokens)
    need = n - -(-similarity * n // 100) + 1
    salt = np.uint64((band + 1) * 0x2545F4914F6CDD1D % 2**64)
    alone = np.cumsum(k == 1)
    if alone[-1] == n or (k[: need] == 1).all():
        return mixed(tokens[:need].view(np.uint64) ^ salt) >> np.uint64(1)
    found, units = [], 0
    groups: dict[tuple[int, int], list[int]] = {}
    for token, size in zip(tokens.view(np.uint64).tolist(), k.tolist(), strict=True):
        if size == 1:
            found.append(token)
            units += 1
        else:
            # classes in proportion to the band's sizes
            classes = max(1, 4**band // (5 if size == 2 else 8))
            own = groups.setdefault((size, (token * 0x9E3779B97F4A7C15 % 2**64 >> 20) % classes), [])
            own.append(token)
            units += len(own) >= size
        if units >= need:
            break
    if units < need:
        raise AssertionError("a prefix can't be longer than its set")
    out = [mixed(np.array(found, np.uint64) ^ salt)]
    for (size, _), own in groups.items():
        if len(own) >= size:
            both = np.array(list(combinations(sorted(own), size)), np.uint64)
            h = both[:, 0]
            for i in range(1, size):
                h = mixed(h + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15) + both[:, i]
            out.append(mixed(h ^ salt))
    return np.unique(np.concatenate(out) >> np.uint64(1))


def ordered(s: np.ndarray, hot: np.ndarray, seen: np.ndarray, classes: Sequence[tuple[int, int]], shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a set in the order of the index, and in combinations of how many each is indexed. hot, seen: its frequent tokens (without their last `shift` bits)."""
    at = int(np.searchsorted(s, 0))
    first, rest = s[at:], s[:at]
    k = np.ones(len(first), np.int64)
    if len(hot):
        order = np.argsort(hot)
        hot, seen = hot[order], seen[order]
        own = first >> shift
        place = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
        k = np.where(hot[place] == own, np.array([c for _, c in classes])[np.searchsorted([n for n, _ in classes], seen[place])], 1)
    order = np.argsort(k, kind="stable")
    return np.r_[first[order], rest], np.r_[k[order], np.ones(len(rest), np.int64)]


def _signed(fp: int, s: np.ndarray, hot: np.ndarray, seen: np.ndarray, counted_bits: int, classes: Sequence[tuple[int, int]], similarity: int) -> list[tuple[int, int, np.ndarray]]:
    if len(s) <= 3:  # similar to equal ones only
        return []
    tokens, k = ordered(s, hot, seen, classes, 31 - counted_bits)
    return [(fp, len(s), signatures(tokens, k, b, similarity)) for b in bands(len(s), similarity)]


def _indexed(bits: int, counted_bits: int, classes: Sequence[tuple[int, int]], similarity: int, width: int, shared):
    """Texts to blocks of signatures. shared: a broadcast of all frequent tokens, in order, and how many sets have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        hot, seen = shared.value
        for part in slices(batches):
            rows = []
            for fp, s in _distinct(part, shingler).items():
                own = s[np.searchsorted(s, 0) :] >> (31 - counted_bits)
                at = np.searchsorted(hot, own)
                at = np.unique(at[hot[np.minimum(at, len(hot) - 1)] == own]) if len(hot) else at[:0]
                rows += _signed(fp, s, hot[at], seen[at], counted_bits, classes, similarity)
            if rows:
                yield _deal(rows, bits)

    return run


def _indexed_sets(bits: int, counted_bits: int, classes: Sequence[tuple[int, int]], similarity: int):
    """Sets (fp, set, tokens, seen: lists of its frequent tokens) to blocks of signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = lambda x: np.array([v for one in x or () for v in one], np.int64)
        for part in slices(batches):
            rows = []
            for fp, s, hot, seen in zip(part.column("fp").to_pylist(), _lists(part.column("set")), part.column("tokens").to_pylist(), part.column("seen").to_pylist(), strict=True):
                rows += _signed(fp, s, flat(hot), flat(seen), counted_bits, classes, similarity)
            if rows:
                yield _deal(rows, bits)

    return run


_FOUND = "kind int, a long, b long, size int"


def _grouped(small: int, similarity: int):
    """Blocks of a shard to candidates: pairs with a group's first member (kind 0), other pairs of groups of up to `small` members (1), rows (group, member) of larger ones (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, marks, fps, sizes in _shards(batches):
            order = np.lexsort((fps, marks))
            marks, fps, sizes = marks[order], fps[order], sizes[order]
            same = np.r_[False, (marks[1:] == marks[:-1]) & (fps[1:] == fps[:-1])]
            marks, fps, sizes = marks[~same], fps[~same], sizes[~same]
            first = np.flatnonzero(np.r_[True, marks[1:] != marks[:-1]])
            m = np.diff(np.r_[first, len(marks)])
            start, m = np.repeat(first, m), np.repeat(m, m)
            at = np.arange(len(marks))
            left, right, kind = [start[at > start]], [at[at > start]], [np.zeros(int((at > start).sum()), np.int32)]
            for d in range(1, small):
                j = at[(m <= small) & (at - start > d)]
                left.append(j - d)
                right.append(j)
                kind.append(np.ones(len(j), np.int32))
            i, j, kind = np.concatenate(left), np.concatenate(right), np.concatenate(kind)
            near = 100 * np.minimum(sizes[i], sizes[j]).astype(np.int64) >= similarity * np.maximum(sizes[i], sizes[j]).astype(np.int64)
            i, j, kind = i[near], j[near], kind[near]
            a, b = fps[j], fps[i]
            order = np.lexsort((kind, b, a))
            a, b, kind = a[order], b[order], kind[order]
            new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.array([], bool)
            a, b, kind = a[new], b[new], kind[new]
            big = m > small
            a, b = np.r_[a, marks[big].astype(np.int64) | shard << 32], np.r_[b, fps[big]]
            kind, size = np.r_[kind, np.full(int(big.sum()), 2, np.int32)], np.r_[np.zeros(len(kind), np.int32), sizes[big]]
            for lo in range(0, len(a), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + 50_000]) for x in (kind, a, b, size)], names=["kind", "a", "b", "size"])

    return run


def _similar(similarity: int):
    """Rows (b, salt, a, set) ordered by b, salt and a, the set of b itself first (a null), to the pairs that reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for part in slices(batches):
            bs, salts, others, sets = part.column("b").to_pylist(), part.column("salt").to_pylist(), part.column("a").to_pylist(), _lists(part.column("set"))
            at, found = 0, ([], [])
            while at < len(bs):
                if others[at] is None:
                    now, held = (bs[at], salts[at]), sets[at].copy()
                    at += 1
                    continue
                end = at
                while end < len(bs) and others[end] is not None and (bs[end], salts[end]) == now:
                    end += 1
                if end == at:
                    raise AssertionError("a set that others meet is missing")
                own = np.array([len(x) for x in sets[at:end]])
                values = np.concatenate(sets[at:end])
                hit = held[np.minimum(np.searchsorted(held, values), len(held) - 1)] == values
                both = np.add.reduceat(hit, np.cumsum(own) - own, dtype=np.int64)
                for i in np.flatnonzero(100 * both >= similarity * (own + len(held) - both)).tolist():
                    found[0].append(others[at + i])
                    found[1].append(bs[at])
                at = end
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, similarity: int, share: int = 256, small: int = 500_000) -> DataFrame:
    """Those of the pairs (a, b) whose sets reach the similarity (per cent). A set that many others meet is given to several tasks, `share` of the others to each."""
    pairs = materialize(pairs.select("a", "b").distinct())
    parts = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("m"))
    salted = materialize(join_counted(pairs, materialize(parts.withColumn("parts", F.ceil(F.col("m") / share))), ["b"], "m").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("salt")))
    few = (lambda d: F.broadcast(d)) if salted.limit(small + 1).count() <= small else (lambda d: d)
    sets = sets.select("fp", "set")
    own = sets.join(few(salted.select("b", "salt").distinct()), sets["fp"] == F.col("b")).select("b", "salt", F.lit(None).cast("long").alias("a"), "set")
    met = own.unionByName(sets.join(few(salted), sets["fp"] == F.col("a")).select("b", "salt", "a", "set"))
    return materialize(met.repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first()).mapInArrow(_similar(similarity), "a long, b long"))


def _bits(numbers: int, shard: int) -> int:
    return min(31, max(4, (max(1, numbers // shard)).bit_length()))


def _blocks(texts: DataFrame, nodes: DataFrame, counted: int, bits: int, classes: Sequence[tuple[int, int]], similarity: int, width: int, most: int) -> DataFrame:
    """Blocks of signatures. Up to `most` frequent tokens (counted) go to all tasks; more meet the sets that have them in a shuffle."""
    shards = _by_shard(texts.mapInArrow(_first_half(counted, width), _BLOCK), counted)
    hot = materialize(shards.mapInArrow(_frequent(classes[0][0], False), "token long, seen long"))
    if hot.count() <= most:
        known = hot.orderBy("token").toPandas()
        shared = texts.sparkSession.sparkContext.broadcast((known["token"].to_numpy(np.int64), known["seen"].to_numpy(np.int64)))
        return texts.select("text").mapInArrow(_indexed(bits, counted, classes, similarity, width, shared), _BLOCK)
    seen = shards.mapInArrow(_frequent(classes[0][0], True), "fp long, tokens array<long>, seen array<long>")
    seen = seen.groupBy("fp").agg(F.collect_list("tokens").alias("tokens"), F.collect_list("seen").alias("seen"))
    return _sets(texts, nodes.select("key", "fp"), width).join(seen, "fp", "left").mapInArrow(_indexed_sets(bits, counted, classes, similarity), _BLOCK)


def _by_shard(blocks: DataFrame, bits: int) -> DataFrame:
    return blocks.repartition(1 << min(bits, 12), "shard").sortWithinPartitions("shard")


def similar_roots(texts: DataFrame, nodes: DataFrame, similarity: int = SIMILARITY, width: int = WIDTH, classes: Sequence[tuple[int, int]] = CLASSES, small: int = SMALL, heads: int = HEADS, shard: int = SHARD, most: int = MOST, held: int = HELD, members: int = MEMBERS) -> DataFrame:
    """Components (node, root: hashes of sets) under links of all sets whose Jaccard similarity is `similarity` per cent or more; sets without links are left out.

    texts: text, key; nodes: fp, size of a set and the key of a text that has it.
    """
    if not 50 <= similarity <= 100:
        raise ValueError("prefixes are made for a similarity from 50 to 100 per cent")
    total = nodes.agg(F.sum("size")).first()[0] or 0
    counted, bits = _bits(total // 2, shard), _bits(total // 3, shard)
    found = materialize(_by_shard(_blocks(texts, nodes, counted, bits, classes, similarity, width, most), bits).mapInArrow(_grouped(small, similarity), _FOUND))
    crowd = found.filter("kind = 2").select(F.col("a").alias("sig"), F.col("b").alias("fp"), "size")
    pairs = materialize(found.filter("kind < 2").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).unionByName(crowd.select("fp")).distinct()
    sets = _sets(texts, materialize(nodes.select("key", "fp").join(wanted, "fp")), width)
    pairs = materialize(near(pairs, sets, similarity).join(pairs, ["a", "b"]))
    # each set meets the one that it was found with most often, then, where that didn't link them, the others
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b"))
    links = verified(best, sets, similarity)
    roots = materialize(components(links))
    waiting = _rooted(pairs.select("a", "b"), roots, "a", "b").filter("root_a <> root_b")
    return _crowds(crowd, waiting.select("a", "b"), links, roots, sets, similarity, heads, held, members)


def _rooted(rows: DataFrame, roots: DataFrame, *columns: str) -> DataFrame:
    """Append for each column of fps the root of its component, as root_<column>."""
    for c in columns:
        rows = rows.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    return rows


def _crowds(crowd: DataFrame, waiting: DataFrame, links: DataFrame, roots: DataFrame, sets: DataFrame, similarity: int, heads: int, held: int, members: int) -> DataFrame:
    """Roots (node, root) once the waiting pairs and the large groups (sig, fp, size) have added their links.

    Members outside a group's largest component, as it is at first, meet the others: about `heads` of each group in the first round, when a
    family falls into few components, and 64 times as many in each further one. A hash of the set says who comes first, so the groups of one family send the same.
    """
    rows = _mixed(crowd, roots)
    shares = rows.groupBy("sig", "root_fp").agg(F.count(F.lit(1)).alias("n"))
    largest = materialize(shares.groupBy("sig").agg(F.max_by("root_fp", F.struct("n", "root_fp")).alias("core"), F.sum("n").alias("n")))
    rows = materialize(join_counted(rows, largest, ["sig"], "n").withColumn("outside", F.col("root_fp") != F.col("core")).drop("core"))
    first = True
    while True:
        left = F.sum(F.col("outside").cast("long")).alias("left")
        stats = materialize(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("of"), left, F.max("size").alias("most")).filter("left > 0"))
        turn = F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) * F.col("left") < heads << 20
        rows = materialize(join_counted(rows, stats, ["sig"], "n").withColumn("head", F.col("outside") & turn))
        pairs = _met(rows, sets, similarity, heads, held, members)
        links = links.unionByName(verified(pairs.unionByName(waiting) if first else pairs, sets, similarity))
        roots = materialize(components(links))
        rows = rows.withColumn("outside", F.col("outside") & ~F.col("head")).drop("head", "root_fp", "of", "left", "most")
        if rows.filter("outside").isEmpty():
            return roots
        rows, heads, first = _mixed(rows, roots), heads * 64, False


def _with_firsts(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Append to rows (sig, fp, ..) the bits of the set and its first groups, a signature for each remainder of their hashes (-1: none)."""
    slot = F.pmod(F.xxhash64("sig"), F.lit(FIRSTS))
    firsts = rows.groupBy("fp").agg(*[F.min(F.when(slot == i, F.col("sig"))).alias(f"first{i}") for i in range(FIRSTS)])
    firsts = firsts.select("fp", F.array(*[F.coalesce(f"first{i}", F.lit(-1).cast("long")) for i in range(FIRSTS)]).alias("firsts"))
    return rows.join(sets.select("fp", "bits").join(firsts, "fp"), "fp")


def _met(rows: DataFrame, sets: DataFrame, similarity: int, heads: int, size: int, members: int) -> DataFrame:
    """Pairs (a, b) of heads and members of a group (sig, fp, size, root_fp, head; of, left, most: its members, those that wait, its largest size), of different components, that sizes and parity bits allow and that are not known to meet in an earlier group.

    A set that meets others and is a head itself has role 2, as it meets another head twice. A task holds a portion of a group's heads (`size` bytes, about) and streams `members` of its members past them.
    """
    known = _with_firsts(rows, sets)
    parts, blocks = F.ceil(F.col("of") / members), F.ceil(F.least(F.col("left"), F.lit(2 * heads)) * (F.col("most") / 2 + 64) / size)
    place = lambda salt, n: F.pmod(F.xxhash64("fp", F.lit(salt)), n)
    spot = lambda role, block, part: F.struct(F.lit(role).alias("role"), block.cast("int").alias("block"), part.cast("int").alias("part"))
    past = lambda role: F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda b: spot(role, b, place(1, parts)))
    held = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda p: spot(0, place(2, blocks), p))
    dealt = known.select("sig", "fp", "size", F.col("root_fp").alias("root"), "bits", "firsts", F.explode(F.when(F.col("head"), F.concat(held, past(2))).otherwise(past(1))).alias("at"))
    dealt = dealt.select("sig", "at.*", "fp", "size", "root", "bits", "firsts").repartition("sig", "block", "part").sortWithinPartitions("sig", "block", "part", "role")
    return dealt.mapInArrow(_meeting(similarity), "a long, b long")


def _meeting(similarity: int):
    """Rows (sig, block, part, role, fp, size, root, bits, firsts) in this order, heads (role 0) before members, to the pairs that sizes and parity bits allow.

    A pair that shares one of its firsts before this group, or that meets again with the other one as the head, is left to that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], None
        for batch in slices(batches, 1024):
            sig, block, part, role, fp, size, root = (batch.column(c).to_numpy().astype(np.int64) for c in ("sig", "block", "part", "role", "fp", "size", "root"))
            bits, firsts = batch.column("bits"), batch.column("firsts").flatten().to_numpy().reshape(len(sig), -1)
            # those from this group on never agree
            firsts = np.where(firsts < sig[:, None], firsts, -1)
            firsts[(firsts < 0) & (role == 0)[:, None]] = -2
            cut = np.flatnonzero(np.r_[True, (sig[1:] != sig[:-1]) | (block[1:] != block[:-1]) | (part[1:] != part[:-1]) | (role[1:] != role[:-1])])
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(sig)], strict=True):
                key = (sig[lo], block[lo], part[lo])
                if key != now:
                    now, held, ready = key, [], None
                own = (fp[lo:hi], size[lo:hi], root[lo:hi], firsts[lo:hi], bits.slice(lo, hi - lo).to_pylist())
                if role[lo] == 0:
                    held.append(own)
                    continue
                if not held:  # no head fell into this portion
                    continue
                if ready is None:
                    ready = (*[np.concatenate([h[c] for h in held]) for c in range(4)], _Bits([x for h in held for x in h[4]]))
                fps, sizes, roots, earlier, marks = ready
                # what the smaller size allows at best, and only what isn't linked yet
                mine, step = _Bits(own[4]), max(1, (1 << 20) // len(fps))
                for at in range(0, hi - lo, step):
                    n = own[1][at : at + step, None]
                    near = (100 * np.minimum(n, sizes) >= similarity * np.maximum(n, sizes)) & (own[2][at : at + step, None] != roots)
                    if role[lo] == 2:
                        near &= own[0][at : at + step, None] > fps
                    for c in range(earlier.shape[1]):
                        near &= own[3][at : at + step, c, None] != earlier[:, c]
                    i, j = np.nonzero(near)
                    i += at
                    keep = _possible(own[1][i], sizes[j], mine.apart(marks, i, j), similarity)
                    a, b = own[0][i[keep]], fps[j[keep]]
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    return run


def _mixed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (sig, fp, ..) of the groups that are not in one component yet, with root_fp."""
    rows = materialize(_rooted(rows, roots, "fp"))
    open_ = rows.groupBy("sig").agg(F.min("root_fp").alias("lo"), F.max("root_fp").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo <> hi").select("sig", "n")
    return materialize(join_counted(rows, materialize(open_), ["sig"], "n"))


def join(df: DataFrame, similarity: int = SIMILARITY, width: int = WIDTH, **options) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) of df (doc_id, text): the size of each row's set, and the smallest id that links lead to."""
    texts = df.select("text", F.xxhash64("doc_id", "text").alias("key"))
    rows = materialize(_with_set(df.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")), ["doc_id", "key"], width, False))
    nodes = materialize(rows.filter("n > 0").groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"), F.min("key").alias("key"), F.max("n").alias("size")))
    named = _named_by(nodes.select("fp", "low", "n"), similar_roots(texts, nodes, similarity, width, **options))
    linked = join_counted(rows.filter("n > 0"), materialize(named.select(F.col("__fp").alias("fp"), "component_id", F.col("__n").alias("m"))), ["fp"], "m")
    alone = rows.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone, allowMissingColumns=True).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def op11_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
