"""How far the word use of a language's sources differs: an exact audit through single-pass in-memory indexing.

Indexing. A task reads its documents once and counts terms in memory, by language and source: occurrences and
documents that have the term. When the block holds `most` entries it is spilled: for every hash shard of terms and
every language one run of terms in order, with their sources' numbers, goes to the shuffle, and a new block begins.
A task that owns a shard merges the shard's runs of a language through a heap, so equal terms of all sources
and blocks come together, keeps those in at least `least` documents of the language, and sends one row a term. Shards
are as many as the corpus's bytes ask for, so a shard's runs stay small whatever the corpus.

Divergence. With N occurrences of kept terms in a group and V kept terms in its language, a term with count c has
p = 1 + floor(10^9 (c + 1) / (N + V)), and two groups differ in it by floor((p - q)^2 / q). Over all V terms: what
two terms without occurrences give, V times; corrections for the terms that one group has, which depend on the count alone
and so come from a histogram of counts; and corrections for terms that both have, streamed over the term rows. All
arithmetic is on integers (modulo 2^64 in between; the sums themselves fit).

Defined cases: null texts, languages and sources are ''; a text without terms counts as a document and its group occurs; a
repeated row is a document of its own; without kept terms a language's pairs have the value 0; ties of value are ranked by
the item's UTF-8 bytes; very long texts are read whole; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_keyed, materialize, slices, table

SCALE = 1_000_000_000
LEAST, TOP = 3, 200
#: Entries (term of a source) that a block holds before it is spilled.
MOST = 500_000
#: Bytes of text for each shard of terms.
SHARD_BYTES = 8 << 20
#: A-Z lower-cased, other ASCII that is no letter made a space; bytes of other characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


_RUNS = "shard int, lang string, sources array<string>, terms binary, lens binary, owners binary, numbers binary"
#: A number holds documents above this many bits, and occurrences below.
_BITS = 40


def _index(shards: int, most: int):
    """Documents to runs: for a shard and a language the terms in order, how many sources of the block have each, and these sources with their numbers.

    A language's first run of a task may be without terms: its sources are those that occur.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        block: dict[str, dict[str, dict[bytes, int]]] = {}
        said: set[tuple[str, str]] = set()
        one = 1 << _BITS

        def spill() -> Iterator[pa.RecordBatch]:
            for lang, by_source in block.items():
                names, rows = list(by_source), []
                if new := [s for s in names if (lang, s) not in said]:
                    said.update((lang, s) for s in new)
                    rows.append((0, new, b"", b"", b"", b""))
                found = sorted(set().union(*by_source.values()))
                rank = {t: i for i, t in enumerate(found)}
                shard = np.array([zlib.crc32(t) for t in found], np.int64) % shards
                term = np.concatenate([np.fromiter(map(rank.__getitem__, d), np.int64, len(d)) for d in by_source.values()])
                number = np.concatenate([np.fromiter(d.values(), np.int64, len(d)) for d in by_source.values()])
                owner = np.repeat(np.arange(len(names)), [len(d) for d in by_source.values()])
                # shard by shard, within one in the order of terms
                order = np.argsort(shard, kind="stable")
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                way = np.argsort(place[term], kind="stable")
                term, number, owner = place[term[way]], number[way], owner[way]
                lens = np.bincount(term, minlength=len(found))
                ends = np.cumsum(lens)
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    lo, hi = int(cut[k]), int(cut[k + 1])
                    some = slice(int(ends[lo] - lens[lo]), int(ends[hi - 1]))
                    used, own = np.unique(owner[some], return_inverse=True)
                    rows.append((k, [names[i] for i in used.tolist()], b" ".join([found[i] for i in order[lo:hi].tolist()]), lens[lo:hi].astype(np.uint32).tobytes(), own.astype(np.uint32).tobytes(), number[some].tobytes()))
                if rows:
                    shard_, *rest = zip(*rows, strict=True)
                    types = [pa.list_(pa.string()), *[pa.binary()] * 4]
                    yield pa.RecordBatch.from_arrays([pa.array(shard_, pa.int32()), pa.array([lang] * len(rows)), *[pa.array(c, t) for c, t in zip(rest, types, strict=True)]], names=["shard", "lang", "sources", "terms", "lens", "owners", "numbers"])
            block.clear()

        for part in slices(batches):
            for lang, source, text in zip(*[part.column(c).to_pylist() for c in ("lang", "source", "text")], strict=True):
                own = block.setdefault(lang, {}).setdefault(source, {})
                get = own.get
                for t, n in Counter(terms(text)).items():
                    own[t] = get(t, 0) + n + one
            if sum(len(d) for x in block.values() for d in x.values()) > most:
                yield from spill()
        yield from spill()

    return run


def _merged(lang: str, runs: list[tuple], least: int) -> pa.RecordBatch:
    """Runs of one shard and language to its kept terms, with the sources that have each and how often."""
    heap = heapq.merge(*[zip(words.split(b" "), repeat(i), count()) for i, (_, words, *_) in enumerate(runs)])
    found: list[bytes] = []
    term, run, at = [], [], []
    now = None
    for t, i, k in heap:
        if t != now:
            found.append(t)
            now = t
        term.append(len(found) - 1)
        run.append(i)
        at.append(k)
    names = sorted(set().union(*[r[0] for r in runs]))
    number_of = {s: i for i, s in enumerate(names)}
    lens = [np.frombuffer(r[2], np.uint32).astype(np.int64) for r in runs]
    owners = np.concatenate([np.array([number_of[s] for s in r[0]], np.int64)[np.frombuffer(r[3], np.uint32)] for r in runs])
    numbers = np.concatenate([np.frombuffer(r[4], np.int64) for r in runs])
    first = np.cumsum([0, *[len(x) for x in lens]])[:-1]
    lens = np.concatenate(lens)
    starts = np.cumsum(lens) - lens
    entry = first[np.array(run)] + np.array(at)
    w = lens[entry]
    place = np.repeat(starts[entry] - (np.cumsum(w) - w), w) + np.arange(int(w.sum()))
    key = np.repeat(np.array(term, np.int64), w) * len(names) + owners[place]
    order = np.argsort(key, kind="stable")
    key, number = key[order], numbers[place][order]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    key = key[cut]
    counts = np.add.reduceat(number & ((1 << _BITS) - 1), cut)
    docs = np.add.reduceat(number >> _BITS, cut)
    term = key // len(names)
    begin = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    enough = np.add.reduceat(docs, begin) >= least
    each = np.repeat(enough, np.diff(np.r_[begin, len(term)]))
    offsets = np.r_[0, np.cumsum(np.diff(np.r_[begin, len(term)])[enough])].astype(np.int32)
    sources = pa.array(names, pa.string()).take(pa.array(key[each] % len(names)))
    kept = [found[i].decode("utf-8", "surrogatepass") for i in np.flatnonzero(enough).tolist()]
    lists = [pa.ListArray.from_arrays(pa.array(offsets), x) for x in (sources, pa.array(counts[each], pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(kept), pa.string()), pa.array(kept, pa.string()), *lists], names=["lang", "term", "sources", "counts"])


def _merge(least: int):
    """Runs, ordered by shard and language, to kept terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, runs = None, []
        for part in slices(batches):
            for shard, lang, *one in zip(*[part.column(c).to_pylist() for c in ("shard", "lang", "sources", "terms", "lens", "owners", "numbers")], strict=True):
                if (shard, lang) != now:
                    if runs:
                        yield _merged(now[1], runs, least)
                    now, runs = (shard, lang), []
                if one[1]:
                    runs.append(tuple(one))
        if runs:
            yield _merged(now[1], runs, least)

    return run


def frequencies(df: DataFrame, least: int = LEAST, most: int = MOST, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(groups lang, source that occur; kept terms lang, term, sources, counts) of df (lang, source, text)."""
    docs = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(16, size // shard_bytes)
    runs = materialize(docs.mapInArrow(_index(shards, most), _RUNS))
    own = runs.repartition(min(shards, max(16, shards // 4)), "shard").sortWithinPartitions("shard", "lang")
    return materialize(runs.filter("terms = X''").select("lang", F.explode("sources").alias("source")).distinct()), materialize(own.mapInArrow(_merge(least), "lang string, term string, sources array<string>, counts array<bigint>"))


def _share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (n + v)), in two steps that fit in 64 bits."""
    a, d = (count + 1) * 32_000, n + v
    div = lambda x, y: F.call_function("div", x, y)
    return div(a, d) * 31_250 + div((a % d) * 31_250, d) + 1


def _shares(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same over arrays; size: n + v."""
    a = (count + 1) * 32_000
    return a // size * 31_250 + a % size * 31_250 // size + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """For each group lang, source: n (occurrences of kept terms), n_lang, v (kept terms of the language)."""
    own = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e")).groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    v = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    out = materialize(groups.join(own, ["lang", "source"], "left").join(v, "lang", "left").fillna(0, ["n", "v"]))
    langs = out.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    return materialize(join_keyed(out, langs, ["lang"]))


def _corrections(limit: int = 1 << 20):
    """Term rows (lang, sources, counts, sizes: n + v of each source) to sums by pair of sources, over the terms that both have, of
    f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0); x0: the share of a term without occurrences. At most `limit` pairs are spread out at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        sums: dict[int, int] = {}

        def add(ids: list, sizes: list, counts: list, lens: list) -> None:
            group, size, count = (np.array(x, np.int64) for x in (ids, sizes, counts))
            p, p0 = _shares(count, size), _shares(np.zeros_like(count), size)
            w = np.array(lens)
            start = np.repeat(np.cumsum(w) - w, w)
            each = np.repeat(w, w)  # every entry meets all entries of its term
            left = np.repeat(np.arange(len(p)), each)
            right = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(start, each)
            off = left != right
            left, right = left[off], right[off]
            value = _apart(p[left], p[right]) - _apart(p[left], p0[right]) - _apart(p0[left], p[right]) + _apart(p0[left], p0[right])
            pair = group[left] << 32 | group[right]
            order = np.argsort(pair, kind="stable")
            pair, value = pair[order], value[order]
            first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else []
            if len(pair):
                for k, s in zip(pair[first].tolist(), np.add.reduceat(value, first).tolist(), strict=True):
                    sums[k] = sums.get(k, 0) + s

        for part in slices(batches, 4096):
            ids, sizes, counts, lens, pairs = [], [], [], [], 0
            for lang, sources, n_v, count in zip(*[part.column(c).to_pylist() for c in ("lang", "sources", "sizes", "counts")], strict=True):
                ids += [names.setdefault((lang, s), len(names)) for s in sources]
                sizes += n_v
                counts += count
                lens.append(len(sources))
                pairs += len(sources) ** 2
                if pairs > limit:
                    add(ids, sizes, counts, lens)
                    ids, sizes, counts, lens, pairs = [], [], [], [], 0
            if lens:
                add(ids, sizes, counts, lens)
        if sums:
            back = list(names)
            keys = list(sums)
            wrapped = [(x + (1 << 63)) % (1 << 64) - (1 << 63) for x in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array([back[k >> 32][0] for k in keys]), pa.array([back[k >> 32][1] for k in keys]), pa.array([back[k & 0xFFFFFFFF][1] for k in keys]), pa.array(wrapped, pa.int64())], names=["lang", "source", "other", "value"])

    return run


def _sum(c: str | Column) -> Column:
    return F.sum(F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)"))


def _wrapped(c: Column) -> Column:
    """A decimal as a long modulo 2^64."""
    two = F.lit("18446744073709551616").cast("decimal(38,0)")
    low = F.pmod(c.cast("decimal(38,0)"), two)
    return F.when(low >= F.lit("9223372036854775808").cast("decimal(38,0)"), low - two).otherwise(low).cast("bigint")


def _far(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def entries(known: DataFrame, kept: DataFrame) -> DataFrame:
    """A row for each kept term and source that has it: lang, term, total (in the language), source, count, and its group's n, n_lang, v."""
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total")
    each = kept.select("lang", "term", total, F.explode(F.arrays_zip("sources", "counts")).alias("e")).select("lang", "term", "total", F.col("e.sources").alias("source"), F.col("e.counts").alias("count"))
    return join_keyed(each, known, ["lang", "source"])


def _sized(known: DataFrame, kept: DataFrame, most: int = 1_000) -> DataFrame:
    """Term rows (lang, sources, counts, sizes). Sizes come from a map for each language, or, where a language has more than `most` sources, by a join of entries."""
    if known.groupBy("lang").count().filter(F.col("count") > most).isEmpty():
        maps = known.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("source", (F.col("n") + F.col("v")).alias("size")))).alias("size_of"))
        return join_keyed(kept, materialize(maps), ["lang"]).select("lang", "sources", "counts", F.transform("sources", lambda s: F.col("size_of")[s]).alias("sizes"))
    size = (F.col("n") + F.col("v")).alias("sizes")
    again = entries(known, kept).groupBy("lang", "term").agg(F.collect_list(F.struct(F.col("source").alias("sources"), F.col("count").alias("counts"), size)).alias("e"))
    return again.select("lang", "e.sources", "e.counts", "e.sizes")


def pairs(known: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value): every two sources of a language and how far the first is from the second."""
    known = known.select("lang", "source", "n", "v")
    both = known.join(known.select("lang", F.col("source").alias("item"), F.col("n").alias("m")), "lang").filter("source <> item")
    blank = lambda n: F.when(F.col("v") > 0, _share(F.lit(0).cast("bigint"), F.col(n), F.col("v"))).otherwise(1)
    both = both.withColumns({"p0": blank("n"), "q0": blank("m")})
    both = materialize(both.withColumn("f00", _far(F.col("p0"), F.col("q0"))))
    # terms of one group as if the other lacked them: the same for all with one count
    counted = entries(known, kept).groupBy("lang", "source", "n", "v", "count").agg(F.count(F.lit(1)).alias("k"))
    shares = materialize(counted.select("lang", "source", _share(F.col("count"), F.col("n"), F.col("v")).alias("p"), "k"))
    more = lambda f: _sum((f - F.col("f00")).cast("decimal(19,0)") * F.col("k"))
    name = ["lang", "source", "item"]
    one = shares.join(both.select(*name, "q0", "f00"), ["lang", "source"]).groupBy(*name).agg(more(_far(F.col("p"), F.col("q0"))).alias("one"))
    two = shares.withColumnRenamed("source", "item").join(both.select(*name, "p0", "f00"), ["lang", "item"]).groupBy(*name).agg(more(_far(F.col("p0"), F.col("p"))).alias("two"))
    stream = _sized(known, kept).mapInArrow(_corrections(), "lang string, source string, other string, value bigint")
    met = stream.groupBy("lang", "source", F.col("other").alias("item")).agg(_sum("value").alias("met"))
    out = both.join(one, name, "left").join(two, name, "left").join(met, name, "left")
    value = F.col("f00").cast("decimal(19,0)") * F.col("v")
    for c in ("one", "two", "met"):
        value = value + F.coalesce(F.col(c), F.lit(0).cast("decimal(38,0)"))
    return out.select(*name, _wrapped(value).alias("value"))


def telling(known: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value): the terms that a group uses more than its language, and how far it is from it there."""
    shares = entries(known, kept).select("lang", "source", F.col("term").alias("item"), _share(F.col("count"), F.col("n"), F.col("v")).alias("p"), _share(F.col("total"), F.col("n_lang"), F.col("v")).alias("q"))
    return shares.filter("p > q").select("lang", "source", "item", _far(F.col("p"), F.col("q")).alias("value"))


def audit(df: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of df (lang, source, text): all pairs of sources, and the `top` telling terms of each source."""
    groups, kept = frequencies(df, least)
    known = totals(groups, kept)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    part = lambda rows, name: rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", rank)
    return part(pairs(known, kept), "pair").unionByName(part(telling(known, kept), "term").filter(F.col("rank") <= top))


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS k FROM w JOIN kept ON kept.lang = w.lang AND kept.term = w.term GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(k), 0)::HUGEINT AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
nl AS (SELECT lang, sum(n)::HUGEINT AS n FROM n GROUP BY lang),
full_ AS (SELECT n.lang, n.source, kept.term, coalesce(c.k, 0) AS k, 1 + (1000000000::HUGEINT * (coalesce(c.k, 0) + 1)) // (n.n + v.v) AS p
    FROM n JOIN v ON v.lang = n.lang JOIN kept ON kept.lang = n.lang LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = kept.term),
lang_ AS (SELECT c.lang, c.term, 1 + (1000000000::HUGEINT * (sum(c.k) + 1)::HUGEINT) // (any_value(nl.n) + any_value(v.v)) AS q FROM c JOIN nl ON nl.lang = c.lang JOIN v ON v.lang = c.lang GROUP BY ALL),
far AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::HUGEINT AS value FROM full_ a JOIN full_ b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
term AS (SELECT f.lang, f.source, 'term' AS part, f.term AS item, (((f.p - l.q) * (f.p - l.q)) // l.q)::BIGINT AS value
    FROM full_ f JOIN lang_ l ON l.lang = f.lang AND l.term = f.term WHERE f.k > 0 AND f.p > l.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
