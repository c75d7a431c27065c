import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from stopwise.llm import divergence as d

from .helpers import ODD, SF, empty, odd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def brute(rows, least=3, top=200):
    """All rows of the audit in plain Python; rows: (text, lang, source)."""
    rows = [(text or "", lang or "", source or "") for text, lang, source in rows]
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = Counter(TERM.findall(text.translate(LOWER)))
        counts[lang, source].update(found)
        docs[lang].update(found.keys())
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        share = lambda c, n: 1 + 10**9 * (c + 1) // (n + len(kept))
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(counts[lang, s][t], n[s]) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(n.values())) for t in kept}
        far = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pair = [(o, sum(far(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, far(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, len(pair)), ("term", term, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_given_rows(spark):
    path = f"{SF}/documents.parquet"
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(path).collect()]
    found = got(d.op12_source_divergence(spark, SF))
    assert found == brute(rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    assert found == sorted(con.sql(d.OP12_SQL).fetchall())


def test_odd_rows(spark):
    assert got(d.audit(odd(spark))) == brute([(r[1], r[2], r[3]) for r in ODD])
    assert got(d.audit(odd(spark).withColumns({"term": F.lit("x"), "shard": F.lit(1), "counts": F.lit(2)}), least=1)) == brute([(r[1], r[2], r[3]) for r in ODD], 1)
    assert got(d.audit(empty(spark))) == []


def test_terms():
    for text in ("Ab-cd_E\x7ff\x00g Ünï…日本 1a2b c d", "", None, "123 !?", "Éa"):
        assert [t.decode() for t in d.terms(text)] == TERM.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("seed", range(2))
def test_spilled_blocks(spark, seed, monkeypatch):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("ba", "ko", "é", "日", "te") for b in ("na", "si", "ü", "du", "pe", "ga", "ri")]
    rows = [(" ".join(rng.choices(vocab, range(1, len(vocab) + 1), k=rng.randint(0, 40))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "b", "b", "ß", ""])) for _ in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    groups, kept = d.frequencies(docs, 3, most=20, shard_bytes=50)  # many runs and shards
    known = d.totals(groups, kept)
    want = brute(rows, top=10**9)
    assert sorted((r.lang, r.source, r.item, r.value) for r in d.pairs(known, kept).collect()) == sorted((*r[:2], *r[3:5]) for r in want if r[2] == "pair")
    assert sorted((r.lang, r.source, r.item, r.value) for r in d.telling(known, kept).collect()) == sorted((*r[:2], *r[3:5]) for r in want if r[2] == "term")
    many = d._sized(known, kept, most=1)  # by the join for languages of many sources
    key = lambda r: (r.lang, sorted(zip(r.sources, r.counts, r.sizes, strict=True)))
    assert sorted(map(key, many.collect())) == sorted(map(key, d._sized(known, kept).collect()))
