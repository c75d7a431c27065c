import os

import pytest

import corpus_pipeline as cp
from stopwise.llm import mixing, pii, registry, simhash
from stopwise.llm import sentencepiece_bpe as sp

from .helpers import ODD, SF, empty, odd

needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@needs_tables
@pytest.mark.parametrize(("name", "stage"), cp.STAGES)
def test_stages_take_odd_and_empty_tables(spark, name, stage):
    for docs in (odd(spark), empty(spark)):
        out = stage(spark, docs.selectExpr("*", "'x' AS score", "1 AS copies"), SF)
        rows = out.collect()
        assert name == "tokens" or out.columns == list(cp.COLUMNS)
        assert len(rows) <= 3 * len(ODD)


@needs_tables
def test_stages_against_the_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = cp.drop_toxic(spark, docs, SF).collect()
    insults = ("idiot", "moron", "scum", "trash")
    assert 0.8 * docs.count() < len(clean) <= docs.count()
    assert sum(any(f" {w} " in r.text for w in insults) for r in clean) < 0.05 * len(clean)

    one = {r.doc_id for r in cp.drop_near_duplicates(spark, docs, SF).collect()}
    named = simhash.near_duplicates(docs, keep=["doc_id"]).collect()
    assert one == {r.component_id for r in named}

    before = {r.doc_id: r.text for r in docs.collect()}
    spans = {r.doc_id: r.spans for r in pii.find(docs, pii.fit(docs)).collect()}
    for r in cp.mask_personal_data(spark, docs, SF).collect():
        want, at = "", 0
        for s in spans[r.doc_id]:
            if s.start >= at:
                want += before[r.doc_id][at : s.start] + f"<{pii.KINDS[s.kind]}>"
            at = max(at, s.end)
        assert r.text == want + before[r.doc_id][at:] and r.n_chars == len(r.text)

    times = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    mixed = [r.doc_id for r in cp.mix_sources(spark, docs, SF).collect()]
    assert all(mixed.count(i) == n for i, n in times.items())


@needs_tables
def test_run(spark):
    pytest.importorskip("sentencepiece")
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    rows = cp.run(spark, SF).collect()
    assert rows
    for r in rows[:50]:
        assert r.ids == library.encode(r.text, add_eos=True) and r.n_tokens == len(r.ids)


def test_registry():
    assert [int(n[2:].split("_")[0]) for n in sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 11))
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@needs_tables
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_queries_on_the_smallest_tables(spark, name):
    import duckdb

    df = registry.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if name in registry.ORACLE_SQL:
        con = duckdb.connect()
        for t in ("documents", "pages", "embeddings", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = con.execute(registry.ORACLE_SQL[name])
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(df.columns)
        norm = lambda v: round(v, 6) if isinstance(v, float) else v
        assert sorted((tuple(norm(r[c]) for c in names) for r in rows), key=repr) == sorted((tuple(map(norm, r)) for r in want.fetchall()), key=repr)
