import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stopwise.llm import quality_rules as q

from .helpers import ODD, SF, empty, odd, prose


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    marked = {i + j for i in range(len(ws) - 2) if count[tuple(ws[i : i + 3])] > 1 for j in range(3)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t|#é\u2003\x1c\x85😀", max_size=120))
def test_statistics_equal_plain_counting(text):
    assert q.text_stats(text)[:5] == brute(text)


def test_odd_rows(spark):
    rows = q.quality_rules(odd(spark)).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert q.quality_rules(empty(spark)).count() == 0


def test_clashing_columns_give_way(spark):
    from pyspark.sql import functions as F

    out = q.quality_rules(odd(spark).withColumns({"Kept": F.lit("old"), "distance": F.lit("old"), "mine": F.lit(1)}))
    assert {"kept", "distance", "mine"} <= set(out.columns) and len({c.lower() for c in out.columns}) == len(out.columns)
    assert dict(out.dtypes)["kept"] == "boolean"


def test_planted_outliers_go_and_clean_ones_stay(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        clean = i % 10 > 1
        body = prose(i, rng.randint(60, 300))
        rows.append((i, body if clean else " ".join(w + "%%%" for w in body.split()), "en" if i % 3 else "de", f"s{i % 2}", 0))
    got = {r.doc_id: r.kept for r in q.quality_rules(odd(spark, rows)).collect()}
    assert all(got[i] == (i % 10 > 1) for i in got)


def test_fit_is_near_the_clean_moments(spark):
    rng = np.random.default_rng(5)
    clean = rng.multivariate_normal(np.zeros(7), np.diag([1, 0.04, 0.04, 0.25, 0.25, 0.01, 0.01]), 3000)
    bad = rng.normal(8, 0.1, (500, 7))
    df = spark.createDataFrame([("0", "1", "2", *map(float, x)) for x in np.vstack([clean, bad])], "g0 string, g1 string, g2 string, " + ", ".join(f"x{i} double" for i in range(7)))
    fit = {r.g: r for r in q.fit_mcd(df).collect()}
    assert np.abs(np.array(fit["2"].mu)).max() < 0.1 and set(fit) == {"0", "1", "2"}


def _vector(text):
    n, chars, symbols, dup, repeat, lines, upper, marks = q.text_stats(text)
    n, chars, lines = max(n, 1), max(chars, 1), max(lines, 1)
    return [math.log(n), math.log(chars / n), *[math.sqrt(a / b) for a, b in ((symbols, chars), (dup, lines), (repeat, n), (upper, chars), (marks, chars))]]


def brute_mcd(rows, alpha=0.75, steps=4, centre_rows=7.0, scatter_rows=100.0):
    """Squared distances by id, group by group in plain numpy: rows (id, language, source, vector)."""
    x = np.array([r[3] for r in rows])
    floor = np.array(q._FLOOR)
    members = {}
    for i, (_, lang, source, _v) in enumerate(rows):
        for g in ((), (lang,), (lang, source)):
            members.setdefault(g, []).append(i)
    fit = {}
    for g, at in members.items():
        own = x[members[g[:1]]]
        bins = np.sort(np.floor(own / (floor / 32)), axis=0)
        low, mid, high = ((bins[math.ceil(len(own) * p) - 1] + 0.5) * floor / 32 for p in (0.25, 0.5, 0.75))
        fit[g] = mid, np.diag(np.maximum((high - low) / 1.349, floor) ** 2)
    factor = q._consistency(alpha, 7)
    far = lambda g, at: np.maximum(np.einsum("ij,jk,ik->i", x[at] - fit[g][0], np.linalg.inv(fit[g][1]), x[at] - fit[g][0]), 0)
    for _ in range(steps):
        moments = {}
        for g, at in members.items():
            bins = np.floor(np.log2(np.maximum(far(g, at), 1e-9)) * 64)
            h = max(int(len(at) * alpha), 1)
            near = x[at][bins <= np.sort(bins)[h - 1]]
            moments[g] = len(near), near.mean(0), factor * np.cov(near.T, bias=True)
        for g in sorted(members, key=len):
            m, mean, cov = moments[g]
            if g:
                mean = (m * mean + centre_rows * fit[g[:-1]][0]) / (m + centre_rows)
                cov = (m * cov + scatter_rows * fit[g[:-1]][1]) / (m + scatter_rows)
            value, vector = np.linalg.eigh(cov / np.outer(floor, floor))
            fit[g] = mean, vector @ np.diag(np.maximum(value, 1)) @ vector.T * np.outer(floor, floor)
    return {rows[i][0]: d for g, at in members.items() if len(g) == 2 for i, d in zip(at, far(g, at), strict=True)}


def test_verdict_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows += [(100_000 + i, prose(i, 60 + i % 90) + " %%% ## $$" * (i % 7 == 0) * 20, None if i % 2 else "en", f"s{i % 3}", 0) for i in range(150)]
    got = {r.doc_id: r for r in q.quality_rules(odd(spark, rows)).collect()}
    fine = [(i, lang, source, _vector(text)) for i, text, lang, source, _ in rows if not got[i].base_failed]
    want = brute_mcd(fine)
    limit = q.chi2_quantile(3.9, 7)
    assert len(want) == len(fine) > 200
    for i, d in want.items():
        assert abs(got[i].distance - d) <= 1e-6 * max(1, d) and got[i].kept == (d <= limit)
    assert all(r.distance is None and not r.kept for r in got.values() if r.base_failed)
    assert any(not r.kept for i, r in got.items() if i in want)


def test_outliers_in_tiny_groups_go(spark):
    """Every (language, source) has 2 to 4 rows, one of the larger ones bad."""
    rows = [(i, prose(i, 80), "en", f"s{i % 30}", 0) for i in range(100)]
    rows = [(i, " ".join(w + "%%%" for w in t.split()) if i in (5, 9) else t, lang, s, n) for i, t, lang, s, n in rows]
    got = {r.doc_id: r.kept for r in q.quality_rules(odd(spark, rows)).collect()}
    assert {i for i, kept in got.items() if not kept} == {5, 9}


def test_consistency_factor():
    assert 1.2 < q._consistency(0.75, 6) < 1.6
    assert abs(q.chi2_quantile(1.6449, 7) - 14.07) < 0.05
