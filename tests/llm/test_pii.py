import math
import random
import re
import time

from pyspark.sql import functions as F

from stopwise.llm import pii

from .helpers import ODD, empty, odd

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([ -]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for i, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), i, m.end()))
    return sorted(out)


def _spans(df, column="base_spans", model=None):
    return {r.doc_id: [(s.start, s.kind, s.end) for s in r[column]] for r in pii.find(df, model or pii.Model()).collect()}


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("0123456789.@+-() aB_%é\n") for _ in range(rng.randint(0, 80))) for _ in range(600)]
    texts += ["".join(rng.choice(["4111 1111 1111 1111", "a@b.co", "x.y@", "@c.d", ".e", "1.2.3.4", "255.300.1.1", "0001.2.3.00255", "+1 (415) 555-2671", " ", "-", "0", "12", "é😀"]) for _ in range(rng.randint(0, 12))) for _ in range(600)]
    texts += ["a." * 5000 + "@x.y" + ".z" * 5000, "1" * 50_000, "1 " * 30_000, "+1" + " " * 20_000, "a@b.c " * 3000]
    got = _spans(odd(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    assert all(got[i] == brute(t) for i, t in enumerate(texts))


def test_odd_rows(spark):
    out = pii.find(odd(spark).withColumn("Spans", F.lit("old")), pii.fit(odd(spark))).collect()
    assert len(out) == len(ODD) and all([tuple(s) for s in r.base_spans] == [(a, k, e) for a, k, e in brute(r.text)] for r in out)
    assert pii.find(empty(spark), pii.fit(empty(spark))).count() == 0


def _corpus(n=300):
    rng, rows = random.Random(8), []
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    for i in range(n):
        parts = ["plain words here", f"token = \"{hexa(40)}\" end", "see section-2-of-the-long-title and part3ofthebook", f"mail me{i}@mail.example.com now", f"order {rng.randrange(10**8, 10**9)} shipped"]
        rng.shuffle(parts)
        rows.append((i, " ".join(parts), "en", "s", 0))
    return rows


def test_credentials_are_learned_and_redacted(spark):
    rows = _corpus()
    df = odd(spark, rows)
    model = pii.fit(df)
    assert model.trees and pii.KINDS.index("secret") in model.thresholds
    found = pii.find(df, model)
    for r in pii.redact(found).collect():
        secret = re.search(r'token = "([0-9a-f]+)"', rows[r.doc_id][1])[1]
        assert secret not in r.text and "<secret>" in r.text and "<email>" in r.text and "@" not in r.text
        assert "plain words here" in r.text and "section-2-of-the-long-title" in r.text
    # what was learned holds without the word in front
    alone = odd(spark, [(1, "see b44e15e09fd311c3cf3163b66d5a9875b883d8ce there", None, None, None)])
    assert [s.kind for s in pii.find(alone, model).first().spans] in ([], [pii.KINDS.index("secret")])


def test_redaction_of_overlaps(spark):
    df = spark.createDataFrame([(1, "0123456789", [(2, 0, 5), (3, 1, 7), (8, 2, 9)]), (2, None, []), (3, "é😀x", [(1, 0, 2)])], "id int, text string, spans array<struct<start:bigint,kind:int,end:bigint>>")
    assert {r.id: r.text for r in pii.redact(df).collect()} == {1: "01<email>7<card>9", 2: None, 3: "é<email>x"}


def test_span_text(spark):
    df = spark.createDataFrame([([(2, 0, 5), (3, 4, 7)],), ([],)], "s array<struct<start:bigint,kind:int,end:bigint>>")
    assert [r.t for r in df.select(pii.span_text(F.col("s")).alias("t")).collect()] == ["email:2:5,secret:3:7", ""]


def test_main_path_has_no_python(spark):
    df = odd(spark)
    plan = pii.redact(pii.find(df, pii.Model(trees=[(1, 2, 0.5, -0.5)], thresholds={4: 0.5})))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_trees_decide(spark):
    """Nothing but the base kinds without trees; with them format and context decide, for new strings of the forms that were there."""
    rng = random.Random(3)
    hexa = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(28, 60)))
    words = lambda: "-".join(rng.choice(["section", "of", "the", "long", "title", "other", "paper", "2", "17"]) for _ in range(rng.randint(5, 9))) + "-4"
    joined = lambda: rng.choice(["page", "part", "item"]) + str(rng.randint(1, 9)) + "ofthe" + rng.choice(["paper", "volume", "journal"])
    df = odd(spark, [(i, f'plain key = "{hexa()}" and {joined()} in {words()} or {words()}, order {rng.randrange(10**8, 10**9)} shipped', None, None, None) for i in range(300)])
    model = pii.fit(df)
    assert not any(s[1] >= len(pii.BASE) for spans in _spans(df, "spans").values() for s in spans)
    texts = ['set token = "0123b44e15e09fd311c3cf3163b66d5a9875b883" now', "see section-7-of-another-long-title and page4ofthevolume", "order 412345678 shipped"]
    got = _spans(odd(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), "spans", model)
    assert [texts[0][a:b] for a, _, b in got[0]] == ["0123b44e15e09fd311c3cf3163b66d5a9875b883"] and got[1] == got[2] == []
    every = pii.proposals(df, model).collect()
    taken = {(r.doc_id, r.start, r.kind, r.end) for r in every if r.taken}
    assert any(not r.taken for r in every) and all(r.taken == (r.score >= model.thresholds.get(r.kind, 2)) for r in every)
    assert taken == {(i, *s) for i, spans in _spans(df, "spans", model).items() for s in spans if s[1] >= len(pii.BASE)}


def test_thresholds_are_pooled_bounds(spark):
    names = [f"x{i}" for i in range(len(pii.FEATURES))]
    rows = [(k, *[0] * (len(names) - 1), pos, neg) for k, pos, neg in [(4, 500, 5), (5, 0, 0), (6, 2, 6)]]
    vectors = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in [*names, "pos", "neg"]))
    got = pii.calibrate(pii.Model(bias=1.0), vectors)
    # the rare kind leans on all, the one with many false ones has none, whatever the others' share
    assert got.thresholds == {4: 0.5, 5: 0.5} and got.precisions[4][1] == 505
    assert pii.calibrate(pii.Model(bias=1.0), vectors.filter("x0 = 5")).thresholds == {}


def test_checks_need_no_words(spark):
    rows = [("secret", "59b79a44c83160ff605db5295c3f1b8f59a30bf7", True), ("secret", "0810992847249404", False), ("secret", "section-2-of-the-long-title", False), ("number", "123-45-6789", True), ("number", "000-45-6789", False), ("number", "021000021", True), ("number", "021000022", False), ("number", "(415) 555-2671", True), ("number", "015 555 2671", False)]
    df = spark.createDataFrame(rows, "k string, m string, ok boolean")
    got = df.withColumn("got", F.when(F.col("k") == "secret", pii._true("secret", F.col("m"))).otherwise(pii._true("number", F.col("m"))))
    assert all(r.got == r.ok for r in got.collect())


def test_spelled_addresses_by_the_ends_of_plain_ones(spark):
    df = odd(spark, [(1, "ann (at) mail (dot) org", None, None, None), (2, "bob (at) mail (dot) nowhere", None, None, None), (3, "x@y.org", None, None, None)])
    got = {r.x1: (r.pos, r.neg) for r in pii._vectors(df, "text", "doc_id").collect()}
    assert sorted(got.values()) == [(0, 1), (1, 0)]


def test_spans_can_be_exploded_and_filtered(spark):
    df = odd(spark, _corpus(100))
    found = pii.find(df, pii.fit(df))
    began = time.time()
    n = found.select(F.explode("spans").alias("s")).count()
    assert n == found.select(F.sum(F.size("spans")).alias("n")).first().n > 100
    assert found.filter(F.size("spans") > 0).count() == 100 and found.select(F.explode("base_spans")).count() == 100
    assert time.time() - began < 30


def test_account_numbers(spark):
    rows = [("DE89 3704 0044 0532 0130 00", True), ("GB82WEST12345698765432", True), ("DE88 3704 0044 0532 0130 00", False), ("123-45-6789", False)]
    df = spark.createDataFrame(rows, "m string, ok boolean")
    assert all(r.got == r.ok for r in df.withColumn("got", pii._iban(F.col("m"))).collect())


def test_texts_dense_with_spans(spark):
    one = [(1, "an@b.co " * 100_000), (2, "é" * 300 + 'token = "b44e15e09fd311c3cf31" x@y.zz 1.2.3.4 ' * 3000), (3, "q" * 1000)]
    df = spark.createDataFrame(one, "doc_id long, text string")
    began = time.time()
    found = pii.find(df, pii.Model(trees=[(1, 2, -0.5, 0.5)], thresholds={4: 0.5}))
    got = {r.doc_id: r for r in pii.redact(found).collect()}
    took = time.time() - began
    assert len(got[1].base_spans) == 100_000 and got[1].base_spans[-1].start == 799_992 and got[1].text == "<email> " * 100_000
    assert got[2].text == "é" * 300 + 'token = "<secret>" <email> <ip> ' * 3000 and [s.start for s in got[2].spans] == sorted(s.start for s in got[2].spans)
    assert got[3].text == one[2][1] and took < 60


def test_scores_and_spans_equal_plain_python(spark):
    """The model's verdict on every proposal, recomputed outside Spark from the features that Spark gives."""
    rows = _corpus(120)
    df = odd(spark, rows)
    model = pii.fit(df)
    tagged = pii._spans_of(df.withColumn("__t", F.col("text")), pii.MORE, "__t")
    judged = lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.array(*[v.cast("int") for v in pii.feature_columns(c)]).alias("x"))
    every = tagged.select("doc_id", F.explode(F.concat(*[F.transform(pii._tag(k), judged) for k in pii.MORE])).alias("z")).select("doc_id", "z.*").collect()

    def leaf(t, x):
        return t if isinstance(t, float) else leaf(t[2] if x[t[0]] <= t[1] else t[3], x)

    want = set()
    for r in every:
        margin = model.bias + sum(leaf(t, r.x) for t in model.trees)
        limit = model.thresholds.get(r.x[0])
        if limit is not None and 1 / (1 + math.exp(-margin)) >= limit - 1e-12:
            want.add((r.doc_id, r.start, r.x[0], r.end))
    text = {r[0]: r[1] for r in rows}
    base = {i: brute(t) for i, t in text.items()}
    want = {w for w in want if not any(b[0] <= w[1] and b[2] >= w[3] for b in base[w[0]])}
    got = {(r.doc_id, s.start, s.kind, s.end) for r in pii.find(df, model).collect() for s in r.spans if s.kind >= len(pii.BASE)}
    assert got == want and len(want) >= 120
    # matches, contexts and positions are those of the text
    for r in tagged.select("doc_id", F.explode(F.concat(*[pii._tag(k) for k in pii.MORE])).alias("c")).select("doc_id", "c.*").collect():
        t = text[r.doc_id]
        assert (r.match, r.before, r.after) == (t[r.start : r.end], t[max(0, r.start - 24) : r.start], t[r.end : r.end + 8])
