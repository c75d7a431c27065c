import random
from collections import Counter

from pyspark.sql import functions as F

from stopwise.llm import url_filter as u

from .helpers import SF

PAGES = "page_id long, url string, good boolean"


def _judge(spark, rows, **options):
    return {r.page_id: r for r in u.judge(spark.createDataFrame(rows, PAGES), "good", **options).collect()}


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path[:end]


URLS = ["http://A.Example.ORG/es/1", "https://example.org/en/12?x#y", "http://example.org/en/2", "ftp://x.com/fr/", "http://x.com/de/1#/fr/", "http://com/de/", "http://xcom/de/", "http://a.org", "http://a.org?x/", "//a.org/x", "", None, "http://É.org/Ü", "x://y://z/q", "http://a.net/\n/b", "http://org/"]


def test_parts_and_rules(spark):
    want = ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", "com/de/", None, None, None, None, None, None, "org/", None, None, "org/"]
    got = _judge(spark, [(i, x, None) for i, x in enumerate(URLS)])
    for i, x in enumerate(URLS):
        assert (got[i].host, got[i].path) == brute_parts(x), x
        assert got[i].rule == want[i], x
        assert got[i].verdict == ("block" if want[i] in ("example.org/es/", "example.org/en/1", "com/de/") else "allow")


def test_bad_templates_go(spark):
    rows = [(i, f"http://h.net/good/{i}.html", i % 10 > 0) for i in range(200)]
    rows += [(1000 + i, f"http://h.net/spam/{i}", i % 10 == 0 if i % 2 else None) for i in range(200)]
    rows += [(2000 + i, f"http://h.net/fine/{i}/x", True) for i in range(50)]
    got = _judge(spark, rows)
    assert {got[i].template for i in range(200)} == {"/good/*"} and got[2000].template == "/fine/*/x"
    assert {got[1000 + i].verdict for i in range(200)} == {"block"} and {got[i].verdict for i in range(200)} == {"allow"}


def test_similar_siblings_share_their_purity(spark):
    rows = [(i, f"http://h.net/{'ab'[i % 2]}/{i}", i % 5 > 0) for i in range(300)]
    got = _judge(spark, rows)
    assert len({round(r.purity, 9) for r in got.values()}) == 1
    far = [(i, f"http://h.net/{'ab'[i % 2]}/{i}", bool(i % 2)) for i in range(300)]
    assert len({round(r.purity, 9) for r in _judge(spark, far).values()}) == 2


def test_odd_tables(spark):
    assert _judge(spark, []) == {}
    rows = [(1, "http://h.net/a", True), (1, "http://h.net/a", True), (None, None, None), (2, "http://h.net/" + "/".join("abcdefghij"), False), (3, "http://h.net//" + "x" * 20_000, None)]
    df = spark.createDataFrame(rows, PAGES).withColumns({"Host": F.lit("old"), "verdict": F.lit("old"), "mine": F.lit(1)})
    out = u.judge(df, "good").collect()
    assert len(out) == 5 and {r.mine for r in out} == {1} and {r.verdict for r in out} == {"allow"}


def brute_tree(rows, min_support=8, min_share=0.01, merge_z=1.96, strength=2.0, z=2.33):
    """Verdicts and purities by row, in plain Python: rows (url, good)."""
    parts = [brute_parts(u) for u, _ in rows]
    seg = [[s for s in p.split("/") if s] for _, p in parts]
    template = [() for _ in rows]
    for level in range(max(map(len, seg), default=0)):
        count, of = Counter(), Counter()
        for (h, _), s, t in zip(parts, seg, template, strict=True):
            if len(s) > level:
                count[h, t, s[level]] += 1
                of[h, t] += 1
        ok = {k for k, n in count.items() if n >= min_support and n >= of[k[:2]] * min_share}
        template = [t + (("=" + s[level] if (h, t, s[level]) in ok else "*"),) if len(s) > level else t for (h, _), s, t in zip(parts, seg, template, strict=True)]
    nodes = [(h, t) for (h, _), t in zip(parts, template, strict=True)]
    stat = {k: [0, 0] for k in nodes}
    for k, (_, good) in zip(nodes, rows, strict=True):
        stat[k][0] += good is not None
        stat[k][1] += good is True
    branch = {k: k for k in stat}
    for level in range(max((len(t) for _, t in stat), default=0) - 1, -1, -1):
        total = {}
        for k, b in branch.items():
            v = total.setdefault(b, [0, 0])
            v[0] += stat[k][0]
            v[1] += stat[k][1]
        families = {}
        for (h, b), (n, g) in total.items():
            if n and len(b) > level and b[level].startswith("="):
                families.setdefault((h, b[:level], b[level + 1 :]), []).append(((g + 1) / (n + 2), b[level], n, g))
        for (h, low, high), all_ in families.items():
            groups = []
            for _, at, n, g in sorted(all_):
                if groups:
                    N, G = groups[-1][1:]
                    pooled, gap = (G + g) / (N + n), abs(g / n - G / N)
                    if not (gap > 0 and gap >= merge_z * (pooled * (1 - pooled) * (1 / n + 1 / N)) ** 0.5):
                        groups[-1] = (groups[-1][0] + [at], N + n, G + g)
                        continue
                groups.append(([at], n, g))
            for ats, _, _ in groups:
                if len(ats) > 1:
                    for k, (bh, b) in branch.items():
                        if bh == h and len(b) > level and b[:level] == low and b[level + 1 :] == high and b[level] in ats:
                            branch[k] = (h, (*low, ("merged", tuple(sorted(ats))), *high))
    labelled, good = (sum(v[i] for v in stat.values()) for i in (0, 1))
    prior = good / labelled if labelled else 1.0
    out = {}
    for k, (h, b) in branch.items():
        purity = prior
        for level in range(len(b) + 1):
            under = [o for o, (oh, ob) in branch.items() if oh == h and ob[:level] == b[:level]]
            around = [stat[o] for o in under if level == len(b) or branch[o][1][: level + 1] != b[: level + 1]]
            n, g = sum(v[0] for v in around), sum(v[1] for v in around)
            purity = (g + strength * purity) / (n + strength)
        out[k] = purity, purity + z * (purity * (1 - purity) / (n + strength)) ** 0.5 < prior
    return [out[k] for k in nodes]


def _same_as_brute(spark, rows):
    got = _judge(spark, [(i, u_, g) for i, (u_, g) in enumerate(rows)], rules=())
    want = brute_tree(rows)
    for i, (purity, bad) in enumerate(want):
        assert abs(got[i].purity - purity) < 1e-9 and got[i].verdict == ("block" if bad else "allow"), rows[i]
    return sum(bad for _, bad in want)


def test_tree_equals_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    given = [(r.url, r.good) for r in u.labelled_pages(pages.select("page_id", "url"), spark.read.parquet(f"{SF}/labels.parquet")).collect()]
    assert len(given) == pages.count()
    rng = random.Random(2)
    planted = []
    for i in range(1500):
        host, top, low = rng.choice(["a.net", "b.net"]), rng.choice(["x", "y", "*", "{x|y}", "q|r"]), rng.choice(["new", "old", "tag"])
        bad = {"old": 0.9, "tag": 0.4}.get(low, 0.1) if host == "a.net" else 0.1
        deep = "/".join(["d"] * rng.choice([0, 0, 9]))
        planted.append((f"http://{host}/{top}/{i}/{low}/{deep}", rng.random() > bad if rng.random() < 0.4 else None))
    planted += [(f"http://c.net/ads/{i}", False if i < 4 else None) for i in range(20)] + [(f"http://c.net/fine/{i}", None) for i in range(20)]
    _same_as_brute(spark, given)
    assert _same_as_brute(spark, planted) > 100


def test_unlabelled_siblings_of_bad_ones_stay(spark):
    rows = [(i, f"http://h.net/{'bad' if i % 2 else 'new'}/{i}", False if i % 2 else None) for i in range(100)]
    rows += [(1000 + i, f"http://g.net/{i}", True) for i in range(400)]
    got = _judge(spark, rows)
    assert {got[i].verdict for i in range(1, 100, 2)} == {"block"} and {got[1000 + i].verdict for i in range(400)} == {"allow"}
