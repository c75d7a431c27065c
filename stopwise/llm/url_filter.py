"""URL filters: fixed rules first, then a path-template tree per host judged by labelled purity.

Tree. Level by level, a segment stays literal below its parent (host and template so far) if it holds at
least `min_support` addresses and the share `min_share` of the parent's that go on; all others become the wildcard
`*`, so a node has at most 1 / min_share literal children, whatever the input. Levels go on until no node has
min_support addresses that are any longer; what is left can hold no literal. The tree is learned from the distinct
paths with counts, written once a level; rows meet the literals of all levels in broadcasts if a count
proves them few, else in salted joins.

Merging. Templates of a host that differ in one literal segment are siblings. In the order of their smoothed good
share each labelled one joins the branch before it unless its share differs significantly from all of that branch
(two-proportion z from `merge_z` on); levels are merged from the deepest up, on one row per template. Siblings
without labels stay for themselves, so a bad neighbour says nothing about them.

Verdict. A node's counts are those of all addresses below it. Its purity is smoothed towards that of what surrounds it, (good +
strength x around) / (labelled + strength), from the corpus over the host and each shorter template down, each
without the addresses below the next, so that no label counts twice; it is blocked if the upper end of the purity's confidence interval, `z` standard errors up, is below the
corpus's good share, else allowed. So a small branch goes if all its labels are bad, and none goes without labels.

Defined cases: null addresses and those without `://` have empty host and path and count as one host's
root; repeated rows each count; segments that look like a wildcard or a merged name are literals like others; of
equally pure siblings the first by code point goes first; very long and deep paths are cut whole; without labels
nothing is blocked but by rule; an empty table gives an empty result; extra columns pass through, input columns
with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, join_keyed, materialize, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Rules of the query: (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none fits. Of equally long ones the first by code point."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _segments() -> Column:
    return F.filter(F.split("path", "/"), lambda s: s != "")


def _step(rows: DataFrame, literal: DataFrame, level: int) -> DataFrame:
    """Append the segment of a level to __template: "=" and the segment where it is literal, else "*"."""
    rows = rows.withColumn("__here", F.get("__seg", F.lit(level)))
    rows = join_keyed(rows, literal, ["host", "__template", "__here"], "left")
    step = F.when(F.col("__literal"), F.concat(F.lit("="), "__here")).otherwise(F.lit("*"))
    return rows.withColumn("__template", F.when(F.col("__here").isNull(), F.col("__template")).otherwise(F.array_append("__template", step))).drop("__here", "__literal")


def _rest(rows: DataFrame, levels: int) -> DataFrame:
    more = F.array_repeat(F.lit("*"), F.greatest(F.size("__seg") - levels, F.lit(0)))
    return rows.withColumn("__template", F.concat("__template", more)).drop("__seg")


def _start(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"__seg": _segments(), "__template": F.array().cast("array<string>")})


def learn(paths: DataFrame, min_support: int = 8, min_share: float = 0.01) -> tuple[DataFrame, list[DataFrame]]:
    """paths: host, path, n (addresses), ...; returns it with __template, and each level's literals (host, __template, __here)."""
    rows, literals = materialize(_start(paths)), []
    key = ["host", "__template"]
    while True:
        here = rows.withColumn("__here", F.get("__seg", F.lit(len(literals)))).filter(F.col("__here").isNotNull())
        counts = materialize(here.groupBy(*key, "__here").agg(F.sum("n").alias("n")))
        parents = materialize(counts.groupBy(*key).agg(F.sum("n").alias("of")).filter(F.col("of") >= min_support))
        if parents.isEmpty():
            return _rest(rows, len(literals)), literals
        literal = join_keyed(counts.filter(F.col("n") >= min_support), parents, key).filter(F.col("n") >= F.col("of") * min_share)
        literals.append(materialize(literal.select(*key, "__here", F.lit(True).alias("__literal"))))
        rows = materialize(_step(rows, literals[-1], len(literals) - 1))


def templates(rows: DataFrame, literals: list[DataFrame]) -> DataFrame:
    """Append __template to rows (host, path, ...)."""
    rows = _start(rows)
    for level, literal in enumerate(literals):
        rows = _step(rows, literal, level)
    return _rest(rows, len(literals))


def _merged(siblings: Column, merge_z: float) -> Column:
    """Ordered siblings (p, at, n, g) to (at, k), k the number of the branch."""
    zero = F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("n"), F.lit(0.0).alias("g"), F.array().cast("array<struct<at:string,k:int>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        n, g = x["n"].cast("double"), x["g"].cast("double")
        pooled = (acc["g"] + g) / (acc["n"] + n)
        gap = F.abs(g / n - acc["g"] / acc["n"])
        apart = (acc["n"] > 0) & (gap > 0) & (gap >= merge_z * F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / acc["n"])))
        apart = F.when(acc["n"] > 0, apart).otherwise(False)
        k = acc["k"] + apart.cast("int")
        start = lambda c, v: F.when(apart, v).otherwise(acc[c] + v)
        return F.struct(k.alias("k"), start("n", n).alias("n"), start("g", g).alias("g"), F.array_append(acc["out"], F.struct(x["at"].alias("at"), k.alias("k"))).alias("out"))

    return F.aggregate(siblings, zero, add, lambda acc: acc["out"])


def merge_branches(stats: DataFrame, merge_z: float = 1.96) -> DataFrame:
    """stats: host, __template, labelled, good. Appends branch, the template with merged siblings as {a|b}."""
    depth = stats.agg(F.max(F.size("__template"))).first()[0] or 0
    rows = stats.withColumn("branch", F.col("__template"))
    for level in range(depth - 1, -1, -1):
        at = F.get("branch", F.lit(level))
        swap = lambda new: F.transform("branch", lambda s, i: F.when(i == level, new).otherwise(s))  # noqa: B023, E731
        nodes = rows.groupBy("host", "branch").agg(F.sum("labelled").alias("n"), F.sum("good").alias("g"))
        nodes = materialize(nodes.filter((F.col("n") > 0) & at.startswith("=")).select("host", swap(F.lit("")).alias("rest"), F.substring(at, 2, 1 << 30).alias("at"), "n", "g"))
        # at most 1 / min_share siblings
        lists = nodes.groupBy("host", "rest").agg(F.array_sort(F.collect_list(F.struct(((F.col("g") + 1) / (F.col("n") + 2)).alias("p"), "at", "n", "g"))).alias("all")).filter(F.size("all") > 1)
        named = lists.select("host", "rest", F.explode(_merged(F.col("all"), merge_z)).alias("z")).groupBy("host", "rest", "z.k").agg(F.array_sort(F.collect_list("z.at")).alias("ats"))
        name = F.concat(F.lit("{"), F.array_join(F.transform("ats", lambda x: F.replace(x, F.lit("|"), F.lit("||"))), "|"), F.lit("}"))
        names = materialize(named.filter(F.size("ats") > 1).select("host", "rest", name.alias("name"), F.explode("ats").alias("at")))
        if not names.isEmpty():
            here = rows.withColumns({"rest": swap(F.lit("")), "at": F.when(at.startswith("="), F.substring(at, 2, 1 << 30))})
            rows = materialize(join_keyed(here, names, ["host", "rest", "at"], "left").withColumn("branch", F.when(F.col("name").isNull(), F.col("branch")).otherwise(swap(F.col("name")))).drop("rest", "at", "name"))
    return rows


def purities(rows: DataFrame, prior: float, strength: float) -> DataFrame:
    """Append purity and the labelled addresses `below` each branch's node; smoothed from the corpus down, each node without what is below the next."""
    depth = rows.agg(F.max(F.size("branch"))).first()[0] or 0
    rows = rows.withColumn("__at", F.array().cast("array<struct<n:double,g:double>>"))
    for level in range(depth + 1):
        node = F.when(F.size("branch") >= level, F.slice("branch", 1, level) if level else F.array().cast("array<string>"))
        rows = rows.withColumn("__node", node)
        sums = rows.filter("__node is not null").groupBy("host", "__node").agg(F.struct(F.sum("labelled").cast("double").alias("n"), F.sum("good").cast("double").alias("g")).alias("__c"))
        rows = join_keyed(rows, materialize(sums), ["host", "__node"], "left")
        rows = materialize(rows.withColumn("__at", F.when(F.col("__c").isNull(), F.col("__at")).otherwise(F.array_append("__at", F.col("__c")))).drop("__node", "__c"))
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("g"))
    rest = F.transform("__at", lambda c, i: F.struct((c["n"] - F.coalesce(F.get("__at", i + 1), none)["n"]).alias("n"), (c["g"] - F.coalesce(F.get("__at", i + 1), none)["g"]).alias("g")))
    smooth = F.aggregate(rest, F.lit(float(prior)), lambda p, c: (c["g"] + F.lit(strength) * p) / (c["n"] + F.lit(strength)))
    return rows.withColumns({"purity": smooth, "below": F.element_at("__at", -1)["n"]}).drop("__at")


def judge(pages: DataFrame, good: Column | str, url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES, min_support: int = 8, min_share: float = 0.01, merge_z: float = 1.96, strength: float = 2.0, z: float = 2.33) -> DataFrame:
    """Append host, path, rule, template, purity and verdict. good: a boolean of the page (null: not labelled)."""
    made = ("host", "path", "rule", "template", "purity", "verdict")
    good = F.col(good) if isinstance(good, str) else good
    keep = [c for c in pages.columns if c.lower() not in made]
    rows = pages.withColumn("__good", good).select(*[F.col(f"`{c}`") for c in keep], "__good", host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"))
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count("__good").alias("labelled"), F.sum(F.coalesce(F.col("__good").cast("int"), F.lit(0))).alias("good"))
    known, literals = learn(paths, min_support, min_share)
    stats = materialize(known.groupBy("host", "__template").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good")))
    totals = stats.agg(F.sum("labelled"), F.sum("good")).first()
    prior = totals[1] / totals[0] if totals[0] else 1.0
    upper = F.col("purity") + F.lit(z) * F.sqrt(F.col("purity") * (1 - F.col("purity")) / (F.col("below") + F.lit(strength)))
    judged = purities(merge_branches(stats, merge_z), prior, strength).select("host", "__template", "purity", (upper < F.lit(float(prior))).alias("__bad"))
    out = join_keyed(templates(rows, literals), materialize(judged), ["host", "__template"], "left")
    shown = F.concat(F.lit("/"), F.array_join(F.transform("__template", lambda s: F.when(s.startswith("="), F.substring(s, 2, 1 << 30)).otherwise(s)), "/"))
    out = out.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("__bad"), "block").otherwise("allow"))
    return out.select(*[F.col(f"`{c}`") for c in keep if c != "__good"], "host", "path", F.col("__rule.rule").alias("rule"), shown.alias("template"), "purity", verdict.alias("verdict"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Append good: that of the document whose number ends the path (of quality and not toxic); null without number or label."""
    marks = labels.filter(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("__doc")).agg(F.min((F.col("quality") == 1) & ~F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("good"))
    doc = F.expr(r"try_cast(regexp_extract(url, '/([0-9]{1,18})(?:[.][a-z]+)?/?(?:[?#].*)?$', 1) AS BIGINT)")
    rows = pages.withColumn("__doc", doc)
    # most addresses may have no number: they meet no label, and stay out of the join; labels are those that pages name
    named = rows.filter("__doc is not null")
    asked = materialize(named.groupBy("__doc").agg(F.count(F.lit(1)).alias("__n")).join(marks, "__doc", "left"))
    return join_counted(named, asked, ["__doc"], "__n").unionByName(rows.filter("__doc is null"), allowMissingColumns=True).drop("__doc")


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """Pages are labelled through the document number that ends their path: good if of quality and not toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rows = labelled_pages(pages, table(spark, sf_dir, "labels"))
    return judge(rows, "good").select("page_id", "host", "path", "rule", "verdict", "template", "purity")
