"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds.

Generators of high recall propose spans, which may overlap: the base kinds (email, ip, card, phone) by
their fixed patterns and checks, and credentials (`secret`), identity numbers (`number`) and spelled-out
addresses (`spelled`) by wide patterns. Base spans that pass their check always stay, those that fail go. The
other proposals are decided by gradient-boosted trees alone, over binned features of the span's format (length, shares
of digits and capitals, changes between classes of characters, groups, repeats) and context (characters around it,
whether the word before is a credential, an identity or any other word): a span is selected where its score reaches
its kind's threshold, the lowest score bin from which on a lower bound of the share of true proposals, on those set
aside, reaches `precision`. A kind's share is smoothed towards that of all kinds together, so a rare kind has a
threshold too. `proposals` gives each proposal with its score, taken or refused.

Training needs no span labels. A proposal counts as true by a check that needs no words and is not among the
features: for a `secret` the information in its characters (length times entropy) without long runs of letters as words
have, for a `number` the checksum of an account or bank number or the assigned ranges of identity and telephone
numbers, for `spelled` a last part that plain addresses of the corpus end in. Trees grow level by level; each level
is one aggregation over the table of distinct feature vectors with counts, which is grouped and written at full
width, and what comes to the driver is one row per tree node, feature and bin. All documents count; every fifth, by
hashed id and length of text, is set aside for thresholds.

Everything runs as DataFrame functions. Patterns are written with possessive repeats and anchored starts,
so that very long runs take linear time, and give the same matches as the plain ones. Texts dense with spans
take time in proportion to their number, but for the copies that running sums make (in blocks of its root):
positions and reaches are running sums and maxima, and pieces of text come from blocks of 256 characters. Spans
leave through a generator of one row, so that a filter on them, or an explode, is not copied into their making.

Defined cases: null text is the empty one, without spans; repeated rows get the same spans; very long texts
are read whole; of equal starts a base span goes before the others, and a proposal that one base span covers adds
nothing; without proposals nothing is trained and only base spans remain; empty tables give
an empty result; extra columns pass through, input columns with the name of a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_keyed, materialize, table

BASE = ("email", "ip", "card", "phone")
MORE = ("secret", "number", "spelled")
KINDS = (*BASE, *MORE)

# Fixed patterns. A match of the plain form starts at the first character of a run, or where the last match ended.
_LOCAL = "A-Za-z0-9._%+-"
_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?=[0-9](?:[ -]?[0-9]){11})[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{0,64}[0-9])[A-Za-z0-9+/_-]{12,}+={0,2}+",
    "number": r"(?<![A-Za-z0-9])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{9,11})(?![A-Za-z0-9])",
    "spelled": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,32} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{2,32} ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,12}(?![A-Za-z])",
}
#: Text that must be there for a pattern to match at all: a cheap test before the pattern runs.
_NEEDS = {"email": "@", "phone": "+", "spelled": "dot"}
# Words in front, for a feature.
_CREDENTIAL_WORD = r"(?i)(?:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key|bearer|auth)[\"' ]{0,2}[=:]? ?[\"']?$"
_IDENTITY_WORD = r"(?i)(?:ssn|social security|passport|iban|account|acct|tel|phone|fax|mobile)[a-z.:# ]{0,12}$"
_CONTEXT = 24
_BLOCK = 256


def _scan(values: Column, start: Column, join) -> Column:
    """For each entry what start and the entries before it come to."""
    zero = F.struct(start.cast("long").alias("s"), F.array().cast("array<bigint>").alias("a"))
    return F.aggregate(values, zero, lambda acc, x: F.struct(join(acc["s"], x).alias("s"), F.array_append(acc["a"], acc["s"]).alias("a")), lambda acc: acc["a"])


def _running(values: Column, join) -> Column:
    """For each entry what the entries before it come to (0 at the first), for sums or maxima of longs.

    In blocks of about the root of their number, as appending copies an array. values: a column of its
    own, since an expression would be evaluated again for each block.
    """
    n = F.size(values)
    step = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil((n / step).cast("double")).cast("int") - 1, F.lit(0))), lambda k: F.slice(values, k * step + 1, step))
    starts = _scan(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), join)), F.lit(0), join)
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), starts.alias("s")), lambda z: _scan(z["b"], z["s"], join)))


def _sealed(df: DataFrame, made: dict[str, Column], gone: Sequence[str] = ()) -> DataFrame:
    """Add columns through a generator of one row: the optimiser doesn't put their expressions into what uses them."""
    keep = [c for c in df.columns if c not in made and c not in gone]
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(F.struct(*[v.alias(n) for n, v in made.items()]))))


def _sum(x: Column, y: Column) -> Column:
    return x + y


def _most(x: Column, y: Column) -> Column:
    return F.greatest(x, y)


def _blocks(text: Column, wanted: Column) -> Column:
    """The text in pieces of 256 characters, where it is wanted."""
    return F.when(wanted, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _cut(blocks: Column, a: Column, b: Column) -> Column:
    """The characters from a to before b, from a text's blocks."""
    at = lambda x: F.floor(x / _BLOCK).cast("int")
    off = lambda x: (x - at(x) * _BLOCK).cast("int")
    long = F.concat(
        F.substring(F.get(blocks, at(a)), off(a) + 1, F.lit(_BLOCK)),
        F.array_join(F.slice(blocks, at(a) + 2, F.greatest(at(b) - at(a) - 1, F.lit(0))), ""),
        F.coalesce(F.substring(F.get(blocks, at(b)), F.lit(1), off(b)), F.lit("")),
    )
    return F.coalesce(F.when(at(a) == at(b), F.substring(F.get(blocks, at(a)), off(a) + 1, (b - a).cast("int"))).otherwise(long), F.lit(""))


def _spans_of(df: DataFrame, kinds: Sequence[str], text: str) -> DataFrame:
    """Add columns __m_<kind>: arrays of (start, end, match), in code points, end exclusive; for each pattern's matches, left to right. And __blocks, the text's blocks where it has matches."""
    none = F.array().cast("array<string>")
    matches = {}
    for k in kinds:
        found = F.regexp_extract_all(F.col(text), F.lit(_PATTERNS[k]), F.lit(0))
        matches[f"__f_{k}"] = F.when(F.contains(F.col(text), F.lit(_NEEDS[k])), found).otherwise(none) if k in _NEEDS else found
    df = df.withColumns(matches)
    some = F.greatest(*[F.size(m) for m in matches], F.lit(0)) > 0
    df = df.withColumns({f"__p_{k}": F.when(F.size(f"__f_{k}") > 0, F.split(F.col(text), _PATTERNS[k], -1)).otherwise(none) for k in kinds} | {"__blocks": _blocks(F.col(text), some)})
    # each in a column of its own, see _running
    df = df.withColumns({f"__n_{k}": F.zip_with(F.slice(F.col(f"__p_{k}"), F.lit(1), F.size(f"__f_{k}")), F.col(f"__f_{k}"), lambda p, m: (F.length(p) + F.length(m)).cast("long")) for k in kinds})
    empty = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    out = {}
    for k in kinds:
        starts = F.zip_with(_running(F.col(f"__n_{k}"), _sum), F.slice(F.col(f"__p_{k}"), F.lit(1), F.size(f"__f_{k}")), lambda s, p: s + F.length(p))
        spans = F.zip_with(starts, F.col(f"__f_{k}"), lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("match")))
        out[f"__m_{k}"] = F.when(F.size(f"__f_{k}") > 0, spans).otherwise(empty)
    return _sealed(df, out, [*matches, *[f"__p_{k}" for k in kinds], *[f"__n_{k}" for k in kinds]])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    """Whether a string of at least one digit passes the checksum."""
    n = F.length(d)

    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, n - i + 1, F.lit(1)).cast("int")
        twice = x * 2
        return acc + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) < 3) | (F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255"))
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _iban(m: Column) -> Column:
    """Whether a text has the form of an international account number and passes its checksum (mod 97)."""
    bare = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))

    def add(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return (acc * F.when(c < 58, 10).otherwise(100) + F.when(c < 58, c - 48).otherwise(c - 55)) % 97

    return F.when(F.rlike(bare, F.lit("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$")), F.aggregate(F.sequence(F.lit(1), F.length(bare)), F.lit(0), add) == 1).otherwise(False)


def _tag(kind: str) -> Column:
    """The spans of a kind with what scoring needs: kind number and the text around."""
    return F.transform(
        F.col(f"__m_{kind}"),
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            x["end"].alias("end"),
            x["match"].alias("match"),
            _cut(F.col("__blocks"), F.greatest(x["start"] - _CONTEXT, F.lit(0)), x["start"]).alias("before"),
            _cut(F.col("__blocks"), x["end"], x["end"] + 8).alias("after"),
        ),
    )


def _bins(value: Column, cuts: Sequence[float]) -> Column:
    out = F.lit(0)
    for c in cuts:
        out = out + (value >= c).cast("int")
    return out


FEATURES = ("kind", "length", "digits", "capitals", "hex", "changes", "repeats", "groups", "before_mark", "before_word", "after_mark", "dots")


def feature_columns(c: Column) -> list[Column]:
    """Small integers for a tagged span, in the order of FEATURES."""
    m, n = c["match"], F.greatest(F.length(c["match"]), F.lit(1)).cast("double")
    count = lambda p: F.regexp_count(m, F.lit(p))
    share = (0.05, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95)
    last = F.right(c["before"], F.lit(1))
    first = F.left(c["after"], F.lit(1))
    mark = lambda x: F.when(x == "", 0).when(x.isin(" ", "\n", "\t"), 1).when(x.isin('"', "'"), 2).when(x.isin("=", ":", "<", "("), 3).when(F.rlike(x, F.lit("[.,;!?)]")), 4).when(F.rlike(x, F.lit(r"\w")), 5).otherwise(6)
    return [
        c["kind"],
        _bins(n, (9, 12, 14, 16, 18, 20, 24, 28, 33, 40, 41, 64)),
        _bins(count("[0-9]") / n, share),
        _bins(count("[A-Z]") / n, share),
        _bins(count("[0-9a-fA-F]") / n, (0.5, 0.75, 0.9, 1.0)),
        _bins(count("[0-9][A-Za-z]|[A-Za-z][0-9]") / n, (0.01, 0.1, 0.2, 0.3, 0.5)),
        _bins(count(r"(.)\1") / n, (0.05, 0.15, 0.3)),
        _bins(count("[^0-9A-Za-z]+"), (1, 2, 3, 4, 6)),
        mark(last),
        F.when(F.rlike(c["before"], F.lit(_CREDENTIAL_WORD)), 3).when(F.rlike(c["before"], F.lit(_IDENTITY_WORD)), 4).when(F.rlike(c["before"], F.lit(r"[A-Za-z]{3,}\W{1,4}$")), 1).when(F.rlike(c["before"], F.lit(r"[0-9]\W{0,2}$")), 2).otherwise(0),
        mark(first),
        _bins(count(r"\."), (1, 2, 3, 4)),
    ]


def _bits(m: Column) -> Column:
    """Length times the entropy of the characters."""
    n = F.length(m).cast("double")
    share = lambda c: (n - F.length(F.replace(m, c, F.lit("")))) / n
    return n * F.aggregate(F.array_distinct(F.split(m, "")), F.lit(0.0), lambda acc, c: acc + F.when(c == "", 0.0).otherwise(-share(c) * F.log2(share(c))))


def _bank(m: Column) -> Column:
    """Whether nine digits pass the checksum of a bank's number (weights 3, 7, 1)."""
    weight = lambda i: F.when(i % 3 == 1, 3).when(i % 3 == 2, 7).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), F.lit(9)), F.lit(0), lambda acc, i: acc + weight(i) * F.substring(m, i, F.lit(1)).cast("int"))
    return F.when(F.rlike(m, F.lit("^[0-9]{9}$")), total % 10 == 0).otherwise(False)


# Assigned ranges: identity numbers, and telephone numbers of ten digits.
_ASSIGNED = r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
_DIALLED = r"^\(?[2-9][0-8][0-9]\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}$"


def _true(kind: str, m: Column) -> Column:
    """The check of a proposal of kind `secret` or `number`; none of it is a feature."""
    if kind == "secret":
        worded = F.length(m) - F.length(F.regexp_replace(m, "[a-z]{4,}|[A-Z]{4,}", ""))
        return (_bits(m) >= 56) & (worded < 0.4 * F.length(m))
    return F.rlike(m, F.lit(_ASSIGNED)) | F.rlike(m, F.lit(_DIALLED)) | _iban(m) | _bank(m)


def _last_part(m: Column) -> Column:
    return F.lower(F.regexp_extract(m, "([A-Za-z]+)$", 1))


@dataclass
class Model:
    """Trees as (feature, cut, left value or subtree, right value or subtree); bias; threshold per kind (missing: none is selected) with the lower bound of the share of true proposals above it, and their number."""

    bias: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)
    precisions: dict[int, tuple[float, int]] = field(default_factory=dict)

    def margin(self, x: Sequence[Column]) -> Column:
        out = F.lit(self.bias)
        for t in self.trees:
            out = out + _tree(t, x)
        return out


def _tree(t, x: Sequence[Column]) -> Column:
    if isinstance(t, float):
        return F.lit(t)
    f, cut, low, high = t
    return F.when(x[f] <= cut, _tree(low, x)).otherwise(_tree(high, x))


def _leaf_of(t, x: Sequence[Column], name: str = "r") -> Column:
    if isinstance(t, float):
        return F.lit(name)
    f, cut, low, high = t
    return F.when(x[f] <= cut, _leaf_of(low, x, name + "0")).otherwise(_leaf_of(high, x, name + "1"))


def _grow(t, splits: dict, name: str = "r"):
    if isinstance(t, float):
        return splits.get(name, t)
    f, cut, low, high = t
    return (f, cut, _grow(low, splits, name + "0"), _grow(high, splits, name + "1"))


def boost(vectors: DataFrame, rounds: int = 8, depth: int = 3, rate: float = 0.5, l2: float = 1.0, least: float = 5.0) -> Model:
    """Second-order boosting of logistic loss on rows (x0.., pos, neg): distinct feature vectors with counts."""
    x = [F.col(f"x{i}") for i in range(len(FEATURES))]
    n = vectors.agg(F.sum("pos"), F.sum("neg")).first()
    if n[0] is None or not n[0] or not n[1]:
        return Model(bias=0.0 if n[0] is None else 6.0 if n[0] else -6.0)
    model = Model(bias=math.log((n[0] + 1) / (n[1] + 1)))
    for _ in range(rounds):
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-model.margin(x)))
        moved = vectors.withColumn("g", F.col("pos") * (1 - p) - F.col("neg") * p).withColumn("h", (F.col("pos") + F.col("neg")) * p * (1 - p))
        tree = 0.0
        for _level in range(depth):
            sums: dict[str, dict[int, dict[int, tuple[float, float, float]]]] = {}
            flat = moved.select(_leaf_of(tree, x).alias("leaf"), "g", "h", (F.col("pos") + F.col("neg")).alias("c"), F.posexplode(F.array(*x)).alias("f", "v"))
            for r in flat.groupBy("leaf", "f", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("c").alias("c")).collect():
                sums.setdefault(r.leaf, {}).setdefault(r.f, {})[r.v] = (r.g, r.h, r.c)
            splits = {}
            for leaf, by in sums.items():
                best = _best_split(by, rate, l2, least)
                if best:
                    splits[leaf] = best
            if not splits:
                break
            tree = _grow(tree, splits)
        if isinstance(tree, float):
            break
        model.trees.append(tree)
    return model


def _best_split(by: dict, rate: float, l2: float, least: float):
    total = [sum(v[i] for v in by[0].values()) for i in range(3)]
    gain_of = lambda g, h: g * g / (h + l2)
    best, found = 1e-6, None
    for f in sorted(by):
        g = h = c = 0.0
        for v in sorted(by[f])[:-1]:
            g, h, c = g + by[f][v][0], h + by[f][v][1], c + by[f][v][2]
            gain = gain_of(g, h) + gain_of(total[0] - g, total[1] - h) - gain_of(total[0], total[1])
            if gain > best and c >= least and total[2] - c >= least:
                best, found = gain, (f, v, rate * g / (h + l2), rate * (total[0] - g) / (total[1] - h + l2))
    return found


def calibrate(model: Model, vectors: DataFrame, precision: float = 0.9, strength: float = 2.0, z: float = 0.5, floor: float = 0.5) -> Model:
    """Per kind, the lowest twentieth of the score from which on a lower bound of the share of true proposals reaches `precision`.

    No threshold is below `floor`, as a score under a half says false. The share is (true + strength x share of all kinds from that score on) / (number + strength), the bound `z` standard errors below.
    """
    x = [F.col(f"x{i}") for i in range(len(FEATURES))]
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-model.margin(x)))
    rows = vectors.groupBy(x[0].alias("kind"), F.least(F.floor(p * 20), F.lit(19)).cast("int").alias("bin")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()
    for kind in (KINDS.index(k) for k in MORE):
        for low in range(math.ceil(floor * 20), 20):
            above = [r for r in rows if r.bin >= low]
            pos, n = sum(r.pos for r in above if r.kind == kind), sum(r.pos + r.neg for r in above if r.kind == kind)
            pooled = (sum(r.pos for r in above) + 0.5) / (sum(r.pos + r.neg for r in above) + 1)
            share = (pos + strength * pooled) / (n + strength)
            bound = share - z * math.sqrt(share * (1 - share) / (n + strength))
            if bound >= precision:
                model.thresholds[kind], model.precisions[kind] = low / 20, (bound, n)
                break
    return model


def _vectors(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Distinct feature vectors of the proposals of MORE with aside, pos and neg."""
    key = F.concat_ws("|", F.col(f"`{id_col}`").cast("string"), F.length(F.col(f"`{text_col}`")).cast("string"))
    rows = df.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t"), (F.pmod(F.xxhash64(key, F.lit("aside")), F.lit(5)) == 0).alias("aside"))
    rows = _spans_of(rows, ("email", *MORE), "__t")
    none = F.array().cast("array<int>")
    row = lambda x, y, part: F.struct(x.alias("x"), y.alias("y"), part.alias("part"))
    no, no_part = F.lit(None).cast("boolean"), F.lit(None).cast("string")

    def mark(k: str):
        x = lambda c: F.array(*[v.cast("int") for v in feature_columns(c)])
        if k == "spelled":
            return lambda c: row(x(c), no, _last_part(c["match"]))
        return lambda c: row(x(c), _true(k, c["match"]), no_part)

    plain = F.transform(F.array_distinct(F.transform("__m_email", lambda c: _last_part(c["match"]))), lambda part: row(none, no, part))
    each = _sealed(rows, {"__z": F.concat(plain, *[F.transform(_tag(k), mark(k)) for k in MORE])})
    flat = each.select("aside", F.explode("__z").alias("z"))
    counts = materialize(flat.groupBy("aside", "z.x", "z.y", "z.part").agg(F.count(F.lit(1)).alias("n")))
    parts = counts.filter(F.size("x") == 0).select("part").distinct().withColumn("__met", F.lit(True))
    made = counts.filter(F.size("x") > 0)
    spelled = join_keyed(made.filter("y is null"), parts, ["part"], "left").withColumn("y", F.coalesce("__met", F.lit(False))).drop("__met")
    every = made.filter("y is not null").unionByName(spelled)
    sums = [F.sum(F.when(F.col("y") == yes, F.col("n")).otherwise(0)).alias(name) for name, yes in (("pos", True), ("neg", False))]
    return every.groupBy(*[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(len(FEATURES))], "aside").agg(*sums)


def fit(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", precision: float = 0.9) -> Model:
    """Train on the proposals of all documents; every fifth document is set aside for thresholds."""
    grouped = materialize(_vectors(df, text_col, id_col)).persist()
    model = calibrate(boost(grouped.filter("not aside")), grouped.filter("aside"), precision)
    grouped.unpersist()
    return model


def _scored(kind: str, model: Model) -> Column:
    """The proposals of a kind as (start, kind, end, score)."""
    made = F.transform(_tag(kind), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.array(*[v.cast("int") for v in feature_columns(c)]).alias("x")))
    score = lambda c: F.lit(1.0) / (F.lit(1.0) + F.exp(-model.margin([c["x"][j] for j in range(len(FEATURES))])))
    return F.transform(made, lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), c["end"].alias("end"), score(c).alias("score")))


def proposals(df: DataFrame, model: Model, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """A row for each proposal that the trees decide: the columns of df in keep (default all), start, kind, end, score, taken."""
    made = ("start", "kind", "end", "score", "taken")
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    rows = _spans_of(df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t")), MORE, "__t")
    taken = F.lit(False)
    for i, t in model.thresholds.items():
        taken = taken | ((F.col("kind") == i) & (F.col("score") >= t))
    each = _sealed(rows, {"__z": F.concat(*[_scored(k, model) for k in MORE])})
    return each.select(*[F.col(f"`{c}`") for c in keep], F.inline("__z")).withColumn("taken", taken)


def find(df: DataFrame, model: Model, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Append base_spans and spans: arrays of (start, kind, end), ordered; kind is a place in KINDS."""
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("base_spans", "spans")]
    rows = _spans_of(df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t")), KINDS, "__t")
    short = lambda i: lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("kind"), x["end"].alias("end"))
    passes = lambda k: lambda x: _valid(k, x["match"])
    base = F.array_sort(F.concat(*[F.transform(F.filter(F.col(f"__m_{k}"), passes(k)), short(i)) for i, k in enumerate(BASE)]))
    chosen = []
    for k in MORE:
        i = KINDS.index(k)
        none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
        if i not in model.thresholds:
            chosen.append(none)
            continue
        taken = F.filter(_scored(k, model), (lambda t: lambda c: c["score"] >= t)(model.thresholds[i]))
        chosen.append(F.when(F.size(f"__m_{k}") > 0, F.transform(taken, short(i))).otherwise(none))
    rows = rows.select(*[F.col(f"`{c}`") for c in keep], base.alias("base_spans"), F.concat(*chosen).alias("__more"))
    # a chosen span that a base span covers adds nothing: by start, it ends no later than the furthest base span before it
    rows = rows.withColumn("__all", F.array_sort(F.concat("base_spans", "__more")))
    rows = rows.withColumn("__ends", F.transform("__all", lambda x: F.when(x["kind"] < len(BASE), x["end"]).otherwise(F.lit(0).cast("long"))))
    held = F.zip_with("__all", _running(F.col("__ends"), _most), lambda x, far: F.when((x["kind"] < len(BASE)) | (x["end"] > far), x))
    spans = F.when(F.size("__more") > 0, F.filter(held, lambda x: x.isNotNull())).otherwise(F.col("base_spans"))
    return _sealed(rows.select(*[F.col(f"`{c}`") for c in keep], F.col("base_spans").alias("__base"), spans.alias("__spans")), {"base_spans": F.col("__base"), "spans": F.col("__spans")}, ["__base", "__spans"])


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """Replace each span in the text by its kind in angle brackets; of overlapping spans the first goes on to the end of the last."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    text = F.col(f"`{text_col}`")
    rows = df.withColumn("__s", F.array_sort(F.coalesce(F.col(f"`{spans_col}`"), F.array().cast(df.schema[spans_col].dataType))))
    rows = rows.withColumns({"__ends": F.transform("__s", lambda x: x["end"].cast("long")), "__blocks": _blocks(text, F.size("__s") > 0)})
    heads = F.filter(F.zip_with("__s", _running(F.col("__ends"), _most), lambda x, far: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), far.alias("far"))), lambda x: x["start"] >= x["far"])
    parts = F.transform(heads, lambda x: F.concat(_cut(F.col("__blocks"), x["far"], x["start"]), F.element_at(names, x["kind"] + 1)))
    tail = _cut(F.col("__blocks"), F.array_max("__ends"), F.greatest(F.length(text), F.array_max("__ends")))
    out = F.when(text.isNotNull() & (F.size("__s") > 0), F.concat(F.array_join(parts, ""), tail)).otherwise(text)
    return rows.withColumn(text_col, out).drop("__s", "__ends", "__blocks")


def op10_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs), keep=["doc_id"])
    of_kind = lambda i: lambda x: x["kind"] == i
    counts = [F.size(F.filter(F.col("base_spans"), of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
