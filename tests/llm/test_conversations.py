import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stopwise.llm import conversations as c

from .helpers import SF

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
ALLOWED = re.compile(r"(s?(ua)+)?")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if h == 3 else 1)
    return out


def after(state, initial):
    """The state behind a row, or None: 0 nothing, 1 system, 2 user, 3 assistant."""
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, initial))


def brute_repair(rows):
    """Forward over all states, keeping the cheapest and then ASCII-least audit: (cost, audit, repaired rows)."""

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, new) in list(best.items()):
                for role in ("user", "assistant"):
                    s = after(state, role[0])
                    put(best, s, cost + 3, audit + "I", [*new, f"{role}:"])
        return best

    def put(best, state, cost, audit, new):
        if state is not None and (state not in best or (cost, audit) < best[state][:2]):
            best[state] = (cost, audit, new)

    best = inserted({0: (0, "", [])})
    for role, text, kind in rows:
        now = {}
        for state, (cost, audit, new) in best.items():
            put(now, state, cost + 4, audit + "D", new)
            if kind not in ("blank", "duplicate"):
                more = 3 * (kind == "truncated")
                put(now, after(state, role[:1]), cost + more, audit + "K", [*new, f"{role}:{text}"])
                for other in ("user", "assistant"):
                    put(now, after(state, other[0]), cost + 3 + more, audit + "R", [*new, f"{other}:{text}"])
        best = inserted(now)
    cost, audit, new = min((best[s][0], best[s][1], best[s][2]) for s in (0, 3) if s in best)
    assert ALLOWED.fullmatch("".join(x[0] for x in new))
    return cost, audit, new


def brute(rows, damaged=True):
    """conv_id -> all columns."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in (brute_damage(rows) if damaged else rows) if r[0] == conv]
        own = [(t, " " if role is None else role, " " if text is None else text) for _, t, role, text in own]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, kinds = set(), []
        for _, role, text in own:
            bare = text.rstrip(SPACE)
            kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, new = brute_repair([(role, text, kind) for (_, role, text), kind in zip(own, kinds, strict=True)])
        sha = hashlib.sha256("\n".join(new).encode("utf-8", "surrogatepass")).hexdigest()
        out[conv] = (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, sha)
    return out


def _query(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    got = c.op13_conversation_repair(spark, str(tmp_path)).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in c.op13_conversation_repair(spark, SF.replace("0.001", "0.01")).collect()}
    assert got == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = [
        (None, None, None, None), (None, 1, "user", "A row."), (1, None, "user", None), (1, 0, None, "x"), (1, 0, "", "y."),
        (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 9, "user", "same."), (2, 9, "tool", "z!"), (2, 2, "system", "w?"),
        (3, 1, "system", "only."), (4, 1, "assistant", "ends. \x0b"), (5, 7, "user", "long " * 30_000 + "end."), (5, 8, "assistant", "ünï 😀?"),
    ]
    assert _query(spark, rows, tmp_path) == brute(rows)


def test_no_rows(spark, tmp_path):
    assert _query(spark, [], tmp_path) == {}


@pytest.mark.parametrize(("chunk", "group"), [(1, 80), (3, 4), (256, 4096)])
def test_long_conversations(spark, chunk, group):
    rng = random.Random(chunk)
    rows = []
    for conv in range(20):
        for turn in range(rng.choice([0, 1, 2, 9, 30, 60])):
            rows += [(conv, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant", "user", "assistant", "system", "odd"]), rng.choice(["Yes.", "", "No", f"Text {turn}.", f"Cut {turn}", f"Text {turn % 7}!"]))] * rng.choice([1, 1, 1, 2])
    rows += [(99, t, "user", " ") for t in range(25)] + [(99, 500, "assistant", "End.")]  # nothing here makes vectors converge
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, damaged=False)
    got = {int(r.k[1:]): (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in c.repair(frame, chunk, group).collect()}
    assert got == want
    back = {}
    for r in sorted(c.repaired(frame, chunk, group).collect(), key=lambda r: (r.k, r.piece, r.place)):
        back.setdefault(int(r.k[1:]), []).append(f"{r.role}:{r.text}")
    for conv, row in want.items():
        assert hashlib.sha256("\n".join(back.get(conv, [])).encode()).hexdigest() == row[-1]


def test_extra_columns(spark):
    frame = spark.createDataFrame([(1, 1, "user", "A."), (1, 2, "assistant", "B.")], SCHEMA).withColumns({"k": F.lit("z"), "n": F.lit(9), "code": F.lit("q")})
    row = c.repair(frame).first()
    assert (row.cost, row.audit, row.illegal) == (0, "KK", 0)
