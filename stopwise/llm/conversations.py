"""Structure repair of conversations: the cheapest edits that make their roles alternate, by rank-convergence parallel Viterbi.

Role initials of a repaired conversation follow `(s?(ua)+)?`. Four states tell how far a prefix has come (nothing
yet, after the system's row, after a user's, after an assistant's); a row is kept, gets another role or goes,
and rows without text may be put in anywhere.

Chunks. Rows, copies counted, are sorted by ranges over all tasks (conversation, turn, role, text), so a long conversation
spreads; a task cuts what it has of each conversation into chunks of at most `CHUNK` rows. A conversation in one chunk
is done there and then. For the others costs run backward: every chunk starts from a speculative cost vector at
its right end (the last one from the true one); fix-up passes run a chunk again from the vector that its right
neighbour gave, where that differs from the one used by more than a constant. A task brings up to `GROUP` neighbouring chunks in
line at once, so passes are as many as groups in a row that don't converge, at worst. Costs of a few rows usually force all
states through one row, so vectors soon differ by constants only, whose sum over the chunks is the cost. Then
the least audit is traced forward: at each row the ASCII-least edit that the backward costs allow, first from all four
states a chunk may be entered in, then, with the states stitched, from the true one.

Defined cases: a null role or text is one space; a null turn comes first; rows of one turn are ordered by role,
then text; equal rows (same conversation, turn, role, text) are kept as one with a count, each counts; a null
conversation is one of its own; an empty table gives an empty result; a role whose first character is none of s, u, a
fits nowhere and is changed or deleted; very long texts stay whole in a chunk of their own; other columns are left out.
SHA-256 has no parallel form: the repaired text of one conversation is hashed as a stream by one task, which holds a chunk at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, materialize, slices, table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
CHUNK, CHUNK_BYTES = 256, 4 << 20
#: Neighbouring chunks (without texts) that one task brings in line in a pass.
GROUP = 4096
_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 40
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state that a row of the only fitting new role leads to, and that role.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = ("user", "user", "assistant", "user")
#: By initial (s, u, a, others) and state: the state after keeping the row (-1: it doesn't fit).
_KEEP = ((_SYSTEM, -1, -1, -1), (_USER, _USER, -1, _USER), (-1, -1, _ASSISTANT, -1), (-1, -1, -1, -1))


def _closure() -> np.ndarray:
    """Costs from state to state by inserted rows alone."""
    out = np.full((4, 4), _FAR, np.int64)
    for i in range(4):
        at, cost = i, 0
        while cost < out[i, at]:
            out[i, at] = cost
            at, cost = _NEXT[at], cost + INSERT
    return out


def _edits(code: int) -> np.ndarray:
    """Costs from state to state by the edits of one row. Code: 3 times the initial's number, plus 1 (truncated) or 2 (to be deleted)."""
    initial, kind = divmod(code, 3)
    out = np.full((4, 4), _FAR, np.int64)
    for i in range(4):
        out[i, i] = DELETE
        if kind < 2:
            out[i, _NEXT[i]] = min(out[i, _NEXT[i]], REROLE + kind * TRUNCATED)
            if _KEEP[initial][i] >= 0:
                out[i, _KEEP[initial][i]] = min(out[i, _KEEP[initial][i]], kind * TRUNCATED)
    return out


_INSERTS = _closure()
#: Inserted rows, then the row, by code; the last one, for padding, changes nothing.
_STEP = np.stack([*[(_INSERTS[:, :, None] + _edits(c)[None]).min(axis=1) for c in range(12)], np.where(np.eye(4, dtype=bool), 0, _FAR)])
#: Cost of ending in each state.
END = _INSERTS[:, [_START, _ASSISTANT]].min(axis=1)


def backward(codes: list[np.ndarray], copies: list[np.ndarray], right: np.ndarray) -> np.ndarray:
    """Cost vectors before each row of several chunks at once, [row, chunk, state]; right: the vectors behind their last rows.

    Chunks are padded in front, so all end in the last row of the result. Copies of a row beyond the first are deletions.
    """
    most = max(map(len, codes), default=0)
    out = np.empty((most + 1, len(codes), 4), np.int64)
    code = np.full((len(codes), most), 12)
    more = np.zeros((len(codes), most), np.int64)
    for i, (c, n) in enumerate(zip(codes, copies, strict=True)):
        code[i, most - len(c) :] = c
        more[i, most - len(c) :] = (n - 1) * DELETE
    out[most] = right
    for t in range(most - 1, -1, -1):
        out[t] = (_STEP[code[:, t]] + out[t + 1][:, None, :]).min(axis=2) + more[:, t, None]
    return out


def trace(codes: np.ndarray, copies: np.ndarray, costs: np.ndarray, state: int, last: bool) -> tuple[str, list[tuple[str | None, int]], int]:
    """The least audit through one chunk from a state: (edits' initials, new rows as (new role or None, row or -1), state behind).

    costs: [row, state], the vectors of `backward`. last: inserted rows may follow the last row.
    """
    audit: list[str] = []
    rows: list[tuple[str | None, int]] = []
    for t in range(len(codes)):
        initial, kind = divmod(int(codes[t]), 3)
        more = (int(copies[t]) - 1) * DELETE
        ahead = costs[t + 1] + more
        left = int(costs[t][state])
        while True:
            if left == DELETE + ahead[state]:
                audit.append("D")
            elif left == INSERT + (nearer := _before(codes[t], ahead)[_NEXT[state]]):
                audit.append("I")
                rows.append((_ROLE[state], -1))
                state, left = _NEXT[state], int(nearer)
                continue
            elif kind < 2 and _KEEP[initial][state] >= 0 and left == kind * TRUNCATED + ahead[_KEEP[initial][state]]:
                audit.append("K")
                rows.append((None, t))
                state = _KEEP[initial][state]
            else:
                audit.append("R")
                rows.append((_ROLE[state], t))
                state = _NEXT[state]
            break
        audit.append("D" * (int(copies[t]) - 1))
    while last and state in (_SYSTEM, _USER):
        audit.append("I")
        rows.append((_ROLE[state], -1))
        state = _NEXT[state]
    return "".join(audit), rows, state


def _before(code: int, ahead: np.ndarray) -> np.ndarray:
    return (_STEP[code] + ahead).min(axis=1)


_CHUNKS = "k string, pid int, sub int, whole boolean, codes binary, copies array<bigint>, roles array<string>, texts array<string>"


def _chunks(most: int):
    """Over sorted rows (k, pid, role, text, n, code): chunks of at most so many rows. whole: the chunk is neither cut nor at an end of the partition, so it is all of its conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "pid", "sub", "whole", "codes", "copies", "roles", "texts"]
        done: list[list] = []
        now: str | None = None
        pid = sub = size = 0
        held: list[tuple] = []
        first = True  # of the partition's conversations

        def flush(ends: bool) -> None:
            nonlocal held, size, sub
            codes, copies, roles, texts = zip(*held, strict=True)
            done.append([now, pid, sub, ends and sub == 0 and not first, bytes(codes), list(copies), list(roles), list(texts)])
            held, size, sub = [], 0, sub + 1

        def batch() -> pa.RecordBatch:
            types = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)
            done.clear()
            return out

        for part in slices(batches):
            for k, p, role, text, n, code in zip(*[part.column(c).to_pylist() for c in ("k", "pid", "role", "text", "n", "code")], strict=True):
                if k != now:
                    if held:
                        flush(True)
                    if now is not None:
                        first = False
                    now, pid, sub = k, p, 0
                elif len(held) >= most or size + len(text) > CHUNK_BYTES:
                    flush(False)
                held.append((code, n, role, text))
                size += len(text)
            if len(done) >= 256:
                yield batch()
        if held:
            flush(False)  # the next partition may go on with it
        if done:
            yield batch()

    return run


def _arrays(part: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return [np.frombuffer(c, np.uint8) for c in part.column("codes").to_pylist()], [np.array(c, np.int64) for c in part.column("copies").to_pylist()]


def _fixed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Fill in used and out for a group of neighbouring chunks of one conversation: `right` is the vector behind the last of them (null: not known yet).

    Without vectors so far all chunks start from zeros, at once; then, from right to left, those are run again whose right neighbour gave another vector.
    """
    pdf = pdf.sort_values("idx").reset_index(drop=True)
    codes, copies = [np.frombuffer(c, np.uint8) for c in pdf["codes"]], [np.array(c, np.int64) for c in pdf["copies"]]
    if pdf["out"][0] is None:
        used = np.zeros((len(pdf), 4), np.int64)
        out = backward(codes, copies, used)[0]
    else:
        used, out = (np.array(pdf[c].tolist(), np.int64) for c in ("used", "out"))
    came = END if pdf["last"].iloc[-1] else pdf["right"].iloc[-1]
    for i in range(len(pdf) - 1, -1, -1):
        if came is not None and ((came := np.array(came, np.int64)) - came[0] != used[i] - used[i][0]).any():
            used[i] = came
            out[i] = backward([codes[i]], [copies[i]], came[None])[0][0]
        came = out[i]
    return pdf.assign(used=used.tolist(), out=out.tolist(), right=None)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, idx, exits): the state behind a chunk for each state it may be entered in."""
    for part in slices(batches):
        codes, copies = _arrays(part)
        costs = backward(codes, copies, np.array(part.column("used").to_pylist(), np.int64).reshape(-1, 4))
        exits = [[trace(c, n, costs[len(costs) - 1 - len(c) :, i], s, False)[2] for s in range(4)] for i, (c, n) in enumerate(zip(codes, copies, strict=True))]
        yield pa.RecordBatch.from_arrays([part.column("k"), part.column("idx"), pa.array(exits, pa.list_(pa.int32()))], names=["k", "idx", "exits"])


def _entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """States in which the chunks of one conversation are entered (a few bytes for a chunk)."""
    pdf = pdf.sort_values("idx")
    state, entry = _START, []
    for exits in pdf["exits"]:
        entry.append(state)
        state = int(exits[state])
    return pdf.assign(entry=entry)[["k", "idx", "entry"]]


_TRACED = "k string, idx int, ends string, illegal bigint, cost bigint, audit string, roles array<string>, texts array<string>"


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks (k, idx, entry, last, used, cost, codes, copies, roles, texts) to repaired pieces. ends: the first and last initial's numbers; cost: that of the first chunk."""
    for part in slices(batches):
        codes, copies = _arrays(part)
        costs = backward(codes, copies, np.array(part.column("used").to_pylist(), np.int64).reshape(-1, 4))
        rest = {c: part.column(c).to_pylist() for c in ("entry", "last", "roles", "texts", "cost", "idx")}
        out: list[list] = [[], [], [], [], [], []]
        for i, (c, n) in enumerate(zip(codes, copies, strict=True)):
            own = costs[len(costs) - 1 - len(c) :, i]
            audit, rows, _ = trace(c, n, own, rest["entry"][i], rest["last"][i])
            initial = "".join("suax"[x // 3] for x in c)
            illegal = int((n - 1).sum()) + sum(not _legal(a + b) for a, b in zip(initial, initial[1:], strict=False))
            cost = rest["cost"][i] if rest["cost"][i] is not None else int(own[0][_START]) if rest["idx"][i] == 0 else 0
            roles, texts = rest["roles"][i], rest["texts"][i]
            for column, value in zip(out, (initial[0] + initial[-1], illegal, cost, audit, [role or roles[t] for role, t in rows], [texts[t] if t >= 0 else "" for _, t in rows]), strict=True):
                column.append(value)
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
        made = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("k"), part.column("idx"), *made], names=["k", "idx", "ends", "illegal", "cost", "audit", "roles", "texts"])


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


_REPORT = "k string, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one row for each conversation."""
    done: list[tuple] = []
    now: str | None = None
    digest, some, before, illegal, cost = hashlib.sha256(), False, "", 0, 0
    audit: list[str] = []

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["k", "illegal", "cost", "audit", "repaired_sha256"])
        done.clear()
        return out

    for part in slices(batches):
        for k, ends, bad, spent, edits, roles, texts in zip(*[part.column(c).to_pylist() for c in ("k", "ends", "illegal", "cost", "audit", "roles", "texts")], strict=True):
            if k != now:
                if now is not None:
                    done.append((now, illegal, cost, "".join(audit), digest.hexdigest()))
                now, digest, some, before, illegal, cost, audit = k, hashlib.sha256(), False, "", 0, 0, []
            illegal += bad + (before != "" and not _legal(before + ends[0]))
            before, cost = ends[-1], cost + spent
            audit.append(edits)
            for role, text in zip(roles, texts, strict=True):
                digest.update(("\n" * some + role + ":" + text).encode("utf-8", "surrogatepass"))
                some = True
        if len(done) >= 4096:
            yield batch()
    if now is not None:
        done.append((now, illegal, cost, "".join(audit), digest.hexdigest()))
    if done:
        yield batch()


def _key(c: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))


def _rows(df: DataFrame) -> DataFrame:
    """Distinct rows (k, turn, role, text) with their number n, code and faults."""
    given = df.select(_key(F.col("conv_id")).alias("k"), "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    own = materialize(given.groupBy("k", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("d", F.unhex(F.sha2(F.concat_ws("\u0000", "role", "text"), 256))))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = materialize(own.groupBy("k", "d").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("m")))
    rows = join_counted(own, firsts, ["k", "d"], "m")
    last = F.right(F.rtrim(F.col("text"), F.lit(_SPACE)), F.lit(1))
    rows = rows.withColumns({"blank": last == "", "again": ~place.eqNullSafe(F.col("first")), "cut": ~last.isin(".", "!", "?")})
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = F.when(F.col("blank") | F.col("again"), 2).when(F.col("cut"), 1).otherwise(0)
    faults = {
        "n_blank": F.when(F.col("blank"), F.col("n")).otherwise(0),
        "n_again": F.when(F.col("blank"), 0).when(F.col("again"), F.col("n")).otherwise(F.col("n") - 1),
        "n_cut": F.when(kind == 1, 1).otherwise(0),
    }
    return materialize(rows.withColumns(faults).withColumn("code", (number * 3 + kind).cast("int")).select("k", "turn", "role", "text", "n", "code", *faults))


def _normal(c: str) -> Column:
    return F.transform(F.col(c), lambda x: x - F.col(c)[0])


def _pieces(rows: DataFrame, chunk_rows: int, group: int) -> tuple[DataFrame, DataFrame]:
    """Repaired pieces (k, idx, ends, illegal, cost, audit, roles, texts): of conversations in one chunk, and of the others."""
    order = [F.col("k"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("k", F.spark_partition_id().alias("pid"), "role", "text", "n", "code")
    chunks = materialize(cut.mapInArrow(_chunks(chunk_rows), _CHUNKS))
    long = lambda v: F.array(*[F.lit(int(x)).cast("bigint") for x in v])
    alone = chunks.filter("whole").select("k", F.lit(0).alias("idx"), F.lit(0).alias("entry"), F.lit(True).alias("last"), long(END).alias("used"), F.lit(None).cast("bigint").alias("cost"), "codes", "copies", "roles", "texts")
    w = Window.partitionBy("k").orderBy("pid", "sub")
    slim = chunks.filter("not whole").select("k", "pid", "sub", "codes", "copies", (F.row_number().over(w) - 1).alias("idx"), F.lead("sub").over(w).isNull().alias("last"))
    none = F.lit(None).cast("array<bigint>")
    state = slim.withColumns({"g": F.floor(F.col("idx") / group).cast("int"), "used": none, "out": none, "right": none})
    names, schema = state.columns, state.schema.simpleString()[7:-1]
    state = materialize(state.groupBy("k", "g").applyInPandas(_fixed, schema))
    while not state.filter("g > 0").isEmpty():  # of one group: all is known
        came = state.filter(F.col("idx") == F.col("g") * group).select("k", (F.col("g") - 1).alias("g"), F.col("out").alias("came"))
        ends = state.filter(F.col("idx") == (F.col("g") + 1) * group - 1).select("k", "g", "used")
        stale = materialize(ends.join(came, ["k", "g"]).filter(_normal("came") != _normal("used")).select("k", "g", "came"))
        if stale.isEmpty():
            break
        met = state.join(stale, ["k", "g"], "left").withColumn("right", F.col("came"))
        again = met.filter("came is not null").select(*names).groupBy("k", "g").applyInPandas(_fixed, schema)
        state = materialize(met.filter("came is null").select(*names).unionByName(again))
    # what a chunk's own numbers lack is a constant: the sum of these is the cost
    ahead = F.lead("out").over(Window.partitionBy("k").orderBy("idx"))
    costs = state.withColumn("came", ahead).select("k", "idx", "used", (F.when(F.col("idx") == 0, F.col("out")[0]).otherwise(0) + F.coalesce(F.col("came")[0] - F.col("used")[0], F.lit(0))).alias("cost"))
    exits = state.mapInArrow(_exits, "k string, idx int, exits array<int>")
    entries = exits.groupBy("k").applyInPandas(_entries, "k string, idx int, entry int")
    known = state.select("k", "pid", "sub", "idx", "last").join(entries, ["k", "idx"]).join(costs, ["k", "idx"])
    others = chunks.filter("not whole").select("k", "pid", "sub", "codes", "copies", "roles", "texts").join(known, ["k", "pid", "sub"]).select(*alone.columns)
    return alone.mapInArrow(_traced, _TRACED), others.mapInArrow(_traced, _TRACED)


def repair(df: DataFrame, chunk_rows: int = CHUNK, group: int = GROUP) -> DataFrame:
    """One row for each conv_id of df (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Of each row the first fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated (no
    full stop, exclamation or question mark at the end). A row: keep (0), change its role to user or assistant (3), delete
    (4; a must for blank and duplicate ones); insert a row anywhere (3); truncated rows that stay cost 3 more.
    """
    rows = _rows(df)
    by_turn = rows.groupBy("k", "turn").agg(*[F.sum(c).alias(c) for c in ("n_blank", "n_again", "n_cut")])
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = by_turn.groupBy("k").agg(F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"), *[F.sum(c).alias(n) for c, n in (("n_blank", "blank"), ("n_again", "duplicate"), ("n_cut", "truncated"))])
    alone, others = _pieces(rows, chunk_rows, group)
    reports = alone.mapInArrow(_reports, _REPORT).unionByName(others.repartition("k").sortWithinPartitions("k", "idx").mapInArrow(_reports, _REPORT))
    return counts.join(reports, "k")


def repaired(df: DataFrame, chunk_rows: int = CHUNK, group: int = GROUP) -> DataFrame:
    """The rows of the repaired conversations: k ('v' and the conversation's id, 'n' for null), piece and place (their order), role, text."""
    alone, others = _pieces(_rows(df), chunk_rows, group)
    both = alone.unionByName(others).select("k", F.col("idx").alias("piece"), F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "r"))
    return both.select("k", "piece", "place", F.col("r.roles").alias("role"), F.col("r.texts").alias("text"))


def damage(df: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text; nulls of role and text, and in the hashed text, are one space) damaged by crc32 of `conv_id:turn` modulo 20."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), h.alias("h")).filter("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("h") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair(damage(given))
    ids = given.select("conv_id").distinct().withColumn("k", _key(F.col("conv_id")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    out = ids.join(found, "k", "left").select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), "audit", "repaired_sha256")
    return out.withColumns({"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest()))})
