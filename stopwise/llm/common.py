"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of characters other than space and U+0009 to U+000D (bytes.split() cuts at the same ones).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Where that is unset, a session of one machine takes a temporary folder; a cluster gets an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/stopwise-checkpoints"
    return f"{root.rstrip('/')}/stopwise-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors, keeps column statistics."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in smaller ones: at most so many rows and, but for a single row, so many bytes.

    Spark bounds a batch by bytes (64 MB by default); what is computed from a batch is larger than the
    batch, so the work is bounded here and no setting of the session is touched.
    """
    for b in batches:
        step = max(1, min(rows, int(size * b.num_rows / max(b.nbytes, 1)))) if b.num_rows else 1
        at = 0
        while at < b.num_rows:
            part = b.slice(at, step)
            while part.num_rows > 1 and part.nbytes > 2 * size:  # a very long row among short ones
                part = part.slice(0, (part.num_rows + 1) // 2)
            yield part
            at += part.num_rows


def add_columns(
    df: DataFrame,
    fields: Sequence[T.StructField],
    uses: Sequence[str],
    make: Callable[[], Callable[..., Sequence[pa.Array]]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Append columns computed per Arrow batch.

    make() runs once per task and returns f(*columns named in uses) -> new arrays. keep: columns that go
    on (default all). An input column whose name equals a new one, in any case, gives way to it.
    """
    new = {f.name.lower() for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    extra = [u for u in uses if u not in keep]
    src = df.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{c}`").alias(f"__use{i}") for i, c in enumerate(extra)])
    where = [keep.index(c) if c in keep else len(keep) + extra.index(c) for c in uses]
    schema = T.StructType([*src.schema.fields[: len(keep)], *fields])
    n_keep, names = len(keep), [*keep, *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in slices(batches):
            made = f(*[b.column(i) for i in where])
            yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], *made], names=names)

    return src.mapInArrow(run, schema)


def held_out(doc_id: Column | str) -> Column:
    """True where crc32 of the id as text leaves no remainder by 5 (null id: false)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def bounded_sample(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """All rows if there are at most `bound`, else those whose hashed key falls below bound/count (about `bound` rows, the same in every run)."""
    n = df.count()
    if n <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * bound / n))


def shared_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark a side for broadcast if a count proves that it has at most max_rows rows, else leave the join to a shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def join_keyed(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", max_rows: int = 20_000, salts: int = 64) -> DataFrame:
    """Join a table with one row per key to rows of which one key may hold a third.

    Broadcast if a count proves that the side has at most max_rows rows. Else both are salted: the rows by
    their place in the partition (the same in a retry), the side by a copy for each salt.
    """
    if side.limit(max_rows + 1).count() <= max_rows:
        return df.join(F.broadcast(side), list(keys), how)
    rows = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.join(copies, [*keys, "__salt"], how).drop("__salt")


def join_counted(rows: DataFrame, side: DataFrame, keys: Sequence[str], n_col: str, busy: int = 100_000) -> DataFrame:
    """Join rows to a written table with one row per key that knows in n_col how many rows have the key (n_col is dropped).

    Keys of more than `busy` rows (few, as each stands for that many) go apart, by broadcast or salted; all others by a plain join.
    """
    keys = list(keys)
    hot = side.filter(F.col(n_col) > busy)
    if hot.isEmpty():
        return rows.join(side.drop(n_col), keys)
    cold = join_keyed(rows, hot.select(*keys), keys, "left_anti").join(side.filter(F.col(n_col) <= busy).drop(n_col), keys)
    return join_keyed(rows, hot.drop(n_col), keys).unionByName(cold)
