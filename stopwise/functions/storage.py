"""Intermediate tables in the folder that driver and executors share, and single steps on files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, a session of one machine takes a temporary folder; a cluster gets an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/stopwise-checkpoints"
    return f"{root.rstrip('/')}/stopwise-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a table and read it back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def for_small_files(spark: SparkSession) -> SparkSession:
    """A session with the settings of the given one whose tasks read many small files each."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 16))
    return own


def exists(spark: SparkSession, path: str) -> bool:
    """True if there is a file or folder of that name, in whatever file system the path names; nothing is listed."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(there)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(there, True)


#: Characters that Spark writes as %XX in the names of partition folders, beside control characters; the folder of null and empty values.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def key_folder(names: list[str], values: list) -> str:
    """The folder of a key below a partitioned table: name=value/.."""
    text = lambda v: "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in str(v))
    return "/".join(f"{n}={_NO_VALUE if v is None or v == '' else text(v)}" for n, v in zip(names, values, strict=True))
