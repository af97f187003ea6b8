"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "loanweft", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution on; ``extra`` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_FOLDERS: dict[str, str] = {}  # of local-mode sessions without the setting, by application


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it then gets a
    temporary folder of its own. See ``clear_stages`` for removing what a job
    has left there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    name = spark.sparkContext.applicationId
    if name not in _OWN_FOLDERS:
        _OWN_FOLDERS[name] = tempfile.mkdtemp(prefix="loanweft-")
    return _OWN_FOLDERS[name]


ARROW_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few rows of constants as a local relation, whose size the optimizer knows."""
    fields = T.StructType.fromDDL(schema)
    columns = {field.name: pa.array([row[i] for row in rows], ARROW_TYPES[field.dataType.simpleString()])
               for i, field in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), schema=fields)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/loanweft/{name}-{uuid.uuid4().hex}"


def clear_stages(spark: SparkSession) -> None:
    """Remove what ``shared_path`` and ``materialize`` have put below the shared folder; call it when no result is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/loanweft")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Remove what ``materialize`` has written and ``tables`` read directly, once no result reads it any more."""
    for table in tables:
        spark, conf = table.sparkSession, table.sparkSession._jsc.hadoopConfiguration()
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/loanweft")
        root = root.getFileSystem(conf).makeQualified(root)
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            if path.getParent().equals(root):
                path.getFileSystem(conf).delete(path, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Unlike a cache this survives lost executors, and later passes still prune
    columns and skip row groups. The shuffle files of the write go when it has
    ended, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
