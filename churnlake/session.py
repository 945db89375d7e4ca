"""Session settings and staging of intermediate results."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Fallback folders of local sessions, and staged paths, by application id.
_OWN_FOLDERS: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def local_session(cores: str = "*", partitions: int = 8, app: str = "churnlake") -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder, since there the driver is the only machine; it is
    removed when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        own = tempfile.mkdtemp(prefix="churnlake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN_FOLDERS[app] = own
    return _OWN_FOLDERS[app]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For a table that many passes read, such as one row per user out of all fact tables:
    it survives lost executors, cuts the plan and the task lineage of everything built
    on it, and keeps column pruning, which an RDD checkpoint does not. The table stays
    until ``clear_staged`` or, in a local session without a named folder, process end.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def spread(df: DataFrame, rows: int, of: int = 1 << 15) -> DataFrame:
    """The frame in a partition for every ``of`` rows; as it is if it has no more than these.

    For narrow rows with much work each, which a scan or a shuffle would put into few tasks.
    """
    return df.repartition(math.ceil(rows / of)) if rows > of else df


def drop_staged(df: DataFrame) -> None:
    """Delete the table that ``stage`` returned, once nothing will read it again."""
    path = getattr(df, "staged_path", None)
    if path is not None:
        spark = df.sparkSession
        _STAGED.get(spark.sparkContext.applicationId, []).remove(path)
        _delete(spark, path)


def clear_staged(spark: SparkSession) -> int:
    """Delete what this session staged, once the frames built on it are done with."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, text: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several passes read; the caller may ``unpersist`` it.

    Blocks lost with an executor are recomputed from the source tables, and every
    derived value here is a pure function of its input row set.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def kept(df: DataFrame):
    """``keep`` for the length of a block; for operators that return bounded results."""
    held = not df.is_cached
    if held:
        keep(df)
    try:
        yield df
    finally:
        if held:
            df.unpersist()


def small_frame(spark: SparkSession, rows: list[tuple], ddl: str | T.StructType) -> DataFrame:
    """A driver-made frame of a few rows as a local relation (no job, known size)."""
    declared = T.StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl
    columns = list(zip(*rows)) if rows else [[] for _ in declared]
    table = pa.table(
        [pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, declared)],
        names=declared.names,
    )
    return spark.createDataFrame(table, declared)
