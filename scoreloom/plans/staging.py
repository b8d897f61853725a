"""Written tables that cut a plan in two.

A staged table is computed once however often it is read, outlives the loss of
executors, is read back column by column, and its size on disk is known to the
planner. The last point is why small lookup tables are staged too: Spark then
broadcasts them when, and only when, their real size allows it, and shuffles
otherwise. No join in this package forces a broadcast of data that can grow.

Whoever stages a table may release it once nothing reads it any more; what is
never released stays in the shared folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
# Tables as long as the largest input: their bytes count for more than the time to pack them.
_CODECS = {"owned-lines": "zstd"}
_SHARED: dict[tuple[str, str], DataFrame] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a scratch folder only in local mode."""
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"set {_CHECKPOINT_DIR} to a folder every executor can reach; "
            "a machine-local folder would not survive there"
        )
    return _local_scratch(spark.sparkContext.applicationId)


@cache
def _local_scratch(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"scoreloom-{application}-")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other table has."""
    return f"{staging_root(spark)}/scoreloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, compression=_CODECS.get(name))
    # Columns read from files are nullable; giving the schema saves a footer scan.
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def _version(spark: SparkSession, paths: Sequence[str]) -> str:
    """Bytes, number of files and time of change of every path, as its file system tells them."""
    found = []
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        whole = files.getContentSummary(where)
        found.append((path, whole.getLength(), whole.getFileCount(), files.getFileStatus(where).getModificationTime()))
    return repr(found)


def stage_once(spark: SparkSession, sources: Sequence[str], build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table called ``name`` that ``build`` makes of the files or folders ``sources``, staged once in this application.

    It is built again when a source has changed: another size, number of files or
    time of change. (A folder that is only changed deep inside, byte for byte as
    long as before, goes unnoticed.) ``release_shared`` deletes what is kept.
    """
    slot = (spark.sparkContext.applicationId, f"{name}: {_version(spark, sources)}")
    if slot not in _SHARED:
        _SHARED[slot] = stage(build(), name)
    return _SHARED[slot]


def release(*tables: DataFrame) -> None:
    """Delete staged tables; nothing may read them afterwards."""
    for table in tables:
        path = _PATHS.pop(table, None)
        if path is not None:
            spark = table.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release_shared(spark: SparkSession) -> None:
    """Delete every table that ``stage_once`` keeps for this application."""
    application = spark.sparkContext.applicationId
    for slot in [s for s in _SHARED if s[0] == application]:
        release(_SHARED.pop(slot))
