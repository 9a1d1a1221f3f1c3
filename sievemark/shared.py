"""Tables written in the folder that the driver and all executors share, which cut the lineage and are read again after a loss."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []
_tables: dict[int, tuple[weakref.ref, str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor can reach.

    It is ``spark.checkpoint.dir`` where the session sets one. Where it is unset, a local
    master (tests) gets a temporary folder, a cluster a folder beside the warehouse.
    """
    conf = spark.sparkContext.getConf()
    if root := conf.get("spark.checkpoint.dir", None):
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if spark.sparkContext.master.startswith("local["):
            _own[app] = "file://" + tempfile.mkdtemp(prefix="sievemark-")
        else:
            _own[app] = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return _own[app]


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/sievemark/{tag}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again, which cuts the lineage."""
    path = fresh_dir(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _tables[id(out)] = (weakref.ref(out), path)
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete what ``table`` has written, once no frame in use reads it."""
    for df in tables:
        held, path = _tables.pop(id(df), (None, None))
        if held is not None and held() is df:
            discard(df.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store it names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is None:  # the session is gone; the folder's owner cleans up
            continue
        try:
            discard(spark, path)
        except Exception:  # one path that cannot go does not keep the others
            continue
