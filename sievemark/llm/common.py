"""Helpers that the operators of this subpackage share: the shared folder, row keys, words."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The byte whitespace that separates words: space, \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

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


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is None:  # the session is gone; the folder's owner cleans up
            continue
        try:
            discard(spark, path)
        except Exception:  # one path that cannot go does not keep the others
            continue


def column(name: str) -> Column:
    """A column by its whole name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, *replaced: str) -> Column:
    """The user's columns but for ``replaced`` as one struct, ``row``, so that no name of an operator meets one of theirs."""
    return F.struct(*(column(c) for c in df.columns if c not in replaced)).alias("row")


def row_key(*cols: Column) -> list[Column]:
    """Two 64-bit hashes of the columns' values and null flags, as ``k1`` and ``k2``.

    Rows with equal values share the key, so a result by key is the result of each of them. It does not
    depend on the order of rows, so a recomputed partition has the same keys.
    """
    flags = [c.isNull() for c in cols]
    return [F.xxhash64(*flags, *cols).alias("k1"), F.xxhash64(F.lit(0x5EED), *flags, *cols).alias("k2")]


def remainder(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; null counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8. ``bytes.split`` cuts at ASCII whitespace alone, as ``WORD`` says."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def need(df: DataFrame, *names: str) -> None:
    """Raise if a column is missing."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"columns {missing} not in {df.columns}")
