"""What several operators need: the shared scratch folder, written tables and free column names."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Bytes that a Python worker gets or gives in one Arrow batch, about, and the setting for it.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

#: Shuffle partitions for each file of `in_few_files`, where that makes more files than there are cores.
PER_FILE = 32

_OWN: dict[str, str] = {}
_held: dict[Hashable, Any] = {}
_tables: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("tables", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made in local mode (tests); on a cluster that is an
    error, as each machine would write to a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="tidebook-")
    return _OWN[app]


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """`df` as a Parquet table in the shared folder: a cut in the lineage that outlives executors.

    The tables live below ``<spark.checkpoint.dir>/tidebook/<application id>``. Those written within
    `scratch` are deleted at its end unless `keep` is set; others may be when the application has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidebook/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    tables = _tables.get()
    if tables is not None and not keep:
        tables.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def in_few_files(df: DataFrame) -> DataFrame:
    """`df` for `written` in about as many files as there are cores, for tables far smaller than the input
    (links, components): its rows are computed in as many tasks as ever and then dealt out evenly.

    Without Hadoop's native library every file written to a local disk starts processes (chmod),
    each of which has the executor's own memory until it runs its program.
    """
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // PER_FILE))


@contextmanager
def scratch() -> Iterator[None]:
    """Deletes the tables written within it, but for those to keep, once nothing needs them any more:
    what leaves the block must be written itself."""
    tables: list[tuple[SparkSession, str]] = []
    token = _tables.set(tables)
    try:
        yield
    finally:
        _tables.reset(token)
        for spark, path in tables:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` returns, made once per worker process: kept for the tasks to come until another is made,
    or until a task begins that has no use for any (see `lean`)."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Drops what `held` keeps."""
    _held.clear()


def lean(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], holds: bool = False) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow, which gives freed memory back to the system when a task ends: Python workers
    live on from stage to stage, and what one has reserved counts against the executor in all later ones.
    Unless `run` uses `held` itself, what earlier tasks of the worker held is dropped first."""

    def leanly(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holds:
            let_go()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
            trim(0)

    return leanly


def mapped(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, holds: bool = False) -> DataFrame:
    """mapInArrow of `lean` in batches of about `BATCH_BYTES`, or one row if that is longer: 10,000 rows of
    text, Spark's own limit, are buffers of 20 to 60 MB on both sides. A session that has the setting
    keeps it; else it is set, as it is read when the plan runs."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(lean(run, holds), schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of `df` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
