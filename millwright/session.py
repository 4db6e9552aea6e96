"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
DOCUMENTS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}
"""How tables of texts are written: a fifth smaller than at the usual level, in about the same time."""
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def build_session(app: str = "millwright", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are written for. Only tests pass ``master``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot join key even where that costs one more shuffle
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A machine-local folder is only ever used by a local master that names none.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="millwright-")
        spark.conf.set(CHECKPOINT_KEY, folder)
    return folder.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/millwright/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is materialized in the block is deleted when it ends: for jobs that have written all they return by then."""
    outer = _scratch.set([])
    try:
        yield
    finally:
        stored = _scratch.get()
        _scratch.reset(outer)
        for folder in stored:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage durably (a lost executor re-reads files, nothing is recomputed), and
    gives Catalyst real sizes and column pruning for whatever follows. Written as zstd: documents take far less than as snappy.
    Inside ``scratch`` the table goes when the block ends.
    """
    path = new_table_path(df.sparkSession, name)
    if _scratch.get() is not None:
        _scratch.get().append(path)
    df.write.options(**{"compression": "zstd"} | options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(source: DataFrame) -> DataFrame:
    """Deal a freshly read source out over all cores if it has fewer splits than that.

    For CPU-heavy work behind a few small files; a source of many splits is left alone.
    """
    cores = source.sparkSession.sparkContext.defaultParallelism
    return source.repartition(cores) if source.rdd.getNumPartitions() < cores else source
