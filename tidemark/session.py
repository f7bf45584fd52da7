"""Session settings, durable intermediate results and shared scratch space."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: The folder of each durable table, and the folders that belong to an owner.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_owned: dict[str, list[str]] = {}
_owner: ContextVar[str | None] = ContextVar("owner", default=None)


def build_session(app: str = "tidemark", cores: int | str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for.

    On a cluster, leave ``cores`` unset and let spark-submit name the master. The
    partition count is only a ceiling: AQE merges small shuffle partitions and splits
    skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if cores is not None:
        builder = builder.master(f"local[{cores}]")
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a skewed join may be split even where that costs one more exchange
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: the cluster's checkpoint folder."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    # only where driver and executors are one process, as in tests
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root; nothing is created yet. All folders of
    an application lie together, so that they can be removed when it has ended."""
    application = spark.sparkContext.applicationId
    return f"{_shared_root(spark)}/tidemark/{application}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str = "step", options: Mapping[str, object] | None = None) -> DataFrame:
    """Write ``df`` as a table under the shared root, with ``options`` of Parquet, and read it back.

    Cuts the lineage where a result is read more than once and must be the same each
    time, also after an executor is lost. A Parquet table rather than ``checkpoint()``:
    later reads prune columns and the planner knows the real size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[out] = path
    if owner := _owner.get():
        _owned.setdefault(owner, []).append(path)
    return out


def forget(df: DataFrame) -> None:
    """Remove the files of a ``durable`` table that nothing reads any more. Other tables
    are left alone."""
    folder = _folders.pop(df, None)
    if folder is not None:
        remove_folder(df.sparkSession, folder)


@contextmanager
def owned(owner: str):
    """``durable`` tables made inside belong to ``owner`` until it releases them."""
    token = _owner.set(owner)
    try:
        yield
    finally:
        _owner.reset(token)


def release(spark: SparkSession, owner: str, needed: DataFrame | None = None) -> None:
    """Remove the ``durable`` tables of ``owner``, but for those that ``needed`` reads."""
    read = needed.inputFiles() if needed is not None and _owned.get(owner) else []
    kept = []
    for folder in _owned.pop(owner, []):
        if any(f"/{folder.rsplit('/', 1)[-1]}/" in f for f in read):
            kept.append(folder)
        else:
            remove_folder(spark, folder)
    if kept:
        _owned[owner] = kept


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system that Spark knows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def inline_table(spark: SparkSession, columns: Mapping[str, Sequence], **types) -> DataFrame:
    """A driver-side table of bounded size as a local relation, so that the planner
    knows its exact size. ``types`` gives Arrow types for columns that need one."""
    arrays = {
        name: pa.array(list(values), type=types.get(name)) for name, values in columns.items()
    }
    return spark.createDataFrame(pa.table(arrays))


def spread(scan: DataFrame) -> DataFrame:
    """Share out a table that lies in fewer splits than there are cores, such as one file
    with one row group, before heavy work per row. A table of many splits is handed back
    as it is. ``scan`` must be a plain read without a shuffle in it."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
