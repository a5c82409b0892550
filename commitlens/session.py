"""Session helpers: UTC clock, sane local defaults, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "commitlens",
                  driver_memory: str | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's session and call :func:`ensure_utc`.

    In local mode the driver JVM is the only executor, so ``driver_memory`` is the heap every task shares. The number
    of shuffle partitions is set only where it is given, or 8 for a local master: a cluster's own value stands.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions is None and (master or "").startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All commit clocks are UTC (decision D-1): hour/day/week results must not depend on the machine."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings, for what runs or starts inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, scheme included.

    Read from the session. Only a local master (tests, a laptop) gets a fresh local folder when it is unset: executors
    of a cluster would not see one, so there it is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="commitlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never a machine-local temp dir on a cluster)."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove every folder that :func:`scratch_path` gave to this application. Call it when results are consumed:
    landed views, feeds and checkpoints are gone afterwards (and are built again when asked for)."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        fs, p = _file_system(spark, path)
        fs.delete(p, True)


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: a lineage cut that is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the (possibly remote) file system of the session."""
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def files_under(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(path, length, modification time)`` of the data files under a path; names only, no contents."""
    fs, p = _file_system(spark, path)
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((f.getPath().toString(), int(f.getLen()), int(f.getModificationTime())))
    return sorted(found)


_VIEWS: dict[tuple, str] = {}


def landed_view(spark: SparkSession, name: str, sf_dir: str, tables: list[str],
                write: Callable[[str], None]) -> str:
    """Path of a view that ``write`` makes once per application and state of its tables: other files, sizes or times of any table
    in ``sf_dir`` give a new one, and so does a scratch folder that was cleared. Its shuffles have partitions by the bytes of
    the tables (:func:`shuffle_settings`)."""
    from commitlens.functions.partitions import shuffle_settings
    state = tuple(tuple(files_under(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")) for t in tables)
    key = (spark.sparkContext.applicationId, name, sf_dir, hash(state))
    if key not in _VIEWS or not path_exists(spark, _VIEWS[key]):
        path = scratch_path(spark, name)
        with session_conf(spark, shuffle_settings(spark, sum(size for files in state for _, size, _ in files))):
            write(path)
        _VIEWS[key] = path
    return _VIEWS[key]
