"""Session settings the jobs rely on, and the place where long lineages are cut."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even if a later step then needs a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # row_number() <= k keeps only k rows per group before the shuffle; search takes k = 2000
    "spark.sql.optimizer.windowGroupLimitThreshold": "4096",
    # IN lists up to this length reach the parquet row groups as they are
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
    # seen-content state of a long crawl lives on disk, not in the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # web pages are large rows, so bound a Python batch by bytes as well as by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


_shipped: set[str] = set()


class _Scopes(threading.local):
    """The lists that tables staged by this thread are noted in, the innermost last."""

    def __init__(self):
        self.open: list[list[str]] = []


_scopes = _Scopes()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="pagewright-"), "pagewright-code")
        archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    ship_package(spark)
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pagewright")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.pagewright.inputPartitions", str(os.cpu_count() if cores == "*" else cores))
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; a temporary one only for a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="pagewright-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a parquet table in the scratch folder and read it back.

    For inputs used by more than one branch: they are computed once, and a lost executor costs a
    re-read of files rather than a recomputation. They stay until the block they were staged in ends
    (``staging``), or for good where there is none. ``compression`` is a parquet codec, if not the
    session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _scopes.open:
        _scopes.open[-1].append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Note in ``paths`` the tables that this thread stages inside the block, and no others."""
    _scopes.open.append(paths)
    try:
        yield
    finally:
        _scopes.open.pop()


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a table is a folder of files rather than one file, in any store Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete the noted tables and empty the list; once nothing reads them any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block goes at its end; for jobs that store their results inside it."""
    paths: list[str] = []
    try:
        with recorded(paths):
            yield
    finally:
        remove_tables(spark, paths)


def together(*jobs: Callable[[], object]) -> None:
    """Run independent jobs side by side; what they stage belongs to the caller's block."""
    scopes = list(_scopes.open)

    def run(job: Callable[[], object]) -> None:
        _scopes.open = scopes
        job()

    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(run, job) for job in jobs]:
            done.result()


@contextmanager
def batches_by_rows(spark: SparkSession) -> Iterator[None]:
    """Python batches are bound by rows alone in plans made and run inside the block.

    For rows of a few numbers: to bound them by bytes a batch is measured after each row, which takes
    longer than to write the row.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(2**31 - 1))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint, which keeps the partitioning of ``df`` (``stage`` does not)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint()
