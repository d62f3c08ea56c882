"""Session defaults and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "peerledger", cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it. Only a local master may go without: a folder of the driver's
    own disk would be read back short, or not at all, where executors run elsewhere."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        current = tempfile.mkdtemp(prefix="peerledger-")
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Scope:
    """The staged tables written while it is the innermost open one."""

    def __init__(self, spark: SparkSession, outer: Scope | None):
        self.spark, self.outer = spark, outer
        self.owned: list[tuple[DataFrame, str]] = []

    def _take(self, frames: tuple[DataFrame, ...]) -> list[tuple[DataFrame, str]]:
        taken = [o for o in self.owned if any(o[0] is f for f in frames)]
        self.owned = [o for o in self.owned if not any(o[0] is f for f in frames)]
        return taken

    def keep(self, *frames: DataFrame) -> None:
        """These staged tables outlive the scope: the next outer one owns them, or nobody."""
        taken = self._take(frames)
        if self.outer is not None:
            self.outer.owned += taken

    def release(self, *frames: DataFrame) -> None:
        """Delete these staged tables now, their last reader having been written."""
        for _, path in self._take(frames):
            delete_path(self.spark, path)


INNERMOST: ContextVar[Scope | None] = ContextVar("staging scope", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Scope]:
    """Own the staged tables written inside: all but the kept ones are deleted at the end, after a failure too.

    What is still lazy at the end must read kept tables only.
    """
    scope = Scope(spark, INNERMOST.get())
    token = INNERMOST.set(scope)
    try:
        yield scope
    finally:
        INNERMOST.reset(token)
        scope.release(*[df for df, _ in scope.owned])


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffle_files_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each write ends, instead of when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stage_measured(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict[str, int]]:
    """Write `df` once to the shared folder; return it read back, and its `rows` and other aggregates as observed by the
    write itself.

    Later steps that use the result several times read only the columns they need, and a lost
    executor costs a re-read instead of a replay of everything before this point.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    seen = Observation(name)
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in measures.items()])
    with shuffle_files_freed(spark):
        observed.write.mode("error").option("compression", "zstd").parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    scope = INNERMOST.get()
    if scope is not None:
        scope.owned.append((staged, path))
    return staged, seen.get


def stage_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    staged, seen = stage_measured(df, name)
    return staged, seen["rows"]


def stage(df: DataFrame, name: str) -> DataFrame:
    return stage_counted(df, name)[0]
