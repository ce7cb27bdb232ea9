"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Generated methods above the size that the JVM compiles would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}
#: Folders of stored tables that go with their application.
_ending: set[str] = set()
#: Paths stored in the innermost open block of ``Passing``.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
#: Spark removes a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "casebook", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; ``conf`` overrides them, and both override a cluster's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, may fall
    back to a temporary folder, which goes when the program ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="casebook-", ignore_cleanup_errors=True)
    return _local_dirs[app].name


class Folder:
    """A folder in whatever file system its path names, through the Hadoop API that Spark itself uses."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names of what the folder holds; none if it is absent."""
        here = self._at("")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(here)) if self._fs.exists(here) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file whole or not at all; False if it exists."""
        draft = self._at(f".{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        done = not self._fs.exists(self._at(name)) and self._fs.rename(draft, self._at(name))
        if not done:
            self._fs.delete(draft, False)
        return bool(done)

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def remove_at_end(self) -> None:
        """Remove the folder when the application's driver ends."""
        self._fs.mkdirs(self._at(""))
        self._fs.deleteOnExit(self._at(""))


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that no other run uses."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if folder not in _ending:
        Folder(spark, folder).remove_at_end()
        _ending.add(folder)
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting ``key`` is ``value`` in this block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def shuffle_files_go(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files: what they wrote is read from the table, never from the shuffle."""
    with setting(spark, CLEANUP, "true"):
        yield


def store(df: DataFrame, tag: str) -> str:
    """Write ``df`` to the shared folder; returns the path."""
    path = fresh_path(df.sparkSession, tag)
    open_block = _passing.get()
    if open_block is not None:
        open_block.append(path)
    with shuffle_files_go(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written table survives lost executors and later scans prune its columns.
    """
    return df.sparkSession.read.schema(df.schema).parquet(store(df, tag))


#: A frame of more rows is not broadcast.
BROADCAST_ROWS = 100_000


def merged_if_large(df: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Mark a join's side of many rows for a merge; Spark decides on one of few rows.

    Spark judges by the size of packed files, and rows of a million keys that fill 10 MB there fill a
    driver. ``counted`` is the frame to count instead where ``df`` has no more rows than it.
    """
    rows = (df if counted is None else counted).count()
    return df.hint("merge") if rows > BROADCAST_ROWS else df


class Passing:
    """Every table stored in this block goes when it ends; only what ``keep`` stores stays, in the block around it.

    For steps of many tables: ``with Passing(spark) as block: …; return block.keep(result, "name")``.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def __enter__(self) -> Passing:
        self._token = _passing.set(self._paths)
        self._outer = self._token.old_value if isinstance(self._token.old_value, list) else None
        return self

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        token = _passing.set(self._outer)
        try:
            return materialize(df, tag)
        finally:
            _passing.reset(token)

    def __exit__(self, *_: object) -> None:
        _passing.reset(self._token)
        for path in self._paths:
            Folder(self._spark, path).remove()


class Scratch:
    """Stored tables that go when the block ends: ``with Scratch(spark) as keep: df = keep(df, "name")``.

    For steps whose result is written before the block ends, so that long loads do not fill the shared folder.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __call__(self, df: DataFrame, tag: str) -> DataFrame:
        path = store(df, tag)
        self._paths.append(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def __exit__(self, *_: object) -> None:
        for path in self._paths:
            Folder(self._spark, path).remove()
