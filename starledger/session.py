"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Where scratch files go inside a ``scratch_scope``.
_SCOPE: ContextVar[str | None] = ContextVar("scratch_scope", default=None)
#: Set to true where a ``file:`` folder is a mount that all executors share.
MOUNTED = "spark.starledger.sharedFolderIsMounted"
#: For long chains of writes: shuffle files are deleted when their query ends, not when the driver next collects its
#: garbage. A frame that is run again shuffles again.
SHUFFLES_DROPPED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Joins of shuffled sides build hash tables, instead of sorting, where every partition is found to be small.
SMALL_PARTS_HASHED = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m"}

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "starledger", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder;
    a cluster without it is refused, because executors would not share one, and so is a
    ``file:`` folder there unless it is declared to be a shared mount.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        on_cluster = not sc.master.startswith("local")
        if on_cluster and named.startswith("file:") and sc.getConf().get(MOUNTED, "false") != "true":
            raise RuntimeError(f"{named} is a local folder; set {MOUNTED}=true if all executors share it")
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="starledger-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, or in the scratch scope; never reused."""
    return f"{_SCOPE.get() or shared_dir(spark)}/starledger-{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch files written inside are deleted at the end.

    For work whose results are written elsewhere: no frame made inside may be read afterwards.
    Threads see the scope if they run in a copy of the context.
    """
    folder = f"{shared_dir(spark)}/starledger-scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        discard(spark, folder)


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings inside; what was set before is set again at the end. They also hold for other queries that the session runs meanwhile."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def materialised(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` as a written table in the shared folder, read back.

    Later passes see one and the same row set, also after lost executors, and read only
    the columns they need. ``options`` are those of the writer. The files stay until their scratch scope ends or the shared folder is cleaned.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
