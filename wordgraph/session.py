"""Session helpers: the shared checkpoint folder and lineage cuts.

Iterative operators (PageRank, components) cut their lineage once per round.
They never use ``localCheckpoint``: a lost executor would lose the only copy.
Instead every round is written as a Parquet table below the folder that the
cluster names in ``spark.checkpoint.dir``; reading it back starts a fresh,
short plan whose input survives executor loss.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _context(spark: SparkSession):
    """The SparkContext of a classic session; ``None`` for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    Taken from the SparkContext, else from ``spark.checkpoint.dir``; where
    both are unset, a folder below the SQL warehouse, which executors and
    driver share as well. Never a machine-local temporary folder.
    """
    sc = _context(spark)
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if configured:
        return configured
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_cuts"


_ROOTS: dict[str, list[str]] = {}


def _delete(spark: SparkSession, path: str) -> None:
    sc = _context(spark)
    if sc is None:  # Spark Connect: no file system handle on the client
        return
    jvm = sc._jvm
    conf = sc._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end: its writer's job marked it."""
    sc = _context(spark)
    if sc is None:  # Spark Connect: no file system handle on the client
        return False
    p = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)


def release_cuts(spark: SparkSession) -> int:
    """Delete every table this application wrote below the checkpoint folder.

    Results returned earlier read those tables: call this once they have
    been consumed (written out or collected). Returns the number of folders.
    """
    sc = _context(spark)
    roots = _ROOTS.pop(sc.applicationId if sc else "connect", [])
    for root in roots:
        _delete(spark, root)
    return len(roots)


class TableCuts:
    """Writes intermediate tables of one run below the checkpoint folder.

    ``cut(df, name)`` writes ``df`` once and returns a DataFrame that reads the
    written files, so later rounds do not re-plan or re-run earlier ones.
    ``drop(df_path)`` removes a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession, prefix: str, name: str | None = None, release_shuffles: bool = False):
        """``name``: a folder that a later run under the same name finds again; else one of its own.
        ``release_shuffles``: shuffle files of a write go when it has ended, not when the driver's garbage collector
        finds that nothing refers to them, which many shuffles of one run may fill the disks before."""
        self.spark = spark
        self.release_shuffles = release_shuffles
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/wordgraph-{prefix}-{name or uuid.uuid4().hex}"
        self.paths: list[str] = []
        sc = _context(spark)
        _ROOTS.setdefault(sc.applicationId if sc else "connect", []).append(self.root)

    def cut(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with self._released():
            df.write.mode("overwrite").options(**options).parquet(path)
        self.paths.append(path)
        # With the schema given, reading back starts no job of its own.
        return self.spark.read.schema(df.schema).parquet(path)

    @contextlib.contextmanager
    def _released(self):
        if not self.release_shuffles:
            yield
            return
        before = self.spark.conf.get(SHUFFLE_CLEANUP_CONF, "false")
        self.spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
        try:
            yield
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP_CONF, before)

    def drop(self, path: str) -> None:
        _delete(self.spark, path)
        if path in self.paths:
            self.paths.remove(path)

    def drop_named(self, *names: str) -> None:
        """Tables of this run that no later plan reads; a name without a table is passed over."""
        for path in [p for p in self.paths if p in {f"{self.root}/{name}" for name in names}]:
            self.drop(path)

    def drop_all_but_last(self) -> None:
        for path in list(self.paths[:-1]):
            self.drop(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` on ``key`` when its scan has fewer parts than the cluster has cores.

    Large inputs come in many files and splits, so nothing changes for them;
    a small input stored as one row group would otherwise run its CPU-heavy
    steps (tokenising whole texts) in a single task.
    """
    sc = _context(df.sparkSession)
    if sc is None:
        return df
    parallelism = sc.defaultParallelism
    if df.rdd.getNumPartitions() < parallelism:
        return df.repartition(parallelism, key)
    return df


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "wordgraph",
                  checkpoint: str | None = None) -> SparkSession:
    """A local-mode session with the settings used in tests and the bench.

    ``checkpoint`` names the folder for lineage cuts (``spark.checkpoint.dir``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    if checkpoint:
        builder = builder.config(CHECKPOINT_CONF, checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
