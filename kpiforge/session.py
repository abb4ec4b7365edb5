"""SparkSession construction and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every kpiforge job relies on. ANSI stays on (division by zero must
# be guarded with nullif, as the KPI definitions do) and AQE is on so that join
# strategy, partition coalescing and skew splitting are decided at runtime from
# measured shuffle sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # a decimal result with too many digits raises instead of losing some
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where the next step reuses the join's
    # partitioning (the per-order folds); AQE then adds the one shuffle that
    # split needs, and only when it actually splits
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    # concurrent KPI runs (one scheduler pool each) share the executors
    "spark.scheduler.mode": "FAIR",
    # checkpoint files are row-serialised; compress them (context-level setting)
    "spark.checkpoint.compress": "true",
}


# sorts, hash maps and windows of one task hold some ten times its shuffled bytes
TASK_SHUFFLE = 16 << 20
TASK_INPUT = 8 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "kpiforge", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the kpiforge defaults.

    On a cluster pass ``master=None``. ``shuffle_partitions`` left out is 8 on
    a local master and Spark's own default elsewhere; the runner sizes it from
    the raw tables anyway (``size_for_tables``).
    """
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 8
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_settings(spark: SparkSession) -> None:
    """The settings every job relies on, for a session made by the caller
    (those that can be set while it runs)."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20, least: int = 200,
                   max_partitions: int = 500_000) -> dict[str, str]:
    """Shuffle sizing for a run reading ``input_bytes``: about one shuffle
    partition per ``partition_bytes`` of input (at least ``least``), scans split
    at 128 MB, and AQE coalescing small partitions back towards half that size.
    Partitions of this size fit executor memory and spill cleanly.
    ``max_partitions`` bounds the map-output metadata; it is reached at 128 TB,
    beyond which partitions grow in proportion."""
    parts = min(max(least, -(-input_bytes // partition_bytes)), max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }


def size_for_tables(spark: SparkSession, tables) -> dict[str, str]:
    """Size the session's shuffles for a run over ``tables`` (their estimated
    sizes, from file metadata), never below the number already set."""
    size = sum(int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables)
    conf = scale_settings(size, least=int(spark.conf.get("spark.sql.shuffle.partitions")))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def bound_tasks(spark: SparkSession, path: str) -> None:
    """Bounds what a task of a shuffle holds, for a session sized by its caller:
    a shuffle partition per ``TASK_INPUT`` of the files under ``path``, never below
    the number set, joined up to ``TASK_SHUFFLE`` at most."""
    held = spark.conf
    parts = min(-(-input_bytes(spark, path) // TASK_INPUT), 500_000)
    held.set("spark.sql.shuffle.partitions", str(max(parts, int(held.get("spark.sql.shuffle.partitions")))))
    advisory = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held.get(_ADVISORY))
    if advisory > TASK_SHUFFLE:
        held.set(_ADVISORY, str(TASK_SHUFFLE))


def hadoop_fs(spark: SparkSession, path: str):
    """(Path, FileSystem) of ``path`` through the session's Hadoop
    configuration: local folders, HDFS and object stores alike (metadata only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop FileSystem summary)."""
    p, fs = hadoop_fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def apply_scale_settings(spark: SparkSession, path: str) -> dict[str, str]:
    """Size the session's shuffles for the input under ``path``, never below
    the number already set."""
    conf = scale_settings(input_bytes(spark, path), least=int(spark.conf.get("spark.sql.shuffle.partitions")))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's ``spark.checkpoint.dir``. Only a local-mode session
    (tests, a laptop) may fall back to a fresh scratch folder when it is unset;
    on a cluster a machine-local folder would not survive executor loss, so an
    unset setting is an error there."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="kpiforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return a
    DataFrame reading it back (survives executor loss, short lineage). It is
    written as parquet, so the planner sees the true size of the result (a
    small table is broadcast, a large one is not) and later reads prune columns."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` that also returns the number of rows written, observed
    during the write itself."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation()
    out = cut_lineage(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return out, int(obs.get["rows"])


def scratch_root(spark: SparkSession, base: str | None = None) -> str:
    """Folder of this application's materialised intermediates."""
    base = base or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/kpiforge-scratch/{spark.sparkContext.applicationId}"


def purge_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediates (only once nothing reads them)."""
    path, fs = hadoop_fs(spark, scratch_root(spark))
    if fs.exists(path):
        fs.delete(path, True)
