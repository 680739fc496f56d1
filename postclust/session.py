"""Session helpers: a configured local session for tests and the bench, and
lineage cutting that respects the cluster's shared checkpoint folder."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every session of this library should run with. AQE re-plans joins
# at run time (broadcast when a side turns out small, split skewed partitions,
# coalesce tiny shuffle partitions).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    checkpoint_dir: str | None = None,
    app_name: str = "postclust",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Local session for tests and benchmarks (the UI stays off).

    ``checkpoint_dir`` is a fallback: it is used only when the Spark
    configuration does not already name a checkpoint folder.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not ensure_checkpoint_dir(spark) and checkpoint_dir:
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder of the session, or None.

    The folder comes from ``spark.checkpoint.dir`` as the cluster sets it; this
    library never invents a machine-local one.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns the context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get(CHECKPOINT_CONF, None)
    if conf_dir and sc is not None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir or None


def scratch_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: the checkpoint folder, else the warehouse."""
    return ensure_checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize a (small, reused) DataFrame so later jobs do not replay its lineage.

    With a shared checkpoint folder the rows are written there (reliable
    checkpoint), so losing an executor only re-reads the checkpoint files rather
    than recomputing the scans and joins above; the returned DataFrame reads
    those files. Without one, the rows are persisted in memory and on disk, and
    a lost block is recomputed from the (deterministic) lineage.
    """
    spark = df.sparkSession
    persisted = df.persist(StorageLevel.MEMORY_AND_DISK)
    if ensure_checkpoint_dir(spark):
        # persist first so the checkpoint write reads the cached blocks instead
        # of computing the plan a second time
        checkpointed = persisted.checkpoint(eager=True)
        persisted.unpersist()
        return checkpointed
    persisted.count()
    return persisted
