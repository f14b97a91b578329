"""Session helpers: defaults for local runs and lineage cutting via reliable checkpoints."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE re-plans joins and coalesces shuffle partitions at
# run time; the session time zone only matters for LTZ timestamps (test data is NTZ).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where the split breaks the order_id partitioning that the
    # deduplication reuses (it then pays one partially aggregated exchange instead of one
    # task holding a third of the rows)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # local mode runs everything in the driver JVM; Spark's 1 GB default is too small for
    # concurrent model fits (takes effect only when this builder starts the JVM)
    "spark.driver.memory": "8g",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "demandflow", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults; meant for tests and benches."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.  Where it
    is unset, a local session (one JVM, as in tests) gets a fresh scratch folder and any other
    master is refused: executors would not see a folder on the driver's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="demandflow-ckpt-")
    sc.setCheckpointDir(local)
    return local


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows as a Parquet table into the shared folder and read them from
    there.  Later branches re-read only the columns they need instead of recomputing joins, and a
    lost executor costs nothing.  The table goes when the driver ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a task where :func:`partitions_for` deals them.
TASK_ROWS = 250_000


def partitions_for(rows: DataFrame) -> int:
    """Partitions for about TASK_ROWS of ``rows`` each, so that what a task sorts or hashes stays
    the same size whatever the input.  Meant for scans, of which a count reads footers only."""
    return max(1, -(-rows.count() // TASK_ROWS))


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the JVM may already be gone when Python exits
        pass


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of plan-time values as literals: no data travels from the driver."""
    from pyspark.sql import functions as F
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")
