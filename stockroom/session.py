"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", app: str = "stockroom", **conf) -> SparkSession:
    """A session configured the way the operators expect (UTC, AQE on, no UI)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "8g"))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Pin the settings results depend on.

    Dates derived from timestamps must not move with the machine's zone, so the session
    zone is UTC (the oracle engine treats timestamps as zone-less).
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is only read
    here. In local mode (tests, bench) a private scratch folder is created when unset.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not (sc.master == "local" or sc.master.startswith("local[")):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    d = tempfile.mkdtemp(prefix="stockroom-ckpt-")
    sc.setCheckpointDir(d)
    return d


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back: a lineage
    cut that keeps column pruning, filter pushdown and size statistics for later plans."""
    import os
    import uuid
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def together(spark: SparkSession, *steps):
    """The results of ``steps`` (callables that each write tables and do not need each other), run at the same time:
    their jobs share the executors instead of waiting in line. The first error is raised once all have ended."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and cut its lineage (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None before its first write."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
