"""Session helpers: building a local session for tests and benches, reading
tables, and cutting lineage into the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wordmill") -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured (local tests) do we pick a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wordmill-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialise ``df`` in the shared checkpoint folder.

    The plan is persisted first so that it runs once: an eager checkpoint
    otherwise computes it for the count and again for the checkpoint write.
    The cache is dropped once the files exist; a lost executor then costs
    nothing, since readers use the checkpoint files."""
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist(blocking=False)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path next to the checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    parent = base.rsplit("/", 1)[0] if "/" in base else base
    import uuid

    return f"{parent}/wordmill-tables/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder (below ``within``, if given):
    it is computed once, row numbers drawn in it stay, and its lineage is cut."""
    path = f"{within}/{name}" if within else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of scratch tables that no later step reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_checkpoint(df: DataFrame) -> None:
    """Removes the files of a table that ``cut_lineage`` gave and no later step reads."""
    at = df._jdf.logicalPlan().rdd().getCheckpointFile()
    if at.isDefined():
        remove_folder(df.sparkSession, at.get())


def free_shuffles(spark: SparkSession) -> None:
    """Has the shuffle files of earlier jobs removed. Spark removes them once their
    plans are collected as garbage, which a loop of jobs over large tables cannot
    wait for: each round would add its files to the disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (zip + addPyFile),
    once per application."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="wordmill-pkg-"), "wordmill.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
