"""Session helpers: a default session, the shared checkpoint folder, and size checks before broadcasting."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A side of a join is broadcast only if a count has shown it to have at most this many rows.
BROADCAST_ROWS = 500_000


def get_spark(cores: int | str = 8, memory: str = "12g", app: str = "billforge") -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, Arrow)."""
    root = str(Path(__file__).resolve().parents[1])
    os.environ["PYTHONPATH"] = os.pathsep.join([root, *filter(None, [os.environ.get("PYTHONPATH")])])  # for the Python workers
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Make this package importable by the Python workers wherever they run, once per context; timestamps are read as UTC."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if getattr(sc, "_billforge_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="billforge-"), "billforge.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))  # read once, by the driver, which hands it out
    sc._billforge_shipped = True


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the folder the cluster shares (``spark.checkpoint.dir``).

    A folder of our own is set only where that setting is absent, as in local tests.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="billforge-checkpoint-"))
    return df.checkpoint()


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows; reads no further than it must."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is proven small, else as it is (a shuffled join, which AQE splits where skewed)."""
    return F.broadcast(df) if is_small(df, rows) else df


def spread(scan: DataFrame) -> DataFrame:
    """A scan cut finer for costly work per row: where it has fewer partitions than the session has cores, as a small table of one file."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in scan._jdf.queryExecution().executedPlan().toString():
        return scan  # not just a scan; to ask for its partitions would run it
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
