"""Session helpers: a tuned session for local use and the shared folder of a cluster."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "symgraph", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    } | conf
    spark = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors of a session that was not started with it (``--py-files`` or an installed package do the same)."""
    package, folder = os.path.dirname(os.path.abspath(__file__)), tempfile.mkdtemp(prefix="symgraph-")  # the driver serves it to executors from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/symgraph", "zip", os.path.dirname(package), os.path.basename(package)))


def shared_dir(spark: SparkSession, purpose: str, name: str | None = None) -> str:
    """A folder that every executor can reach: a new one, or with a name the same one whenever it is asked for.

    It lies in ``spark.checkpoint.dir``; only where that is unset (tests, a laptop)
    a local temporary folder is made, set as the checkpoint folder, and deleted at the end.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get() if held.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="symgraph-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = f"file://{folder}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{name or uuid.uuid4().hex}"


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage by a written table in the shared folder, which survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_all(tables: dict[str, DataFrame], purpose: str, at_once: int = 4) -> dict[str, DataFrame]:
    """``cut`` for several tables; their jobs run at the same time, so small ones do not wait for each other."""
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(lambda name: cut(tables[name], f"{purpose}-{name}"), tables)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
