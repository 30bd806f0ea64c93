"""The session the library is tuned for."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: UTC and ANSI keep results equal on every cluster; AQE coalesces, splits skewed joins and picks broadcasts at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "lakewright", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=DEFAULTS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session may do without one: elsewhere executors wouldn't see each other's files."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lakewright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df once as Parquet in the shared folder and return a reader of it.

    Cuts the lineage like checkpoint(): a lost executor re-reads the files
    instead of recomputing them. An empty result keeps its schema.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so tasks can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    # the driver's file server reads the archive whenever an executor asks for it, so it stays until the driver ends
    archive = Path(tempfile.mkdtemp(prefix="lakewright-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
