"""Session plumbing shared by every operator: code shipping, shared scratch folder, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the executors run.

    The package is zipped once per application and handed to Spark's own file
    server, so nothing relies on a path that only the driver can see.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="leafmill-")) / "leafmill.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, os.path.join(root.name, source.relative_to(root)))
    context.addPyFile(str(target))
    _SHIPPED[context.applicationId] = str(target)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can write: spark.checkpoint.dir, or, where all run on this machine, one of our own."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="leafmill-checkpoint-"))
    return context.getCheckpointDir().rstrip("/")


def cut(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and read it back without its lineage."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A frame without rows that the optimizer knows to be empty, so that joins with it are no joins."""
    columns = StructType.fromDDL(schema)
    return spark.range(0).where(F.lit(False)).select(*[F.lit(None).cast(c.dataType).alias(c.name) for c in columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
