"""Sessions, input tables and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in workers import it there; nothing has to be installed
    on the executors or lie in their working folder.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark")
    shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(f"{name}.zip")
    _SHIPPED.add(context.applicationId)


class Tables:
    """The parquet tables of one data folder, opened on first use."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def views(self, *names: str) -> None:
        """Register tables as temporary views for SQL text."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)

    def folder(self, label: str) -> str:
        return folder(self.spark, label)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a session without it (a test on one
    machine) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tidemark/{app}/{label}-{uuid.uuid4().hex[:12]}"


def inline_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small settings table as literals of the plan, without a trip through Python workers."""
    fields = StructType.fromDDL(ddl).fields
    packed = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*packed)))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when a scan has fewer splits than there are cores.

    For work that costs much per row. A large table has more splits than cores
    and is left where it is: nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result is needed by several later jobs: lost executors then
    cost a re-read, not a re-run of the lineage.
    """
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
