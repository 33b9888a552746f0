"""Session defaults, table access and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[8]", memory: str = "8g", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the defaults the queries are tested under."""
    b = SparkSession.builder.master(master).appName("siltstone").config("spark.driver.memory", memory)
    for k, v in (DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions)} | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once a context, so that it needn't be installed there."""
    import shutil
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_siltstone_shipped", False):
        return
    here = Path(__file__).resolve().parent
    if here.parent.is_dir():
        out = shutil.make_archive(f"{tempfile.mkdtemp(prefix='siltstone-zip-')}/siltstone", "zip", here.parent, here.name)
        sc.addPyFile(out)
    sc._siltstone_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, as written."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one where none is set (tests)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        sc.setCheckpointDir(root)
        sc._jsc.sc().getCheckpointDir()
    return root.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path as its object."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class Scratch:
    """A folder of tables written once and read back: cuts lineage with files that outlive any executor.

    The folder is removed when the JVM ends, or earlier by drop().
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        fs, path = file_system(spark, self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Writes df as Parquet and returns the written table."""
        self._n += 1
        path = f"{self.root}/{name}-{self._n}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        fs, path = file_system(self.spark, self.root)
        fs.delete(path, True)


def fence(df: DataFrame) -> DataFrame:
    """df with its columns computed once: a generator that the optimiser neither merges projections across nor pushes
    filters through, so a long chain of expressions isn't copied into each place that uses it."""
    from pyspark.sql import functions as F

    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
