"""Session helper for tests, the bench and local runs; on a cluster spark-submit sets the configuration."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf) -> SparkSession:
    """A local[cpus] session in UTC with adaptive execution on."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("loomspan")
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def with_package(spark: SparkSession) -> SparkSession:
    """Ship this package to the executors' Python workers, where it isn't installed there; the same as spark-submit --py-files."""
    root = pathlib.Path(__file__).resolve().parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="loomspan-")) / "loomspan.zip"  # read by the driver alone, which serves it
    with zipfile.ZipFile(path, "w") as held:
        for file in sorted(root.rglob("*.py")):
            held.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    return spark


def cut(df: DataFrame) -> DataFrame:
    """df by checkpoint() in the folder of spark.checkpoint.dir; a temporary one is set only where there is none on one machine (tests)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(folder or "file://" + tempfile.mkdtemp(prefix="loomspan-"))
    return df.checkpoint()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only where none is set on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="loomspan-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stored(df: DataFrame, name: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors. settings: in force meanwhile."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/loomspan/{name}-{uuid.uuid4().hex}"
    tidy = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}  # the table is whole: its shuffle files can go
    settings = tidy | (settings or {})
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark so that any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
