"""Tables that operators write for themselves, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the tasks, once a session, for what runs there in Python."""
    sc = spark.sparkContext
    if getattr(sc, "_lookout_shipped", False):
        return
    top = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="lookout")) / f"lookout_{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((top / "lookout").rglob("*.py")):
            z.write(f, f.relative_to(top))
    sc.addPyFile(str(archive))
    sc._lookout_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only local runs may leave it unset."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not getattr(sc, "_lookout_core_dir", None):
        sc._lookout_core_dir = "file://" + tempfile.mkdtemp(prefix="lookout-core-")
    return sc._lookout_core_dir


class Scratch:
    """Cuts lineage by written tables, which outlive a lost executor, and removes those that nothing reads any more.

    As a context it removes, at its end, all but what keep() was told of: what a lazy result reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.kept = spark, {}, set()

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{shared_folder(self.spark)}/lookout-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.add(id(df))
        return df

    def drop(self, df: DataFrame) -> None:
        path, _ = self.paths.pop(id(df), (None, None))
        if path:
            p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for key, (_, df) in [*self.paths.items()]:
            if key not in self.kept:
                self.drop(df)
