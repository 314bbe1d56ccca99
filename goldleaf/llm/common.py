"""What the operators share: work folders in the shared space, and names that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.session import run_folder


class Workspace:
    """Intermediate tables of one run, in a new folder of the shared space.

    ``keep`` computes a result once and gives it back as a stored table, which cuts the plan and
    outlives the executors that made it. ``drop`` removes one that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.made = spark, run_folder(spark, label), 0

    def path(self, label: str) -> str:
        self.made += 1
        return f"{self.folder}/{self.made:03d}-{label}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        df.write.option("compression", "zstd").parquet(path)
        # a reader without a schema would have to look into the files again
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._stored_at = path
        return stored

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self.remove(table._stored_at)

    def remove(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the DataFrame does not have yet."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
