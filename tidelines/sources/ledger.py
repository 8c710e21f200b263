"""Which files have been loaded: what makes a load repeatable.

A ledger is a small Parquet table of three kinds of rows. ``begin`` notes a load before it writes anything, ``commit``
the files it has read and, last and in one file of its own, that it is done. A file counts as loaded only if a load that
is done has read it. Rows of a load that began and is not done are what a crash left behind; ``withdraw`` removes them, so
the next load starts from what complete loads wrote. One load may run at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelines.sources.files import delete, has_files

SCHEMA = "load_id string, state string, path string, length long, noted_at timestamp"


@dataclass(frozen=True)
class Ledger:
    """The ledger in a folder. It may be missing: nothing is loaded then."""

    path: str

    def entries(self, spark: SparkSession) -> DataFrame:
        if not has_files(spark, self.path):
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(self.path)

    def loads(self, spark: SparkSession) -> DataFrame:
        """load_id and done, one row per load."""
        return self.entries(spark).groupBy("load_id").agg(F.max(F.col("state") == "done").alias("done"))

    def loaded(self, spark: SparkSession) -> DataFrame:
        """load_id, path and length of all files that complete loads have read."""
        done = self.loads(spark).filter("done").select("load_id")
        files = self.entries(spark).filter("state = 'file'")
        # No hint: AQE broadcasts the loads if their measured size allows it.
        return files.join(done, "load_id", "left_semi").select("load_id", "path", "length")

    def pending(self, spark: SparkSession, files: DataFrame) -> DataFrame:
        """Of ``files`` (path, length, ...) those not loaded yet. A file whose length has changed counts as new."""
        return files.join(self.loaded(spark).select("path", "length"), ["path", "length"], "left_anti")

    def unfinished(self, spark: SparkSession) -> list[str]:
        """Ids of loads that began and are not done: as many as have crashed since the last complete load."""
        return sorted(r["load_id"] for r in self.loads(spark).filter("NOT done").collect())

    def begin(self, spark: SparkSession, load_id: str) -> None:
        if not self.loads(spark).filter((F.col("load_id") == load_id) & F.col("done")).isEmpty():
            raise ValueError(f"load id {load_id} is taken: a complete load has it")
        self._note(spark, load_id, "begun")

    def commit(self, spark: SparkSession, load_id: str, files: DataFrame) -> None:
        """``files`` (path, length) are loaded. They count from the moment the last row is written, a file of its own."""
        rows = files.select(F.lit(load_id).alias("load_id"), F.lit("file").alias("state"), "path", "length", F.current_timestamp().alias("noted_at"))
        rows.write.mode("append").parquet(self.path)
        self._note(spark, load_id, "done")

    def withdraw(self, spark: SparkSession, table: str) -> list[str]:
        """Remove what unfinished loads have written to ``table`` (rows with their load_id) and forget their files.
        Returns their ids."""
        lost = self.unfinished(spark)
        if lost:
            withdraw(spark, table, lost)
        return lost

    def _note(self, spark: SparkSession, load_id: str, state: str) -> None:
        row = spark.createDataFrame([(load_id, state)], "load_id string, state string")
        full = row.select("load_id", "state", F.lit(None).cast("string").alias("path"), F.lit(None).cast("long").alias("length"), F.current_timestamp().alias("noted_at"))
        full.coalesce(1).write.mode("append").parquet(self.path)


def withdraw(spark: SparkSession, table: str, load_ids: list[str]) -> None:
    """Delete the files that loads have added to a table. Spark's appends write files of their own, so a file holds rows
    of one load; a table whose files were joined since is left alone, with an error."""
    if not has_files(spark, table):
        return
    rows = spark.read.schema("load_id string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(table)
    theirs = F.col("load_id").isin(load_ids)
    files = rows.select("load_id", F.col("_metadata.file_path").alias("file")).groupBy("file").agg(
        F.max(theirs).alias("any"), F.min(F.coalesce(theirs, F.lit(False))).alias("all")
    )
    found = files.filter("any").collect()
    if not all(r["all"] for r in found):
        raise ValueError(f"{table} holds files that mix the rows of an unfinished load with others")
    delete(spark, [r["file"] for r in found])
