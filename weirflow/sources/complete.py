"""Complete tables, replaced as a whole without a moment in which there is none."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How many versions of a table are kept; the one written next takes the place of the oldest.
KEPT_VERSIONS = 4

_POINTER = "version LONG, mark STRING"


class Pointer:
    """A number that only rises, with a note, kept in files under ``path``.

    A new one is written beside the one that holds until then, and readers take
    the highest they find: so there always is one, whatever becomes of the writer.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def current(self) -> tuple[int, str] | None:
        """Number and note; None before the first."""
        try:
            rows = self.spark.read.schema(_POINTER).option("ignoreMissingFiles", True).json(self.path).collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return max(((r["version"], r["mark"]) for r in rows), default=None)

    def set(self, version: int, mark: str = "") -> None:
        row = self.spark.range(1, numPartitions=1).select(F.lit(version).cast("long").alias("version"), F.lit(mark).alias("mark"))
        row.write.mode("overwrite").json(f"{self.path}/slot={version % 2}")


class CompleteTable:
    """A table under ``path`` whose rows are always those of one finished version.

    A new version is written to a folder of its own, while readers go on with the
    current one; a `Pointer`, written only when all rows are there, makes it the
    current one in one step. A write that fails, or loses its driver, leaves the
    pointer and so the table as they were; the next write takes the same folder.

    A query that was planned on a version can finish as long as fewer than
    ``kept`` newer ones have been written. One writer at a time: two at once would
    write to one folder.
    """

    def __init__(self, spark: SparkSession, path: str, kept: int = KEPT_VERSIONS):
        if kept < 2:
            raise ValueError("a version is written beside the current one: keep two at least")
        self.spark, self.root, self.kept = spark, path.rstrip("/"), kept
        self.pointer = Pointer(spark, f"{self.root}/pointer")

    def folder(self, version: int) -> str:
        return f"{self.root}/versions/{version % self.kept}"

    def current(self) -> tuple[int, str] | None:
        """Number and mark of the version that holds; None before the first."""
        return self.pointer.current()

    def stage(self, df: DataFrame) -> int:
        """Write the next version, unseen by readers; gives its number for `switch`."""
        now = self.current()
        version = 0 if now is None else now[0] + 1
        df.write.mode("overwrite").parquet(self.folder(version))
        return version

    def switch(self, version: int, mark: str = "") -> None:
        """Make a staged version the current one. ``mark`` is a note to find in `current`."""
        now = self.current()
        expected = 0 if now is None else now[0] + 1
        if version != expected:
            raise ValueError(f"version {version} of {self.root} was staged, {expected} is next: is there another writer?")
        self.pointer.set(version, mark)

    def replace(self, df: DataFrame, mark: str = "") -> DataFrame:
        """All rows of ``df`` in place of what was there; gives the table as it is now."""
        version = self.stage(df)
        self.switch(version, mark)
        return self.spark.read.parquet(self.folder(version))

    def read(self) -> DataFrame:
        """The rows of the current version."""
        now = self.current()
        if now is None:
            raise ValueError(f"{self.root}: no version has been written yet")
        return self.spark.read.parquet(self.folder(now[0]))
