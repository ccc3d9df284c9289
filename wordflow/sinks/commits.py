"""What was done for which micro-batch, kept where a restarted query finds it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordflow.session import file_system

# Spark runs the last batch again after a failure, never an earlier one.
KEPT = 2


class Versions:
    """Tables under ``folder``, one per batch id, of which the last few are kept.

    A table counts once its writer has left the mark that Spark writes last. A
    batch that runs again replaces its own table.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/version-{batch_id}"

    def _ids(self) -> list[int]:
        files, place = file_system(self.spark, self.folder)
        if not files.exists(place):
            return []
        names = [status.getPath().getName() for status in files.listStatus(place)]
        return sorted(int(name.partition("-")[2]) for name in names if name.startswith("version-"))

    def has(self, batch_id: int) -> bool:
        files, mark = file_system(self.spark, f"{self._path(batch_id)}/_SUCCESS")
        return files.exists(mark)

    def read(self, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(self._path(batch_id))

    def before(self, batch_id: int) -> DataFrame | None:
        """The newest whole table of an earlier batch."""
        earlier = [n for n in self._ids() if n < batch_id and self.has(n)]
        return self.read(earlier[-1]) if earlier else None

    def write(self, batch_id: int, table: DataFrame) -> None:
        table.write.mode("overwrite").parquet(self._path(batch_id))
        for old in [n for n in self._ids() if n <= batch_id][:-KEPT]:
            files, place = file_system(self.spark, self._path(old))
            files.delete(place, True)


class CommitLog:
    """Marks under ``folder``, one per finished batch. They are made whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _mark(self, batch_id: int) -> tuple:
        return file_system(self.spark, f"{self.folder}/commit-{batch_id}")

    def done(self, batch_id: int) -> bool:
        files, mark = self._mark(batch_id)
        return files.exists(mark)

    def commit(self, batch_id: int) -> None:
        files, mark = self._mark(batch_id)
        files.create(mark, True).close()

    def committed(self) -> list[int]:
        files, place = file_system(self.spark, self.folder)
        if not files.exists(place):
            return []
        names = [status.getPath().getName() for status in files.listStatus(place)]
        return sorted(int(name.partition("-")[2]) for name in names if name.startswith("commit-"))
