"""Lookups of streams that are read once per period, not once per micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirgate.sinks.batches import children, file_system

#: Snapshots that are kept, so that frames which still read an older one find it.
KEPT = 3


class PeriodicLookup:
    """Versions of a lookup in a folder, one for each period in which a micro-batch needed it.

    A micro-batch joins the newest version that is younger than the period, or makes one. Which one that was, is
    pinned in the folder before the batch is joined, so that a batch that runs again, after a restart too, joins the same
    rows. Only the last batch can run again, so older pins go, and with them versions that no pin or later batch
    needs. The folder belongs to one stream, like its checkpoint.
    """

    def __init__(self, read: Callable[[SparkSession], DataFrame], folder: str, seconds: float,
                 now: Callable[[], float] = time.time) -> None:
        self.read, self.folder, self.seconds, self.now = read, folder.rstrip("/"), seconds, now

    def _numbers(self, spark: SparkSession, kind: str) -> list[tuple[int, int]]:
        """What lies in the folder under names ``kind=a_b``, as numbers in order."""
        found = [path.rstrip("/").rpartition("=")[2].split("_") for path in children(spark, self.folder, f"{kind}=*")]
        return sorted((int(a), int(b)) for a, b in found)

    def _version(self, spark: SparkSession) -> int:
        """The newest complete version, made now if there is none or it is too old."""
        made = [number for number, _ in self._numbers(spark, "version")]
        instant = int(self.now() * 1000)
        if made and instant < made[-1] + self.seconds * 1000:
            return made[-1]
        number = max(instant, made[-1] + 1 if made else 0)
        fs, hidden = file_system(spark, f"{self.folder}/_making")
        _, place = file_system(spark, f"{self.folder}/version={number}_0")
        self.read(spark).write.mode("overwrite").parquet(f"{self.folder}/_making")
        if not fs.rename(hidden, place):
            raise OSError(f"{hidden} cannot be moved to {place}")
        return number

    def at(self, spark: SparkSession, batch: int) -> DataFrame:
        """The lookup as micro-batch ``batch`` joins it, now and whenever it runs again."""
        pins = dict(self._numbers(spark, "batch"))
        if batch not in pins:
            pins[batch] = self._version(spark)
            fs, pin = file_system(spark, f"{self.folder}/batch={batch}_{pins[batch]}")
            fs.mkdirs(pin)
        version = pins[batch]
        for old, number in pins.items():
            if old < batch - 1:
                fs, path = file_system(spark, f"{self.folder}/batch={old}_{number}")
                fs.delete(path, True)
        for number, _ in self._numbers(spark, "version")[:-KEPT]:
            if number < min(pins[b] for b in pins if b >= batch - 1):
                fs, path = file_system(spark, f"{self.folder}/version={number}_0")
                fs.delete(path, True)
        return spark.read.parquet(f"{self.folder}/version={version}_0")
