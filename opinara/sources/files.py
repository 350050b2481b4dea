"""Moving and deleting folders through Spark's file systems, whatever store they are on."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def ready(self, path: str) -> None:
        """Make the folder if need be, and mark it as complete."""
        system, place = self._at(path)
        system.mkdirs(place)
        system.create(self._at(f"{path}/_SUCCESS")[1], True).close()

    def replace(self, source: str, target: str) -> None:
        """Move `source` to `target`; what was there is deleted only after the move.

        A rename that fails puts the old folder back.
        """
        system, place = self._at(target)
        old = self._at(f"{target}.old")[1]
        had = system.exists(place)
        if had and not system.rename(place, old):
            raise OSError(f"cannot move {target} aside")
        moved = False
        try:
            moved = system.rename(self._at(source)[1], place)
        finally:
            if had and not moved:
                system.rename(old, place)
        if not moved:
            raise OSError(f"cannot move {source} to {target}")
        if had:
            system.delete(old, True)
