"""Tables of tile images, points and polygons: keyed rows in Parquet, laid out by depth and layer.

A write with a key that is there replaces that row. A table is a folder of versions; a write makes the next one from the
last and then points to it, so readers always see a whole one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class Store:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], partitions: list[str] | None = None):
        self.spark, self.path, self.keys, self.partitions = spark, path.rstrip("/"), keys, partitions or []
        self._fs = None

    def _files(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _versions(self) -> list[int]:
        fs, path = self._files()
        root = path(self.path)
        if not fs.exists(root):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n[1:]) for n in found if n.startswith("v") and fs.exists(path(f"{self.path}/{n}/_SUCCESS")))

    def read(self) -> DataFrame | None:
        v = self._versions()
        return self.spark.read.parquet(f"{self.path}/v{v[-1]}") if v else None

    def _write(self, rows: DataFrame) -> None:
        v = self._versions()
        order = [c for c in ("long_index", "lat_index", "row_key") if c in rows.columns and c not in self.partitions]
        # ranges of tiles, so that the deepest level of a layer is many tasks
        out = rows.repartitionByRange(*self.partitions, *order).sortWithinPartitions(*self.partitions, *order) if self.partitions else rows
        writer = out.write.mode("overwrite")
        (writer.partitionBy(*self.partitions) if self.partitions else writer).parquet(f"{self.path}/v{v[-1] + 1 if v else 0}")
        fs, path = self._files()
        for old in v[:-1]:
            fs.delete(path(f"{self.path}/v{old}"), True)

    def upsert(self, rows: DataFrame) -> None:
        """Of equal keys the new row stays; of equal new ones that of the greatest hash, the same at each run."""
        order = W.partitionBy(*self.keys).orderBy(F.xxhash64(*[c for c in sorted(rows.columns)]).desc())
        new = rows.withColumn("r_", F.row_number().over(order)).where("r_ = 1").drop("r_")
        old = self.read()
        self._write(new if old is None else old.join(new.select(*self.keys), self.keys, "left_anti").unionByName(new, allowMissingColumns=True))

    def delete(self, key: str, low: str, high: str) -> None:
        """Rows with keys in low..high, both included, go."""
        if (old := self.read()) is not None:
            self._write(old.where(~F.col(key).between(low, high)))

    def delete_where(self, condition: Column) -> None:
        if (old := self.read()) is not None:
            self._write(old.where(~condition))

    def drop(self) -> None:
        fs, path = self._files()
        fs.delete(path(self.path), True)
