"""What a stream's batches add, kept as a bounded number of parts.

Every batch stores one part under its id, so a repeated batch replaces itself. Parts can be
combined in any order: each time FAN parts of one level are complete, the batch that
completes them also writes their combination, one part of the next level. A part is
therefore rewritten once per level, and after n batches a reader meets at most FAN - 1 parts
of each of log(n) levels, whatever came late.

A combined part has a fixed name and is made of fixed parts, so a batch that fails after
writing it and comes again writes the same. Parts are deleted one combination later than
they are combined, so neither a repeated batch nor a reader that has just listed them is left
without. A part counts once its _SUCCESS is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FAN = 16


class PartTable:
    """Parts of a table in one folder; `combine` maps rows of parts to fewer rows of the same columns."""

    def __init__(self, spark: SparkSession, path: str, combine: Callable[[DataFrame], DataFrame], fan: int = FAN):
        self.spark, self.path, self.combine, self.fan = spark, path, combine, fan

    def _name(self, level: int, chunk: int) -> str:
        return f"{self.path}/level={level:02d}/chunk={chunk:012d}"

    def store(self, rows: DataFrame, batch_id: int) -> None:
        """Store the part of a batch, and the combinations it completes. Batches come in order, from 0."""
        rows.write.mode("overwrite").parquet(self._name(0, batch_id))
        level, done = 1, batch_id + 1
        while done % self.fan == 0:
            done //= self.fan
            chunk = done - 1
            below = range(chunk * self.fan, (chunk + 1) * self.fan)
            parts = self.spark.read.schema(rows.schema).parquet(*[self._name(level - 1, c) for c in below])
            self.combine(parts).select(*rows.columns).write.mode("overwrite").parquet(self._name(level, chunk))
            for old in range((chunk - 1) * self.fan, chunk * self.fan):
                if chunk:
                    self._delete(level - 1, old)
            level += 1

    def _delete(self, level: int, chunk: int) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._name(level, chunk))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def parts(self) -> list[str]:
        """The complete parts that together hold every batch once: the highest level first."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        marks = hadoop.Path(f"{self.path}/level=*/chunk=*/_SUCCESS")
        found = marks.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
        names = [s.getPath().getParent() for s in found or []]
        chunks = sorted(((int(p.getParent().getName()[6:]), int(p.getName()[6:])) for p in names), key=lambda c: (-c[0], c[1]))
        out, seen = [], 0
        for level, chunk in chunks:
            # Batches up to `seen` are in parts of higher levels.
            if chunk * self.fan ** level >= seen:
                out.append((level, chunk))
                seen = (chunk + 1) * self.fan ** level
        return [self._name(*c) for c in out]

    def read(self) -> DataFrame:
        """Rows of all parts, not yet combined."""
        return self.spark.read.parquet(*self.parts())
