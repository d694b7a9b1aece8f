"""A keyed state that grows by batches: what a stream has written so far, read at a cost that does not grow with the number of batches.

Every batch adds a segment, a folder of its own, and the state's file lists the segments that count (``published``). As soon as ``FAN``
segments of one size class lie side by side they are merged into one of the next class, reduced to what still counts, so a row is written
again once for each class (the logarithm of the number of batches) and a reader meets less than ``FAN`` folders of each class.

A batch is known by its stream (its checkpoint folder) and number. One that runs again after a failure finds itself listed and adds nothing; a stream
that starts anew with another checkpoint adds its rows beside those of the first, and the reduction makes one of the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siteatlas.sources import published

FAN = 4


class Segments:
    """``reduce`` keeps the rows of a union of segments that still count; it must give the same however the rows were cut."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, reduce: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.schema, self.reduce = spark, path, schema, reduce

    def _state(self) -> dict | None:
        return published.state(self.spark, self.path)

    def _publish(self, before: dict | None, segments: list[dict], seen: dict) -> None:
        published.switch(self.spark, self.path, before, {"folders": [s["folder"] for s in segments], "segments": segments, "seen": seen})

    def _load(self, segments: list[dict]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{s['folder']}" for s in segments])

    def has(self, stream: str, batch: int) -> bool:
        state = self._state()
        return bool(state) and state["seen"].get(stream, -1) >= batch

    def add(self, rows: DataFrame, stream: str, batch: int) -> None:
        """Add the rows of a batch, unless they are in already; then merge what has come together."""
        if self.has(stream, batch):
            return
        folder = published.new_folder(f"batch-{batch}")
        n = published.write_folder(self.reduce(rows).select(*self.schema.names), self.path, folder)["rows"]
        before = self._state()
        segments = list(before["segments"]) if before else []
        if n:
            segments.append({"folder": folder, "level": 0})
        self._publish(before, segments, {**(before["seen"] if before else {}), stream: batch})
        while self._merge():
            pass

    def _merge(self) -> bool:
        before = self._state()
        segments = before["segments"]
        level = segments[-1]["level"] if segments else 0
        alike = [s for s in segments if s["level"] == level]
        if len(alike) < FAN:
            return False
        folder = published.new_folder(f"level-{level + 1}")
        published.write_folder(self.reduce(self._load(alike)).select(*self.schema.names), self.path, folder)
        kept = [s for s in segments if s["level"] != level]
        self._publish(before, [*kept, {"folder": folder, "level": level + 1}], before["seen"])
        return True

    def read(self) -> DataFrame:
        """The rows that count, over all segments of this moment."""
        state = self._state()
        return self.reduce(self._load(state["segments"] if state else []))
