"""A connector of its own: rows made from a rule, in as many parts as asked for."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Span(InputPartition):
    def __init__(self, start: int, stop: int):
        self.start, self.stop = start, stop


class SquaresReader(DataSourceReader):
    def __init__(self, options: dict):
        self.rows, self.parts = int(options.get("rows", 100)), int(options.get("parts", 4))

    def partitions(self) -> list[Span]:
        return [Span(self.rows * k // self.parts, self.rows * (k + 1) // self.parts) for k in range(self.parts)]

    def read(self, partition: Span) -> Iterator[tuple[int, int]]:
        for k in range(partition.start, partition.stop):
            yield k, k * k


class Squares(DataSource):
    """Numbers and their squares; options rows and parts."""

    @classmethod
    def name(cls) -> str:
        return "tarnwheel_squares"

    def schema(self) -> str:
        return "k long, square long"

    def reader(self, schema) -> SquaresReader:
        return SquaresReader(self.options)


def squares(spark: SparkSession, rows: int, parts: int = 4):
    spark.dataSource.register(Squares)
    return spark.read.format("tarnwheel_squares").options(rows=rows, parts=parts).load()
