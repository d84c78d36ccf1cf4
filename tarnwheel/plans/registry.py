"""Registered queries by name, and DuckDB text that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnwheel.sources.tables import TABLES, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Views that SQL text reads have this before their table's name, so that no view of the user's is replaced.
PREFIX = "tarnwheel_"
_FROM = re.compile(rf"\b(FROM|JOIN)(\s+)({'|'.join(TABLES)})\b")


def both(name: str, text: str, twin: str | None = None) -> None:
    """Registers SQL text for Spark, with DuckDB's text where the dialects differ."""
    used = {m[3] for m in _FROM.finditer(text)}
    own = _FROM.sub(rf"\1\2{PREFIX}\3", text)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for t in used:
            table(spark, sf_dir, t).createOrReplaceTempView(PREFIX + t)
        return spark.sql(own)

    run.__name__ = name
    QUERIES[name], ORACLE[name] = run, twin or text


def built(twin: str | None) -> Callable:
    """Registers a function of (spark, sf_dir) under its name, with DuckDB's text if there is any."""

    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if twin:
            ORACLE[f.__name__] = twin
        return f

    return keep
