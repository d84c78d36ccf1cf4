"""The ways to put Python into a plan, all by Arrow batches; for what no built-in expression says."""

from __future__ import annotations

import re
from collections.abc import Iterator
from unicodedata import normalize

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = re.compile("[\u0300-\u036f]")


def vowels() -> object:
    """A scalar function of one row, carried by Arrow: how many vowels a string has."""

    def count(text: str | None) -> int | None:
        return None if text is None else sum(c in "aeiou" for c in text)

    return F.udf(count, "long", useArrow=True)


def unaccented(value: Column) -> Column:
    """A vectorised function: letters without their accents and other marks.

    The decomposed forms, of two to four bytes a character, are held for one text at a time and not for a whole batch.
    """

    def plain(text: str) -> str:
        return text if text.isascii() else normalize("NFC", MARKS.sub("", normalize("NFD", text)))

    @F.pandas_udf("string")
    def strip(values: pd.Series) -> pd.Series:
        return values.map(plain, na_action="ignore")

    return strip(value)


def buffered(value: Column) -> Column:
    """A vectorised function over an iterator of batches, for state that is costly to make: made once a task."""

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = str.maketrans("", "", "0123456789")
        for batch in batches:
            yield batch.map(lambda s: None if s is None else len(s.translate(table)))

    return lengths(value)


def deviation() -> object:
    """An aggregate from a series to one value: the median distance from the median. A group has to fit one task."""

    @F.pandas_udf("double")
    def of(values: pd.Series) -> float:
        return float((values - values.median()).abs().median())

    return of


def digits() -> object:
    """A table function: a row for each decimal digit of a number, with its place from the right."""

    class Digits:
        def eval(self, number: int):
            for place, digit in enumerate(reversed(str(abs(number)))):
                yield place, int(digit)

    return F.udtf(Digits, returnType="place int, digit int", useArrow=True)


def smoothed(df: DataFrame, by: str, order: str, value: str, weight: float) -> DataFrame:
    """A grouped map: each group's rows in order, with the exponentially smoothed value so far. A group has to fit one task."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order)
        return group.assign(smooth=group[value].ewm(alpha=weight, adjust=False).mean())

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.groupBy(by).applyInPandas(run, f"{fields}, smooth double")


def sizes(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """A cogrouped map: rows of a key on both sides."""

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "n_left": [len(a)], "n_right": [len(b)]})

    return left.groupBy(by).cogroup(right.groupBy(by)).applyInPandas(run, "key long, n_left long, n_right long")
