"""Which language a paragraph is in: character n-grams with back-off, counted on labelled texts, scored in Arrow batches.

`fit` counts grams of one to ORDER characters by language in Spark, over a share of the labelled texts that makes some
FIT_TEXTS of them, and keeps the MODEL most frequent (language, gram) counts: both are bounds of what is fitted, and so
of what is sent to each worker. A character c after h has the probability n(hc) / n(h); where hc wasn't seen in a
language, BACK_OFF times that of c after a shorter h, and at last FLOOR. A paragraph is a line with a letter; its language
is the one of the largest mean logarithm, a text's the one of the largest mean over its paragraphs' characters (ties: the
first by name).

Characters are lower-cased, white space runs are one blank. Code points over U+FFFF count as one character.

Defined results: a null, empty or letterless text has no paragraphs and no language; null labels take no part in a fit; a
fit without labelled texts finds no language anywhere; texts are read whole; repeated rows count and come out each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER, BACK_OFF, FLOOR = 4, 0.4, 1e-7
FIT_TEXTS, MODEL = 20_000, 400_000
#: Characters that are scored at once.
AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Model:
    """Sorted grams, and the log probability of each one's last character after the others in each language (NaN: not seen)."""

    languages: tuple[str, ...]
    grams: np.ndarray
    scores: np.ndarray


def paragraphs(text: str | None) -> list[tuple[int, str]]:
    """(number of the line, its plain form) of lines with a letter."""
    lines = ((k, " ".join(x.lower().split())) for k, x in enumerate((text or "").split("\n")))
    return [(k, x) for k, x in lines if any(c.isalpha() for c in x)]


def _points(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of lines, a blank before each, and where each line begins; 16 bits a character."""
    whole = " " + " ".join(lines)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    return np.minimum(points, 0xFFFF).astype(np.uint64), np.cumsum([0, *(len(x) + 1 for x in lines)])


def _grams(points: np.ndarray, begins: np.ndarray, order: int) -> np.ndarray:
    """For each character the gram of `order` characters that it ends, fewer where its line begins."""
    out = points.copy()
    at = np.arange(len(points)) - np.repeat(begins[:-1], np.diff(begins))
    for k in range(1, order):
        back = np.zeros_like(points)
        back[k:] = points[:-k]
        out |= np.where(at >= k, back << np.uint64(16 * k), np.uint64(0))
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, text) to (language, gram, n)."""
    for batch in batches:
        by: dict[str, list[str]] = {}
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by.setdefault(language, []).extend(x for _, x in paragraphs(text))
        for language, lines in by.items():
            if not lines:
                continue
            points, begins = _points(lines)
            for order in range(1, ORDER + 1):
                grams, n = np.unique(_grams(points, begins, order), return_counts=True)
                some = grams >> np.uint64(16 * (order - 1)) > 0  # those of full length
                yield pa.RecordBatch.from_arrays([pa.array([language] * int(some.sum()), pa.string()), pa.array(grams[some].view(np.int64)), pa.array(n[some])], ["lang", "gram", "n"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = FIT_TEXTS, most: int = MODEL) -> Model:
    """A model of the languages in lang_col."""
    labelled = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    share = min(1.0, texts / max(1, labelled.count()))
    some = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    counts = some.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    kept = counts.orderBy(F.desc("n"), "lang", "gram").limit(most).toPandas()
    languages = tuple(sorted(kept["lang"].unique()))
    grams = np.unique(kept["gram"].to_numpy().view(np.uint64))
    table = np.full((len(grams) + 1, max(1, len(languages))), 0.0)
    for k, name in enumerate(languages):
        mine = kept[kept["lang"] == name]
        table[np.searchsorted(grams, mine["gram"].to_numpy().view(np.uint64)), k] = mine["n"]
    # what a gram's last character comes after: the gram without it, or for single characters all of them
    before = np.searchsorted(grams, grams >> np.uint64(16))
    before = np.where(np.append(grams, 0)[before] == grams >> np.uint64(16), before, len(grams))
    single = grams < 1 << 16
    after = np.where(single[:, None], table[:-1][single].sum(0)[None, :], table[before])
    with np.errstate(divide="ignore", invalid="ignore"):
        scores = np.log(np.where((table[:-1] > 0) & (after > 0), table[:-1] / after, np.nan))
    return Model(languages, grams, np.minimum(scores, 0).astype(np.float32))


def score(model: Model, lines: list[str]) -> np.ndarray:
    """lines x languages: sums of log probabilities."""
    points, begins = _points(lines)
    out = np.full((len(points), len(model.languages)), np.nan, np.float32)
    for order in range(ORDER, 0, -1):
        grams = _grams(points, begins, order)
        at = np.minimum(np.searchsorted(model.grams, grams), len(model.grams) - 1)
        found = np.where((model.grams[at] == grams)[:, None], model.scores[at], np.nan) + np.float32((ORDER - order) * np.log(BACK_OFF))
        out = np.where(np.isnan(out), found, out)
    out = np.where(np.isnan(out), np.float32(np.log(FLOOR)), out)
    return np.add.reduceat(out.astype(np.float64), begins[:-1], axis=0)


SCHEMA = "found string, n_paragraphs int, paragraphs array<struct<line: int, n_chars: int, found: string>>"


def _scored(batches: Iterator[pa.RecordBatch], model: Model, names: list[str]) -> Iterator[pa.RecordBatch]:
    """(columns ..., text) to the columns and SCHEMA."""
    kind = pa.list_(pa.struct([("line", pa.int32()), ("n_chars", pa.int32()), ("found", pa.string())]))
    for batch in batches:
        found, parts = [], []
        pending: list[tuple[int, str]] = []
        verdicts: list[np.ndarray] = []
        each = [paragraphs(t) if model.languages else [] for t in batch.column(batch.num_columns - 1).to_pylist()]
        size = 0
        for line in (x for some in each for _, x in some):
            pending.append(line)
            size += len(line)
            if size * len(model.languages) > AT_ONCE:
                verdicts.append(score(model, pending))
                pending, size = [], 0
        if pending:
            verdicts.append(score(model, pending))
        sums = np.concatenate(verdicts) if verdicts else np.zeros((0, 1))
        at = 0
        for some in each:
            mine = sums[at : at + len(some)]
            at += len(some)
            found.append(model.languages[int(mine.sum(0).argmax())] if some else None)
            parts.append([{"line": k, "n_chars": len(x), "found": model.languages[int(s.argmax())]} for (k, x), s in zip(some, mine, strict=True)])
        rest = [batch.column(k) for k in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.string()), pa.array([len(x) for x in parts], pa.int32()), pa.array(parts, kind)], [*names, "found", "n_paragraphs", "paragraphs"])


def languages(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text") -> DataFrame:
    """The columns, the language found for each text, the number of its paragraphs, and (line, n_chars, found) of each."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # MODEL counts at most
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*columns, text_col).mapInArrow(lambda it: _scored(it, sent.value, columns), f"{schema}, {SCHEMA}")
