"""Quality rules: counts with fixed limits, then a calibrated logistic regression over hashed n-grams.

The model sees each text as relative frequencies of hashed words, word pairs and character n-grams. It is fitted on a
bounded sample of labelled rows, calibrated by Platt's method on the part of that sample that the fit has not seen, and
scores whole texts in Arrow batches against a fixed threshold. The sample has SAMPLE different labelled texts at most,
by a hash of their ids, and of those, in that order, the ones that fit into SAMPLE_BYTES bytes of text. A text gives
some ten bytes of features a byte at most, so the one task that fits holds ten times SAMPLE_BYTES at most.

Defined results: a null text counts as empty (no words, base_failed); a very long text is scored whole, in one piece;
rows with null or repeated ids are scored as any other row, and repeated rows count once in the sample; labels without a document or with a null label are left out of the sample; with no labelled rows, or with
one class only, there is no model and every row that passes the base rules is kept; an empty table gives no rows; only
the id and text columns are read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwheel.llm.textarrays import WHITE, Block, blocks, grams, owners, released, repeats, sums_by

#: Most labelled rows that the model is fitted on, and most bytes of their texts.
SAMPLE, SAMPLE_BYTES = 3000, 24 << 20
#: Share of the sample held back from the fit, for calibration.
HELD = 0.3
#: A text is kept from this calibrated probability on.
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Hash buckets for each family of features: words, word pairs, characters in threes and in fives.
BITS, CHARS = 15, (3, 5)
FAMILIES = 2 + len(CHARS)
#: What relative frequencies are multiplied by in the fit, so that half precision holds them well.
STRETCH = 30.0
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Model:
    """Weights by hash bucket, all families end to end; then bias, and scale and shift of the calibration."""

    weights: np.ndarray
    bias: float
    scale: float
    shift: float

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * (score + self.bias) + self.shift, -40, 40)))


def base_counts(block: Block) -> dict[str, np.ndarray]:
    """The base rules' counts for each text of the block."""
    starts, ends, firsts = block.words()
    of, data = owners(firsts), block.data
    bytes_of = lambda mask: sums_by(mask, block.offsets)
    h = block.hashes(starts, ends)
    shingles, at = grams(h, of, 3)
    again, _ = repeats(of[at], shingles)
    covered = np.zeros(len(h) + 2, bool)
    for k in range(3):
        covered[at[again] + k] = True
    line_from, line_to, line_firsts = block.lines()
    with_word = np.searchsorted(starts, line_to) > np.searchsorted(starts, line_from)
    line_of = owners(line_firsts)
    _, later = repeats(line_of[with_word], block.hashes(line_from[with_word], line_to[with_word]))
    return {
        "n_words": np.diff(firsts),
        "word_chars": bytes_of(~WHITE[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": bytes_of(_SYMBOL[data]),
        "n_dup_lines": np.bincount(line_of[with_word][later], minlength=len(firsts) - 1),
        "n_repeat_words": sums_by(covered[: len(h)], firsts),
    }


def features(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family: hash bucket of each occurrence, and where each text's occurrences begin."""
    starts, ends, firsts = block.words()
    of, mask = owners(firsts), np.uint64((1 << BITS) - 1)
    h = block.hashes(starts, ends)
    pair, at = grams(h, of, 2)
    chars = np.append(np.flatnonzero((block.data & 0xC0) != 0x80), len(block.data))
    char_firsts = np.searchsorted(chars[:-1], block.offsets)
    for k, (values, begin) in enumerate(_families(block, h, firsts, pair, at, chars, char_firsts, owners(char_firsts))):
        yield (values & mask).astype(np.int64) + (k << BITS), begin


def _families(block: Block, h, firsts, pair, at, chars, char_firsts, char_of) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    yield h, firsts
    yield pair, np.searchsorted(at, firsts)
    for n in CHARS:
        from_ = np.flatnonzero(char_of[: max(0, len(char_of) - n + 1)] == char_of[n - 1 :])
        yield block.rolling(chars[from_], chars[from_ + n]), np.searchsorted(from_, char_firsts)


def scores(block: Block, weights: np.ndarray) -> np.ndarray:
    """Sum over the families of the mean weight of a text's occurrences."""
    total = np.zeros(len(block.offsets) - 1)
    for index, begin in features(block):
        total += sums_by(weights[index], begin) / np.maximum(1, np.diff(begin))
    return total


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, by, text) to (label, by, buckets as int32 bytes, relative frequencies as float16 bytes)."""
    released()
    for batch in batches:
        out: list[tuple] = []
        for at, to, data, offsets in blocks(batch.column("text")):
            parts: list[list] = [[] for _ in range(to - at)]
            for index, begin in features(Block(data, offsets)):
                for r in range(to - at):
                    bucket, n = np.unique(index[begin[r] : begin[r + 1]], return_counts=True)
                    parts[r].append((bucket, n / max(1, n.sum())))
            out += [(np.concatenate([b for b, _ in p]).astype(np.int32).tobytes(), (np.concatenate([v for _, v in p]) * STRETCH).astype(np.float16).tobytes()) for p in parts]
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("by"), pa.array([b for b, _ in out], pa.binary()), pa.array([v for _, v in out], pa.binary())], ["label", "by", "buckets", "shares"])
    released()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Fits and calibrates on at most `sample` labelled rows of `most_bytes` bytes in all; None where labels or classes are wanting."""
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
        .where("id is not null and label is not null")
        .distinct()
        .withColumn("by", F.xxhash64(F.lit(7), "id"))
        .orderBy("by", "id", "label")
        .limit(sample)  # the bound of what is broadcast
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").withColumn("hash", F.xxhash64("text"))
    # an id can have any number of rows: without their texts, `sample` of them come to the driver
    own = ["by", "id", "label", "hash"]
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")
    found, left = [], most_bytes
    for r in rows.select(*own, size).distinct().orderBy(*own).limit(sample).collect():
        if r["size"] <= left:
            left -= r["size"]
            found.append((r["by"], r["id"], r["label"], r["hash"]))
    if not found:
        return None
    kept = docs.sparkSession.createDataFrame(found, rows.select(*own).schema)
    rows = rows.join(F.broadcast(kept), own).dropDuplicates(own).select("label", "by", "text")
    counted = rows.mapInArrow(_counted, "label double, by long, buckets binary, shares binary")
    # one task fits, as the sample is bounded; the driver gets the weights alone
    out = counted.repartition(1).mapInArrow(_fitted, "weights binary, bias double, scale double, shift double").collect()
    return Model(np.frombuffer(out[0]["weights"], np.float64), *out[0][1:]) if out else None


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sample's features to the model, one row; no row where there is none."""
    released()
    held = [batch for batch in batches if batch.num_rows]
    if held and (model := train(pa.Table.from_batches(held))):
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias], "scale": [model.scale], "shift": [model.shift]})
    held.clear()
    released()


class _Rows:
    """Sparse rows of an Arrow table; a pass takes some hundred at a time, and nothing is kept but views of the table."""

    def __init__(self, table: pa.Table, order: np.ndarray):
        self.y = table.column("label").to_numpy()[order] > 0.5
        buckets, shares = (table.column(k) for k in ("buckets", "shares"))
        self.index = [np.frombuffer(buckets[k].as_buffer(), np.int32) for k in order.tolist()]
        self.value = [np.frombuffer(shares[k].as_buffer(), np.float16) for k in order.tolist()]

    def scores(self, w: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Each hundred rows; their buckets, values and rows entry by entry; their scores."""
        for a in range(0, len(self.index), 100):
            at = slice(a, min(a + 100, len(self.index)))
            index, value = np.concatenate(self.index[at]), np.concatenate(self.value[at]).astype(np.float64)
            row = np.repeat(np.arange(at.stop - a), [len(x) for x in self.index[at]])
            yield at, index, value, row, np.bincount(row, value * w[index], at.stop - a)


def train(table: pa.Table, steps: int = 120, penalty: float = 2e-3) -> Model | None:
    """Logistic regression by accelerated gradient steps over (label, by, buckets, shares); then Platt's calibration.

    The rows are sorted by the hash `by`, which also chooses those that are held back, so the partitions don't matter.
    """
    by = table.column("by").to_numpy()
    order = np.lexsort((np.array([len(x.as_buffer()) for x in table.column("buckets")], dtype=np.int64), table.column("label").to_numpy(), by))
    held = ((by >> 8) % 100 < int(100 * HELD))[order]
    seen, kept = (_Rows(table, order[k]) for k in (~held, held))
    if len(set(seen.y.tolist())) < 2:
        return None
    dims, n, share = FAMILIES << BITS, len(seen.y), seen.y.mean()
    class_weight = np.where(seen.y, 0.5 / share, 0.5 / (1 - share)) / n
    w, bias, mean, square = np.zeros(dims), 0.0, np.zeros(dims + 1), np.zeros(dims + 1)
    for t in range(1, steps + 1):
        grad = np.append(penalty * w / n, 0.0)
        for at, index, value, row, z in seen.scores(w):
            error = class_weight[at] * (1 / (1 + np.exp(-np.clip(z + bias, -40, 40))) - seen.y[at])
            grad[:-1] += np.bincount(index, value * error[row], dims)
            grad[-1] += error.sum()
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        step = 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-7)
        w, bias = w - step[:-1], bias - step[-1]
    scale, shift = 1.0, 0.0
    if len(set(kept.y.tolist())) == 2:
        z = np.concatenate([z for *_, z in kept.scores(w)]) + bias
        scale, shift = calibrated(z, kept.y.astype(float))
    return Model(w * STRETCH, float(bias), scale, shift)


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's scale and shift for scores z of rows y, with his softened targets, by Newton's steps."""
    good = y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    spread = max(1e-6, float(np.std(z)))
    x = np.stack([z / spread, np.ones(len(z))])
    a = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ x, -30, 30)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        a = a - np.clip(np.linalg.solve(hessian, x @ (p - target)), -2, 2)
    return max(1e-6, float(a[0]) / spread), float(a[1])


def judged(column: pa.Array, model: Model | None, threshold: float = THRESHOLD) -> dict[str, np.ndarray]:
    """All the columns of the verdict for a column of texts."""
    parts: list[dict[str, np.ndarray]] = []
    for _, _, data, offsets in blocks(column):
        block = Block(data, offsets)
        row = base_counts(block)
        row["probability"] = model.probability(scores(block, model.weights)) if model else np.ones(len(offsets) - 1)
        parts.append(row)
    names = (*_BASE, "probability")
    out = {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in names}
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["probability"] >= threshold)
    return out


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: its id, the counts, the calibrated probability, base_failed and kept."""
    kinds = {**dict.fromkeys(_BASE, pa.int64()), "base_failed": pa.bool_(), "kept": pa.bool_(), "probability": pa.float64()}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judged(batch.column(1), shared.value, threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[k]).cast(kind) for k, kind in kinds.items())], [id_col, *kinds])
        released()

    spark_of = {pa.int64(): T.LongType(), pa.bool_(): T.BooleanType(), pa.float64(): T.DoubleType()}
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(k, spark_of[v]) for k, v in kinds.items())])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with all their columns."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()  # what the tasks of a former stage have left
        for batch in (whole.slice(k, 1000) for whole in batches for k in range(0, whole.num_rows, 1000)):
            yield batch.filter(pa.array(judged(batch.column(at), shared.value, threshold)["kept"], pa.bool_()))
        released()

    return docs.mapInArrow(run, docs.schema)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fit(docs, labels))
