"""Nearest vectors by an inverted index with residual product quantisation, and an exact ranking of what it finds.

1. Fit, on SAMPLE vectors at most (by a hash of their values, on the driver): k-means gives some sqrt(n) lists, LISTS at
   most; the residuals to a list's centre are cut into PARTS slices, and k-means gives CODES centres for each slice.
2. Index: equal vectors are one row with their KEPT least ids, which is all that a ranking can take of them; every such
   row gets its list and PARTS code bytes. Lists are cut into blocks of BLOCK rows, so a hot list is no hot task.
3. Search: a query goes to the blocks of its nearest lists, as many as hold AIM of the ten nearest of TRIED vectors of the
   sample within the sample: few where vectors form clusters, many where they don't. A block's task compares codes by tables of distances,
   ranks the RANKED best by their real similarity and sends on as many of each query as can be in the result.
4. The best of all blocks are ranked; each asked id leaves itself out.

Similarity is the inner product in doubles (cosine for vectors of unit length). Results are right in their similarities;
neighbours can be missed, `tests/test_vectorindex.py` measures how many.

Defined results: null or empty vectors, those with a null or NaN in them, and those of another length than most of the
sample take no part; ties go to the least id; ids are unique, or repeat in the result; an empty table gives no rows; other
columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwheel.session import Held

SAMPLE, LISTS, PARTS, CODES = 20_000, 4096, 8, 256
RANKED, BLOCK = 200, 8192
AIM, TRIED = 0.97, 400
#: Numbers of a step that a task has in memory at once, and queries that it gets at most.
AT_ONCE, ASKED = 1 << 21, 8192


@dataclass(frozen=True)
class Index:
    """Centres of lists, and centres of each slice's residuals: (lists, dim), (parts, codes, width); lists to search."""

    lists: np.ndarray
    codes: np.ndarray
    probes: int

    @property
    def dim(self) -> int:
        return self.lists.shape[1]

    def residual(self, x: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Residuals cut into slices: (n, parts, width), filled up with zeros."""
        parts, _, width = self.codes.shape
        flat = np.zeros((len(x), parts * width), np.float32)
        flat[:, : self.dim] = x - self.lists[of]
        return flat.reshape(len(x), parts, width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each vector, and its code bytes."""
        of = nearest_centres(x, self.lists, 1)[:, 0]
        slices = self.residual(x, of)
        return of, np.stack([nearest_centres(slices[:, p], self.codes[p], 1)[:, 0] for p in range(len(self.codes))], 1).astype(np.uint8)


def nearest_centres(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row, nearest first."""
    out = []
    norm = (centres**2).sum(1)
    for a in range(0, len(x), max(1, AT_ONCE // len(centres))):
        d = norm[None, :] - 2 * x[a : a + max(1, AT_ONCE // len(centres))] @ centres.T
        if n == 1:
            out.append(d.argmin(1)[:, None])
        else:
            some = np.argpartition(d, min(n, d.shape[1]) - 1, axis=1)[:, :n]
            out.append(np.take_along_axis(some, np.take_along_axis(d, some, 1).argsort(1, kind="stable"), 1))
    return np.concatenate(out) if out else np.zeros((0, n), np.int64)


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k centres of the rows of x, or fewer where there are fewer different rows; begun at random rows."""
    rows = np.unique(x, axis=0)
    centres = rows[np.random.default_rng(seed).permutation(len(rows))[:k]].astype(np.float32)
    for _ in range(rounds):
        of = nearest_centres(x, centres, 1)[:, 0]
        n = np.bincount(of, minlength=len(centres))
        sums = np.zeros(centres.shape, np.float64)
        np.add.at(sums, of, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres).astype(np.float32)
    return centres


def fit(vectors: DataFrame, vector_col: str = "embedding", sample: int = SAMPLE) -> Index | None:
    """An index of a sample of the vectors' values; None where there are none."""
    some = vectors.where((F.size(vector_col) > 0) & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x))).select(F.col(vector_col).cast("array<float>").alias("v"))
    n = some.count()
    if not n:
        return None
    share = min(1.0, sample / n)
    rows = some.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < max(1, int(share * (1 << 30)))).limit(2 * sample).toPandas()["v"]
    rows = rows if len(rows) else some.limit(sample).toPandas()["v"]
    sizes, counts = np.unique([len(v) for v in rows], return_counts=True)
    dim = int(sizes[counts.argmax()])
    x = np.stack([v for v in rows if len(v) == dim]).astype(np.float32)
    lists = k_means(x, max(1, min(LISTS, int(n**0.5), len(x))))
    of = nearest_centres(x, lists, 1)[:, 0]
    width = -(-dim // PARTS)
    flat = np.zeros((len(x), PARTS * width), np.float32)
    flat[:, :dim] = x - lists[of]
    books = [k_means(flat[:, p * width : (p + 1) * width], CODES) for p in range(PARTS)]
    codes = np.stack([np.concatenate([b, np.repeat(b[:1], CODES - len(b), axis=0)]) for b in books])
    return Index(lists, codes, probes(x, of, lists))


def probes(x: np.ndarray, of: np.ndarray, lists: np.ndarray, k: int = 10) -> int:
    """How many nearest lists hold AIM of the k nearest of TRIED of the rows among all rows; of: the list of each row."""
    tried = np.random.default_rng(11).permutation(len(x))[:TRIED]
    sims = x[tried] @ x.T
    sims[np.arange(len(tried)), tried] = -np.inf
    k = min(k, len(x) - 1)
    if not k:
        return 1
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    place = np.empty((len(tried), len(lists)), np.int64)
    np.put_along_axis(place, nearest_centres(x[tried], lists, len(lists)), np.arange(len(lists))[None, :], 1)
    return int(np.ceil(np.quantile(np.take_along_axis(place, of[best], 1), AIM))) + 1


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float32) if len(column) else np.zeros((0, 1), np.float32)


def _encoded(batches, index: Index):
    for batch in batches:
        if batch.num_rows:
            of, codes = index.encode(_matrix(batch.column(2)))
            raw = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of.astype(np.int32)), raw], ["node", "ids", "v", "list", "code"])


def _probed(batches, index: Index, probed: int):
    for batch in batches:
        if batch.num_rows:
            n = min(probed, len(index.lists))
            for a in range(0, batch.num_rows, max(1, AT_ONCE // n)):
                some = batch.slice(a, max(1, AT_ONCE // n))
                lists = nearest_centres(_matrix(some.column(1)), index.lists, n).astype(np.int32)
                ends = pa.array(np.arange(0, lists.size + 1, n, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.ListArray.from_arrays(ends, pa.array(lists.ravel()))], ["asked", "v", "lists"])


def best_of(index: Index, stored: pa.Table, asked: pa.Table, most: int, ranked: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, similarity): for each query the `most` best rows of one list, of the `ranked` best by their codes.

    Queries go in steps, such that none of a step's arrays has over AT_ONCE numbers: distances to all rows, tables of
    distances to codes, and the vectors of the rows that are ranked.
    """
    x, q = _matrix(stored.column("v")), _matrix(asked.column("v"))
    of = int(stored.column("list")[0].as_py())
    codes = np.frombuffer(b"".join(stored.column("code").to_pylist()), np.uint8).reshape(len(x), -1)
    parts, _, width = index.codes.shape
    out = []
    step = max(1, AT_ONCE // max(len(x), index.codes.shape[0] * index.codes.shape[1], min(ranked, len(x)) * index.dim))
    for a in range(0, len(q), step):
        some = q[a : a + step]
        flat = np.zeros((len(some), parts * width), np.float32)
        flat[:, : index.dim] = some
        tables = np.einsum("qpw,pcw->qpc", flat.reshape(len(some), parts, width), index.codes)  # inner products with residuals' codes
        near = (some @ index.lists[of])[:, None] + sum(tables[:, p, codes[:, p]] for p in range(parts))
        top = np.argpartition(-near, min(ranked, len(x)) - 1, axis=1)[:, :ranked]
        real = np.einsum("qd,qrd->qr", some.astype(np.float64), x[top].astype(np.float64))
        first = np.argsort(-real, axis=1, kind="stable")[:, :most]
        out.append((np.repeat(np.arange(a, a + len(some)), first.shape[1]), np.take_along_axis(top, first, 1).ravel(), np.take_along_axis(real, first, 1).ravel()))
    return tuple(np.concatenate(k) for k in zip(*out, strict=True))


def nearest(vectors: DataFrame, asked: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", index: Index | None = None, probed: int | None = None, ranked: int = RANKED, block: int = BLOCK) -> DataFrame:
    """(asked, id, similarity): for each row of `asked` the k most similar of `vectors` that the index finds, its own id left out."""
    spark, held = vectors.sparkSession, Held(vectors.sparkSession)
    index = index or fit(vectors, vector_col)
    kind = vectors.schema[id_col].dataType.simpleString()
    if index is None:
        return spark.createDataFrame([], f"asked {kind}, `{id_col}` {kind}, similarity double")
    sent = spark.sparkContext.broadcast(index)  # LISTS * dim + CODES * dim numbers at most

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vector_col).cast("array<float>")
        return df.where((F.size(vector_col) == index.dim) & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x))).select(F.col(id_col).alias("id"), v.alias("v")).withColumn("node", F.unhex(F.md5(F.col("v").cast("string"))))

    kept = k + 1
    # the least ids of equal vectors, in parts first, so that no task gets all of a hot one
    least = lambda x: F.slice(F.array_sort(x), 1, kept)
    part = usable(vectors).withColumn("part", F.spark_partition_id()).groupBy("node", "part").agg(least(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))
    rows = part.groupBy("node").agg(least(F.flatten(F.collect_list("ids"))).alias("ids"), F.first("v").alias("v"))
    coded = held(rows.mapInArrow(lambda it: _encoded(it, sent.value), f"node binary, ids array<{kind}>, v array<float>, list int, code binary"), "vector-index")
    sizes = coded.groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))  # LISTS rows at most
    queries = usable(asked)
    each = queries.groupBy("node").agg(F.first("v").alias("v")).select(F.col("node").alias("asked"), "v")
    probes = each.mapInArrow(lambda it: _probed(it, sent.value, probed or sent.value.probes), "asked binary, v array<float>, lists array<int>").select("asked", "v", F.explode("lists").alias("list"))
    shares = max(1, -(-each.count() // ASKED))  # a block meets all queries in as many tasks
    probes = probes.join(F.broadcast(sizes), "list").select("asked", "v", "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    probes = probes.withColumn("share", F.pmod(F.xxhash64("asked"), F.lit(shares)))
    stored = coded.join(F.broadcast(sizes), "list").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).drop("blocks")
    stored = stored.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast("array<long>")))

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            q, r, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            q, r, s = best_of(sent.value, left, right, kept, ranked)
        return pa.table({"asked": right.column("asked").combine_chunks().take(pa.array(q)), "ids": left.column("ids").combine_chunks().take(pa.array(r)), "similarity": pa.array(s)})

    found = stored.groupBy("list", "block", "share").cogroup(probes.groupBy("list", "block", "share")).applyInArrow(compared, f"asked binary, ids array<{kind}>, similarity double")
    order = Window.partitionBy("asked").orderBy(F.desc("similarity"), "id")
    best = found.select("asked", F.explode("ids").alias("id"), "similarity").withColumn("place", F.row_number().over(order)).where(F.col("place") <= kept)
    best = held(best, "vector-best")
    told = queries.select(F.col("id").alias("_asked"), F.col("node").alias("asked")).join(best, "asked").where("_asked <> id")
    own = told.withColumn("place", F.row_number().over(Window.partitionBy("_asked").orderBy("place"))).where(F.col("place") <= k)
    out = own.select(F.col("_asked").alias("asked"), F.col("id").alias(id_col), "similarity")
    held.release(out)
    return out
