"""The nearest vectors by comparing all pairs, in blocks of both sides and by matrix products.

A task has one pair of blocks, whatever the tables' sizes, and k rows of an asked vector leave it. The products only tell
which rows can be among the k: the greatest of each GROUP of rows is kept, and the groups that reach the k-th are summed
again in the order of the arrays, as `functions.vectors.inner_product` does, so similarities and ties are the same to the
last bit. The work is asked x rows all the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwheel.functions.vectors import inner_product
from tarnwheel.operators import relational

#: Numbers in a block of asked vectors and of rows at most, and rows that a block has at least.
ASKED, ROWS, LEAST = 1 << 19, 1 << 22, 4096
#: A matrix product has some asked vectors by TILE rows; so many of these share a greatest one.
AT_ONCE, TILE, GROUP = 256, 2048, 32
#: Rows that are summed again at once.
AGAIN = 1 << 14
#: Vectors with a number beyond this go by `relational.nearest`, so that no product overflows.
LARGE = 1e100


def nearest(asked: DataFrame, rows: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(asked, id, similarity): for each asked row its k most similar others by the inner product; ties by id.

    Rows without a vector, with a null, NaN or LARGE number in it, or of another length than most, and rows without an id
    go by `relational.nearest`, whose rules hold for all.
    """
    spark, v = asked.sparkSession, F.col(vector_col)
    asked, rows = asked.select(id_col, vector_col), rows.select(id_col, vector_col)
    odd = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) > LARGE)
    length = F.when(F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, odd), F.nullif(F.size(v), F.lit(0)))
    sizes = {r.dim: r.n for r in rows.groupBy(length.alias("dim")).agg(F.count("*").alias("n")).collect()}  # a row a length
    dim = max((d for d in sizes if d), key=lambda d: (sizes[d], d), default=None)
    fits = length.eqNullSafe(F.lit(dim).cast("int")) if dim else F.lit(False)
    n_asked = {r.fits: r.n for r in asked.groupBy(fits.alias("fits")).agg(F.count("*").alias("n")).collect()}

    def singly(a: DataFrame, b: DataFrame) -> DataFrame:
        return relational.nearest(a, b, id_col, inner_product(F.col(f"asked_{vector_col}"), v), k)

    if not dim or not n_asked.get(True):
        return singly(asked, rows)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a_blocks = -(-n_asked[True] // max(1, ASKED // dim))
    r_blocks = max(-(-sizes[dim] // max(1, ROWS // dim)), min(-(-parts // a_blocks), -(-sizes[dim] // LEAST)))
    schema = rows.schema
    kind = schema[id_col].dataType.simpleString()
    number = "float" if schema[vector_col].dataType.elementType.simpleString() == "float" else "double"

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit(own), id_col), F.lit(blocks)).cast("int").alias(own)
        one = df.where(fits).select(F.col(id_col).alias("id"), v.cast(f"array<{number}>").alias("v"), block)
        return one.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).repartition(2 * a_blocks * r_blocks, "a", "r")

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        i, j, s = best_of(left, right, dim, k)
        return pa.table({"asked": left.column("id").combine_chunks().take(pa.array(i)), id_col: right.column("id").combine_chunks().take(pa.array(j)), "similarity": pa.array(s)})

    a, b = dealt(asked, "a", a_blocks, "r", r_blocks), dealt(rows, "r", r_blocks, "a", a_blocks)
    met = a.groupBy("a", "r").cogroup(b.groupBy("a", "r")).applyInArrow(compared, f"asked {kind}, `{id_col}` {kind}, similarity double")
    if len(n_asked) > 1:
        met = met.union(singly(asked.where(~fits), rows))
    if len(sizes) > 1:
        met = met.union(singly(asked.where(fits), rows.where(~fits)))
    return relational.top_k(met, ["asked"], [F.desc("similarity"), F.asc(id_col)], k)


def best_of(left: pa.Table, right: pa.Table, dim: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(asked one, row, similarity): of each asked one the k best rows with another id."""
    if not left.num_rows or not right.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    both = pc.dictionary_encode(pa.chunked_array([*left.column("id").chunks, *right.column("id").chunks]).combine_chunks())
    code = both.indices.to_numpy()
    own, other = code[: left.num_rows], code[left.num_rows :]
    copies = int(np.bincount(other).max())  # rows of one id; 1 where ids are unique
    by_id = pc.sort_indices(right.column("id").combine_chunks()).to_numpy().astype(np.int64)
    x = _matrix(right.column("v"), dim)[by_id]
    # of equal vectors no more than the first by id can be in a result
    same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * dim)))[:, 0], return_inverse=True)[1].ravel()
    order = np.argsort(same, kind="stable")
    first = np.concatenate([[True], same[order][1:] != same[order][:-1]])
    place = np.arange(len(x)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    keep = np.sort(order[place < k + copies])
    by_id, x, other = by_id[keep], x[keep].astype(np.float64), other[by_id[keep]]
    q, n = _matrix(left.column("v"), dim).astype(np.float64), len(x)
    slack = 4 * dim * np.finfo(np.float64).eps * np.sqrt((x**2).sum(1).max())
    tiles, lanes = -(-n // TILE), TILE // GROUP
    out = []
    for a in range(0, len(q), AT_ONCE):
        some = q[a : a + AT_ONCE]
        most = np.empty((len(some), tiles * lanes))
        for t in range(tiles):
            found = some @ x[t * TILE : (t + 1) * TILE].T
            if found.shape[1] < TILE:
                found = np.concatenate([found, np.full((len(some), TILE - found.shape[1]), -np.inf)], 1)
            found.reshape(len(some), GROUP, lanes).max(1, out=most[:, t * lanes : (t + 1) * lanes])
        at = most.shape[1] - (k + copies)
        least = np.partition(most, at, axis=1)[:, at] if at >= 0 else np.full(len(some), -np.inf)
        least = least - slack * np.sqrt((some**2).sum(1))
        of, group = np.nonzero((most >= least[:, None]) & (most > -np.inf))
        mine = []
        for c in range(0, len(of), AGAIN // GROUP):
            i = np.repeat(of[c : c + AGAIN // GROUP], GROUP)
            g = group[c : c + AGAIN // GROUP]
            j = ((g // lanes * TILE + g % lanes)[:, None] + np.arange(GROUP) * lanes).ravel()
            i, j = i[j < n], j[j < n]
            differs = own[a + i] != other[j]
            i, j = i[differs], j[differs]
            left_side, right_side, sums = some[i], x[j], np.zeros(len(i))
            for d in range(dim):
                sums += left_side[:, d] * right_side[:, d]
            mine.append(_first(i, j, sums, k))  # nonzero goes row by row, so an asked one's rows stand together
        i, j, s = _first(*(np.concatenate(z) for z in zip(*mine, strict=True)), k) if mine else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        out.append((a + i, by_id[j], s))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def _first(i: np.ndarray, j: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k rows of each i with the greatest s, ties by j."""
    order = np.lexsort((j, -s, i))
    i, j, s = i[order], j[order], s[order]
    begin = np.concatenate([[True], i[1:] != i[:-1]]) if len(i) else np.zeros(0, bool)
    place = np.arange(len(i)) - np.flatnonzero(begin)[np.cumsum(begin) - 1] if len(i) else np.zeros(0, np.int64)
    return i[place < k], j[place < k], s[place < k]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
