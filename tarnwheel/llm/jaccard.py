"""Exact n-gram Jaccard self-join by a token-group matrix.

Documents with equal sets of shingles are one node. Nodes are dealt into groups of similar ones: all with the same key
token, cut into parts of about GROUP nodes or TOKENS tokens, whichever is less. The matrix has a row (token, group) for
each token in the union of a group's prefixes. Each node queries it with its own prefix; a group can hold a partner
only where the overlap is large enough and the sizes allow it, and only such groups are opened.

Groups are opened in three steps, since what comes out are components and not all pairs:

1. Every group is compared with itself, all pairs exactly by products of incidence matrices, and what links is joined.
2. Of the nodes of one component that ask for the same group, one asks.
3. The other ones ask where the group still holds a node of another component than theirs.

A group whose nodes are all of the asking node's component is never opened, as no link to it could join anything. So a
cluster of near copies over many parts is sent out about twice, and not once for each of its parts.

Prefixes: a pair has at least `least(n)` tokens in common, n the size of either (at 0.9, ceil(0.9 n)), so of the first
n - least(n) + k tokens of both, in one order for all, at least k agree. k is `shared(n)`; a partner has at least
least(n) tokens, so shared(least(n)) agree whatever the partner is. The order puts common tokens last: tokens that
tasks find to make up over 1 / 2**HOT_BITS of what they see are listed with their counts, and sorted by them. The list
can leave out a token that is rare in every task, and its counts are lower bounds; the order decides how many groups
are opened, never which links are found.

Hashes have 64 bits: two of n shingles, or two of n sets, fall together with a chance of n**2 / 2**65.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing; rows with
equal ids are separate documents; ids are cast to long (an id that is no number is an error); a component's id is its
least non-null id; a very long text is a group of its own; an empty table gives no rows; columns other than id and text
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwheel.llm.components import components
from tarnwheel.llm.textarrays import Block, blocks, grams, mix, owners, released, sums_by
from tarnwheel.session import Held, written

#: Words in a shingle, and the least percentage of the union that two linked sets have in common.
SHINGLE, PERCENT = 5, 80
#: A prefix has so many tokens more than can be missing: one in SHARE, and LEAST_SHARED at least.
SHARE, LEAST_SHARED = 32, 3
HOT_BITS = 22
#: Most nodes and tokens of a part of a group (or of the queries to it), but for a part of one node.
GROUP, TOKENS = 1024, 1 << 20
#: A table is broadcast up to so many rows (of 40 bytes at most), the list of key tokens in parts up to fewer; beyond,
#: both sides are shuffled.
MOST_ROWS, MOST_TOKENS = 500_000, 100_000
NO_ID = -(1 << 63)
#: Tokens that a task counts at once; beyond, the rarer half is forgotten.
_HOT_TABLE = 1 << 19


def least(n: np.ndarray, percent: int) -> np.ndarray:
    """Fewest common tokens of a set of size n with any partner."""
    return (percent * n + 99) // 100


def shared(n: np.ndarray, percent: int) -> np.ndarray:
    """How many tokens more than can be missing a set's prefix has."""
    return np.minimum(np.maximum(LEAST_SHARED, n // SHARE), least(n, percent))


def overlap(percent: int) -> str:
    """SQL for what of its prefix a node of n tokens has in common with any partner: shared(least(n))."""
    fewest = f"(({percent} * n + 99) div 100)"
    return f"least(greatest({LEAST_SHARED}, {fewest} div {SHARE}), ({percent} * {fewest} + 99) div 100)"


def tokens(block: Block, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of a block with repeats, and the text of each."""
    starts, ends, firsts = block.words()
    of, h = owners(firsts), block.hashes(starts, ends)
    full, at = grams(h, of, shingle)
    n = np.diff(firsts)
    few = np.flatnonzero((n > 0) & (n < shingle))
    whole = np.zeros(len(few), np.uint64)
    for k in range(shingle - 1):
        has = n[few] > k
        whole[has] = mix(whole[has] + h[firsts[few][has] + k] + np.uint64(k + 77))
    return np.concatenate([full, whole]), np.concatenate([of[at], few])


def _counted(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """A task's frequent tokens with their counts, and the total under token 0, flagged."""
    keys, counts, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        k, c = (np.concatenate([x[i] for x in waiting]) for i in (0, 1))
        waiting.clear()
        order = np.argsort(k)
        k, c = k[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])[: len(k)])
        k, c = (k[first], np.add.reduceat(c, first)) if len(k) else (k, c)
        if len(k) > _HOT_TABLE:
            often = np.argpartition(c, len(c) - _HOT_TABLE // 2)[len(c) - _HOT_TABLE // 2 :]
            k, c = k[often], c[often]
        return k, c

    for batch in batches:
        for _, _, data, offsets in blocks(batch.column(0)):
            found, _ = tokens(Block(data, offsets, lower=True), shingle)
            total += len(found)
            waiting.append(np.unique(found, return_counts=True))
            if sum(len(k) for k, _ in waiting) > _HOT_TABLE:
                waiting[:] = [merged()]
    if waiting:
        keys, counts = merged()
    some = counts >= max(2, total >> (HOT_BITS + 1))
    waiting.clear()
    released()
    yield pa.RecordBatch.from_arrays([pa.array(np.append(keys[some], np.uint64(0)).view(np.int64)), pa.array(np.append(counts[some], total)), pa.array(np.append(np.zeros(int(some.sum()), bool), True))], ["token", "n", "total"])


def hot_tokens(docs: DataFrame, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens with over 1 / 2**HOT_BITS of all occurrences, sorted, and their counts; fewer than 2**HOT_BITS."""
    counted = docs.select(text_col).mapInArrow(lambda it: _counted(it, shingle), "token long, n long, total boolean")
    counts = written(counted.groupBy("token", "total").agg(F.sum("n").alias("n")), "hot-tokens")
    total = counts.where("total").agg(F.sum("n")).first()[0] or 0
    hot = counts.where(~F.col("total") & (F.col("n") > max(8, total >> HOT_BITS))).select("token", "n").toArrow()
    keys = hot.column("token").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], hot.column("n").to_numpy()[order]


def _sets(batches: Iterator[pa.RecordBatch], hot: tuple[np.ndarray, np.ndarray], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(id, text, hash of the text) to (id, hash, node, n, key, prefix)."""
    for batch in batches:
        parts = []
        for _, _, data, offsets in blocks(batch.column(1)):
            found, of = tokens(Block(data, offsets, lower=True), shingle)
            count = np.zeros(len(found), np.int64)
            if len(hot[0]):
                where = np.minimum(np.searchsorted(hot[0], found), len(hot[0]) - 1)
                count = np.where(hot[0][where] == found, hot[1][where], 0)
            found, of, count = _distinct(found, of, count)
            firsts = np.searchsorted(of, np.arange(len(offsets)))
            n = np.diff(firsts)
            node = _node(found, firsts)
            size = n - least(n, percent) + shared(n, percent)
            at = np.repeat(firsts[:-1], size) + _ramp(size)
            prefix, is_hot = found[at], count[at] > 0
            begin = np.concatenate([[0], np.cumsum(size)])
            cool = size - sums_by(is_hot, begin)
            key = np.zeros(len(n), np.uint64)
            some = size > 0
            key[some] = prefix[(begin[:-1] + np.where(cool < size, cool, 0))[some]]
            parts.append((node, n, key, prefix, size))
        if parts:
            node, n, key, prefix, size = (np.concatenate(x) for x in zip(*parts, strict=True))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(prefix.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(node.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(key.view(np.int64)), lists], ["id", "hash", "node", "n", "key", "prefix"])
    released()


def _distinct(found: np.ndarray, of: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of each text in the common order: by count, then hash."""
    order = np.lexsort((found, count, of))
    found, of, count = found[order], of[order], count[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[new], of[new], count[new]


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each size, end to end."""
    total = np.cumsum(sizes)
    return np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - sizes, sizes)


def _node(found: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A hash of each text's set: of the sum of its tokens' hashes, and its size."""
    total = np.zeros(len(found) + 1, np.uint64)
    np.cumsum(mix(found + np.uint64(0x51ED270B)), dtype=np.uint64, out=total[1:])
    return mix(total[firsts[1:]] - total[firsts[:-1]] + np.diff(firsts).astype(np.uint64))


def _token_sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """(text, node, roles) to (node, tokens, roles): the distinct tokens as bytes, for texts that are their node's."""
    for batch in batches:
        sets, fits = [], np.zeros(batch.num_rows, bool)
        wanted = batch.column(1).to_numpy().view(np.uint64)
        for a, b, data, offsets in blocks(batch.column(0)):
            found, of = tokens(Block(data, offsets, lower=True), shingle)
            found, of, _ = _distinct(found, of, np.zeros(len(found), np.int64))
            firsts = np.searchsorted(of, np.arange(len(offsets)))
            fits[a:b] = _node(found, firsts) == wanted[a:b]
            sets += [found[x:y].tobytes() for x, y in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sets, pa.binary()), batch.column(2)], ["node", "tokens", "roles"]).filter(pa.array(fits))
    released()


def compared(own: list[bytes], others: list[bytes] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs of sets: within `own`, or between `own` and `others`; as two arrays of positions."""
    everything = [np.frombuffer(x, np.uint64) for x in own + (others or [])]
    n = np.array([len(x) for x in everything])
    flat, of = np.concatenate(everything), np.repeat(np.arange(len(n)), n)
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    first = np.concatenate([[True], flat[1:] != flat[:-1]])
    run = np.cumsum(first) - 1
    several = np.bincount(run) > 1
    column = (np.cumsum(several) - 1)[run]
    of, column = of[several[run]], column[several[run]]  # a token of one set alone is in no intersection
    m, width = len(own), 4096
    rows = m if others is None else len(n) - m
    common = np.zeros((rows, m), np.float32)
    for at in range(0, int(several.sum()), width):
        some = slice(*np.searchsorted(column, [at, at + width]))
        table = np.zeros((len(n), min(width, int(several.sum()) - at)), np.float32)
        table[of[some], column[some] - at] = 1
        common += (table if others is None else table[m:]) @ table[:m].T
    size = n if others is None else n[m:]
    linked = 100 * common >= percent * (size[:, None] + n[None, :m] - common)
    if others is None:
        linked = np.tril(linked, -1)
    return np.nonzero(linked)


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """What the links (a, b) connect, as stars: each node with the least one of its component, which has no row."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
    return [(x, top(x)) for x in list(root) if top(x) != x]


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (gid, part, query, node, tokens) sorted by gid and part to links (a, b), group by group.

    A group without queries is compared with itself; else its queries with its members. Links come out as stars over
    what a task holds at once, which spares rounds of joining them.
    """
    now, rows = None, ([], [])
    out: list[tuple[int, int]] = []

    def close() -> None:
        own, others = rows
        node, other = (np.array([x for x, _ in side], np.int64) for side in rows)
        if len(own) > 1 and not others:
            a, b = compared([t for _, t in own], None, percent)
            out.extend(forest(node[a], node[b]))
        elif own and others:
            a, b = compared([t for _, t in own], [t for _, t in others], percent)
            out.extend(forest(other[a], node[b]))

    def flush() -> pa.RecordBatch:
        table = np.array(out, np.int64).reshape(-1, 2)
        table = np.array(forest(table[:, 0], table[:, 1]), np.int64).reshape(-1, 2)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(table[:, 0]), pa.array(table[:, 1])], ["a", "b"])

    for batch in batches:
        for gid, part, query, node, data in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if (gid, part) != now:
                close()
                now, rows = (gid, part), ([], [])
            rows[query].append((node, data))
        if len(out) > 50_000:
            yield flush()
    close()
    rows = ([], [])
    released()
    yield flush()


def _parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _small(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """df to be broadcast if a count shows that it may be; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _slot(parts: Column) -> Column:
    """A node's place among so many parts, by its hash."""
    return F.floor(F.pmod(F.xxhash64("node"), F.lit(1 << 40)) * parts / F.lit(1 << 40))


def _needed_parts() -> Column:
    """How many parts nodes with their sizes `n` are cut into."""
    return F.greatest(F.ceil(F.count("*") / F.lit(GROUP)), F.ceil(F.sum("n") / F.lit(TOKENS)))


def _links(texts: DataFrame, base: DataFrame, roles: DataFrame, shingle: int, percent: int, held: Held) -> DataFrame:
    """Links (a, b) among the nodes that `roles` (node, gid, part, query) brings together; sets are made from texts."""
    each = held(roles.groupBy("node").agg(F.collect_list(F.struct("gid", "part", "query")).alias("roles")), "roles")
    sources = base.select("node", "id", "hash").join(_small(each.select("node")), "node", "left_semi").groupBy("node").agg(F.min(F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "hash")).alias("s"))
    needed = held(each.join(sources, "node").select("s.id", "s.hash", "node", "roles"), "needed")
    few = (needed.agg(F.sum(F.size("roles"))).first()[0] or 0) <= MOST_ROWS
    sets = texts.withColumn("id", F.coalesce("id", F.lit(NO_ID))).join(F.broadcast(needed) if few else needed, ["id", "hash"]).select("text", "node", "roles")
    kind = "array<struct<gid: long, part: long, query: int>>"
    sets = sets.mapInArrow(lambda it: _token_sets(it, shingle), f"node long, tokens binary, roles {kind}").select(F.explode("roles").alias("r"), "node", "tokens").select("r.gid", "r.part", "r.query", "node", "tokens")
    return sets.repartition(_parts(texts.sparkSession), "gid", "part").sortWithinPartitions("gid", "part").mapInArrow(lambda it: _linked(it, percent), "a long, b long")


def _roots(texts: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, root) for the nodes that any links connect to a lesser one."""
    held = Held(rows.sparkSession)
    # of two different sets that link, the smaller lacks one token of the union at least (at 0.9: nine of ten)
    base = rows.where(F.col("n") >= -(-percent // max(1, 100 - percent)))
    large = base.groupBy("key").agg(_needed_parts().alias("parts")).where("parts > 1")
    base = base.join(_small(held(large, "large-keys"), MOST_TOKENS), "key", "left").withColumn("gid", F.xxhash64("key", _slot(F.coalesce("parts", F.lit(1)))))

    member = base.select("gid", "node", "n", F.explode("prefix").alias("token"))
    along = Window.partitionBy("token")  # prefixes are shuffled once, by token, for both: which are shared, and distinct rows
    shared_ = member.withColumns({"_x": F.min("node").over(along), "_y": F.max("node").over(along)}).where("_x <> _y")
    asked = held(shared_.select("gid", "node", "n", "token").distinct(), "asked")
    able = held(asked.groupBy("node", "gid", "n").agg(F.count("*").alias("c")).where(f"c >= {overlap(percent)}").select("node", "gid"), "able")
    # both sides of the join below read one shuffle: without nulls, of which there are none, Spark filters neither by itself
    asked = asked.join(_small(able.select("node")), "node", "left_semi").where("token is not null and gid is not null and n is not null and node is not null").repartition("token")
    matrix = asked.groupBy("token", "gid").agg(F.min("n").alias("low"), F.max("n").alias("high"), (F.min("node") < F.max("node")).alias("twice"))

    q, g = asked.alias("q"), matrix.alias("g")
    fits = f"q.token = g.token and 100 * q.n >= {percent} * g.low and 100 * g.high >= {percent} * q.n and (q.gid > g.gid or q.gid = g.gid and g.twice)"
    open_ = q.join(g, F.expr(fits)).groupBy("q.node", "q.n", "g.gid", (F.col("q.gid") == F.col("g.gid")).alias("own")).agg(F.count("*").alias("overlap"))
    open_ = held(open_.where(f"overlap >= {overlap(percent)}").select("node", "n", "gid", "own"), "open-groups")

    zero, alone = F.lit(0).cast("long"), F.lit(-1).cast("long")
    inside = open_.where("own").select("node", "gid", alone.alias("part"), F.lit(0).alias("query"))
    roots = components(_links(texts, base, inside, shingle, percent, held), held)

    others, done = open_.where("not own").select("node", "n", "gid"), None
    while True:
        rooted = lambda df: df.join(_small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))  # noqa: E731, B023
        spread = held(rooted(able).groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high")), "spread")
        left = rooted(others).join(_small(spread), "gid").where("low <> high or low <> root")
        if done is None:
            left = left.groupBy("root", "gid").agg(F.min(F.struct("node", "n")).alias("q")).select("q.node", "q.n", "gid")
        else:
            left = left.join(_small(done), ["node", "gid"], "left_anti").select("node", "n", "gid")
        queries = held(left, "queries")
        if queries.isEmpty():
            break
        counts = _small(held(queries.groupBy("gid").agg(_needed_parts().alias("parts")), "open-parts"))
        members = able.join(counts, "gid").select("node", "gid", F.explode(F.sequence(zero, F.col("parts") - 1)).alias("part"), F.lit(0).alias("query"))
        asking = queries.join(counts, "gid").select("node", "gid", _slot(F.col("parts")).alias("part"), F.lit(1).alias("query"))
        found = _links(texts, base, members.union(asking), shingle, percent, held)
        roots = components(roots.toDF("a", "b").union(found), held)
        if done is not None:
            break
        done = queries.select("node", "gid")
    held.release(roots)
    return roots


def self_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Each row's id, n_shingles and component_id; all links with enough similarity are found."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))
    hot = docs.sparkSession.sparkContext.broadcast(hot_tokens(texts, "text", shingle))
    kinds = "id long, hash long, node long, n long, key long, prefix array<long>"
    rows = written(texts.select("id", "text", "hash").mapInArrow(lambda it: _sets(it, hot.value, shingle, percent), kinds), "sets")
    roots = _roots(texts, rows, shingle, percent)
    rooted = rows.select("id", "node", "n").join(_small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    # a document alone in its component needs no look-up
    first = rooted.where("n > 0").groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("c")).where("c > 1").drop("c")
    both = rooted.join(_small(written(first, "first-ids")), "root", "left")
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, with all its columns: the one with the least id, null ids last.

    Rows are told apart by a 64-bit hash of all their columns, which breaks ties between equal ids; of equal rows one
    stays. Two different rows out of n have one hash with a chance of n**2 / 2**65, and would then share their fate.
    Rows without shingles (null, empty and wordless texts) all stay. Columns can have any name but _row.
    """
    held = Held(docs.sparkSession)
    rows = docs.withColumn("_row", F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    marks = held(self_join(rows, "_row", text_col, **options).where("n_shingles > 0").select("_row", F.col("component_id").alias("_component")), "marks")
    several = marks.groupBy("_component").agg(F.count("*").alias("_n")).where("_n > 1").select("_component")
    members = held(marks.join(_small(held(several, "components-of-several")), "_component").groupBy("_row", "_component").agg(F.count("*").alias("_n")), "members")
    found = rows.select("_row", F.col(id_col).alias("_id")).join(_small(members), "_row").select("_component", "_row", "_id", "_n")
    first = found.groupBy("_component").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("_first"))
    fates = held(members.join(_small(held(first, "first-rows")), "_component").select("_row", "_n", (F.col("_row") == F.col("_first._row")).alias("_stays")), "fates")
    gone = written(fates.where("not _stays").select("_row"), "later-members")
    equal = written(fates.where("_stays and _n > 1").select("_row"), "equal-rows")
    held.release()
    left = rows.join(_small(gone), "_row", "left_anti")
    if not equal.isEmpty():
        left = left.join(_small(equal), "_row", "left_anti").unionByName(left.join(_small(equal), "_row", "left_semi").dropDuplicates(["_row"]))
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return self_join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), shingle=3, percent=90)


ORACLE_OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 3 THEN [array_to_string(l, ' ')]
    ELSE list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM p JOIN n i ON i.doc_id = x JOIN n j ON j.doc_id = y WHERE 100 * c >= 90 * (i.n + j.n - c)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.y FROM r JOIN e ON e.x = r.b
), c AS (
  SELECT a, min(b) AS component_id FROM r GROUP BY a
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
"""
