"""Near-duplicate classes by MinHash signatures and banded locality-sensitive hashing, all in JVM expressions.

1. Sets. A text's words are lower-cased (A-Z), and its set holds the 64-bit hashes of its SHINGLE-word windows (a shorter
   text has one, of all its words). Texts with equal sets are one node, known by the MD5 of the set.
2. Signatures by one permutation: the sorted set is cut by the upper bits of its hashes into ROWS ranges, each gives its
   least hash. A range without any borrows that of the next one that has, with its distance, so short texts compare too.
3. Bands of BAND rows are keys of buckets. A bucket of up to SMALL nodes gives all its pairs. A larger one gives the pairs
   of all its nodes with its least node, which joins a cluster of copies in as many steps as it has nodes, and goes on
   under twice as many rows, until all ROWS are in the key. So candidates grow with the nodes, not with their squares.
4. Candidates whose signatures agree in less than LIKELY rows go; the others are verified by the sets themselves, which
   are made for nodes with candidates only.
5. Classes are the connected components of verified links.

A verified link is exact up to 64-bit hashes of shingles; links can be missed: with 16 bands of four rows a pair at the
threshold of 0.8 shares some band with a chance of 1 - (1 - 0.8**4)**16 = 0.9998. `tests/test_minhash.py` measures recall.
In a large bucket only links along its stars are found, so `n_links` counts links found, and classes are what to go by.

Defined results: a null text is an empty one; a text without words is in a class of its own; repeated rows and equal ids
share a class; null ids are the last that a class is named after; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwheel.operators.components import components
from tarnwheel.session import Held

SHINGLE, LINKED = 5, 80
ROWS, BAND, SMALL, LIKELY = 64, 4, 16, 35
#: Bytes of a side that is broadcast.
MOST_BYTES = 16 << 20
_WORD = r"[^\x20\x09-\x0D]+"


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """The sorted set of hashes of a text's windows of words."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.transform(F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0)), lambda w: F.xxhash64(w))

    def windows(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
        short = F.when(F.size(w) == 0, F.array().cast("array<long>")).otherwise(F.array(F.xxhash64(w)))
        return F.when(F.size(w) < size, short).otherwise(F.sort_array(F.array_distinct(each)))

    return _with(words, windows)


def _with(value: Column, f) -> Column:
    """f(value) with value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _range(x: Column) -> Column:
    """The range of a hash, 0 .. ROWS - 1, in the order of hashes."""
    return F.shiftright(x, 64 - (ROWS.bit_length() - 1)).cast("int") + ROWS // 2


def signature(found: Column) -> Column:
    """ROWS numbers for a sorted set that isn't empty."""
    least = F.filter(found, lambda x, i: (i == 0) | (_range(x) != _range(F.get(found, i - 1))))

    def rows(least: Column) -> Column:
        def row(k: Column) -> Column:
            nearest = F.coalesce(F.get(F.filter(least, lambda x: _range(x) >= k), F.lit(0)), F.get(least, F.lit(0)))
            return F.hash(nearest, F.pmod(_range(nearest) - k, F.lit(ROWS)))

        return F.transform(F.sequence(F.lit(0), F.lit(ROWS - 1)), row)

    return _with(least, rows)


def _small(df: DataFrame, size: int) -> DataFrame:
    """df to be broadcast if a count shows that it is under MOST_BYTES, at `size` bytes a row; else for a shuffle join."""
    most = MOST_BYTES // size
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def candidates(nodes: DataFrame, held: Held, small: int = SMALL) -> DataFrame:
    """(node, signature) to pairs (a, b) of nodes, a > b, that share a bucket, or one of their buckets' stars."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(ROWS // BAND - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.slice("signature", b * BAND + 1, BAND)).alias("key")))
    now = nodes.select("node", F.explode(bands).alias("x")).select("node", "x.band", "x.key")
    found, rows = None, BAND
    while True:
        sizes = now.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1")
        tagged = held(now.join(sizes, ["band", "key"]), "buckets")
        few, stars = tagged.where(F.col("n") <= small), tagged.where(F.col("n") > small)
        pairs = few.alias("x").join(few.alias("y"), ["band", "key"]).where("x.node > y.node").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        pairs = pairs.union(stars.where("node > least").select(F.col("node").alias("a"), F.col("least").alias("b")))
        found = pairs if found is None else found.union(pairs)
        if rows >= ROWS or stars.isEmpty():
            return held(found.distinct(), "candidates")
        rows *= 2
        twice = F.concat("signature", "signature")
        further = F.xxhash64("key", F.slice(twice, F.col("band") * BAND + 1 + rows // 2, F.lit(rows // 2)))
        now = stars.select("node", "band", "key").join(nodes, "node").select("node", "band", further.alias("key"))


def links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, held: Held) -> DataFrame:
    """Pairs (a, b) that are similar; nodes: (node, signature, row); texts: (row, text), row being xxhash64 of the text."""
    one, two = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa")), nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    likely = held(pairs.join(one, "a").join(two, "b").where(agree >= LIKELY).select("a", "b"), "likely")
    asked = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    wanted = nodes.join(asked, "node", "left_semi").select("node", "row")
    # the id keeps the filter from being pushed below, where it would make each set a second time
    made = texts.join(_small(wanted, 40), "row").select("node", shingles(F.col("text")).alias("found"), F.monotonically_increasing_id().alias("_id"))
    sets = held(made.where(F.unhex(F.md5(F.col("found").cast("string"))) == F.col("node")).select("node", "found").dropDuplicates(["node"]), "sets")
    both = likely.join(sets.toDF("a", "fa"), "a").join(sets.toDF("b", "fb"), "b")
    shared = F.size(F.array_intersect("fa", "fb"))
    return both.withColumn("shared", shared).where(100 * F.col("shared") >= LINKED * (F.size("fa") + F.size("fb") - F.col("shared"))).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """Each row's id, class_id (the least id of its class), n_class (rows of it) and n_links (links found for its set)."""
    held = Held(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))
    made = texts.select("id", "row", shingles(F.col("text")).alias("found"))
    made = made.select("id", "row", F.unhex(F.md5(F.col("found").cast("string"))).alias("node"), F.when(F.size("found") > 0, signature(F.col("found"))).alias("signature"))
    rows = held(made, "signatures")
    nodes = rows.where("signature is not null").groupBy("node").agg(F.min_by("signature", "row").alias("signature"), F.min("row").alias("row"))
    nodes = held(nodes, "nodes")
    pairs = held(links(candidates(nodes.select("node", "signature"), held, small), nodes, texts.select("row", "text"), held), "links")
    roots = components(pairs, held)
    counts = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).groupBy("node").agg(F.count("*").alias("n_links"))
    each = nodes.select("node").join(roots, "node", "left").join(counts, "node", "left").select("node", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    # counted by set before by class, so that a set's copies meet nowhere
    least = F.min(F.struct(F.col("id").isNull().alias("no"), "id")).alias("least")
    sums = rows.where("signature is not null").groupBy("node").agg(F.count("*").alias("n"), least).join(each, "node")
    classes = sums.groupBy("root").agg(F.sum("n").alias("n_class"), F.min("least").alias("least"))
    named = held(each.join(classes, "root").select("node", F.col("least.id").alias("class_id"), "n_class", "n_links"), "classes")
    full = rows.where("signature is not null").select("id", "node").join(named, "node").select("id", "class_id", "n_class", "n_links")
    none = F.lit(0).cast("long")
    out = full.union(rows.where("signature is null").select("id", "id", (none + 1), none)).toDF(id_col, "class_id", "n_class", "n_links")
    held.release(out)
    return out
