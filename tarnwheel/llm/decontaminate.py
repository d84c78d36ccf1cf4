"""Benchmark decontamination by SimHash windows of item size. DataFrame functions only.

1. Windows. A window has as many words as an item and begins at any place where the document has a shingle of an item
   of that size. No better one begins elsewhere: moving a window on to its first shared shingle keeps all its shared
   shingles. A document may also begin inside of an item: then its first words are a shorter window, up to any place
   where such a shingle ends (its start is negative: where the item would begin). Of all these, the windows are taken that have as many shared places as a match needs, which leaves out the
   chance phrases; which items they are compared with is left to the fingerprints.
2. Fingerprints. A window's and an item's 64-bit SimHash over their words. The fingerprints are cut into RADIUS + 1
   blocks, and the index holds each item once for each block: two fingerprints at most RADIUS bits apart agree in a
   whole block, so looking up all blocks of a window finds every item of its size within the radius.
3. Verification. Of those pairs, the ones whose shingles agree to LEAST_PERCENT: the sum of the smaller counts over the
   sum of the larger counts of each shingle. A window counts for an item whose shingle it begins with, or ends with
   where its start is negative.

Words are runs of letters, marks and digits, in lower case; shingles have SHINGLE words, and an item with fewer words
is one shingle. SimHash and similarity take any order of sentences alike, so a copy with its parts moved is a match.

Documents are known by two 64-bit hashes of id and text.

Defined results: a null or empty text or item has no words and matches nothing; a very long text costs in proportion to
its words; repeated rows count once; a null id is an id like others, of any type; a document's best window for an item
is its most similar one, then its first; empty tables give no rows; other columns don't matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.session import Held, written

SHINGLE = 5
LEAST_PERCENT = 80
BITS, RADIUS = 64, 15
#: Most rows of a table that is broadcast: item shingles (24 bytes each) and the like (50 bytes each at most).
MOST_ROWS = 500_000
NO_WORD = r"[^\p{L}\p{M}\p{N}]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_WORD), lambda w: w != "")


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _once(value: Column, use) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _shingles(hashes: Column, k: int) -> Column:
    """Hashes of all k consecutive words."""
    window = lambda a: lambda i: F.xxhash64(*(F.get(a, i + j) for j in range(k)))
    return _once(hashes, lambda a: F.when(F.size(a) >= k, F.transform(F.sequence(F.lit(0), F.size(a) - k), window(a))).otherwise(F.array().cast("array<bigint>")))


def _row(id_col: Column, text: Column) -> Column:
    return F.struct(F.xxhash64(id_col, text).alias("a"), F.xxhash64(F.lit(1), text, id_col).alias("b"))


def _small(df: DataFrame) -> DataFrame:
    """df to be broadcast if a count shows that it may be; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.limit(MOST_ROWS + 1).count() <= MOST_ROWS else df


def _fingerprints(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, hashes) to (keys, fingerprint): bit k is set where most of the words' hashes have it.

    Bits k and k + 32 are counted in the halves of one number, which holds up to 2**31 words.
    """
    both = lambda k: F.sum(F.shiftrightunsigned("h", k).bitwiseAND((1 << 32) + 1)).alias(f"b{k}")
    counted = df.select(*keys, F.explode("hashes").alias("h")).groupBy(*keys).agg(F.count("*").alias("n"), *(both(k) for k in range(BITS // 2)))
    halves = [(F.col(f"b{k}").bitwiseAND((1 << 32) - 1), k) for k in range(BITS // 2)] + [(F.shiftrightunsigned(f"b{k}", 32), k + 32) for k in range(BITS // 2)]
    bits = (F.when(2 * count > F.col("n"), F.shiftleft(F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long")) for count, k in halves)
    return counted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint"))


def _blocks(df: DataFrame) -> DataFrame:
    """A row for each of the RADIUS + 1 blocks of a fingerprint."""
    edges = [BITS * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    cut = [F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fingerprint", a).bitwiseAND((1 << (b - a)) - 1).alias("value")) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return df.withColumn("_b", F.explode(F.array(*cut))).select(*df.columns, "_b.block", "_b.value")


def _any_shingles(hashes: Column, k: Column) -> Column:
    """Shingles of k words, k from 1 to SHINGLE."""
    return reduce(lambda rest, n: F.when(k == n, _shingles(hashes, n)).otherwise(rest), range(1, SHINGLE + 1), F.array().cast("array<bigint>"))


def _least(size: Column, k: Column) -> Column:
    """Fewest shared shingles of a match with an item of that size."""
    return F.floor((LEAST_PERCENT * (size - k + 1) + 99) / 100).cast("int")


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and item that it has: row (hashes of id and text), id, item, similarity, start."""
    held = Held(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("row", _row(F.col("id"), F.col("text")))
    asked = items.select(F.col(item_col).alias("item"), _hashes(F.col(item_text)).alias("hashes")).where("size(hashes) > 0")
    asked = held(asked.withColumn("size", F.size("hashes")).withColumn("k", F.least("size", F.lit(SHINGLE))).distinct(), "items")
    lengths = sorted(r[0] for r in asked.select("k").distinct().collect())  # SHINGLE values at most
    if not lengths:
        return texts.where("false").select("row", F.col("id").alias(id_col), F.lit(None).cast(items.schema[item_col].dataType).alias(item_col), F.lit(0.0).alias("similarity"), F.lit(0).alias("start"))

    laid = []
    for k in lengths:
        wanted = held(asked.where(F.col("k") == k).select("size", F.explode(_shingles(F.col("hashes"), k)).alias("g")).distinct(), "wanted")
        found = texts.select("row", F.posexplode(_shingles(_hashes(F.col("text")), k)).alias("at", "g")).join(_small(wanted), "g")
        hits = found.groupBy("row", "size").agg(F.sort_array(F.collect_set("at")).alias("at"))
        # a window holds enough places where the one that many hits on is inside it
        least = _least(F.col("size"), F.lit(k))
        begins = F.filter("at", lambda at, i: F.get("at", i + least - 1) <= at + F.col("size") - k)  # noqa: B023
        ends = F.filter("at", lambda at, i: (at + k < F.col("size")) & (i + 1 >= least))  # noqa: B023
        starts = F.concat(begins, F.transform(ends, lambda at: at + k - F.col("size")))  # noqa: B023
        laid.append(hits.select("row", "size", F.lit(k).alias("k"), starts.alias("starts")).where("size(starts) > 0"))
    windows = held(reduce(DataFrame.union, laid).groupBy("row").agg(F.collect_list(F.struct("size", "k", "starts")).alias("laid")), "windows")
    owned = texts.join(_small(windows), "row").select("row", "id", _hashes(F.col("text")).alias("all"), "laid").dropDuplicates(["row"])
    owned = held(owned, "window-owners")

    own = ["row", "size", "start"]
    words_in = F.slice("all", F.greatest("start", F.lit(0)) + 1, F.col("size") + F.least("start", F.lit(0)))
    each = owned.select("row", "all", F.explode("laid").alias("w")).select("row", "all", "w.size", F.explode("w.starts").alias("start"))
    prints = _blocks(_fingerprints(each.select(*own, words_in.alias("hashes")), own))
    index = _blocks(_fingerprints(asked, ["item", "size"])).withColumnRenamed("fingerprint", "item_fingerprint")
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))) <= RADIUS
    pairs = prints.join(_small(held(index, "index")), ["size", "block", "value"]).where(near).select(*own, "item").distinct()

    grams = asked.select("item", "size", F.explode(_any_shingles(F.col("hashes"), F.col("k"))).alias("g"))
    theirs = held(grams.groupBy("item", "size", "g").agg(F.count("*").alias("d")), "item-shingles")
    n_theirs = theirs.groupBy("item", "size").agg(F.sum("d").alias("m"))
    cut = held(pairs, "pairs").join(owned, "row").select(*own, "item", "id", words_in.alias("hashes"))
    ours = cut.select(*own, "item", "id", F.posexplode(_any_shingles(F.col("hashes"), F.least("size", F.lit(SHINGLE)))).alias("at", "g"))
    ours = ours.groupBy(*own, "item", "g").agg(F.count("*").alias("c"), F.min("at").alias("at"), F.max("at").alias("last"), F.first("id").alias("id"))
    edge = F.when(F.col("start") < 0, F.col("last") == F.col("start") + F.col("size") - F.least("size", F.lit(SHINGLE))).otherwise(F.col("at") == 0)
    rated = ours.join(_small(theirs), ["item", "size", "g"], "left").groupBy(*own, "item").agg(
        F.sum(F.when(F.col("d").isNotNull(), F.least("c", "d")).otherwise(0)).alias("common"), F.sum("c").alias("n"), F.max(edge & F.col("d").isNotNull()).alias("edge"), F.first("id").alias("id")
    )
    rated = rated.where("edge").join(_small(n_theirs), ["item", "size"]).withColumn("union", F.col("n") + F.col("m") - F.col("common"))
    sure = rated.where(100 * F.col("common") >= LEAST_PERCENT * F.col("union")).withColumn("similarity", F.col("common") / F.col("union"))
    best = sure.groupBy("row", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"), F.first("id").alias("id"))
    out = held(best.select("row", F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start")), "matches")
    held.release(out)
    return out


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without any item, with all their columns."""
    gone = written(matches(docs, items, id_col, text_col, **options).select("row").distinct(), "contaminated")
    return docs.join(_small(gone), _row(docs[id_col], docs[text_col]) == gone["row"], "left_anti")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return matches(docs, items).select("doc_id", "item_id", "similarity", "start").distinct()


ORACLE_OP3 = r"""
WITH i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), ig AS (
  SELECT item_id, len(w) AS size, unnest(range(0, len(w) - 4)) AS o, w[o + 1:o + 5] AS g FROM i
), dg AS (
  SELECT doc_id, unnest(range(0, len(w) - 4)) AS pos, w[pos + 1:pos + 5] AS g FROM d
), win AS (
  SELECT DISTINCT doc_id, item_id, size, unnest(CASE WHEN pos + 5 < size THEN [pos, pos + 5 - size] ELSE [pos] END) AS start FROM dg JOIN ig ON dg.g = ig.g
), cut AS (
  SELECT win.*, w[greatest(start, 0) + 1:start + size] AS l FROM win JOIN d USING (doc_id)
), wg AS (
  SELECT doc_id, item_id, start, g, count(*) AS c FROM (SELECT doc_id, item_id, start, unnest(range(0, len(l) - 4)) AS j, l[j + 1:j + 5] AS g FROM cut) GROUP BY ALL
), ic AS (
  SELECT item_id, g, count(*) AS c FROM ig GROUP BY ALL
), m AS (
  SELECT doc_id, item_id, start, sum(least(wg.c, ic.c)) AS k FROM wg JOIN ic USING (item_id, g) GROUP BY ALL
), r AS (
  SELECT m.*, (SELECT sum(c) FROM ic WHERE ic.item_id = m.item_id) + wn.n - k AS u
  FROM m JOIN (SELECT doc_id, item_id, start, sum(c) AS n FROM wg GROUP BY ALL) wn USING (doc_id, item_id, start)
)
SELECT doc_id, item_id, max(k / u)::DOUBLE AS similarity, arg_max(start, struct_pack(s := k / u, b := -start))::INT AS start
FROM r WHERE 100 * k >= 80 * u GROUP BY doc_id, item_id
"""
