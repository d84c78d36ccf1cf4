"""Removal of repeated line runs by a suffix array over line ids. DataFrame functions only.

Every document is the sequence of its \\n-split lines, each line an id (a 64-bit hash of its bytes). A run of lines
with MIN_WORDS words or more that also occurs earlier - in a document with a smaller id, or earlier in the same one -
is a later copy, and its lines are deleted; what is deleted is judged on the input, not on what is left.

1. Suffixes that can matter: those of maximal stretches of lines whose ids all occur twice or more.
2. Prefix doubling. In round k the suffixes are sorted by the ranks of their first 2**k and next 2**k lines, by range
   over all keys, so that equal suffixes may lie in several parts; a rank is the place of the first of its equals in
   that order. A suffix without an equal is resolved and drops out, and the rounds end when all are, or the ranks
   reach the longest run that is asked for.
3. Intervals. From each line the shortest run forward, and to each line the shortest run back, that has MIN_WORDS: the
   union of such runs inside a maximal repeated run is all of it. The suffixes whose longest common prefix reaches
   such a run's length m are an interval of the suffix array, named by the ranks at both ends of the run's first and
   last 2**k lines, 2**k <= m. All of the interval but its first suffix start later copies.

A line of MIN_WORDS words is a run by itself; shorter ones go as parts of longer runs only. So what stays of repeated
lines is stretches of under MIN_WORDS words in all between lines that are not repeated.

Exact copies of whole texts are one document in all this: the later ones are deleted whole, if they have MIN_WORDS.

Defined results: a null or empty text is one empty line; a very long text costs in proportion to its
repeated lines (deleted runs are merged as spans, so lines without words, where runs of every length begin, cost no more);
rows with equal ids and texts share their fate and don't count
as copies of each other; null ids come first, and equal ids fall back on a hash of the text; an empty table gives no
rows; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwheel.session import Held

#: Words that a run of lines needs: blank lines, headings and short labels are no run.
MIN_WORDS = 5
#: Most rows of a table that is broadcast (100 bytes each or so).
MOST_ROWS = 200_000
#: Most bytes of a table whose rows have arrays, where that is broadcast.
MOST_BYTES = 16 << 20
WORD = r"[^\x20\x09-\x0D]+"
#: Steps of a binary search in one document's lines.
_STEPS = [1 << k for k in range(30, -1, -1)]


def _small(df: DataFrame) -> DataFrame:
    """df to be broadcast if a count shows that it may be; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.limit(MOST_ROWS + 1).count() <= MOST_ROWS else df


def _last(array: Column, size: Column, fits) -> Column:
    """The last place (from 0) of an ascending array whose value fits, -1 if none does; by bisection."""
    return F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(-1), lambda at, step: F.when((at + step < size) & fits(F.get(array, at + step)), at + step).otherwise(at))


def _runs(lines: DataFrame) -> DataFrame:
    """Lines (id, row, at, h, w) with repeated ids to the runs (id, row, at, m) that have just MIN_WORDS."""
    along = Window.partitionBy("row").orderBy("at")
    stretch = lines.withColumn("stretch", F.col("at") - F.row_number().over(along)).withColumn("sum", F.sum("w").over(along))
    whole = stretch.groupBy("id", "row", "stretch").agg(F.sort_array(F.collect_list(F.struct("at", "sum", "w"))).alias("l")).where(F.aggregate("l", F.lit(0).cast("long"), lambda n, x: n + x["w"]) >= MIN_WORDS)
    cut = whole.select("id", "row", F.col("l")[0]["at"].alias("first"), F.size("l").alias("n"), F.transform("l", lambda x: x["sum"]).alias("after"), F.transform("l", lambda x: x["sum"] - x["w"]).alias("before"))
    # forward from i: the first j with after[j] >= before[i] + MIN_WORDS; back from j: the last i with before[i] <= after[j] - MIN_WORDS
    forward = F.transform("before", lambda b, i: F.struct(i.alias("i"), (_last(F.col("after"), F.col("n"), lambda a: a < b + MIN_WORDS) + 2 - i).alias("m")))
    back = F.transform("after", lambda a, j: F.struct(_last(F.col("before"), F.col("n"), lambda b: b <= a - MIN_WORDS).alias("i"), j.alias("j")))
    both = F.concat(F.filter(forward, lambda r: r["i"] + r["m"] <= F.col("n")), F.transform(F.filter(back, lambda r: r["i"] >= 0), lambda r: F.struct(r["i"].alias("i"), (r["j"] - r["i"] + 1).alias("m"))))
    return cut.select("id", "row", "first", F.explode(F.array_distinct(both)).alias("r")).select("id", "row", (F.col("first") + F.col("r.i")).alias("at"), F.col("r.m").alias("m"))


def _row() -> Column:
    """What a document is known by: two 64-bit hashes of its id and text."""
    return F.struct(F.xxhash64("id", "text").alias("a"), F.xxhash64(F.lit(1), "text", "id").alias("b"))


def _several(df: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Keys of two different suffixes or more, and the first suffix of each; counted where the rows are."""
    where = F.struct(F.col("id"), F.col("row"), F.col("at"))
    return df.groupBy(*keys).agg(F.min(where).alias("first"), F.max(where).alias("_last"), *more).where("first <> _last").drop("_last")


def _islands(copies: DataFrame) -> DataFrame:
    """Runs (row, at, m) that overlap or touch, as one (row, start, stop) each: as many as there are gaps, whatever the runs' lengths."""
    along = Window.partitionBy("row").orderBy("at")
    far = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    ends = copies.groupBy("row", "at").agg((F.col("at") + F.max("m")).alias("stop")).withColumn("far", far)
    numbered = ends.withColumn("island", F.sum(F.when(F.col("far") >= F.col("at"), 0).otherwise(1)).over(along))
    return numbered.groupBy("row", "island").agg(F.min("at").alias("start"), F.max("stop").alias("stop"))


def repeated(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(row, gone: spans (start, stop) of the lines to delete) for rows by hashes of id and text; (md, owner) of texts with copies."""
    spark, held = docs.sparkSession, Held(docs.sparkSession)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumns({"md": F.md5("text"), "row": _row()})
    owners = texts.groupBy("md").agg(F.min(F.struct(F.col("id").isNotNull().alias("some"), "id")).alias("owner"), F.max(F.struct(F.col("id").isNotNull().alias("some"), "id")).alias("_last"))
    owners = held(owners.where("owner <> _last").select("md", F.col("owner.id").alias("owner")), "line-owners")
    later = F.col("owner_md").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    once = texts.join(_small(owners.withColumnRenamed("md", "owner_md")), F.col("md") == F.col("owner_md"), "left").where(~later)

    every = once.select("id", "row", F.posexplode(F.split("text", "\n")).alias("at", "line")).select("id", "row", "at", F.xxhash64("line").alias("h"), F.regexp_count("line", F.lit(WORD)).cast("long").alias("w"))
    twice = held(_several(every, ["h"]).select("h"), "repeated-lines")
    lines = held(every.join(_small(twice), "h", "left_semi").distinct(), "lines")
    runs = held(_runs(lines), "runs")
    longest = runs.agg(F.max("m")).first()[0] or 0

    ranked = {0: held(lines.join(_small(runs.select("row").distinct()), "row", "left_semi").select("id", "row", "at", F.col("h").alias("rank")), "ranks")}
    level = 0
    while 2 << level <= longest:
        now = ranked[level]
        then = now.select("row", (F.col("at") - (1 << level)).alias("at"), F.col("rank").alias("next"))
        order = ("rank", "next", "id", "row", "at")
        array = held(now.join(then, ["row", "at"]).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "suffixes")
        first = held(_several(array, ["rank", "next"], F.min("place").alias("first_place")).drop("first"), "first-places")
        level += 1
        ranked[level] = held(array.drop("place").join(_small(first), ["rank", "next"]).select("id", "row", "at", F.col("first_place").alias("rank")), "ranks")

    found = None
    for k, ranks in ranked.items():
        some = runs.where((F.col("m") >= 1 << k) & (F.col("m") < 2 << k))
        head = some.join(ranks.select("row", "at", F.col("rank").alias("head")), ["row", "at"])
        ends = ranks.select("row", F.col("at").alias("_at"), F.col("rank").alias("tail"))
        named = held(head.withColumn("_at", F.col("at") + F.col("m") - (1 << k)).join(ends, ["row", "_at"]).drop("_at"), "intervals")
        firsts = held(_several(named, ["m", "head", "tail"]), "interval-firsts")
        copies = named.join(_small(firsts), ["m", "head", "tail"]).where(F.struct("id", "row", "at") > F.col("first")).select("row", "at", "m")
        found = copies if found is None else found.union(copies)
    gone = held(_islands(found).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone")), "gone-lines")
    held.release(gone, owners)
    return gone, owners


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, text without its later copies of runs, n_lines, n_removed and n_runs (maximal deleted runs)."""
    gone, owners = repeated(docs, id_col, text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    owners = owners.withColumnRenamed("md", "owner_md")
    size = gone.agg(F.sum(48 + 8 * F.size("gone"))).first()[0] or 0
    spans = gone.withColumnRenamed("row", "_row")
    rows = texts.join(_small(owners), F.md5("text") == F.col("owner_md"), "left").join(F.broadcast(spans) if size <= MOST_BYTES else spans, _row() == F.col("_row"), "left")
    lines = F.split("text", "\n")
    later = F.col("owner_md").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner")) & (F.regexp_count("text", F.lit(WORD)) >= MIN_WORDS)
    kind = "array<struct<start: int, stop: int>>"
    whole = F.array(F.struct(F.lit(0).alias("start"), F.size(lines).alias("stop"))).cast(kind)
    rows = rows.select("id", "text", F.size(lines).cast("long").alias("n_lines"), F.when(later, whole).otherwise(F.coalesce("gone", F.array().cast(kind))).alias("gone"))

    def kept(split: Column) -> Column:
        """The lines before, between and after the spans."""
        start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get("gone", k - 1)["stop"])
        stop = lambda k: F.coalesce(F.get("gone", k)["start"], F.size(split))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size("gone")), lambda k: F.slice(split, start(k) + 1, stop(k) - start(k))))

    left = F.transform(F.array(lines), lambda split: F.array_join(kept(split), "\n"))[0]  # the text is split once
    text = F.when(F.size("gone") == 0, F.col("text")).otherwise(left)
    removed = F.aggregate("gone", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return rows.select(F.col("id").alias(id_col), "n_lines", removed.alias("n_removed"), F.size("gone").cast("long").alias("n_runs"), text.alias(text_col))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_OP9 = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), p AS (
  SELECT doc_id, l, unnest(range(0, len(l))) AS k, len(regexp_extract_all(l[k + 1], '[^\x20\x09-\x0D]+')) AS w FROM d
), c AS (
  SELECT doc_id, k, w, sum(w) OVER (PARTITION BY doc_id ORDER BY k)::BIGINT AS aft FROM p
), f AS (
  SELECT a.doc_id, a.k AS i, min(b.k) AS j FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.aft - (a.aft - a.w) >= 5 GROUP BY ALL
), b AS (
  SELECT a.doc_id, max(b.k) AS i, a.k AS j FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.k <= a.k AND a.aft - (b.aft - b.w) >= 5 GROUP BY ALL
), r AS (
  SELECT doc_id, i, j FROM f UNION SELECT doc_id, i, j FROM b
), n AS (
  SELECT r.*, array_to_string(l[i + 1:j + 1], chr(10)) AS run FROM r JOIN d USING (doc_id)
), m AS (
  SELECT run, min(struct_pack(d := doc_id, i := i)) AS first FROM n GROUP BY run HAVING count(*) > 1
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS k FROM n JOIN m USING (run) WHERE struct_pack(d := doc_id, i := i) > first
), s AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (NOT EXISTS (SELECT 1 FROM g h WHERE h.doc_id = g.doc_id AND h.k = g.k - 1)) AS n_runs FROM g GROUP BY doc_id
), t AS (
  SELECT p.doc_id, string_agg(l[k + 1], chr(10) ORDER BY k) AS kept FROM p WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = p.doc_id AND g.k = p.k) GROUP BY p.doc_id
)
SELECT d.doc_id, len(l)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN t USING (doc_id)
"""
