"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words: a share of all words by weight, at most MAX_COPIES times what it has, the
excess reshared by weight. A target is whole copies of the source, which are certain, and a remainder, which is a
fixed-size sample with unequal inclusion probabilities: a document's rank is q = (u / (1 - u)) / (p / (1 - p)) with u a
uniform number hashed from its id and p / (1 - p) its inclusion odds (the source's f / (1 - f), times the document's
own odds), and the smallest ranks are taken. The size that is fixed is that in words: from the least rank up, each
document is taken that fits in what is left of the remainder.

Where over NEAR of a remainder is left by that, what is left are documents larger than the gap. Then the smallest of
them is taken too, and from the greatest taken rank down each document is dropped that fits in the excess; this holds if
it brings the words nearer to the target (which they may then exceed, by less than the gap was).

`_walked` does both without walking: a step takes all documents up to the rank where their sum would pass the gap, then
goes on behind it with those that fit in the new gap. A step sums by parts of the ranks first, and row by row only in
the part where the gap ends, so no task has more than a part, and the steps grow with the logarithm of the gap.

What comes out is a plan with one row for each source (target, whole copies, the steps), so the documents, texts and
all, are never shuffled: each row is decided where it is read.

Defined results: a null text has no words; a very long text counts whole; ids can be of any type; a null source is a source of its own, last in order; rows that agree in id,
source and number of words share their fate; equal ranks fall back on the hash; a document without words is taken
with its whole copies at most; an empty table gives no rows; other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwheel.session import Held

MAX_COPIES = 3
#: Share of a remainder that may be left without a swap.
NEAR = 0.01
#: Documents in a part of the ranks, about.
PART = 250_000
SEED = "mix-1"
#: A list of sources up to this length is broadcast (its rows are under 300 bytes); a longer one is joined by salted keys.
MOST_BROADCAST, SALTS = 20_000, 64
WORD = r"[^\x20\x09-\x0D]+"
#: Documents under so many words get half the odds of the others in op1.
SHORT = 50


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(id_col: Column, size: Column) -> Column:
    """The hash that stands for a document in ranks and ties."""
    return F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(id_col.cast("string"), F.lit("null")), size.cast("string")))


def _rank(key: Column, share: Column, odds: Column) -> Column:
    """Random odds divided by inclusion odds; null where the share is none or all."""
    u = (F.conv(F.substring(key, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.when((share > 0) & (share < 1), (u / (1 - u)) / ((share / (1 - share)) * odds))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, size) rows to one row a source: sid, source, source_size, target, whole, share, rest.

    The windows without a key run over one row for each source, not over documents.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "sid")
    numbered = sources.withColumn("sid", F.row_number().over(by_name).cast("long")).withColumn("weight", F.pmod(F.col("sid") - 1, F.lit(3)) + 1)
    roomed = (
        numbered.withColumn("most", F.col("source_size") * MAX_COPIES)
        .withColumn("room", F.col("most") / F.col("weight"))
        .withColumn("full", F.coalesce(F.sum("most").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - F.col("full")) / F.col("open"))
    )
    level = F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "sid", "level"))).over(by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (
        roomed.withColumn("level", level["level"])
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")))
        .withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("share", F.coalesce(F.try_divide("rest", "source_size"), F.lit(0.0)))
        .select("sid", "source", "source_size", "target", "whole", "rest", "share")
    )


def _with_plan(df: DataFrame, plan: DataFrame, n_sources: int) -> DataFrame:
    """Joins rows to their source's row of the plan; no row of df moves unless the plan is too long to broadcast."""
    same = df["source"].eqNullSafe(plan["source"])
    if n_sources <= MOST_BROADCAST:
        return df.join(F.broadcast(plan), same).drop(plan["source"])
    salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, (dealt["_salt"] == salted["_salt"]) & dealt["source"].eqNullSafe(salted["source"])).drop(salted["source"]).drop("_salt")


def _by_source(n_sources: int) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Joins rows with `sid` and `key` to a table with one row a source; a long table goes out by salted keys."""
    if n_sources <= MOST_BROADCAST:
        return lambda df, table: df.join(F.broadcast(table), "sid")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    return lambda df, table: df.withColumn("_salt", salt).join(table.withColumn("_salt", salts), ["sid", "_salt"]).drop("_salt")


def _walked(ranked: DataFrame, gaps: DataFrame, down: bool, join: Callable, held: Held) -> DataFrame:
    """(sid, gap) to (sid, gap, steps): from the least rank up (or from the greatest down) what fits is taken.

    A step (q, key, most): from the step before to this rank, documents of at most `most` words are taken; q is null in
    the last step of a source whose documents all fit.
    """
    way = F.desc if down else F.asc
    ends = F.min if down else F.max
    state = held(gaps.select("sid", "gap", F.lit(None).cast("double").alias("q"), F.lit(None).cast("string").alias("key"), F.array().cast("array<struct<q: double, key: string, most: double>>").alias("steps"), F.lit(True).alias("open")), "mix-walk")
    while not (now := state.where("open").select("sid", "gap", F.col("q").alias("from_q"), F.col("key").alias("from_key"))).isEmpty():
        here, start = F.struct("q", "key"), F.struct(F.col("from_q").alias("q"), F.col("from_key").alias("key"))
        left = join(ranked, now).where("words <= gap").where(F.col("from_q").isNull() | ((here < start) if down else (here > start)))
        parts = left.groupBy("sid", "part", "gap").agg(F.sum("words").alias("words"), ends(here).alias("end"))
        along = Window.partitionBy("sid").orderBy(way("part"))
        parts = held(parts.withColumn("before", F.coalesce(F.sum("words").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("end_before", F.lag("end").over(along)), "mix-parts")
        crossed = parts.where("before <= gap and before + words > gap").select("sid", "part", "before", "end_before")
        rows = join(left, crossed.withColumnRenamed("part", "at")).where("part = at")
        rows = rows.withColumn("run", F.col("before") + F.sum("words").over(Window.partitionBy("sid", "part").orderBy(way("q"), way("key")).rowsBetween(Window.unboundedPreceding, 0)))
        cut = rows.where("run <= gap").groupBy("sid").agg(ends(here).alias("to"), F.max("run").alias("run"))
        total = parts.groupBy("sid").agg(F.sum("words").alias("all"))
        step = total.join(crossed.drop("part"), "sid", "left").join(cut, "sid", "left").withColumn("to", F.coalesce("to", "end_before")).withColumn("got", F.coalesce("run", "before", "all"))
        moved = {
            "steps": F.when(F.col("got").isNull(), F.col("steps")).otherwise(F.concat("steps", F.array(F.struct(F.col("to.q").alias("q"), F.col("to.key").alias("key"), F.col("gap").alias("most"))))),
            "open": F.col("open") & F.col("before").isNotNull(),
            "gap": F.col("gap") - F.coalesce("got", F.lit(0)),
            "q": F.coalesce("to.q", "q"),
            "key": F.coalesce("to.key", "key"),
        }
        state = held(state.join(step.select("sid", "to", "got", "before"), "sid", "left").withColumns(moved).select(*state.columns), "mix-walk")
    return state.select("sid", "gap", "steps")


def _fits(steps: str, q: Column, key: Column, words: Column, down: bool = False) -> Column:
    """Whether a document is taken by the steps: by the first that reaches its rank."""
    here = F.struct(q.alias("q"), key.alias("key"))
    there = lambda s: F.struct(s["q"].alias("q"), s["key"].alias("key"))
    first = F.get(F.filter(steps, lambda s: s["q"].isNull() | ((here >= there(s)) if down else (here <= there(s)))), 0)
    return F.coalesce(q.isNotNull() & (words <= first["most"]), F.lit(False))


def _taken(q: Column, key: Column, words: Column) -> Column:
    """Whether a document is in the sample of its source's remainder."""
    own = _fits("steps", q, key, words) & ~_fits("drops", q, key, words, down=True)
    return own | F.coalesce((q == F.col("extra.q")) & (key == F.col("extra.key")), F.lit(False))


def _plan(sizes: DataFrame, held: Held) -> tuple[DataFrame, int]:
    """One row for each source: its target, whole copies, and which ranks are taken."""
    sources = held(targets(sizes), "mix-sources")
    n_sources = sources.count()
    units = sizes.groupBy("source", "_key", "odds").agg(F.sum("size").alias("words"), F.max("size").alias("size")).where("words > 0")
    ranked = (
        _with_plan(units, sources.select("sid", "source", "share"), n_sources)
        .select("sid", _rank(F.col("_key"), F.col("share"), F.col("odds")).alias("q"), F.col("_key").alias("key"), "words", "size")
        .where("q is not null")
    )
    parts = sizes.count() // PART + 1
    ranked = held(ranked.repartitionByRange(parts, "sid", "q", "key").withColumn("part", F.spark_partition_id()), "mix-ranked")
    join = _by_source(n_sources)
    up = held(_walked(ranked, sources.select("sid", F.col("rest").alias("gap")), False, join, held), "mix-up")

    far = sources.select("sid", "rest").join(up, "sid").where((F.col("gap") >= 1) & (F.col("gap") > F.lit(NEAR) * F.col("rest")))
    there = join(ranked, far).withColumn("taken", _fits("steps", F.col("q"), F.col("key"), F.col("words")))
    extra = held(there.where("not taken").groupBy("sid", "gap").agg(F.min(F.struct("words", "q", "key")).alias("extra")), "mix-extra")
    need = extra.select("sid", (F.col("extra.words") - F.col("gap")).alias("gap"))
    down = _walked(there.where("taken").select(*ranked.columns), need, True, join, held).withColumnsRenamed({"gap": "over", "steps": "drops"})
    swaps = extra.join(down, "sid").where("over < gap").select("sid", "extra", "drops")
    plan = held(sources.join(up.select("sid", "steps"), "sid", "left").join(swaps, "sid", "left"), "mix-plan")
    # a row doesn't know how many rows are the same, so where that decides, the plan says it
    several = join(ranked.where("words <> size"), plan.select("sid", "steps", "extra", "drops"))
    odd = several.where(_taken(F.col("q"), F.col("key"), F.col("words")) != _taken(F.col("q"), F.col("key"), F.col("size")))
    return plan.join(odd.groupBy("sid").agg(F.collect_list("key").alias("odd")), "sid", "left"), n_sources


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", odds: Column | None = None) -> DataFrame:
    """All rows of docs as struct `doc`, with source, size, source_size, target, copies and taken.

    odds: the documents' own factor on their inclusion odds, from their size in the column `size`; 1 by default.
    """
    odds, held = F.lit(1.0) if odds is None else odds, Held(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("doc")).withColumns({"source": F.col(f"doc.`{source_col}`"), "size": n_words(F.col(f"doc.`{text_col}`"))})
    rows = rows.withColumns({"_key": _key(F.col(f"doc.`{id_col}`"), F.col("size")), "odds": odds.cast("double")})
    plan, n_sources = _plan(held(rows.select("source", "size", "_key", "odds"), "mix-sizes"), held)
    plan = held(plan, "mix-plan")
    held.release(plan)
    out = _with_plan(rows, plan, n_sources)
    alone = _taken(_rank(F.col("_key"), F.col("share"), F.col("odds")), F.col("_key"), F.col("size"))
    copies = F.col("whole") + (alone != F.coalesce(F.array_contains("odd", F.col("_key")), F.lit(False))).cast("long")
    return out.withColumn("copies", copies).select("doc", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def short_odds() -> Column:
    """Half the odds for documents of under SHORT words."""
    return F.when(F.col("size") < SHORT, 0.5).otherwise(1.0)


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns of docs."""
    return mixed(docs, **options).where("copies > 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mixed(docs, odds=short_odds()).select("doc.doc_id", "size", "source_size", "target", "taken", "copies", "source")


ORACLE_OP1 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), k AS (
  SELECT *, md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size) AS h,
    CASE WHEN size < 50 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS odds FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source
), r AS (
  SELECT *, (sid - 1) % 3 + 1 AS weight, 3 * source_size AS most, (3 * source_size)::DOUBLE / ((sid - 1) % 3 + 1) AS room FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY room, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY room, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lev FROM r
), t AS (
  SELECT *, least(most::DOUBLE, weight * (SELECT arg_min(lev, struct_pack(room := room, sid := sid)) FROM l WHERE lev <= room)) AS target FROM l
), p AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM t
), f AS (
  SELECT *, target - whole * source_size AS rest, coalesce((target - whole * source_size) / nullif(source_size, 0), 0) AS share FROM p
), u AS (
  SELECT f.sid, h, sum(size)::BIGINT AS words, any_value(rest) AS rest,
    any_value((('0x' || substr(h, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS x, any_value(share) AS share, odds
  FROM k JOIN f ON k.source IS NOT DISTINCT FROM f.source GROUP BY f.sid, h, odds HAVING sum(size) > 0
), q AS (
  SELECT *, (x / (1 - x)) / ((share / (1 - share)) * odds) AS q FROM u WHERE share > 0 AND share < 1
), o AS (
  SELECT sid, h, words, rest, q, row_number() OVER (PARTITION BY sid ORDER BY q, h) AS k FROM q
), up(sid, k, gap, hit) AS (
  SELECT DISTINCT sid, 0::BIGINT, rest, false FROM o
  UNION ALL
  SELECT o.sid, o.k, CASE WHEN o.words <= up.gap THEN up.gap - o.words ELSE up.gap END, o.words <= up.gap
  FROM up JOIN o ON o.sid = up.sid AND o.k = up.k + 1
), e AS (
  SELECT sid, min(gap) AS gap FROM up GROUP BY sid
), x AS (
  SELECT o.sid, e.gap, min(struct_pack(words := o.words, q := o.q, h := o.h)) AS s
  FROM o JOIN up USING (sid, k) JOIN e ON e.sid = o.sid WHERE NOT hit AND e.gap >= 1 AND e.gap > 0.01::DOUBLE * o.rest GROUP BY ALL
), y AS (
  SELECT o.sid, o.h, o.words, row_number() OVER (PARTITION BY o.sid ORDER BY o.k DESC) AS k FROM o JOIN up USING (sid, k) JOIN x ON x.sid = o.sid WHERE hit
), down(sid, k, gap, h, hit) AS (
  SELECT sid, 0::BIGINT, s.words - gap, NULL::VARCHAR, false FROM x
  UNION ALL
  SELECT y.sid, y.k, CASE WHEN y.words <= down.gap THEN down.gap - y.words ELSE down.gap END, y.h, y.words <= down.gap
  FROM down JOIN y ON y.sid = down.sid AND y.k = down.k + 1
), swap AS (
  SELECT x.sid, s.h AS h FROM x WHERE (SELECT min(gap) FROM down WHERE down.sid = x.sid) < gap
), chosen AS (
  SELECT o.sid, o.h FROM o JOIN up USING (sid, k) LEFT JOIN swap ON swap.sid = o.sid
  WHERE o.h IS NOT DISTINCT FROM swap.h
    OR hit AND NOT (swap.h IS NOT NULL AND EXISTS (SELECT 1 FROM down WHERE down.sid = o.sid AND down.h = o.h AND down.hit))
)
SELECT doc_id, size, source_size, target, size * (whole + (chosen.h IS NOT NULL)::BIGINT) AS taken,
  whole + (chosen.h IS NOT NULL)::BIGINT AS copies, k.source
FROM k JOIN f ON k.source IS NOT DISTINCT FROM f.source LEFT JOIN chosen ON chosen.sid = f.sid AND chosen.h = k.h
"""
