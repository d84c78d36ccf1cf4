"""What each of five filters removes, alone and in every order, counted from one mask of failures for each document.

Filters (a document fails where the condition holds; words are maximal runs of other than ASCII white space):
A under 200 words; B 100 * distinct words < 50 * words; C 100 * [A-Z] > 3 * code points; D any of [#$%&*|];
E the text of some smaller id, table-wide.

1. Fingerprints. E needs equal texts together, so texts are routed by their xxhash. Each task first keeps chains of its
   own texts: all but the row of the least id fail E already and go on without their text, dealt by id, so a group of
   copies sends one text a task at most. A receiving task chains what it gets by fingerprint, with the full text and the
   least id of each; a fingerprint that two texts share makes a chain of two. All but the least id of a text fail E.
2. Masks. Every row becomes (id, part, mask); those are written, and get their labels by a join of ids.
3. Vectors. combineByKey sums 32 masks x (all, good, toxic) for each part where the rows are, then across tasks. The
   120 orders are read off a part's vector, so no order looks at a row again.

Defined results: a null text is an empty one, a null part an empty string; a null id is the least of all, and rows of one
id are no copies of each other; a document has a label if any row of `labels` with its id has; labels of null ids count
for nothing; repeated rows count each; a very long text is held whole, once for each task that has it, and its words are counted in slices; an empty table
gives no rows; ids have any type that can be compared; other columns don't matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import permutations
from zlib import crc32

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tarnwheel.session import written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
MASKS = 1 << len(FILTERS)
CAPITALS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: Bytes of a text that are taken apart at once.
SLICE = 1 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
#: Text that a task holds in chains before it sends them on, and that a receiving task should get.
HELD = 32 << 20


def mask(text: str) -> int:
    """The bits of A to D; words are counted in slices, so that memory follows the different ones."""
    data = text.encode()
    n, words, at = 0, set(), 0
    while at < len(data):
        stop = at + SLICE
        if stop < len(data):  # on to the end of the word
            white = _WHITE.search(data, stop)
            stop = white.start() if white else len(data)
        some = data[at:stop].split()  # of bytes: at \x20 and \x09-\x0D
        n += len(some)
        words.update(some)
        at = stop
    capitals = sum(len(x) - len(x.translate(None, CAPITALS)) for x in (data[k : k + SLICE] for k in range(0, len(data), SLICE)))
    fails = (n < 200, 2 * len(words) < n, 100 * capitals > 3 * len(text), any(m in data for m in MARKS))
    return sum(BIT[f] for f, x in zip(FILTERS, fails, strict=False) if x)


def _order(key) -> tuple:
    """Ids in order, nulls first."""
    return (key is not None, key)


class Chains:
    """For each fingerprint the different texts seen, each as [text, least id, the rows (id, part, mask) of that id counted]."""

    def __init__(self):
        self.found: dict[int, list[list]] = {}
        self.size = 0

    def add(self, fingerprint: int, text: str, key, rows: Counter) -> Iterator[tuple[tuple, int]]:
        """Takes rows of one id and text; gives the rows, counted, that are known for copies from now on."""
        chain = self.found.setdefault(fingerprint, [])
        for entry in chain:
            if entry[0] == text:
                break
        else:
            chain.append([text, key, Counter(rows)])
            self.size += len(text)
            return
        if key == entry[1]:
            entry[2].update(rows)
        elif _order(key) < _order(entry[1]):
            yield from entry[2].items()
            entry[1], entry[2] = key, Counter(rows)
        else:
            yield from rows.items()

    def drain(self) -> Iterator[tuple[int, list]]:
        for fingerprint, chain in self.found.items():
            for entry in chain:
                yield fingerprint, entry
        self.found, self.size = {}, 0


def _copy(row: tuple) -> tuple:
    return (row[0], row[1], row[2] | BIT["E"])


def _local(rows: Iterable[Row]) -> Iterator[tuple[int, tuple]]:
    """(id, part, text, fingerprint) to (route, (text, least id, its rows)) or, for a copy, (route, (None, None, its row))."""
    chains = Chains()
    for key, part, text, fingerprint in rows:
        for row, n in chains.add(fingerprint, text, key, Counter([(key, part, mask(text))])):
            yield crc32(repr(row[0]).encode()), (None, None, Counter({_copy(row): n}))
        if chains.size > HELD:
            yield from _sent(chains)
    yield from _sent(chains)


def _sent(chains: Chains) -> Iterator[tuple[int, tuple]]:
    for fingerprint, entry in chains.drain():
        yield fingerprint, tuple(entry)


def _routed(rows: Iterable[tuple[int, tuple]]) -> Iterator[tuple]:
    """What one task received to (id, part, mask, n) with E."""
    chains = Chains()
    for fingerprint, (text, key, own) in rows:
        if text is None:
            yield from ((*row, n) for row, n in own.items())
        else:
            yield from ((*_copy(row), n) for row, n in chains.add(fingerprint, text, key, own))
    for _, (_, _, own) in chains.drain():
        yield from ((*row, n) for row, n in own.items())


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask, n): how many rows of an id fail the filters whose bits are in mask; written to the shared folder."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("fingerprint"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // HELD)
    routed = rows.rdd.mapPartitions(_local).partitionBy(parts, lambda route: route).mapPartitions(_routed)
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, part string, mask int, n long"
    return written(spark.createDataFrame(routed, schema, verifySchema=False), "filter-masks")


def _vector(x: tuple[int, int, bool, bool]) -> list[int]:
    return _counted([0] * (3 * MASKS), x)


def _counted(vector: list[int], x: tuple[int, int, bool, bool]) -> list[int]:
    for k, counts in enumerate((True, *x[2:])):
        vector[k * MASKS + x[0]] += x[1] * counts
    return vector


def _summed(a: list[int], b: list[int]) -> list[int]:
    return [x + y for x, y in zip(a, b, strict=True)]


def report(part: str, vector: list[int]) -> Iterator[tuple]:
    """The 600 rows of one part."""
    every, good, toxic = (vector[k * MASKS : (k + 1) * MASKS] for k in range(3))

    def of(counts: list[int], has: int, before: int) -> int:
        return sum(n for m, n in enumerate(counts) if m & has == has and not m & before)

    removed = {(f, before): of(every, BIT[f], before) for f in FILTERS for before in range(MASKS) if not before & BIT[f]}
    shapley = dict.fromkeys(FILTERS, 0)
    befores = [(order, k, f, sum(BIT[g] for g in order[:k])) for order in ORDERS for k, f in enumerate(order)]
    for _, _, f, before in befores:
        shapley[f] += removed[f, before]
    for order, k, f, before in befores:
        fails = removed[f, 0]
        gone = removed[f, before]
        yield part, order, k + 1, of(every, 0, before | BIT[f]), gone, fails - gone, every[BIT[f]], of(good, BIT[f], before), of(toxic, BIT[f], before), shapley[f]


REPORT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """A row for each part, order of filters and step, with REPORT's columns; labels: id, quality, toxic."""
    spark = docs.sparkSession
    found = masks(docs, id_col, text_col, part_col)
    told = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    told = told.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    no = F.lit(False)
    # rows without an id need no partner, and would all meet in one task
    rows = found.where("id is not null").join(told, "id", "left").select("part", "mask", "n", F.coalesce("good", no).alias("good"), F.coalesce("bad", no).alias("bad"))
    rows = rows.union(found.where("id is null").select("part", "mask", "n", no, no))
    vectors = rows.rdd.map(lambda r: (r[0], tuple(r[1:]))).combineByKey(_vector, _counted, _summed, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.createDataFrame(vectors.flatMap(lambda kv: report(*kv)), REPORT, verifySchema=False)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE_OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, part,
    (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE bad) AS b FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
p AS (SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits FROM f v, f w, f x, f y, f z WHERE (v.bit | w.bit | x.bit | y.bit | z.bit) = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM p, (VALUES (1), (2), (3), (4), (5)) k(step)),
r AS (SELECT part, filter_order, step, bit,
    sum(n) FILTER (WHERE (mask & (before + bit)) = 0) AS kept,
    sum(n) FILTER (WHERE (mask & bit) > 0 AND (mask & before) = 0) AS removed,
    sum(n) FILTER (WHERE (mask & bit) > 0 AND (mask & before) > 0) AS redundant,
    sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(g) FILTER (WHERE (mask & bit) > 0 AND (mask & before) = 0) AS good_lost,
    sum(b) FILTER (WHERE (mask & bit) > 0 AND (mask & before) = 0) AS toxic_lost
    FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley FROM r
"""
