"""Spelling variants: words that differ by one inserted, deleted or replaced code point, each led to its most used form.

A word is a maximal run [A-Za-z\\u00C0-\\u00FF]+ with A-Z lower-cased. Let h be the crc32 of UTF-8 `<id>:<word>`; where
DAMAGE divides h, the code point h % length goes (the table's own misspellings). Words of SIZE code points and LEAST
occurrences or more take part.

1. Counts. Each task sums its words in numpy over whole blocks of text, Spark sums the tasks' counts.
2. Dictionaries. One edit leaves a half of the shorter word intact, m code points long: either its first m // 2 or its
   last m // 2. So each word stands in a forward dictionary under its first half and in a reversed one under its last
   half, once for m = its length and once as the longer word of a pair, for m = its length - 1.
3. Subdivision. A block that all words with one half share may be large: `st...`. Where its pairs would be over PAIRS,
   each word goes to two narrower blocks instead, as one edit in what is left leaves a half of that intact too; so on
   until a block is small or one code point is left, where a block is no larger than the alphabet allows. Rounds are
   log2 of the longest word at most, each a written table.
4. Scans. Blocks are ranges of the sorted dictionaries; tasks walk them and compare a block's pairs in numpy, a bounded
   number at a time. Code points are below 256, so a word is an array of bytes, and each pair is verified exactly.
5. Forms. A word's form is its near word of most occurrences n (ties: least in code-point order), if that is 2 n of the
   word at least. Roots are found by pointer jumping, so in the logarithm of the longest chain.

Words of one block of text are told apart by a 64-bit hash (`textarrays.range_hashes`: two fall together by chance alone,
2**-57 for each pair); everywhere else by themselves.

Defined results: a null text has no words, a null id is an empty string before the colon; repeated rows count each; a very
long text is counted in slices of half a megabyte, a word of any length is one word; ties as above; an empty table gives no
rows; ids have any type with a string form; other columns don't matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.llm.textarrays import BLOCK, LOWER, Block, blocks, owners, range_hashes
from tarnwheel.session import Held

SIZE, LEAST, DAMAGE = 5, 3, 97
#: Pairs of a block beyond which it is subdivided, and code points compared at once.
PAIRS, AT_ONCE = 1 << 15, 1 << 22
#: Different words that a task sums before it sends them on.
SUMMED = 200_000
_LEAD = 0xC3  # of UTF-8 for U+00C0 to U+00FF
_OTHER = np.ones(256, bool)
_OTHER[[*range(65, 91), *range(97, 123), _LEAD]] = False
_LONG = 64


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each range of bytes, after bytes whose crc32 is `before`."""
    size, out = ends - starts, before.astype(np.uint32)
    for k in np.flatnonzero(size > _LONG):
        out[k] = crc32(data[starts[k] : ends[k]], int(before[k]))
    order = np.argsort(-np.where(size > _LONG, 0, size), kind="stable")
    left = np.where(size > _LONG, 0, size)[order]
    state = out[order] ^ np.uint32(0xFFFFFFFF)
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, "left"))  # ranges of over k bytes
        state[:n] = _CRC[(state[:n] ^ data[starts[order[:n]] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters: starts, ends, text of each."""
    marked = data.copy()
    marked[1:][data[:-1] == _LEAD] = 97  # what follows the lead byte belongs to the letter
    starts, ends, firsts = Block(marked, offsets).cut(_OTHER)
    return starts, ends, owners(firsts)


def slices(data: np.ndarray, size: int = BLOCK) -> Iterator[np.ndarray]:
    """One text in slices of about `size` bytes, cut where no run of letters is."""
    at = 0
    while at < len(data):
        stop = min(at + size, len(data))
        while stop < len(data):
            some = data[stop : stop + size]
            free = np.flatnonzero((some < 128) & _OTHER[some])
            stop += int(free[0]) if len(free) else len(some)
            if len(free):
                break
        yield data[at:stop]
        at = stop


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id as text, text) to (word, n), summed for some batches."""
    found: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        words = pa.array([w.decode() for w in found], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        ids = batch.column(0).to_pylist()
        for a, b, data, offsets in blocks(batch.column(1)):
            parts = [(data, offsets)] if b > a + 1 else ((x, np.array([0, len(x)])) for x in slices(data))
            for part, edges in parts:
                count(LOWER[part], edges, ids[a:b], found)
                if len(found) > SUMMED:
                    yield out()
                    found.clear()
    if found:
        yield out()


def count(data: np.ndarray, offsets: np.ndarray, ids: list[str], found: Counter[bytes]) -> None:
    """Adds the words of a block's texts to `found`."""
    starts, ends, of = runs(data, offsets)
    if not len(starts):
        return
    heads = np.array([crc32(f"{k}:".encode()) for k in ids], np.uint32)
    h = checksums(data, starts, ends, heads[of])
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    length = points[ends] - points[starts]
    hit = h % DAMAGE == 0
    for k in np.flatnonzero(hit & (length > SIZE)):
        word = data[starts[k] : ends[k]].tobytes().decode()
        at = int(h[k]) % len(word)
        found[(word[:at] + word[at + 1 :]).encode()] += 1
    whole = np.flatnonzero(~hit & (length >= SIZE))
    starts, ends = starts[whole], ends[whole]
    _, first, n = np.unique(range_hashes(data, starts, ends), return_index=True, return_counts=True)
    for a, b, c in zip(starts[first].tolist(), ends[first].tolist(), n.tolist(), strict=True):
        found[data[a:b].tobytes()] += c


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that take part."""
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    return texts.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


#: A block: the shorter word's length m; how many code points at the front and at the back are shared, and which.
KEY = ["m", "front", "back", "head", "tail"]


def _block(rows: DataFrame, m, front, back) -> DataFrame:
    """rows (word, n, length) under the blocks of words whose first `front` and last `back` code points are the same."""
    keyed = rows.withColumns({"m": m, "front": front, "back": back}).withColumns({"head": F.expr("left(word, front)"), "tail": F.expr("reverse(right(word, back))")})
    return keyed.select("word", "n", "length", *KEY)


def _halves(rows: DataFrame, front, back, left) -> DataFrame:
    """Each row under two blocks: what is shared, and the first or the last half of the `left` code points between."""
    half = F.floor(left / 2).cast("int")
    return _block(rows, F.col("m"), front + half, back).union(_block(rows, F.col("m"), front, back + half))


def dictionary(words: DataFrame, held: Held, most: int) -> DataFrame:
    """(word, n, length, KEY): each word under its blocks, those with over `most` pairs subdivided."""
    sized = words.withColumn("length", F.length("word"))
    both = sized.withColumn("m", F.col("length")).union(sized.withColumn("m", F.col("length") - 1)).where(F.col("m") >= SIZE)
    now = held(_halves(both, F.lit(0), F.lit(0), F.col("m")), "halves")
    done = None
    while True:
        short = F.sum(F.when(F.col("length") == F.col("m"), 1).otherwise(0))
        sizes = now.groupBy(*KEY).agg((F.greatest(short, F.lit(1)) * F.count("*")).alias("pairs")).where("m - front - back >= 2")
        large = held(sizes.where(F.col("pairs") > most).drop("pairs"), "large")
        if large.isEmpty():
            return now if done is None else done.union(now)
        left = now.join(large, KEY, "left_anti").select(now.columns)
        done = held(left if done is None else done.union(left), "narrow")
        wide = now.join(large, KEY, "left_semi").select(now.columns)
        between = F.col("m") - F.col("front") - F.col("back")
        now = held(_halves(wide, F.col("front"), F.col("back"), between), "halves")


def near_pairs(words: list[bytes], length: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes (i, j) of pairs one edit apart; i is of length m, j of m or m + 1.

    words: latin-1, of one m, blocks end to end, the shorter ones of each block first; ends: where the block of each ends.
    """
    m = int(length.min())
    at = np.arange(len(words))
    partners = np.where(length == m, ends - at - 1, 0)
    table = np.frombuffer(b"".join(w.ljust(m + 1, b"\0") for w in words), np.uint8).reshape(-1, m + 1)
    total = np.concatenate([[0], np.cumsum(partners)])
    step = max(1, AT_ONCE // (m + 1))
    for a in range(0, int(total[-1]), step):
        pair = np.arange(a, min(a + step, int(total[-1])))
        i = np.searchsorted(total, pair, "right") - 1
        j = i + 1 + pair - total[i]
        one, two = table[i], table[j]
        same = one[:, :m] == two[:, :m]
        good = np.zeros(len(pair), bool)
        even = length[j] == m
        good[even] = same[even].sum(1) == m - 1
        odd = np.flatnonzero(~even)
        front = np.logical_and.accumulate(same[odd], axis=1).sum(1)
        back = np.logical_and.accumulate((one[odd, :m] == two[odd, 1:])[:, ::-1], axis=1).sum(1)
        good[odd] = front + back >= m
        yield i[good], j[good]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (word, n, length, KEY) to (word, near, near_n), both ways."""
    held: list[pa.RecordBatch] = []

    def pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
        words, n, length, m, new = _read(table)
        for a, b in _stretches(m):
            starts = np.flatnonzero(new[a:b])
            ends = np.repeat(np.append(starts[1:], b - a), np.diff(np.append(starts, b - a)))
            for i, j in near_pairs(words[a:b], length[a:b], ends):
                x, y = np.concatenate([i, j]) + a, np.concatenate([j, i]) + a
                text = table.column("word").combine_chunks()
                yield pa.RecordBatch.from_arrays([text.take(pa.array(x)), text.take(pa.array(y)), pa.array(n[y])], ["word", "near", "near_n"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) < 20_000:
            continue
        table = pa.Table.from_batches(held)
        cut = int(np.flatnonzero(_read(table)[4])[-1])  # the last block may go on
        if cut:
            yield from pieces(table.slice(0, cut))
            held = table.slice(cut).to_batches()
    if held and sum(x.num_rows for x in held):
        yield from pieces(pa.Table.from_batches(held))


def _read(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words, n, length, m, and where a block begins."""
    n, length, m, front, back = (table.column(k).to_numpy() for k in ("n", "length", "m", "front", "back"))
    new = np.ones(len(n), bool)
    for x in (m, front, back, *(np.array(table.column(k).to_pylist(), object) for k in ("head", "tail"))):
        if x is m:
            new[1:] = x[1:] != x[:-1]
        else:
            new[1:] |= x[1:] != x[:-1]
    return [w.encode("latin-1") for w in table.column("word").to_pylist()], n, length, m, new


def _stretches(m: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = [0, *(np.flatnonzero(m[1:] != m[:-1]) + 1).tolist(), len(m)]
    return zip(edges[:-1], edges[1:], strict=True)


def near(words: DataFrame, held: Held, most: int = PAIRS) -> DataFrame:
    """(word, near, near_n), a row for each near word of a word."""
    listed = dictionary(words, held, most)
    parts = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = listed.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY, "length", "word")
    return ranges.mapInArrow(_scanned, "word string, near string, near_n long").dropDuplicates(["word", "near"])  # found by both halves


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = PAIRS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word that takes part."""
    held = Held(docs.sparkSession)
    words = held(vocabulary(docs, id_col, text_col), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    each = near(words, held, most).groupBy("word").agg(F.count("*").alias("n_near"), best)
    told = words.join(each, "word", "left").withColumn("leads", F.coalesce(-F.col("best.less") >= 2 * F.col("n"), F.lit(False)))
    of = lambda x: F.when(F.col("leads"), x)
    now = told.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), of(F.col("best.near")).alias("form"), of(-F.col("best.less")).alias("form_n"))
    now = held(now.withColumn("root", F.coalesce("form", "word")), "forms")
    while True:
        # those whose root leads on somewhere else
        further = now.where("root <> word").select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = now.join(further, F.col("root") == F.col("_word"), "left")
        if now.join(further, F.col("root") == F.col("_word"), "left_semi").isEmpty():
            held.release(now)
            return now
        now = held(moved.withColumn("root", F.coalesce("_root", "root")).drop("_word", "_root"), "roots")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE_OP12 = r"""
WITH RECURSIVE t(i, c, k) AS MATERIALIZED (SELECT i, i::BIGINT, 0 FROM range(256) r(i) UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM t WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM t WHERE k = 8),
run AS MATERIALIZED (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents) GROUP BY ALL),
b AS MATERIALIZED (SELECT doc_id, w, n, flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)) AS bytes FROM run),
h AS MATERIALIZED (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda s, x: xor(s >> 8, tab[(xor(s, x) & 255) + 1])), 4294967295) AS h FROM b, crc),
u AS (SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM u WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
d AS MATERIALIZED (SELECT word, n, i, left(word, i::INT - 1) || substr(word, i::INT + 1) AS less FROM v, range(1, 1000) r(i) WHERE i <= length(word)),
p AS MATERIALIZED (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM d a JOIN v b ON a.less = b.word UNION SELECT b.word, a.word, a.n FROM d a JOIN v b ON a.less = b.word),
e AS (SELECT word, near, near_n, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM p),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(e.n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM v LEFT JOIN e ON v.word = e.word AND e.k = 1),
g(word, root) AS (SELECT word, word FROM f UNION ALL SELECT g.word, f.form FROM g JOIN f ON f.word = g.root WHERE f.form IS NOT NULL)
SELECT f.word, form, g.root, f.n, n_near, form_n FROM f JOIN g ON g.word = f.word WHERE g.root IN (SELECT word FROM f WHERE form IS NULL)
"""
