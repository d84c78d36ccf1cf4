"""Removal of passages that repeat anywhere, by suffix trees over groups of suffixes that share a prefix.

A window is WINDOW consecutive words [^\\x20\\x09-\\x0D]+ of one document. Each word is removed that is covered by a
window whose words also start anywhere else, the same document included; so all copies go, the first one too. Windows
are judged on the input.

The suffixes are those that start a window; of the tree of all of them only the inner nodes at a depth of WINDOW words
or more matter, whose leaves are the repeats.

1. Prefixes. Each window holds WINDOW - GRAM + 1 grams of GRAM words; its anchor is the one with the least hash, the
   leftmost of equals. Equal windows have equal anchors at equal places, so a suffix is filed under its anchor's gram and
   place, which stand for a prefix that is as long as the place says. Suffixes with one anchor lie side by side and go
   as one segment.
2. Pruning. Anchors are counted by gram; suffixes under a gram that is found once are leaves below the root, and go no
   further. Grams that a task's batch holds twice or more are known to stay, so the batch sends one of them to be counted
   for all, and a hot gram is counted by sums.
3. Groups. What is left is dealt by gram and sorted, so a task takes whole groups, some ten thousand segments at a time.
   Segments of a batch that are equal word for word repeat each other and send one for all. A gram with over HOT segments
   isn't held by one task: each of its suffixes takes the longest prefix instead, all WINDOW words, as a 128-bit digest,
   and those are summed where they are.
4. Subtrees. A task grows the trees of its groups from the top, RANGE words a step, all groups side by side: suffixes
   with the same node and the same next words move to one child, and those alone drop out. What is left at depth WINDOW
   hangs under a deep inner node.
5. Runs of such suffixes are spans of words; the words outside of all spans stay.

Texts that occur twice or more go whole if they have WINDOW words, and one of them stands for all in the trees.
Hashes of words have 64 bits (`textarrays.range_hashes`), those of steps are mixed from them: two different windows are
taken for equal by chance alone. 64-bit hashes of texts bring anchors to texts only; spans belong to a text's MD5.

Defined results: a null text has no words; repeated rows are copies of each other; ties don't arise, as all copies go;
ids only pass through, of any type, nulls too; a very long text is read in pieces of about half a megabyte that overlap;
an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.llm.textarrays import BLOCK, WHITE, Block, blocks, grams, mix, owners, powers, range_hashes, released
from tarnwheel.session import Held

WINDOW, GRAM = 35, 18
SIDE = WINDOW - GRAM
#: Words that a step of a tree reads.
RANGE = 5
#: Segments in memory at once, and the most that a gram may have there.
TOGETHER, HOT = 30_000, 50_000
#: Bytes of a table that is broadcast.
MOST_BYTES = 16 << 20
U64 = np.uint64
_PLACE_BITS = 22
_MASK = U64((1 << _PLACE_BITS) - 1)


def pieces(data: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words before it, bytes) of pieces of one text that hold each window in exactly one of them."""
    begin = base = 0
    while True:
        stop = begin + size
        while stop < len(data):  # on to the next white space
            white = np.flatnonzero(WHITE[data[stop : stop + size]])
            stop += int(white[0]) if len(white) else size
            if len(white):
                break
        piece = data[begin:stop]
        yield base, piece
        if stop >= len(data):
            return
        starts, _, _ = Block(piece, np.array([0, len(piece)])).words()
        if len(starts) >= WINDOW:  # the next one begins with the last WINDOW - 1 words
            base += len(starts) - WINDOW + 1
            begin += int(starts[len(starts) - WINDOW + 1])
        else:
            size *= 2  # a few huge words


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each `width` neighbours, the leftmost of equals."""
    step, out = int(_MASK) - width, []
    for a in range(0, max(1, len(h) - width + 1), step):
        part = h[a : a + step + width - 1]
        rows = -(-len(part) // width)
        keyed = np.full(rows * width, U64(2**64 - 1))
        keyed[: len(part)] = (part & ~_MASK) | np.arange(len(part), dtype=U64)
        table = keyed.reshape(rows, width)
        before = np.minimum.accumulate(table, axis=1).ravel()
        after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - width + 1
        out.append((np.minimum(after[:n], before[width - 1 : width - 1 + n]) & _MASK).astype(np.int64) + a)
    return np.concatenate(out)


def anchors(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and their texts to (first word of the first window, place of the anchor there, windows, gram) of anchors."""
    none = np.zeros(0, np.int64)
    if len(h) < WINDOW:
        return none, none, none, none.astype(U64)
    up, down = powers(len(h))
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(h * up[: len(h)], dtype=U64)])
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(h) - GRAM + 1])
    least = _least(gram, SIDE + 1)
    start = np.flatnonzero(of[: len(h) - WINDOW + 1] == of[WINDOW - 1 :])
    anchor = least[start]
    if not len(start):
        return none, none, none, none.astype(U64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (of[start][1:] != of[start][:-1])]))
    n = np.diff(np.append(new, len(start)))
    return start[new], anchor[new] - start[new], n, gram[anchor[new]]


def _packed(start: np.ndarray, off: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (start << 16) | (off << 8) | n


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text) to (key, h, row, at, weight), a row for each anchor; at: first word, place and windows in one number.

    Of a gram that the batch holds w times, one comes with weight w and the gram as key; the others, which are known to
    stay, with weight 0 and a key of their own.
    """
    for batch in batches:
        rows = batch.column(0).to_numpy()
        found: list[tuple] = []
        for a, _, data, offsets in blocks(batch.column(1)):
            parts = [(0, data, offsets)]
            if len(offsets) == 2 and len(data) > BLOCK:
                parts = ((base, x, np.array([0, len(x)])) for base, x in pieces(data))
            for base, x, edges in parts:
                block = Block(x, edges)
                starts, ends, firsts = block.words()
                of = owners(firsts)
                start, off, n, h = anchors(block.hashes(starts, ends), of)
                text = of[start]
                found.append((h, rows[a + text], _packed(base + start - firsts[text], off, n)))
        if not found:
            continue
        h, row, at = (np.concatenate(x) for x in zip(*found, strict=True))
        _, first, w = np.unique(h, return_index=True, return_counts=True)
        weight, key = np.zeros(len(h), np.int64), mix(row.view(U64) + at.view(U64))
        weight[first], key[first] = w, h[first]
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(h.view(np.int64)), pa.array(row), pa.array(at), pa.array(weight)], ["key", "h", "row", "at", "weight"])
    released()


def _stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, h, row, at, weight) to (h, row, at, n) of those that aren't alone; n, the gram's anchors, is 0 if not counted here.

    Of a key only one row is held back, until the next one shows whether it is alone.
    """
    names = ["h", "row", "at", "n"]
    held, total = None, 0  # the last row so far, and the weight of its gram up to it

    def out(rows: pa.RecordBatch, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(n.astype(np.int64))], names)

    for batch in batches:
        weight = batch.column(4).to_numpy()
        rows = batch.select([1, 2, 3])
        sure, counted = np.flatnonzero(weight == 0), np.flatnonzero(weight)
        if len(sure):
            yield out(rows.take(pa.array(sure)), np.zeros(len(sure)))
        if not len(counted):
            continue
        rows, weight = rows.take(pa.array(counted)), weight[counted]
        h = rows.column(0).to_numpy()
        group = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))
        whole = np.bincount(group, weight)
        more = held is not None and held.column(0)[0].as_py() == h[0]
        if held is not None and (more or total > 1):
            yield out(held, np.array([total]))
        if more:
            whole[0] += total
        keep = np.flatnonzero(whole[group][:-1] > 1)  # the last row's gram may go on
        yield out(rows.take(pa.array(keep)), whole[group][keep])
        held, total = rows.slice(len(h) - 1, 1), int(whole[-1])
    if total > 1:
        yield out(held, np.array([total]))


def normal(text: str) -> tuple[bytes, np.ndarray]:
    """The words of a text joined by one space each, and where each word begins (and an end, one past the last word's space)."""
    data = text.encode().translate(_SPACES)
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    data = data.strip(b" ")
    if not data:
        return data, np.zeros(1, np.int64)
    return data, np.concatenate([[0], np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1, [len(data) + 1]])


_SPACES = bytes(32 if WHITE[k] else k for k in range(256))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(md, text, spots) to (md, h, start, off, n, words): the words of all suffixes under one anchor, or words null for a span.

    Segments that the batch holds twice come as spans, and one of them again as a segment for those of other batches.
    """
    for batch in batches:
        names, texts, spots = batch.column(0), batch.column(1), batch.column(2)
        seen: dict[tuple, int] = {}
        text, h, at, words, double = [], [], [], [], []
        for k in range(batch.num_rows):
            data, edges = normal(texts[k].as_py())
            for x in spots[k].as_py():
                start, n = x["at"] >> 16, x["at"] & 255
                if start + n + WINDOW - 1 >= len(edges):
                    continue  # of another text whose hash is the same
                piece = data[edges[start] : edges[start + n + WINDOW - 1] - 1]
                place = seen.setdefault((x["h"], x["at"] & 0xFFFF, piece), len(text))
                if place < len(text):
                    double[place] = True
                text.append(k)
                h.append(x["h"])
                at.append(x["at"])
                words.append(piece if place == len(text) - 1 else None)
                double.append(place < len(text) - 1)
        spans = [k for k, (d, w) in enumerate(zip(double, words, strict=True)) if d and w is not None]
        text += [text[k] for k in spans]
        h += [h[k] for k in spans]
        at += [at[k] for k in spans]
        words += [None] * len(spans)
        packed = np.array(at, np.int64)
        columns = [names.take(pa.array(text, pa.int64())), pa.array(h, pa.int64()), pa.array((packed >> 16).astype(np.int32)), pa.array((packed >> 8 & 255).astype(np.int32)), pa.array((packed & 255).astype(np.int32)), pa.array(words, pa.binary())]
        for a in range(0, len(text), 20_000):
            yield pa.RecordBatch.from_arrays(columns, ["md", "h", "start", "off", "n", "words"]).slice(a, 20_000)


def repeated(segments: list[bytes], group: np.ndarray, off: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that hang under nodes WINDOW words deep: (segment, suffix of it), in order.

    group: the gram of each segment; off: where its anchor lies in its first suffix; n: its suffixes.
    """
    data = np.frombuffer(b" ".join(segments), np.uint8)
    sizes = np.array([len(x) + 1 for x in segments])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    offsets[-1] = len(data)
    starts, ends, firsts = Block(data, offsets).words()
    h = range_hashes(data, starts, ends)
    step, _ = grams(h, np.zeros(len(h), np.int8), RANGE)
    seg = np.repeat(np.arange(len(segments)), n)
    k = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    at = firsts[seg] + k
    node = mix(group[seg].view(U64) + (off[seg] - k).astype(U64) * U64(0x9E3779B97F4A7C15))
    alive = np.arange(len(seg))
    for depth in range(0, WINDOW, RANGE):
        node = mix(node * U64(0xC2B2AE3D27D4EB4F) + step[at[alive] + depth])
        _, child, count = np.unique(node, return_inverse=True, return_counts=True)
        several = count[child] > 1
        alive, node = alive[several], node[several]
    return seg[alive], k[alive]


def _spans(seg: np.ndarray, k: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order to runs of neighbours: (segment, first word, word after the last)."""
    if not len(seg):
        return seg, seg, seg
    new = np.flatnonzero(np.concatenate([[True], (seg[1:] != seg[:-1]) | (k[1:] != k[:-1] + 1)]))
    last = np.append(new[1:], len(seg)) - 1
    return seg[new], start[seg[new]] + k[new], start[seg[new]] + k[last] + WINDOW


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, md, h, start, off, n, words, hot) to (md, start, stop, x, y): spans, or single suffixes by their digest x, y."""

    def out(md: pa.Array, start: np.ndarray, stop: np.ndarray, name: np.ndarray | None = None) -> pa.RecordBatch:
        none = pa.nulls(len(md), pa.int64())
        x, y = (none, none) if name is None else (pa.array(name[:, 0]), pa.array(name[:, 1]))
        return pa.RecordBatch.from_arrays([md, pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), x, y], ["md", "start", "stop", "x", "y"])

    def group(table: pa.Table) -> Iterator[pa.RecordBatch]:
        md, words = (table.column(c).combine_chunks() for c in ("md", "words"))
        h, start, off, n = (table.column(c).to_numpy() for c in ("h", "start", "off", "n"))
        seg, k = repeated(words.to_pylist(), h, off, n)
        seg, a, b = _spans(seg, k, start)
        yield out(md.take(pa.array(seg)), a, b)

    def named(table: pa.Table) -> Iterator[pa.RecordBatch]:
        md, words = (table.column(c).combine_chunks() for c in ("md", "words"))
        start, n = (table.column(c).to_numpy() for c in ("start", "n"))
        seg, first, names = [], [], []
        for s, (piece, size) in enumerate(zip(words.to_pylist(), n.tolist(), strict=True)):
            some = piece.split(b" ")
            for k in range(size):
                seg.append(s)
                first.append(k)
                names.append(blake2b(b" ".join(some[k : k + WINDOW]), digest_size=16).digest())
        a = start[seg] + np.array(first, np.int64)
        yield out(md.take(pa.array(seg, pa.int64())), a, a + WINDOW, np.frombuffer(b"".join(names), np.int64).reshape(-1, 2))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        null, hot = (batch.column(c).to_numpy(zero_copy_only=False) for c in (6, 7))
        null = np.asarray(batch.column(6).is_null())
        done = batch.filter(pa.array(null))
        if done.num_rows:
            start, n = done.column(3).to_numpy(), done.column(5).to_numpy()
            yield out(done.column(1), start, start + n + WINDOW - 1)
        some = batch.filter(pa.array(hot & ~null))
        for a in range(0, some.num_rows, 5000):
            yield from named(pa.Table.from_batches([some.slice(a, 5000)]))
        rest = batch.filter(pa.array(~hot & ~null))
        if rest.num_rows:
            held.append(rest)
        if sum(x.num_rows for x in held) >= TOGETHER:
            table = pa.Table.from_batches(held)
            h = table.column("h").to_numpy()
            cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0  # the last gram may go on
            if cut:
                yield from group(table.slice(0, cut))
                held = table.slice(cut).to_batches()
    if held:
        yield from group(pa.Table.from_batches(held))
    released()


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the words that spans cover."""
    out: list[list[int]] = []
    for start, stop in sorted((x["start"], x["stop"]) for x in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(md, spans) to (md, maximal runs)."""
    for batch in batches:
        runs = [[{"start": a, "stop": b} for a, b in merged(x)] for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, _RUNS)], ["md", "spans"])


def _cut(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    """(id, text, copied, spans) to the id, its number of words, the runs that went and the words left."""
    for whole in batches:
        for batch in (whole.slice(k, 250) for k in range(0, whole.num_rows, 250)):
            sizes, runs, kept = [], [], []
            for text, copied, spans in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                data, edges = normal(text)
                n = len(edges) - 1
                gone = ([(0, n)] if n >= WINDOW else []) if copied else [(x["start"], x["stop"]) for x in spans or []]
                bounds = [0, *(x for run in gone for x in run), n]
                kept.append(b" ".join(data[edges[a] : edges[b] - 1] for a, b in zip(bounds[::2], bounds[1::2], strict=True) if a < b))
                sizes.append(n)
                runs.append([{"start": a, "stop": b} for a, b in gone])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())], [id_col, "n_words", "spans", "kept"])


def _small(df: DataFrame, size) -> DataFrame:
    """df to be broadcast if the sum of `size`, bytes of a row, shows that it may be; else as it is, for a shuffle join."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= MOST_BYTES else df


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("md"))


def _found(texts: DataFrame, copies: DataFrame, held: Held, hot: int) -> DataFrame:
    """(md, spans) of texts with repeated windows; held."""
    spark = texts.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    later = F.col("_md").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    once = texts.join(copies, F.col("md") == F.col("_md"), "left").where(~later).select(F.xxhash64("text").alias("row"), "md", "text")
    anchored = once.select("row", "text").mapInArrow(_anchored, "key long, h long, row long, at long, weight long")
    spots = held(anchored.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_stay, "h long, row long, at long, n long"), "anchors")
    often = spots.where(F.col("n") > hot).select(F.col("h").alias("_h")).distinct()
    each = spots.groupBy("row").agg(F.collect_set(F.struct("h", "at")).alias("spots"))
    segments = once.join(each, "row").select("md", "text", "spots").mapInArrow(_segments, "md binary, h long, start int, off int, n int, words binary")
    flagged = segments.join(_small(often, F.lit(8)), F.col("h") == F.col("_h"), "left").withColumn("hot", F.col("_h").isNotNull())
    # spans, and suffixes that meet theirs later, are dealt by text
    key = F.when(F.col("hot") | F.col("words").isNull(), F.xxhash64("md", "start")).otherwise(F.col("h"))
    dealt = flagged.select(key.alias("key"), "md", "h", "start", "off", "n", "words", "hot")
    grown = held(dealt.repartition(parts, "key").sortWithinPartitions("key", "h").mapInArrow(_grown, "md binary, start int, stop int, x long, y long"), "suffixes")
    deep = grown.where("x is not null")
    inner = deep.groupBy("x", "y").agg(F.count("*").alias("leaves")).where("leaves > 1")
    spans = grown.where("x is null").select("md", "start", "stop").union(deep.join(inner, ["x", "y"]).select("md", "start", "stop"))
    return held(spans.groupBy("md").agg(F.collect_set(F.struct("start", "stop")).alias("spans")).mapInArrow(_runs, "md binary, spans array<struct<start: int, stop: int>>"), "text-spans")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Each row's id, n_words, the maximal removed runs of words `spans` (start, stop), and the words left as `kept`, joined by a space."""
    held = Held(docs.sparkSession)
    texts = _hashed(docs, id_col, text_col)
    who = F.struct(F.col("id").isNotNull().alias("some"), "id")
    copies = held(texts.groupBy("md").agg(F.min(who).alias("owner"), F.count("*").alias("rows")).where("rows > 1").select(F.col("md").alias("_md"), "owner.id"), "text-copies").withColumnRenamed("id", "owner")
    copies = _small(copies, F.lit(48))
    spans = _found(texts, copies, held, hot)
    spans = _small(spans.withColumnRenamed("md", "_text"), 24 + 8 * F.size("spans"))
    rows = texts.join(copies, F.col("md") == F.col("_md"), "left").join(spans, F.col("md") == F.col("_text"), "left")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, spans array<struct<start: int, stop: int>>, kept string"
    out = rows.select("id", "text", F.col("_md").isNotNull().alias("copied"), "spans").mapInArrow(lambda it: _cut(it, id_col), schema)
    held.release(out)
    return out


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_OP11 = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT rowid_ AS r, doc_id, w FROM (SELECT row_number() OVER () AS rowid_, doc_id, w FROM d)),
v AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM s WHERE len(w) >= 35),
m AS MATERIALIZED (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS m FROM v),
t AS (SELECT r, i FROM m WHERE m IN (SELECT m FROM m GROUP BY m HAVING count(*) > 1)),
g AS (SELECT r, list_distinct(flatten(list(range(i, i + 35)))) AS gone FROM t GROUP BY r),
k AS (SELECT s.r, doc_id, w, coalesce(gone, []) AS gone FROM s LEFT JOIN g ON g.r = s.r),
e AS (SELECT r, doc_id, len(w) AS n_words, len(gone) AS n_removed,
    CASE WHEN len(gone) = len(w) THEN '' WHEN len(gone) = 0 THEN array_to_string(w, ' ') ELSE array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]), ' ') END AS kept FROM k)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(kept) AS kept_sha256 FROM e
"""
