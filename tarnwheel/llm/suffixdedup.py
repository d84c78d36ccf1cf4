"""Exact removal of repeated byte strings by column-wise construction over a collection of segments.

Every byte covered by a WINDOW-byte string that also starts earlier (in a document with a smaller id, or earlier in the
same one) is removed; strings are judged on the input, overlaps count, and no string crosses documents.

1. Anchors. Each WINDOW-byte string holds WINDOW - GRAM + 1 grams of GRAM bytes; its anchor is the one with the least
   hash, the leftmost of equals. Equal strings have equal anchors at equal places, so only strings at anchors whose
   gram occurs twice or more can repeat: the anchors' hashes are sorted by Spark, and lone ones dropped.
2. Segments. Around each remaining anchor, the SIDE bytes before and after it hold all strings that it can anchor, one
   for each start column. The segments are the documents of the collection.
3. Columns. From the last column to the first, one symbol of each segment is inserted before its current suffix. The
   inserted column, in the order of the suffixes so far, is that column's part of the collection's Burrows-Wheeler
   transform; sorting it stably gives the order of the longer suffixes, and the common prefixes of neighbours follow
   from it: one more than the least common prefix between the two where the symbols are equal, else none. Only the
   current suffix of each segment is kept, since strings with one anchor repeat at one column.
4. At each start column, neighbours with WINDOW or more in common form an interval: equal strings. All but its first
   are later copies, and their bytes are covered.

A task takes its segments in sorted order, some ten thousand at a time, so all of an anchor's are together. An anchor
with over HOT segments goes another way, with all else equal: its strings are grouped by a 128-bit BLAKE2 digest each,
summed up where they are, so that no task gets all of a hot group.

Exact copies of whole texts are found by their digest first; the later ones are removed whole if they have WINDOW bytes.
64-bit hashes choose anchors only: two grams that fall together cost time, never a wrong byte. Rows are known by id and
a 64-bit hash of id and text, so what goes is decided for that id alone; two rows of one id whose hashes fall together
(a chance of 2**-64 for each such pair) would share their fate.

Defined results: a null text is an empty one; rows with equal ids and texts share their fate and are no copies of each
other; null ids come first, and equal ids fall back on a hash of the text; an empty table gives no rows; other columns
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.llm.textarrays import Block, blocks, mix
from tarnwheel.session import written

WINDOW, GRAM = 100, 36
SIDE = WINDOW - GRAM
WIDTH = WINDOW + SIDE
#: Segments that are sorted at once, and the most that one anchor may have there.
TOGETHER, HOT = 30_000, 200_000
#: Bytes of texts, segments and texts that a step of a worker holds beside its batch.
BYTES, CUT, TEXTS = 1 << 19, 4_000, 250
#: Most rows of a table that is broadcast.
MOST_ROWS = 300_000


def anchors(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that anchor any string of a block's texts."""
    n = len(block.data)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = block.rolling(np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    out = [_least(h[a : a + _PIECE + SIDE]) + a for a in range(0, max(1, len(h) - SIDE), _PIECE)]
    least = np.concatenate(out)  # for each start of a string, the place of its anchor
    inside = np.zeros(n + 1, np.int32)  # starts of strings that end within their text
    np.add.at(inside, block.offsets[:-1], 1)
    np.add.at(inside, np.maximum(block.offsets[:-1], block.offsets[1:] - WINDOW + 1), -1)
    place = least[np.cumsum(inside)[: len(least)] > 0]
    place = place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place
    return place, h[place]


#: Places that fit beside a hash's upper bits.
_PLACE_BITS = 22
_PIECE = (1 << _PLACE_BITS) - SIDE


def _least(h: np.ndarray) -> np.ndarray:
    """The place of the least of each SIDE + 1 neighbours, the leftmost of equals: least before and after block edges."""
    width, mask = SIDE + 1, np.uint64((1 << _PLACE_BITS) - 1)
    rows = -(-len(h) // width)
    keyed = np.full(rows * width, np.uint64(2**64 - 1))
    keyed[: len(h)] = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    table = keyed.reshape(rows, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - SIDE
    return (np.minimum(after[:n], before[SIDE : SIDE + n]) & mask).astype(np.int64)


def _cuts(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The WIDTH bytes around each place; outside of the data, whatever is there."""
    column = place.astype(np.int32)[:, None] + np.arange(-SIDE, WIDTH - SIDE, dtype=np.int32)[None, :]
    return data[np.clip(column, 0, max(0, len(data) - 1), out=column)]


def _again(block: Block, place: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places whose segment is whole and the same, byte for byte, as an earlier one of its text."""
    out = np.zeros(len(place), bool)
    full = np.flatnonzero((place - SIDE >= block.offsets[text]) & (place + GRAM + SIDE <= block.offsets[text + 1]))
    key = block.rolling(place[full] - SIDE, place[full] + GRAM + SIDE)
    order = full[np.lexsort((place[full], key, text[full]))]
    for a in range(0, len(order) - 1, CUT):
        one, two = order[a : a + CUT], order[a + 1 : a + CUT + 1]
        one = one[: len(two)]
        same = (text[one] == text[two]) & (_cuts(block.data, place[one]) == _cuts(block.data, place[two])).all(1)
        out[two[same]] = True
    return out


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text) to (h, row, at, again) of each anchor; at counts bytes from the text's start.

    again: whether the text has the same segment before, so that all strings at the anchor are later copies. Such
    anchors need no partner and come with any h, or a periodic text would send one anchor over and over.
    """
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for a, _, data, offsets in blocks(batch.column(1), BYTES):
            block = Block(data, offsets)
            place, h = anchors(block)
            text = np.searchsorted(offsets, place, "right") - 1
            at, again = (place - offsets[text]).astype(np.int32), _again(block, place, text)
            h = np.where(again, mix(rows[a + text].view(np.uint64) + at.astype(np.uint64)), h)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(rows[a + text]), pa.array(at), pa.array(again)], ["h", "row", "at", "again"])


def _repeated(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted (h, row, at, again) to those whose h isn't alone, with `hot`: whether there are more than `most` of it.

    Those that are `again` come out as they are and count for nothing.
    """
    held: list[pa.RecordBatch] = []
    last, n, hot = None, 0, False

    def out(part: pa.RecordBatch, flag: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(flag)], ["h", "row", "at", "again", "hot"])

    for batch in batches:
        again = batch.column(3)
        if again.true_count:
            part = batch.filter(again)
            yield out(part, np.full(part.num_rows, False))
            batch = batch.filter(pc.invert(again))
        h = batch.column(0).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else []
        ends = [*first[1:], len(h)] if len(h) else []
        if not len(h):
            continue
        if held and h[0] != last:
            if n > 1:
                yield from (out(part, np.full(part.num_rows, False)) for part in held)
            held, n, hot = [], 0, False
        if hot and h[0] != last:
            hot, n = False, 0
        sizes = np.array(ends) - first
        if h[0] == last and (held or hot):
            head = batch.slice(0, int(sizes[0]))
            n += int(sizes[0])
            held.append(head)
            if n > most or hot:
                hot = True
                yield from (out(part, np.full(part.num_rows, True)) for part in held)
                held = []
            body = 1
        else:
            body = 0
        if len(sizes) > body:
            if held and n > 1:
                yield from (out(part, np.full(part.num_rows, False)) for part in held)
            held, hot = [], False
            middle = sizes[body:-1]
            if len(middle):
                a, b = int(first[body]), int(first[-1])
                keep = np.repeat(middle > 1, middle)
                yield out(batch.slice(a, b - a), np.repeat(middle > most, middle)).filter(pa.array(keep))
            held, n = [batch.slice(int(first[-1]), int(sizes[-1]))], int(sizes[-1])
            if n > most:
                hot = True
                yield out(held[0], np.full(n, True))
                held = []
        last = h[-1]
    if held and n > 1:
        yield from (out(part, np.full(part.num_rows, False)) for part in held)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, row, text, anchors) to a row for each anchor: h, hot, id, row, at, left, right, bytes.

    left and right: how many bytes there are on either side, SIDE at most; the rest of `bytes` is filled up. Anchors
    that are `again` come with left = -1 and no bytes.
    """
    for batch in batches:
        ids, rows = batch.column(0), batch.column(1).to_numpy()
        spots = batch.column(3)
        for a, b, data, offsets in blocks(batch.column(2), BYTES):
            found = spots.slice(a, b - a)
            n = np.diff(found.offsets.to_numpy())
            flat = found.flatten()
            at, h, hot, again = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("at", "h", "hot", "again"))
            text = np.repeat(np.arange(b - a), n)
            for c in range(0, len(at), CUT):
                s = slice(c, c + CUT)
                place = offsets[text[s]] + at[s]
                left = np.where(again[s], -1, np.minimum(SIDE, at[s]))
                right = np.minimum(SIDE, offsets[text[s] + 1] - place - GRAM)
                cut, column = _cuts(data, place), np.arange(-SIDE, WIDTH - SIDE)[None, :]
                cut[(column < -left[:, None]) | (column >= (GRAM + right)[:, None]) | again[s][:, None]] = 0
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(cut), [None, pa.py_buffer(np.ascontiguousarray(cut))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[s]), pa.array(hot[s]), ids.take(pa.array(a + text[s])), pa.array(rows[a + text[s]]), pa.array(at[s]), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), raw],
                    ["h", "hot", "id", "row", "at", "left", "right", "bytes"],
                )


def column_wise(symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each start column, last first: (column, order of the suffixes from it, common prefixes with the one before).

    symbols: segments x columns. Common prefixes are counted up to WINDOW.
    """
    n = len(symbols)
    by_column = np.ascontiguousarray(symbols.T)
    order, common = np.arange(n), np.zeros(n, np.uint8)
    levels = max(1, n.bit_length())
    table = np.zeros((levels, n), np.uint8)
    log = np.zeros(n + 1, np.int8)
    for k in range(1, levels + 1):
        log[1 << k :] = k
    for column in range(symbols.shape[1] - 1, -1, -1):
        inserted = by_column[column][order]  # this column's part of the transform
        table[0] = common
        for k in range(1, levels):
            half = 1 << (k - 1)
            if 2 * half > n:
                break
            np.minimum(table[k - 1, : n - 2 * half + 1], table[k - 1, half : n - half + 1], out=table[k, : n - 2 * half + 1])
        to = np.argsort(inserted, kind="stable")
        order, sorted_symbols = order[to], inserted[to]
        low, high = to[:-1] + 1, to[1:]
        same = sorted_symbols[1:] == sorted_symbols[:-1]
        low, high = low[same], high[same]
        k = log[high - low + 1]
        least = np.minimum(table[k, low], table[k, high - (1 << k.astype(np.int64)) + 1])
        common = np.zeros(n, np.uint8)
        common[1:][same] = np.minimum(least, WINDOW - 1) + 1
        yield column, order, common


def copies(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """segments x (SIDE + 1) start columns: whether the string from there also starts earlier; rank: order of segments."""
    out = np.zeros((len(symbols), SIDE + 1), bool)
    never = np.int64(1 << 62)
    for column, order, common in column_wise(symbols):
        if column > SIDE:
            continue
        valid = ((SIDE - column <= left) & (column <= right))[order]
        ranks = np.where(valid, rank[order], never)
        starts = np.flatnonzero(common < WINDOW)
        first = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, len(ranks))))
        out[order[valid & (ranks > first)], column] = True
    return out


def _spans(hit: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True start columns to (segment, first byte, byte after the last)."""
    edge = np.zeros((len(hit), hit.shape[1] + 2), np.int8)
    edge[:, 1:-1] = hit
    turn = np.diff(edge, axis=1)
    seg, a = np.nonzero(turn == 1)
    _, b = np.nonzero(turn == -1)
    return seg, at[seg] - SIDE + a, at[seg] - SIDE + b - 1 + WINDOW


def _order(ids: pa.Array, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks by (id, row, at), nulls first, equal ones alike."""
    some = np.asarray(ids.is_valid())
    key = ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((at, rows, key, some))
    new = np.zeros(len(order), bool)
    for x in (some, key, rows, at):
        new[1:] |= x[order][1:] != x[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def _pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Segments, all of an anchor's together, to covered spans and to the strings of hot anchors."""
    names = ("id", "row", "at", "left", "right", "hot", "bytes")
    ids, rows, at, left, right, hot, raw = (table.column(k).combine_chunks() for k in names)
    rows, at, left, right, hot = (x.to_numpy(zero_copy_only=False) for x in (rows, at, left, right, hot))
    symbols = np.frombuffer(raw.buffers()[2], np.uint8, len(rows) * WIDTH, np.frombuffer(raw.buffers()[1], np.int32)[raw.offset]).reshape(-1, WIDTH)
    again = np.flatnonzero(left < 0)
    of = lambda k: ids.take(pa.array(k))
    yield _out(of(again), rows[again], at[again] - SIDE, at[again] + GRAM + SIDE)
    usual = np.flatnonzero((left >= 0) & ~hot)
    if len(usual) > 1:
        rank = _order(of(usual), rows[usual], at[usual])
        seg, a, b = _spans(copies(symbols[usual], left[usual], right[usual], rank), at[usual])
        yield _out(of(usual[seg]), rows[usual[seg]], a, b)
    some = np.flatnonzero((left >= 0) & hot)
    if len(some):
        columns = np.arange(SIDE + 1)[None, :]
        seg, column = np.nonzero((SIDE - columns <= left[some, None]) & (columns <= right[some, None]))
        seg = some[seg]
        flat = symbols.tobytes()
        named = b"".join(blake2b(flat[a : a + WINDOW], digest_size=16).digest() for a in (seg * WIDTH + column).tolist())
        name = np.frombuffer(named, np.int64).reshape(-1, 2)
        start = at[seg] - SIDE + column
        yield _out(of(seg), rows[seg], start, start + WINDOW, name)


def _out(ids: pa.Array, row: np.ndarray, start: np.ndarray, stop: np.ndarray, name: np.ndarray | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(row), pa.int64())
    x, y = (none, none) if name is None else (pa.array(name[:, 0]), pa.array(name[:, 1]))
    return pa.RecordBatch.from_arrays([ids, pa.array(row), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), x, y], ["id", "row", "start", "stop", "x", "y"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by h, some ten thousand at a time, to spans and strings."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= TOGETHER:
            table = pa.Table.from_batches(held)
            h = table.column("h").to_numpy()
            cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0  # the last anchor may go on
            if cut:
                yield from _pieces(table.slice(0, cut))
                held = table.slice(cut).to_batches()
    if held and sum(x.num_rows for x in held):
        yield from _pieces(pa.Table.from_batches(held))


def _small(df: DataFrame) -> DataFrame:
    """df to be broadcast if a count shows that it may be; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.limit(MOST_ROWS + 1).count() <= MOST_ROWS else df


def _covered(docs: DataFrame, id_col: str, text_col: str, hot: int) -> tuple[DataFrame, DataFrame]:
    """(id, row, spans) for rows by id and hash of id and text; (md, owner) of texts with copies."""
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumns({"md": F.md5("text"), "row": F.xxhash64("id", "text")})
    who = F.struct(F.col("id").isNotNull().alias("some"), "id")
    owners = texts.groupBy("md").agg(F.min(who).alias("owner"), F.max(who).alias("_last")).where("owner <> _last")
    owners = written(owners.select("md", F.col("owner.id").alias("owner")), "text-owners")
    later = F.col("_md").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    once = texts.join(_small(owners.withColumnRenamed("md", "_md")), F.col("md") == F.col("_md"), "left").where(~later).select("id", "row", "text")

    # repeated rows give each place twice: a set
    found = once.select("row", "text").mapInArrow(_anchored, "h long, row long, at int, again boolean").repartition(parts, "h").sortWithinPartitions("h")
    spots = found.mapInArrow(lambda it: _repeated(it, hot), "h long, row long, at int, again boolean, hot boolean").groupBy("row").agg(F.collect_set(F.struct("at", "h", "hot", "again")).alias("spots"))
    kinds = "h long, hot boolean, id long, row long, at int, left int, right int, bytes binary"
    segments = once.join(spots, "row").select("id", "row", "text", "spots").mapInArrow(_segments, kinds)

    # those that need no partner, or meet theirs later, are dealt by text
    dealt = segments.withColumn("h", F.when((F.col("left") < 0) | F.col("hot"), F.col("row")).otherwise(F.col("h")))
    found = written(dealt.repartition(parts, "h").sortWithinPartitions("h").mapInArrow(_compared, "id long, row long, start int, stop int, x long, y long"), "spans")
    strings = found.where("x is not null")
    who = F.struct(F.col("id").isNotNull().alias("some"), "id", "row", "start")
    first = strings.groupBy("x", "y").agg(F.min(who).alias("first"), F.max(who).alias("_last")).where("first <> _last").drop("_last")
    later = strings.join(first, ["x", "y"]).where(who > F.col("first"))
    spans = found.where("x is null").select("id", "row", "start", "stop").union(later.select("id", "row", "start", "stop"))
    each = spans.groupBy("id", "row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return written(each.mapInArrow(_runs, "id long, row long, spans array<struct<start: int, stop: int>>"), "row-spans"), owners


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that spans cover."""
    out: list[list[int]] = []
    for start, stop in sorted((x["start"], x["stop"]) for x in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, row, spans) to (id, row, maximal runs)."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        runs = [[{"start": a, "stop": b} for a, b in merged(x)] for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, kind)], ["id", "row", "spans"])


def _cut(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    """(id, text, later, spans) to the id, the bytes left, and what went."""
    for batch in (whole.slice(k, TEXTS) for whole in batches for k in range(0, whole.num_rows, TEXTS)):
        sizes, spans, kept = [], [], []
        for text, later, found in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            data = text.encode()
            runs = ([(0, len(data))] if len(data) >= WINDOW else []) if later else [(x["start"], x["stop"]) for x in found or []]
            edges = [0, *(x for run in runs for x in run), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            sizes.append(len(data))
            spans.append([{"start": a, "stop": b} for a, b in runs])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], [id_col, "n_bytes", "spans", "kept"])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Each row's id, n_bytes, the maximal removed spans (start, stop) in bytes, and the remaining bytes as `kept`."""
    spans, owners = _covered(docs, id_col, text_col, hot)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    owners, spans = owners.withColumnRenamed("md", "_md"), spans.withColumnsRenamed({"row": "_row", "id": "_id"})
    few = (spans.agg(F.sum(F.size("spans"))).first()[0] or 0) <= MOST_ROWS
    rows = texts.join(_small(owners), F.md5("text") == F.col("_md"), "left").join(F.broadcast(spans) if few else spans, (F.xxhash64("id", "text") == F.col("_row")) & F.col("id").eqNullSafe(F.col("_id")), "left")
    later = F.col("_md").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    schema = f"`{id_col}` long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"
    return rows.select("id", "text", later.alias("later"), "spans").mapInArrow(lambda it: _cut(it, id_col), schema)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
