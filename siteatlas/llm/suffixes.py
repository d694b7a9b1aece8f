"""Exact substring deduplication with suffix arrays.

A byte goes if it lies in a ``length``-byte string that also starts earlier (in a smaller document, or earlier in its own).

Which strings could repeat is decided first, without loss: every string has one *anchor*, the least k-gram inside it (in an order
that puts frequent k-grams last, so that what follows a very common line is told apart by its own bytes). Equal strings have equal
anchors, and every string holds its anchor with half of the remaining bytes on one side of it, so strings for which this longer
gram occurs once in the corpus cannot repeat. The rest is cut into *pieces*, the runs of strings with one anchor, and pieces
are dealt by anchor, so all equal strings meet. Pieces of the same bytes are merged before they are sent, the first stays.

A task reads its pieces in the order of (anchor, document, start) and makes shards of bounded size. A shard's suffix array is
built by Larsson-Sadakane refinement (sort by 8 bytes, then double the depth and sort only groups that are still equal), common
prefixes by Kasai's rule, and suffixes that share ``length`` bytes are one string: all but the first go. Where an anchor's
pieces fill more than one shard, the strings of the next shard are looked up by binary search in the sorted ones of those before.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteatlas.llm import bitmap, words
from siteatlas.session import persist_reliably

K = 32
SHARD_BYTES = 1 << 18
SEGMENT_BITS = 18
COUNT_BITS = 18  # the table of k-gram counts has 2^18 cells, whatever the data
_SLICES = 64
_CLASS = 4  # bits of the frequency class at the top of a k-gram's order
HOT_CLASS = 1  # of anchors that are common: in a cell with more than twice the mean count
BITMAP_BITS = 26
_MERGE_BYTES = 1 << 25


# ---- k-grams and anchors -----------------------------------------------------------------------------


def _segments(texts: pa.Array, length: int) -> Iterator[tuple[words.Texts, int]]:
    """Runs of texts of at most 2^SEGMENT_BITS bytes; longer texts in parts that share length - 1 bytes."""
    size = 1 << SEGMENT_BITS
    for batch in words.batches(texts, rows=1 << 16, size=size):
        if len(batch.data) <= size:
            yield batch, 0
            continue
        for base in range(0, len(batch.data) - length + 1, size - length + 1):
            part = batch.data[base : base + size]
            yield words.Texts(part, np.array([0, len(part)]), batch.first), base


def _grams_from(h: np.ndarray, low: np.ndarray | int, size: int) -> np.ndarray:
    """Hashes of the ``size`` bytes from ``low``, with the prefix hashes of the text; all of them if low is 0."""
    if isinstance(low, int):
        n = max(len(h) - size, 0)
        return (h[size : size + n] - h[:n]) * _inverses(n)
    return (h[low + size] - h[low]) * _inverses(len(h))[low]


_INVERSE_TABLE = np.empty(0, np.uint64)


def _inverses(n: int) -> np.ndarray:
    global _INVERSE_TABLE
    if n > len(_INVERSE_TABLE):
        _INVERSE_TABLE = words.inverse_power(np.arange(max(n, 1 << SEGMENT_BITS)))
    return _INVERSE_TABLE[:n]


def _runs(texts: words.Texts, classes: np.ndarray, length: int):
    """Runs of strings with one anchor: text, first start, number of starts, the anchor's hash, how many of the first strings hold the
    anchor with half of the rest on its left, and the hashes of this left gram and of the right one, which the others hold."""
    h = words.prefix_hash(texts.data)
    grams = _grams_from(h, 0, K)
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64), np.empty(0, np.int64)) + (np.empty(0, np.uint64),) * 2
    span = length - K + 1  # k-grams in a string
    n = len(grams) - span + 1
    if n <= 0:
        return none
    low = np.uint64(SEGMENT_BITS)
    order = classes[grams >> np.uint64(64 - COUNT_BITS)] << np.uint64(64 - _CLASS)
    order |= (grams >> (low + np.uint64(_CLASS))) << low
    order |= np.arange(len(grams) - 1, -1, -1, dtype=np.uint64)  # of equal ones the last
    reach = 1
    while 2 * reach <= span:
        order = np.minimum(order[:-reach], order[reach:])
        reach *= 2
    order = np.minimum(order[: n], order[span - reach : span - reach + n])
    count = np.maximum(np.diff(texts.offsets) - length + 1, 0)
    doc = np.repeat(np.arange(texts.n), count)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count - texts.offsets[:-1], count)
    at = len(grams) - 1 - (order[start] & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)
    if not len(at):
        return none
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
    doc, start, count, at = doc[new], start[new], np.diff(np.append(new, len(at))), at[new]
    half = (length - K) // 2
    left = np.clip(at - half - start + 1, 0, count)  # strings with at least half of the rest before the anchor
    last = len(texts.data) - (length - half)
    left_gram = words.mix(_grams_from(h, np.maximum(at - half, 0), K + half))
    right_gram = words.mix(_grams_from(h, np.minimum(at, last), length - half) + np.uint64(1))
    return doc, start, count, grams[at], left, left_gram, right_gram


def _counted(length: int):
    """Passes the narrow columns on and counts all k-grams in a table of fixed size, one per task."""
    names = ["id", "h", "whole", "n_bytes", "digest"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        for batch in batches:
            for texts, _ in _segments(batch.column(5), length):
                cell = (_grams_from(words.prefix_hash(texts.data), 0, K) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
                counts += np.bincount(cell, minlength=len(counts)).astype(np.uint32)
            n = batch.num_rows
            yield pa.record_batch([*batch.columns[:5], pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=[*names, "slice", "counts"])
        if counts.any():
            none = [pa.nulls(_SLICES, kind) for kind in (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())]
            parts = pa.array([p.tobytes() for p in np.split(counts, _SLICES)], pa.binary())
            yield pa.record_batch([*none, pa.array(range(_SLICES), pa.int32()), parts], names=[*names, "slice", "counts"])

    return over, "id long, h long, whole string, n_bytes long, digest string, slice int, counts binary"


def _summed(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()], axis=0, dtype=np.uint64)
    return pa.table({"slice": pa.array([table["slice"][0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _classes(rows: DataFrame) -> np.ndarray:
    parts = rows.filter("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(_summed, "slice int, counts binary")
    counts = np.zeros(1 << COUNT_BITS)
    step = len(counts) // _SLICES
    for row in parts.toArrow().to_pylist():
        counts[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(row["counts"], np.uint64)
    mean = max(1.0, counts.mean())
    return np.clip(np.floor(np.log2(np.maximum(counts, 1) / mean)), 0, (1 << _CLASS) - 1).astype(np.uint64)


_KEPT_BITS = 48  # of a gram's hash, when grams are counted


def _held_grams(classes, length: int, left_out=None):
    """The hashes of all left and right grams that strings hold, each at most twice a text. Texts whose key ``left_out`` may hold are passed over."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if left_out is not None:
                keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                batch = batch.filter(pa.array(~bitmap.contains(left_out.value, keys)))
            for texts, _ in _segments(batch.column(1), length):
                doc, _, count, _, left, left_gram, right_gram = _runs(texts, classes.value, length)
                some = np.concatenate([left > 0, left < count])
                grams, doc = np.concatenate([left_gram, right_gram])[some], np.concatenate([doc, doc])[some]
                order = np.lexsort((doc, grams))
                doc, grams = doc[order], grams[order]
                third = np.zeros(len(doc), bool)
                third[2:] = (doc[2:] == doc[:-2]) & (grams[2:] == grams[:-2])
                grams, counts = np.unique(grams[~third] >> np.uint64(64 - _KEPT_BITS), return_counts=True)
                yield pa.record_batch([grams.view(np.int64), counts], names=["gram", "n"])

    return over, "gram long, n long"


_PIECE = "anchor long, id long, h long, low long, high long, piece binary"


_WEIGHT = 190  # of a held piece beside its bytes: its entry and key in the table, and five numbers


class _Merged:
    """Distinct pieces with the place of each one's first; places of the others become removed ranges."""

    def __init__(self):
        self.at: dict[bytes, int] = {}
        self.places = [array("q") for _ in range(5)]  # id, h, low, high, anchor
        self.ranges = [array("q") for _ in range(4)]
        self.weight = 0

    def add(self, piece: bytes, this: tuple) -> None:
        n = len(self.at)
        at = self.at.setdefault(piece, n)
        if at == n:
            for column, value in zip(self.places, this, strict=True):
                column.append(value)
            self.weight += len(piece) + _WEIGHT
            return
        first = tuple(column[at] for column in self.places)
        if first == this:  # a repeated row
            return
        if this < first:
            for column, value in zip(self.places, this, strict=True):
                column[at] = value
            this = first
        i, h, low, high = self.ranges
        if i and i[-1] == this[0] and h[-1] == this[1] and high[-1] == this[2]:
            high[-1] = this[3]
            return
        for column, value in zip(self.ranges, this[:4], strict=True):
            column.append(value)
        self.weight += 32

    def rows(self) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "id", "h", "low", "high", "piece"]
        i, h, low, high, anchor = (np.array(column, np.int64) for column in self.places)
        yield pa.record_batch([anchor, i, h, low, high, pa.array(list(self.at), pa.binary())], names=names)
        i, h, low, high = (np.array(column, np.int64) for column in self.ranges)
        yield pa.record_batch([i ^ (h << 1), i, h, low, high, pa.nulls(len(i), pa.binary())], names=names)


def _pieces(classes, repeated, length: int):
    """Pieces with an anchor that may repeat; of equal ones the first goes on, the others are removed ranges.

    Pieces are dealt by their anchor. One whose anchor is common is cut in two, the strings that hold the left gram and those that hold the
    right one, and dealt by these: equal strings share them as well, and a common line's surroundings go to different tasks.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = _Merged()
        for batch in batches:
            ids, hs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for texts, base in _segments(batch.column(2), length):
                doc, start, count, anchor, left, left_gram, right_gram = _runs(texts, classes.value, length)
                low = np.where(bitmap.contains(repeated.value, left_gram), 0, left)
                high = np.where(bitmap.contains(repeated.value, right_gram), count, left)
                common = classes.value[anchor >> np.uint64(64 - COUNT_BITS)] >= HOT_CLASS
                key = np.where(common, np.where(high <= left, left_gram, right_gram), anchor)
                both = common & (low < left) & (left < high)
                cut = np.flatnonzero(both)
                doc, start, key = np.append(doc, doc[cut]), np.append(start, start[cut]), np.append(key, left_gram[cut])
                low, high = np.append(np.where(both, left, low), low[cut]), np.append(high, left[cut])
                start, count = start + low, high - low
                keep = np.flatnonzero(count > 0)
                keep = keep[np.lexsort((start[keep], doc[keep]))]
                raw = texts.data.tobytes() if len(keep) else b""
                in_text = start[keep] - texts.offsets[doc[keep]] + base
                rows = zip((doc[keep] + texts.first).tolist(), start[keep].tolist(), count[keep].tolist(), in_text.tolist(), key.view(np.int64)[keep].tolist(), strict=True)
                for row, at, n, low_, key_ in rows:
                    merged.add(raw[at : at + n + length - 1], (ids[row], hs[row], low_, low_ + n, key_))
                if merged.weight > _MERGE_BYTES:
                    yield from merged.rows()
                    merged = _Merged()
        yield from merged.rows()

    return over, _PIECE


# ---- suffix arrays -----------------------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes, sorted.

    Larsson-Sadakane: after sorting by h bytes, a suffix' rank is its group's first place, and groups that hold more than one suffix are sorted
    by the ranks of the suffixes h bytes on.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | padded[j : j + n]
    order = np.argsort(key)
    sorted_key = key[order]
    first = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]) if n else np.empty(0, bool)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = group
    h = 8
    while h < n:
        single = first & np.append(first[1:], True)
        place = np.flatnonzero(~single)
        if not len(place):
            break
        suffix = order[place]
        key = rank[suffix] * (n + 1) + rank[np.minimum(suffix + h, n)] + 1
        by = np.argsort(key)
        key, suffix = key[by], suffix[by]
        order[place] = suffix
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first[place] = new
        rank[suffix] = place[np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, ends: np.ndarray, cap: int) -> np.ndarray:
    """For every place of the suffix array the bytes, up to ``cap``, its suffix shares with the one before.

    Kasai's rule: what a suffix shares with its neighbour, less one byte, the next suffix of the text shares with its own. The rule runs along each
    of the texts ``starts`` to ``ends``, and along all of them at once.
    """
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(cap + 1, np.uint8)])
    now = np.zeros(len(starts), np.int64)
    live = np.arange(len(starts))
    step = 0
    while True:
        live = live[starts[live] + step < ends[live]]
        if not len(live):
            break
        i = starts[live] + step
        j = before[i]
        length = np.maximum(now[live] - 1, 0)
        length[j < 0] = 0
        going = np.flatnonzero(j >= 0)
        while len(going):
            a, b = i[going] + length[going], j[going] + length[going]
            more = (length[going] < cap) & (a < n) & (b < n) & (padded[np.minimum(a, n)] == padded[np.minimum(b, n)])
            going = going[more]
            length[going] += 1
        shared[i] = length
        now[live] = length
        step += 1
    return shared[order]


def _later(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the string at each byte repeats an earlier one, and the first places of the strings, sorted by their bytes."""
    order = suffix_array(text)
    shared = common_prefixes(text, order, starts, ends, length)
    whole = np.zeros(len(text) + 1, np.int64)  # only strings inside one piece count
    np.add.at(whole, starts, 1)
    np.add.at(whole, np.maximum(ends - length + 1, starts), -1)
    whole = np.cumsum(whole[:-1]) > 0
    group = np.cumsum(shared < length) - 1
    counted = whole[order]
    first = np.full(int(group[-1]) + 1 if len(group) else 0, len(text), np.int64)
    np.minimum.at(first, group[counted], order[counted])
    later = np.zeros(len(text), bool)
    later[order[counted]] = order[counted] != first[group[counted]]
    return later, first[first < len(text)]


def _removed(length: int):
    """Ranges of starts to remove, from pieces in the order of (anchor, id, h, low)."""

    def strings(text: np.ndarray, at: np.ndarray) -> np.ndarray:
        grid = np.ascontiguousarray(text[at[:, None] + np.arange(length)])
        return grid.view(f"V{length}").ravel() if len(at) else np.empty(0, f"V{length}")

    def known(runs: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
        """Binary search of strings in the sorted strings of the shards before. Bytes compare as big-endian words."""
        found = np.zeros(len(wanted), bool)
        for run in runs:
            found |= _search(run, wanted, length)
        return found

    def shard(held: list[tuple], carried: list[np.ndarray], carried_anchor, goes_on: bool):
        ends = np.cumsum([len(r[5]) for r in held])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        text = np.frombuffer(b"".join(r[5] for r in held), np.uint8)
        later, firsts = _later(text, starts, ends, length)
        anchors = np.array([r[0] for r in held])
        if carried:
            in_old = np.zeros(len(text), bool)
            for p in np.flatnonzero(anchors == carried_anchor):
                in_old[starts[p] : ends[p] - length + 1] = True
            at = np.flatnonzero(in_old & ~later)
            later[at] = known(carried, strings(text, at))
        flags = np.concatenate([later, [False]]).astype(np.int8)
        change = np.diff(flags, prepend=0)
        lows, highs = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        piece = np.searchsorted(ends, lows, side="right")
        out = [(held[p][1], held[p][2], held[p][3] + a - starts[p], held[p][3] + b - starts[p]) for p, a, b in zip(piece.tolist(), lows.tolist(), highs.tolist(), strict=True)]
        last = held[-1][0]
        if not goes_on:
            return out, [], None
        if last != carried_anchor:
            carried = []
        fresh = np.flatnonzero(anchors == last)
        mine = firsts[(firsts >= starts[fresh[0]]) & (firsts < ends[fresh[-1]])]
        mine = mine[~later[mine]] if carried else mine
        return out, [*carried, strings(text, mine)], last

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["id", "h", "low", "high"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, seen, size, carried, carried_anchor = [], [], {}, 0, [], None
        # held: pieces of anchors that have company, for the next shard; group, seen: the pieces of the anchor now read
        for batch in batches:
            passed = batch.filter(batch.column(5).is_null())
            if passed.num_rows:
                yield pa.record_batch(passed.columns[1:5], names=["id", "h", "low", "high"])
            again = []
            for row in zip(*(c.to_pylist() for c in batch.filter(batch.column(5).is_valid()).columns), strict=True):
                if group and group[-1][0] != row[0]:
                    if len(group) > 1 or group[0][0] == carried_anchor:
                        held += group
                    else:
                        size -= len(group[0][5])
                    group, seen = [], {}
                    if size > SHARD_BYTES and held:
                        out, carried, carried_anchor = shard(held, carried, carried_anchor, False)
                        yield rows(out)
                        held, size = [], 0
                first = seen.setdefault(row[5], row)
                if first is not row:
                    if first[1:4] != row[1:4]:  # else a repeated row
                        again.append(row[1:5])
                    continue
                group.append(row)
                size += len(row[5])
                if size > 4 * SHARD_BYTES:  # within one anchor's pieces
                    out, carried, carried_anchor = shard(held + group, carried, carried_anchor, True)
                    yield rows(out)
                    held, group, size, seen = [], [], 0, {}  # equal pieces of the next shard are found by search
            yield rows(again)
        if len(group) > 1 or group and group[0][0] == carried_anchor:
            held += group
        if held:
            yield rows(shard(held, carried, carried_anchor, False)[0])

    return over, "id long, h long, low long, high long"


def _search(run: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """Which of ``wanted`` are in the sorted ``run``: a binary search by 8 bytes at a time, on all of them at once."""
    if not len(run) or not len(wanted):
        return np.zeros(len(wanted), bool)
    width = -(-length // 8) * 8

    def split(x):
        grid = np.zeros((len(x), width), np.uint8)
        grid[:, :length] = x.view(np.uint8).reshape(len(x), length)
        return grid.view(">u8").astype(np.uint64)

    a, b = split(run), split(wanted)
    low, high = np.zeros(len(b), np.int64), np.full(len(b), len(a), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        x, y = a[middle], b[open_]
        differ = x != y
        at = differ.argmax(axis=1)
        less = differ.any(axis=1) & (np.take_along_axis(x, at[:, None], 1) < np.take_along_axis(y, at[:, None], 1))[:, 0]
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
    found = np.minimum(low, len(a) - 1)
    return (low < len(a)) & (a[found] == b).all(axis=1)


# ---- the operator --------------------------------------------------------------------------------------

_LAST = (1 << 63) - 1  # rows without an id come after all others


def _keys(id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")


def _narrow(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    i, h, text = _keys(id_col, text_col)
    columns = docs.select(i, h, F.md5(text).alias("whole"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest"), text)
    return persist_reliably(columns.mapInArrow(*_counted(length)))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> tuple[DataFrame, DataFrame]:
    """What each document loses: (narrow rows, spans).

    The narrow rows are (id, h, whole, n_bytes, digest, first): ids, a hash and digests of the text, and the first id with the
    very same text. Texts that have an earlier copy go as a whole if they have ``length`` bytes. ``spans`` is (id, h, spans): for
    documents that lose something otherwise, the maximal removed byte ranges [low, high).
    Null texts are empty. Rows without an id come last. Rows of equal id and text are one document; rows of equal id and
    different texts follow each other by a hash of the text. Only the id and text columns are read.
    """
    spark = docs.sparkSession
    words.bound_arrow_batches(spark)
    narrow = _narrow(docs, id_col, text_col, length)
    classes = spark.sparkContext.broadcast(_classes(narrow))
    narrow = narrow.filter("slice is null").drop("slice", "counts")
    first = narrow.groupBy("whole").agg(F.min(F.struct("id", "h")).alias("first"))
    firsts = first.select("first.*").distinct()

    texts = docs.select(*_keys(id_col, text_col))
    long = texts.filter(F.octet_length("text") >= length)
    # later copies of a text are not counted; only texts that may be such are joined. No stage of this runs two Python functions.
    copies = narrow.join(first, "whole").filter(F.struct("id", "h") != F.col("first")).select("id", "h")
    key = F.xxhash64("id", "h")
    members = bitmap.build(copies, key)
    sent = spark.sparkContext.broadcast(members)
    grams = long.select(key, "text").mapInArrow(*_held_grams(classes, length, sent))
    again = long.filter(bitmap.test(spark, members, key)).join(firsts.hint("merge"), ["id", "h"], "left_semi").select(key, "text")
    grams = grams.unionAll(again.mapInArrow(*_held_grams(classes, length))).groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1")
    repeated = spark.sparkContext.broadcast(bitmap.build(grams, F.shiftleft("gram", 64 - _KEPT_BITS), BITMAP_BITS))
    sent.destroy()

    pieces = long.mapInArrow(*_pieces(classes, repeated, length))
    dealt = pieces.repartition("anchor").sortWithinPartitions("anchor", "id", "h", "low")
    removed = dealt.mapInArrow(*_removed(length))
    spans = removed.distinct().groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("low", (F.col("high") + length - 1).alias("high")))).alias("spans"))
    merged = F.expr(
        """aggregate(slice(spans, 2, size(spans)), slice(spans, 1, 1), (done, s) -> CASE
            WHEN element_at(done, -1).high >= s.low THEN concat(slice(done, 1, size(done) - 1),
              array(named_struct('low', element_at(done, -1).low, 'high', greatest(element_at(done, -1).high, s.high))))
            ELSE concat(done, array(s)) END)"""
    )
    spans = persist_reliably(spans.select("id", "h", merged.alias("spans")))
    classes.destroy()
    repeated.destroy()
    return narrow.join(first, "whole"), spans


def _cut(data: bytes, spans) -> bytes:
    parts, at = [], 0
    for s in spans:
        parts.append(data[at : s["low"]])
        at = s["high"]
    return b"".join([*parts, data[at:]])


@F.arrow_udf(T.BinaryType())
def _kept(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, spans in texts:
        pairs = zip(text.to_pylist(), spans.to_pylist(), strict=True)
        yield pa.array([None if t is None else _cut(t.encode(), s or ()) for t, s in pairs], pa.binary())


def _maybe(spans: DataFrame, spark):
    """A test of the key for documents that lose bytes; others may pass it too."""
    key = F.xxhash64("id", "h")
    return bitmap.test(spark, bitmap.build(spans, key), key)


def kept_texts(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, spans, kept) of the documents that lose bytes; only texts that may be among them are shuffled."""
    texts = docs.select(*_keys(id_col, text_col)).filter(_maybe(spans, docs.sparkSession)).dropDuplicates(["id", "h"])
    return texts.join(spans, ["id", "h"]).select("id", "h", "spans", _kept("text", "spans").alias("kept"))


@F.arrow_udf(T.StringType())
def _kept_string(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, spans in texts:
        pairs = zip(text.to_pylist(), spans.to_pylist(), strict=True)
        yield pa.array([t if t is None or s is None else _cut(t.encode(), s).decode(errors="ignore") for t, s in pairs], pa.string())


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """``docs`` without the repeated bytes; a character that loses some of its bytes goes, and so do texts that lose all.

    Only texts that may lose something are shuffled. Rows keep all their columns.
    """
    narrow, spans = repeats(docs, id_col, text_col, length)
    copies = narrow.filter((F.struct("id", "h") != F.col("first")) & (F.col("n_bytes") >= length)).select("id", "h", "n_bytes").distinct()
    whole = copies.select("id", "h", F.array(F.struct(F.lit(0).cast("long").alias("low"), F.col("n_bytes").alias("high"))).alias("spans"))
    spans = persist_reliably(spans.join(copies, ["id", "h"], "left_anti").unionByName(whole))
    i, h, _ = _keys(id_col, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), i, h, F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("maybe", _maybe(spans, docs.sparkSession))
    # the join is a shuffle, so that the test and the cut are not two Python functions of one stage; the cut is not made again for the filter
    touched = rows.filter("maybe").join(spans.hint("merge"), ["id", "h"], "left").withColumn("kept", _kept_string.asNondeterministic()("text", "spans"))
    touched = touched.filter("spans is null or kept <> ''").withColumn("doc", F.col("doc").withField(text_col, F.col("kept")))
    return rows.filter("not maybe").select("doc.*").unionByName(touched.select("doc.*"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``."""
    narrow, spans = repeats(docs, id_col, text_col, length)
    changed = kept_texts(docs, spans, id_col, text_col).select(
        "id",
        "h",
        F.octet_length("kept").cast("long").alias("n_kept"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    out = narrow.join(changed, ["id", "h"], "left")
    copy = (F.struct("id", "h") != F.col("first")) & (F.col("n_bytes") >= length)
    return out.select(
        F.when(F.col("id") != _LAST, F.col("id")).alias(id_col),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_bytes") - F.coalesce("n_kept", "n_bytes")).alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS g FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM d WHERE len(x) >= 200)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM w),
r AS (SELECT doc_id, i, coalesce(i > max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 100, true) AS new FROM f WHERE nth > 1),
s AS (SELECT doc_id, min(i) AS low, max(i) + 100 AS high FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r) GROUP BY doc_id, run),
k AS (
  SELECT doc_id, d.x, s.low, s.high, lag(s.high, 1, 0) OVER (PARTITION BY doc_id ORDER BY s.low) AS since,
    row_number() OVER (PARTITION BY doc_id ORDER BY s.low DESC) = 1 AS last FROM s JOIN d USING (doc_id)),
c AS (
  SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed,
    string_agg(substr(x, 2 * since + 1, 2 * (low - since)) || CASE WHEN last THEN substr(x, 2 * high + 1) ELSE '' END, '' ORDER BY low) AS kept
  FROM k GROUP BY doc_id)
SELECT d.doc_id, (len(d.x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(c.kept, d.x))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""
