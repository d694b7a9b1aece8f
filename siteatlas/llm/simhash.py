"""Near duplicates by SimHash fingerprints, joined in the space of their segments' bit counts.

A fingerprint is cut into 32 segments of 2 bits; the number of set bits of each is one coordinate. Two fingerprints differ in at least
as many bits as the Manhattan distance of their coordinates. In thermometer code (a count of c is c ones) a point's coordinates fill
64 bits again, and the Manhattan distance is the number of bits in which two codes differ.

The grid has six groups of coordinates. Points within distance three agree in at least three groups, so the 20 choices of three groups are
20 grids, and any two points in reach share a cell of one of them. Points are dealt by cell and sorted by code; in a cell each is
compared with the ``WINDOW`` points after it, first by the Manhattan distance, then by the fingerprints. Cells that hold no more
points are done with that.

Larger cells (families of near copies) are dealt and compared in the same way by their parts, which links most of a family. What is left there are
pairs of different components, found without comparing all: of two fingerprints within three bits, one has a neighbour by one bit that
the other has by two. Every point of such a cell sends its 65 neighbours by up to one bit, those outside the cell's
largest component also their 2081 by up to two, and where they meet there is a link. Rows grow with the number of points, not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteatlas.llm import graph, words
from siteatlas.session import persist_reliably

REACH = 3
SEED = 42
WINDOW = 2048
#: Bits of the coordinates in each group: 6, 5, 5, 5, 5 and 6 segments.
_GROUPS = (12, 10, 10, 10, 10, 12)
_CHUNK = 1 << 15  # shingles whose bits are counted at once
_HITS = 1 << 18

_edges = np.concatenate([[0], np.cumsum(_GROUPS)]).tolist()
_MASKS = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(_edges[:-1], _edges[1:], strict=True)]
#: A grid is the coordinates of three groups; two points within three bits agree in one of them.
GRIDS = [_MASKS[a] | _MASKS[b] | _MASKS[c] for a, b, c in combinations(range(len(_MASKS)), len(_MASKS) - REACH)]
_LOW_BITS = 0x5555555555555555


# ---- fingerprints ------------------------------------------------------------------------------------


def _fingerprints(k: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for texts in words.batches(batch.column(1), rows=1 << 16):
                out[texts.first : texts.first + texts.n] = fingerprints(texts, k)
            yield pa.record_batch([batch.column(0), out.view(np.int64)], names=["id", "fp"])

    return over, "id long, fp long"


def fingerprints(texts: words.Texts, k: int = 3) -> np.ndarray:
    """The fingerprint of every text: a bit is set if more than half of the shingles' hashes have it."""
    starts, ends, bounds = texts.words(words.NOT_SPACE)
    # the words again, each followed by one space
    size = ends - starts + 1
    to = np.cumsum(size) - size
    line = np.full(int(size.sum()), 32, np.uint8)
    inside = np.flatnonzero(_covered(starts, ends, len(texts.data)))
    line[inside + np.repeat(to - starts, size - 1)] = words.FOLD[texts.data[inside]]
    raw = line.tobytes()
    count = np.diff(bounds)
    shingles = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(texts.n), shingles)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(shingles) - shingles - bounds[:-1], shingles)
    last = np.minimum(first + k, bounds[doc + 1]) - 1
    low, high = to[first], to[last] + size[last] - 1
    ones = np.zeros((texts.n, 64), np.int64)
    for at in range(0, len(doc), _CHUNK):
        part = slice(at, at + _CHUNK)
        hashes = [xxhash.xxh64_intdigest(raw[a:b], SEED) for a, b in zip(low[part].tolist(), high[part].tolist(), strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        of, begin = np.unique(doc[part], return_index=True)
        ones[of] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    set_ = 2 * ones > shingles[:, None]
    return np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).astype(bool)


# ---- the embedding and its grids ---------------------------------------------------------------------------


def code(fp: np.ndarray) -> np.ndarray:
    """The counts of all segments in thermometer code."""
    one = np.uint64(1)
    low = np.uint64(_LOW_BITS)
    return ((fp | fp >> one) & low) | (fp & fp >> one & low) << one


def _code(fp: str) -> Column:
    """The same as a column."""
    above = F.shiftrightunsigned(fp, 1)
    low = F.lit(_LOW_BITS)
    return F.col(fp).bitwiseOR(above).bitwiseAND(low).bitwiseOR(F.shiftleft(F.col(fp).bitwiseAND(above).bitwiseAND(low), 1))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _cells(points: DataFrame) -> DataFrame:
    """(cell, fp): every point in its cell of all grids. Cells are hashes; if two fell together, more would be compared and nothing lost."""
    keys = [F.xxhash64(F.col("code").bitwiseAND(F.lit(_signed(mask)).cast("long")), F.lit(n)) for n, mask in enumerate(GRIDS)]
    return points.withColumn("code", _code("fp")).select(F.explode(F.array(*keys)).alias("cell"), "fp")


# ---- comparing ---------------------------------------------------------------------------------------------


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as stars: every node of a component with the component's first."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, new[x])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _linked(cell: np.ndarray, fp: np.ndarray, old: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between each point and the ``window`` after it in its cell, but for pairs of the first ``old`` points."""
    codes = code(fp)
    left, right, held = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], 0
    at = np.arange(len(fp) - 1)
    for step in range(1, window + 1):
        at = at[at + step < len(fp)]
        at = at[cell[at] == cell[at + step]]
        if not len(at):
            break
        i = at[at + step >= old] if old else at
        i = i[np.bitwise_count(codes[i] ^ codes[i + step]) <= REACH]
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= REACH]
        left.append(fp[i])
        right.append(fp[i + step])
        held += len(i)
        if held > _HITS:
            a, b = _stars(np.concatenate(left), np.concatenate(right))
            left, right, held = [a], [b], 0
    return _stars(np.concatenate(left), np.concatenate(right))


def _compare(window: int):
    """Links of points that come sorted by cell and code. A batch leaves its last ``window`` points to the next one."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            old = len(cell)
            cell = np.concatenate([cell, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            a, b = _linked(cell, fp, old, window)
            yield pa.record_batch([a.view(np.int64), b.view(np.int64)], names=["a", "b"])
            last = np.flatnonzero(cell == cell[-1])[-window:] if len(cell) else slice(0)
            cell, fp = cell[last], fp[last]

    return over, "a long, b long"


# ---- neighbours by flipped bits ------------------------------------------------------------------------------


def _flips(bits: int) -> np.ndarray:
    """All masks of up to so many bits."""
    return np.array([sum(1 << b for b in some) for n in range(bits + 1) for some in combinations(range(64), n)], np.uint64)


def _neighbours():
    """(at, fp, comp, near) from (fp, comp, outside): neighbours by up to one bit (near), for points outside also by two."""
    one, two = _flips(1), _flips(2)[65:]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, comp = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            outside = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False))
            for rows, masks in ((np.arange(len(fp)), one), (outside, two)):
                step = max(1, (1 << 18) // len(masks))
                for low in range(0, len(rows), step):
                    some = rows[low : low + step]
                    at = (fp[some][:, None] ^ masks).ravel()
                    yield pa.record_batch([at.view(np.int64), np.repeat(comp[some], len(masks)), np.full(len(at), masks is one)], names=["at", "comp", "near"])

    return over, "at long, comp long, near boolean"


def _rest(crowded: DataFrame, points: DataFrame, settled: DataFrame) -> DataFrame:
    """Links (a, b) that large cells still miss, as links between components. ``crowded``: (cell, fp) of large cells."""
    of = points.join(settled.withColumnRenamed("id", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("comp"))
    crowded = persist_reliably(crowded.join(of, "fp").select("cell", "fp", "comp"))
    share = crowded.groupBy("cell", "comp").agg(F.count("*").alias("n"))
    main = share.groupBy("cell").agg(F.max(F.struct("n", "comp")).alias("main"), F.count("*").alias("parts"))
    main = main.filter("parts > 1").select("cell", F.col("main.comp").alias("main"))  # a cell of one component is done
    asks = crowded.join(main, "cell").groupBy("fp", "comp").agg(F.max(F.col("comp") != F.col("main")).alias("outside"))
    sent = asks.mapInArrow(*_neighbours())
    # at a neighbour, all components that reach it are linked if one does so by one bit
    met = sent.groupBy("at", "comp").agg(F.max("near").alias("near"))
    met = persist_reliably(met)
    centre = met.groupBy("at").agg(F.min(F.when(F.col("near"), F.col("comp"))).alias("a"), F.count("*").alias("comps"))
    return met.join(centre.filter("comps > 1 and a is not null"), "at").filter("comp <> a").select("a", F.col("comp").alias("b")).distinct()


# ---- the operator --------------------------------------------------------------------------------------------


def links(points: DataFrame, window: int = WINDOW) -> DataFrame:
    """(a, b: long) links that make the components of the distinct fingerprints ``points`` (fp: long) within ``REACH`` bits."""
    cells = _cells(points)
    crowded = cells.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > window + 1).select("cell")
    crowded = persist_reliably(crowded)
    some = not crowded.isEmpty()
    part = F.lit(0)
    if some:  # parts by the last two groups of coordinates; cells that the grid already split so fall into few parts
        cells = persist_reliably(cells.join(crowded.withColumn("large", F.lit(True)), "cell", "left"))
        part = F.when(F.col("large"), F.xxhash64(_code("fp").bitwiseAND(F.lit(_signed(_MASKS[-1] | _MASKS[0])).cast("long"))) % 64).otherwise(0)
    dealt = cells.withColumn("part", part).repartition("cell", "part").sortWithinPartitions("cell", "part", _code("fp"), "fp")
    found = persist_reliably(dealt.select("cell", "fp").mapInArrow(*_compare(window)).distinct())
    if not some:
        return found
    settled = graph.components(found)
    more = _rest(cells.filter("large").select("cell", "fp"), points, settled)
    return settled.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(more)


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, window: int = WINDOW) -> DataFrame:
    """(id_col, fingerprint, component_id), a row for every row of ``docs``.

    Words are split at ASCII white space, A-Z folded; shingles are ``k`` words joined by a space, repeats included, the whole text if it has
    fewer. Null texts and texts without words have fingerprint zero, which is linked like any other. The component is the smallest id
    reachable over fingerprints that differ in up to ``REACH`` bits; ids of repeated rows, also with different texts, are rows like
    others; rows without an id have a component only if a row with one is linked. Only the id and text columns are read, the text once.
    """
    words.bound_arrow_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = persist_reliably(texts.mapInArrow(*_fingerprints(k)))
    points = persist_reliably(rows.groupBy("fp").agg(F.min("id").alias("least")))
    found = graph.components(links(points.select("fp"), window)).withColumnRenamed("id", "fp")
    whole = points.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    of = whole.join(least, "component").select("fp", "component_id")
    out = rows.join(of, "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
