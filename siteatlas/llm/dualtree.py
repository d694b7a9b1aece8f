"""Ranked lexical search of many items at once by dual-tree search.

Documents become sparse vectors over the items' terms: a coordinate is the term's weight in the document, a whole number, and an item's
coordinates are the weights of its terms. A score is the product of the two. Both sides are put into trees whose nodes hold the largest
value of every coordinate below them, so the product of two nodes bounds every score between them. Where the bound stays below
the weakest kth score of the items of a node, all pairs of the two nodes are left out at once; nothing else is.

* One pass over the texts counts and keeps the vectors (a few bytes for each of the items' terms that a document holds), with the
  document frequencies as one more row per task.
* A task builds a tree over each shard of its vectors. In the first round every item opens only its best leaf of each shard, and the kth best of
  all scores found so is a lower bound for its kth best. The second round is the search, which starts with those bounds; a task sends
  its k best for each item.

Items are searched in blocks of at most ``BLOCK_TERMS`` terms, the only thing that is sent to tasks. Terms are taken as equal where their
64-bit hashes agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.llm import words
from siteatlas.session import persist_reliably

K = 50
BLOCK_TERMS = 1 << 15
SHARD = 4096  # documents, and
SHARD_ENTRIES = 1 << 20  # coordinates of one tree, about; and
SHARD_CELLS = 1 << 23  # numbers in its matrix of leaves by terms
LEAF = 4
FAN = 8
SEEDS = 10  # scores that a task sends for an item in the first round
_LAST = (1 << 63) - 1  # documents without an id come after all others


# ---- items ---------------------------------------------------------------------------------------------


def _item_terms():
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.batches(batch.column(1), rows=1 << 16):
                hashes, bounds = texts.word_hashes(words.ALNUM)
                item = batch.column(0).take(pa.array(words.owner(bounds) + texts.first))
                yield pa.record_batch([item, hashes.view(np.int64)], names=["item", "term"])

    return over


@dataclass(frozen=True)
class Node:
    """Some items, and the terms that any of them has."""

    items: np.ndarray
    terms: np.ndarray
    children: tuple[Node, ...]


def item_tree(terms: list[np.ndarray]) -> Node:
    """A tree over items given by their term numbers; items with the same common terms stand together."""
    count = np.bincount(np.concatenate(terms))
    common = np.argsort(-count, kind="stable")[:64]
    order = sorted(range(len(terms)), key=lambda i: (np.isin(common, terms[i], invert=True).tolist(), i))
    nodes = [Node(np.array([i]), terms[i], ()) for i in order]
    while len(nodes) > 1:
        groups = [nodes[at : at + FAN] for at in range(0, len(nodes), FAN)]
        nodes = [Node(np.concatenate([n.items for n in g]), np.unique(np.concatenate([n.terms for n in g])), tuple(g)) for g in groups]
    return nodes[0]


# ---- document vectors --------------------------------------------------------------------------------------


def _term_type(terms: int) -> type:
    return np.uint16 if terms <= 1 << 16 else np.uint32


def _vectors(vocabulary):
    """(id, n, terms, tfs) of documents that hold terms of the sorted vocabulary; and per task its counts: how many documents
    hold each term, then how many hold any term at all, and all terms."""
    names = ["id", "n", "terms", "tfs", "counts"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        counts = np.zeros(len(known) + 2, np.int64)
        for batch in batches:
            for texts in words.batches(batch.column(1), rows=1 << 16):
                hashes, bounds = texts.word_hashes(words.ALNUM)
                n = np.diff(bounds)
                counts[-2:] += (n > 0).sum(), len(hashes)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                key, tf = np.unique(words.owner(bounds)[hit] * len(known) + at[hit], return_counts=True)
                doc, term = key // len(known), (key % len(known)).astype(_term_type(len(known)))
                counts[:-2] += np.bincount(term, minlength=len(known))
                rows, first = np.unique(doc, return_index=True)
                ends = np.append(first, len(doc))[1:]
                terms = [term[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                tfs = [tf[a:b].astype(np.uint16 if tf[a:b].max() < 1 << 16 else np.int64).tobytes() for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                ids = batch.column(0).take(pa.array(rows + texts.first))
                yield pa.record_batch([ids, n[rows], pa.array(terms, pa.binary()), pa.array(tfs, pa.binary()), pa.nulls(len(rows), pa.binary())], names=names)
        if counts[-1]:
            yield pa.record_batch([*(pa.nulls(1, kind) for kind in (pa.int64(), pa.int64(), pa.binary(), pa.binary())), pa.array([counts.tobytes()], pa.binary())], names=names)

    return over, "id long, n long, terms binary, tfs binary, counts binary"


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.column(0).to_pylist():
            count = np.frombuffer(row, np.int64)
            some = np.flatnonzero(count)
            yield pa.record_batch([some.astype(np.int32), count[some]], names=["i", "n"])


# ---- trees over documents and the search -------------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """What tasks know of a block of items: term weights, document and term totals, each item's terms, the tree, and lower bounds for kth scores."""

    weights: np.ndarray
    documents: int
    terms: int
    items: list[np.ndarray]
    tree: Node
    floor: np.ndarray


class Shard:
    """A tree over some documents: coordinates by leaf and term, and for every level the largest coordinates and the smallest ids."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, terms: list[bytes], tfs: list[bytes], block: Block):
        self.width = len(block.weights)
        term = np.frombuffer(b"".join(terms), _term_type(self.width)).astype(np.int64)
        size = np.array([len(t) for t in terms]) // np.dtype(_term_type(self.width)).itemsize
        tf = np.concatenate([np.frombuffer(x, np.uint16 if len(x) == 2 * s else np.int64) for x, s in zip(tfs, size.tolist(), strict=True)]).astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), size)
        m = np.array([100 - 50 + 50 * a * block.documents // block.terms for a in n.tolist()], np.int64)
        value = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
        gain = block.weights[term] * value
        order = np.lexsort((ids, n))  # lengths decide how large coordinates can be, and how many there are
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        key = place[doc] // LEAF * self.width + term
        by = np.argsort(key, kind="stable")
        self.key, self.place, self.gain = key[by], place[doc][by], gain[by]
        self.ids = np.append(ids[order], np.full(-len(ids) % LEAF, _LAST))
        first = np.flatnonzero(np.append(True, self.key[1:] != self.key[:-1]))
        leaf = np.zeros((len(self.ids) // LEAF, self.width))
        leaf.ravel()[self.key[first]] = np.maximum.reduceat(self.gain, first)
        self.levels = [(leaf, self.ids.reshape(-1, LEAF).min(axis=1))]
        while len(self.levels[0][0]) > 1:
            most, least = self.levels[0]
            step = np.arange(0, len(most), FAN)
            self.levels.insert(0, (np.maximum.reduceat(most, step), np.minimum.reduceat(least, step)))

    def scores(self, leaves: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, id) of the documents of some leaves that hold any of the terms."""
        wanted = (leaves[:, None] * self.width + terms).ravel()
        low, high = np.searchsorted(self.key, wanted), np.searchsorted(self.key, wanted, side="right")
        count = high - low
        entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
        slot = np.repeat(np.arange(len(leaves)), len(terms)).repeat(count) * LEAF + self.place[entry] % LEAF
        score = np.zeros(len(leaves) * LEAF, np.int64)
        np.add.at(score, slot, self.gain[entry])
        some = np.flatnonzero(score > 0)
        return score[some], self.ids.reshape(-1, LEAF)[leaves].ravel()[some]


class Best:
    """The k best documents of each item so far, and what a further one must beat."""

    def __init__(self, block: Block, k: int):
        self.k = k
        self.score = [np.empty(0, np.int64) for _ in block.items]
        self.id = [np.empty(0, np.int64) for _ in block.items]
        self.worst = np.maximum(block.floor, 1)
        self.worst_id = np.full(len(block.items), _LAST)
        self.opened = 0

    def add(self, item: int, score: np.ndarray, ids: np.ndarray) -> None:
        able = score >= self.worst[item]
        score, ids = np.append(self.score[item], score[able]), np.append(self.id[item], ids[able])
        order = np.lexsort((ids, -score))[: self.k]
        self.score[item], self.id[item] = score[order], ids[order]
        if len(order) == self.k:
            self.worst[item], self.worst_id[item] = score[order[-1]], ids[order[-1]]

    def able(self, item: int, bound: np.ndarray, least: np.ndarray) -> np.ndarray:
        return (bound > self.worst[item]) | ((bound == self.worst[item]) & (least <= self.worst_id[item]))


def search(shard: Shard, block: Block, best: Best, leaves: int | None = None) -> None:
    """Enter the shard's documents into ``best``; with ``leaves``, only so many leaves of each item, those with the largest bounds."""

    def descend(node: Node, at: np.ndarray, level: int) -> None:
        most, least = shard.levels[level]
        bound = most[np.ix_(at, node.terms)].sum(axis=1)
        if not node.children:
            keep = best.able(node.items[0], bound, least[at])
        else:
            keep = bound >= best.worst[node.items].min()
        at, bound = at[keep], bound[keep]
        if not len(at):
            return
        if level + 1 < len(shard.levels):
            below = (at[:, None] * FAN + np.arange(FAN)).ravel()
            at, level = below[below < len(shard.levels[level + 1][0])], level + 1
        elif not node.children:
            open_(node.items[0], at, bound)
            return
        for child in node.children or (node,):
            descend(child, at, level)

    def open_(item: int, at: np.ndarray, bound: np.ndarray) -> None:
        order = np.argsort(-bound, kind="stable")
        at, bound, done, step = at[order], bound[order], 0, leaves or 4
        while done < len(at):
            part = slice(done, done + step)
            keep = best.able(item, bound[part], shard.levels[-1][1][at[part]])
            if not keep.any() and bound[done] < best.worst[item]:
                return
            if keep.any():
                best.add(item, *shard.scores(at[part][keep], block.items[item]))
                best.opened += int(keep.sum())
            if leaves:
                return
            done, step = done + step, step * 2

    descend(block.tree, np.array([0]), 0)


def _searched(block, k: int, leaves: int | None, send: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(block.value, k)
        held, entries = [], 0
        most = min(SHARD, max(1, SHARD_CELLS // len(block.value.weights)) * LEAF)

        def build():
            ids, n, terms, tfs = (pa.chunked_array([b.column(i) for b in held]) for i in range(4))
            ids = ids.combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)
            search(Shard(ids, n.to_numpy(), terms.to_pylist(), tfs.to_pylist(), block.value), block.value, best, leaves)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, min(most // 4, most - sum(b.num_rows for b in held)))
                at += part.num_rows
                held.append(part)
                entries += part.nbytes // 4
                if entries >= SHARD_ENTRIES or sum(b.num_rows for b in held) >= most:
                    build()
                    held, entries = [], 0
        if held:
            build()
        for item, (score, ids) in enumerate(zip(best.score, best.id, strict=True)):
            if len(score):
                yield pa.record_batch([np.full(len(score[:send]), item, np.int32), score[:send], ids[:send]], names=["item", "score", "id"])

    return over, "item int, score long, id long"


def _top(hits: DataFrame, k: int) -> DataFrame:
    """(item, hits): the k best of each item, first of 64 parts, then of all; a task has sent a fixed number at most."""
    best = F.slice(F.sort_array(F.collect_list("hit")), 1, k).alias("hits")
    hits = hits.select("item", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part"), F.struct((-F.col("score")).alias("less"), "id").alias("hit"))
    hits = hits.groupBy("item", "part").agg(best).select("item", F.explode("hits").alias("hit"))
    return hits.groupBy("item").agg(best)


def _block(texts: DataFrame, rows: list, k: int) -> DataFrame:
    """(item: place in ``rows``, hits) for items with their term hashes."""
    spark = texts.sparkSession
    hashes = [np.array(row["terms"], np.int64).view(np.uint64) for row in rows]
    known = np.unique(np.concatenate(hashes))
    vocabulary = spark.sparkContext.broadcast(known)
    vectors = persist_reliably(texts.mapInArrow(*_vectors(vocabulary)))
    vocabulary.unpersist()
    counts = vectors.filter("counts is not null").select("counts").mapInArrow(_spread, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(known) + 2, np.int64)
    total[counts["i"].to_numpy()] = counts["n"].to_numpy()
    documents, terms = int(total[-2]), int(total[-1])
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in total[:-2].tolist()], np.int64)
    items = [np.searchsorted(known, h) for h in map(np.sort, hashes)]
    block = Block(weights, documents, terms, items, item_tree(items), np.zeros(len(items), np.int64))
    vectors = vectors.filter("counts is null").select("id", "n", "terms", "tfs")

    sent = spark.sparkContext.broadcast(block)
    seeds = _top(vectors.mapInArrow(*_searched(sent, k, 1, SEEDS)), k).filter(F.size("hits") == k).select("item", (-F.col("hits")[k - 1]["less"]).alias("floor"))
    for row in seeds.toArrow().to_pylist():  # a number for each item of the block
        block.floor[row["item"]] = row["floor"]
    sent.unpersist()
    return _top(vectors.mapInArrow(*_searched(spark.sparkContext.broadcast(block), k, None, k)), k)


def rank(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """(item_col, rank, id_col, score): for each item its k documents of the highest scores above 0, ties by ascending id.

    Terms are maximal runs of ASCII letters, digits and non-ASCII bytes, A-Z folded; null texts have none. Rows of one item id are one item with the
    terms of all its rows, rows without an item id one too. Every row of ``docs`` is a document of its own, also repeated ones;
    documents without an id come last among equal scores and keep their null. Items without terms or hits have no rows, nor
    do empty tables. Other columns are not read.
    """
    spark = docs.sparkSession
    words.bound_arrow_batches(spark)
    item_type = items.schema[item_col].dataType
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    terms = asked.mapInArrow(_item_terms(), f"item {item_type.simpleString()}, term long")
    asked = persist_reliably(terms.groupBy("item").agg(F.collect_set("term").alias("terms")))
    blocks = math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = spark.createDataFrame([], f"{item_col} {item_type.simpleString()}, rank int, {id_col} long, score long")
    for number in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).orderBy("item").collect()  # about block_terms terms
        if not rows:
            continue
        names = spark.createDataFrame([(at, row["item"]) for at, row in enumerate(rows)], f"item int, name {item_type.simpleString()}")
        found = _block(texts, rows, k).join(names, "item").select("name", F.posexplode("hits").alias("pos", "hit"))
        found = found.select(
            F.col("name").alias(item_col),
            (F.col("pos") + 1).cast("int").alias("rank"),
            F.when(F.col("hit.id") != _LAST, F.col("hit.id")).alias(id_col),
            (-F.col("hit.less")).alias("score"),
        )
        out = found if number == 0 else out.unionByName(found)
    return out


ORACLE = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
p AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY term, docs),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (doc_id), c GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""
