"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, shard results merged.

Vectors are dealt to shards of bounded size by a hash of their id. A shard's graph is one row: vectors, ids and, per layer, one
flat array of neighbour numbers with a fixed width. Shards are put together in bundles, and a task reads the graphs of a bundle once for
all its queries. A query searches the graph of the shard its own id is dealt to, by a beam search that runs for many queries in lock step. To every
other shard it is compared by a matrix product that leaves only what is nearer than its kth place so far: at 4096 vectors a product takes
a fiftieth of a search's time and misses nothing. The query's own bundle goes first and gives the bound for all others; the bundles' answers are merged by two aggregates.

Equal vectors of a shard are one node with all their ids, so a vector that fills a shard costs no links and hides no other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from siteatlas.session import bound_arrow_batches, persist_reliably

SHARD = 4096  # vectors in a shard, about
M = 16  # links of a node in the upper layers; twice as many in the lowest
EF_BUILD = 64
EF_SEARCH = 96
QUERY_BLOCK = 512  # queries that meet a shard in one product
BUNDLE = 64 << 20  # bytes of graphs that a task keeps, about
BUNDLES = 4  # bundles for a core at least, as far as there are shards
_BLOCK = 256


# ---- one graph -----------------------------------------------------------------------------------------


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all of y."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0)


def _diverse(x: np.ndarray, q: np.ndarray, ids: np.ndarray, dist: np.ndarray, m: int) -> np.ndarray:
    """The linking rule: of candidates sorted by distance, those nearer to q than to any one taken before, filled up with the nearest others.

    ids: (b, c) with -1 for none; returns (b, m), -1 for none.
    """
    b, c = ids.shape
    near = x[np.maximum(ids, 0)]
    norm = (near * near).sum(2)
    between = norm[:, :, None] + norm[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
    taken = np.zeros((b, c), bool)
    count = np.zeros(b, np.int64)
    for j in range(c):
        blocked = (taken & (between[:, j, :] < dist[:, j, None])).any(1)
        taken[:, j] = (ids[:, j] >= 0) & ~blocked & (count < m)
        count += taken[:, j]
        if (count >= m).all():
            break
    rank = np.where(taken, 0, np.where(ids >= 0, 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, axis=1)[:, :m]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)


def _layer(x: np.ndarray, nodes: np.ndarray, m: int) -> np.ndarray:
    """Neighbour numbers (len(nodes), m): every node is linked, in the order of insertion, with near ones inserted before, and these with it.

    A shard is small enough to take the candidates from exact distances instead of a search.
    """
    n = len(nodes)
    local = x[nodes]
    forward = np.full((n, m), -1, np.int64)
    for low in range(0, n, _BLOCK):
        high = min(n, low + _BLOCK)
        d = _distances(local[low:high], local[:high])
        d[np.arange(high)[None, :] >= np.arange(low, high)[:, None]] = np.inf
        c = min(EF_BUILD, high)
        ids = np.argpartition(d, c - 1, axis=1)[:, :c]
        dist = np.take_along_axis(d, ids, 1)
        order = np.argsort(dist, axis=1)
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        ids[np.isinf(dist)] = -1
        forward[low:high] = _diverse(local, local[low:high], ids, dist, max(m // 2, 1))[:, :m] if m == 1 else np.pad(
            _diverse(local, local[low:high], ids, dist, m // 2), ((0, 0), (0, m - m // 2)), constant_values=-1
        )
    a, b = np.repeat(np.arange(n), m), forward.ravel()
    a, b = a[b >= 0], b[b >= 0]
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    dist = ((local[source] - local[target]) ** 2).sum(1)
    order = np.lexsort((dist, source))
    source, target, dist = source[order], target[order], dist[order]
    start = np.searchsorted(source, np.arange(n + 1))
    out = np.full((n, m), -1, np.int64)
    width = np.diff(start)
    for low in range(0, n, _BLOCK):
        rows = np.arange(low, min(n, low + _BLOCK))
        c = int(min(width[rows].max(initial=0), 4 * m))
        if not c:
            continue
        at = start[rows][:, None] + np.arange(c)
        inside = np.arange(c) < width[rows][:, None]
        at = np.where(inside, at, 0)
        ids = np.where(inside, target[at], -1)
        out[rows] = _diverse(local, local[rows], ids, np.where(inside, dist[at], np.inf), m)
    return np.where(out >= 0, nodes[np.maximum(out, 0)], -1).astype(np.int32)


def build(x: np.ndarray, seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the lowest: (node numbers, neighbour numbers). Nodes are inserted in the order of their levels' draw."""
    n = len(x)
    draw = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - draw.random(n)) / math.log(M)).astype(np.int64)
    order = draw.permutation(n)
    layers = []
    for at in range(int(level.max(initial=0)) + 1):
        nodes = order[level[order] >= at]
        if len(nodes):
            layers.append((nodes, _layer(x.astype(np.float32), nodes, 2 * M if at == 0 else M)))
    return layers


def _beam(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search in one layer for all queries. links: (nodes of the shard, width). Returns ids (q, ef) by distance, -1 for none."""
    q, n = len(queries), len(x)
    rows = np.arange(q)[:, None]
    ids = np.full((q, ef), -1, np.int64)
    dist = np.full((q, ef), np.inf, np.float32)
    done = np.ones((q, ef), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = ((x[entry] - queries) ** 2).sum(1)
    seen = np.zeros((q, n), bool)
    seen[rows[:, 0], entry] = True
    mark = np.empty((q, n), np.int32)
    ahead = 4 if ef >= 16 else 1
    while True:
        waiting = np.where(done, np.inf, dist)
        live = np.flatnonzero(np.isfinite(waiting).any(1))
        if not len(live):
            break
        w = waiting[live]
        pick = np.argpartition(w, min(ahead, ef) - 1, axis=1)[:, :ahead] if ef > ahead else np.argsort(w, axis=1)[:, :ahead]
        ready = np.isfinite(np.take_along_axis(w, pick, 1))
        from_ = np.where(ready, ids[live[:, None], pick], -1)
        done[live[:, None], pick] = True
        near = np.where(from_[:, :, None] >= 0, links[np.maximum(from_, 0)], -1).reshape(len(live), -1)
        column = np.arange(near.shape[1])
        r = np.broadcast_to(live[:, None], near.shape)
        fresh = (near >= 0) & ~seen[r, np.maximum(near, 0)]
        fr, fc = np.nonzero(fresh)
        node = near[fr, fc]
        mark[live[fr], node] = column[fc]  # of several links to a node the last counts
        once = mark[live[fr], node] == column[fc]
        fr, fc, node = fr[once], fc[once], node[once]
        seen[live[fr], node] = True
        new = np.full(near.shape, np.inf, np.float32)
        new[fr, fc] = ((x[node] - queries[live[fr]]) ** 2).sum(1)
        all_ids = np.concatenate([ids[live], np.where(np.isfinite(new), near, -1)], axis=1)
        all_dist = np.concatenate([dist[live], new], axis=1)
        all_done = np.concatenate([done[live], ~np.isfinite(new)], axis=1)
        keep = np.argpartition(all_dist, ef - 1, axis=1)[:, :ef]
        ids[live], dist[live], done[live] = (np.take_along_axis(v, keep, 1) for v in (all_ids, all_dist, all_done))
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)


def search(x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, ef: int) -> np.ndarray:
    """Nearest nodes of every query found, (q, ef), nearest first, -1 for none."""
    x32, q32 = x.astype(np.float32), queries.astype(np.float32)
    entry = np.full(len(queries), layers[-1][0][0])
    for nodes, neighbours in reversed(layers[1:]):
        entry = _beam(x32, _spread(nodes, neighbours, len(x)), q32, entry, 1)[0][:, 0]
    return _beam(x32, _spread(*layers[0], len(x)), q32, entry, ef)[0]


def _spread(nodes: np.ndarray, neighbours: np.ndarray, n: int) -> np.ndarray:
    out = np.full((n, neighbours.shape[1]), -1, np.int32)
    out[nodes] = neighbours
    return out


# ---- the index as a table --------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def _graph(table: pa.Table) -> pa.Table:
    """One shard's row."""
    ids = table["id"].to_numpy()
    dim = table["dim"][0].as_py()
    x = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), dim)
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    nodes, place = np.unique(x, axis=0, return_inverse=True)  # equal vectors are one node
    place = place.ravel()
    by_node = np.argsort(place, kind="stable")  # ids of a node stay sorted
    starts = np.searchsorted(place[by_node], np.arange(len(nodes) + 1))
    layers = build(nodes, int(table["shard"][0].as_py()))
    single = table.schema.field("vector").type.value_type == pa.float32()
    row = {
        "shard": table["shard"][0].as_py(),
        "dim": dim,
        "single": single,
        "vectors": nodes.astype(np.float32 if single else np.float64).tobytes(),
        "ids": ids[by_node].astype(np.int64).tobytes(),
        "starts": starts.astype(np.int64).tobytes(),
        "layers": [{"nodes": a.astype(np.int32).tobytes(), "neighbours": b.astype(np.int32).tobytes(), "width": b.shape[1]} for a, b in layers],
    }
    return pa.Table.from_pylist([row], _INDEX)


_INDEX = pa.schema(
    [
        ("shard", pa.int64()),
        ("dim", pa.int32()),
        ("single", pa.bool_()),
        ("vectors", pa.binary()),
        ("ids", pa.binary()),
        ("starts", pa.binary()),
        ("layers", pa.list_(pa.struct([("nodes", pa.binary()), ("neighbours", pa.binary()), ("width", pa.int32())]))),
    ]
)
_INDEX_SQL = "shard long, dim int, single boolean, vectors binary, ids binary, starts binary, layers array<struct<nodes:binary,neighbours:binary,width:int>>"


def _usable_rows(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, vector) of every row with an id and a usable vector; numbers of single precision stay as they are."""
    vector, kind = F.col(vector_col), rows.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    return rows.filter(F.col(id_col).isNotNull() & usable(vector)).select(
        F.col(id_col).cast("long").alias("id"), F.size(vector).alias("dim"), vector.cast("array<float>" if single else "array<double>").alias("vector")
    )


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, vector) of every usable vector, one row per id and number of dimensions: the smallest by its components."""
    # reduced where the rows are read, so an id of any number of rows is one row before shards are dealt
    return _usable_rows(rows, id_col, vector_col).groupBy("id", "dim").agg(F.min("vector").alias("vector"))


def index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """The graphs, one row per shard and number of dimensions, over every usable vector.

    Null, zero and non-finite vectors, and rows without an id, take no part. Of rows with one id and number of dimensions one counts, the smallest by its components.
    The rows are read twice, the first time to count ids only, so that no copy of the vectors stays on disk beside the graphs.
    """
    bound_arrow_batches(rows.sparkSession)
    shards = max(1, -(-_usable_rows(rows, id_col, vector_col).select("id", "dim").distinct().count() // shard))
    dealt = _vectors(rows, id_col, vector_col).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    return persist_reliably(dealt.groupBy("shard", "dim").applyInArrow(_graph, _INDEX_SQL))


_ROOM: dict[type, np.ndarray] = {}  # memory for products, used again by all of a worker's


def _room(kind: type, rows: int, columns: int) -> np.ndarray:
    if kind not in _ROOM or len(_ROOM[kind]) < rows * columns:
        _ROOM[kind] = np.empty(rows * columns, kind)
    return _ROOM[kind][: rows * columns].reshape(rows, columns)


class _Shard:
    """A shard's graph as its row holds it, and its vectors ready for products."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        value = lambda name: batch.column(batch.schema.get_field_index(name))[at]
        buffer = lambda scalar, kind: np.frombuffer(scalar.as_buffer(), kind)
        self.shard, self.dim = value("shard").as_py(), value("dim").as_py()
        self.vectors = buffer(value("vectors"), np.float32 if value("single").as_py() else np.float64).reshape(-1, self.dim)
        self.ids, self.starts = buffer(value("ids"), np.int64), buffer(value("starts"), np.int64)
        self.layers = [(buffer(v["nodes"], np.int32), buffer(v["neighbours"], np.int32).reshape(-1, v["width"].as_py())) for v in value("layers")]
        self.middle = self.vectors.mean(0, dtype=np.float64)
        self.scale = float(np.sqrt(((self.vectors - self.middle) ** 2).sum(1).max())) or 1.0
        self.factors = self._factors().astype(np.float32)

    def _factors(self) -> np.ndarray:
        """Vectors around the shard's middle, none longer than 1, and minus half their squared length."""
        x = (self.vectors - self.middle) / self.scale
        return np.concatenate([x, -0.5 * (x * x).sum(1)[:, None]], axis=1)

    def nearer(self, queries: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes that may be as near as ``bound``, or for a query without a bound among its ``k`` nearest.

        |q - x|^2 = |q|^2 - 2 (q x - |x|^2 / 2); the product's rounding is allowed for, so no node is missed.
        """
        q = (queries - self.middle) / self.scale
        length = (q * q).sum(1)
        kind, factors = (np.float32, self.factors) if np.sqrt(length.max()) < 1e15 else (np.float64, self._factors())
        product = np.matmul(np.concatenate([q, np.ones((len(q), 1))], axis=1).astype(kind), factors.T, out=_room(kind, len(q), len(factors)))
        limit = (bound / self.scale) ** 2
        open_ = np.isinf(limit)
        slack = (self.dim + 8) * np.finfo(kind).eps * (np.sqrt(length) + 1) + 1e-14 * (length + np.where(open_, 0, limit))
        least = (length - limit) / 2 - slack
        if open_.any() and k < len(factors):
            least[open_] = np.partition(product[open_], len(factors) - k, axis=1)[:, len(factors) - k] - 2 * slack[open_]
        least = np.nextafter(least.astype(kind), kind(-np.inf))
        some = np.flatnonzero(~(product.max(1) < least))
        row, node = np.divmod(np.flatnonzero(~(product[some] < least[some, None])), len(factors))
        return some[row], node


class _Places:
    """The k nearest found so far of some queries, as (query, score, id) in order."""

    def __init__(self, q_ids: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int):
        self.q_ids, self.queries, self.bound, self.k = q_ids, queries, bound, k
        self.q, self.score, self.vec = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def take(self, q: np.ndarray, node: np.ndarray, shard: _Shard) -> None:
        """Put the ids of nodes in, without the query's own."""
        k, score = self.k, np.sqrt(((shard.vectors[node] - self.queries[q]) ** 2).sum(1))
        near = score <= self.bound[q]
        q, node, score = q[near], node[near], score[near]
        width = np.minimum(np.diff(shard.starts)[node], k + 1)  # no more of equal vectors than can be wanted
        q, score, first = np.repeat(q, width), np.repeat(score, width), np.repeat(shard.starts[node], width)
        vec = shard.ids[first + np.arange(len(first)) - np.repeat(np.cumsum(width) - width, width)]
        other = vec != self.q_ids[q]
        if not other.any():
            return
        q, score, vec = (np.concatenate([a, b[other]]) for a, b in ((self.q, q), (self.score, score), (self.vec, vec)))
        order = np.lexsort((vec, score, q))
        q, score, vec = q[order], score[order], vec[order]
        place = np.arange(len(q)) - np.searchsorted(q, np.arange(len(self.q_ids)))[q]
        self.bound[q[place == k - 1]] = score[place == k - 1]
        best = place < k
        self.q, self.score, self.vec = q[best], score[best], vec[best]


def _nearest_of(shards: list[_Shard], q_ids: np.ndarray, queries: np.ndarray, home: np.ndarray, bound: np.ndarray, k: int, ef: int) -> _Places:
    """Of the vectors of all ``shards`` that are no farther than ``bound``; home: the shard whose graph a query searches."""
    places = _Places(q_ids, queries, bound, k)
    for shard in shards:
        own = np.flatnonzero(home == shard.shard)
        if len(own):
            found = search(shard.vectors, shard.layers, queries[own], ef)
            q, at = np.nonzero(found >= 0)
            places.take(own[q], found[q, at], shard)
    for shard in shards:
        other = np.flatnonzero(home != shard.shard)
        if len(other):
            q, node = shard.nearer(queries[other], places.bound[other], k + 1)  # the query's own id may be one
            places.take(other[q], node, shard)
    return places


_GRAPHS = -1  # the home of rows that are graphs, so that they come before the queries of their bundle


def _searched(k: int, ef: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shards = None, []
        for batch in batches:
            bundle, home = batch.column("bundle").to_numpy(), batch.column("home").to_numpy()
            graph = home == _GRAPHS
            for at in np.flatnonzero(graph):
                if bundle[at] != now:
                    # the queries before it are those of the bundle before
                    yield from answers(batch, np.flatnonzero(~graph & (bundle == now)), shards)
                    now, shards = bundle[at], []
                shards.append(_Shard(batch, int(at)))
            yield from answers(batch, np.flatnonzero(~graph & (bundle == now)), shards)

    def answers(batch: pa.RecordBatch, rows: np.ndarray, shards: list[_Shard]) -> Iterator[pa.RecordBatch]:
        asked = batch.take(pa.array(rows))
        dim = asked.column("dim").to_numpy()
        for size in np.unique(dim):
            held, own = [s for s in shards if s.dim == size], np.flatnonzero(dim == size)
            for low in range(0, len(own) if held else 0, QUERY_BLOCK):
                block = asked.take(pa.array(own[low : low + QUERY_BLOCK]))
                queries = block.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
                q_ids, home, bound = (block.column(name).to_numpy() for name in ("id", "home", "bound"))
                best = _nearest_of(held, q_ids, queries, home, bound.copy(), k, ef)
                hits = pa.StructArray.from_arrays([pa.array(best.score), pa.array(best.vec)], names=["score", "vec_id"])
                starts = np.searchsorted(best.q, np.arange(len(q_ids) + 1)).astype(np.int32)
                columns = [block.column("id"), block.column("dim"), block.column("bundle"), pa.ListArray.from_arrays(pa.array(starts), hits)]
                yield pa.record_batch(columns, names=["query_id", "dim", "bundle", "hits"])

    return over, "query_id long, dim int, bundle long, hits array<struct<score:double,vec_id:long>>"


def nearest(graphs: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, ef: int = EF_SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``k`` nearest found of every usable query, by Euclidean distance and then id, without the query's own id.

    Every query meets every shard. Queries are dealt once for a bundle of shards, its own first, and of a bundle's answers the best ``k`` leave the task.
    """
    spark = graphs.sparkSession
    bound_arrow_batches(spark)
    size = F.length("vectors") + F.length("ids") + F.length("starts") + F.aggregate("layers", F.lit(0), lambda n, v: n + F.length(v["neighbours"]))
    last, total = graphs.agg(F.max("shard"), F.sum(size)).first()
    shards = (last or 0) + 1
    bundles = min(shards, max(-(-(total or 0) // BUNDLE), BUNDLES * spark.sparkContext.defaultParallelism))
    held = graphs.withColumns({"bundle": F.col("shard") % bundles, "home": F.lit(_GRAPHS).cast("long")})

    def found(asked: DataFrame) -> DataFrame:
        dealt = held.unionByName(asked, allowMissingColumns=True).repartition(bundles, "bundle")
        return dealt.sortWithinPartitions("bundle", "home", "id").mapInArrow(*_searched(k, ef))

    asked = _vectors(queries, id_col, vector_col).withColumn("home", F.pmod(F.xxhash64("id"), F.lit(shards)))
    own = F.col("home") % bundles
    if bundles == 1:
        hits = found(asked.withColumns({"bundle": own, "bound": F.lit(math.inf)}))
    else:
        asked = persist_reliably(asked)
        first = persist_reliably(found(asked.withColumns({"bundle": own, "bound": F.lit(math.inf)})))
        bound = F.coalesce(F.get("hits", F.lit(k - 1))["score"], F.lit(math.inf))
        others = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long")), lambda b: b != own))
        rest = asked.join(first.select(F.col("query_id").alias("id"), "dim", "hits"), ["id", "dim"], "left")
        hits = first.union(found(rest.select(*asked.columns, bound.alias("bound")).withColumn("bundle", others)))
    # at most k from each bundle, then from each 64th of the bundles, then of all
    best = F.slice(F.sort_array(F.flatten(F.collect_list("hits"))), 1, k).alias("hits")
    hits = hits.groupBy("query_id", (F.col("bundle") % 64).alias("part")).agg(best).groupBy("query_id").agg(best)
    hits = hits.select("query_id", F.posexplode("hits").alias("pos", "hit"))
    return hits.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
