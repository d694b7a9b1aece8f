"""Exact n-gram Jaccard join over documents with a token-group matrix.

Similar documents are put into small groups. For each group the union of its members' tokens is stored; the
number of a query's tokens in that union bounds its overlap with every member, and only groups whose bound
reaches the threshold are opened and compared exactly.

How the matrix is built and searched at scale:

* Texts with equal token sets are one *class*, found by an aggregate, so exact copies never meet each other.
* All tokens have one global order, rare before frequent (by a fixed-size table of counts over all documents). Two
  sets over the threshold share ``l`` tokens among the first ``n - ceil(t n) + l`` of each, so only those *leading* tokens
  become matrix cells (token, group), with ``l`` a tenth of the set. A document with too few shared leading tokens has no
  partner, and a group with too few of a query's is not opened.
* A document joins the group of its most shared leading token; a group that would exceed ``GROUP_SIZE`` is split by
  hash, sets of many tokens taking several places. Groups are opened on themselves, then split groups against the first part of
  their token, and what is connected by then is not compared again. The last step takes every document whose leading tokens meet a
  group that holds another component, with all of its tokens: nothing is capped. A component that fills more than a group is
  met as a whole first, by the union of all its tokens, before any document asks one of its groups.

Null and empty texts have no tokens and link with nothing. Rows with one id (repeated rows too) count as linked. Rows with a null
id are returned with a null component and link with nothing. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.llm import bitmap, graph, words
from siteatlas.session import persist_reliably

GROUP_SIZE = 48  # documents in a group, about
GROUP_TOKENS = 20_000  # a set of more tokens takes the place of several
QUERY_BLOCK = 64
LEAD = 10  # one in so many tokens must be shared among the leading ones
PAIR_LEAD = 40  # the same where documents meet groups, by fewer leading tokens
COUNT_BITS = 20  # the table of token counts has 2^20 cells, whatever the data
SHARED_BITS = 26  # of the bitmap of shared leading tokens
TASK_ROWS = 1 << 15  # a task over documents or groups takes so many rows at least, however many partitions a session deals
TASK_TOKENS = 1 << 17  # the same over single tokens
PARTS = 16  # a set's tokens are also counted by the last bits of their hash
_SLICES = 64
_CLASS = 54  # a token: 4 bits of frequency class above 54 bits of hash
_MAX_CLASS = 15


def _sets(texts: pa.Array, k: int, classes: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct tokens, bounds of each text) of runs of texts."""
    for batch in words.batches(texts, rows=64):
        hashes, bounds = batch.word_hashes(words.NOT_SPACE)
        doc = words.owner(bounds)
        tokens = words.grams(hashes, k)
        inside = doc[: len(tokens)] == doc[k - 1 :] if len(tokens) else np.empty(0, bool)
        tokens, doc_of = tokens[inside], doc[: len(inside)][inside]
        count = np.diff(bounds)
        for size in range(1, k):  # a text of fewer words is one token
            short = np.flatnonzero(count == size)
            if len(short):
                at = bounds[short][:, None] + np.arange(size)
                value = words.mix(
                    (hashes[at] * words.powers(size + 2)[2:]).sum(axis=1, dtype=np.uint64) + np.uint64(size)
                )
                tokens, doc_of = np.concatenate([tokens, value]), np.concatenate([doc_of, short])
        tokens = tokens >> np.uint64(64 - _CLASS)
        if classes is not None:
            tokens |= classes[tokens >> np.uint64(_CLASS - COUNT_BITS)] << np.uint64(_CLASS)
        # sorted by text, then token: 6 bits of row above 58 bits of token
        keys = np.sort(doc_of.astype(np.uint64) << np.uint64(58) | tokens)
        if len(keys):
            keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        doc_of = (keys >> np.uint64(58)).astype(np.int64)
        yield batch.first, keys & np.uint64((1 << 58) - 1), np.searchsorted(doc_of, np.arange(batch.n + 1))


def _signatures(k: int):
    """Per text the size and two sums over its set; per task the token counts, in slices."""
    schema = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("sig_a", pa.int64()), ("sig_b", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())]
    )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        for batch in batches:
            n, a, b = (np.zeros(batch.num_rows, np.uint64) for _ in range(3))
            for first, tokens, bounds in _sets(batch.column(1), k, None):
                np.add.at(counts, tokens >> np.uint64(_CLASS - COUNT_BITS), np.uint32(1))
                size = np.diff(bounds)
                rows, full = slice(first, first + len(size)), np.flatnonzero(size)
                n[rows] = size
                if len(full):
                    a[rows][full] = np.add.reduceat(words.mix(tokens), bounds[full])
                    b[rows][full] = np.add.reduceat(words.mix(tokens ^ np.uint64(0x5555555555555555)), bounds[full])
            yield pa.record_batch(
                [batch.column(0), n.view(np.int64), a.view(np.int64), b.view(np.int64), pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())],
                schema=schema,
            )
        if counts.any():
            parts = np.split(np.minimum(counts, 0xFFFF).astype(np.uint16), _SLICES)
            none = pa.nulls(_SLICES, pa.int64())
            yield pa.record_batch([none, none, none, none, pa.array(range(_SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], schema=schema)

    return over, "id long, n long, sig_a long, sig_b long, slice int, counts binary"


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << COUNT_BITS) // _SLICES, np.uint64)
    for part in table["counts"]:
        total += np.frombuffer(part.as_buffer(), np.uint16)
    return pa.table({"slice": pa.array([table["slice"][0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _classes(rows: DataFrame) -> np.ndarray:
    """The frequency class of every cell of the count table: 0, or how often it holds twice the mean."""
    parts = rows.filter("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(_summed, "slice int, counts binary")
    cells = 1 << COUNT_BITS
    counts = np.zeros(cells)
    step = cells // _SLICES
    for row in parts.toArrow().to_pylist():  # one row a slice: 2^COUNT_BITS numbers in all
        counts[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(row["counts"], np.uint64)
    mean = max(1.0, counts.mean())
    return np.clip(np.floor(np.log2(np.maximum(counts, 1) / mean)), 0, _MAX_CLASS).astype(np.uint64)


def _needed(n, percent: int):
    """The least overlap with a set of n that allows the threshold."""
    return (percent * n + 99) // 100


def _at_least(n):
    """How many leading tokens a set of n shares with any partner of n or more."""
    return n // LEAD + 1


def _tasks(classes: int, tokens: int, percent: int) -> tuple[int, int, int]:
    """Tasks for a row per document, for a row per leading token and for all tokens.

    They bound only what a session deals beyond its data: every task has a log entry and a file, and the driver keeps both.
    """
    leading = tokens * (100 - percent) // 100 + tokens // LEAD + classes
    return classes // TASK_ROWS + 1, leading // TASK_TOKENS + 1, tokens // (2 * TASK_TOKENS) + 1


def _leading(k: int, percent: int, classes):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, tokens, bounds in _sets(batch.column(1), k, classes.value):
                n = np.diff(bounds)
                lead = np.minimum(n - _needed(n, percent) + _at_least(n), n)
                offsets = np.concatenate([[0], np.cumsum(lead)])
                at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - bounds[:-1], lead)
                yield pa.record_batch(
                    [ids.slice(first, len(n)), n, pa.ListArray.from_arrays(offsets.astype(np.int32), tokens[at].view(np.int64))], names=["id", "n", "lead"]
                )

    return over, "id long, n long, lead array<long>"


def _lookup(bits):
    """Leading tokens that may be shared, one row each."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = batch.column(2)
            tokens = lead.flatten().to_numpy(zero_copy_only=False)
            row = lead.value_parent_indices().to_numpy(zero_copy_only=False)
            at = np.arange(len(row)) - np.searchsorted(row, row)
            keep = bitmap.contains(bits.value, words.mix(tokens.view(np.uint64)))
            row = pa.array(row[keep])
            columns = [batch.column(0).take(row), batch.column(1).take(row), tokens[keep], at[keep].astype(np.int32)]
            yield pa.record_batch(columns, names=["id", "n", "token", "at"])

    return over, "id long, n long, token long, at int"


def _packed(names: list[str], to: str) -> list:
    """Sixteen small numbers as two longs, a byte each; what is larger counts as 255, which only loosens a bound."""
    byte = lambda name, at: f"shiftleft(CAST(least({name}, 255) AS BIGINT), {8 * (at % 8)})"
    half = lambda low: " | ".join(byte(name, at) for at, name in enumerate(names) if low <= at < low + 8)
    return [F.expr(half(0)).alias(f"{to}0"), F.expr(half(8)).alias(f"{to}1")]


def _unpacked(name: str, at: int) -> str:
    return f"(shiftright({name}{at // 8}, {8 * (at % 8)}) & 255)"


def _full(k: int, classes, wanted):
    """All tokens of the texts whose id may be wanted."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(bitmap.contains(wanted.value, words.mix(ids.view(np.uint64))))
            if not len(keep):
                continue
            batch = batch.take(pa.array(keep))
            for first, tokens, bounds in _sets(batch.column(1), k, classes.value):
                packed = [tokens[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
                part = words.owner(bounds) * PARTS + (tokens % np.uint64(PARTS)).astype(np.int64)
                parts = np.bincount(part, minlength=len(packed) * PARTS).reshape(-1, PARTS).astype(np.int32)
                yield pa.record_batch([batch.column(0).slice(first, len(packed)), pa.array(packed, pa.binary()), *parts.T.copy()], names=["id", "tokens", *_PART_NAMES])

    return over, "id long, tokens binary, " + ", ".join(f"{p} int" for p in _PART_NAMES)


_PART_NAMES = [f"part{i}" for i in range(PARTS)]
_OPEN_PAIRS = 1 << 22


def _open(percent: int):
    """Open one group for its queries. Rows: (group, block, query, id, tokens); returns links as stars (a, b).

    Rows with ``query`` null are members that also query each other.
    """

    def links(q_tokens, q_bounds, m_tokens, m_bounds):
        q_n, m_n = np.diff(q_bounds), np.diff(m_bounds)
        union, inverse = np.unique(m_tokens, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        owner = words.owner(m_bounds)[order]  # members holding each union token, one after the other
        starts = np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(union)))])
        at = np.minimum(np.searchsorted(union, q_tokens), max(len(union) - 1, 0))
        inside = union[at] == q_tokens
        q_owner = words.owner(q_bounds)
        bound = np.bincount(q_owner[inside], minlength=len(q_n))
        least = np.maximum(_needed(q_n, percent), m_n.min(initial=0))  # of a partner's tokens
        inside &= (bound * (100 + percent) >= (q_n + least) * percent)[q_owner]  # only queries that qualify open the group
        at, q_owner = at[inside], q_owner[inside]
        width = starts[at + 1] - starts[at]
        done, found = 0, []
        edges = np.concatenate([[0], np.cumsum(width)])
        while done < len(at):
            to = int(np.searchsorted(edges, edges[done] + _OPEN_PAIRS, side="right")) - 1
            to = min(len(at), max(to, done + 1))
            if to < len(at):  # whole queries only
                back = int(np.searchsorted(q_owner, q_owner[to]))
                to = back if back > done else int(np.searchsorted(q_owner, q_owner[done], side="right"))
            w = width[done:to]
            member = owner[np.arange(w.sum()) - np.repeat(np.cumsum(w) - w - starts[at[done:to]], w)]
            q = np.repeat(q_owner[done:to], w)
            low = int(q_owner[done])
            common = np.bincount((q - low) * len(m_n) + member)
            hit = np.flatnonzero(common)
            qi, mi = hit // len(m_n) + low, hit % len(m_n)
            c = common[hit]
            ok = 100 * c >= percent * (q_n[qi] + m_n[mi] - c)
            found.append(np.stack([qi[ok], mi[ok]]))
            done = to
        return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)

    def unpack(rows):
        parts = [np.frombuffer(x, np.uint64) for x in rows]
        return np.concatenate([*parts, np.empty(0, np.uint64)]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def over(table: pa.Table) -> pa.Table:
        asks = table["query"].to_numpy(zero_copy_only=False).astype(bool)
        ids, tokens = table["id"].to_numpy(), table["tokens"].to_pylist()
        members = np.flatnonzero(~asks)
        queries = np.flatnonzero(asks) if asks.any() else members
        q, m = links(*unpack([tokens[i] for i in queries]), *unpack([tokens[i] for i in members]))
        a, b = graph.stars(ids[queries[q]], ids[members[m]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return over, "a long, b long"


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """(id_col, n_shingles, component_id) per row: documents linked where 100 |A and B| >= percent |A or B|.

    A and B are the sets of the distinct k-word shingles of the two texts, A-Z folded, words split at ASCII white
    space; a text of fewer words is one shingle. Tokens are compared by 54-bit hashes. Rows of one id count as linked, whatever their texts.
    """
    spark = docs.sparkSession
    words.bound_arrow_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = persist_reliably(texts.mapInArrow(*_signatures(k)))
    signature = F.struct("sig_a", "sig_b", "n")
    several = rows.filter("slice is null and id is not null").groupBy("id").agg(F.min(signature).alias("x"), F.max(signature).alias("y"))
    several = persist_reliably(several.filter("x <> y").select("id"))
    if not several.isEmpty():
        return _by_text(texts, several, k, percent).toDF(id_col, "n_shingles", "component_id")
    classes = spark.sparkContext.broadcast(_classes(rows))

    rows = rows.filter("slice is null").select("id", "n", "sig_a", "sig_b")
    full = rows.filter("n > 0 and id is not null")
    same = persist_reliably(full.groupBy("sig_a", "sig_b", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    few, many, whole = _tasks(*same.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first(), percent)
    same = same.coalesce(few)

    texts = texts.filter("id is not null")
    reps = same.select(F.col("rep").alias("id"))
    leading = texts.mapInArrow(*_leading(k, percent, classes)).filter("n > 0").join(reps, "id", "left_semi")
    leading = persist_reliably(leading).coalesce(many)
    shared = persist_reliably(
        leading.select("id", F.explode("lead").alias("token")).groupBy("token").agg(F.count("*").alias("df")).filter("df > 1").coalesce(many)
    )
    # _lookup tests mixed tokens: tokens in order are not spread evenly
    bits = spark.sparkContext.broadcast(bitmap.build(shared, _mixed("token"), SHARED_BITS))
    least = F.expr(f"({percent} * n + 99) div 100 div {LEAD} + 1")  # a partner has at least the needed size
    cells = persist_reliably(leading.mapInArrow(*_lookup(bits)).join(shared.select("token"), "token").coalesce(many))
    able = cells.groupBy("id", "n").agg(F.count("*").alias("have")).filter(F.col("have") >= F.least(least, "n")).select("id")
    cells = cells.join(able, "id", "left_semi")
    again = cells.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    cells = persist_reliably(cells.join(again, "token").select("token", "id", "n", "at", "df").coalesce(many))

    best = cells.groupBy("id", "n").agg(F.max(F.struct("df", "token")).alias("best"), F.count("*").alias("have"))
    best = best.filter(F.col("have") >= F.least(least, "n"))
    places = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") / GROUP_TOKENS)))).cast("long")
    parts = F.ceil(F.col("best.df") * places / GROUP_SIZE)
    part = F.pmod(F.xxhash64("id"), parts)
    placed = best.select("id", "n", F.col("best.token").alias("own_token"), part.alias("part"), places.alias("places"), (parts > 1).alias("split"))
    placed = placed.withColumns({"own": F.xxhash64("own_token", "places"), "grp": F.xxhash64("own_token", "places", "part")})
    mates = placed.groupBy("grp").agg((F.count("*") > 1).alias("mates"))
    placed = persist_reliably(placed.join(mates, "grp").coalesce(few))
    wanted = spark.sparkContext.broadcast(bitmap.build(placed, _mixed("id")))
    tokens = texts.mapInArrow(*_full(k, classes, wanted)).join(placed, "id").dropDuplicates(["id"])
    tokens = persist_reliably(tokens.coalesce(whole))

    # groups on themselves, and the parts of a split group against its first ones, which hold GROUP_SIZE documents in all
    own = tokens.filter("mates").select("grp", F.lit(0).cast("long").alias("block"), F.lit(False).alias("query"), "id", "tokens")
    hubs = tokens.filter(f"split and part < least(places, {GROUP_SIZE})").select("own", "grp", F.col("part").alias("hub"), "id", "tokens")
    asking = tokens.filter("split and part > 0").select("own", F.col("part").alias("block"), "id", "tokens")
    hub_members = hubs.join(asking.select("own", "block").distinct(), "own").filter("block > hub").select("grp", "block", F.lit(False).alias("query"), "id", "tokens")
    hub_groups = hubs.select("own", "grp", "hub").distinct()
    hub_queries = asking.join(hub_groups, "own").filter("block > hub").select("grp", "block", F.lit(True).alias("query"), "id", "tokens")
    first = own.unionAll(hub_members).unionAll(hub_queries)
    first = persist_reliably(first.groupBy("grp", "block").applyInArrow(*_open(percent)))
    settled = graph.components(first)

    # what is not connected yet, from the smaller component to the larger
    sizes = settled.groupBy("component").agg(F.count("*").alias("size"))
    of = persist_reliably(settled.join(sizes, "component").select("id", F.struct((-F.col("size")).alias("less"), "component").alias("comp")).coalesce(few))
    alone = F.struct(F.lit(-1).cast("long").alias("less"), F.col("id").alias("component"))
    known = cells.drop("df").join(of, "id", "left").withColumn("comp", F.coalesce("comp", alone))
    open_tokens = known.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("token")
    profiles = tokens.select("id", "grp", "own_token", *_packed(_PART_NAMES, "q"))
    boxes = tokens.groupBy("grp").agg(*[f(p).alias(f"{f.__name__}_{p}") for p in _PART_NAMES for f in (F.min, F.max)])
    # read by up to four joins of one plan: written once, a plan holds none of its aggregates
    boxes = persist_reliably(boxes.select("grp", *_packed([f"min_{p}" for p in _PART_NAMES], "low"), *_packed([f"max_{p}" for p in _PART_NAMES], "high")).coalesce(few))
    unsettled = persist_reliably(known.join(open_tokens, "token").join(profiles, "id").coalesce(many))
    unsettled_asks = unsettled.select(
        "token", "at", F.col("id").alias("q"), F.col("n").alias("q_n"), F.col("comp").alias("q_comp"), F.col("own_token").alias("q_own"), F.col("grp").alias("q_grp"), "q0", "q1"
    )
    extent = [F.min("comp").alias("least"), F.min("n").alias("n_min"), F.max("n").alias("n_max")]
    fits = (F.col("q_comp") > F.col("least")) & (F.col("q_grp") != F.col("grp"))
    fits &= (F.col("n_max") * 100 >= F.col("q_n") * percent) & (F.col("q_n") * 100 >= F.col("n_min") * percent)
    # sets over the threshold differ in few tokens, so in every part by few
    differ = " + ".join(f"greatest(0, {_unpacked('low', k)} - {_unpacked('q', k)}, {_unpacked('q', k)} - {_unpacked('high', k)})" for k in range(PARTS))
    fits &= F.expr(f"({differ}) * {100 + percent} <= (q_n + n_max) * {100 - percent}")
    # two sets over the threshold also share a few of still fewer leading tokens
    leads = f"at < {{n}} - ({percent} * {{n}} + 99) div 100 + {{n}} div {PAIR_LEAD} + 1"
    asks = unsettled_asks.filter(leads.format(n="q_n"))
    met = unsettled.filter(leads.format(n="n"))
    q_least = F.expr(f"least(({percent} * q_n + 99) div 100 div {PAIR_LEAD} + 1, q_n)")
    asked = ["grp", "q", "q_n", "q0", "q1"]

    def meetings(asks, met, own_asks, own, *also):
        """Groups and the documents that ask them: of other tokens by what they share, groups of one token through that token alone."""
        matrix = met.groupBy("token", "grp", "own_token", *also).agg(*extent).join(boxes, "grp").coalesce(many)
        pairs = asks.join(matrix, ["token", *also]).filter(fits & (F.col("q_own") != F.col("own_token")))
        pairs = pairs.groupBy(*asked).agg(F.count("*").alias("have")).filter(F.col("have") >= q_least).select(*asked)
        groups = own.groupBy("own_token", "grp", *also).agg(*extent).join(boxes, "grp").coalesce(many)
        kin = own_asks.join(groups.withColumnRenamed("own_token", "q_own"), ["q_own", *also]).filter(fits)
        return pairs.unionAll(kin.select(*asked))

    own_asks, own = unsettled_asks.filter("token = q_own"), unsettled.filter("token = own_token")
    family = F.col("comp.less") < -GROUP_SIZE
    pairs = persist_reliably(meetings(asks, met.filter(~family), own_asks, own.filter(~family)).coalesce(many))
    near_families = _near_families(asks, met.filter(family), of, tokens, percent, q_least, many)
    if near_families is not None:
        # a plan of its own, over rows written once: the driver holds one meeting's stages at a time
        near_asks = persist_reliably(unsettled_asks.join(near_families, "q").coalesce(many))
        more = meetings(near_asks.filter(leads.format(n="q_n")), met.filter(family), near_asks.filter("token = q_own"), own.filter(family), "comp")
        pairs = pairs.unionAll(persist_reliably(more.coalesce(many)))
    # the same bound with each member, before any set is sent
    members = tokens.select(F.col("grp").alias("m_grp"), F.col("n").alias("m_n"), *_packed(_PART_NAMES, "m"))
    apart = " + ".join(f"abs({_unpacked('m', k)} - {_unpacked('q', k)})" for k in range(PARTS))
    near = F.expr(f"grp = m_grp AND ({apart}) * {100 + percent} <= (q_n + m_n) * {100 - percent}")
    pairs = persist_reliably(pairs.join(members, near, "left_semi").select("grp", "q").distinct().coalesce(many))
    blocks = persist_reliably(pairs.groupBy("grp").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks")).coalesce(few))
    # bitmaps keep sets that are not asked for out of the joins
    members = tokens.filter(bitmap.test(spark, bitmap.build(blocks, F.col("grp")), F.col("grp"))).select("grp", "id", "tokens").join(blocks, "grp")
    members = members.select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("query"), "id", "tokens")
    asking = pairs.join(blocks, "grp").select("grp", F.pmod(F.xxhash64("q"), "blocks").alias("block"), F.lit(True).alias("query"), F.col("q").alias("id"))
    q_hash = F.xxhash64("q")
    asked_for = tokens.filter(bitmap.test(spark, bitmap.build(pairs, q_hash), F.xxhash64("id"))).select("id", "tokens")
    asking = asking.join(asked_for, "id").select("grp", "block", "query", "id", "tokens")
    second = members.unionAll(asking).groupBy("grp", "block").applyInArrow(*_open_asked(percent))

    stars = settled.select(F.col("id").alias("a"), F.col("component").alias("b"))
    found = graph.components(stars.unionAll(second))

    component = F.coalesce("component", "rep", "id")
    out = rows.join(same.drop("copies"), ["sig_a", "sig_b", "n"], "left")
    rep = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("rep"))
    out = out.select("id", "n", rep.alias("rep")).join(found.withColumnRenamed("id", "rep"), "rep", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _near_families(asks: DataFrame, met: DataFrame, of: DataFrame, tokens: DataFrame, percent: int, q_least, tasks: int) -> DataFrame | None:
    """(q, comp): documents and components of more than a group's size that may be linked, by the component's token union.

    A family of near copies fills many groups, so its union is looked at once for the whole family: a document that holds too few of its tokens
    for a link with the smallest member asks none of the groups. None where there is no such pair.
    """
    sizes = met.groupBy("token", "comp").agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"))
    fits = (F.col("q_comp") > F.col("comp")) & (F.col("n_max") * 100 >= F.col("q_n") * percent) & (F.col("q_n") * 100 >= F.col("n_min") * percent)
    pairs = asks.join(sizes, "token").filter(fits).groupBy("q", "q_n", "comp").agg(F.count("*").alias("have"), F.min("n_min").alias("n_min"))
    # a partner has at least the size that the document needs
    smallest = F.greatest("n_min", F.expr(f"({percent} * q_n + 99) div 100"))
    pairs = persist_reliably(pairs.filter(F.col("have") >= q_least).select("q", "comp", F.ceil((F.col("q_n") + smallest) * percent / (100 + percent)).alias("needed")).coalesce(tasks))
    if pairs.isEmpty():
        return None
    comps, asking = pairs.select("comp").distinct(), pairs.select(F.col("q").alias("id")).distinct()
    members = tokens.select("id", "tokens").join(of, "id").join(comps, "comp", "left_semi")
    union = members.select(F.col("comp.component").alias("key"), "tokens").mapInArrow(*_exploded(distinct=True)).distinct()
    held = tokens.select("id", "tokens").join(asking, "id", "left_semi").select(F.col("id").alias("key"), "tokens").mapInArrow(*_exploded(distinct=False))
    held = pairs.select(F.col("q").alias("key"), F.col("comp.component").alias("of"), "comp", "needed").join(held, "key")
    held = held.join(union.withColumnRenamed("key", "of"), ["of", "token"])
    enough = held.groupBy("key", "comp", "needed").agg(F.count("*").alias("overlap")).filter("overlap >= needed")
    return persist_reliably(enough.select(F.col("key").alias("q"), "comp").coalesce(tasks))


def _exploded(distinct: bool):
    """(key, token) of packed sets; ``distinct`` leaves out what a task has just sent for the key."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column(1).to_pylist()
            token = np.frombuffer(b"".join(sets), np.int64)
            key = np.repeat(batch.column(0).to_numpy(), [len(x) // 8 for x in sets])
            if distinct and len(key):
                order = np.lexsort((token, key))
                key, token = key[order], token[order]
                new = np.append(True, (key[1:] != key[:-1]) | (token[1:] != token[:-1]))
                key, token = key[new], token[new]
            yield pa.record_batch([key, token], names=["key", "token"])

    return over, "key long, token long"


def _by_text(texts: DataFrame, several: DataFrame, k: int, percent: int) -> DataFrame:
    """``components`` of (id, text) where the ids in ``several`` have different texts: each of these is a document of its own, linked with the id."""
    several = several.select(F.col("id").alias("of"))
    keyed = texts.join(several, F.col("id") == F.col("of"), "left")
    keyed = persist_reliably(keyed.select("id", "text", F.when(F.col("of").isNotNull(), F.xxhash64("id", "text")).otherwise(F.col("id")).alias("node"), "of"))
    aliases = persist_reliably(keyed.filter("of is not null").select("node", "of").distinct())
    found = components(keyed, "node", "text", k, percent).join(aliases, "node", "left")
    found = persist_reliably(found.select(F.coalesce("of", "node").alias("id"), F.col("n_shingles").alias("n"), F.col("component_id").alias("part"), "of"))
    edges = found.filter("of is not null").select(F.col("of").alias("a"), F.col("part").alias("b"))
    joined = graph.components(edges).withColumnRenamed("id", "part")
    found = persist_reliably(found.join(joined, "part", "left").select("id", "n", F.coalesce("component", "part").alias("part")))
    least = found.filter("part is not null").groupBy("part").agg(F.min("id").alias("least"))  # a part may bear the key of a text
    return found.join(least, "part", "left").select("id", "n", "least")


def _open_asked(percent: int):
    """As ``_open``, but a block that got no query opens nothing."""
    over, schema = _open(percent)

    def asked(table: pa.Table) -> pa.Table:
        if not any(table["query"].to_pylist()):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        return over(table)

    return asked, schema


def _mixed(name: str):
    """``words.mix`` of a column, as an Arrow function: Spark's own hashes differ from it."""

    @F.arrow_udf("long")
    def mixed(values: pa.Array) -> pa.Array:
        return pa.array(words.mix(values.to_numpy(zero_copy_only=False).view(np.uint64)).view(np.int64))

    return mixed(F.col(name))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
    ELSE array_to_string(ws[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
"""
