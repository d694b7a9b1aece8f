"""The dual-tree search against plain Python over all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from siteatlas.llm import dualtree

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "alpha " * 50_000 + " ".join(f"w{i}" for i in range(70_000)) + " " + "y" * 100_000


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def expected(docs, items, k=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, c in counts:
            n = sum(c.values())
            score = 0
            for t in ts & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * (100 - 50 + 50 * n * n_docs // total)))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (less, missing, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if missing else i, -less))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, rank int")
    b = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id string, text string, doc_id int")
    return sorted((tuple(r) for r in dualtree.rank(d, b, **options).collect()), key=str)


def corpus(rng, n, vocabulary):
    return [(i * 3 - n, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 5, 40, 200])))) for i in range(n)]


@pytest.mark.parametrize("k, block", [(50, dualtree.BLOCK_TERMS), (3, 40), (1, 10)])
def test_against_all_pairs(spark, k, block, monkeypatch):
    monkeypatch.setattr(dualtree, "SHARD", 64)
    rng = random.Random(k)
    vocabulary = [f"t{int(rng.paretovariate(0.6))}" for _ in range(400)]
    docs = corpus(rng, 700, vocabulary)
    docs += [(10_000 + i, docs[5][1]) for i in range(90)]  # ties that fill more than k ranks
    items = [(f"i{i:02d}", " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 15])))) for i in range(25)] + [("copy", docs[5][1])]
    assert run(spark, docs, items, k=k, block_terms=block) == expected(docs, items, k)


def test_edge_cases(spark):
    docs = [
        (1, None), (2, ""), (3, "--- !!"), (4, "Alpha beta"), (5, "alpha_BETA"), (6, "ALPHA-beta gamma"), (4, "Alpha beta"), (4, "other words"), (None, "alpha beta"),
        (7, LONG), (8, "é É naïve"), (9, "zeta " * 300), (-3, "alpha"),
    ]
    items = [
        ("a", "alpha"), ("b", "ALPHA beta beta"), ("c", None), ("d", "..."), ("e", "unseen"), (None, "gamma"), ("f", "É naïve"), ("a", "zeta"), ("b", "ALPHA beta beta"), ("g", LONG),
    ]
    assert run(spark, docs, items) == expected(docs, items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    assert run(spark, docs[:3], items) == [] and run(spark, docs, items[2:4]) == []


def test_item_ids_keep_their_type(spark):
    d = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id int, text string")
    b = spark.createDataFrame([(7, "a c")], "item_id int, text string")
    found = dualtree.rank(d, b)
    assert dict(found.dtypes) == {"item_id": "int", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert [(r.item_id, r.rank, r.doc_id) for r in found.collect()] == [(7, 1, 2), (7, 2, 1)]


def test_bounds_prune_and_hold(monkeypatch):
    """With the kth scores known, most leaves stay closed and every better document is found."""
    rng = np.random.default_rng(2)
    items = [np.sort(rng.choice(200, 12, replace=False)) for _ in range(30)]
    block = dualtree.Block(rng.integers(1000, 9000, 200), 2000, 80_000, items, dualtree.item_tree(items), np.zeros(30, np.int64))
    size = rng.integers(1, 60, 2000)
    parts = [np.sort(rng.choice(200, s, replace=False)).astype(np.uint16) for s in size]
    tfs = [rng.integers(1, 5, s).astype(np.uint16) for s in size]
    shard = dualtree.Shard(np.arange(2000), size * 2, [p.tobytes() for p in parts], [t.tobytes() for t in tfs], block)
    best = dualtree.Best(block, 10)
    dualtree.search(shard, block, best)
    for i, wanted in enumerate(items):
        score, ids = shard.scores(np.arange(len(shard.levels[-1][0])), wanted)
        order = np.lexsort((ids, -score))[:10]
        assert best.id[i].tolist() == ids[order].tolist() and best.score[i].tolist() == score[order].tolist()
    again = dualtree.Best(dualtree.Block(block.weights, 2000, 80_000, items, block.tree, best.worst), 10)
    dualtree.search(shard, block, again)
    assert [x.tolist() for x in again.id] == [x.tolist() for x in best.id]
    assert again.opened < 0.5 * len(items) * len(shard.levels[-1][0])
