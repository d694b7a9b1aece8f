"""SimHash fingerprints and their join against plain Python over all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from siteatlas.llm import queries, simhash, words
from tests.conftest import SF

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 977}" for i in range(60_000)) + " " + "x" * 200_000


def fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] if len(found) >= 3 else [" ".join(found)] if found else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def linked(points):
    """The smallest point of each point's component, over all pairs."""
    of = {p: p for p in points}

    def root(p):
        while of[p] != p:
            of[p] = of[of[p]]
            p = of[p]
        return p

    for a, b in combinations(sorted(points), 2):
        if (a ^ b).bit_count() <= 3:
            x, y = sorted((root(a), root(b)))
            of[y] = x
    return {p: root(p) for p in points}


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    of = linked(set(prints))
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[of[p]] = min(i, least.get(of[p], i))
    return sorted(((i, f"{p:016x}", least.get(of[p])) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "c", "f") for i, t in rows], "doc_id long, text string, component_id string, fp string")
    return sorted((tuple(r) for r in simhash.components(docs, **options).collect()), key=str)


def test_native_hash_is_the_same(spark):
    for text in ("", "a", "ab cd éf", "x" * 100):
        assert spark.sql("SELECT xxhash64(:t)", {"t": text}).first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "a b c"), (8, "A b  B\tc\nd"), (9, LONG), (10, LONG + " end"),
        (None, "one"), (None, "lonely words in a row"), (11, "É é ñ Ñ"), (12, "\U0001f600 \U0001f600 \U0001f600 \U0001f600"), (7, "a b c"), (7, "other text of one id"),
        (-5, "one"), (13, "x " * 70_000),
    ]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("window", [2048, 3, 40])
def test_near_copies(spark, window):
    rng = random.Random(window)
    vocabulary = [f"word{i}" for i in range(500)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 60, 300]))]
        for _ in range(rng.choice([1, 5, 60])):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 1000, " ".join(copy)))
    assert run(spark, rows, window=window) == expected(rows)


@pytest.mark.parametrize("window", [2, 30])
def test_dense_families_of_fingerprints(spark, window):
    """Crowded cells, whose pairs are not all compared."""
    rng = np.random.default_rng(window)
    points = set()
    for n, flips in ((400, 4), (150, 7), (60, 2)):
        centre = int(rng.integers(0, 1 << 63, dtype=np.int64))
        for _ in range(n):
            p = centre
            for b in rng.choice(64, flips, replace=False).tolist():
                p ^= 1 << b
            points.add(p)
    of = linked(points)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    frame = spark.createDataFrame([(signed(p),) for p in points], "fp long")
    got = simhash.graph.components(simhash.links(frame, window)).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.component, set()).add(r.id)
    want = {}
    for p, c in of.items():
        want.setdefault(c, set()).add(signed(p))
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_manhattan_distance_is_a_lower_bound():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 63, (2, 1000), dtype=np.uint64)
    segments = lambda x: np.bitwise_count(x[:, None] >> np.arange(0, 64, 2, dtype=np.uint64) & np.uint64(3)).astype(int)
    manhattan = np.abs(segments(a) - segments(b)).sum(axis=1)
    assert (np.bitwise_count(simhash.code(a) ^ simhash.code(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_growth_of_a_family(spark):
    """Rows sent for a family of near copies grow with its size, not with the square."""
    rng = np.random.default_rng(9)
    sent = []
    for n in (200, 400):
        fp = np.array([sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(n)], np.uint64)
        cells = np.zeros(len(fp), np.int64)
        a, _ = simhash._linked(cells, np.sort(fp), 0, 50)
        sent.append(len(a))
    assert sent[1] <= 2.5 * sent[0]


def test_query_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in queries.QUERIES["op11_simhash_dedup"](spark, SF).collect()), key=str)
    assert found == expected(rows)


def test_long_text_is_counted_in_chunks():
    texts = words.Texts(np.frombuffer(LONG.encode(), np.uint8), np.array([0, len(LONG)]))
    assert simhash.fingerprints(texts).tolist() == [fingerprint(LONG)]
