"""Removed bytes against a scan of all strings, suffix arrays against sorting."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from siteatlas.llm import suffixes

SCHEMA = "doc_id long, text string, spans int, h string"


def brute(rows, length):
    """rows in the order of the documents."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        hit = bytearray(len(data))
        for at in range(len(data) - length + 1):
            s = data[at : at + length]
            if s in seen:
                hit[at : at + length] = b"\1" * length
            seen.add(s)
        spans = sum(hit[j] and not (j and hit[j - 1]) for j in range(len(hit)))
        kept = bytes(b for b, h in zip(data, hit) if not h)
        out.append((i, len(data), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, rows, length=100):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    found = suffixes.report(docs, length=length).collect()
    return sorted((tuple(r) for r in found), key=lambda r: (r[0] is None, r[0] or 0))


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 8))]
        rows.append((i * 3, " ".join(parts)))
    return rows


def test_equals_scan(spark):
    rows = corpus(1, 150)
    shuffled = random.Random(2).sample(rows, len(rows))
    assert run(spark, shuffled) == brute(rows, 100)


def pieces(rows):
    names = ["anchor", "id", "h", "low", "high", "piece"]
    return pa.record_batch([pa.array(c, pa.binary() if n == "piece" else pa.int64()) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def test_small_shards_are_merged(spark, monkeypatch):
    # one very common line with different neighbours: an anchor whose pieces fill many shards
    rng = random.Random(4)
    line = "".join(rng.choice("abcdef ") for _ in range(130))
    rows = [(i, "".join(rng.choice("gh") for _ in range(rng.randint(0, 9))) + line + "".join(rng.choice("gh") for _ in range(rng.randint(0, 9)))) for i in range(120)]
    # tasks read the module in their own process, so the sizes are set where the shards are made
    over, _ = suffixes._removed(100)
    text = [(int(rng.random() < 0.5), i, 0, 0, 0, t.encode()) for i, t in rows]
    text = sorted((a, i, h, low, len(t) - 99, t) for a, i, h, low, _, t in text if len(t) >= 100)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 200)
    batches = [pieces(text[at : at + 7]) for at in range(0, len(text), 7)]
    removed = {(i, s) for b in over(iter(batches)) for i, _, low, high in zip(*(c.to_pylist() for c in b.columns)) for s in range(low, high)}
    expected = set()
    for anchor in (0, 1):
        seen = set()
        for _, i, _, _, _, data in (t for t in text if t[0] == anchor):
            for at in range(len(data) - 99):
                if data[at : at + 100] in seen:
                    expected.add((i, at))
                seen.add(data[at : at + 100])
    assert removed == expected and expected


def test_edge_cases(spark):
    a, b = "ab" * 49, "q" * 700
    unit = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    rows = [(1, None), (2, ""), (3, a), (4, a), (5, a + "x" * 2), (6, a + "x" * 2), (7, b), (8, b + "z"), (9, unit * 3), (10, "é" * 120), (11, "\0" * 150)]
    assert run(spark, rows) == brute(rows, 100)


def test_repeated_and_null_ids(spark):
    text = "".join(f"{i}," for i in range(80))
    found = run(spark, [(5, text), (5, text), (None, text), (9, text)])
    empty = hashlib.sha256(b"").hexdigest()
    assert [r[:3] for r in found] == [(5, 0 + len(text), 0), (5, len(text), 0), (9, len(text), len(text)), (None, len(text), len(text))]
    assert found[-1][4] == empty


def test_very_long_text(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh") for _ in range(600_000))
    rows = [(1, long[300_000:300_500]), (2, long)]
    found = run(spark, rows)
    assert [(r[0], r[2], r[3]) for r in found] == [(1, 0, 0), (2, 500, 1)]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_removal_keeps_columns_and_whole_characters(spark):
    shared = "".join(f"{i}é" for i in range(60))
    docs = spark.createDataFrame([(1, "x" + shared, 4, "k"), (2, "y" + shared + "z", 5, "l"), (3, shared, 6, "m")], SCHEMA)
    kept = sorted(tuple(r) for r in suffixes.remove(docs).collect())
    assert kept == [(1, "x" + shared, 4, "k"), (2, "yz", 5, "l")]


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(97, 99 + seed, 700).astype(np.uint8)
    text[300:450] = text[100:250]
    raw = text.tobytes()
    order = suffixes.suffix_array(text)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    starts = np.array([0, 200, 450])
    shared = suffixes.common_prefixes(text, order, starts, np.array([200, 450, 700]), 60)
    for at in range(1, len(raw)):
        a, b = raw[order[at - 1] :], raw[order[at] :]
        n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert shared[at] == min(n, 60)
