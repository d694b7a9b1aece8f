import re

import numpy as np
import pyarrow as pa
import pytest

from siteatlas.llm import bitmap, words

TEXTS = ["The cat  sat", None, "", "a", "  the CAT é\t", "THE cat sat", "x" * 5000, "\n", "ends here", "here ends"]


@pytest.mark.parametrize("rows,size", [(64, 1 << 20), (1, 1 << 20), (64, 8), (3, 100)])
def test_words_are_those_of_the_pattern(rows, size):
    array = pa.array(["out", *TEXTS, "out"]).slice(1, len(TEXTS))
    seen = []
    for batch in words.batches(array, rows, size):
        starts, ends, bounds = batch.words(words.NOT_SPACE)
        data = batch.data.tobytes()
        for i in range(batch.n):
            seen.append([data[a:b].decode() for a, b in zip(starts[bounds[i] : bounds[i + 1]], ends[bounds[i] : bounds[i + 1]])])
    assert seen == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]


def test_hashes_fold_ascii_only_and_do_not_depend_on_place():
    of = {}
    for size in (1 << 20, 16):
        for batch in words.batches(pa.array(["The É cat", "cat é THE"]), 64, size):
            hashes, bounds = batch.word_hashes(words.NOT_SPACE)
            for i in range(batch.n):
                of[size, batch.first + i] = hashes[bounds[i] : bounds[i + 1]].tolist()
    assert of[1 << 20, 0] == of[16, 0] and of[1 << 20, 1] == of[16, 1]
    (the, big, cat), (cat2, small, the2) = of[16, 0], of[16, 1]
    assert the == the2 and cat == cat2 and big != small


def test_bitmap(spark):
    rows = spark.range(2000).selectExpr("xxhash64(id) AS h")
    bits = bitmap.build(rows, rows["h"], 16)
    members = np.array([r.h for r in rows.collect()], np.int64).view(np.uint64)
    assert bitmap.contains(bits, members).all()
    others = np.array([r.h for r in spark.range(10000, 14000).selectExpr("xxhash64(id) AS h").collect()], np.int64).view(np.uint64)
    assert bitmap.contains(bits, others).mean() < 0.06
