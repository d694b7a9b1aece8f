"""The pipeline: what each stage does to planted rows, and the run as a whole."""

import hashlib
import random
import re
import shutil
import zlib

import pytest

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_jaccard import brute as linked
from tests.llm.test_text_operators import contaminated, targets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean documents, copies, near copies, a repeated passage, a benchmark passage and texts without a letter."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(800)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item, passage, base = say(30), say(60), say(200).split()
    near = list(base)
    near[50] = "changed"
    rows = {i: say(120) for i in range(20)}
    rows |= {20: rows[3], 21: " ".join(base), 22: " ".join(near), 23: say(40) + " " + passage + " " + say(40), 24: say(40) + " " + passage + " " + say(40)}
    rows |= {25: say(30) + " " + item + " " + say(30), 26: "12 34 !!", 27: None, 28: ""}
    path = str(tmp_path_factory.mktemp("sf"))
    docs = [(i, t, "xx", f"s{i % 3}", len(t or "")) for i, t in rows.items()]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    yield path, rows, passage
    shutil.rmtree(path)


def test_stages(spark, planted):
    path, rows, passage = planted
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    clean = set(range(20))

    docs = stages["language_id"](spark, docs, path)
    assert {r.doc_id for r in docs.collect()} == set(rows) - {26, 27, 28}
    docs = stages["near_duplicates"](spark, docs, path)
    assert {r.doc_id for r in docs.collect()} == clean | {21, 23, 24, 25}
    docs = stages["repeated_strings"](spark, docs, path)
    texts = {r.doc_id: r for r in docs.collect()}
    assert {i: texts[i].text for i in clean} == {i: rows[i] for i in clean}
    assert passage in texts[23].text and passage not in texts[24].text and texts[24].n_chars == len(texts[24].text) < len(rows[24]) - 300
    docs = stages["decontaminate"](spark, docs, path)
    assert {r.doc_id for r in docs.collect()} == clean | {21, 23, 24}
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    mixed = stages["mix_sources"](spark, docs, path)
    assert all(0 < r.mix_copies <= 2 and r.mix_taken == r.mix_copies * len(r.text.split()) for r in mixed.collect())
    assert mixed.columns[:5] == docs.columns


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    total = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.5 * total < found.count() <= total


def test_empty_table(spark, planted):
    path, _, _ = planted
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert docs.count() == 0


def test_nulls_and_extra_columns(spark, planted):
    path, rows, _ = planted
    odd = [(None, rows[0], "xx", None, 5, 1), (1, rows[1], None, "s", None, 2), (1, rows[1], None, "s", None, 2), (None, None, None, None, None, 3)]
    docs = spark.createDataFrame(odd, SCHEMA + ", hash int")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "hash"], name
        docs.collect()


def test_one_row_of_repeated_ones_and_of_null_ids(spark, planted):
    path, rows, _ = planted
    near = rows[4].split()
    near[50] = "changed"
    odd = [(7, rows[1], "xx", "b", 5), (7, rows[1], "xx", "a", 5), (7, rows[1], "xx", "a", 5), (9, rows[1], "xx", "a", 5)]  # repeated, and a copy
    odd += [(None, rows[1], "xx", "a", 5), (None, rows[2], "xx", "a", 5), (None, rows[2], "xx", "a", 5)]  # copies without an id
    odd += [(None, " ".join(near), "xx", "a", 5), (8, rows[4], "xx", "a", 5), (8, rows[5], "xx", "a", 5), (10, rows[6], "xx", None, None)]
    docs = spark.createDataFrame(odd, SCHEMA)
    found = corpus_pipeline.near_duplicates(spark, docs, path)
    assert found.columns == docs.columns
    expected = [odd[1], odd[5], odd[8], odd[9], odd[10]]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_unlearned_languages_go(spark, planted):
    path, rows, _ = planted
    rng = random.Random(6)
    foreign = lambda n: "".join(rng.choice("qrstuvwxyz") for _ in range(n))
    odd = {100 + n: foreign(n) for n in (4, 13)} | {200 + n: foreign(n) for n in (14, 20, 29, 60, 199, 200, 400)}
    odd |= {1000 + n: rows[3][:n] for n in (6, 13, 14, 20, 29, 60, 199, 200, 400)}
    odd |= {2000: rows[3][:40] + " " + foreign(200), 2001: rows[3][:100] + " " + foreign(150), 2002: "12 34", 2003: "123 " * 60 + rows[3][:30]}
    docs = [(i, t, "xx", "s", 1) for i, t in rows.items() if i < 20] + [(i, t, None, "s", 1) for i, t in odd.items()]
    found = corpus_pipeline.language_id(spark, spark.createDataFrame(docs, SCHEMA), path)
    gone = {i for i, *_ in docs} - {r.doc_id for r in found.collect()}
    # 13 letters are 9 n-grams, too few to tell
    assert gone == {214, 220, 229, 260, 399, 400, 600, 2000, 2002}


# ---- the five stages in plain Python; documents are (doc_id, text, lang, source, n_chars), ids distinct -------------------------


def plain_language(docs):
    def grams(text):
        data = re.sub(rb"[^a-z\x80-\xff]+", b" ", (text or "").lower().encode()).lstrip()
        return [data[i : i + 5] for i in range(len(data) - 4)]

    known = {}
    for i, text, lang, *_ in docs:
        if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            known.setdefault(lang, set()).update(grams(text))  # so few that none is below the least share
    out = []
    for d in docs:
        found = grams(d[1])
        score = max(sum(g in k for g in found) for k in known.values()) / max(len(found), 1)
        if re.search("[a-zA-Z]", d[1] or "") and score >= min(0.2, 0.5 - 1.5 / max(len(found), 1) ** 0.5):
            out.append(d)
    return out


def plain_near(docs):
    of = {i: root for i, _, root in linked([d[:2] for d in docs], 5, 80)}
    return [d for d in docs if of[d[0]] == d[0]]


def plain_repeated(docs, length=100):
    seen, out = set(), []
    for i, text, lang, source, _ in sorted(docs):
        keep = [True] * len(text)
        for at in range(len(text) - length + 1):
            if text[at : at + length] in seen:
                keep[at : at + length] = [False] * length
            seen.add(text[at : at + length])
        text = "".join(c for c, k in zip(text, keep, strict=True) if k)
        out.append((i, text, lang, source, len(text)))
    return out


def plain_clean(docs, items):
    hit = {i for i, _, n, *_ in contaminated([d[:2] for d in docs], items) if n}
    return [d for d in docs if d[0] not in hit]


def plain_mix(docs):
    sizes, out = {}, []
    for d in docs:
        sizes[d[3]] = sizes.get(d[3], 0) + len(d[1].split())
    for source, target in targets(sizes).items():
        passes, budget = divmod(target, sizes[source]) if sizes[source] else (0, 0)
        upto = 0
        for d in sorted((d for d in docs if d[3] == source), key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()[:15]):
            before, upto = upto, upto + len(d[1].split())
            more = budget > 0 and (upto < budget or before < budget and upto - budget <= budget - before)
            if passes + more:
                n = len(d[1].split())
                out.append((*d, n, sizes[source], round(target, 6), int(passes + more), int(passes + more) * n))
    return out


def test_run_equals_plain_stages(spark, tmp_path):
    rng = random.Random(12)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
    words = {lang: [word(letters) for _ in range(500)] for lang, letters in {"aa": "abcdefghij", "bb": "ghijklmnop", "cc": "mnopqrstuv"}.items()}
    say = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    passages = {lang: [say(lang, rng.randint(20, 50)) for _ in range(4)] for lang in words}
    items = [(i, say(rng.choice("abc") * 2, rng.choice([4, 9, 12, 30]))) for i in range(12)] + [(None, say("aa", 15))]
    docs = []
    for i in rng.sample(range(10_000), 260):
        lang = rng.choice("abc") * 2
        text, kind = say(lang, rng.randint(3, 150)), rng.random()
        if kind < 0.12 and docs:
            _, text, lang, *_ = rng.choice(docs)
        elif kind < 0.3 and docs:
            text = (rng.choice(docs)[1] or "none").split()
            for _ in range(rng.randint(1, 4)):
                text[rng.randrange(len(text))] = rng.choice(words[lang])
            text = " ".join(text)
        elif kind < 0.5:
            text += " " + rng.choice(passages[lang]) + " " + say(lang, 10)
        elif kind < 0.6:
            text += " " + rng.choice(items)[1] + ", " + say(lang, 5)
        elif kind < 0.7:
            text = rng.choice([None, "", "12 34", "xyz", "wxyz" * rng.randint(1, 80), "xw zy " * rng.randint(1, 9)])
            lang = None
        docs.append((i, text, lang, rng.choice(["s", "t", "t", "u", None]), len(text or "")))
    path = str(tmp_path)
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")

    want, left = docs, [len(docs)]
    for stage in (plain_language, plain_near, plain_repeated, lambda d: plain_clean(d, items), plain_mix):
        want = stage(want)
        left.append(len(want))
    assert left[0] > left[1] > left[2] == left[3] > left[4] > left[5] > 50  # every stage but the third drops documents
    found = [(*r[:7], round(r.mix_target, 6), r.mix_copies, r.mix_taken) for r in corpus_pipeline.run(spark, path).collect()]
    assert sorted(found, key=lambda d: d[0]) == sorted(want, key=lambda d: d[0])
