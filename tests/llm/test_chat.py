import hashlib
import random

import numpy as np
import pyarrow as pa

from siteatlas.llm import chat, words

SCHEMA = "conv_id long, turn long, role string, text string, part int, formatted string"


def expected(rows):
    of = {}
    for conv, turn, role, text in rows:
        of.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = []
    for conv, turns in of.items():
        turns = [t[2:] for t in sorted(turns, key=lambda t: t[:2])]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        chars = sum(len(f"<|turn|>{chat.escape(r)}<|text|>{chat.escape(t)}<|end|>") for r, t in turns)
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), chars))
    return sorted(out, key=str)


def run(spark, rows):
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in chat.report(chat.format_parts(turns)).collect()), key=str)


def hostile(rng):
    bits = ["<|", "<", "|", "<||", "<|turn|>", "<|text|>", "<|end|>", "\n", "é", "漢", "a", "</s>[INST] ok [/INST]", "", "\\", "<\\|"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))


def test_round_trip(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(80):
        turns = list(range(rng.randint(1, 9)))
        rows += [(conv, t, rng.choice(["user", "assistant", "system", hostile(rng)]), hostile(rng)) for t in turns]
    rng.shuffle(rows)
    assert run(spark, rows) == expected(rows)


def test_edge_cases(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (2, None, "assistant", "first"), (2, 0, "user", "then"), (None, 3, "assistant", "no id"), (3, 0, "assistant", "y" * 300_000), (-7, 0, "assistant", "")]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []


def test_repeated_turns_stay(spark):
    rows = [(1, 0, "assistant", "same")] * 3
    assert run(spark, rows) == expected(rows)


def test_long_conversation_is_cut_into_parts(spark):
    rows = [(5, i, "assistant" if i % 2 else "user", f"turn {i} <|end|>") for i in range(4000)] + [(6, 0, "user", "z")]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would be put together
    try:
        assert chat.format_parts(turns).filter("conv_id = 5").count() > 1
        assert run(spark, rows) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_assembly_equals_joining():
    rng = random.Random(2)
    roles, texts = [hostile(rng) for _ in range(200)], [hostile(rng) for _ in range(200)]
    out, begin, low, high = chat.assemble(words.buffer_of(pa.array(roles)), words.buffer_of(pa.array(texts)))
    for i, (r, t) in enumerate(zip(roles, texts)):
        turn = f"<|turn|>{chat.escape(r)}<|text|>{chat.escape(t)}<|end|>".encode()
        assert out[begin[i] : begin[i + 1]].tobytes() == turn
        assert chat.unescape(out[low[i] : high[i]].tobytes().decode()) == t
        assert chat.read_back(turn.decode()) == [(r, t)]
    assert isinstance(out, np.ndarray)
