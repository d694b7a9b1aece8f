"""Chat formatting by columnar byte assembly.

A turn is written as ``<|turn|>role<|text|>text<|end|>``. A control string starts with ``<|`` and a letter, and in roles and texts every
``<|`` becomes ``<||``, so no text can hold one and reading back is exact. All turns of an Arrow batch are written at once: from the
lengths of headers, roles and texts come the offsets of every segment in one output buffer, every byte is copied to its place by
an index, and the buffer becomes the Arrow column without another copy.

Rows are dealt by ranges of (conversation, turn), so a conversation of any length is cut into parts that follow each other instead of
being gathered by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.llm import words

# The control strings of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

_TURN, _TEXT, _END = (np.frombuffer(s.encode(), np.uint8) for s in (TURN, TEXT, END))
_BATCH_BYTES = 1 << 23


def escape(text: str) -> str:
    return text.replace("<|", "<||")


def unescape(text: str) -> str:
    return text.replace("<||", "<|")


def _escaped(texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes each text takes, and for each byte how many were put in before it in its text, itself included."""
    data = texts.data
    mark = np.zeros(len(data), bool)
    if len(data):
        mark[1:] = (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        inner = texts.offsets[:-1]
        mark[inner[inner < len(data)]] = False  # not across texts
    added = np.concatenate([[0], np.cumsum(mark)])
    return np.diff(texts.offsets) + np.diff(added[texts.offsets]), added


def _scatter(out: np.ndarray, texts: words.Texts, added: np.ndarray, to: np.ndarray) -> None:
    """Copy every text to its place in the buffer, with a second bar behind each ``<``."""
    length = np.diff(texts.offsets)
    shift = np.repeat(to - texts.offsets[:-1] - added[texts.offsets[:-1]], length)
    at = np.arange(len(texts.data)) + shift + added[1:]
    out[at] = texts.data
    put = np.flatnonzero(np.diff(added))
    out[at[put] - 1] = ord("|")


def assemble(roles: words.Texts, texts: words.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer; where each turn begins (one more than turns), and where each text begins and ends."""
    role_size, role_added = _escaped(roles)
    text_size, text_added = _escaped(texts)
    fixed = len(_TURN) + len(_TEXT) + len(_END)
    begin = np.concatenate([[0], np.cumsum(role_size + text_size + fixed)])
    out = np.empty(int(begin[-1]), np.uint8)
    low = begin[:-1] + len(_TURN) + role_size + len(_TEXT)
    high = low + text_size
    for segment, at in ((_TURN, begin[:-1]), (_TEXT, low - len(_TEXT)), (_END, high)):
        out[at[:, None] + np.arange(len(segment))] = segment
    _scatter(out, roles, role_added, begin[:-1] + len(_TURN))
    _scatter(out, texts, text_added, low)
    return out, begin, low, high


def _formatter(trained_roles: Sequence[str]):
    span = pa.struct([("low", pa.int64()), ("high", pa.int64())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts in words.batches(batch.column(2), rows=1 << 16, size=_BATCH_BYTES):
                conv = batch.column(0).slice(texts.first, texts.n)
                role = pc.fill_null(batch.column(1).slice(texts.first, texts.n), "")
                out, begin, low, high = assemble(words.buffer_of(role), texts)
                ids = pc.fill_null(conv, 0).to_numpy()
                null = conv.is_null().to_numpy(zero_copy_only=False)
                first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])]))
                edges = np.append(first, texts.n)
                start = np.repeat(begin[first], np.diff(edges))
                loss = np.flatnonzero(pc.is_in(role, pa.array(list(trained_roles), pa.string())).to_numpy(zero_copy_only=False))
                spans = pa.StructArray.from_arrays([pa.array(low[loss] - start[loss]), pa.array(high[loss] - start[loss])], fields=list(span))
                formatted = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(begin[edges].astype(np.int64)), pa.py_buffer(out)])
                yield pa.record_batch(
                    [
                        conv.take(pa.array(first)),
                        np.arange(part, part + len(first)),
                        np.diff(edges),
                        formatted.cast(pa.string()),
                        pa.ListArray.from_arrays(np.searchsorted(loss, edges).astype(np.int32), spans),
                    ],
                    names=["conv_id", "part", "n_turns", "formatted", "loss"],
                )
                part += len(first)

    return over, "conv_id long, part long, n_turns long, formatted string, loss array<struct<low:long,high:long>>"


def format_parts(turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text", trained_roles=("assistant",)) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss): a conversation's turns in order, as one or more parts; their texts in the order of ``part`` follow
    each other. ``loss`` has the byte ranges [low, high) of ``formatted`` to train on, the texts of ``trained_roles``.

    Turns go by number, null first; of equal ones by role, then by a hash of the text, then by text. Null roles and texts are empty; rows
    with a null id are one conversation. Repeated rows are turns of their own. Other columns are not read.
    """
    rows = turns.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
        F.col(turn_col).cast("long").alias("turn"),
        F.xxhash64(text_col).alias("tie"),
    )
    rows = rows.repartitionByRange("conv_id", "turn", "role", "tie").sortWithinPartitions("conv_id", "turn", "role", "tie", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(*_formatter(trained_roles))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a part."""
    turns = []
    for turn in formatted.split(END)[:-1]:
        role, _, text = turn[len(TURN) :].partition(TEXT)
        turns.append((unescape(role), unescape(text)))
    return turns


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, spans: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text in read_back(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        data = formatted.encode()
        for s in spans:
            text = unescape(data[s["low"] : s["high"]].decode())
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self):
        return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGEST = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        for conv, formatted, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv)
            now.add(formatted, spans)
        yield pa.RecordBatch.from_pylist([dict(zip([n for n, _ in _DIGEST], r, strict=True)) for r in done], pa.schema(_DIGEST))
        done = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip([n for n, _ in _DIGEST], now.row(), strict=True))], pa.schema(_DIGEST))


def report(parts: DataFrame) -> DataFrame:
    """Digests per conversation, read back from the formatted parts. A task hashes its conversations part by part and holds one part."""
    parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return parts.mapInArrow(_digests, schema)


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(23 + length(replace(role, '<|', '<||')) + length(replace(text, '<|', '<||')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
