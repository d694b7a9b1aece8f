"""Token counts by a linear longest-match automaton.

The vocabulary is a trie. Where the next byte has no edge, greedy longest match would put out some tokens and go on behind them; each node
knows how many (its popped tokens) and where in the trie that ends (its failure link), so a word is read once, byte by byte, and no piece is
ever built. The automaton runs on all distinct words of a batch in lock step, and counts of words seen before are looked up.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.llm import words

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_KNOWN = 1 << 20  # words whose counts a task keeps


def read_vocabulary(path: str) -> list[bytes]:
    """Tokens of a file with lines of base64 and rank."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@dataclass
class Automaton:
    """``edges`` are sorted (node * 256 + byte) with their ``targets``; ``popped`` and ``link`` per node (link -1: no token fits);
    ``rest``: tokens that a word ending at a node still gives (-1: it can't be finished)."""

    edges: np.ndarray
    targets: np.ndarray
    popped: np.ndarray
    link: np.ndarray
    rest: np.ndarray

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The edge's end, or -1."""
        key = nodes * 256 + letters
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.targets[at], -1)

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: bytes = b"") -> np.ndarray:
        """Tokens of the words [start, end), each read behind ``lead``; a word that can't be finished is one unknown token."""
        node = np.zeros(len(starts), np.int64)
        total = np.zeros(len(starts), np.int64)
        unknown = np.zeros(len(starts), bool)
        order = np.argsort(starts - ends, kind="stable")  # long words first, so that those still read are a prefix
        size = (ends - starts)[order]
        for j in range(len(lead) + int(size.max(initial=0))):
            live = np.arange(len(starts)) if j < len(lead) else np.arange(np.searchsorted(-size, -(j - len(lead))))
            live = live[~unknown[live]]
            letters = np.full(len(live), lead[j], np.int64) if j < len(lead) else data[starts[order[live]] + j - len(lead)].astype(np.int64)
            while len(live):
                to = self.step(node[live], letters)
                moved = to >= 0
                node[live[moved]] = to[moved]
                live, letters = live[~moved], letters[~moved]
                total[live] += self.popped[node[live]]
                node[live] = self.link[node[live]]
                lost = node[live] < 0
                unknown[live[lost]] = True
                live, letters = live[~lost], letters[~lost]
        rest = np.where(unknown, -1, self.rest[np.maximum(node, 0)])
        total = np.where(rest < 0, 1, total + rest)
        out = np.empty(len(starts), np.int64)
        out[order] = total
        return out


def automaton(vocabulary: Iterable[bytes]) -> Automaton:
    """Trie, failure links and popped counts. The root has no link: a word stuck there has an unknown byte."""
    children, token = [{}], [False]
    for piece in vocabulary:
        node = 0
        for byte in piece:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                token.append(False)
            node = children[node][byte]
        token[node] = node != 0
    link, popped = [-1] * len(children), [0] * len(children)
    queue = deque([0])
    while queue:
        parent = queue.popleft()
        for byte, node in children[parent].items():
            queue.append(node)
            if token[node]:
                link[node], popped[node] = 0, 1
                continue
            at, n = link[parent], popped[parent]
            while at >= 0 and byte not in children[at]:
                n += popped[at]
                at = link[at]
            if at >= 0:
                link[node], popped[node] = children[at][byte], n
    rest = [0] * len(children)
    for node in range(1, len(children)):
        n, at = 0, node
        while at > 0:
            n += popped[at]
            at = link[at]
        rest[node] = n if at == 0 else -1
    edges = sorted((node * 256 + byte, to) for node, of in enumerate(children) for byte, to in of.items())
    keys, targets = (np.array(x, np.int64) for x in (zip(*edges, strict=True) if edges else ([-1], [0])))
    return Automaton(keys, targets, np.array(popped), np.array(link), np.array(rest))


def _counted(machine, lead: bytes):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            for texts in words.batches(batch.column(0), rows=1 << 16):
                starts, ends, bounds = texts.words(words.NOT_SPACE)
                hashes, _ = texts.word_hashes(words.NOT_SPACE, words.BYTE)
                distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
                at = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
                new = np.flatnonzero(known[at] != distinct) if len(known) else np.arange(len(distinct))
                if len(new):
                    n = machine.value.count(texts.data, starts[first[new]], ends[first[new]], lead)
                    if len(known) + len(new) > _KNOWN:
                        known, counts = known[:0], counts[:0]
                        new, n = np.arange(len(distinct)), machine.value.count(texts.data, starts[first], ends[first], lead)
                    known, counts = np.concatenate([known, distinct[new]]), np.concatenate([counts, n])
                    order = np.argsort(known)
                    known, counts = known[order], counts[order]
                    at = np.searchsorted(known, distinct)
                total = np.concatenate([[0], np.cumsum(counts[at][place] if len(hashes) else np.empty(0, np.int64))])
                rows = [c.slice(texts.first, texts.n) for c in batch.columns[1:]]
                yield pa.record_batch([*rows, np.diff(bounds), np.diff(total[bounds])], names=[*batch.schema.names[1:], "n_words", "n_tokens"])

    return over


def count_tokens(docs: DataFrame, vocabulary: Iterable[bytes], columns=("doc_id",), text_col: str = "text", lead: bytes = b" ") -> DataFrame:
    """``columns`` with n_words and n_tokens: greedy longest-match tokens of every word, a word being read behind ``lead``.

    Words are runs of anything but ASCII white space, case matters. A word in which some byte starts no token is one unknown token.
    Null and empty texts have none. Words are told apart by 64-bit hashes.
    """
    words.bound_arrow_batches(docs.sparkSession)
    machine = docs.sparkSession.sparkContext.broadcast(automaton(vocabulary))
    texts = docs.select(F.col(text_col).cast("string").alias("__text"), *columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[1:])
    return texts.mapInArrow(_counted(machine, lead), f"{schema}, n_words long, n_tokens long")
