"""Language identification with bit-sliced n-gram Bloom filters.

One table of slots serves all languages: a slot is a bitmask with one bit, or slice, per language, and an n-gram sets
its language's bit in ``HASHES`` slots. The bitwise *and* of an n-gram's slots names every language that may contain
it, in one lookup. For a text, a language's count of n-grams (the population of its slice) is corrected for the false positives
that its share of set bits predicts; the language with the largest corrected count is the answer.

The filter holds the n-grams that make up at least ``MIN_SHARE`` of a language's n-grams in the training texts, so at most
1 / MIN_SHARE of each, and has a fixed number of slots: what is sent to the tasks does not grow with the data. All training texts are
counted, whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteatlas.llm import words
from siteatlas.session import persist_reliably

N = 5  # bytes of an n-gram
HASHES = 3
MIN_SHARE = 4e-6
SLOT_BITS = 22
_HELD = 1 << 21  # distinct n-grams that a task holds before it passes counts on

#: Bytes of words: ASCII letters and everything beyond ASCII.
_LETTER = ~words.byte_class("00-40 5B-60 7B-7F")


def _grams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, bounds): the n-grams of runs of texts, over lower-case words with one space around each."""
    for batch in words.batches(pc.utf8_lower(texts.cast(pa.large_string())), rows=1 << 14):
        letter = _LETTER[batch.data]
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # what ends a word counts as its space
        at = np.flatnonzero(keep)
        data = np.where(letter[at], batch.data[at], np.uint8(32))
        bounds = np.searchsorted(at, batch.offsets)
        hashes = words.grams(words.BYTE[data], N)
        doc = words.owner(bounds)
        inside = doc[: len(hashes)] == doc[N - 1 :] if len(hashes) else np.empty(0, bool)
        yield batch.first, hashes[inside], np.searchsorted(doc[: len(inside)][inside], np.arange(batch.n + 1))


def _counted(languages: list[str]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        index = {name: i for i, name in enumerate(languages)}

        def flush():
            for language, (grams, counts) in held.items():
                yield pa.record_batch([np.full(len(grams), language, np.int32), grams.view(np.int64), counts], names=["language", "gram", "n"])
            held.clear()

        for batch in batches:
            of = np.array([index[x] for x in batch.column(1).to_pylist()], np.int64)
            for language in np.unique(of):
                texts = batch.column(0).take(pa.array(np.flatnonzero(of == language)))
                for _, hashes, _ in _grams(texts):
                    grams, counts = np.unique(hashes, return_counts=True)
                    if language in held:
                        old, n = held[language]
                        grams, place = np.unique(np.concatenate([old, grams]), return_inverse=True)
                        counts = np.bincount(place, np.concatenate([n, counts]), len(grams)).astype(np.int64)
                    held[language] = grams, counts
            if sum(len(g) for g, _ in held.values()) > _HELD:
                yield from flush()
        yield from flush()

    return over, "language int, gram long, n long"


@dataclass
class LanguageModel:
    languages: list[str]  # in the order of their bits
    table: np.ndarray  # (slots, words of 64 languages); narrower for up to 32 languages
    false_rate: np.ndarray  # per language
    prior: int  # the language with most training text, for texts that hold no known n-gram

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For every n-gram the bitmask of the languages that may contain it."""
        out = None
        for i in range(HASHES):
            slots = self.table[_slot(hashes, i)]
            out = slots if out is None else out & slots
        return out


def _slot(hashes: np.ndarray, i: int) -> np.ndarray:
    """Slots by double hashing."""
    a, b = hashes >> np.uint64(64 - SLOT_BITS), hashes << np.uint64(SLOT_BITS) >> np.uint64(64 - SLOT_BITS)
    return ((a + np.uint64(i) * (b | np.uint64(1))) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _kind(n: int):
    return next(kind for size, kind in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (1 << 30, np.uint64)) if n <= size)


def train(texts: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """The filter of all rows with a text and a language. The number of languages is taken to be small."""
    words.bound_arrow_batches(texts.sparkSession)
    rows = texts.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    counted = rows.mapInArrow(*_counted(languages)).groupBy("language", "gram").agg(F.sum("n").alias("n"))
    counted = persist_reliably(counted)
    totals = {r["language"]: r["n"] for r in counted.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    kind = _kind(len(languages))
    width = -(-len(languages) // 64)
    table = np.zeros((1 << SLOT_BITS, width), kind)
    for i in range(len(languages)):
        least = MIN_SHARE * totals.get(i, 0)
        grams = counted.filter((F.col("language") == i) & (F.col("n") >= least)).select("gram").toArrow()["gram"].to_numpy()
        for j in range(HASHES):
            table[_slot(grams.view(np.uint64), j), i // 64] |= kind(1 << (i % 64))
    bits = [np.count_nonzero(table[:, i // 64] & kind(1 << (i % 64))) for i in range(len(languages))]
    rate = (np.array(bits) / len(table)) ** HASHES
    prior = max(totals, key=lambda i: (totals[i], -i), default=0)
    return LanguageModel(languages, table[:, 0] if width == 1 else table, rate, prior)


def column(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """struct<lang_pred, score, n_grams> of a text column; see ``predict``. ``n_grams`` is how many n-grams the score is a share of."""
    broadcast = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,n_grams:bigint>")
    def predicted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = broadcast.value
        names = pa.array([*m.languages, "und"], pa.string())
        for column in columns:
            texts = pc.fill_null(column, "")
            lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            best, score, counts = np.full(len(texts), len(m.languages)), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for first, hashes, bounds in _grams(texts) if m.languages else ():
                masks = m.masks(hashes)
                n = np.diff(bounds)
                found = np.empty((len(n), len(m.languages)))
                for i, rate in enumerate(m.false_rate):
                    words64 = masks[:, i // 64] if masks.ndim == 2 else masks
                    hits = np.concatenate([[0], np.cumsum(words64 >> words64.dtype.type(i % 64) & words64.dtype.type(1), dtype=np.int64)])
                    found[:, i] = np.maximum(0, (hits[bounds[1:]] - hits[bounds[:-1]] - n * rate) / max(1 - rate, 1e-9))
                top = found.argmax(axis=1)
                most = found[np.arange(len(n)), top]
                rows = slice(first, first + len(n))
                best[rows] = np.where(most > 0, top, m.prior)
                score[rows], counts[rows] = np.minimum(1.0, most / np.maximum(n, 1)), n
            best[~lettered], score[~lettered] = len(m.languages), 0
            yield pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(score), pa.array(counts)], names=["lang_pred", "score", "n_grams"])

    return predicted(text.cast("string"))


def predict(docs: DataFrame, model: LanguageModel, columns: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``columns`` with lang_pred and score (the share of the text's n-grams that the language knows, 0 to 1), one row per row.

    ``und``, with score 0, is a text that is null, or has no letter, or for which nothing was learned. A text without any known n-gram gets
    the language with most training text and score 0; of equal languages the first by name.
    """
    found = docs.select(*columns, column(docs.sparkSession, model, F.col(text_col)).alias("__found"))
    return found.select(*columns, "__found.lang_pred", "__found.score")


def held_out(id_col: str = "doc_id"):
    """True for the fourth of the ids that nothing is learned from; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """The model of the labelled rows that are not held out and have an id."""
    return train(docs.filter(~held_out(id_col) & F.col(id_col).isNotNull()), text_col, lang_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id_col, held_out, lang_pred, score): learned from labelled rows that are not held out, predicted for all rows."""
    out = predict(docs, learn(docs, id_col, text_col, lang_col), (id_col,), text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
