"""Language identification with language-bitmask n-gram filters.

One Bloom filter serves all languages: its slots hold a bit a language, so that the AND of an n-gram's slots names all languages that
contain it (a bit-sliced filter). Of a text, all n-grams of all its letters are looked up; per language the hits are counted, corrected for the
language's false-positive rate, and the largest corrected count decides.

Learning: at most `sample` documents a language (the smallest xxhash64 of their doc_id), an equal share of `SAMPLE_BYTES` for each, on the driver, of the `most` most
frequent languages. Prediction is one pass without a shuffle; the filter has a byte a slot for up to 8 languages, then 2, 4, 8, and a word of 8 for each 64
languages beyond: 32 MB for the 256 languages that `most` allows unless it is raised.

Defined cases: null text, or text without a letter: `und`, score 0. A text too short for an n-gram: the most frequent language
among those learned from, score 0. A null lang is not learned from; without learned languages every text is `und`. A null doc_id is never held
out and not learned from. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfold.llm import arrowtext as at
from wayfold.llm.common import SAMPLE_BYTES, in_arrow, within

GRAM, HASHES, SLOTS = 5, 3, 1 << 20
_MULTS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x61:0x7B] = _PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_PLAIN[0x80:] = np.arange(0x80, 0x100)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x61:0x7B] = _ASCII_LETTER[0x41:0x5B] = True


class Filter(NamedTuple):
    languages: list[str]
    slots: np.ndarray  # a row for each word of masks
    false_rate: np.ndarray
    common: int


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte n-grams that hold a letter, and for each text the index of its first n-gram (one more at the end)."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    plain = _PLAIN[data]
    wide = plain.astype(np.uint32)
    code = wide[:n] * np.uint32(1)
    for k in range(1, GRAM):
        code = code * np.uint32(0x01000193) ^ wide[k : k + n]
    letter = plain != 0x20
    good = letter[:n].copy()
    good[:-1] |= letter[1:n]  # at most one space before the first letter
    for k in range(1, GRAM):  # none reaches over the end of a text
        over = offsets[1:-1] - k
        good[over[(over >= 0) & (over < n)]] = False
    places = np.flatnonzero(good)
    return code[places], np.searchsorted(places, offsets)


def slots_of(code: np.ndarray) -> Iterator[np.ndarray]:
    shift = np.uint32(32 - (SLOTS.bit_length() - 1))
    for m in _MULTS:
        x = (code ^ (code >> np.uint32(15))) * m
        yield (x ^ (x >> np.uint32(13))) * m >> shift


def learn(samples: dict[str, list[str]], sizes: dict[str, int]) -> Filter:
    """sizes: the number of documents of each language, which decides where no n-gram can."""
    languages = sorted(samples)
    kind = next((t for bits, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32)) if len(languages) <= bits), np.uint64)
    width = 8 * kind().itemsize
    slots = np.zeros((max(1, -(-len(languages) // width)), SLOTS), kind)
    for k, language in enumerate(languages):
        raw = [t.encode() for t in samples[language]]
        data = np.frombuffer(b"".join(raw), np.uint8)
        code, _ = grams(data, np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))
        code = np.unique(code)
        for s in slots_of(code):
            slots[k // width, s] |= kind(1 << k % width)
    fill = np.array([((slots[k // width] >> kind(k % width)) & kind(1)).mean() for k in range(len(languages))])
    common = max(range(len(languages)), key=lambda k: (sizes.get(languages[k], 0), -k), default=0)
    return Filter(languages, slots, fill**HASHES, common)


def counts(filter_: Filter, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the number of n-grams, and per language the corrected number of n-grams that it contains."""
    code, first = grams(data, offsets)
    n = np.diff(first)
    out = np.zeros((len(n), len(filter_.languages)))
    if len(code):
        some, places = np.flatnonzero(n), list(slots_of(code))
        width = 8 * filter_.slots.itemsize
        for word, slots in enumerate(filter_.slots):
            masks = slots[places[0]] & slots[places[1]] & slots[places[2]]
            one = masks.dtype.type(1)
            for k in range(word * width, min(len(filter_.languages), (word + 1) * width)):
                bits = (masks >> masks.dtype.type(k % width)) & one
                out[some, k] = np.add.reduceat(bits, first[:-1][some], dtype=np.int64)
        out = np.clip((out - n[:, None] * filter_.false_rate) / (1 - np.minimum(filter_.false_rate, 0.99)), 0, None)
    return n, out


def has_letter(chunk: at.Chunk) -> np.ndarray:
    n = chunk.rows.num_rows
    sums = np.concatenate(([0], np.cumsum(_ASCII_LETTER[chunk.data])))
    found = sums[chunk.offsets[1:]] > sums[chunk.offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(chunk.offsets) > 0)).tolist():
        found[i] = any(c.isalpha() for c in chunk.text(i).decode(errors="replace"))
    return found[:n]


def predict(docs: DataFrame, filter_: Filter, *extra: Column) -> DataFrame:
    """doc_id, lang_pred, score of each document, after any `extra` columns given."""
    schema = "doc_id long, lang_pred string, score double"

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*filter_.languages, "und"], object)
        for chunk in at.chunks(batches, limit=1 << 20):
            letters = has_letter(chunk)
            n, found = counts(filter_, chunk.data, chunk.offsets)
            if filter_.languages:
                best = np.where(found.max(axis=1) > 0, found.argmax(axis=1), filter_.common)
                total = found.sum(axis=1)
                share = np.where(total > 0, found.max(axis=1) / np.maximum(total, 1e-9), 0.0)
                best[~letters], share[~letters] = len(names) - 1, 0.0
            else:
                best, share = np.zeros(len(n), np.int64), np.zeros(len(n))
            yield pa.RecordBatch.from_arrays([chunk.rows.column(0), pa.array(names[best], pa.string()), pa.array(np.clip(share, 0.0, 1.0))], names=["doc_id", "lang_pred", "score"])

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), make, schema)


def held_out(divisor: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == remainder, F.lit(False))


def fit(docs: DataFrame, sample: int = 300, most: int = 256) -> Filter:
    """Learns from at most `sample` documents a language of those given with text and lang, of the `most` most frequent languages."""
    text, lang = F.col("text").cast("string"), F.col("lang").cast("string")
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("text_hash"))
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(most).collect()}
    if not sizes:
        return learn({}, {})
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text_hash"))
    rows = known.where(F.col("lang").isin(list(sizes))).withColumn("place", place).where(F.col("place") <= sample).collect()
    ids = []
    for language in sizes:
        mine = sorted((r for r in rows if r.lang == language), key=lambda r: r.place)
        ids += [(r.doc_id, r.lang, r.text_hash) for r, fits in zip(mine, within([r.bytes for r in mine], SAMPLE_BYTES // len(sizes)), strict=True) if fits]
    samples: dict[str, list[str]] = {language: [] for language in sizes}
    if ids:
        chosen = docs.sparkSession.createDataFrame(ids, "doc_id long, lang string, text_hash long").distinct()
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
        found = texts.join(F.broadcast(chosen), ["doc_id", "lang", "text_hash"], "left_semi").collect()
        for r in sorted(found, key=lambda r: (r.lang, r.doc_id, r.text)):
            samples[r.lang].append(r.text)
    return learn(samples, sizes)


def identify(docs: DataFrame, sample: int = 300, divisor: int = 4, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that are not held out."""
    out = held_out(divisor, remainder)
    filter_ = fit(docs.where(~out), sample)
    return predict(docs, filter_).select("doc_id", out.alias("held_out"), "lang_pred", "score")
