"""Passages that repeat across documents, by the suffixes of a sparse suffix array over minimiser positions.

Of all suffixes of a text only those at minimisers are retained: the word whose
eight-word gram hashes lowest among the starts in some window of ``length``
words, leftmost of equals.  Equal windows choose the same place, so no repeated
passage of ``length`` words is without a common retained suffix.  Each retained
suffix stands for a stretch: the windows that chose it and the words they cover.
The suffixes are not sorted and no neighbours are compared: the sorted order is
replaced by grouping on hashes of gram and stretch, since a common passage would
make one long run of neighbours in a sorted order, and the next suffix alone
misses passages whose two sides have different partners.  Suffixes whose whole
stretch is equal are matched at once, to the left and to the right.  Where a gram stands in different stretches, at the edges
of a passage, a text of each different stretch is read again, and the match is
extended window by window as far as it goes on either side.

All comparisons are grouped counts (combined before the shuffle) and joins on
fingerprints of 128 bits, gram and stretch or gram and window; a passage that a
third of all documents share is one row per document there, and no pair of
documents is ever formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WordHashes, gram_hashes, pieces_of, text_bytes, written

LENGTH, GRAM = 50, 8
#: Ids of documents to read again that are sent to every task (8 MB); more are joined by shuffle.
MAX_BROADCAST_IDS = 1 << 20
_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 16


class Fingerprints:
    """Fingerprints of stretches of one text from prefix sums (arithmetic modulo 2**64)."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        powers = np.ones(n + 1, dtype=np.uint64)
        powers[1:] = _BASE
        backs = np.ones(n + 1, dtype=np.uint64)
        backs[1:] = _BACK
        np.cumprod(powers, out=powers)
        self.backs = np.cumprod(backs)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.backs[start] + (end - start).astype(np.uint64)


def _lowest(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the place of its lowest, leftmost of equals."""
    n = len(grams) - width + 1
    out = np.empty(n, dtype=np.int64)
    for at in range(0, n, _SLICE):
        part = grams[at : at + _SLICE + width - 1]
        found = sliding_window_view(part, width).argmin(axis=1)
        out[at : at + len(found)] = found + np.arange(at, at + len(found))
    return out


def retained(words: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(place, first window, last window, gram hash, stretch fingerprint) of each retained suffix."""
    if len(words) < length:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, empty, empty
    grams = gram_hashes(words, gram)
    lowest = _lowest(grams, length - gram + 1)
    first = np.flatnonzero(np.r_[True, lowest[1:] != lowest[:-1]])
    last = np.r_[first[1:], len(lowest)] - 1
    place = lowest[first]
    stretch = Fingerprints(words).of(first, last + length)
    return place, first, last, grams[place].view(np.int64), stretch.view(np.int64)


_SUFFIX = "doc_id long, place long, first long, last long, gram long, stretch long"


def _suffixes(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = [f.split()[0] for f in _SUFFIX.split(", ")]

    def run(batches):
        hashes = WordHashes()
        for whole in batches:
            for batch in pieces_of(whole):
                cols: list[list[np.ndarray]] = [[] for _ in names]
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    found = retained(hashes.of(text.lower().split()), length, gram)
                    cols[0].append(np.full(len(found[0]), doc, dtype=np.int64))
                    for col, values in zip(cols[1:], found, strict=True):
                        col.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in cols], names=names)

    return docs.mapInArrow(run, _SUFFIX)


def _windows(docs: DataFrame, stretches: DataFrame, length: int) -> DataFrame:
    """(gram, offset, window, doc_id, start, low, high): every window of the wanted stretches (doc_id, first, last, place, ...)."""
    parts = F.struct("place", "first", "last", "gram", "stretch", "low", "high")
    one = stretches.groupBy("doc_id").agg(F.collect_list(parts).alias("wanted"))
    one = written(one, "wanted")
    few = one.count() <= MAX_BROADCAST_IDS
    ids = one.select("doc_id")
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").join(one, "doc_id")
    names = ["gram", "offset", "window", "doc_id", "start", "low", "high"]

    def run(batches):
        hashes = WordHashes()
        for whole in batches:
            for batch in pieces_of(whole, rows=64):
                cols: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in names]
                rows = zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "wanted")], strict=True)
                for doc, text, wanted in rows:
                    words = hashes.of(text.lower().split())
                    prints = Fingerprints(words)
                    for w in wanted:
                        start = np.arange(w["first"], w["last"] + 1)
                        edges = np.array([w["first"]]), np.array([w["last"] + length])
                        # of several texts with one id, the one that the stretch is from
                        if edges[1][0] > len(words) or prints.of(*edges).view(np.int64)[0] != w["stretch"]:
                            continue
                        n = len(start)
                        prints_at = prints.of(start, start + length).view(np.int64)
                        same = [np.full(n, x) for x in (w["gram"], doc, w["low"], w["high"])]
                        values = (same[0], w["place"] - start, prints_at, same[1], start, *same[2:])
                        for col, v in zip(cols, values, strict=True):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in cols], names=names)

    return texts.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _other(own: str = "doc_id"):
    """The lowest document of the group, or the highest where the row is from the lowest."""
    return F.when(F.col("low") != F.col(own), F.col("low")).otherwise(F.col("high")).alias("other")


def repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per passage: ``doc_id, start_word, end_word, n_words, other_doc_id``.

    A passage is a maximal stretch of words [start_word, end_word) of a document
    in which every run of ``length`` words within it that makes it up occurs in
    another document too; ``other_doc_id`` is one such document (the lowest
    known for its beginning).  Words are runs of anything but ASCII white space,
    A-Z lower-cased.  Null, empty and shorter texts have no passage; repeats
    within one document alone, rows that repeat a doc_id among them, do not
    count; rows without a doc_id are not looked at.  Further columns of ``docs``
    are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text"))
    texts = texts.filter("doc_id is not null and text is not null")
    suffixes = written(_suffixes(texts, length, gram), "suffixes")

    # Compare: grams that stand in several documents, and whether their stretches are all equal.
    span = [F.min("doc_id").alias("low"), F.max("doc_id").alias("high")]
    grams = suffixes.groupBy("gram").agg(*span, F.min("stretch").alias("s"), F.max("stretch").alias("t"))
    # Written, as all counts that are joined back, so that the join has a shuffle of its own on
    # either side and a gram that a third of the suffixes share can be split over tasks.
    grams = written(grams.filter("low != high").select("gram", (F.col("s") != F.col("t")).alias("mixed")), "grams")
    shared = written(suffixes.join(grams, "gram"), "shared")
    stretches = shared.groupBy("gram", "stretch", "mixed").agg(*span, F.min(F.struct("doc_id", "place", "first", "last")).alias("one"))
    stretches = written(stretches, "stretches")
    whole = stretches.filter("low != high").select("gram", "stretch", "low", "high")
    spans = shared.join(whole, ["gram", "stretch"]).select("doc_id", F.col("first").alias("start"), (F.col("last") + length).alias("end"), _other())

    # Extend, window by window: every place of a stretch that one document alone has, one place of any other stretch.
    lone = stretches.filter("mixed and low = high").select("gram", "stretch")
    cols = ["gram", "stretch", "doc_id", "place", "first", "last"]
    edges = shared.filter("mixed").join(lone, ["gram", "stretch"], "left_semi")
    edges = edges.select(*cols, F.col("doc_id").alias("low"), F.col("doc_id").alias("high"))
    edges = edges.union(stretches.filter("mixed and low != high").select("gram", "stretch", "one.*", "low", "high"))
    windows = written(_windows(texts, edges, length), "windows")
    key = ["gram", "offset", "window"]
    alone = F.col("low") == F.col("high")
    met = windows.groupBy(key).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or(alone).alias("alone"))
    met = written(met.filter("alone and low != high").drop("alone"), "met")
    ends = windows.filter(alone).drop("low", "high").join(met, key)
    ends = ends.select("doc_id", "start", (F.col("start") + length).alias("end"), _other())
    found = written(spans.union(ends), "spans")

    # Join what overlaps within a document.
    step = F.struct(F.col("start"), F.col("end"), F.col("other"))
    lists = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(step)).alias("spans"))

    def joined(batches):
        names = ["doc_id", "start_word", "end_word", "n_words", "other_doc_id"]
        for whole_batch in batches:
            for batch in pieces_of(whole_batch):
                out = []
                for doc, spans_of in zip(batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                    merged: list[list[int]] = []
                    for s in spans_of:
                        if merged and s["start"] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s["end"])
                        else:
                            merged.append([s["start"], s["end"], s["other"]])
                    out += [(doc, a, b, b - a, o) for a, b, o in merged]
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return lists.mapInArrow(joined, "doc_id long, start_word long, end_word long, n_words long, other_doc_id long")
