"""Benchmark passages in documents, found by Wu-Manber multi-pattern search.

Texts are normalised to lower-case (A-Z) words joined by single spaces, with a
space at either end, so that a pattern " w1 w2 ... " matches whole words only.
The patterns are the windows of ``n`` consecutive words of the benchmark items;
an item of fewer words is one window.  Patterns of similar length share a
matcher: a shift table over blocks of bytes tells how far the search may jump,
blocks that end some pattern's shortest common length select a bucket of test
strings, and direct comparison confirms.  Short windows thus never shorten the
jumps of long ones.

The windows reach the executors in blocks of at most ``block_bytes``: a
benchmark beyond that is searched in several passes over the documents, each
with one block, instead of one unbounded broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import pieces_of, written

WINDOW = 10
BLOCK_BYTES = 24 << 20

#: ASCII letters (as lower case), digits and all other bytes from 0x80 on make words; the rest is a break.
_KEEP = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_KEEP).split() if text else []


def windows_of(words: list[bytes], n: int) -> set[bytes]:
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + n]) + b" " for i in range(max(1, len(words) - n + 1))}


class Matcher:
    """Wu-Manber tables of patterns that are at least ``m`` bytes long."""

    def __init__(self, patterns: list[bytes]):
        self.m = min(map(len, patterns))
        self.block = min(8, max(1, self.m // 2))
        self.most = self.m - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, list[bytes]] = {}
        for p in patterns:
            for end in range(self.block, self.m + 1):
                key = p[end - self.block : end]
                if self.m - end < self.shift.get(key, self.most):
                    self.shift[key] = self.m - end
            self.buckets.setdefault(p[self.m - self.block : self.m], []).append(p)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(position, pattern) of each occurrence."""
        block, most, jump, end, n = self.block, self.most, self.shift.get, self.m, len(text)
        while end <= n:
            key = text[end - block : end]
            far = jump(key, most)
            if far:
                end += far
                continue
            at = end - self.m
            for p in self.buckets[key]:
                if text.startswith(p, at):
                    yield at, p
            end += 1


class Matchers:
    """One matcher for each power of two of the pattern length; items by pattern."""

    def __init__(self, items: dict[bytes, list[str]]):
        self.items = items
        by: dict[int, list[bytes]] = {}
        for p in items:
            by.setdefault(len(p).bit_length(), []).append(p)
        self.parts = [Matcher(by[k]) for k in sorted(by)]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans [start, end) of the occurrences, and the items they belong to."""
        text = b" " + b" ".join(words) + b" "
        hits = [hit for part in self.parts if part.m <= len(text) for hit in part.find(text)]
        if not hits:
            return [], set()
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
        starts = np.searchsorted(spaces, [at for at, _ in hits]).tolist()
        spans = [(s, s + p.count(b" ") - 1) for s, (_, p) in zip(starts, hits, strict=True)]
        return spans, {i for _, p in hits for i in self.items[p]}


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _windows(benchmark: DataFrame, n: int) -> DataFrame:
    """Distinct (window, item) rows; an item without an id has a null item."""

    def run(batches):
        for batch in batches:
            found = [
                (w, i)
                for i, t in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for w in windows_of(words_of(t), n)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.binary()), pa.array([i for _, i in found], pa.string())], ["window", "item"]
            )

    cols = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    return cols.mapInArrow(run, "window binary, item string").distinct()


def _blocks(windows: DataFrame, block_bytes: int) -> Iterator[dict[bytes, list[str]]]:
    """The windows in blocks that the driver and a task can hold."""
    block: dict[bytes, list[str]] = {}
    held = 0
    for row in windows.toLocalIterator():
        if held >= block_bytes:
            yield block
            block, held = {}, 0
        w = bytes(row.window)
        held += (len(w) if w not in block else 0) + 32
        block.setdefault(w, []).extend([] if row.item is None else [row.item])
    if block:
        yield block


def _search(state: DataFrame, block: dict[bytes, list[str]]) -> DataFrame:
    """One pass: adds the block's occurrences to the spans and items found so far."""
    shared = state.sparkSession.sparkContext.broadcast(block)
    schema = state.schema

    def run(batches):
        matchers = Matchers(shared.value)
        for whole in batches:
            for batch in pieces_of(whole):
                texts = pc.struct_field(batch.column("row"), "text").cast(pa.binary()).to_pylist()
                counts, spans, items = [], [], []
                old = zip(texts, batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
                for text, before, known in old:
                    words = words_of(text)
                    new, ids = matchers.search(words) if words else ([], set())
                    counts.append(len(words))
                    spans.append([{"start": s, "end": e} for s, e in _joined(new + [(x["start"], x["end"]) for x in before])])
                    items.append(sorted(ids.union(known)))
                arrays = [batch.column("row"), pa.array(counts, pa.int64())]
                arrays += [pa.array(x, batch.schema.field(c).type) for x, c in ((spans, "spans"), (items, "items"))]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "n_words", "spans", "items"])

    return state.mapInArrow(run, schema)


def find_passages(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (struct of all columns of ``docs``), ``n_words``, ``spans``, ``items`` for every input row.

    ``spans`` are the joined word ranges [start, end) that windows of the
    benchmark cover, ``items`` the sorted ids (strings) of the items with an
    occurring window.  Null and wordless texts have no words and no spans; null
    and wordless items have no windows.  Windows of an item without an id count
    in ``spans`` only; items that repeat an id count once.  ``docs`` may have
    any further columns; an empty benchmark finds nothing.
    """
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    state = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(spans).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    done = 0
    for block in _blocks(written(_windows(benchmark, n), "windows"), block_bytes):
        if done:
            state = written(state, "searched")
        state, done = _search(state, block), done + 1
    return state if done else _search(state, {})


def report(found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of each row of :func:`find_passages`."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs (all columns)."""
    return find_passages(docs, benchmark, **options).filter(F.size("spans") == 0).select("row.*")
