"""Filter interaction audit: what five quality filters remove in every order, duplicates found by radix tries.

Four filters look at one text; the fifth, "identical to the text of a smaller
doc_id", is decided by the tries:

1. the range of texts is cut by *adaptive prefixes*: a bounded sample of texts,
   chosen by hash, is counted by prefix; prefixes that hold more than a shard's
   share of different texts are counted again eight times as long, until none
   does.  A cut is the shortest prefix that tells its text from the one before;
2. copies within a piece of input become one row with their smallest doc_id
   before the shuffle, so a text that fills a third of the table is one row per
   piece;
3. each shard inserts its full texts into a compressed (radix) trie, byte by
   byte exact, with the smallest doc_id at every terminal; the traversal emits
   the first document of every text;
4. documents, reduced to filter masks, are joined with the first documents and
   the labels on narrow rows, counted per (part, mask, label), and the counts
   alone are unfolded into the 120 orders.

A document's text is shuffled once.  The sample decides the balance of the
shards and nothing else.
"""

from __future__ import annotations

import bisect
import itertools
import json
import math

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import pieces_of, written

#: Bytes of text a shard's trie should hold, where the session has not more shuffle partitions.
SHARD_BYTES = 128 << 20
#: Sampled texts per shard, and in all (they go to the driver as prefixes).
SAMPLE, MAX_SAMPLE = 40, 1_000_000
#: Characters of the prefixes counted first; heavy ones are counted again with the factor's length.
PREFIX, LONGER = 32, 8

FILTERS = "ABCDE"
# The filters' limits and characters.
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"


class RadixTrie:
    """Compressed trie over byte strings with the smallest id at each terminal.

    A node is ``[label, children, terminal]``: children by their first byte (or
    None), terminal ``[smallest id or None, key of the text]`` or None.
    """

    def __init__(self):
        self.root: list = [b"", None, None]

    def insert(self, text: bytes, key: int, smallest: int | None) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at]) if node[1] else None
            if child is None:
                leaf = [text[at:], None, [smallest, key]]
                if node[1] is None:
                    node[1] = {}
                node[1][text[at]] = leaf
                return
            label = child[0]
            if not text.startswith(label, at):
                self._split(child, _common(label, text, at))
            at += len(child[0])
            node = child
        if node[2] is None:
            node[2] = [smallest, key]
        elif smallest is not None and (node[2][0] is None or smallest < node[2][0]):
            node[2][0] = smallest

    @staticmethod
    def _split(node: list, at: int) -> None:
        """Cut a node's label: the rest goes to a child that takes over what the node had."""
        rest = [node[0][at:], node[1], node[2]]
        node[0], node[1], node[2] = node[0][:at], {rest[0][0]: rest}, None

    def terminals(self):
        """``[smallest id, key]`` of every text."""
        stack = [self.root]
        while stack:
            _, children, terminal = stack.pop()
            if terminal is not None:
                yield terminal
            if children:
                stack.extend(children.values())


def _common(label: bytes, text: bytes, at: int) -> int:
    """Length of the longest common prefix of ``label`` and ``text[at:]``."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == text[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def cut_points(docs: DataFrame, shards: int, rows: int) -> list[bytes]:
    """At most ``shards - 1`` ascending prefixes that cut the distinct texts into shards of about equal bytes."""
    if shards < 2:
        return []
    wanted = min(SAMPLE * shards, MAX_SAMPLE)
    text, h = F.col("text"), F.col("h")
    sample = docs.select(_text(docs).alias("text")).withColumn("h", F.xxhash64("text"))
    sample = sample.filter(F.pmod(h, F.lit(max(1, rows // wanted))) == 0)
    length, light, heavy = PREFIX, {}, None
    while True:
        own = sample
        if heavy is not None:  # fewer than there are shards: each holds more than a share
            short = docs.sparkSession.createDataFrame([(p,) for p in heavy], "p string")
            own = own.join(F.broadcast(short), F.substring("text", 1, length // LONGER) == F.col("p"), "left_semi")
        distinct = own.groupBy(F.substring(text, 1, length).alias("p"), "h").agg(F.max(F.octet_length(text)).alias("b"))
        found = distinct.groupBy("p").agg(F.count("*").alias("n"), F.sum("b").alias("b")).collect()
        if heavy is None:
            share = max(1, sum(r.b for r in found)) / shards
        heavy = [r.p for r in found if r.n > 1 and r.b > share]
        light.update((r.p.encode(), r.b) for r in found if not (r.n > 1 and r.b > share))
        if not heavy:
            break
        length *= LONGER
    cuts, held, before = [], 0, b""
    for prefix, size in sorted(light.items()):
        if held >= share and prefix != before:
            cuts.append(prefix[: _common(before, prefix, 0) + 1])
            held = 0
        held += size
        before = prefix
    return cuts


def first_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key`` of the smallest document of every distinct text (a null text is empty).

    Documents without an id are not smaller than others; a text that only they
    have is not listed.
    """
    spark = docs.sparkSession
    total = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(_text(docs))).alias("b")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((total.b or 0) / SHARD_BYTES))
    shards = min(shards, max(1, total.n // 100))
    cuts = cut_points(docs, shards, total.n)
    shared = spark.sparkContext.broadcast(cuts)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), _text(docs).cast("binary").alias("text"))

    def collapse(batches):
        names = ["shard", "text", "text_key", "smallest"]
        for whole in batches:
            for batch in pieces_of(whole, rows=4096):
                found: dict[bytes, int | None] = {}
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    old = found.get(text)
                    found[text] = doc_id if old is None else old if doc_id is None else min(old, doc_id)
                texts = list(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bisect.bisect_right(shared.value, t) for t in texts], pa.int32()),
                        pa.array(texts, pa.binary()),
                        pa.array([_key(t) for t in texts], pa.int64()),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    names=names,
                )

    def tries(batches):
        trie = RadixTrie()
        for whole in batches:
            for batch in pieces_of(whole, rows=4096):
                columns = [batch.column(c).to_pylist() for c in ("text", "text_key", "smallest")]
                for text, key, smallest in zip(*columns, strict=True):
                    trie.insert(text, key, smallest)
        out = [t for t in trie.terminals() if t[0] is not None]
        for at in range(0, len(out), 10_000):
            part = out[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([t[0] for t in part], pa.int64()), pa.array([t[1] for t in part], pa.int64())],
                names=["doc_id", "text_key"],
            )

    collapsed = rows.mapInArrow(collapse, "shard int, text binary, text_key long, smallest long")
    sharded = collapsed.repartitionById(len(cuts) + 1, F.col("shard"))
    return sharded.mapInArrow(tries, "doc_id long, text_key long")


def _key(text: bytes) -> int:
    """Tells the texts of one doc_id apart, should it repeat."""
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def own_masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, text_key``: bits of the filters that need the text alone (A 1, B 2, C 4, D 8)."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["lang"], F.lit("")).alias("part"),
        _text(docs).alias("text"),
    )

    def run(batches):
        for whole in batches:
            for batch in pieces_of(whole, rows=4096):
                text = batch.column("text")
                points = pc.utf8_length(text).to_pylist()
                texts = pc.cast(text, pa.binary()).to_pylist()
                masks = [_mask(t, n) for t, n in zip(texts, points, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("part"),
                        pa.array(masks, pa.int32()),
                        pa.array([_key(t) for t in texts], pa.int64()),
                    ],
                    names=["doc_id", "part", "mask", "text_key"],
                )

    return rows.mapInArrow(run, "doc_id long, part string, mask int, text_key long")


def _mask(text: bytes, points: int) -> int:
    words = text.split()
    upper = len(text) - len(text.translate(None, UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > MAX_UPPER_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def document_masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask`` of every document, with bit E (16) for copies of a smaller doc_id's text.

    Repeated rows stay, documents without an id never fail E, extra columns are ignored.
    """
    masks = own_masks(docs)
    first = first_documents(docs).withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    joined = masks.join(first, ["doc_id", "text_key"], "left")
    return joined.select("doc_id", "part", F.when(copy, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"))


def _steps() -> list[dict]:
    """Every order and step with the bit of its filter and the bits of those before it."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return out


def interactions(masks: DataFrame) -> DataFrame:
    """The audit of ``part, mask, good, toxic`` rows: one row per part, order and step."""
    counts = masks.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    steps = _steps()
    kind = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    unfolded = counts.select("*", F.inline(F.from_json(F.lit(json.dumps(steps)), kind)))
    mask, n = F.col("mask"), F.col("n")
    fails, earlier = mask.bitwiseAND(F.col("bit")) != 0, mask.bitwiseAND(F.col("before")) != 0
    # In all orders a document is removed once by each that fails it first: by every one of its k filters in 120 / k.
    fair = n * F.expr(f"{len(steps) // len(FILTERS)} div bit_count(mask)")

    def total(test: Column, value: Column = n) -> Column:
        return F.sum(F.when(test, value).otherwise(0)).cast("long")

    return unfolded.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(mask == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier & F.col("good")).alias("good_lost"),
        total(fails & ~earlier & F.col("toxic")).alias("toxic_lost"),
        total(fails, fair).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes from ``docs`` at each step of each order, per language.

    ``labels`` (doc_id, quality, toxic) may name a document more than once: one
    row that says so is enough.  An empty table has no parts and no rows; a null
    language is the part ``''``.
    """
    flags = labels.groupBy(labels["doc_id"].alias("doc_id")).agg(
        F.max(F.coalesce(labels["quality"] == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(labels["toxic"] == 1, F.lit(False))).alias("toxic"),
    )
    masks = written(document_masks(docs), "audit-masks")
    marked = masks.join(flags, "doc_id", "left").select(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    return interactions(marked)


def oracle_sql() -> str:
    return r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
firsts AS (SELECT t, min(doc_id) AS low FROM d GROUP BY t),
flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.part,
    [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
     100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * length(w.t),
     regexp_matches(w.t, '[#$%&*|]'), coalesce(w.doc_id > firsts.low, false)] AS fails,
    coalesce(flags.good, 0) AS good, coalesce(flags.toxic, 0) AS toxic
    FROM w JOIN firsts ON firsts.t = w.t LEFT JOIN flags ON flags.doc_id = w.doc_id),
h AS (SELECT part, fails, good, toxic, count(*) AS n, len(list_filter(fails, lambda x: x)) AS k FROM f GROUP BY ALL),
five AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM five a, five b, five c, five d, five e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT o, s.i AS step, o[s.i] AS own, o[1:s.i - 1] AS earlier FROM orders, five s),
x AS (SELECT h.*, o, step, own, fails[own] AS now, len(list_filter(earlier, lambda j: fails[j])) > 0 AS gone
    FROM h, steps)
SELECT part, array_to_string(list_transform(o, lambda j: substr('ABCDE', j, 1)), '') AS filter_order,
    CAST(step AS INTEGER) AS step,
    CAST(sum(CASE WHEN NOT now AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN now AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN now AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN now AND k = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN now AND NOT gone AND good = 1 THEN n ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN now AND NOT gone AND toxic = 1 THEN n ELSE 0 END) AS BIGINT) AS toxic_lost,
    CAST(sum(CASE WHEN now THEN n * (120 // k) ELSE 0 END) AS BIGINT) AS shapley
FROM x GROUP BY part, o, step
"""
