"""Near-duplicate documents: MinHash, banding, signature check, exact confirmation, star components.

Each text becomes the set of its distinct ``k``-word shingles.  Texts with equal
sets are one class; only one representative of a class goes on, so groups of
exact copies cost nothing more.  Every representative gets ``bands * rows``
minima under universal hash functions ``(a x + b) mod 2**64``; ``rows``
neighbouring minima form a band key.  In each bucket of equal band keys the
members are compared with the smallest and the largest member (linear in the
bucket), first by signature, then on the full sets.  Links make components by
large-star and small-star.  Buckets that still hold members of different
components after that get the exact rest: their members are compared block by
block, every block pair a group of its own, and a group tells only links that
join different components.

With 36 bands of 3 minima a pair at similarity 0.75 shares no band with
probability (1 - 0.75**3)**36 = 2.7e-9.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WordHashes, pieces_of, shingles, text_bytes, written
from tessera.llm.components import connected_components

K, BANDS, ROWS, PERCENT = 5, 36, 3, 75
#: Pairs whose signatures agree on less than this share are dropped before the exact check:
#: five standard deviations of the estimate (108 minima) under a similarity of 0.75.
SLACK = 0.21
#: Ids of candidate documents sent to every task that fetches their texts (8 MB).
MAX_BROADCAST_IDS = 1 << 20
#: Members of a bucket that one task of the exact rest compares with as many others.
BLOCK = 2048
_CHUNK = 4096


def _hash_family(n: int, seed: int = 20240607) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 2**64, n, dtype=np.uint64)


def signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the minimum of each universal hash function over ``values``."""
    least = None
    for at in range(0, len(values), _CHUNK):
        part = (values[at : at + _CHUNK, None] * a + b).min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return (least >> np.uint64(32)).astype("<u4")


def _sets(docs: DataFrame, k: int, minima: int) -> DataFrame:
    """(doc_id, n_shingles, fp, sig): set size, 128-bit set fingerprint and signature of each text; null for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()), ("sig", pa.binary())])

    def run(batches):
        hashes, (a, b) = WordHashes(), _hash_family(minima)
        for whole in batches:
            for batch in pieces_of(whole):
                sizes, fps, sigs = [], [], []
                for text in batch.column("text").to_pylist():
                    s = shingles(hashes.of(text.lower().split()), k) if text else ()
                    sizes.append(len(s))
                    fps.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sigs.append(signature(s, a, b).tobytes() if len(s) else None)
                yield pa.record_batch([batch.column("doc_id"), sizes, fps, sigs], schema=schema)

    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text"))
    return cols.mapInArrow(run, "doc_id long, n_shingles long, fp binary, sig binary")


def _full_sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, hashes, short): the whole shingle set of each wanted document, and its upper halves packed.

    Up to MAX_BROADCAST_IDS ids go to every task, more are joined by shuffle.
    """
    schema = pa.schema([("node", pa.int64()), ("hashes", pa.list_(pa.int64())), ("short", pa.binary())])

    def run(batches):
        words = WordHashes()
        for whole in batches:
            for batch in pieces_of(whole):
                sets = [shingles(words.of(text.lower().split()), k) for text in batch.column("text").to_pylist()]
                hashes = pa.array([x.view(np.int64) for x in sets], schema.field(1).type)
                short = pa.array([(x >> np.uint64(32)).astype("<u4").tobytes() for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("node"), hashes, short], schema=schema)

    nodes = written(nodes, "nodes")
    few = nodes.count() <= MAX_BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), text_bytes("text").alias("text")).filter("text is not null")
    texts = texts.join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
    return written(texts.mapInArrow(run, "node long, hashes array<bigint>, short binary"), "sets")


def _alike(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """The pairs whose signatures agree on at least the share ``least`` of all minima."""

    def run(batches):
        for batch in batches:
            keep = [
                np.mean(np.frombuffer(x, "<u4") == np.frombuffer(y, "<u4")) >= least
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a").join(
        sigs.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity: 100 |x & y| >= percent |x or y|."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    both = both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("total"))
    return both.filter(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("a", "b").distinct()


class _Groups(dict):
    """Union-find over component ids."""

    def __missing__(self, x):
        return x

    def root(self, x):
        while self[x] != x:
            x = self[x]
        return x


def _rest(members: DataFrame, split: DataFrame, sets: DataFrame, least: float, rows: int, percent: int, block: int) -> DataFrame:
    """Links that join different components within the buckets ``split (key, n)``, compared block by block.

    A bucket of n members is cut into ceil(n / block) blocks by a hash of the
    member; each pair of blocks is a group of about two blocks of rows.  A pair
    that meets in several buckets is looked at in its first common band.  Pairs
    whose signatures agree enough are compared on the halved hashes of their
    sets; what a task has joined for sure (beyond what equal halves could feign)
    it need not join again, so it tells fewer links than it has members, and
    those that only the full sets can decide.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = members.join(split, "key").withColumn("blocks", blocks).withColumn("own", own).join(sets, "node")
    placed = placed.select(
        "key", "band", "node", "component", "own", "sig", "short", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    first, second = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    groups = placed.select("key", "band", "node", "component", "sig", "short", "own", first, second)

    def run(_, group):
        import pandas as pd

        band = int(group.band.iloc[0])
        first, second = group[group.own == group.i], group[group.own == group.j]
        out, joined = [], _Groups()
        if len(first) and len(second):
            ys = np.stack([np.frombuffer(s, "<u4") for s in second.sig])
            nodes, parts = second.node.to_numpy(), second.component.to_numpy()
            sets = [np.frombuffer(s, "<u4") for s in second.short]
            for node, part, sig, short in zip(first.node, first.component, first.sig, first.short, strict=True):
                equal = ys == np.frombuffer(sig, "<u4")
                hit = (parts != part) & (nodes != node) & (equal.mean(axis=1) >= least)
                bands = equal[hit].reshape(hit.sum(), ys.shape[1] // rows, rows).all(axis=2)
                mine = np.frombuffer(short, "<u4")
                for at in np.flatnonzero(hit)[bands.argmax(axis=1) == band]:
                    if joined.root(part) == joined.root(parts[at]):
                        continue
                    n = len(np.intersect1d(mine, sets[at], assume_unique=True))
                    total = len(mine) + len(sets[at])
                    if 100 * n >= percent * (total - n):
                        out.append((min(node, nodes[at]), max(node, nodes[at])))
                        if 100 * (n - 2) >= percent * (total - n + 2):
                            joined[joined.root(part)] = joined.root(parts[at])
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return groups.groupBy("key", "i", "j").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, k: int = K, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  Null,
    empty and wordless texts have no shingles and link with nothing.  Rows with
    one doc_id are one document (its texts' links are pooled, ``kept`` holds for
    each of the rows); rows without a doc_id link with nothing, have a null
    component and are kept.  Other columns of ``docs`` are not read.
    """
    least = percent / 100 - SLACK
    texts = docs.select("doc_id", "text")
    found = written(_sets(texts, k, bands * rows), "signatures")
    full = found.filter("doc_id is not null and fp is not null")
    classes = written(full.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    sigs = written(
        full.select("fp", F.col("doc_id").alias("node"), "sig").join(classes, ["fp", "node"], "left_semi")
        .select("node", "sig").distinct(),
        "representatives",
    )
    width = 4 * rows
    key = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * width + 1, F.lit(width))))
    keys = sigs.select("node", F.posexplode(key).alias("band", "key"))
    ends = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"))
    # Written before it is joined back: a hot key's rows can then be split over tasks.
    ends = written(ends.filter("lo != hi"), "buckets")
    members = written(keys.join(ends, "key"), "members")
    near = members.select("node", F.explode(F.array("lo", "hi")).alias("end")).filter("node != end")
    pairs = near.select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct()
    pairs = written(_alike(pairs, sigs, least), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    links = written(_confirmed(pairs, _full_sets(texts, nodes, k), percent), "links")
    # Equal doc_ids with different sets have several class nodes: link those too.
    same = full.join(classes, "fp").filter("doc_id != node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    same = same.join(classes.select(F.col("node").alias("a")), "a", "left_semi").distinct()
    links = links.union(same)
    parts = written(connected_components(links), "components")

    # Buckets of up to three members have had every pair compared.
    large = members.filter("n > 3").join(parts, "node", "left")
    large = large.select("key", "band", "node", "n", F.coalesce("component", "node").alias("component"))
    split = large.groupBy("key").agg(F.max("n").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    split = written(split.filter("x != y").select("key", "n"), "split")
    if not split.isEmpty():
        large = written(large.drop("n").join(split.select("key"), "key", "left_semi"), "large")
        sets = _full_sets(texts, large.select("node").distinct(), k)
        more = _rest(large, split, sets.select("node", "short").join(sigs, "node"), least, rows, percent, block)
        more = written(_confirmed(written(more, "pairs"), sets, percent), "links")
        if not more.isEmpty():
            parts = written(connected_components(links.union(more)), "components")

    out = found.select("doc_id", "n_shingles", "fp").join(classes, "fp", "left").join(parts, "node", "left")
    part = F.when(F.col("fp").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "node"))
    out = out.select("doc_id", "n_shingles", part.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without those that :func:`near_duplicates` does not keep (all columns)."""
    gone = near_duplicates(docs, **options).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    return docs.join(gone.distinct(), F.col("doc_id") == F.col("_gone"), "left_anti")
