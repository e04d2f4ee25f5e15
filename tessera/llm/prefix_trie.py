"""Conversation prefix trie: ternary search trees over turn ids, one per range shard, merged at the borders.

Conversations are rebuilt (a conversation takes the first turns of its family's
first), then every distinct sequence of first turns becomes a node:

1. *dictionary*: each distinct (role, text) gets an id, in the order of its
   SHA-256; from here on a turn is its id and the bytes of its text;
2. *rebuilding*: turns are sorted over all partitions by family, conversation and
   turn, and streamed; what a partition needs from the ones before (at most eight
   turns and a position) goes through the driver, one small summary a partition,
   so a conversation that holds a third of all turns spreads like any other.
   Sequences are cut into blocks of ``BLOCK`` turns; a block hangs under the node
   that the blocks before it spell;
3. *copies*: equal blocks become one row with their count and smallest
   conversation; the ids that end at a node are digested in sorted order, in
   pieces, so no group is collected;
4. *trees*: distinct sequences are range-partitioned; each shard is streamed in
   bounded runs.  A run is inserted into a ternary search tree median first,
   which balances the trees of siblings, and accumulated without recursion,
   children before parents;
5. *merging*: what a run shares with its neighbours are the nodes on the paths of
   its first and last sequence down to the common prefix.  Counts there are
   written so that they add up (a node's own bytes count in the first run that
   has it), so border nodes are merged by one aggregation; all others are final.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Conversations of a family share the first turns of its first conversation: at most HEAD of them.
FAMILY, HEAD = 5, 8
#: Turns of a sequence that one tree holds; deeper ones hang under it, block by block.
BLOCK = 1024
#: Turns of the sequences that are inserted into one tree.
RUN = 100_000
#: Conversation ids in one piece of a long list that is digested.
LISTED = 50_000

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_ROOT = b""
_PIECES = "conv_id long, k int, at int, ids array<long>, sizes array<int>, ends boolean, open boolean"
_NODES = (
    "k int, root binary, is_root boolean, gid binary, parent_gid binary, depth int, low long, parent_low long, "
    "n long, children long, leaves long, saved long, sha string"
)


def borrowed(conv_id: int) -> int:
    """How many first turns a conversation takes from its family's first."""
    return zlib.crc32(str(conv_id).encode()) % (HEAD + 1)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.strip().split(" ") for f in schema.split(", ")]
    kind = [pa.list_(kinds[t[6:-1]]) if t.startswith("array") else kinds[t] for _, t in fields]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    arrays = [pa.array(c, t) for c, t in zip(columns, kind, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def _rows(batches, *names: str):
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            yield from zip(*[part.column(n).to_pylist() for n in names], strict=True)


def _batched(rows, schema: str, limit: int = 50_000):
    """Record batches of rows; a row counts as many as its lists are long."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 + sum(len(x) for x in row if isinstance(x, list))
        if size >= limit:
            yield _table(held, schema)
            held, size = [], 0
    if held:
        yield _table(held, schema)


# ------------------------------------------------------------------ rebuilding


def coded_turns(conversations: DataFrame) -> DataFrame:
    """``base, own, conv_id, turn, id, size``: each turn with its dictionary id and the bytes of its text.

    Rows without a conv_id belong to no conversation and stay out.
    """
    c = conversations
    role, text = F.coalesce(c["role"], F.lit("")), F.coalesce(c["text"], F.lit(""))
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = written(
        c.filter(c["conv_id"].isNotNull()).select(
            c["conv_id"].cast("long").alias("conv_id"),
            c["turn"].alias("turn"),
            F.unhex(F.sha2(spelled.cast("binary"), 256)).alias("digest"),
            F.octet_length(text).alias("size"),
        ),
        "trie-turns",
    )
    ids = turns.groupBy("digest").agg(F.max("size")).select("digest").orderBy("digest")
    dictionary = written(ids.withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    return turns.join(dictionary, "digest").select(
        base.alias("base"), (base != F.col("conv_id")).alias("own"), "conv_id", "turn", "id", "size"
    )


def _summary(batches):
    """One row on a sorted partition: its first and last conversation and the family heads it ends with."""
    first = base = conv = None
    n, heads = 0, []
    for b, c, i, s in _rows(batches, "base", "conv_id", "id", "size"):
        if first is None:
            first = c
        if b != base:
            base, heads = b, []
        if c != conv:
            conv, n = c, 0
        n += 1
        if c == b and len(heads) < HEAD:
            heads.append((i, s))
    if first is not None:
        p = TaskContext.get().partitionId()
        yield _table([(p, first, base, conv, n, [i for i, _ in heads], [s for _, s in heads])], _SUMMARY)


_SUMMARY = "p int, first long, base long, conv_id long, n long, ids array<long>, sizes array<long>"


def _carried(summaries: list) -> dict[int, tuple]:
    """What each partition starts with (family, heads, conversation, turns of it before) and whether its last goes on."""
    out, state = {}, (None, [], None, 0)
    rows = sorted(summaries, key=lambda r: r.p)
    for row, after in zip(rows, [*rows[1:], None], strict=False):
        base, heads, conv, n = state
        out[row.p] = (*state, after is not None and after.first == row.conv_id)
        own = list(zip(row.ids, row.sizes, strict=True))
        heads = ((heads if base == row.base else []) + own)[:HEAD]
        state = (row.base, heads, row.conv_id, row.n + (n if conv == row.conv_id else 0))
    return out


def _sequences(rows, start: tuple, block: int):
    """Pieces of rebuilt conversations from sorted turns: ``conv_id, k, at, ids, sizes, ends, open``."""
    base, heads, conv, pos, goes_on = start
    heads, opened, h = list(heads), conv is not None, 0
    depth = took = 0
    ids: list[int] = []
    sizes: list[int] = []

    def piece(ends: bool, is_open: bool):
        first = depth - len(ids)
        k = max(0, depth - 1) // block if not ids else first // block
        return (conv, k, first - k * block, list(ids), list(sizes), ends, is_open)

    def begin() -> None:
        nonlocal h, took
        h = 0 if conv == base else borrowed(conv)
        took = min(h, len(heads))

    def add(turn: int, size: int):
        nonlocal depth, ids, sizes
        if ids and depth % block == 0:
            yield piece(False, opened)
            ids, sizes = [], []
        ids.append(turn)
        sizes.append(size)
        depth += 1

    if opened:
        begin()
        depth = took + max(0, pos - h)
    seen = False
    for b, c, i, s in rows:
        if c != conv:
            if seen:
                yield piece(True, opened)
            opened = False
            if b != base:
                base, heads = b, []
            conv, pos, depth, ids, sizes = c, 0, 0, [], []
            begin()
            for head in heads[:took]:
                yield from add(*head)
        seen = True
        pos += 1
        if c == b and len(heads) < HEAD:
            heads.append((i, s))
        if pos > h:
            yield from add(i, s)
    if seen and (ids or not goes_on):
        yield piece(not goes_on, opened or goes_on)


def blocks_of(conversations: DataFrame) -> tuple[DataFrame, int]:
    """Rebuilt conversations in blocks (``conv_id, k, root, ids, sizes, ends, key``) and the largest ``k``."""
    order = ["base", "own", "conv_id", F.col("turn").asc_nulls_first(), "id"]
    turns = coded_turns(conversations)
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    spark, block = conversations.sparkSession, BLOCK
    carried = spark.sparkContext.broadcast(_carried(turns.mapInArrow(_summary, _SUMMARY).collect()))

    def build(batches):
        start = carried.value.get(TaskContext.get().partitionId())
        if start is not None:
            rows = _rows(batches, "base", "conv_id", "id", "size")
            yield from _batched(_sequences(rows, start, block), _PIECES)

    pieces = written(turns.mapInArrow(build, _PIECES), "trie-pieces")
    whole = pieces.filter(~F.col("open")).select("conv_id", "k", "ids", "sizes", "ends")
    parts = F.sort_array(F.collect_list(F.struct("at", "ids", "sizes")))
    torn = pieces.filter("open").groupBy("conv_id", "k").agg(parts.alias("parts"), F.max("ends").alias("ends"))
    torn = torn.select("conv_id", "k", F.flatten("parts.ids").alias("ids"), F.flatten("parts.sizes").alias("sizes"), "ends")
    spelled = F.array_join(F.col("ids").cast("array<string>"), ",")
    blocks = whole.unionByName(torn).withColumn("digest", F.unhex(F.sha2(spelled.cast("binary"), 256)))
    top = pieces.agg(F.max("k")).first()[0] or 0
    lone = blocks.withColumns({"root": F.lit(_ROOT), "key": F.col("digest")})
    if top:
        blocks = written(blocks, "trie-blocks")
        more = (F.col("k") > 0) | ~F.col("ends")
        lone = blocks.filter(~more).withColumns({"root": F.lit(_ROOT), "key": F.col("digest")})
        links = blocks.filter(more).select("conv_id", "k", "digest")
        links = links.repartition("conv_id").sortWithinPartitions("conv_id", "k").mapInArrow(_chain, _CHAIN)
        lone = lone.unionByName(blocks.filter(more).join(links, ["conv_id", "k"]))
    return written(lone.drop("digest"), "trie-sequences"), top


_CHAIN = "conv_id long, k int, root binary, key binary"


def _chain(batches):
    """Keys of the blocks of a conversation: each names its block and all before it."""

    def rows():
        conv, key = None, _ROOT
        for c, k, digest in _rows(batches, "conv_id", "k", "digest"):
            if c != conv:
                conv, key = c, _ROOT
            root, key = key, hashlib.sha256(key + digest).digest() if k else digest
            yield c, k, root, key

    yield from _batched(rows(), _CHAIN)


# ------------------------------------------------------------------ copies


_LISTS = "key binary, n long, low long, sha string, text string"


def _lists(batches):
    """Of sorted (key, conv_id): a digest per group; a group at the partition's end as pieces of its text."""

    def rows():
        held, first, key, cut = [], True, None, False
        for k, c in _rows(batches, "key", "conv_id"):
            if k != key:
                if held:
                    yield _listed(key, held, first or cut)
                first, key, cut, held = key is None, k, False, []
            elif len(held) >= LISTED:
                yield _listed(key, held, True)
                cut, held = True, []
            held.append(c)
        if held:
            yield _listed(key, held, True)

    yield from _batched(rows(), _LISTS, 500)


def _listed(key: bytes, ids: list[int], is_part: bool) -> tuple:
    text = ",".join(map(str, ids))
    return (key, len(ids), ids[0], None, text) if is_part else (key, len(ids), ids[0], hashlib.sha256(text.encode()).hexdigest(), None)


def _joined(batches):
    """Digests of the lists whose pieces arrive in order."""

    def rows():
        key, n, low, sha = None, 0, None, None
        for k, count, first, text in _rows(batches, "key", "n", "low", "text"):
            if k != key:
                if key is not None:
                    yield key, n, low, sha.hexdigest(), None
                key, n, low, sha = k, 0, first, hashlib.sha256()
            sha.update((("," if n else "") + text).encode())
            n += count
        if key is not None:
            yield key, n, low, sha.hexdigest(), None

    yield from _batched(rows(), _LISTS, 500)


def distinct_blocks(blocks: DataFrame) -> DataFrame:
    """One row per distinct sequence: ``k, root, key, ids, sizes, n, low, n_more, sha``.

    ``n`` conversations have it, the smallest is ``low``, ``n_more`` of them go on
    after it; ``sha`` digests the ids of those that end with it (null if none).
    """
    ends = blocks.filter("ends").select("key", "conv_id")
    ends = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    lists = written(ends.mapInArrow(_lists, _LISTS), "trie-lists")
    parts = lists.filter(F.col("text").isNotNull()).repartition("key").sortWithinPartitions("key", "low")
    done = lists.filter(F.col("sha").isNotNull()).unionByName(parts.mapInArrow(_joined, _LISTS))
    done = done.select("key", "n", "low", "sha", F.lit(0).cast("long").alias("n_more"))
    more = blocks.filter(~F.col("ends")).groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    more = more.select("key", "n", "low", F.lit(None).cast("string").alias("sha"), F.col("n").alias("n_more"))
    stats = done.unionByName(more).groupBy("key").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("sha").alias("sha"), F.sum("n_more").alias("n_more")
    )
    # The smallest conversation's row stands for the sequence: one row on each side, no key is hot.
    found = blocks.join(stats.withColumnRenamed("low", "conv_id"), ["key", "conv_id"])
    return found.select("k", "root", "key", "ids", "sizes", "n", F.col("conv_id").alias("low"), "n_more", "sha")


# ------------------------------------------------------------------ trees


class TernaryTree:
    """Ternary search tree: siblings form a binary tree by turn id, ``eq`` leads to the next turn."""

    def __init__(self):
        self.split, self.lo, self.hi, self.eq = [0], [-1], [-1], [-1]
        self.up, self.depth, self.size = [-1], [0], [0]

    def _new(self, split: int, size: int, up: int) -> int:
        self.split.append(split)
        self.size.append(size)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        for links in (self.lo, self.hi, self.eq):
            links.append(-1)
        return len(self.split) - 1

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """Node that the whole sequence ends at; 0 is the textless root."""
        split, lo, hi, at = self.split, self.lo, self.hi, 0
        for turn, size in zip(ids, sizes, strict=True):
            links, slot = self.eq, at
            node = links[slot]
            while node >= 0 and split[node] != turn:
                links, slot = (lo if turn < split[node] else hi), node
                node = links[slot]
            if node < 0:
                node = links[slot] = self._new(turn, size, at)
            at = node
        return at


def _middle_first(n: int):
    """0 to n - 1, each range's middle before its halves."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            stack.append((mid + 1, b))
            stack.append((a, mid))


def _shared(x: list[int], y: list[int]) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    return next((i for i in range(n) if x[i] != y[i]), n)


def _run_nodes(run: list[tuple], before: int, after: int, k: int, block: int):
    """Nodes of one run of sorted distinct sequences of one root.

    ``before`` and ``after`` are the turns that its first and its last sequence
    share with the neighbours of the same root (-1: no such neighbour).
    """
    tree = TernaryTree()
    ends = [0] * len(run)
    for r in _middle_first(len(run)):
        ends[r] = tree.insert(run[r][1], run[r][2])
    count = len(tree.split)
    n, low, sha = [0] * count, [None] * count, [None] * count
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for row, end in zip(run, ends, strict=True):
        n[end], low[end], sha[end] = row[3], row[4], row[5]
        if row[7] is not None:
            children[end], leaves[end], saved[end] = row[7], row[8], row[9]
    first, last = _path(tree, ends[0]), _path(tree, ends[-1])
    known = set(first[: before + 1])  # counted by an earlier run
    extended = ends[-1] if after == len(run[-1][1]) else -1  # its children are in a later run
    has_child = [False] * count
    for node in range(count - 1, -1, -1):  # a node is made after its parent
        if not has_child[node] and node != extended and not leaves[node]:
            leaves[node] = 1
        saved[node] += tree.size[node] * (n[node] - (node not in known))
        parent = tree.up[node]
        if parent >= 0:
            has_child[parent] = True
            n[parent] += n[node]
            low[parent] = low[node] if low[parent] is None else min(low[parent], low[node])
            children[parent] += node not in known
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
    root, root_low = run[0][0], run[0][6]
    gids = _gids(root, run[0][1], first[: before + 1]) | _gids(root, run[-1][1], last[: after + 1])
    for node in range(count):
        parent = tree.up[node]
        if parent < 0:
            above = (None, None)
        elif parent == 0 and k:
            above = (None, root_low)
        else:
            above = (gids[parent], None) if parent in gids else (None, low[parent])
        yield (
            k, root, parent < 0, gids.get(node), above[0], k * block + tree.depth[node], low[node], above[1],
            n[node], children[node], leaves[node], saved[node], sha[node],
        )


def _path(tree: TernaryTree, end: int) -> list[int]:
    out = []
    while end >= 0:
        out.append(end)
        end = tree.up[end]
    return out[::-1]


def _gids(root: bytes, ids: list[int], nodes: list[int]) -> dict[int, bytes]:
    """Names, the same in every run, of the first nodes of a path."""
    out, h = {}, hashlib.sha256(root + b"|")
    for d, node in enumerate(nodes):
        if d:
            h.update(ids[d - 1].to_bytes(8, "little"))
        out[node] = h.digest()
    return out


_TREE_ROW = ("root", "ids", "sizes", "n", "low", "sha", "root_low", "children", "leaves", "saved")


def _forest(batches, before: int, after: int, k: int, block: int, limit: int):
    """Nodes of a sorted partition, run by run."""
    run, size, last = [], 0, None
    for row in _rows(batches, *_TREE_ROW):
        if run and (row[0] != run[-1][0] or size >= limit):
            common = _shared(run[-1][1], row[1]) if row[0] == run[-1][0] else -1
            yield from _run_nodes(run, before, common, k, block)
            run, size, before = [], 0, common
        run.append(row)
        size += 1 + len(row[1])
    if run:
        yield from _run_nodes(run, before, after, k, block)


_EDGE = "p int, root binary, ids array<long>, last_root binary, last_ids array<long>"


def _edges(batches):
    """First and last sequence of a sorted partition."""
    first = last = None
    for row in _rows(batches, "root", "ids"):
        first, last = first or row, row
    if first is not None:
        yield _table([(TaskContext.get().partitionId(), *first, *last)], _EDGE)


def _common(batches):
    """Turns that a partition's first sequence shares with the last of the one before."""

    def rows():
        for p, root, ids, old_root, old_ids in _rows(batches, "p", "root", "ids", "old_root", "old_ids"):
            yield p, _shared(old_ids, ids) if old_root is not None and old_root == root else -1

    yield from _batched(rows(), "p int, common int")


def _trees(rows: DataFrame, k: int) -> DataFrame:
    """Nodes of one level's trees, those at the borders of runs in parts."""
    rows = rows.repartitionByRange("root", "ids").sortWithinPartitions("root", "ids").checkpoint()
    by_place = Window.orderBy("p")  # a row a partition
    edges = rows.mapInArrow(_edges, _EDGE)
    edges = edges.withColumns({"old_root": F.lag("last_root").over(by_place), "old_ids": F.lag("last_ids").over(by_place)})
    found = sorted((r.p, r.common) for r in edges.mapInArrow(_common, "p int, common int").collect())
    after = [common for _, common in found[1:]] + [-1]
    near = rows.sparkSession.sparkContext.broadcast({p: (b, a) for (p, b), a in zip(found, after, strict=False)})
    block, run = BLOCK, RUN

    def grow(batches):
        ends = near.value.get(TaskContext.get().partitionId())
        if ends is not None:
            yield from _batched(_forest(batches, *ends, k, block, run), _NODES)

    return written(rows.mapInArrow(grow, _NODES), "trie-nodes")


def _unary(rows: DataFrame) -> DataFrame:
    """Nodes of blocks that one conversation alone reaches: a path."""
    i, last = F.col("pos"), F.col("pos") == F.size("ids") - 1
    at_end = last & F.col("sha").isNotNull()
    spread = rows.select("k", "ids", "low", "root_low", "sha", F.posexplode("ids").alias("pos", "turn"))
    return spread.select(
        F.col("low").alias("conv_id"),
        (F.col("k") * BLOCK + i + 1).cast("long").alias("depth"),
        F.when(i == 0, F.col("root_low")).otherwise(F.col("low")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(at_end, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(at_end, F.col("sha")).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the rebuilt conversations' prefix trie.

    Turns go by ``turn``, null first; turns of equal number by the SHA-256 of role
    and text, and equal rows are turns of their own.  A null role or text is
    empty.  Rows without a conv_id are left out; an empty table has no nodes.
    """
    blocks, top = blocks_of(conversations)
    rows = distinct_blocks(blocks).withColumns({"root_low": F.lit(None).cast("long"), "alone": F.lit(False)})
    rows = written(rows, "trie-distinct")
    deepest, paths = 0, None
    if top:
        above = rows.select(F.col("key").alias("root"), F.col("low").alias("root_low"), (F.col("n_more") == 1).alias("alone"))
        deep = rows.filter("k > 0").drop("root_low", "alone").join(above, "root")
        rows = written(rows.filter("k = 0").unionByName(deep), "trie-levels")
        deepest = rows.filter(~F.col("alone")).agg(F.max("k")).first()[0] or 0
        paths = _unary(rows.filter("alone"))
    nodes, totals = None, None
    for k in range(deepest, -1, -1):  # one round for every BLOCK turns that conversations share
        level = rows.filter(~F.col("alone") & (F.col("k") == k))
        single = F.when(F.col("n_more") == 1, F.struct(F.lit(1).cast("long").alias("children"), F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")))
        if totals is not None:
            level = level.join(totals, level["key"] == totals["below"], "left")
            single = F.coalesce(single, F.when(F.col("below").isNotNull(), F.struct("children", "leaves", "saved")))
        level = level.withColumn("under", single)
        level = level.select("root", "ids", "sizes", "n", "low", "sha", "root_low", "under.children", "under.leaves", "under.saved")
        grown = _trees(level, k)
        ends = grown.filter("is_root").groupBy(F.col("root").alias("below"))
        totals = written(ends.agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")]), "trie-totals") if k else None
        nodes = grown if nodes is None else nodes.unionByName(grown)
    nodes = nodes.filter("k = 0 OR NOT is_root")
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    alike = [F.max(c).alias(c) for c in ("parent_gid", "depth", "parent_low", "sha")]
    border = written(nodes.filter(F.col("gid").isNotNull()).groupBy("gid").agg(F.min("low").alias("low"), *sums, *alike), "trie-border")
    inner = nodes.filter(F.col("gid").isNull()).drop("k", "root", "is_root")
    every = inner.unionByName(border)
    hanging = every.filter(F.col("parent_gid").isNotNull()).drop("parent_low")
    above = border.select(F.col("gid").alias("parent_gid"), F.col("low").alias("parent_low"))
    every = every.filter(F.col("parent_gid").isNull()).unionByName(hanging.join(above, "parent_gid"))
    found = every.select(
        F.col("low").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.col("parent_low").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )
    return found if paths is None else found.unionByName(paths)
