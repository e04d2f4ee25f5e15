"""Balanced label propagation: documents with equal texts move into few shards of equal row counts.

Groups of more than a quarter of a shard, a few per shard at most, are laid out
first, shard by shard, each shard up to its quota.  The linked documents (equal
texts) of the other groups start in the shard of their id's hash, dealt by the
room that is left.  All members of a group in one shard are alike, so the state
is one row per group with a count per shard; its size never depends on how large
a group is.  Each round, a group that is still cut draws the label it prefers
among its shards, mostly the one that holds most of it.  The planned moves are
counted per shard pair and hash bucket, and the buckets are accepted one after
another as long as the receiving shard has room; what leaves a shard makes room
there at once, so opposite flows cancel also between full shards.  Rounds go on
until some have no gain.  A shard may be an eighth over its room meanwhile: whole
groups of such shards then move to those with room.  At the
end the members are dealt out to their units by rank, and the documents without
links, and what a quota left over, fill the shards up to row counts that are
at most one apart.  Slots number the rows of each shard without gaps.

Ranks are counted in two levels (rows within small hash parts, parts within the
key), so no group, however large, meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import partitions_for, written

SHARDS = 24
#: Hash buckets per label in which planned moves are accepted or refused.
BUCKETS = 128
#: Part of its room that a shard may be over it until the whole groups are levelled; hash buckets of those per shard pair.
OVER, LEVEL_BUCKETS = 8, 16
#: Rounds in a row without a gain that end the propagation (preferences are drawn anew each round).
IDLE = 3
GROUP = ["g1", "g2", "size"]


def rank_within(df: DataFrame, keys: list[str], parts: int, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... within each value of ``keys``, in no particular but a fixed order of ``rid`` (unique)."""
    df = df.withColumn("_part", F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int"))
    by = [*keys, "_part"]
    # Dealt by key and part: a join on the keys below would satisfy count and window with a whole group in one task.
    df = df.repartition(*by)
    counts = df.groupBy(by).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(keys or [F.lit(0)]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = df.withColumn("_own", F.row_number().over(Window.partitionBy(by).orderBy("rid")) - 1)
    return ranked.join(starts, by).withColumn(name, F.col("_start") + F.col("_own")).drop("_part", "_own", "_start")


def _from_list(values: list, at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def _loads(units: DataFrame, shards: int) -> list[int]:
    """Rows per shard (as many numbers as there are shards)."""
    found = {r["shard"]: r["n"] for r in units.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [int(found.get(s, 0)) for s in range(shards)]


def _draw(n: int, *by: Column) -> Column:
    """0 .. n - 1 by hash of the group and ``by``."""
    return F.pmod(F.xxhash64("g1", "g2", *by), F.lit(n))


def _marked(taken: set[int], n: int, at: Column) -> Column:
    """Whether ``at`` (0 .. n - 1) is among ``taken``."""
    return F.substr(F.lit("".join("1" if k in taken else "0" for k in range(n))), (at + 1).cast("int"), F.lit(1)) == "1"


def lay_out(sizes: list[int], room: list[int]) -> list[list[tuple[int, int]]]:
    """(shard, rows) of each group, as few shards as the room allows; takes the rows off ``room``."""
    out = []
    for left in sizes:
        own = []
        while left:
            fits = [s for s, r in enumerate(room) if r >= left]
            at = min(fits, key=lambda s: room[s]) if fits else max(range(len(room)), key=lambda s: room[s])
            n = min(left, room[at])
            own.append((at, n))
            room[at] -= n
            left -= n
        out.append(own)
    return out


def accepted(moves: list[tuple[int, int, int, int]], room: list[int]) -> set[tuple[int, int]]:
    """The (to, bucket) whose ``moves`` (from, to, bucket, rows) fit one after another; changes ``room`` as they do."""
    items: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for source, to, bucket, n in moves:
        items.setdefault((bucket, to), []).append((source, n))
    taken: set[tuple[int, int]] = set()
    waiting, before = sorted(items), -1
    while waiting and len(taken) > before:
        before, refused = len(taken), []
        for bucket, to in waiting:
            parts = items[bucket, to]
            n = sum(k for _, k in parts)
            if n > room[to]:
                refused.append((bucket, to))
                continue
            room[to] -= n
            for source, k in parts:
                room[source] += k
            taken.add((to, bucket))
        waiting = refused
    return taken


def propagate(cut: DataFrame, shards: int, room: list[int]) -> DataFrame:
    """``(g1, g2, size, parts)`` after label propagation; ``room`` is what each shard has besides the rows of ``cut``."""
    done, turn, idle = [], 0, 0
    while idle < IDLE:
        draw = _draw(BUCKETS, F.lit(turn)).cast("int")
        again = F.lit(-1 - turn)

        def key(p):
            u = (_draw(1 << 30, p["shard"], again) + 1) / float((1 << 30) + 1)
            return F.struct((-F.log(u) / F.pow(p["n"], F.lit(3.0))).alias("k"), p["shard"].alias("shard"))

        now = cut.withColumn("to", F.array_min(F.transform("parts", key))["shard"]).withColumn("bucket", draw)
        moves = now.select("to", "bucket", F.explode("parts").alias("p")).filter("p.shard != to")
        moves = moves.groupBy("p.shard", "to", "bucket").agg(F.sum("p.n").alias("n"))
        moves = [(r["shard"], r["to"], r["bucket"], int(r["n"])) for r in moves.collect()]  # shards² · BUCKETS at most
        if not moves:
            break
        taken = accepted(sorted(moves), room)
        turn, idle = turn + 1, 0 if taken else idle + 1
        if not taken:
            continue
        goes = _marked({to * BUCKETS + b for to, b in taken}, shards * BUCKETS, F.col("to") * BUCKETS + F.col("bucket"))
        whole = F.array(F.struct(F.col("to").alias("shard"), F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n")))
        step = written(now.select(*GROUP, F.when(goes, whole).otherwise(F.col("parts")).alias("parts"), goes.alias("goes")), "units")
        done.append(step.filter("goes").drop("goes"))
        cut = step.filter("not goes").drop("goes")
    for part in done:
        cut = cut.union(part)
    return cut


def level(groups: DataFrame, shards: int, loads: list[int], room: list[int]) -> DataFrame:
    """``groups`` with some of one shard moved from shards over their room (``room`` < 0) to those that have some."""
    at = F.col("parts")[0]["shard"]
    share = [min(1.0, 4 * max(0, -r) / max(1, n)) for r, n in zip(room, loads, strict=True)]
    drawn = (F.size("parts") == 1) & (_draw(1 << 30, F.lit("pool")) < _from_list([int(x * (1 << 30)) for x in share], at))
    pool, done, turn, idle = groups.filter(drawn), [groups.filter(~drawn)], 0, 0
    while idle < IDLE and min(room) < 0 < max(room):
        ends = [sum(max(0, r) for r in room[: s + 1]) for s in range(shards)]
        place = _draw(ends[-1], F.lit("to"), F.lit(turn))
        to = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= place))
        cell = (at * shards + to) * LEVEL_BUCKETS + _draw(LEVEL_BUCKETS, F.lit(turn))
        now = pool.withColumn("cell", cell)
        moves = now.groupBy("cell").agg(F.sum(F.col("parts")[0]["n"]).alias("n")).collect()  # shards² · LEVEL_BUCKETS at most
        taken = set()
        for all_ in (False, True):  # first what the excess holds, then what ends it
            for cell, n in sorted((r["cell"], int(r["n"])) for r in moves):
                a, b = divmod(cell // LEVEL_BUCKETS, shards)
                if cell not in taken and room[a] < 0 and n <= room[b] and (all_ or n <= -room[a]):
                    room[a] += n
                    room[b] -= n
                    taken.add(cell)
        turn, idle = turn + 1, 0 if taken else idle + 1
        if not taken:
            continue
        goes = _marked(taken, shards * shards * LEVEL_BUCKETS, F.col("cell"))
        other = F.array(F.struct(to.alias("shard"), F.col("parts")[0]["n"].alias("n")))
        step = written(now.select(*GROUP, F.when(goes, other).otherwise(F.col("parts")).alias("parts"), goes.alias("goes")), "levelled")
        done.append(step.filter("goes").drop("goes"))
        pool = step.filter("not goes").drop("goes")
    for part in done:
        pool = pool.union(part)
    return pool


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every input row, under the law ``rows``.

    Size is the UTF-8 length of the text (null: none) plus 8; the CRC of a null
    text is 0, as of an empty one.  Rows with equal texts (by size and a 128-bit
    hash) are linked, repeated rows too; null texts link with nothing.  An empty table gives no rows.
    Further columns are not read.
    """
    text = F.col("text")
    nodes = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(text.isNotNull(), F.xxhash64(text)).alias("g1"),
        F.when(text.isNotNull(), F.xxhash64(F.lit(shards), text)).alias("g2"),
    )
    nodes = written(nodes, "nodes")  # the row ids are fixed from here on
    total = nodes.count()
    parts = partitions_for(total, 500_000, least=64)
    quota = [total // shards + (s < total % shards) for s in range(shards)]

    groups = nodes.filter("g1 is not null").groupBy(GROUP).agg(F.count("*").alias("members")).filter("members > 1")
    groups = written(groups, "groups")
    is_large = F.col("members") > total // shards // 4
    # At most about four per shard: together they have no more rows than the table.
    large = groups.filter(is_large).orderBy(F.desc("members"), *GROUP).collect()
    room = list(quota)
    laid = lay_out([r["members"] for r in large], room)
    schema = "g1 long, g2 long, size long, shard int, n long"
    flat = [(r["g1"], r["g2"], r["size"], s, n) for r, own in zip(large, laid, strict=True) for s, n in own]
    fixed = docs.sparkSession.createDataFrame(flat, schema)

    # The others start over the room that is left, in proportion.
    ends = [sum(room[: s + 1]) for s in range(shards)]
    at = F.pmod(F.xxhash64("rid"), F.lit(max(1, ends[-1])))
    start = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= at))
    others = nodes.join(groups.filter(~is_large).select(GROUP), GROUP, "left_semi") if ends[-1] else nodes.limit(0)
    units = others.groupBy(*GROUP, start.alias("shard")).agg(F.count("*").alias("n"))
    units = written(units.groupBy(GROUP).agg(F.collect_list(F.struct("shard", "n")).alias("parts")), "units")
    held = units.select(F.explode("parts").alias("p")).select("p.*")
    over = [r // OVER for r in room]
    left = [r + x - n for r, x, n in zip(room, over, _loads(held, shards), strict=True)]
    settled = propagate(units.filter(F.size("parts") > 1), shards, left).union(units.filter(F.size("parts") == 1))
    left = [r - x for r, x in zip(left, over, strict=True)]
    settled = level(settled, shards, [r - x for r, x in zip(room, left, strict=True)], left)
    units = settled.select(*GROUP, F.explode("parts").alias("p")).select(*GROUP, "p.shard", "p.n").union(fixed)

    # Members get their unit by rank in the group.
    to = Window.partitionBy(GROUP).orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = units.withColumn("end", F.sum("n").over(to)).groupBy(GROUP)
    # Written before the join, so that the rows of a hot group can be split over tasks.
    ends = written(ends.agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("ends")), "ends")
    placed = nodes.join(ends, GROUP, "left")
    members = rank_within(placed.filter("ends is not null"), GROUP, parts, "r")
    own = F.get(F.filter("ends", lambda e: e["end"] > F.col("r")), F.lit(0))["shard"]
    cols = ["rid", "doc_id", "size", "text_crc32"]
    members = written(rank_within(members.select(*cols, own.alias("shard")), ["shard"], parts, "slot"), "members")

    # What exceeds a quota, and all rows without links, fill the remaining slots.
    fits = F.col("slot") < _from_list(quota, F.col("shard"))
    held = [min(q, n) for q, n in zip(quota, _loads(members.withColumn("n", F.lit(1)), shards), strict=True)]
    fill = [sum(quota[:s]) - sum(held[:s]) for s in range(shards + 1)]
    rest = placed.filter("ends is null").select(cols).union(members.filter(~fits).select(cols))
    rest = rank_within(rest, [], parts, "f")
    at = F.size(F.filter(F.array(*[F.lit(x) for x in fill[1:]]), lambda e: e <= F.col("f")))
    slot = F.col("f") - _from_list(fill, F.col("shard")) + _from_list(held, F.col("shard"))
    rest = rest.withColumn("shard", at).withColumn("slot", slot)
    out = members.filter(fits).select(*cols, "shard", "slot").union(rest.select(*cols, "shard", "slot"))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
