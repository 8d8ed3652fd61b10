"""Resharding by minimum-cost flow: new shard sizes with the fewest bytes moved, then new files for changed shards.

The documents of an old shard are cut into blocks, ranges of doc_id. A flow network with the old shards as sources, the
new ones as sinks, and a cost of one for each byte that changes its shard says how many bytes go from where to where; whole
blocks then carry them out. All that the driver holds are the block sizes: their number is a parameter.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import ordered_buckets
from precinct.session import scratch_path

SHARDS = 24
OLD_SHARDS = 16
BLOCKS = 1024
# Bytes of documents that one task writes of a shard, or one range where a range has more.
PART_BYTES = 32 << 20


# --- The flow ---


def min_cost_flow(supply: list[int], demand: list[int], cost: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard: successive shortest paths with potentials.

    ``supply`` and ``demand`` have equal sums; the cost of a pair is 1 where ``cost`` does not say otherwise.
    """
    n_old, n_new = len(supply), len(demand)
    source, sink = n_old + n_new, n_old + n_new + 1
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    to, room, price = [], [], []

    def edge(a: int, b: int, capacity: int, c: int) -> None:
        for end, cap, k in ((b, capacity, c), (a, 0, -c)):
            graph[a if end == b else b].append(len(to))
            to.append(end)
            room.append(cap)
            price.append(k)

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
    for j, d in enumerate(demand):
        edge(n_old + j, sink, d, 0)
    for i in range(n_old):
        for j in range(n_new):
            edge(i, n_old + j, min(supply[i], demand[j]), cost.get((i, j), 1))
    potential = [0] * (sink + 1)
    while True:
        far = [None] * (sink + 1)
        via = [-1] * (sink + 1)
        far[source] = 0
        queue = [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in graph[a]:
                b, step = to[e], d + price[e] + potential[a] - potential[to[e]]
                if room[e] and (far[b] is None or step < far[b]):
                    far[b], via[b] = step, e
                    heapq.heappush(queue, (step, b))
        if far[sink] is None:
            break
        potential = [p + (f if f is not None else far[sink]) for p, f in zip(potential, far)]
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = to[via[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    flows = {}
    for i in range(n_old):
        for e in graph[i]:
            if not e % 2 and room[e ^ 1]:
                flows[i, to[e] - n_old] = room[e ^ 1]
    return flows


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def assign_blocks(
    blocks: list[tuple[int, int, int]], flows: dict[tuple[int, int], int], capacities: list[int]
) -> dict[tuple[int, int], int]:
    """The new shard of each block (old shard, block number, bytes), following the flows.

    Blocks go, largest first, to the new shard with most of its old shard's flow left, while one can take it whole;
    the others follow, largest first, to the shard with most room left. So the small blocks even out the sizes.
    """
    left, room, out, rest = dict(flows), list(capacities), {}, []
    by_old: dict[int, list[int]] = {}
    for i, j in flows:
        by_old.setdefault(i, []).append(j)
    for old, block, size in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        choices = by_old.get(old, [])
        new = max(choices, key=lambda j: (left[old, j], -j), default=None)
        if new is None or left[old, new] < size or room[new] < size:
            rest.append((old, block, size))
            continue
        left[old, new] -= size
        room[new] -= size
        out[old, block] = new
    for old, block, size in rest:
        new = max(range(len(room)), key=lambda j: (room[j], left.get((old, j), 0)))
        room[new] -= size
        out[old, block] = new
    return out


# --- The tables ---


class Resharding:
    """A plan that brings ``docs`` from their ``old_shard`` (null: no shard yet) into shards of equal bytes.

    A document counts the UTF-8 bytes of its text (null: none) plus 8. Null doc_ids form the last block of their shard.
    Rows with one doc_id fall into one block unless a hash of their texts tells them apart. ``plan`` has one row for
    each block: old_shard, block, shard, rows, bytes, and ``first_slot``, where its rows begin in the new shard.
    Blocks stand in a shard in the order of their ranges of doc_id, then of their old shards.
    """

    def __init__(self, docs: DataFrame, old_shards: int, shards: int = SHARDS, blocks: int = BLOCKS):
        spark = docs.sparkSession
        size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 8
        rows = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("old_shard", F.lit(-1)).cast("int").alias("old_shard"),
            size.alias("size"),
        )
        rows, count = ordered_buckets(rows, "doc_id", blocks, "range")
        # A range is split once more by text, so that rows that repeat one doc_id do not make one large block.
        self.rows = rows.withColumn("block", F.col("range") * 4 + F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % 4)
        self.rows = self.rows.withColumn("block", F.col("block").cast("int"))
        found = self.rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
        # Old shard number i is new shard number i while there is one; rows without a shard come from a source of their own.
        olds = [*range(old_shards), -1]
        supply = [sum(r["bytes"] for r in found if r["old_shard"] == o) for o in olds]
        self.capacities = even_capacities(sum(supply), shards)
        flows = min_cost_flow(supply, self.capacities, {(i, i): 0 for i in range(min(old_shards, shards))})
        self.flows = {(olds[i], j): x for (i, j), x in flows.items()}
        self.moved = sum(x for (i, j), x in self.flows.items() if i != j)
        placed = assign_blocks([(r["old_shard"], r["block"], r["bytes"]) for r in found], self.flows, self.capacities)
        slots, plan = [0] * shards, []
        for r in sorted(found, key=lambda r: (r["block"], r["old_shard"])):
            new = placed[r["old_shard"], r["block"]]
            plan.append((r["old_shard"], r["block"], new, r["rows"], r["bytes"], slots[new]))
            slots[new] += r["rows"]
        gained = {p[2] for p in plan if p[0] != p[2]}
        lost = {p[0] for p in plan if p[0] != p[2]}
        self.affected = sorted((gained | lost) & set(range(shards)))
        schema = "old_shard int, block int, shard int, rows long, bytes long, first_slot long"
        self.plan = spark.createDataFrame(plan, schema)
        self.count = count

    def placed(self, only: list[int] | None = None, files: int = 1) -> DataFrame:
        """Rows with their new ``shard`` and ``slot``. The plan is bounded, so it is broadcast; texts are shuffled once.

        ``files`` splits each shard into so many parts by range, each of which one task writes.
        """
        plan = self.plan if only is None else self.plan.filter(F.col("shard").isin(only))
        rows = self.rows.join(F.broadcast(plan.drop("rows", "bytes")), ["old_shard", "block"])
        rows = rows.withColumn("part", F.floor(F.col("range") * files / self.count).cast("int"))
        own = Window.partitionBy("shard", "part", "block", "old_shard").orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
        rows = rows.repartition("shard", "part")
        slot = F.col("first_slot") + F.row_number().over(own) - 1
        return rows.select("doc_id", "text", "old_shard", "shard", slot.alias("slot"))

    def rewrite(self, folder: str | None = None) -> DataFrame:
        """Write the shards that gain or lose a block as Parquet, one folder for each, and read all shards back.

        Shards that stay as they are, are read from where they were. Without ``folder`` the files go to the
        shared folder.
        """
        spark = self.rows.sparkSession
        folder = folder or scratch_path(spark, "shards")
        shards = len(self.capacities)
        files = max(1, -(-max(self.capacities, default=0) // PART_BYTES))
        if not self.affected:
            return self.placed(files=files)
        self.placed(self.affected, files).write.partitionBy("shard").parquet(folder)
        written = spark.read.schema("doc_id long, text string, old_shard int, slot long, shard int").parquet(folder)
        same = [s for s in range(shards) if s not in set(self.affected)]
        return written.unionByName(self.placed(same, files)) if same else written


def old_layout(docs: DataFrame, old_shards: int = OLD_SHARDS) -> DataFrame:
    """``docs`` with the shard that a layout by source gives them: uneven, as sources are."""
    source = F.coalesce("source", F.lit("")).cast("binary")
    return docs.select("doc_id", "text", (F.crc32(source) % old_shards).cast("int").alias("old_shard"))
