"""Minimum-cost-flow resharding.

Old shard sizes and new capacities make a transport problem over shards (never over documents); its
solution says how many bytes each old shard hands to each new one, moving as few as possible. Documents
of a shard stand in a fixed order (large ones first, so that the cut between two receivers falls among
small ones), grouped in blocks; an amount to transfer is an interval of that order, so whole blocks move
and only the blocks at a cut are divided between documents.

Nulls: a null text has 0 bytes, a null id belongs to old shard 0 like any other row. Empty tables give no
rows and no transfers. Repeated rows are all placed, each with its own slot. Ties in size are ordered by a
hash of the id, then by id. Extra columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Sub-blocks of each size class of a shard: a hot size is spread over so many tasks.
SUBBLOCKS = 64


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """flow[i][j] >= 0 with row sums supply, column sums <= capacity and least total cost
    (successive shortest paths with potentials; the graph has as many nodes as shards)."""
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are smaller than what they must hold")
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(n + m + 2)]  # [to, left, cost, index of the reverse]

    def edge(a: int, b: int, most: int, price: int) -> None:
        graph[a].append([b, most, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for i in range(n):
        edge(source, i, supply[i], 0)
        for j in range(m):
            edge(i, n + j, supply[i], cost[i][j])
    for j in range(m):
        edge(n + j, sink, capacity[j], 0)
    potential = [0] * (n + m + 2)
    left = sum(supply)
    while left:
        far: list[float] = [float("inf")] * (n + m + 2)
        via: list[tuple[int, int]] = [(-1, -1)] * (n + m + 2)
        far[source] = 0
        heap = [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for k, (b, most, price, _) in enumerate(graph[a]):
                if most and (e := d + price + potential[a] - potential[b]) < far[b]:
                    far[b], via[b] = e, (a, k)
                    heapq.heappush(heap, (e, b))
        for v, d in enumerate(far):
            if d < float("inf"):
                potential[v] += int(d)
        push, v = left, sink
        while v != source:
            a, k = via[v]
            push, v = min(push, graph[a][k][1]), a
        v = sink
        while v != source:
            a, k = via[v]
            graph[a][k][1] -= push
            graph[v][graph[a][k][3]][1] += push
            v = a
        left -= push
    flow = [[0] * m for _ in range(n)]
    for i in range(n):
        for b, left_over, _, _ in graph[i]:
            if n <= b < n + m:
                flow[i][b - n] = supply[i] - left_over
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


@dataclass
class Plan:
    """flow[i][j]: bytes from old shard i to new shard j; moved: bytes that change shard;
    affected: shards that gain or lose anything, whose files must be rewritten."""

    flow: list[list[int]]

    @property
    def moved(self) -> int:
        return sum(x for i, row in enumerate(self.flow) for j, x in enumerate(row) if i != j)

    @property
    def affected(self) -> list[int]:
        return sorted({s for i, row in enumerate(self.flow) for j, x in enumerate(row) if i != j and x for s in (i, j)})

    def intervals(self, i: int) -> list[tuple[int, int]]:
        """(end, new shard): what stays comes first, then the receivers in order."""
        row = self.flow[i]
        order = sorted((j for j, x in enumerate(row) if x), key=lambda j: (j != i, j))
        out, at = [], 0
        for j in order:
            at += row[j]
            out.append((at, j))
        return out


def plan(old_sizes: list[int], capacities: list[int]) -> Plan:
    return Plan(min_cost_flow(old_sizes, capacities, [[int(i != j) for j in range(len(capacities))] for i in range(len(old_sizes))]))


def _blocks(docs: DataFrame, old: Column) -> DataFrame:
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long")
    return docs.select("doc_id", "text", size.alias("size"), old.cast("int").alias("old")).withColumns(
        {"cls": F.floor(F.log2(F.col("size").cast("double")) * 8).cast("int"), "sub": F.pmod(F.xxhash64("doc_id"), F.lit(SUBBLOCKS)).cast("int")}
    )


def reshard(docs: DataFrame, old: Column, n_old: int, n_new: int) -> tuple[DataFrame, Plan]:
    """(doc_id, text, size, old, shard, slot) of every row, with new shards of nearly equal bytes, and the plan.
    The driver sees one number a shard; block totals (a bounded count: shards x size classes x SUBBLOCKS) are broadcast."""
    rows = _blocks(docs, old)
    key = ["old", "cls", "sub"]
    totals = common.materialize(rows.groupBy(*key).agg(F.sum("size").alias("bytes")))
    sizes = {r.old: r.bytes for r in totals.groupBy("old").agg(F.sum("bytes").alias("bytes")).collect()}
    old_sizes = [int(sizes.get(i, 0)) for i in range(n_old)]
    found = plan(old_sizes, even_capacities(sum(old_sizes), n_new))
    in_order = Window.partitionBy("old").orderBy(F.desc("cls"), "sub").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*key, F.coalesce(F.sum("bytes").over(in_order), F.lit(0)).alias("base"))
    within = Window.partitionBy(*key).orderBy("doc_id", "size", "text").rowsBetween(Window.unboundedPreceding, -1)

    def placed(x: DataFrame, order: Window) -> DataFrame:
        at = F.col("base") + F.coalesce(F.sum("size").over(order), F.lit(0)) + F.floor(F.col("size") / 2)
        shard = F.lit(None).cast("int")
        for i in range(n_old):
            inner = None
            ends = found.intervals(i)
            for end, j in ends[:-1]:
                inner = F.when(F.col("at") < end, j) if inner is None else inner.when(F.col("at") < end, j)
            if ends:
                last = F.lit(ends[-1][1])
                shard = F.when(F.col("old") == i, last if inner is None else inner.otherwise(last)).otherwise(shard)
        return x.join(F.broadcast(base), key).withColumn("at", at).withColumn("shard", shard.cast("int"))

    light = placed(rows.select("doc_id", "size", *key, F.xxhash64("text").alias("text")), within)
    counts = common.materialize(light.groupBy(*key, "shard").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("shard").orderBy("old", F.desc("cls"), "sub").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*key, "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    hashed = Window.partitionBy(*key).orderBy("doc_id", "size", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
    slot = Window.partitionBy(*key, "shard").orderBy("at", "doc_id", F.xxhash64("text"))
    out = placed(rows, hashed).join(F.broadcast(first), [*key, "shard"]).withColumn("slot", F.col("first") + F.row_number().over(slot) - 1)
    return out.select("doc_id", "text", "size", "old", "shard", F.col("slot").cast("long")), found


def rewrite(placed: DataFrame, path: str, shards: list[int] | None = None) -> None:
    """Writes one folder a shard below path; given shards, only those, leaving the others' files alone."""
    if shards is not None:
        placed = placed.where(F.col("shard").isin([int(s) for s in shards]))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """Twelve old shards by a hash of the id become sixteen of equal bytes; digests come from the files read back."""
    docs = common.read(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(12))
    placed, _ = reshard(docs, old, 12, 16)
    path = f"{common.scratch_dir(spark)}/shards"
    rewrite(placed, path)
    schema = "doc_id long, text string, size long, old int, slot long, shard int"
    back = spark.read.schema(schema).parquet(path)
    return back.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("old").alias("old_shard"),
    )
