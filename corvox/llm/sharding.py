"""Resharding by minimum-cost flow: which blocks of which shard move where, so that the fewest bytes move."""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

#: The plan of a rewrite that is being published, in the layout's folder.
PUBLISHING = "_publishing"


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Bytes to send from each old shard to each new one so that all supply is placed at least cost: successive
    shortest paths with potentials. The graph has old plus new shards as nodes, whatever the number of documents."""
    n, m = len(supply), len(capacity)
    flow, left, room = [[0] * m for _ in range(n)], list(supply), list(capacity)
    potential = [0] * (n + m)
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards can't hold all bytes")
    while any(left):
        distance, came = [float("inf")] * (n + m), [-1] * (n + m)
        queue = [(0, i) for i in range(n) if left[i]]
        for _, i in queue:
            distance[i] = 0
        heapq.heapify(queue)
        while queue:
            d, u = heapq.heappop(queue)
            if d > distance[u]:
                continue
            ahead = ((n + j, cost[u][j]) for j in range(m)) if u < n else ((i, -cost[i][u - n]) for i in range(n) if flow[i][u - n])
            for v, c in ahead:
                reached = d + c + potential[u] - potential[v]
                if reached < distance[v]:
                    distance[v], came[v] = reached, u
                    heapq.heappush(queue, (reached, v))
        end = min((j for j in range(m) if room[j]), key=lambda j: distance[n + j] + potential[n + j])
        for v in range(n + m):
            if distance[v] < float("inf"):
                potential[v] += distance[v]
        path, v = [], n + end
        while came[v] >= 0:
            path.append((came[v], v))
            v = came[v]
        amount = min([left[v], room[end]] + [flow[b][a - n] for a, b in path if a >= n])
        for a, b in path:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[v] -= amount
        room[end] -= amount
    return flow


def transfers(blocks: list[tuple[int, int, int]], capacity: list[int]) -> list[tuple[int, int, int, int]]:
    """blocks: (old shard, block, bytes). A block's byte ranges and the new shards that get them, as (block, first
    byte, byte after the last, new shard), such that each new shard gets the bytes that the flow gives it and as few
    as can be change their shard. Blocks are taken in order, so all but a few go whole."""
    old = sorted({x[0] for x in blocks})
    supply = [sum(x[2] for x in blocks if x[0] == k) for k in old]
    flow = min_cost_flow(supply, capacity, [[int(k != j) for j in range(len(capacity))] for k in old])
    out = []
    for k, row in zip(old, flow, strict=True):
        # what stays is taken first, then what goes to each other shard
        due = sorted(([j, x] for j, x in enumerate(row) if x), key=lambda d: (d[0] != k, d[0]))
        for _, block, size in sorted(x for x in blocks if x[0] == k):
            at = 0
            while at < size:
                take = min(due[0][1], size - at)
                out.append((block, at, at + take, due[0][0]))
                at += take
                due[0][1] -= take
                if not due[0][1]:
                    due.pop(0)
    return out


def reshard(docs: DataFrame, shards: int, old_shard: Column, old_shards: int, blocks_per_shard: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """New shards of near equal bytes from an old layout, moving as few bytes as that takes: doc_id, size (UTF-8
    bytes of the text plus 1), text_crc32 (of an empty text, where it is null), old_shard, shard, slot (gapless from
    0 within a shard), moved.

    old_shard says where a row lies, from 0 to old_shards - 1. Each old shard has blocks_per_shard blocks by the hash
    of the id; only the blocks' sizes (old_shards * blocks_per_shard rows) reach the driver, which solves the flow.
    A block that goes to several shards is cut at the row in whose middle the flow's byte lies, so a shard's size
    misses its share by a few rows at most. Rows of a block are ordered by id (null first), checksum and size; equal
    rows are told apart by nothing, so which of them lies where doesn't matter. Empty table: no rows. Other columns
    are ignored. One row of huge size is never split: its shard is then larger than the others."""
    spark, text = docs.sparkSession, docs[text_col].cast("string")
    old = F.coalesce(old_shard.cast("int"), F.lit(0))
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        old.alias("old_shard"),
    )
    # rows of one id lie in different blocks unless they are equal
    part = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks_per_shard)).cast("int")
    rows = written(rows.withColumn("block", F.col("old_shard") * blocks_per_shard + part), "sizes")
    sizes = [(r.old_shard, r.block, r.bytes) for r in rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes")).collect()]
    total = sum(x[2] for x in sizes)
    capacity = [total * (k + 1) // shards - total * k // shards for k in range(shards)]
    plan: dict[int, list] = {}
    for block, first, end, shard in transfers(sizes, capacity):
        plan.setdefault(block, []).append((first, end, shard))
    plan_rows = [(block, [dict(first=a, until=b, shard=s) for a, b, s in parts]) for block, parts in plan.items()]
    plan_df = spark.createDataFrame(plan_rows, "block int, parts array<struct<first: long, until: long, shard: int>>")
    order = Window.partitionBy("block").orderBy("doc_id", "text_crc32", "size")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    middle = F.col("before") + F.floor(F.col("size") / 2)
    placed = (
        rows.withColumn("before", before)
        .withColumn("at", F.row_number().over(order))
        .join(F.broadcast(plan_df), "block")  # at most old_shards * blocks_per_shard rows
        .withColumn("shard", F.filter("parts", lambda p: (p["first"] <= middle) & (middle < p["until"]))[0]["shard"])
        .drop("parts", "before")
    )
    placed = written(placed, "placed")
    runs = placed.groupBy("shard", "block").agg(F.min("at").alias("first_at"), F.count("*").alias("n")).collect()
    offsets, used = [], dict.fromkeys(range(shards), 0)
    for r in sorted(runs, key=lambda r: (r.shard, r.block)):
        offsets.append((r.shard, r.block, used[r.shard] - r.first_at))
        used[r.shard] += r.n
    offsets_df = spark.createDataFrame(offsets, "shard int, block int, shift long")
    return placed.join(F.broadcast(offsets_df), ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("at") + F.col("shift")).alias("slot"), (F.col("shard") != F.col("old_shard")).alias("moved")
    )


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of path and a function that makes its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def finish_rewrite(spark: SparkSession, path: str) -> bool:
    """Ends a rewrite() that was broken off while it published: shards that lie ready replace the old ones, and those
    that hold nothing any more go. Any number of times, with the same result. False if there was nothing to end."""
    files, make = _files(spark, path)
    plan = make(f"{path}/{PUBLISHING}")
    if not files.exists(plan):
        return False
    steps = [(r.shard, r.ready) for r in spark.read.schema("shard int, ready string").json(str(plan.toString())).collect()]  # a row a shard
    for shard, ready in steps:
        source = make(f"{ready}/shard={shard}") if ready else None
        if source is None or files.exists(source):  # else it is in its place already
            files.delete(make(f"{path}/shard={shard}"), True)
        if source is not None and files.exists(source) and not files.rename(source, make(f"{path}/shard={shard}")):
            raise OSError(f"shard {shard} of {path} can't be put in its place")
    files.delete(plan, True)
    for ready in {r for _, r in steps if r}:
        files.delete(make(ready), True)
    return True


def rewrite(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", files_per_shard: int = 8, text_col: str = "text") -> list[int]:
    """Writes the rows of docs to path/shard=K; only shards that a moved row leaves or enters are written again, and
    those of rows of one id, size and checksum that lay in several shards, as nothing tells which is which. Returns
    these. placed is what reshard() returned: each of its rows is written once, null and repeated ids too; a shard that
    all rows leave is gone afterwards. No moved row, or an empty table: nothing is changed.

    The new shards are written beside the old ones, where readers of path don't look, and counted; docs may be read
    from path itself. Then a plan of what replaces what is written, and carried out. A driver that is lost before that
    leaves the old layout, after it the new one as soon as finish_rewrite(), or the next rewrite(), has been called."""
    spark = docs.sparkSession
    finish_rewrite(spark, path)
    key = ["doc_id", "size", "text_crc32"]
    ends = F.explode(F.array("old_shard", "shard")).alias("s")
    apart = placed.groupBy(*key).agg(F.min("old_shard").alias("a"), F.max("old_shard").alias("b"), F.collect_set("shard").alias("to"), F.collect_set("old_shard").alias("of"))
    found = placed.where("moved").select(ends).union(apart.where("a <> b").select(F.explode(F.array_union("to", "of"))))
    affected = sorted(r.s for r in found.distinct().collect())
    if not affected:
        return []
    nth = lambda order: F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    where = placed.withColumn("nth", nth(["shard", "slot"])).where(F.col("shard").isin(affected)).select(*(F.col(c).alias(f"{c}_") for c in key), F.col("nth").alias("nth_"), "shard")
    text = docs[text_col].cast("string")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "shard")).alias("row"),
        docs[id_col].cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    # rows of one key are numbered by what they hold, so a task that runs again numbers them the same
    rows = rows.withColumn("nth", nth([F.xxhash64(F.to_json("row"))]))
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("size") == F.col("size_")) & (F.col("text_crc32") == F.col("text_crc32_")) & (F.col("nth") == F.col("nth_"))
    out = rows.join(where, same).select("row.*", "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(files_per_shard)).alias("part_"))
    out = out.repartition("shard", "part_").drop("part_")
    ready = f"{path}/_resharded-{uuid.uuid4().hex}"
    out.write.partitionBy("shard").parquet(ready)
    count = lambda df: {r["shard"]: r["count"] for r in df.groupBy("shard").count().collect()}
    want, got = count(placed.where(F.col("shard").isin(affected))), count(spark.read.schema(out.schema).parquet(ready).select("shard"))
    if want != got:
        _files(spark, ready)[0].delete(_files(spark, ready)[1](ready), True)
        raise ValueError(f"docs aren't the rows that were placed: shards should have {want} rows, and have {got}")
    steps = spark.createDataFrame([(k, ready if k in got else None) for k in affected], "shard int, ready string")
    steps.coalesce(1).write.json(f"{path}/{PUBLISHING}-")
    files, make = _files(spark, path)
    files.rename(make(f"{path}/{PUBLISHING}-"), make(f"{path}/{PUBLISHING}"))  # from here on the new layout holds
    finish_rewrite(spark, path)
    return affected
