"""Resharding by minimum-cost flow: the fewest bytes move from old shards to new capacities."""

from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import cleanup, stage

BLOCKS = 1024
FILE_BYTES = 64 << 20  # a shard's file holds whole blocks that begin within so many bytes


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost) -> list[list[int]]:
    """Bytes to send from each old to each new shard at least total cost, ``cost(i, j)`` a byte.

    Successive shortest paths over the small bipartite graph; supply and capacity must have equal sums.
    """
    if sum(supply) != sum(capacity):
        raise ValueError("supply and capacity differ")
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    head, room, price = [], [], []

    def edge(a: int, b: int, most: int, each: int) -> None:
        for x, y, r, p in ((a, b, most, each), (b, a, 0, -each)):
            graph[x].append(len(head))
            head.append(y)
            room.append(r)
            price.append(p)

    for i in range(n):
        edge(source, i, supply[i], 0)
    for j in range(m):
        edge(n + j, sink, capacity[j], 0)
    first = len(head)
    for i in range(n):
        for j in range(m):
            edge(i, n + j, min(supply[i], capacity[j]), cost(i, j))
    while True:
        best, via, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in graph[a]:
                if room[e] and best[a] + price[e] < best.get(head[e], 1 << 62):
                    best[head[e]], via[head[e]] = best[a] + price[e], e
                    if head[e] not in queued:
                        queue.append(head[e])
                        queued.add(head[e])
        if sink not in best:
            break
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = head[via[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    return [[room[(first + 2 * (i * m + j)) ^ 1] for j in range(m)] for i in range(n)]


def plan_transfers(blocks: dict[tuple[int, int], int], weights: Sequence[float], n_old: int) -> dict[tuple[int, int], int]:
    """New shard of each (old shard, block), given the blocks' bytes and the new shards' weights.

    The flow says how many bytes go where; whole blocks realise it, long ones
    first, and what they leave over is carried to the next old shard.
    """
    supply = [0] * n_old
    for (old, _), size in blocks.items():
        supply[old] += size
    total, sum_w = sum(supply), sum(weights)
    capacity = [int(total * w / sum_w) for w in weights]
    for j in range(total - sum(capacity)):
        capacity[j % len(capacity)] += 1
    flow = min_cost_flow(supply, capacity, lambda i, j: int(i != j))
    plan, carry = {}, [0] * len(weights)
    for old in range(n_old):
        left = [f + c for f, c in zip(flow[old], carry, strict=True)]
        for size, block in sorted(((s, b) for (o, b), s in blocks.items() if o == old), reverse=True):
            to = max(range(len(left)), key=lambda j: (left[j], j == old))
            left[to] -= size
            plan[old, block] = to
        carry = left
    return plan


def with_blocks(docs: DataFrame, old_shard, n_old: int, blocks: int = BLOCKS) -> DataFrame:
    """Adds ``old_shard``, ``block`` and ``size``: UTF-8 bytes plus one; columns of these names are replaced.

    Every row is dealt to a block for itself, so rows that share an id, a text or both, or have none, are spread like
    others. Stage the rows before they are used twice, as ``reshard`` does.
    """
    return docs.withColumns({
        "old_shard": F.pmod(old_shard, F.lit(n_old)).cast("int"),
        "block": F.pmod(F.xxhash64(F.col("doc_id"), F.monotonically_increasing_id()), F.lit(blocks)).cast("int"),
        "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1,
    })


def reshard(blocked: DataFrame, weights: Sequence[float], n_old: int, order: Sequence[str] = ("doc_id",), grown: Sequence[float] = ()) -> DataFrame:
    """Adds ``shard`` and ``slot``, gapless from 0 in each shard; columns of these names are replaced.

    With ``grown``, the weights of a larger set of shards, also ``grown_shard``: where the row goes when the new shards
    become these, again at the least bytes moved.
    The driver sees one row a block: ``n_old`` times the number of blocks at most.
    Rows are numbered within their block; blocks take consecutive ranges of slots. Rows are shuffled once, to the task that
    can write their part of a shard, and come in order of their slots.
    Ties in ``order`` are numbered in any order; no rows give no rows.
    """
    blocked = stage(blocked.drop("shard", "slot", *["grown_shard"] * bool(grown)), "blocked")
    found = blocked.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    plan = plan_transfers({(r.old_shard, r.block): r.bytes for r in found}, weights, n_old)
    later = plan_transfers({(plan[r.old_shard, r.block], (r.old_shard, r.block)): r.bytes for r in found}, grown, len(weights)) if grown else {}
    places, filled, written = [], [0] * len(weights), [0] * len(weights)
    for r in sorted(found, key=lambda r: (r.old_shard, r.block)):
        to = plan[r.old_shard, r.block]
        places.append((r.old_shard, r.block, to, filled[to], written[to] // FILE_BYTES, later.get((to, (r.old_shard, r.block)))))
        filled[to] += r.rows
        written[to] += r.bytes
    taken = {c.lower() for c in blocked.columns}
    nr, before, file, then = (next(n for n in (w + "_" * i for i in range(len(taken) + 1)) if n not in taken) for w in ("nr", "before", "file", "grown_shard"))
    types = (("old_shard", "int"), ("block", "int"), ("shard", "int"), (before, "long"), (file, "long"), (then, "int"))
    moved = F.broadcast(blocked.sparkSession.createDataFrame(places, ", ".join(f"{n} {t}" for n, t in types)))
    keys = ", ".join(f"`{c}`" for c in order)
    dealt = blocked.join(moved, ["old_shard", "block"]).repartition("shard", file)
    # A block lies in one file, so that the window needs no shuffle of its own.
    numbered = dealt.selectExpr("*", f"row_number() OVER (PARTITION BY shard, {file}, old_shard, block ORDER BY {keys}) AS {nr}")
    return numbered.withColumn("slot", F.col(before) + F.col(nr) - 1).drop(before, nr, file, *[then] * (not grown))


def write_shards(resharded: DataFrame, folder: str, only: Sequence[int] | None = None) -> None:
    """Write the rows, dealt as ``reshard`` does, as ``folder/shard=N``; with ``only``, replace just these shards' files."""
    rows = resharded if only is None else resharded.where(F.col("shard").isin(list(only)))
    writer = rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd")
    with cleanup(rows.sparkSession):
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(folder)


def read_shards(resharded: DataFrame, folder: str) -> DataFrame:
    """The rows that ``write_shards`` wrote."""
    return resharded.sparkSession.read.schema(resharded.schema).parquet(folder)


def affected(resharded: DataFrame, n_old: int, n_new: int) -> list[int]:
    """New shards that gain or lose a block; the files of the others can stay as they are."""
    moved = resharded.where("old_shard <> shard").select("old_shard", "shard").distinct().collect()
    changed = {r.old_shard for r in moved} | {r.shard for r in moved} | set(range(n_old, n_new))
    return sorted(s for s in changed if s < n_new)
