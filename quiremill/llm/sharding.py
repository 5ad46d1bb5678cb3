"""Sharding over fixed virtual slots with a versioned slot-to-shard map. DataFrame operations only.

Records are hashed into ``n_slots`` virtual slots, bytes are added up per slot, and a map that has one row per slot says
which shard holds it. The map is kept at a path of its own and the newest version is loaded there; it is the only thing that rebalancing
edits: slots leave the fullest shards for the emptiest until they are even, and a new version is stored beside the older ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiremill.llm.common import checkpointed, exists, local_frame

#: Virtual slots; the map and the bytes per slot have this many rows at most, at any size of input.
SLOTS = 4096
MAP_SCHEMA = "version int, slot int, shard int, bytes long, rows long"
#: Parts of a slot that number their rows by themselves.
PARTS = 16
#: A map is edited if a shard's bytes are further from the mean than this share of it.
UNEVEN = 0.005


def records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = SLOTS) -> DataFrame:
    """(id, size, text_crc32, virtual_slot, part) of every row. size: UTF-8 bytes of the text (null: none) plus 1; the CRC of a null text is 0.

    A record is its id, size and CRC: rows that share an id, or have none, don't share a slot, which would be as large as they are many; an edited text is another
    record. part: of the input's partitions, ``PARTS`` by turns.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    slim = df.select(F.col(id_col).alias(id_col), size.alias("size"), F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part"))
    return slim.withColumn("virtual_slot", F.pmod(F.xxhash64(id_col, "size", "text_crc32"), F.lit(n_slots)).cast("int"))


def balanced_map(loads: Sequence[tuple[int, int, int]], n_shards: int) -> dict[int, int]:
    """Slot to shard: the largest slot that is left goes to the shard with the fewest bytes, ties to the lower shard."""
    heap, found = [(0, s) for s in range(n_shards)], {}
    for slot, size, _ in sorted(loads, key=lambda x: (-x[1], x[0])):
        held, shard = heapq.heappop(heap)
        found[slot] = shard
        heapq.heappush(heap, (held + size, shard))
    return found


def grown_map(held: dict[int, int], loads: Sequence[tuple[int, int, int]]) -> dict[int, int]:
    """The map with one more shard: slots leave the fullest shards for the new one until it has its share; none moves elsewhere."""
    size, new = {s: b for s, b, _ in loads}, max(held.values(), default=-1) + 1
    share, totals, out, own = sum(size.values()) / (new + 1), {}, dict(held), {}
    for slot, shard in held.items():
        totals[shard] = totals.get(shard, 0) + size.get(slot, 0)
        own.setdefault(shard, []).append((size.get(slot, 0), slot))
    for slots in own.values():
        slots.sort()
    got = 0
    heap = [(-b, s) for s, b in sorted(totals.items())]
    heapq.heapify(heap)
    while heap and got < share:
        b, shard = heapq.heappop(heap)
        fits = [x for x in own[shard] if got + x[0] <= share]
        if not fits:
            continue
        moved = fits[-1]
        own[shard].remove(moved)
        out[moved[1]] = new
        got += moved[0]
        heapq.heappush(heap, (b + moved[0], shard))
    return out


def rebalanced(held: dict[int, int], loads: Sequence[tuple[int, int, int]], n_shards: int, uneven: float = UNEVEN) -> dict[int, int]:
    """The map edited: slots without a shard (or one that is no more) go to the emptiest ones, the largest first; then a slot moves from the fullest to the emptiest shard while that evens them."""
    size = {s: b for s, b, _ in loads}
    out = {s: held[s] for s in size if held.get(s, n_shards) < n_shards}
    own: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    total = [0] * n_shards
    for s, shard in out.items():
        own[shard].append((size[s], s))
        total[shard] += size[s]
    for b, s in sorted(((b, s) for s, b in size.items() if s not in out), key=lambda x: (-x[0], x[1])):
        shard = min(range(n_shards), key=lambda k: (total[k], k))
        out[s] = shard
        own[shard].append((b, s))
        total[shard] += b
    mean = sum(total) / n_shards
    while True:
        full, low = max(range(n_shards), key=lambda k: (total[k], -k)), min(range(n_shards), key=lambda k: (total[k], k))
        gap = total[full] - total[low]
        fits = [x for x in own[full] if 0 < x[0] < gap]
        if max(total[full] - mean, mean - total[low]) <= uneven * mean or not fits:
            return out
        b, s = moved = min(fits, key=lambda x: (abs(gap - 2 * x[0]), x[1]))
        own[full].remove(moved)
        own[low].append(moved)
        out[s] = low
        total[full] -= b
        total[low] += b


def map_rows(held: dict[int, int], loads: Sequence[tuple[int, int, int]], version: int) -> list[tuple]:
    """Rows of MAP_SCHEMA; slots that have no rows now keep their shard."""
    sizes = {slot: (size, rows) for slot, size, rows in loads}
    return [(version, slot, shard, *sizes.get(slot, (0, 0))) for slot, shard in sorted(held.items())]


def first_rows(held: dict[int, int], loads: Sequence[tuple[int, int, int]]) -> list[tuple]:
    """(slot, shard, rows of the shard in the slots before it): row numbers within slots give gapless ones within shards."""
    before, out = {}, []
    for slot, _, rows in sorted(loads):
        out.append((slot, held[slot], before.get(held[slot], 0)))
        before[held[slot]] = before.get(held[slot], 0) + rows
    return out


def store_map(spark: SparkSession, rows: Sequence[tuple], path: str) -> None:
    """Adds a version to the map table at ``path``; versions that are there stay."""
    local_frame(spark, rows, MAP_SCHEMA).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map, the newest unless given."""
    table = spark.read.schema(MAP_SCHEMA).parquet(path)
    wanted = version if version is not None else table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == F.lit(wanted))


def current_map(spark: SparkSession, path: str, loads: Sequence[tuple[int, int, int]], n_shards: int, uneven: float = UNEVEN) -> dict[int, int]:
    """The newest map at ``path`` if its shards are even under these loads; else the map edited, or a first one, stored as the next version."""
    stored = load_map(spark, path) if exists(spark, path) else None
    old = {r.slot: (r.shard, r.version) for r in stored.collect()} if stored is not None else {}  # n_slots rows at most
    held = {s: x[0] for s, x in old.items()}
    new = rebalanced(held, loads, n_shards, uneven) if held else balanced_map(loads, n_shards)
    if loads and new != {s: held.get(s) for s in new}:
        store_map(spark, map_rows(held | new, loads, max((x[1] for x in old.values()), default=-1) + 1), path)
    return new


def shard(df: DataFrame, path: str, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", n_slots: int = SLOTS) -> DataFrame:
    """Every row's shard under the map at ``path``: id, size, text_crc32, shard, slot, virtual_slot.

    The newest version of the map holds as long as its shards are even; it is edited and stored as a new version if they are not, or made if there is none.
    ``slot`` numbers a shard's rows from 0 without gaps. Law: shards get nearly equal bytes (rows with equal id, size and
    CRC share a virtual slot). Null ids and texts are values like others; rows that are repeated each get a number of
    their own; long texts count by their bytes; an empty table gives no rows and no map. Other columns of ``df`` are ignored.
    """
    spark, rows = df.sparkSession, checkpointed(records(df, id_col, text_col, n_slots))
    parts = checkpointed(rows.groupBy("virtual_slot", "part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")))  # n_slots * PARTS rows at most
    loads = [(r.virtual_slot, r.b, r.n) for r in parts.groupBy("virtual_slot").agg(F.sum("b").alias("b"), F.sum("n").alias("n")).orderBy("virtual_slot").collect()]
    held = local_frame(spark, first_rows(current_map(spark, path, loads, n_shards), loads), "virtual_slot int, shard int, first_row long")
    before = F.sum("n").over(Window.partitionBy("virtual_slot").orderBy("part")) - F.col("n")
    placed = parts.withColumn("before", before).join(F.broadcast(held), "virtual_slot").select("virtual_slot", "part", "shard", (F.col("first_row") + F.col("before")).alias("first_row"))
    order = Window.partitionBy("virtual_slot", "part").orderBy(id_col, "text_crc32", "size")
    numbered = rows.withColumn("_n", F.row_number().over(order))
    return numbered.join(F.broadcast(placed), ["virtual_slot", "part"]).select(id_col, "size", "text_crc32", "shard", (F.col("first_row") + F.col("_n") - 1).cast("long").alias("slot"), "virtual_slot")
