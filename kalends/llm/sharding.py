"""Shards through fixed virtual slots.

A record's slot is a hash of its id (of its text, where it has none) and never changes. Bytes are summed per slot,
and a small stored table says which shard holds which slot. Rebalancing or growing reads its newest version, moves
a few slots and stores the next one; older versions can still be read, and records are found again through their slot.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.operators.numbering import global_row_number
from kalends.sources.versions import VersionedTable
from kalends.storage import Scratch, materialise

#: The map has one row per slot, so this bounds what the driver holds and what is broadcast.
SLOTS = 4096
MAP_SCHEMA = "virtual_slot int, shard int, slot_bytes long, slot_rows long"


def with_slots(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes and one), text_crc32 and virtual_slot of every row; the text itself stays behind."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return documents.select(
        "doc_id",
        (F.length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.sha2(raw, 256))), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.monotonically_increasing_id().alias("_row"),
    )


def slot_sizes(slotted: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(bytes, rows) of every slot: one row per slot reaches the driver."""
    sizes = [(0, 0)] * slots
    for row in slotted.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        sizes[row.virtual_slot] = (row.b, row.n)
    return sizes


def balanced_map(sizes: list[tuple[int, int]], shards: int) -> list[int]:
    """The first version: each slot, largest first, goes to the shard with the fewest bytes so far."""
    loads = [(0, shard) for shard in range(shards)]
    owner = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s][0], s)):
        load, shard = heapq.heappop(loads)
        owner[slot] = shard
        heapq.heappush(loads, (load + sizes[slot][0], shard))
    return owner


def grown_map(owner: list[int], sizes: list[tuple[int, int]], shards: int) -> list[int]:
    """The next version with one shard more: slots move only into the new shard, largest fitting ones first.

    Every old shard gives up what it holds above the new mean.
    """
    mean = sum(size for size, _ in sizes) / (shards + 1)
    excess = [-mean] * shards
    for slot, shard in enumerate(owner):
        excess[shard] += sizes[slot][0]
    edited = list(owner)
    for slot in sorted(range(len(owner)), key=lambda s: (-sizes[s][0], s)):
        if 0 < sizes[slot][0] <= excess[owner[slot]]:
            excess[owner[slot]] -= sizes[slot][0]
            edited[slot] = shards
    return edited


def rebalanced_map(owner: list[int], sizes: list[tuple[int, int]], shards: int) -> list[int]:
    """The next version for slots that have grown: shards above the mean give up slots to the one with the fewest bytes.

    Only shards that are above it to begin with give, and a slot moves only if the shard it goes to is then lighter than the
    one it comes from was, so few slots move.
    """
    loads = [0] * shards
    for slot, shard in enumerate(owner):
        loads[shard] += sizes[slot][0]
    mean, edited = sum(loads) / shards, list(owner)
    givers = {shard for shard in range(shards) if loads[shard] > mean}
    for slot in sorted(range(len(owner)), key=lambda s: (-sizes[s][0], s)):
        giver, taker = edited[slot], min(range(shards), key=lambda k: (loads[k], k))
        if sizes[slot][0] and giver in givers and loads[giver] > mean and loads[taker] + sizes[slot][0] < loads[giver]:
            edited[slot] = taker
            loads[giver] -= sizes[slot][0]
            loads[taker] += sizes[slot][0]
    return edited


def store_map(table: VersionedTable, owner: list[int], sizes: list[tuple[int, int]]) -> int:
    """Write the map as the table's next version; the version's number."""
    rows = [(slot, shard, *sizes[slot]) for slot, shard in enumerate(owner)]
    return table.write(table.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1))


def stored_owners(table: VersionedTable, version: int | None = None) -> list[int]:
    """The shard of every slot in a stored version: one row per slot reaches the driver."""
    return [r["shard"] for r in table.read(version).select("virtual_slot", "shard").orderBy("virtual_slot").collect()]


def rebalance(table: VersionedTable, slotted: DataFrame, shards: int) -> int:
    """Store the next version of the map for the records as they are now; its number."""
    owner = stored_owners(table)
    sizes = slot_sizes(slotted, len(owner))
    return store_map(table, rebalanced_map(owner, sizes, shards), sizes)


def grow(table: VersionedTable, slotted: DataFrame, shards: int) -> int:
    """Store the next version of the map with one shard more than ``shards``; its number."""
    owner = stored_owners(table)
    sizes = slot_sizes(slotted, len(owner))
    return store_map(table, grown_map(owner, sizes, shards), sizes)


def placed(slotted: DataFrame, table: VersionedTable, version: int | None = None) -> DataFrame:
    """Every row with its shard under a stored version of the map, and its place in that shard, gapless from 0.

    All rows are numbered in the order of their shards, by the sizes of their partitions, so no task sees more than a
    partition's rows, whatever their ids; a shard's first number is the number of rows in the shards before.
    """
    slot_map = table.read(version).select("virtual_slot", "shard")
    keyed = slotted.join(F.broadcast(slot_map), "virtual_slot")  # one row per virtual slot
    numbered = global_row_number(keyed, ["shard", "virtual_slot", "doc_id", "text_crc32", "size", "_row"], "_number")
    firsts = numbered.groupBy("shard").agg(F.min("_number").alias("_first"))  # one row per shard
    return numbered.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_number") - F.col("_first")).cast("long").alias("slot"), "virtual_slot"
    )


def sharded(documents: DataFrame, shards: int = 8, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot of every document.

    The map balances bytes, so the law is ``bytes``; ``grown_shard`` belongs to another law and is null.
    ``slot`` is the row's place in its shard. The map is stored in ``folder`` (one of the session's own by default): a folder
    that has a map already is rebalanced for these documents.

    Defined cases: a null text has size 1; null ids are dealt by their texts; repeated rows and ids share a virtual slot and
    take a place each; an empty table gives no rows; a text or id with more than a shard's share of the bytes makes that
    shard larger, as neither is cut; columns other than doc_id and text are ignored.
    """
    spark = documents.sparkSession
    slotted = materialise(with_slots(documents, slots), "slotted")
    table = VersionedTable(spark, folder or Scratch(spark).folder("slot-map"))
    if table.versions():
        rebalance(table, slotted, shards)
    else:
        sizes = slot_sizes(slotted, slots)
        store_map(table, balanced_map(sizes, shards), sizes)
    return placed(slotted, table).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
