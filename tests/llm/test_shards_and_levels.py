"""Stored slot maps, the placing rule of packing against a plain sum of squares, and FTRL against a loop over coordinates."""

import math
import zlib

import numpy as np

from kalends.llm import packing, sharding, toxicity
from kalends.sources.versions import VersionedTable


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    return ["x" * int(rng.integers(1, 400)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, shard int, virtual_slot int")


def loads(rows, shards):
    return [sum(r.size for r in rows if r.shard == k) for k in range(shards)]


def test_sizes_checksums_and_places(spark):
    rows = [(1, "ß日"), (2, None), (3, ""), (None, "a"), (None, "b"), (7, "same"), (7, "same")]
    out = sharding.sharded(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in out) == sorted(
        (i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    for k in range(8):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))


def test_one_id_with_a_third_of_the_rows(spark):
    rows = list(enumerate(texts(400))) + [(None, f"null {i} " + "y" * 190) for i in range(300)] + [(5, "z" * 9)] * 200
    out = sharding.sharded(frame(spark, rows)).collect()
    assert len(out) == 900
    for k in range(8):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))
    mean = sum(r.size for r in out) / 8
    assert max(loads(out, 8)) < 1.02 * mean + 400  # null ids do not fill one shard


def test_the_map_is_stored_edited_and_read_again(spark, tmp_path):
    folder = str(tmp_path / "map")
    first = sharding.sharded(frame(spark, list(enumerate(texts(600)))), folder=folder).collect()
    table = VersionedTable(spark, folder)
    owner = sharding.stored_owners(table)
    assert table.versions() == [1] and len(owner) == sharding.SLOTS
    assert {(r.virtual_slot, r.shard) for r in first} <= set(enumerate(owner))
    # the records grow unevenly: what shard 0 holds becomes ten times as long
    held = {r.doc_id for r in first if r.shard == 0}
    grown = [(i, t * (10 if i in held else 1)) for i, t in enumerate(texts(600))]
    second = sharding.sharded(frame(spark, grown), folder=folder).collect()
    assert table.versions() == [1, 2] and sharding.stored_owners(table, 1) == owner
    slotted = sharding.with_slots(frame(spark, grown))
    stale = sharding.placed(slotted, table, 1).collect()
    assert max(loads(second, 8)) < 0.7 * max(loads(stale, 8))
    edited = sharding.stored_owners(table)
    assert all(a == b or a == 0 for a, b in zip(owner, edited))  # only the overloaded shard gave slots away
    assert {(r.virtual_slot, r.shard) for r in second} <= set(enumerate(edited))
    # one more shard takes slots only into itself
    assert sharding.grow(table, slotted, 8) == 3
    ninth = sharding.stored_owners(table, 3)
    assert all(a == b or b == 8 for a, b in zip(edited, ninth)) and 8 in ninth
    after = sharding.placed(slotted, table).collect()
    assert max(loads(after, 9)) <= max(loads(second, 8))


def test_documents_go_to_the_level_with_the_least_sum_of_squares():
    rng = np.random.default_rng(3)
    for capacity in (7, 16, 33):
        levels, counts = packing.SumOfSquares(capacity), np.zeros(capacity + 1, int)
        for size in rng.integers(1, capacity + 1, 400).tolist():
            def total(level):
                after = counts.copy()
                if level:
                    after[level] -= 1
                if level + size < capacity:
                    after[level + size] += 1
                return int((after[1:capacity] ** 2).sum())

            options = [h for h in range(capacity - size + 1) if h == 0 or counts[h]]
            chosen = levels.level_for(size)
            assert chosen in options and total(chosen) == min(map(total, options))
            levels.place((1, 0, b"\0\0\0\0" * size, size))
            if chosen:
                counts[chosen] -= 1
            if chosen + size < capacity:
                counts[chosen + size] += 1
            assert levels.count[1:capacity].tolist() == counts[1:capacity].tolist()


def test_padding_is_little(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(rng.integers(1, 5000, 300))]
    out = packing.packed(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    windows = {r.sequence_id for r in out}
    assert sum(r.length for r in out) > (len(windows) - 1) * packing.WINDOW


def test_weights_are_those_of_a_loop_over_coordinates():
    rng = np.random.default_rng(2)
    rows = [(np.unique(rng.integers(0, 60, 12)).astype(np.int32), int(k % 3 == 0)) for k in range(150)]
    for features, label in rows[::2]:
        features[0] = 1 if label else 2
    rows = [(np.unique(f), y) for f, y in rows]
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * toxicity.L1) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for epoch in range(toxicity.EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            features, label = rows[k]
            at = [*features.tolist(), 64]
            old = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-min(max(sum(old.values()), -35), 35))) - label
            for i in at:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * old[i]
                n[i] = n.get(i, 0.0) + g * g
    used, values, intercept = toxicity.ftrl(rows, bits=6)
    want = {i: weight(i) for i in range(64) if i in z and weight(i)}
    assert dict(zip(used.tolist(), values.tolist())).keys() == want.keys() and len(want) > 0
    assert np.allclose(values, [want[i] for i in used.tolist()]) and abs(intercept - weight(64)) < 1e-9
