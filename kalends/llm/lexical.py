"""Rank all documents for each item by pipelined term partitioning.

Documents are read once and dealt to slots of bounded size; a slot keeps one posting list for each term that
some item holds. Terms belong to owners by how frequent they are, rarest first. A bundle of items visits the owners
one after the other: at each, a cogroup by (bundle, slot) brings the bundle's sparse accumulators together with
the owner's posting lists, adds their contributions in 64-bit integers and sends the accumulators on. An accumulator is
left behind only where the 20 best of its slot can no longer be reached, whatever the later owners add.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.storage import Scratch

#: Results per item.
BEST = 20
#: A slot ends at so many documents or so many characters.
SLOT_DOCS = 8192
SLOT_CHARS = 16_000_000
#: Items of a bundle, on average.
BUNDLE = 128
#: Owners hold the terms whose share of the documents is at most this, and above the one before.
OWNERS = (1 / 64, 1 / 8, 1.0)
#: Bits of the filter that tells which terms some item may hold: 1 MB, whatever the number of items.
FILTER_BITS = 1 << 23
#: Terms for which a worker remembers the filter's answer.
REMEMBERED = 500_000

#: tf's part of a contribution is below this.
_TOP = 1_000_000
#: Stand for null ids inside the operator; a null document comes last among equals.
_NULL_ITEM, _NULL_DOC = -(1 << 63), (1 << 63) - 1

_STATE = "bundle int, slot long, docs binary, lengths binary, items binary, counts binary, places binary, scores binary"
_POSTINGS = "slot long, kind int, term string, docs binary, counts binary, size long, total long"


def _separators() -> bytes:
    """A table for bytes.translate: A-Z in lower case, every character that ends a term as a blank."""
    ends = {*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
    return bytes(0x20 if b in ends else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


_TABLE = _separators()


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8; a term's bytes hold no ASCII but letters and digits."""
    return (text or "").encode().translate(_TABLE).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """item, term, repeats: rows of one item_id count as one item."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, counts = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Counter(terms(text))
                ids += [item] * len(found)
                words += [w.decode() for w in found]
                counts += found.values()
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["item", "term", "repeats"])

    rows = items.select(F.coalesce(F.col("item_id").cast("long"), F.lit(_NULL_ITEM)).alias("item"), "text")
    return rows.mapInArrow(read, "item long, term string, repeats long").groupBy("item", "term").agg(F.sum("repeats").alias("repeats"))


def _filter(item_terms: DataFrame) -> bytes:
    """The bits of the terms' checksums: at most ``FILTER_BITS`` / 8 bytes reach the driver."""
    place = F.crc32(F.col("term").cast("binary")) % FILTER_BITS + 1  # buckets and bits count from position 1
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    maps = item_terms.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    for bucket, part in maps.collect():
        start = (bucket - 1) * 4096
        bits[start: start + len(part)] |= np.frombuffer(bytes(part), dtype=np.uint8)
    return bits.tobytes()


class _Slot:
    """The posting lists of the documents read since the last slot ended."""

    def __init__(self):
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.lists: dict[bytes, tuple[list[int], list[int]]] = {}
        self.chars = 0

    def rows(self, slot: int) -> Iterator[tuple]:
        yield slot, 0, None, np.array(self.ids, "<i8").tobytes(), np.array(self.lengths, "<i8").tobytes(), len(self.ids), sum(self.lengths)
        for term, (places, counts) in self.lists.items():
            yield slot, 1, term.decode(), np.array(places, "<u2").tobytes(), np.array(counts, "<u4").tobytes(), len(places), 0


def _postings(documents: DataFrame, wanted: bytes) -> DataFrame:
    """A row of kind 0 per slot (ids and lengths of its documents) and one of kind 1 per slot and term."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted, dtype=np.uint8), bitorder="little").tobytes()
        known: dict[bytes, int] = {}
        base, number, slot = TaskContext.get().partitionId() << 32, 0, _Slot()

        def batch_of(slot: _Slot) -> pa.RecordBatch:
            names = [part.split()[0] for part in _POSTINGS.split(", ")]
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*slot.rows(base + number)), kinds)], names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_py())
                if not found:
                    continue
                place = len(slot.ids)
                slot.ids.append(doc)
                slot.lengths.append(len(found))
                slot.chars += sum(map(len, found))
                for term, count in Counter(found).items():
                    held = known.get(term)
                    if held is None:
                        held = bits[zlib.crc32(term) % FILTER_BITS]
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[term] = held
                    if held:
                        lists = slot.lists.get(term)
                        if lists is None:
                            lists = slot.lists[term] = ([], [])
                        lists[0].append(place)
                        lists[1].append(count)
                if len(slot.ids) >= SLOT_DOCS or slot.chars >= SLOT_CHARS:
                    yield batch_of(slot)
                    number, slot = number + 1, _Slot()
        if slot.ids:
            yield batch_of(slot)

    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_DOC)).alias("doc_id"), "text")
    return rows.mapInArrow(read, _POSTINGS)


def _weighted(item_terms: DataFrame, lists: DataFrame, docs: int, bundles: int) -> DataFrame:
    """term, owner, bundle, items: every item that holds the term, with its weight there and what later owners can still add."""
    frequency = lists.groupBy("term").agg(F.sum("size").alias("df"))
    known = item_terms.join(frequency, "term")
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    owner = F.lit(len(OWNERS) - 1)
    for number in reversed(range(len(OWNERS) - 1)):
        owner = F.when(F.col("df") <= F.lit(OWNERS[number] * docs), number).otherwise(owner)
    known = known.select("item", "term", owner.alias("owner"), (weight * F.col("repeats")).alias("weight")).where("weight > 0")
    later = Window.partitionBy("item").orderBy(F.col("owner").desc()).rangeBetween(Window.unboundedPreceding, -1)
    rest = F.coalesce(F.sum("weight").over(later), F.lit(0)) * _TOP
    known = known.withColumn("rest", rest).withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int"))
    return known.groupBy("term", "owner", "bundle").agg(F.collect_list(F.struct("item", "weight", "rest")).alias("items"))


def _contributions(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


class _Accumulators:
    """The sparse accumulators of one bundle in one slot, opened item by item."""

    def __init__(self, state: dict):
        self.state = state
        self.docs = np.frombuffer(state["docs"], "<i8")
        self.lengths = np.frombuffer(state["lengths"], "<i8")
        items, counts = np.frombuffer(state["items"], "<i8"), np.frombuffer(state["counts"], "<i4")
        ends = np.cumsum(counts)
        places, scores = np.frombuffer(state["places"], "<u2"), np.frombuffer(state["scores"], "<i8")
        self.of = {i: (places[e - c: e], scores[e - c: e]) for i, c, e in zip(items.tolist(), counts.tolist(), ends.tolist())}

    def add(self, postings: list[dict], docs: int, total: int) -> None:
        """Add one owner's contributions and drop what cannot be among the slot's best any more."""
        m = 75 + (25 * self.lengths * docs) // total
        additions: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        rests: dict[int, int] = {}
        for row in postings:
            places = np.frombuffer(row["posted"], "<u2")
            part = _contributions(np.frombuffer(row["repeats"], "<u4").astype(np.int64), m[places])
            for item in row["holders"]:
                additions.setdefault(item["item"], []).append((places, part * item["weight"]))
                rests[item["item"]] = item["rest"]
        for item, parts in additions.items():
            scores = np.zeros(len(m), dtype=np.int64)
            if item in self.of:
                places, old = self.of[item]
                scores[places] = old
            for places, part in parts:
                scores[places] += part  # a document stands once in a posting list
            found = np.flatnonzero(scores)
            if len(found) > BEST:
                floor = np.partition(scores[found], len(found) - BEST)[len(found) - BEST]
                found = found[scores[found] + rests[item] >= floor]
            self.of[item] = found.astype("<u2"), scores[found]

    def row(self) -> dict:
        held = list(self.of.values())
        return self.state | {
            "items": np.array(list(self.of), "<i8").tobytes(), "counts": np.array([len(p) for p, _ in held], "<i4").tobytes(),
            "places": b"".join(p.tobytes() for p, _ in held), "scores": b"".join(s.astype("<i8").tobytes() for _, s in held),
        }

    def best(self) -> Iterator[tuple[int, int, int]]:
        """The slot's best documents of every item."""
        for item, (places, scores) in self.of.items():
            ids = self.docs[places]
            for at in np.lexsort((ids, -scores))[:BEST].tolist():
                if scores[at] > 0:
                    yield item, int(ids[at]), int(scores[at])


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(", "))])


def ranked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: each item's 20 best documents with a score above 0, ties by ascending doc_id.

    ``documents`` has doc_id and text, ``items`` item_id and text; other columns are not read.

    Defined cases: a null or empty text has no terms, so such documents and items are in no result; rows with one item_id,
    null among them, are one item whose terms add up; rows with one doc_id are ranked one by one, a null doc_id after
    its equals; a long text is one document, its terms counted in one pass; empty tables give no rows.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark)
    item_terms = scratch.keep(_item_terms(items), "item-terms")
    bundles = -(-item_terms.select("item").distinct().count() // BUNDLE)
    stored = scratch.keep(_postings(documents, _filter(item_terms)), "postings")
    slots, lists = stored.where("kind = 0"), stored.where("kind = 1")
    docs, total = slots.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    if not docs or not bundles:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    weighted = scratch.keep(_weighted(item_terms, lists, docs, bundles), "weighted-terms")
    nothing = F.lit(b"").cast("binary")
    state = slots.select(
        F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"), "slot", "docs", F.col("counts").alias("lengths"),
        nothing.alias("items"), nothing.alias("counts"), nothing.alias("places"), nothing.alias("scores"),
    )
    state_schema, best_schema = _arrow(_STATE), _arrow("item long, doc long, score long")

    def opened(left: pa.Table, right: pa.Table) -> _Accumulators:
        held = _Accumulators(left.to_pylist()[0])
        held.add(right.to_pylist(), docs, total)
        return held

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([opened(left, right).row()], schema=state_schema)

    def select(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = list(opened(left, right).best())
        return pa.table([pa.array(column, pa.int64()) for column in zip(*rows)] if rows else [[], [], []], schema=best_schema)

    for number in range(len(OWNERS)):
        posted = lists.select(F.col("slot").alias("to_slot"), "term", F.col("docs").alias("posted"), F.col("counts").alias("repeats"))
        held = weighted.where(F.col("owner") == number).select("term", F.col("bundle").alias("to_bundle"), F.col("items").alias("holders"))
        owned = posted.join(held, "term").drop("term")
        both = state.groupBy("bundle", "slot").cogroup(owned.groupBy("to_bundle", "to_slot"))
        last = number == len(OWNERS) - 1
        state = both.applyInArrow(select, "item long, doc long, score long") if last else both.applyInArrow(visit, _STATE)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc"))
    best = state.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
    return best.select(
        F.nullif(F.col("item"), F.lit(_NULL_ITEM)).alias("item_id"), F.col("rank").cast("int").alias("rank"),
        F.nullif(F.col("doc"), F.lit(_NULL_DOC)).alias("doc_id"), "score",
    )


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
held AS (SELECT doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM held),
postings AS (SELECT term, doc_id, n, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM held) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, whole GROUP BY term, docs),
wanted AS (SELECT item_id, term, count(*)::BIGINT AS repeats FROM (
           SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scores AS (SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
           FROM wanted JOIN weights USING (term) JOIN postings USING (term), whole GROUP BY item_id, doc_id),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""
