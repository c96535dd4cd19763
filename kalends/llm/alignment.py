"""Align the tokens of two vocabularies over the same bytes, and weigh the links between them corpus-wide.

Both encoders start anew at a blank that follows a character which is no white space, so a text is a row of units, and equal
units are encoded once per block of documents. Inside a unit the token ends are divided and conquered: a common
end near the middle is located by bisect, both halves go on, and an interval without a common end is a leaf group. All
intervals of a block are halved together. A block keeps its documents as unit numbers and its id pairs with their
counts; Spark adds the counts up, and every block gets back the corpus-wide counts of its own pairs.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.pieces import VOCABULARY as PIECES
from kalends.llm.pieces import piece_codec
from kalends.llm.tokens import UNUSUAL, byte_alphabet
from kalends.storage import materialise

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: A block ends at so many characters or documents; its units are encoded and aligned so many at a time.
BLOCK_CHARS = 8_000_000
BLOCK_DOCS = 50_000
UNITS_AT_ONCE = 20_000
#: Ends tried one by one around the middle before all ends of an interval are looked up at once.
TRIES = 16

_UNIT_START = re.compile(r"(?<=\S) ")
#: White space before a blank, as far as usual characters go.
_SPACED = [c + " " for c in "\t\n\x0b\x0c\r \x85\xa0"]
_BLOCKS = (
    "block long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, units binary,"
    " pairs array<long>, times array<long>, link_ends binary, links binary"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class ByteLevel:
    """A byte-level vocabulary to which the strings of special tokens are plain text."""

    def __init__(self, json_path: str, ranks_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(json_path)
        self.library.encode_special_tokens = True
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.merger = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        specials = {i: t.content.encode() for i, t in self.library.get_added_tokens_decoder().items()}
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = specials.get(i) or bytes(byte_of[c] for c in token)

    def encode(self, text: str) -> list[int]:
        if UNUSUAL.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.merger.encode_ordinary(text)


@lru_cache(maxsize=None)
def byte_level(json_path: str, ranks_path: str) -> ByteLevel:
    return ByteLevel(json_path, ranks_path)


def leaf_groups(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups begin, as token numbers of A and of B.

    ``ends_a`` and ``ends_b`` are ascending byte offsets; the tokens from ``first_a[u]`` and ``first_b[u]`` on cover unit u, and
    both sides of a unit end at the same offset.
    """
    a0, b0 = first_a, first_b
    a1, b1 = np.append(first_a[1:], len(ends_a)), np.append(first_b[1:], len(ends_b))
    tried = np.zeros(len(a0), dtype=np.int64)
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(a0):
        inner = a1 - a0 - 1
        leaf = (tried >= inner) | (b1 - b0 == 1)
        leaves.append((a0[leaf], b0[leaf]))
        a0, a1, b0, b1, tried, inner = (x[~leaf] for x in (a0, a1, b0, b1, tried, inner))
        # the middle end first, then its neighbours on the left and the right in turn
        away = (tried + 1) // 2
        at = a0 + inner // 2 + np.where(tried % 2 == 1, -away, away)
        found = np.searchsorted(ends_b, ends_a[at])
        hit = ends_b[np.minimum(found, len(ends_b) - 1)] == ends_a[at]
        for n in np.flatnonzero(~hit & (tried + 1 >= TRIES) & (tried + 1 < inner)).tolist():
            own = ends_a[a0[n]: a1[n] - 1]
            places = np.searchsorted(ends_b, own)
            common = np.flatnonzero(ends_b[np.minimum(places, len(ends_b) - 1)] == own)
            if len(common):
                nearest = common[np.argmin(np.abs(common - inner[n] // 2))]
                at[n], found[n], hit[n] = a0[n] + nearest, places[nearest], True
            else:
                tried[n] = inner[n]
        cut_a, cut_b, rest = at[hit] + 1, found[hit] + 1, ~hit
        none = np.zeros(len(cut_a), dtype=np.int64)
        a0, a1, b0, b1, tried = (
            np.concatenate(parts) for parts in (
                (a0[hit], cut_a, a0[rest]), (cut_a, a1[hit], a1[rest]), (b0[hit], cut_b, b0[rest]), (cut_b, b1[hit], b1[rest]),
                (none, none, tried[rest] + 1),
            )
        )
    start_a, start_b = (np.sort(np.concatenate(parts)) for parts in zip(*leaves))
    return start_a, start_b


def links_of(ends_a: np.ndarray, ends_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all A-B pairs whose byte ranges overlap, group by group in order of A."""
    sizes_a, sizes_b = np.diff(np.append(group_a, len(ends_a))), np.diff(np.append(group_b, len(ends_b)))
    low, high = np.repeat(group_b, sizes_a), np.repeat(group_b + sizes_b, sizes_a)
    mixed = np.flatnonzero(np.repeat((sizes_a > 1) & (sizes_b > 1), sizes_a))
    starts_a, starts_b = (np.append(0, ends[:-1]) for ends in (ends_a, ends_b))
    low[mixed] = np.searchsorted(ends_b, starts_a[mixed], "right")
    high[mixed] = np.searchsorted(starts_b, ends_a[mixed], "left")
    number = high - low
    before = np.cumsum(number) - number
    return np.repeat(np.arange(len(ends_a)), number), np.arange(int(number.sum())) + np.repeat(low - before, number)


class _Units:
    """The aligned units of one block."""

    def __init__(self, parts: list[str], a: ByteLevel, b):
        #: Units whose tokens on both sides join to their own bytes; the others make their documents have no tokens.
        self.good = np.zeros(len(parts), dtype=bool)
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(len(parts), dtype=np.int64) for _ in range(4))
        self.text = [""] * len(parts)
        self.lengths = [np.array(list(map(len, side.bytes_of)), dtype=np.int64) for side in (a, b)]
        self.names = [np.array([f"{i}{mark}" for i in range(len(side.bytes_of)) for mark in ",|;"], dtype=object) for side in (a, b)]
        found = [self._align(parts[start: start + UNITS_AT_ONCE], start, a, b) for start in range(0, len(parts), UNITS_AT_ONCE)]
        #: The linked ids of all units in turn, A's in the upper half.
        self.pairs = np.concatenate([np.empty(0, dtype=np.int64), *found])

    def _align(self, parts: list[str], start: int, a: ByteLevel, b) -> np.ndarray:
        """Align some units, of which the first has number ``start``; their linked ids."""
        whole = [" " + part for part in parts]
        ids_a = [a.encode(unit) for unit in whole]
        ids_b = b.encode_units(parts)
        keep = range(len(parts))
        flat, sizes = self._flat(ids_a, ids_b, keep)
        joined = [b"".join(map(side.bytes_of.__getitem__, ids.tolist())) for side, ids in zip((a, b), flat)]
        text = "".join(whole).encode()
        reach = np.cumsum([len(unit.encode()) for unit in whole])
        same = all(
            j == text and np.array_equal(np.append(0, np.cumsum(of[ids]))[np.cumsum(size)], reach)
            for j, of, ids, size in zip(joined, self.lengths, flat, sizes)
        )
        if not same:  # some unit's tokens do not join to its bytes: look at each
            keep = [u for u, unit in enumerate(whole) if all(
                b"".join(map(side.bytes_of.__getitem__, ids)) == unit.encode()
                for side, ids in ((a, ids_a[u]), (b, np.frombuffer(ids_b[u], "<u4").tolist()))
            )]
            if not keep:
                return np.empty(0, dtype=np.int64)
            flat, sizes = self._flat(ids_a, ids_b, keep)
        firsts = [np.cumsum(s) - s for s in sizes]
        ends = [np.cumsum(of[ids]) for of, ids in zip(self.lengths, flat)]
        group_a, group_b = leaf_groups(*ends, *firsts)
        link_a, link_b = links_of(*ends, group_a, group_b)
        numbers = np.array(keep) + start
        self.good[numbers] = True
        self.n_a[numbers], self.n_b[numbers] = sizes
        self.n_groups[numbers] = np.bincount(np.searchsorted(firsts[0], group_a, "right") - 1, minlength=len(keep))
        self.n_links[numbers] = np.bincount(np.searchsorted(firsts[0], link_a, "right") - 1, minlength=len(keep))
        self._write(numbers.tolist(), flat, group_a, group_b, sizes)
        return (flat[0][link_a] << 32) | flat[1][link_b]

    @staticmethod
    def _flat(ids_a: list[list[int]], ids_b: list[bytes], keep) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of the kept units in a row, and how many each has, for A and B."""
        flat = [np.fromiter(chain.from_iterable(ids_a[u] for u in keep), np.int64), np.frombuffer(b"".join([ids_b[u] for u in keep]), "<u4").astype(np.int64)]
        return flat, [np.array([len(ids_a[u]) for u in keep], dtype=np.int64), np.array([len(ids_b[u]) // 4 for u in keep], dtype=np.int64)]

    def _write(self, keep: list[int], flat: list[np.ndarray], group_a: np.ndarray, group_b: np.ndarray, sizes: list[np.ndarray]) -> None:
        """The groups of every unit as text: A's ids, a bar, B's ids; a semicolon after each group but the last."""
        marked = []
        for ids, starts, names, last in ((flat[0], group_a, self.names[0], 1), (flat[1], group_b, self.names[1], 2)):
            ending = np.zeros(len(ids), dtype=np.int64)
            ending[np.append(starts[1:], len(ids)) - 1] = last
            marked.append(names[ids * 3 + ending])
        # tokens stand group by group, A's before B's
        number_a = np.arange(len(flat[0])) + np.repeat(group_b, np.diff(np.append(group_a, len(flat[0]))))
        number_b = np.arange(len(flat[1])) + np.repeat(np.append(group_a[1:], len(flat[0])), np.diff(np.append(group_b, len(flat[1]))))
        words = np.empty(len(flat[0]) + len(flat[1]), dtype=object)
        words[number_a], words[number_b] = marked
        start, written = 0, words.tolist()
        for unit, size in zip(keep, (sizes[0] + sizes[1]).tolist()):
            self.text[unit] = "".join(written[start: start + size])[:-1]
            start += size


def units(text: str) -> list[str]:
    """The text cut at every blank that follows a character which is no white space; the blanks themselves are left out."""
    if text.startswith(" ") or any(pair in text for pair in _SPACED) or UNUSUAL.search(text):
        return _UNIT_START.split(text)
    return text.split(" ")


class _Block:
    """Documents on their way to one block."""

    def __init__(self):
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        self.ids: list[int | None] = []
        self.documents: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        parts = units(text) if text else []
        self.ids.append(doc_id)
        self.documents.append(np.fromiter(map(self.numbers.__getitem__, parts), np.int32, len(parts)))
        self.chars += len(text or "")

    def batch(self, block: int, a: ByteLevel, b) -> pa.RecordBatch:
        aligned = _Units(list(self.numbers), a, b)
        counted, rows = [np.empty(0, dtype=np.int32)], []
        for doc_id, numbers in zip(self.ids, self.documents):
            row = {"block": block, "kind": 0, "doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "units": b""}
            if len(numbers) and aligned.good[numbers].all():
                counted.append(numbers)
                digest = hashlib.sha256(";".join(map(aligned.text.__getitem__, numbers.tolist())).encode()).hexdigest()
                totals = {name: int(getattr(aligned, name)[numbers].sum()) for name in ("n_a", "n_b", "n_groups", "n_links")}
                row |= totals | {"groups_sha256": digest, "units": numbers.astype("<i4").tobytes()}
            rows.append(row)
        used = np.bincount(np.concatenate(counted), minlength=len(aligned.good))
        # units that only documents without tokens use take no part in any count
        per_link = np.repeat(used, aligned.n_links)
        links = aligned.pairs[per_link > 0]
        ends = np.cumsum(np.where(used > 0, aligned.n_links, 0))
        pairs, place = np.unique(links, return_inverse=True)
        times = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(times, place, per_link[per_link > 0])
        rows.append({"block": block, "kind": 1, "pairs": pairs, "times": times, "link_ends": ends.astype("<i8").tobytes(), "links": place.astype("<i4").tobytes()})
        return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, _BLOCKS.split(", "))])
_ARROW_RESULT = pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, _RESULT.split(", "))])


def _weighed(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one block with the corpus-wide counts of its pairs."""
    kinds = left.column("kind").to_numpy()
    whole = left.filter(pa.array(kinds == 1)).to_pylist()[0]
    documents = left.filter(pa.array(kinds == 0))
    order = np.argsort(right.column("pair").to_numpy())
    links = np.frombuffer(whole["links"], "<i4")
    ends = np.append(0, np.frombuffer(whole["link_ends"], "<i8"))
    sums = []
    for name in ("best", "total"):
        per_link = right.column(name).to_numpy()[order].astype(np.int64)[links]
        running = np.append(0, np.cumsum(per_link))
        sums.append(np.diff(running[ends]))
    rows = [np.frombuffer(units, "<i4") for units in documents.column("units").to_pylist()]
    n_best, count_sum = (pa.array([int(s[r].sum()) for r in rows], pa.int64()) for s in sums)
    columns = {name: documents.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    columns |= {"n_best": n_best, "count_sum": count_sum}
    return pa.table([columns[name] for name in _ARROW_RESULT.names], schema=_ARROW_RESULT)


def aligned_blocks(documents: DataFrame, json_path: str = BYTE_LEVEL, ranks_path: str = RANKS, model_path: str = PIECES) -> DataFrame:
    """The aligned documents by blocks: a row of kind 0 per document, and one of kind 1 per block with its pairs and links."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(json_path, ranks_path), piece_codec(model_path)
        base, number, block = TaskContext.get().partitionId() << 32, 0, _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py())
                if block.chars >= BLOCK_CHARS or len(block.ids) >= BLOCK_DOCS:
                    yield block.batch(base + number, a, b)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.batch(base + number, a, b)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, _BLOCKS)


def aligned(documents: DataFrame, json_path: str = BYTE_LEVEL, ranks_path: str = RANKS, model_path: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    Defined cases: a null or empty text, and one whose tokens do not join to its own bytes on both sides, has zeros and an empty
    ``groups_sha256`` and adds to no count; repeated rows count one by one; a null doc_id stays null; a long text is a block of its
    own; an empty table gives no rows; columns other than doc_id and text are not read.
    """
    blocks = materialise(aligned_blocks(documents, json_path, ranks_path, model_path), "aligned-blocks")
    own = blocks.where("kind = 1").select("block", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("block", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    totals = own.groupBy("pair").agg(F.sum("times").alias("total")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    totals = materialise(totals, "pair-totals")
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))  # a row per id of B's vocabulary at most
    weights = totals.join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("highest")).cast("int").alias("best"))
    counts = own.select(F.col("block").alias("of_block"), "pair").join(weights, "pair")
    left = blocks.select("block", "kind", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "units", "link_ends", "links")
    return left.groupBy("block").cogroup(counts.groupBy("of_block")).applyInArrow(_weighed, _RESULT)
