"""Pack tokenised documents into fixed windows by the sum-of-squares rule.

Every task packs the documents of its own input split, one after the other, so nothing is shuffled and a
task that is repeated gives the same windows. It holds an array with the number of windows open at each fill
level. A document's rest goes to the level at which the sum of the squared counts grows least; whole
windows are cut off long documents first. When the split ends, the windows still open are emptied into
each other, cutting at window ends, so at most one window per split has padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.tokens import byte_level_encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WINDOW = 2048
#: The id that ends every document.
END_ID = 1

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

# A piece in an open window: doc_id, start, ids as bytes, tokens of the document.
Piece = tuple[int | None, int, bytes, int]


class SumOfSquares:
    """The open windows of one task, by fill level."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: list[list[list[Piece]]] = [[] for _ in range(capacity + 1)]
        self.count = np.zeros(capacity + 1, dtype=np.int64)

    def level_for(self, size: int) -> int:
        """The level whose use changes the sum of squares least; 0 stands for a new window.

        Moving a window from level h to h + size changes the sum by 2 (N[h+size] - N[h]) + 2, opening one
        by 2 N[size] + 1, filling one up by 1 - 2 N[h]. Ties go to the fullest level.
        """
        if size == self.capacity:
            return 0
        last = self.capacity - size
        cost = 2 * (self.count[size:] - self.count[: last + 1]) + 2
        cost[last] = 1 - 2 * self.count[last]
        cost[1:][self.count[1 : last + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * self.count[size] + 1
        return last - int(np.argmin(cost[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put the piece into a window; the window, if that filled it."""
        size = len(piece[2]) // 4
        level = self.level_for(size)
        window = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        window.append(piece)
        level += size
        if level == self.capacity:
            return window
        self.open[level].append(window)
        self.count[level] += 1
        return None

    def emptied(self) -> Iterator[list[Piece]]:
        """Close all windows: pieces of the emptiest fill up the fullest, cut where a window ends."""
        windows = [(level, w) for level in range(self.capacity, 0, -1) for w in self.open[level]]
        low, high = 0, len(windows) - 1
        while low <= high:
            level, window = windows[low]
            while level < self.capacity and low < high:
                donor_level, donor = windows[high]
                doc_id, start, ids, total = donor.pop()
                taken = min(self.capacity - level, len(ids) // 4)
                rest = len(ids) // 4 - taken
                window.append((doc_id, start + rest, ids[4 * rest:], total))
                if rest:
                    donor.append((doc_id, start, ids[: 4 * rest], total))
                level += taken
                windows[high] = (donor_level - taken, donor)
                if not donor:
                    high -= 1
            yield window
            low += 1


def _rows(window: list[Piece], sequence: int) -> Iterator[tuple]:
    offset = 0
    for doc_id, start, ids, total in window:
        length = len(ids) // 4
        yield doc_id, start, length, zlib.crc32(ids), total, sequence, offset
        offset += length


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pa.record_batch([pa.array(column, pa.int64()) for column in zip(*rows)], names)


def packed(documents: DataFrame, vocabulary: str = VOCABULARY, ranks: str = RANKS, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, the end id included, lies in exactly one piece. ``sequence_id`` holds the
    task's number in its upper and the window's in its lower 32 bits.

    Defined cases: a null or empty text is its end id alone; a long text fills windows of its own and
    only its rest is placed; repeated rows are packed one by one; an empty table gives no rows; columns
    other than doc_id and text are ignored. Rows must come in the same order when a task is repeated, as
    they do from stored tables.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level_encoder(vocabulary, ranks)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        levels = SumOfSquares(window)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    full = levels.place((doc_id, start, ids[4 * start: 4 * (start + window)], total))
                    if full:
                        rows += _rows(full, sequence)
                        sequence += 1
            if rows:
                yield _batch(rows)
                rows = []
        for last in levels.emptied():
            rows += _rows(last, sequence)
            sequence += 1
        if rows:
            yield _batch(rows)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, SCHEMA)
