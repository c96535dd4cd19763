"""Remove long byte strings that occur more than once, by maximal repeats of an enhanced suffix array.

A string of 400 bytes (the least length is a parameter) contains 337 substrings of 64 bytes; the one with the least hash (the last of equal
ones) is its anchor. Equal strings have equal anchors at equal places, so all occurrences of a repeat meet in
the group of their anchor, and only anchors that occur twice in the corpus need a look. An occurrence brings
its context: the bytes of all 400-byte strings it is the anchor of.

In each group the suffixes that start at the anchor are sorted and their common prefixes computed; a
stack scan of these gives the tree of common-prefix intervals. Within an interval, occurrences are told apart
by what stands to their left: those that agree on enough bytes form a maximal repeat, and all its
occurrences are put out. Equal texts and equal contexts are counted before anything is sorted, so copies never
meet in one task; groups with very many different contexts are divided by longer common strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.storage import Scratch, temporary

#: Bytes that a removed string has at least unless the caller says otherwise, and bytes of an anchor.
LENGTH = 400
ANCHOR = 64
#: Groups with more different contexts than this are divided, by bands of so many starts, one after the other.
SORTED = 256
BANDS = (32, 4, 1)
#: Starts of strings handled at once in a text, which bounds the memory that a very long text takes.
SLICE = 1 << 20

_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _anchor_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the 64 bytes at every place, built by doubling."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * _STEPS[0]
    for j, step in enumerate(_STEPS):
        h = (h[: -(1 << j)] * step) ^ (h[1 << j:] + (h[1 << j:] >> np.uint64(29)))
        h = (h ^ (h >> np.uint64(32))) * _STEPS[1]
    return h


def anchors(raw: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, place, first and last start of the strings, for every anchor of a text in order."""
    found: list[tuple] = []
    starts = len(raw) - length + 1
    for low in range(0, starts, SLICE):
        high = min(low + SLICE, starts)
        h = _anchor_hashes(raw[low: high + length - 1])
        value, place = h, np.arange(len(h), dtype=np.int32)
        span, width = length - ANCHOR + 1, 1
        while width < span:  # least of ``width`` neighbours, the right one of equals
            move = min(width, span - width)
            later = value[move:] <= value[:-move]
            place = np.where(later, place[move:], place[:-move])
            value = np.where(later, value[move:], value[:-move])
            width += move
        cuts = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], cuts])
        last = np.concatenate([cuts - 1, [len(place) - 1]])
        found.append((value[first].view(np.int64), place[first].astype(np.int64) + low, first + low, last + low))
    if not found:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found))


DESCRIBED = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.string()), ("n_bytes", pa.int64()), ("anchors", pa.list_(pa.int64())),
    ("own", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])


def _described(documents: DataFrame, length: int) -> DataFrame:
    """doc_id, key (sha-256 of the text), n_bytes, the distinct anchors and what the text itself repeats."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    rows = []
                    for doc_id, text in zip(*batch.slice(at, 256).columns):
                        raw = (text.as_py() or "").encode()
                        found = anchors(np.frombuffer(raw, np.uint8), length)
                        own = [{"start": low, "end": high} for low, high in _own_repeats(raw, length, *found)]
                        rows.append((doc_id.as_py(), hashlib.sha256(raw).hexdigest(), len(raw), np.unique(found[0]), own))
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), DESCRIBED)], schema=DESCRIBED)

    schema = "doc_id long, key string, n_bytes long, anchors array<long>, own array<struct<start: long, end: long>>"
    return documents.mapInArrow(describe, schema)


def _own_repeats(raw: bytes, length: int, hashes, places, firsts, lasts) -> list[tuple[int, int]]:
    """Runs of strings that a text holds twice."""
    values, counts = np.unique(hashes, return_counts=True)
    if len(values) == len(hashes):
        return []
    groups: dict[int, dict[tuple[int, bytes], list[int]]] = {}
    for i in np.flatnonzero(np.isin(hashes, values[counts > 1])).tolist():
        first = int(firsts[i])
        context = (int(places[i]) - first, raw[first: int(lasts[i]) + length])
        groups.setdefault(int(hashes[i]), {}).setdefault(context, []).append(first)
    spans = []
    for same in groups.values():
        contexts = list(same)
        for (_, context), starts in same.items():
            if len(starts) > 1:
                spans += [(start, start + len(context)) for start in starts]
        if len(contexts) > 1:
            spans += [(same[contexts[n]][0] + low, same[contexts[n]][0] + high) for n, low, high in maximal_repeats(contexts, length)]
    return merge(spans)


CONTEXT = pa.schema([
    ("anchor", pa.int64()), ("digest", pa.binary()), ("holder", pa.int64()), ("key", pa.string()),
    ("start", pa.int64()), ("left", pa.int32()), ("context", pa.binary()),
])
CONTEXT_COLUMNS = "anchor long, digest binary, holder long, key string, start long, left int, context binary"


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """The different contexts of the anchors in ``shared``, from (key, text, shared).

    ``holder`` is the number of the text in short: the first bytes of its key.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_of = lambda rows: pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), CONTEXT)], schema=CONTEXT)
        with np.errstate(over="ignore"):
            for batch in batches:
                rows: list[tuple] = []
                for key, text, shared in zip(*batch.columns):
                    raw, key = text.as_py().encode(), key.as_py()
                    holder = int.from_bytes(bytes.fromhex(key[:16]), "big", signed=True)
                    found = anchors(np.frombuffer(raw, np.uint8), length)
                    chosen = np.isin(found[0], shared.values.to_numpy(zero_copy_only=False))
                    seen = set()
                    for anchor, at, low, high in zip(*(x[chosen].tolist() for x in found)):
                        context = raw[low: high + length]
                        digest = xxhash.xxh3_128_digest(context, seed=at - low)
                        if (anchor, digest) not in seen:
                            seen.add((anchor, digest))
                            rows.append((anchor, digest, holder, key, low, at - low, context))
                    if len(rows) >= 4000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return texts.mapInArrow(cut, CONTEXT_COLUMNS)


def common_prefix(x: bytes, y: bytes) -> int:
    """Length of the longest common prefix."""
    size = min(len(x), len(y))
    if x[:size] == y[:size]:
        return size
    low, high = 0, size  # x[:low] == y[:low], x[:high] != y[:high]
    while high - low > 1:
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of a sorted suffix list, by one scan with a stack.

    ``prefixes[i]`` belongs to the neighbours i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*prefixes, -1]):
        first = i
        while stack and stack[-1][0] > value:
            height, first = stack.pop()
            yield height, first, i
        if value > 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def maximal_repeats(contexts: list[tuple[int, bytes]], length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(context number, first, end) of every occurrence of every maximal repeat that holds the anchor.

    A context is (bytes left of the anchor, bytes). Places count from the context's start.
    """
    rights = [c[left:] for left, c in contexts]
    lefts = [c[:left][::-1] for left, c in contexts]
    if len(contexts) == 2:
        left, right = common_prefix(*lefts), common_prefix(*rights)
        if left + right >= length:
            for n in (0, 1):
                yield n, contexts[n][0] - left, contexts[n][0] + right
        return
    order = sorted(range(len(contexts)), key=rights.__getitem__)
    prefixes = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    by_left = sorted(range(len(contexts)), key=lefts.__getitem__)
    rank = np.empty(len(contexts), np.int64)
    rank[by_left] = np.arange(len(contexts))
    agree = np.array([common_prefix(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:])], np.int64)
    longest = int(agree.max())
    for right, first, last in intervals(prefixes):
        if right + longest < length:
            continue
        # Members by what stands to their left; neighbours agree on the least of the steps between them.
        ranks = np.sort(rank[order[first: last + 1]])
        steps = np.minimum.reduceat(agree[: ranks[-1]], ranks[:-1])
        extent = np.maximum(np.concatenate([[0], steps]), np.concatenate([steps, [0]]))
        for r, left in zip(ranks.tolist(), extent.tolist()):
            if left + right >= length:
                n = by_left[r]
                yield n, contexts[n][0] - left, contexts[n][0] + right


SPANS = "key string, start long, end long"


def _grouped_spans(grouped: DataFrame, length: int) -> DataFrame:
    """Spans of maximal repeats in groups of one anchor each, from (anchor, key, start, left, context)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, group = None, []
        out: list[tuple] = []

        def finish():
            if len(group) > 1:
                best = {}
                for n, low, high in maximal_repeats([(left, c) for _, _, left, c in group], length):
                    best.setdefault(n, set()).add((low, high))
                for n, spans in best.items():
                    key, start = group[n][:2]
                    out.extend((key, start + low, start + high) for low, high in spans)

        def batch_of(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))], ["key", "start", "end"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != anchor:
                    finish()
                    anchor, group = row[0], []
                group.append(row[1:])
            if out:
                yield batch_of(out)
                out = []
        finish()
        if out:
            yield batch_of(out)

    columns = ["anchor", "key", "start", "left", "context"]
    return grouped.select(*columns).repartition("anchor").sortWithinPartitions("anchor", "key", "start").mapInArrow(scan, SPANS)


def _banded(large: DataFrame, width: int, length: int) -> DataFrame:
    """Contexts cut into bands of ``width`` starts, grouped by what all strings of the band have in common.

    Equal strings start equally far before the anchor, so they are in the same band and share these bytes.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for anchor, holder, key, start, left, context in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    nearest = left - (len(context) - length)  # the last string starts so far before the anchor
                    for band in range(nearest // width, left // width + 1):
                        first = left - min(left, band * width + width - 1)
                        last = left - max(nearest, band * width)
                        inner = context[left - band * width: left - band * width + length - width + 1] if band * width <= left else b""
                        group = xxhash.xxh3_64_intdigest(inner, seed=(anchor + band * width) & 0xFFFFFFFFFFFFFFFF)
                        part = context[first: last + length]
                        rows.append((group - (1 << 63), xxhash.xxh3_128_digest(part, seed=left - first), holder, key, start + first, left - first, part))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), CONTEXT)], schema=CONTEXT)

    return large.select("anchor", "holder", "key", "start", "left", "context").mapInArrow(cut, CONTEXT_COLUMNS)


def _spans(contexts: DataFrame, scratch: Scratch, bands: tuple[int, ...], length: int) -> DataFrame:
    """Spans of all strings that different texts share, from contexts.

    Equal contexts are repeats as a whole. Groups of up to ``SORTED`` different ones are sorted; larger ones are
    divided into bands, again and again, the last time of one start, where only equal strings stay together.
    """
    distinct = scratch.keep(
        contexts.groupBy("anchor", "digest").agg(F.min("holder").alias("holder"), F.max("holder").alias("other")), "distinct"
    )
    held = distinct.where(F.col("holder") != F.col("other")).select("anchor", "digest")
    end = F.col("start") + F.octet_length("context")
    whole = contexts.select("anchor", "digest", "key", "start", end.alias("end")).join(held, ["anchor", "digest"], "left_semi").select("key", "start", "end")
    if not bands:
        return whole
    sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    ones = distinct.drop("other").join(sizes, "anchor")
    groups = contexts.join(ones, ["anchor", "digest", "holder"]).dropDuplicates(["anchor", "digest", "holder"])
    groups = scratch.keep(groups.select("anchor", "holder", "key", "start", "left", "context", "size"), "groups")
    found = whole.union(_grouped_spans(groups.where(F.col("size") <= SORTED), length))
    large = groups.where(F.col("size") > SORTED)
    if large.isEmpty():
        return found
    return found.union(_spans(scratch.keep(_banded(large, bands[0], length), "bands"), scratch, bands[1:], length))


def repeated_spans(documents: DataFrame, scratch: Scratch, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """The described rows (doc_id, key, n_bytes, copies), and the spans (key, start, end) of repeats.

    Spans are of texts without copies; a text with copies is a repeat as a whole if it is long enough.
    """
    if length <= ANCHOR:
        raise ValueError(f"repeats must be longer than an anchor of {ANCHOR} bytes, not {length}")
    described = scratch.keep(_described(documents, length), "described")
    long = described.where(F.col("n_bytes") >= length)
    texts = scratch.keep(long.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep")), "texts")
    chosen = texts.select(F.col("key").alias("_key"), "rep")
    short = F.unhex(F.substring("key", 1, 32))  # half the hash tells texts apart; a text has an anchor per 90 bytes or so
    is_chosen = lambda df: (df["key"] == chosen["_key"]) & df["doc_id"].eqNullSafe(chosen["rep"])
    firsts = long.join(chosen, is_chosen(long)).groupBy("key").agg(F.first("anchors").alias("anchors"))  # repeated rows bring the same anchors again
    listed = scratch.keep(firsts.select(short.alias("short"), F.explode("anchors").alias("anchor")), "anchors")
    shared = listed.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    wanted = listed.join(shared, "anchor", "left_semi").groupBy("short").agg(F.collect_list("anchor").alias("shared"))
    wanted = wanted.join(texts.select("key", "rep", short.alias("short")), "short").select(F.col("key").alias("_key"), "rep", "shared")
    keyed = documents.where(F.octet_length("text") >= length).select(F.sha2("text", 256).alias("key"), "doc_id", "text")
    whole_texts = keyed.join(wanted, (keyed["key"] == wanted["_key"]) & keyed["doc_id"].eqNullSafe(wanted["rep"]))
    contexts = scratch.keep(_contexts(whole_texts.select("key", "text", "shared"), length), "contexts")

    own = described.where(F.size("own") > 0).select("key", F.inline("own"))
    single = texts.where("copies = 1").select("key")
    spans = _spans(contexts, scratch, BANDS, length).union(own).join(single, "key", "left_semi")
    rows = described.drop("anchors", "own").join(texts.select("key", "copies"), "key", "left")
    return rows, spans


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    runs: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if runs and low <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], high))
        else:
            runs.append((low, high))
    return runs


def _runs_of_text(scratch: Scratch, spans: DataFrame) -> DataFrame:
    """One row per text that has repeats: key and its spans, bounded by the text's own anchors."""
    return scratch.keep(spans.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")


def _cut_out(raw: bytes, spans: list[dict]) -> tuple[list[tuple[int, int]], bytes]:
    runs = merge([(s["start"], s["end"]) for s in spans])
    kept, at = [], 0
    for low, high in runs:
        kept.append(raw[at:low])
        at = high
    return runs, b"".join([*kept, raw[at:]])


def _whole_characters(raw: bytes, spans: list[dict]) -> str:
    """The text without the runs, each run shrunk to the characters that lie in it whole."""
    kept, at = [], 0
    for low, high in merge([(s["start"], s["end"]) for s in spans]):
        while low < high and raw[low] & 0xC0 == 0x80:
            low += 1
        while high > low and high < len(raw) and raw[high] & 0xC0 == 0x80:
            high -= 1
        kept.append(raw[at:low])
        at = high
    return b"".join([*kept, raw[at:]]).decode()


REMOVED = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()), ("text", pa.string()),
])


def removal(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the remaining text of every document.

    The hash is that of the remaining bytes; ``text`` keeps characters of which a run covers some bytes only, so that it
    stays text.

    Defined cases: a null text is empty; texts under ``length`` bytes lose nothing; repeated rows and equal
    texts of that length lose everything; an empty table gives no rows; columns other than doc_id and
    text are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    changes = _changes(documents, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc_id, text, gone, spans in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    raw = text.encode()
                    runs, kept = ([(0, len(raw))], b"") if gone else _cut_out(raw, spans or [])
                    left = "" if gone else _whole_characters(raw, spans) if spans else text
                    rows.append((doc_id, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), left))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), REMOVED)], schema=REMOVED)

    joined = documents.join(changes, F.sha2(documents["text"], 256) == changes["_key"], "left")
    return joined.select(documents["doc_id"], documents["text"], "_gone", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    )


def _changes(documents: DataFrame, length: int) -> DataFrame:
    """The texts that lose anything, by key: copies lose everything (``_gone``), others their ``spans``.

    What was written on the way goes when this is.
    """
    spark = documents.sparkSession
    with temporary(spark, keep=lambda folder: "/changes-" in folder):
        scratch = Scratch(spark)
        rows, spans = repeated_spans(documents, scratch, length)
        copied = rows.where("copies > 1").select("key").distinct().withColumn("_gone", F.lit(True))
        changes = _runs_of_text(scratch, spans).join(copied, "key", "full").select(F.col("key").alias("_key"), "_gone", "spans")
        return scratch.keep(changes, "changes")


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeats of ``length`` bytes or more taken out of ``text``; other columns stay.

    Bytes of characters that a run covers only in part stay, so that the text remains text; ``n_chars``, if there,
    is counted anew. Null texts stay null. Texts without repeats are passed on as they are.
    """
    changes = _changes(documents.select(F.col("doc_id").cast("long"), "text"), length)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else _whole_characters(t.encode(), s) for t, s in zip(texts, spans)], dtype=object)

    joined = documents.join(changes, F.sha2(documents["text"], 256) == changes["_key"], "left")
    text = F.when(changes["_gone"], F.lit("")).when(changes["spans"].isNull(), documents["text"]).otherwise(cleaned(documents["text"], changes["spans"]))
    columns = {"text": text.alias("text")}
    result = joined.select(*[columns.get(c, documents[c]) for c in documents.columns])
    return result.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in documents.columns else result
