"""Languages of words, and so of texts, by a linear-chain conditional random field.

A word's features are itself (the lexicon), its prefixes and suffixes up to three letters and its letter
trigrams, hashed; learned transitions say how likely one language follows another. Forward-backward gives
every word of a whole text a probability for each language, also where a text switches between languages; the
text's language is the one with the largest sum.

The field is fitted on a bounded sample: fragments of ``FRAGMENT`` characters of the ``PER_LANGUAGE`` documents of
each language with the least hashed ids. Half of the training sequences join fragments of two languages.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import bucket_of_id
from kalends.llm.tokens import Remembered

BITS = 17
PER_LANGUAGE = 600
FRAGMENT = 1000
#: Words of a training sequence, sequences of one step, passes over the sample, and the first step's size.
SEQUENCE, BATCH, EPOCHS, RATE = 40, 64, 4, 0.2
#: Rows with this remainder of crc32(doc_id) by FOLDS are held out.
FOLDS, HELD_OUT = 5, 0
UNDETERMINED = "und"
#: Words whose scores a worker remembers, words it handles at once, and words of a lane.
REMEMBERED, AT_ONCE, LANE = 300_000, 200_000, 64

_WORDS = re.compile(r"[^\W\d_]+")


def _hashed(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) >> (64 - BITS)


#: Affixes and trigrams recur, so their hashes are remembered.
_PART = Remembered(_hashed)


def has_letters(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def features(word: str) -> list[int]:
    """Hashed features of a word; none for a word without letters."""
    if not has_letters(word):
        return []
    marked = f"^{word}$"
    parts = ["<" + word[:1], "<" + word[:2], "<" + word[:3], ">" + word[-1:], ">" + word[-2:], ">" + word[-3:]]
    parts += [marked[i: i + 3] for i in range(len(marked) - 2)]
    return list({_hashed("=" + word), *map(_PART.__getitem__, parts)})


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def posteriors(scores: np.ndarray, firsts: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of every label for every word of sequences laid end to end, by forward-backward.

    ``scores`` are log scores (words x labels), ``firsts`` marks words that begin a sequence, ``start`` and
    ``moves`` are log scores of the first label and of transitions. The words are cut into lanes handled side by
    side; lanes are linked through the products of their transition matrices, so the result is exact.
    """
    n, labels = scores.shape
    lanes = -(-n // LANE)
    pad = lanes * LANE - n
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    e = np.concatenate([e, np.ones((pad, labels))]).reshape(lanes, LANE, labels)
    first = np.concatenate([firsts, np.ones(pad, bool)]).reshape(lanes, LANE)
    t, s = np.exp(moves - moves.max()), np.exp(start - start.max())

    def forward(x, step):  # rows of x are distributions over the label before
        reset = x.sum(axis=-1, keepdims=True) * s
        mark = first[:, step].reshape(-1, *[1] * (x.ndim - 1))
        y = np.where(mark, reset, x @ t)
        return y * (e[:, step] if x.ndim == 2 else e[:, step, None])

    product = np.broadcast_to(np.eye(labels), (lanes, labels, labels))
    for step in range(LANE):
        product = forward(product, step)
        product = product / product.sum(axis=(1, 2), keepdims=True)
    before, after = np.empty((lanes, labels)), np.empty((lanes, labels))
    x = np.ones(labels) / labels
    for lane in range(lanes):
        before[lane] = x
        x = x @ product[lane]
        x = x / x.sum()
    x = np.ones(labels)
    for lane in range(lanes - 1, -1, -1):
        after[lane] = x
        x = product[lane] @ x
        x = x / x.sum()
    alpha = np.empty((lanes, LANE, labels))
    for step in range(LANE):
        before = _normal(forward(before, step))
        alpha[:, step] = before
    for step in range(LANE - 1, -1, -1):
        alpha[:, step] *= after
        weighted = e[:, step] * after
        reset = np.broadcast_to((weighted @ s)[:, None], weighted.shape)
        after = _normal(np.where(first[:, step, None], reset, weighted @ t.T))
    return _normal(alpha).reshape(-1, labels)[:n]


@dataclass
class Field:
    """A fitted field: label names, weights per feature, scores of transitions and of the first label."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray


def _pair_counts(scores, gamma, moves):
    """Expected transitions of sequences (batch x words x labels) of one length, given their posteriors."""
    batch, length, labels = scores.shape
    e, t = np.exp(scores - scores.max(axis=2, keepdims=True)), np.exp(moves - moves.max())
    back = np.ones((batch, labels))
    total = np.zeros((labels, labels))
    for k in range(length - 1, 0, -1):
        weighted = e[:, k] * back
        # P(next | this) does not depend on what came before.
        step = t[None] * weighted[:, None, :]
        total += (gamma[:, k - 1, :, None] * step / step.sum(axis=2, keepdims=True)).sum(axis=0)
        back = _normal(weighted @ t.T)
    return total


def fit(fragments: list[tuple[str, str]]) -> Field:
    """Fit to (language, text) by stochastic gradients of the conditional likelihood, with step sizes per weight."""
    names = sorted({lang for lang, _ in fragments})
    size = len(names)
    rng = np.random.default_rng(11)
    cache: dict[str, list[int]] = {}
    pieces: list[tuple[int, list[list[int]]]] = []
    for lang, text in fragments:
        found = [cache.setdefault(w, features(w)) for w in words_of(text)]
        found = [f for f in found if f]
        if found:
            # the last sequence is filled up with the fragment's words from the start
            whole = -(-len(found) // SEQUENCE) * SEQUENCE
            tiled = (found * (whole // len(found) + 1))[:whole]
            pieces += [(names.index(lang), tiled[i: i + SEQUENCE]) for i in range(0, whole, SEQUENCE)]
    weights, moves, start = np.zeros((1 << BITS, size)), np.zeros((size, size)), np.zeros(size)
    squares = [np.full(p.shape, 1e-2) for p in (weights, moves, start)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(pieces))
        for at in range(0, len(order), BATCH):
            batch = []
            for k in order[at: at + BATCH]:
                label, words = pieces[k]
                other, tail = pieces[rng.integers(len(pieces))]
                cut = int(rng.integers(5, SEQUENCE - 5)) if rng.random() < 0.5 else SEQUENCE
                batch.append(([label] * cut + [other] * (SEQUENCE - cut), words[:cut] + tail[cut:]))
            gold = np.array([x for x, _ in batch])
            flat = [f for _, words in batch for f in words]
            ids, ends = np.concatenate(flat), np.cumsum([len(f) for f in flat])
            scores = np.add.reduceat(weights[ids], np.concatenate([[0], ends[:-1]]), axis=0)
            firsts = np.zeros(len(flat), bool)
            firsts[::SEQUENCE] = True
            gamma = posteriors(scores, firsts, start, moves).reshape(len(batch), SEQUENCE, size)
            truth = np.eye(size)[gold]
            pairs = _pair_counts(scores.reshape(gamma.shape), gamma, moves)
            np.subtract.at(pairs, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
            slope = np.repeat((gamma - truth).reshape(-1, size), np.diff(np.concatenate([[0], ends])), axis=0)
            used, place = np.unique(ids, return_inverse=True)
            slope = np.stack([np.bincount(place, slope[:, j], len(used)) for j in range(size)], axis=1) / len(batch)
            squares[0][used] += slope ** 2
            weights[used] -= RATE * slope / np.sqrt(squares[0][used])
            for p, g, q in ((moves, pairs / len(batch), squares[1]), (start, (gamma - truth)[:, 0].mean(axis=0), squares[2])):
                q += g ** 2
                p -= RATE * g / np.sqrt(q)
    return Field(names, weights.astype(np.float32), moves, start)


class Labeller:
    """Language and score of texts, by the words' posteriors."""

    def __init__(self, field: Field):
        self.field = field
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.new: list[str] = []
        self.known = 1
        self.scores = np.zeros((1024, len(self.field.labels)))

    def numbers(self, text: str | None) -> list[int]:
        """Rows of the score table for a text's words; words without letters have row 0."""
        words, number = words_of(text), self.number
        for word in set(words).difference(number):
            number[word] = 0
            if has_letters(word):
                number[word] = self.known + len(self.new)
                self.new.append(word)
        return list(map(number.__getitem__, words))

    def _learn(self) -> None:
        """Score the words that are new since the last call."""
        if not self.new:
            return
        hashed = [features(word) for word in self.new]
        begins = np.concatenate([[0], np.cumsum([len(f) for f in hashed])[:-1]])
        ids = np.fromiter(itertools.chain.from_iterable(hashed), np.int64)
        last = self.known + len(self.new)
        if last > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros((max(last, len(self.scores)), self.scores.shape[1]))])
        self.scores[self.known: last] = np.add.reduceat(self.field.weights[ids], begins, axis=0)
        self.known, self.new = last, []

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        waiting: list[np.ndarray] = []
        words = 0
        for text in texts:
            waiting.append(np.array(self.numbers(text), np.int64))
            words += len(waiting[-1])
            if words >= AT_ONCE:
                out += self._labelled(waiting)
                waiting, words = [], 0
                if self.known > REMEMBERED:
                    self.forget()
        return out + self._labelled(waiting)

    def _labelled(self, texts: list[np.ndarray]) -> list[tuple[str, float]]:
        self._learn()
        texts_ = [t[t > 0] for t in texts]
        sizes = np.array([len(t) for t in texts_], np.int64)
        out = [(UNDETERMINED, 0.0)] * len(texts)
        full = np.flatnonzero(sizes)
        if len(full):
            scores = self.scores[np.concatenate([texts_[k] for k in full])]
            begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            firsts = np.zeros(len(scores), bool)
            firsts[begins] = True
            shares = np.add.reduceat(posteriors(scores, firsts, self.field.start, self.field.moves), begins, axis=0) / sizes[full, None]
            for k, share in zip(full.tolist(), shares):
                best = int(share.argmax())
                out[k] = (self.field.labels[best], float(min(share[best], 1.0)))
        return out


def training_fragments(documents: DataFrame) -> list[tuple[str, str]]:
    """(language, fragment) of the bounded sample; held-out rows, null languages and null texts take no part."""
    known = documents.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (bucket_of_id(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    spare = F.greatest(F.length("text") - FRAGMENT, F.lit(0)) + 1
    fragment = F.substring("text", F.pmod(F.xxhash64("doc_id"), spare).cast("int") + 1, F.lit(FRAGMENT))
    # Ranges of hashes are counted first: only rows up to the range in which a language's sample is complete are numbered.
    hashed = known.select("doc_id", "lang", F.shiftright(F.xxhash64("doc_id"), 52).alias("_range"))
    ranges = hashed.groupBy("lang", "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy("lang").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = ranges.withColumn("_before", before).where(F.col("_before") < PER_LANGUAGE).groupBy("lang").agg(F.max("_range").alias("_last"))
    near = hashed.join(last.withColumnRenamed("lang", "_named"), F.col("lang") == F.col("_named")).where(F.col("_range") <= F.col("_last"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = near.select("doc_id", "lang").withColumn("_place", place).where(F.col("_place") <= PER_LANGUAGE)
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    rows = (
        known.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))  # PER_LANGUAGE rows each
        .groupBy("doc_id", "lang").agg(F.min(fragment).alias("fragment")).collect()
    )
    return [(r.lang, r.fragment) for r in sorted(rows, key=lambda r: (r.doc_id, r.lang))]


def labelled(documents: DataFrame, *carried: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, and the ``carried`` columns of its row.

    Defined cases: a null text or one without letters is ``und`` with score 0; without any labelled row every text
    is ``und``; a null id is neither learned from nor held out; repeated rows get equal results; an
    empty table gives no rows; columns other than doc_id, text and lang are ignored.
    """
    model = training_fragments(documents.select(F.col("doc_id").cast("long"), "text", "lang"))
    field = fit(model) if any(words_of(text) for _, text in model) else None
    shared = documents.sparkSession.sparkContext.broadcast(field)  # 2 ** BITS weights per language

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value) if shared.value else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = labeller(texts) if labeller else [(UNDETERMINED, 0.0)] * len(texts)
            yield pa.record_batch(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64()), *batch.columns[2:]],
                ["doc_id", "lang_pred", "score", *carried],
            )

    given = documents.select(F.col("doc_id").cast("long"), "text", *carried)
    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in given.schema.fields[2:])
    return given.mapInArrow(label, "doc_id long, lang_pred string, score double" + more).select(
        "doc_id", (bucket_of_id(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", *carried
    )
