"""Encode and decode whole texts with a public piece vocabulary, merging many words at once in numpy rounds.

The vocabulary merges the neighbouring symbols whose joined piece has the best score, leftmost first, until no
two neighbours make a piece. No piece holds a blank behind another character, so a word (a blank and what
follows up to the next) is merged on its own. A round finds the best pair of every word in flat arrays by one
segmented minimum, merges all its occurrences from the left, and compacts the arrays; words without a pair
leave. Words met before are remembered by each Python worker, in a bounded dictionary.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
BLANK = "▁"
#: Words remembered per worker, and the longest that is remembered; longer words are also cut at forced boundaries.
REMEMBERED = 400_000
LONGEST = 64
#: Characters of a text that are worked on at once, and symbols in the arrays of one series of rounds.
SLICE = 1_000_000
SYMBOLS = 400_000

_NONE = np.iinfo(np.int32).max
_SLICE_END = re.compile("(?<! ) ")


class PieceCodec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as file:
            model.ParseFromString(file.read())
        kinds, rule = model.SentencePiece, model.normalizer_spec
        plain = rule.name == "identity" and rule.add_dummy_prefix and rule.escape_whitespaces and not rule.remove_extra_whitespaces
        if not plain or not model.trainer_spec.byte_fallback or any(p.type not in (kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN) for p in model.pieces):
            raise ValueError(f"{model_path} is not a vocabulary with plain text, a leading blank and byte pieces")
        self.size = len(model.pieces)
        self.end_id = next(i for i, p in enumerate(model.pieces) if p.piece == "</s>")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        if any(BLANK in p.lstrip(BLANK) for p in normal):
            raise ValueError(f"{model_path} has a piece with a blank behind another character")
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        #: What each id stands for: bytes of normal and byte pieces, nothing for control pieces.
        self.bytes_of = [
            p.piece.replace(BLANK, " ").encode() if p.type == kinds.NORMAL else bytes([int(p.piece[1:-1], 16)]) if p.type == kinds.BYTE
            else " ⁇ ".encode() if p.type == kinds.UNKNOWN else b""
            for p in model.pieces
        ]
        self.names = [str(i) for i in range(self.size)]
        self._blanks(normal, [p.score for p in model.pieces])
        self._pairs({p: i for p, i in normal.items() if p.strip(BLANK) or len(p) == 1}, [p.score for p in model.pieces])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _blanks(self, normal: dict[str, int], scores: list[float]) -> None:
        """Pieces of blanks alone: they must come last, with one score, so that a run is merged from the left when all else is done."""
        self.runs = {len(p): i for p, i in normal.items() if not p.strip(BLANK)}
        last = {scores[i] for n, i in self.runs.items() if n > 1}
        if 1 not in self.runs or len(last) > 1 or any(scores[i] <= min(last) for p, i in normal.items() if p.strip(BLANK)):
            raise ValueError("pieces of blanks alone must share the least score")

    def _pairs(self, normal: dict[str, int], scores: list[float]) -> None:
        """The table of pairs that make a piece, and the pieces whose occurrences must be merged one by one.

        All occurrences of a word's best pair may be merged at once if no pair that a merge newly makes is as
        good as the merged piece itself. A piece XY at least as good as X is no danger where X = LR and RY is better
        than X, since RY would then have been merged before LR.
        """
        place = {s: n for n, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        rank = {p: place[scores[i]] for p, i in normal.items()}
        table, hasty, self.joined = [], set(), set()
        for piece, own in rank.items():
            self.joined.update(zip(piece, piece[1:]))
            for at in range(1, len(piece)):
                left, right = piece[:at], piece[at:]
                if left not in rank or right not in rank:
                    continue
                table.append((normal[left] * self.size + normal[right], own, normal[piece]))
                for part, near in ((left, lambda a, b, r=right: b + r), (right, lambda a, b, r=left: r + a)):
                    if len(part) > 1 and own <= rank[part]:
                        for cut in range(1, len(part)):
                            a, b = part[:cut], part[cut:]
                            if a in rank and b in rank and not rank.get(near(a, b), _NONE) < rank[part]:
                                hasty.add(rank[part])
        table.sort()
        self.keys, self.ranks, self.merged = (np.array(column, dtype=kind) for column, kind in zip(zip(*table), (np.int64, np.int32, np.int32)))
        self.hasty = np.zeros(len(place) + 1, dtype=bool)
        self.hasty[list(hasty)] = True
        self.of_char = np.arange(0x110000, dtype=np.int32) + self.size  # a character that is no piece has a number of its own
        for piece, i in normal.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of every pair; the rank is ``_NONE`` where the pair is no piece."""
        key = left.astype(np.int64) * self.size + right
        key[(left >= self.size) | (right >= self.size)] = -1
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def merge(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over flat arrays of symbols and their words (ascending); the remaining symbols and words."""
        done_symbols, done_words = [], []
        rank, piece = np.full(len(symbols), _NONE, dtype=np.int32), np.zeros(len(symbols), dtype=np.int32)
        inner = np.flatnonzero(words[:-1] == words[1:])
        rank[inner], piece[inner] = self._looked_up(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(words)]))
            over = best == _NONE
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(words[over])
                symbols, words, rank, piece, best = (x[~over] for x in (symbols, words, rank, piece, best))
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == best)
            # of overlapping occurrences every second one; of pieces that must wait only the first of a word
            number = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], number, 0))
            chosen = (number - run) % 2 == 0
            first = np.r_[True, words[at[1:]] != words[at[:-1]]]
            at = at[chosen & (first | ~self.hasty[rank[at]])]
            symbols[at] = piece[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, words, rank, piece = (x[keep] for x in (symbols, words, rank, piece))
            at -= np.arange(len(at))
            for left in (at, at[at > 0] - 1):
                left = left[left + 1 < len(words)]
                rank[left], piece[left] = self._looked_up(symbols[left], symbols[left + 1])
                rank[left[words[left] != words[left + 1]]] = _NONE
            if len(words):
                rank[-1] = _NONE
        if not done_symbols:
            return symbols, words
        symbols, words = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    def _fragments(self, word: str) -> list[str]:
        """The word, cut where two neighbouring characters stand side by side in no piece."""
        cuts = [0, *(i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.joined), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def _encode_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each word with its ids as bytes; the words start with a blank and hold no other."""
        group: list[tuple[str, int]] = []
        fragments: list[str] = []
        size = 0
        for word in words:
            if len(word) < LONGEST:
                group.append((word, 1))
                fragments.append(BLANK + word)
            else:
                parts = self._fragments(BLANK + word)
                group.append((word, len(parts)))
                fragments += parts
            size += len(word) + 1
            if size >= SYMBOLS:
                yield from self._encode_group(group, fragments)
                group, fragments, size = [], [], 0
        if group:
            yield from self._encode_group(group, fragments)

    def _encode_group(self, group: list[tuple[str, int]], fragments: list[str]) -> Iterator[tuple[str, bytes]]:
        chars = np.frombuffer("".join(fragments).encode("utf-32-le"), dtype=np.uint32)
        numbers = np.repeat(np.arange(len(fragments), dtype=np.int32), np.fromiter(map(len, fragments), np.int64, len(fragments)))
        symbols, numbers = self.merge(self.of_char[chars], numbers)
        unknown = np.flatnonzero(symbols >= self.size)
        if len(unknown):
            spelled = [[self.byte_ids[b] for b in chr(s - self.size).encode()] for s in symbols[unknown].tolist()]
            counts = np.ones(len(symbols), dtype=np.int64)
            counts[unknown] = [len(s) for s in spelled]
            places = np.repeat(symbols >= self.size, counts)
            symbols, numbers = np.repeat(symbols, counts), np.repeat(numbers, counts)
            symbols[places] = [i for s in spelled for i in s]
        of_fragment = np.bincount(numbers, minlength=len(fragments))
        parts = np.array([n for _, n in group], dtype=np.int64)
        of_word = np.add.reduceat(of_fragment, np.cumsum(parts) - parts)
        ends = np.cumsum(of_word).tolist()
        ids, start = symbols.astype("<u4").tobytes(), 0
        for (word, _), end in zip(group, ends):
            yield word, ids[4 * start: 4 * end]
            start = end

    def _of(self, words: set[str]) -> dict[str, bytes]:
        """The ids, as bytes, of all these words."""
        found, new = {}, []
        for word in words:
            ids = self.known.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    new.append(word)
                    continue
                self.known[word] = ids
            found[word] = ids
        for word, ids in self._encode_words(new):
            found[word] = ids
            if len(word) <= LONGEST:
                self.known[word] = ids
                if len(self.known) >= REMEMBERED // 2:
                    self.known, self.older = {}, self.known
        return found

    def _run(self, length: int) -> bytes:
        """The ids of so many blanks, merged from the left."""
        lengths: list[int] = []
        for _ in range(length):
            lengths.append(1)
            while len(lengths) > 1 and lengths[-2] + lengths[-1] in self.runs:
                lengths[-2:] = [lengths[-2] + lengths[-1]]
        return np.array([self.runs[n] for n in lengths], dtype="<u4").tobytes()

    def _joined_up(self, parts: list[str], ids: dict[str, bytes]) -> bytes:
        if "" not in ids:
            return b"".join([ids[p] for p in parts])
        out, blanks, blank = [], 0, self._run(1)
        for part in parts:
            if not part:
                blanks += 1
                continue
            own = ids[part]
            if blanks and own.startswith(blank):  # the word's own blank stayed alone and belongs to the run
                out += self._run(blanks + 1), own[4:]
            else:
                out += self._run(blanks), own
            blanks = 0
        out.append(self._run(blanks))
        return b"".join(out)

    @staticmethod
    def slices(text: str) -> Iterator[str]:
        """The text with its leading blank in slices of bounded size, cut before a blank run; each without its first blank."""
        if not text:
            return
        whole, start = " " + text.replace(BLANK, " "), 0
        while start < len(whole):
            cut = _SLICE_END.search(whole, start + SLICE)
            end = cut.start() if cut else len(whole)
            yield whole[start + 1: end]
            start = end

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """The ids of the text, slice by slice, without an end id."""
        for part in self.slices(text):
            yield self._encode_slice(part)

    def _encode_slice(self, part: str) -> np.ndarray:
        words = part.split(" ")
        ids = self._of(set(words) - {""})
        if "" in words:
            ids[""] = b""
        return np.frombuffer(self._joined_up(words, ids), dtype="<u4")

    def encode_units(self, parts: list[str]) -> list[bytes]:
        """The ids, as bytes, of each part with one blank before it; an empty part is that blank alone."""
        ids = self._of({part for part in parts if part and " " not in part and BLANK not in part})
        return [ids[p] if p in ids else self._run(1) if not p else b"".join([x.tobytes() for x in self.encode(p)]) for p in parts]

    def encode_many(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of every text, without end ids; short texts share the rounds for their new words."""
        group: list[str] = []
        size = 0
        for text in texts:
            if group and size + len(text) > SLICE:
                yield from self._encode_texts(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        yield from self._encode_texts(group)

    def _encode_texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(texts) == 1:
            yield np.concatenate([np.empty(0, dtype="<u4"), *self.encode(texts[0])])
            return
        words = [text.replace(BLANK, " ").split(" ") for text in texts]
        known = self._of(set().union(*words) - {""})
        lone = known | {"": b""}
        for text, parts in zip(texts, words):
            yield np.frombuffer(self._joined_up(parts, lone if "" in parts else known) if text else b"", dtype="<u4")

    def decode(self, ids: list[int]) -> str:
        """The text of ids that ``encode`` gave, the end id among them or not: pieces joined, without the leading blank."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=None)
def piece_codec(model_path: str) -> PieceCodec:
    return PieceCodec(model_path)


def encoded(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit, with the end id) and decoded text of every document.

    Each row is encoded where it is read; nothing is shuffled.

    Defined cases: a null or empty text is its end id alone and decodes to the empty string; a long text is worked on
    in slices, each of which starts at a blank; repeated rows are encoded one by one; an empty table gives no rows;
    columns other than doc_id and text are not read.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(vocabulary)
        for batch in batches:
            rows = [np.append(ids, np.uint32(codec.end_id)) for ids in codec.encode_many([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.record_batch(
                [batch.column(0), pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary()), pa.array([codec.decode(r.tolist()) for r in rows], pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, ids binary, decoded string")


def digests(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what ``encoded`` gives, as digests taken beside the encoder.

    Defined cases as there. A null text counts as empty: one token, the end id.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(vocabulary)
        for batch in batches:
            counts, ids, texts = [], [], []
            for row in codec.encode_many([t or "" for t in batch.column(1).to_pylist()]):
                numbers = [*row.tolist(), codec.end_id]
                counts.append(len(numbers))
                ids.append(hashlib.sha256(" ".join(map(codec.names.__getitem__, numbers)).encode()).hexdigest())
                texts.append(hashlib.sha256(codec.decode(numbers).encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
