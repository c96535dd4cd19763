"""Token ids of whole texts under two public vocabularies, as little-endian unsigned 32-bit bytes.

The byte-level vocabulary encodes a text in one call. For the word vocabulary text is cut where no token can reach
across; the distinct pieces are encoded once per Python worker and kept in a bounded dictionary.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Pieces remembered per worker, and the longest piece remembered.
REMEMBERED = 400_000
LONGEST = 64

# Characters on which Python's and the tokenizers' ideas of letters, case and white space agree;
# texts with others are handed to the tokenizers library for these steps.
UNUSUAL = re.compile("[^\x00-\x1b\x20-ɏ]")


class Remembered(dict):
    """A dictionary that computes what it lacks and never outgrows ``REMEMBERED`` entries.

    It fills up to half of that, becomes the older generation and starts anew; what is asked for again
    moves on, so common pieces stay.
    """

    def __init__(self, compute: Callable[[str], object]):
        self.compute = compute
        self.older: dict = {}

    def __missing__(self, piece: str):
        if len(piece) > LONGEST:
            return self.compute(piece)
        value = self.older.get(piece)
        if value is None:
            value = self.compute(piece)
        if len(self) >= REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = value
        return value


def id_bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=None)
def byte_level_encoder(json_path: str, ranks_path: str) -> Callable[[str], bytes]:
    """The encoder of a byte-level vocabulary: one call of its merger for a whole text.

    Texts with special tokens' strings or unusual characters are handed to the tokenizers library.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(json_path)
    specials = [str(t) for t in (x.content for x in library.get_added_tokens_decoder().values())]
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    merger = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> bytes:
        if UNUSUAL.search(text) or any(s in text for s in specials):
            return id_bytes(library.encode(text, add_special_tokens=False).ids)
        return id_bytes(merger.encode_ordinary(text))

    return encode


class ForcedBoundaries:
    """Which neighbouring bytes never stand side by side inside any token of a vocabulary.

    No merge can join symbols across such a pair, so the bytes on either side are encoded independently.
    """

    def __init__(self, tokens: list[bytes]):
        self.joined = np.zeros((256, 256), dtype=bool)
        for token in tokens:
            if len(token) > 1:
                row = np.frombuffer(token, dtype=np.uint8)
                self.joined[row[:-1], row[1:]] = True
        self.rows = [row.tobytes() for row in self.joined]

    def cuts(self, word: bytes) -> list[int]:
        """Where the word is cut, without its two ends."""
        if len(word) > LONGEST:
            row = np.frombuffer(word, dtype=np.uint8)
            return (np.flatnonzero(~self.joined[row[:-1], row[1:]]) + 1).tolist()
        rows = self.rows
        return [at for at, (a, b) in enumerate(zip(word, word[1:]), 1) if not rows[a][b]]

    def fragments(self, word: bytes) -> list[bytes]:
        bounds = [0, *self.cuts(word), len(word)]
        return [word[a:b] for a, b in zip(bounds, bounds[1:])] if word else []


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordEndCodec:
    """Encode and decode with a lower-casing word vocabulary whose last symbol of a word carries ``</w>``.

    Words are cut at forced boundaries; each fragment is merged on its own, the last one of a word
    with the word-end mark, and the ids are concatenated. Decoding joins the tokens' strings with blanks,
    which is what a vocabulary file without a decoder asks for.
    """

    END = "</w>"

    def __init__(self, json_path: str):
        import regex
        from tokenizers import Tokenizer, models

        self.library = Tokenizer.from_file(json_path)
        with open(json_path, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary, merges = described["model"]["vocab"], [tuple(m) for m in described["model"]["merges"]]
        self.token_of = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.specials = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.alphabet = byte_alphabet()
        self.bytes_of = {i: id_bytes([i]) for i in self.token_of}
        byte_of = {c: b for b, c in enumerate(self.alphabet)}
        stripped = (t.removesuffix(self.END) for t in vocabulary)
        self.boundaries = ForcedBoundaries([bytes(byte_of[c] for c in t) for t in stripped if all(c in byte_of for c in t)])
        self.ending = models.BPE(vocab=vocabulary, merges=merges, end_of_word_suffix=self.END)
        self.inside = models.BPE(vocab=vocabulary, merges=merges)
        pattern = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.words_of = regex.compile(pattern).findall
        self.last_fragment = Remembered(lambda f: self._result([t.id for t in self.ending.tokenize(f)]))
        self.inner_fragment = Remembered(lambda f: self._result([t.id for t in self.inside.tokenize(f)]))
        self.piece = Remembered(self._encode_piece)

    def _encode_word(self, word: bytes) -> list[tuple[bytes, str]]:
        """Ids and tokens of every fragment of a word."""
        letters = word.decode("latin-1").translate(self.alphabet)
        results, start = [], 0
        for cut in self.boundaries.cuts(word):
            results.append(self.inner_fragment[letters[start:cut]])
            start = cut
        results.append(self.last_fragment[letters[start:]])
        return results

    def _result(self, ids: list[int]) -> tuple[bytes, str]:
        """The ids as bytes, and the tokens each followed by a blank."""
        return b"".join([self.bytes_of[i] for i in ids]), "".join([self.token_of[i] + " " for i in ids])

    @staticmethod
    def _joined(results: list[tuple[bytes, str]]) -> tuple[bytes, str]:
        return results[0] if len(results) == 1 else (b"".join([r[0] for r in results]), "".join([r[1] for r in results]))

    def _encode_piece(self, piece: str) -> tuple[bytes, str]:
        """Ids, and the tokens each followed by a blank, of a lower-case piece without white space."""
        return self._joined([f for word in self.words_of(piece) for f in self._encode_word(word.encode())])

    def _encode_unusual(self, text: str) -> tuple[bytes, str]:
        byte_of = {c: b for b, c in enumerate(self.alphabet)}
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return self._joined([f for word, _ in words for f in self._encode_word(bytes(byte_of[c] for c in word))])

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as bytes, and the decoded text."""
        results: list[tuple[bytes, str]] = []
        special = self.special_split is not None and self.special_split.search(text)
        for part in self.special_split.split(text) if special else [text]:
            if part in self.specials:
                results.append(self._result([self.specials[part]]))
            elif UNUSUAL.search(part):
                results.append(self._encode_unusual(part))
            else:
                results += map(self.piece.__getitem__, part.lower().split())
        ids, tokens = self._joined(results)
        return ids, tokens[:-1]


@lru_cache(maxsize=None)
def word_end_codec(json_path: str) -> WordEndCodec:
    return WordEndCodec(json_path)
