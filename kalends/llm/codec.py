"""Encode and decode whole texts with a public word vocabulary, cutting words at forced boundaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.tokens import word_end_codec

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def encoded(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded text of every document.

    Each row is encoded where it is read; nothing is shuffled. A null text counts as empty and gives no
    ids and an empty string. Only doc_id and text are read, so extra columns of any name do no harm.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_end_codec(vocabulary)
        for batch in batches:
            ids, texts = [], []
            for text in batch.column(1):
                a, b = codec.encode(text.as_py() or "")
                ids.append(a)
                texts.append(b)
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, ids binary, decoded string")


def digests(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what ``encoded`` gives, as digests.

    The hashes are taken beside the encoder, so that ids and decoded text need not travel.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_end_codec(vocabulary)
        for batch in batches:
            counts, ids, texts = [], [], []
            for text in batch.column(1):
                a, b = codec.encode(text.as_py() or "")
                counts.append(len(a) // 4)
                ids.append(hashlib.sha256(a).hexdigest())
                texts.append(hashlib.sha256(b.encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
