"""Piece vocabulary against its library, lexical ranking against a loop, alignment against all pairs of tokens."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kalends.llm import alignment, lexical, pieces
from kalends.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "   ", "  a  b ", "Hello  world\nSECOND line", "naïve café ÀÉÎ straße", "日本語のテキスト 漢字", "emoji 👍🏽 and ​ zero",
    "<|endoftext|> <s> </s> <unk> <0x0A>", "x▁y ▁▁ z▁", "a" * 5000, "ab" * 700, "ionionion" * 40, " " * 37, "x" + " " * 15 + "y" + " " * 16 + "\n" + " " * 31,
    "tab\tnew\r\nline", "it's we'll I'M 12345 3.14 #$%", "x\x00y\x01", " lead and trail ", "word " * 3000, "z\x1c y\x85 w\xa0 v  　 u", "日本" * 2000,
]


def frame(spark, texts, key="doc_id"):
    return spark.createDataFrame(
        [(i if i != 3 else None, t, "en", 1.0, 5, 7, 9) for i, t in enumerate(texts)],
        f"{key} long, text string, lang string, score double, rank int, n_tokens long, bundle int",
    )


def documents(table="documents", key="doc_id"):
    return duckdb.sql(f"select {key}, text from '{SF}/{table}.parquet'").fetchall()


# --- pieces -------------------------------------------------------------------------------------

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
CODEC = pieces.piece_codec(MODEL)


def test_pieces_agree_with_the_library(spark):
    texts = TEXTS + [t for _, t in documents()]
    out = {r.doc_id: r for r in pieces.encoded(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        ids, row = LIBRARY.encode(text or "", add_eos=True), out[i if i != 3 else None]
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == ids and row.decoded == LIBRARY.decode(ids)
    digests = {r.doc_id: r for r in pieces.digests(frame(spark, texts)).collect()}
    for i, row in out.items():
        ids = np.frombuffer(bytes(row.ids), "<u4").tolist()
        assert digests[i].n_tokens == len(ids) and digests[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()


def test_pieces_of_repeated_rows_and_empty_tables(spark):
    df = frame(spark, ["same text"] * 3).withColumnRenamed("lang", "ids")
    assert pieces.digests(df.unionByName(df)).count() == 6 and pieces.digests(df.limit(0)).collect() == []
    assert len({r.ids_sha256 for r in pieces.digests(df).collect()}) == 1


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ationhe rs▁ \n\t"), st.characters(codec="utf-8")), max_size=60))
def test_pieces_of_any_text(text):
    ids = LIBRARY.encode(text)
    assert [i for part in CODEC.encode(text) for i in part.tolist()] == ids == next(CODEC.encode_many([text])).tolist()
    assert CODEC.decode([*ids, CODEC.end_id]) == LIBRARY.decode(ids)


def test_long_texts_are_worked_on_in_slices(monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 40)
    monkeypatch.setattr(pieces, "SYMBOLS", 30)
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    codec = pieces.PieceCodec(MODEL)
    for text in [t for t in TEXTS if t] + [t for _, t in documents()[:40]]:
        assert [i for part in codec.encode(text) for i in part.tolist()] == LIBRARY.encode(text)
        assert len(codec.known) + len(codec.older) <= 20


def test_merge_rounds_are_the_merges_one_by_one():
    draw = random.Random(2)
    rank = {k: (int(r), int(p)) for k, r, p in zip(CODEC.keys.tolist(), CODEC.ranks, CODEC.merged)}
    words = ["▁" + "".join(draw.choice("ationeshr") for _ in range(draw.randrange(1, 30))) for _ in range(200)]
    chars = [CODEC.of_char[[ord(c) for c in w]].tolist() for w in words]
    flat, numbers = CODEC.merge(np.array([s for w in chars for s in w], np.int32), np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in chars]))
    for n, word in enumerate(chars):
        while True:
            options = [(rank[a * CODEC.size + b], i) for i, (a, b) in enumerate(zip(word, word[1:])) if a * CODEC.size + b in rank]
            if not options:
                break
            (_, piece), at = min(options, key=lambda o: (o[0][0], o[1]))
            word[at: at + 2] = [piece]
        assert flat[numbers == n].tolist() == word


# --- ranking ------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranks(docs, items):
    held = [(d, collections.Counter(words_of(t)), len(words_of(t))) for d, t in docs if words_of(t)]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = collections.Counter(w for _, c, _ in held for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for w, f in df.items()}
    asked = collections.defaultdict(list)
    for item, text in items:
        asked[item] += words_of(text)
    out = set()
    for item, ws in asked.items():
        scores = []
        for d, c, n in held:
            m = 75 + (25 * n * n_docs) // total
            score = sum(weight[w] * ((10**9 * c[w]) // (1000 * c[w] + 12 * m)) for w in ws if w in c)
            if score > 0:
                scores.append((-score, d is None, d))
        out |= {(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:20], 1)}
    return out


def test_ranking_against_a_loop(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SLOT_DOCS", 7)  # many slots
    monkeypatch.setattr(lexical, "BUNDLE", 3)  # many bundles
    docs, items = documents(), documents("benchmark", "item_id")[:40]
    odd = [(None, "the of and"), (None, "the of and"), (5, "THE the Ünïcode x1 _y-z"), (9001, None), (9002, ""), (9003, "?!")] + [(9100 + i, "equal text of all") for i in range(40)]
    asked = items + [(500, None), (501, "..."), (502, "the THE the of nowhere_else"), (None, "and Ünïcode"), (7, "more of item seven"), (503, "equal text")]
    frame = lambda rows, key: spark.createDataFrame([(i, t, 1, "x") for i, t in rows], f"{key} long, text string, bundle int, term string")
    got = {(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked(frame(docs + odd, "doc_id").repartition(3), frame(asked, "item_id")).collect()}
    assert got == brute_ranks(docs + odd, asked)
    assert lexical.ranked(frame(docs, "doc_id").limit(0), frame(asked, "item_id")).count() == 0
    assert lexical.ranked(frame(docs, "doc_id"), frame(asked, "item_id").limit(0)).count() == 0


def test_ranking_equals_its_sql(spark):
    for table in ("documents", "benchmark"):
        duckdb.sql(f"create or replace view {table} as select * from '{SF}/{table}.parquet'")
    want = duckdb.sql(ORACLES["op12_pipelined_term_ranking"]).fetchall()
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in QUERIES["op12_pipelined_term_ranking"](spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_terms():
    assert [t.decode() for t in lexical.terms("Ab-C_1 É日x\x7f9")] == words_of("Ab-C_1 É日x\x7f9") == ["ab", "c", "1", "É日x", "9"]
    assert lexical.terms(None) == lexical.terms("") == []


# --- alignment ----------------------------------------------------------------------------------

def brute_alignment(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    printable, others, byte_of = [*range(33, 127), *range(161, 173), *range(174, 256)], iter(range(256, 512)), {}
    for b in range(256):
        byte_of[chr(b) if b in printable else chr(next(others))] = b
    counts, out = collections.Counter(), []
    for key, text in rows:
        out.append((key, None))
        if not text:
            continue
        whole = (" " + text).encode()
        a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, LIBRARY.encode(text)
        bytes_a = [bytes(byte_of[c] for c in tokenizer.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(LIBRARY.id_to_piece(i)[1:-1], 16)]) if LIBRARY.is_byte(i) else LIBRARY.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            i0, j0 = i, j
            while i < len(a) and ends_a[i] <= cut:
                i += 1
            while j < len(b) and ends_b[j] <= cut:
                j += 1
            groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
            links += [(a[x], b[y]) for x in range(i0, i) for y in range(j0, j)
                      if ends_a[x] - len(bytes_a[x]) < ends_b[y] and ends_b[y] - len(bytes_b[y]) < ends_a[x]]
        counts.update(links)
        out[-1] = (key, (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    highest = collections.Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (key, 0, 0, 0, 0, 0, 0, "") if found is None else
        (key, *found[:3], len(found[3]), sum(counts[l] == highest[l[1]] for l in found[3]), sum(counts[l] for l in found[3]), found[4])
        for key, found in out
    ]


@pytest.mark.parametrize("block", [alignment.BLOCK_CHARS, 3000])
def test_alignment_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    monkeypatch.setattr(alignment, "UNITS_AT_ONCE", 50)
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS + ["same words again"] * 3)] + [(1000 + d, t) for d, t in documents()]
    df = spark.createDataFrame([(i, t, 1, b"x") for i, t in rows], "doc_id long, text string, block long, units binary")
    got = [tuple(r) for r in alignment.aligned(df.repartition(2)).collect()]
    assert sorted(got, key=str) == sorted(brute_alignment(rows), key=str)
    assert alignment.aligned(df.limit(0)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.randoms(use_true_random=False)), min_size=1, max_size=5))
def test_cuts_are_found_wherever_they_are(units):
    ends_a, ends_b, first_a, first_b, base = [], [], [], [], 0
    for length, draw in units:
        for ends, first, share in ((ends_a, first_a, 0.4), (ends_b, first_b, draw.choice([0.05, 0.6]))):
            first.append(len(ends))
            ends += [base + e for e in range(1, length) if draw.random() < share] + [base + length]
        base += length
    a, b = leaf = alignment.leaf_groups(*(np.array(x, dtype=np.int64) for x in (ends_a, ends_b, first_a, first_b)))
    common = sorted(set(ends_a) & set(ends_b))
    assert [ends_a[i - 1] for i in a.tolist()[1:]] == common[:-1] == [ends_b[i - 1] for i in b.tolist()[1:]] and len(a) == len(common)
    link_a, link_b = alignment.links_of(np.array(ends_a), np.array(ends_b), *leaf)
    want = {(i, j) for i in range(len(ends_a)) for j in range(len(ends_b))
            if ([0, *ends_a][i] < ends_b[j]) and ([0, *ends_b][j] < ends_a[i])}
    assert set(zip(link_a.tolist(), link_b.tolist())) == want and len(link_a) == len(want)
