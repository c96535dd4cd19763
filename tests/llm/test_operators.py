"""Operators without learning: against the libraries, brute force and laws that every result obeys; the pipeline."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from kalends.llm import codec, neardup, packing, quality, sharding, urls
from kalends.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", "   ", "Hello  world\nSECOND line", "naïve café ÀÉÎ straße", "日本語のテキスト 漢字", "emoji 👍🏽 and \u200b zero", "<|endoftext|> x <|startoftext|>",
    "a" * 5000, "tab\tnew\r\nline", "it's we'll I'M 12345 3.14 #$%", "İstanbul ǅ ﬁ", "x\x00y", " lead and trail ", "word " * 3000,
]


def frame(spark, texts):
    return spark.createDataFrame([(i if i != 3 else None, t, "en", "s", 1.0, 5) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, score double, sequence_id int")


def documents():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_codec_agrees_with_the_library(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = TEXTS + [t for _, t in documents()]
    out = {r.doc_id: r for r in codec.encoded(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        row, ids = out[i if i != 3 else None], ids_of(tokenizer, text)
        assert bytes(row.ids) == ids.tobytes()
        assert row.decoded == tokenizer.decode(ids.tolist(), skip_special_tokens=False)
    digests = codec.digests(frame(spark, texts)).collect()
    assert {r.ids_sha256 for r in digests} == {hashlib.sha256(bytes(r.ids)).hexdigest() for r in out.values()}
    assert codec.digests(frame(spark, texts).limit(0)).collect() == []


def test_packing_cuts_nothing_away(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = TEXTS + [t for _, t in documents()]
    out = packing.packed(frame(spark, texts)).collect()
    windows = {}
    for i, text in enumerate(texts):
        ids = np.append(ids_of(tokenizer, text), np.uint32(1)).astype("<u4")
        at = 0
        for r in sorted((r for r in out if r.doc_id == (i if i != 3 else None)), key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at: at + r.length].tobytes())
            at += r.length
            windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(ids)
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert packing.packed(frame(spark, texts).limit(0)).collect() == []


def test_shards_are_balanced_and_gapless(spark):
    out = QUERIES["op8_virtual_slots"](spark, "/root/testdata/sf0.01").collect()
    loads = [sum(r.size for r in out if r.shard == k) for k in range(8)]
    assert max(loads) < 1.05 * min(loads)
    for k in range(8):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))
    odd = sharding.sharded(frame(spark, [None, "", "ß", "x", "x"])).collect()
    assert sorted(r.size for r in odd) == [1, 1, 2, 2, 3]
    assert sharding.sharded(frame(spark, ["x"]).limit(0)).collect() == []


def test_a_grown_map_moves_slots_into_the_new_shard_only():
    sizes = [(int(x), 1) for x in np.random.default_rng(2).integers(0, 1000, 512)]
    owner = sharding.balanced_map(sizes, 8)
    grown = sharding.grown_map(owner, sizes, 8)
    assert all(a == b or b == 8 for a, b in zip(owner, grown))
    loads = np.bincount(grown, [s for s, _ in sizes])
    assert loads.max() < 1.1 * loads.min()


def words(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def test_quality_counts(spark):
    texts = TEXTS + ["one two three one two three four", "a b c d a b c", "x\nx\n\ny\n x\ny", *[t for _, t in documents()]]
    out = {r.doc_id: r for r in quality.outlier_verdicts(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        w, row = words(text), out[i if i != 3 else None]
        seen = {}
        for k in range(len(w) - 2):
            seen.setdefault(tuple(w[k: k + 3]), []).append(k)
        repeated = len({k + j for at in seen.values() if len(at) > 1 for k in at for j in range(3)})
        lines = [line for line in (text or "").split("\n") if words(line)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), repeated)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (len(w) < 50 or 2 * repeated > len(w)) and not (row.kept and row.base_failed)
    assert quality.outlier_verdicts(frame(spark, texts).limit(0)).collect() == []


def test_an_outlier_is_rejected(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(90)) for _ in range(150)]
    texts.append(" ".join("#$%&" * 3 + str(k) for k in range(90)))
    out = quality.outlier_verdicts(frame(spark, texts)).collect()
    assert [r.doc_id for r in out if not r.kept] == [150]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    want = connection.sql(f"select {', '.join(got.columns)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_near_duplicates_of_odd_rows(spark):
    base = " ".join(f"w{k}" for k in range(200))
    texts = [base, base + " tail", base.upper(), None, "", "\t", "two words", "TWO words", "w1 w2", "zz " * 30_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, base, 1), (None, base, 1)], "doc_id long, text string, member int")
    out = neardup.components(df).collect()
    assert len(out) == 12
    component = {r.doc_id: r.component_id for r in out}
    assert [component[i] for i in range(10)] == [0, 0, 0, 3, 4, 5, 6, 6, 8, 9] and component[None] is None
    assert neardup.components(df.limit(0)).collect() == []


def test_large_families_of_different_copies(spark):
    """A hub with thousands of spokes, and pairs in a family without one, that resemble each other at 0.75 to 0.8 only."""
    rng = np.random.default_rng(8)
    def edited(base, n):
        copy = list(base)
        for at in rng.choice(38, n, replace=False) * 5 + 4:
            copy[at] = f"e{rng.integers(1 << 60)}"
        return copy
    hub, other = [f"h{k}" for k in range(200)], [f"o{k}" for k in range(200)]
    firsts = [edited(other, 5) for _ in range(500)]
    texts = [hub, *[edited(hub, 5) for _ in range(2500)], *firsts, *[edited(first, 5) for first in firsts]]
    sets = [{" ".join(t[k: k + 5]) for k in range(196)} for t in texts]
    held = collections.Counter(x for s in sets for x in s)
    number = {s: k for k, s in enumerate(s for s in held if held[s] > 1)}
    root, has = np.arange(len(sets)), np.zeros((len(sets), len(number)), np.float32)
    for i, s in enumerate(sets):
        has[i, [number[x] for x in s if x in number]] = 1
    both = has @ has.T
    for i, j in np.argwhere(100 * both >= 75 * (2 * 196 - both)):
        root[root == max(root[i], root[j])] = min(root[i], root[j])
    out = neardup.components(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert (root == 0).sum() == 2501 and len(set(root.tolist())) >= 400
    assert {r.doc_id: r.component_id for r in out} == dict(enumerate(root.tolist()))


def test_urls_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.ORG/es/x?y"), (5, "http://com"), (6, "http://x.com/de/#a"), (6, "http://x.com/de/#a"), (7, "a://b.org/" + "p" * 100_000)]
    df = spark.createDataFrame([(i, u, "h") for i, u in rows], "page_id long, url string, host string")
    out = urls.judged(df).collect()
    by = {r.page_id: (r.rule, r.verdict) for r in out}
    assert len(out) == 8 and by[4] == ("example.org/es/", "block") and by[6] == ("com/de/", "block") and by[7] == ("org/", "allow")
    assert by[1] == by[2] == by[3] and by[1][0] is None
    assert urls.judged(df.limit(0)).collect() == []


def test_pipeline_keeps_its_promises(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    seen = {r.doc_id: r for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "repeats", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), name)
        assert docs.columns == before.columns
        rows = docs.collect()
        assert 0.5 * before.count() < len(rows) <= before.count()
        if name != "repeats":
            assert all(r == seen[r.doc_id] for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in rows}
    assert sum(r.length for r in corpus_pipeline.run(spark, SF).collect()) == sum(r.length for r in pieces)


def test_pipeline_with_repeated_rows_and_null_ids(spark):
    good = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text and r.lang == "en" and 100 < len(r.text.split()) < 600 and not set(r.text) & set("#*$%&|<>")]
    long = max(good, key=lambda r: len(set(r.text.split())) / len(r.text.split()) + (len(r.text.split()) > 150))
    passage = lambda k: " ".join(np.random.default_rng(ord(k)).permutation(long.text.split()).tolist())
    a, b, c, d = (passage(k) for k in "abcd")
    odd = [(9001, a), (9001, a), (None, b), (None, b), (None, b + " end"), (9002, c), (None, c), (9003, d), (9003, "$ % & # " * 100), (9004, "x x")]
    df = spark.read.parquet(f"{SF}/documents.parquet").unionByName(
        spark.createDataFrame([(i, t, "en", long.source, len(t)) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    )
    docs, texts = df, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), name)
        texts[name] = docs.where("doc_id is null or doc_id > 9000").collect()
    assert sorted((r.doc_id or 0, r.text) for r in texts["language"]) == sorted((i or 0, t) for i, t in odd[:8])
    ends = texts["near_duplicates"]
    assert sorted(r.doc_id or 0 for r in ends) == [0, 9001, 9002, 9003]
    assert {r.text for r in ends if r.doc_id} == {a, c, d} and {r.text for r in ends if not r.doc_id} < {b, b + " end"}
    assert {(r.doc_id, r.text) for r in texts["repeats"]} == {(r.doc_id, r.text) for r in ends}


def test_one_outlier_in_each_component(spark):
    rng = np.random.default_rng(6)
    word = lambda low=2, high=9: "".join(rng.choice(list("abcdefgh"), rng.integers(low, high)))
    line = lambda n=12: " ".join(word() for _ in range(n))
    usual = [" ".join([line(), line(), line(), line(), line(), line()]).replace(" a", " A", int(rng.integers(1, 4))) for _ in range(200)]
    three = line(8)
    planted = {
        "x_length": " ".join(word(14, 18) for _ in range(80)),
        "x_symbols": " ".join(word() + "#" * (k % 2) for k in range(80)),
        "x_lines": "\n".join([line(90), *["xyzxy"] * 12]),
        "x_repeats": " ".join([line(45), three, line(2), three, line(2), three, line(2), three]),
        "x_upper": " ".join(word().upper() if k % 2 else word() for k in range(80)),
    }
    out = {r.doc_id: r for r in quality.outlier_verdicts(frame(spark, usual + list(planted.values()))).collect()}
    assert {name: out[200 + k].kept or out[200 + k].base_failed for k, name in enumerate(planted)} == dict.fromkeys(planted, False)
    assert sum(r.kept for i, r in out.items() if i is None or i < 200) >= 198
    cutoff = quality.chi_square_quantile(quality.INSIDE, len(quality.NAMES))
    most = {"x_lines": 1.0, "x_repeats": (quality.MAX_REPEAT_PERCENT / 100) ** 0.5}
    assert all((most.get(name, 1.0) / floor) ** 2 > cutoff for name, floor in quality.FLOORS.items())
