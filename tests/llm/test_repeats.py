"""Repeats against a brute-force version: every 400-byte string of every text, counted."""

import hashlib
from collections import Counter

import numpy as np

from kalends.llm import repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, spans string"


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    n = repeats.LENGTH
    seen = Counter(r[i: i + n] for r in raws for i in range(len(r) - n + 1))
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - n + 1):
            if seen[r[i: i + n]] > 1:
                gone[i: i + n] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        yield len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def texts():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdeéß")) for _ in range(rng.integers(2, 8)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passage, other = prose(120), prose(150)
    found = [prose(60) + passage + prose(40) for _ in range(8)]
    found += [passage + other, other + passage, other[:390], other[3:], prose(30) + other[100:520] + prose(20)]
    found += ["x" * 3000, "ab" * 900, "x" * 399, "x" * 400, "", None, "   ", prose(300), found[0], found[0]]
    found += [passage + prose(9) + passage, prose(3000) + passage]
    return found


def test_matches_brute_force(spark, monkeypatch):
    rows = texts()
    df = spark.createDataFrame([(i if i else None, t, "en", "s", 1, "k", "v") for i, t in enumerate(rows)], SCHEMA).repartition(3)
    want = {(i if i else None): x for i, x in enumerate(brute(rows))}
    for most in (repeats.SORTED, 2):
        monkeypatch.setattr(repeats, "SORTED", most)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.removal(df).collect()}
        assert got == want


def test_repeated_rows_and_empty_table(spark):
    text = "abc " * 30 + "".join(map(str, range(300)))
    df = spark.createDataFrame([(7, text), (7, text), (8, "y")], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed, r.n_spans) for r in repeats.removal(df).collect()} == {(7, len(text), 1), (8, 0, 0)}
    assert repeats.removal(df.limit(0)).collect() == []


def test_texts_without_repeats_keep_whole_characters(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, "en", "s", 1, "k", "v") for i, t in enumerate(rows)], SCHEMA)
    out = {r.doc_id: r for r in repeats.without_repeats(df).collect()}
    assert len(out) == len(rows) and out[rows.index(None)].text is None and out[0].key == "k"
    for (i, t), (size, removed, _, _) in zip(enumerate(rows), brute(rows)):
        left = len((out[i].text or "").encode())
        assert size - removed <= left <= size - removed + 12


def test_anchors_are_listed_under_short_keys_and_once_for_repeated_rows(spark, monkeypatch):
    """An anchor's row holds half a hash as bytes, not the 64 characters of a whole one."""
    written = {}
    keep = repeats.Scratch.keep
    monkeypatch.setattr(repeats.Scratch, "keep", lambda self, df, label: written.setdefault(label, keep(self, df, label)))
    text = "".join(map(str, range(300)))
    df = spark.createDataFrame([(7, text), (7, text), (8, "z" + text)], "doc_id long, text string")
    scratch = repeats.Scratch(spark)
    repeats.repeated_spans(df, scratch)[1].count()
    listed = [(bytes(r["short"]), r["anchor"]) for r in written["anchors"].collect()]
    assert len(listed) == len(set(listed)) and {len(k) for k, _ in listed} == {16} and len({k for k, _ in listed}) == 2
    scratch.drop()
