"""Operators that learn: held-out accuracy, exactness of forward-backward, recall against brute force."""

import itertools

import duckdb
import numpy as np
import pytest

from kalends.llm import annsearch, langid, toxicity
from kalends.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_posteriors_are_exact():
    rng = np.random.default_rng(3)
    start, moves = rng.normal(size=3), rng.normal(size=(3, 3))
    lengths = [1, 6, 2, 4]
    scores = rng.normal(size=(sum(lengths), 3))
    firsts = np.zeros(len(scores), bool)
    firsts[np.cumsum([0, *lengths[:-1]])] = True
    lane, langid.LANE = langid.LANE, 4  # sequences cross lanes
    try:
        got = langid.posteriors(scores, firsts, start, moves)
    finally:
        langid.LANE = lane
    at = 0
    for n in lengths:
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=n):
            weight = start[path[0]] + sum(moves[a, b] for a, b in zip(path, path[1:])) + sum(scores[at + i, k] for i, k in enumerate(path))
            for i, k in enumerate(path):
                total[i, k] += np.exp(weight)
        assert np.allclose(got[at: at + n], total / total.sum(axis=1, keepdims=True))
        at += n


def test_language_of_held_out_documents(spark):
    lang = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    rows = [r for r in QUERIES["op9_chain_field_language"](spark, SF).collect() if r.held_out and r.lang_pred != "und"]
    assert len(rows) > 100
    assert sum(lang[r.doc_id] == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    schema = "doc_id long, text string, lang string, words string, score double"
    good = [(i, "der hund und die katze " * 9 if i % 2 else "the dog and the cat " * 9, "de" if i % 2 else "en", "x", 1.0) for i in range(1, 60)]
    odd = [(100, None, "en", "x", 1.0), (101, "", "en", "x", 1.0), (102, "12 ² _ 3", "de", "x", 1.0), (None, "der hund", "de", "x", 1.0),
           (103, "the cat " * 50_000, None, "x", 1.0), (103, "the cat " * 50_000, None, "x", 1.0)]
    df = spark.createDataFrame(good + odd, schema)
    out = langid.labelled(df).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(good) + len(odd)
    assert [by[i].lang_pred for i in (100, 101, 102, None, 103)] == ["und", "und", "und", "de", "en"]
    assert by[100].score == 0 and not by[None].held_out
    assert langid.labelled(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.labelled(df.where("lang is null")).collect()} == {"und"}


def test_toxicity_ranks_held_out_texts(spark):
    rng = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(400)]
    bad = ["vile", "nasty", "rotten"]
    rows, labels = [], []
    for i in range(900):
        words = list(rng.choice(plain, 80))
        toxic = int(i % 6 == 0)
        if toxic:
            words[int(rng.integers(80))] = bad[i % 3]
        rows.append((i, " ".join(words), "noise"))
        labels.append((i, 1, toxic))
    rows += [(5000, None, "x"), (5001, "", "x"), (None, "vile", "x"), (5002, "w1 " * 200_000 + "vile", "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.scored(documents, known).collect()
    by = {r.doc_id: r for r in out}
    held = [r for r in out if r.doc_id is not None and r.doc_id < 900 and r.held_out]
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    hits = [r.predicted == int(r.doc_id % 6 == 0) for r in held]
    assert sum(hits) >= 0.9 * len(hits)
    assert by[5000].score == by[5001].score < 0.5 and by[None].held_out is False
    assert {r.score for r in toxicity.scored(documents, known.limit(0)).collect()} == {0.0}
    assert toxicity.scored(documents.limit(0), known).collect() == []


def test_neighbours_reach_their_recall(spark):
    found = {}
    for r in QUERIES["op2_kmeans_tree_neighbours"](spark, SF).collect():
        found.setdefault(r.query_id, []).append(r)
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet' where embedding is not null").fetchall()
    rows = [(i, v) for i, v in rows if all(c is not None and np.isfinite(c) for c in v) and any(v)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, distance)) if k != q][:10]
        mine = sorted(found[ids[q]], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert mine == sorted(mine, key=lambda r: (r.score, r.vec_id))
        hits += len({int(ids[k]) for k in order} & {r.vec_id for r in mine})
        total += len(order)
    assert hits >= 0.9 * total


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], 7) for i in range(1, 40)] + [
        (0, [1.0, 2.0], 7), (100, [1.0, 2.5], 7), (100, [1.0, 2.5], 7), (200, None, 7), (300, [0.0, 0.0], 7), (400, [nan, 1.0], 7),
        (500, [inf, 1.0], 7), (600, [None, 1.0], 7), (700, [], 7), (800, [1.0], 7), (None, [1.0, 2.0], 7),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    out = annsearch.nearest(df).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in out] == [(0, i) for i in range(1, 11)] + [(100, i) for i in range(10)]
    assert out[0].score == 0 and out[-1].score == pytest.approx(0.5)
    few = annsearch.nearest(df.where("vec_id in (0, 1, 2)")).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert annsearch.nearest(df.limit(0)).collect() == []
