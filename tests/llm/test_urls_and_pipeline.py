"""Url rules both ways, and the whole pipeline: passages gone, empty tables, clashing columns."""

import collections

import corpus_pipeline
from kalends.llm import urls
from kalends.storage import materialise

RULES = [("allow", "org/"), ("block", "b.org/x/"), ("allow", "a.b.org/x/y"), ("block", "com/"), ("allow", "com/"), ("block", "a.b.c.net/")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.split(mark, 1)[0]
    path = rest[len(host):]
    for mark in "?#":
        path = path.split(mark, 1)[0]
    path = path if path.startswith("/") else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in {r for _, r in RULES}:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            blocks = any(v == "block" for v, r in RULES if r == rule)
            fits.append((-len(rule), not blocks, rule))
    best = min(fits, default=None)
    return host, path, best and best[2], "allow" if best is None or best[1] else "block"


def test_file_and_join_agree_with_a_loop(spark):
    given = [None, "", "org/", "http://org/", "https://A.B.ORG/x/y?z", "x://b.org/x/#", "x://q.b.org/x", "y://a.com/", "z://com", "z://com?/", "t://a.b.c.net/1",
             "t://b.c.net/1", "t://x.a.b.c.net/", "t://.org/", "t://..com//", "h://" + ".".join(["l"] * 50_000) + ".b.org/x/", "h://e/" + "p" * 50_000]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(given + given[3:5])], "page_id long, url string, rule string, host string")
    want = [(i, *brute(u)) for i, u in enumerate(given + given[3:5])]
    for found in (urls.judged(df, RULES), urls.judged_by_join(df, spark.createDataFrame(RULES, "verdict string, rule string"))):
        assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted(map(tuple, found.collect())) == sorted(want)
    assert urls.judged(df, []).where("rule is not null").count() == 0
    assert urls.judged_by_join(df, spark.createDataFrame([], "verdict string, rule string")).where("rule is not null").count() == 0


def test_no_passage_is_left_in_two_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = corpus_pipeline.table(spark, sf, "documents").withColumnRenamed("source", "source")
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, materialise(stage(spark, docs, sf), name)

    def shared(rows):
        held = collections.defaultdict(set)
        for r in rows:
            words = r.text.split()
            for k in range(len(words) - 50):
                held[" ".join(words[k: k + 51])].add(r.doc_id)
        return sum(len(v) > 1 for v in held.values())

    given, left = before.collect(), {r.doc_id: r.text for r in docs.collect()}
    assert shared(given) > 100 and shared(docs.collect()) == 0
    assert len(left) == len(given) and sum(left[r.doc_id] == r.text for r in given) > 0.85 * len(given)


def test_empty_tables_and_clashing_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = corpus_pipeline.table(spark, sf, "documents")
    for c in ("_row", "member", "key", "kept", "component_id", "lang_pred", "distance", "tokens"):
        docs = docs.withColumn(f"{c}_", docs["doc_id"]) if c == "_row" else docs.withColumn(c, docs["doc_id"])
    small = materialise(docs.limit(60), "clashing")
    for given in (small, small.limit(0)):
        out = given
        for name, stage in corpus_pipeline.STAGES[:4]:
            out = materialise(stage(spark, out, sf), name)
            assert out.columns == docs.columns
        packed = corpus_pipeline.STAGES[4][1](spark, out, sf)
        assert (packed.count() > 0) == (out.count() > 0) == (given is small)
