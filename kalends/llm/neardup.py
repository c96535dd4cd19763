"""Near duplicates on five-word shingles by a chosen-path set similarity join.

Each document's shingle set is summarised by minwise tokens. A tree of the forest starts by sending every
document down the path of one chosen token; nodes that hold many documents are branched again by
further tokens, small nodes are compared exhaustively, and independent trees are repeated until a pair at the
threshold is missed with negligible probability. Pairs whose tokens agree often enough are confirmed on the
full shingle sets, and confirmed links are contracted to connected components.

Large nodes whose members resemble each other are families of different copies and are not branched. Families with a
member in common are one cluster. Links to its most typical member connect most of a cluster; what they leave apart is
compared on the full sets, every member of a cluster with every other one of another component, in tasks of two
blocks each. The work of that last step grows with the size of the cluster times the number of its members left apart.

Documents with equal sets are one member of the join, so groups of copies cost one comparison, however large.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import SPACES
from kalends.llm.tokens import Remembered
from kalends.storage import Scratch, materialise, temporary

WORDS = 5
#: Two sets are linked when SIMILAR_TO * |union| <= 100 * |intersection|.
SIMILAR_TO = 75

#: Minwise tokens per document; the first TREES of them are the trees' first choices.
TOKENS = 32
TREES = 16
#: Nodes up to this size are compared exhaustively; larger ones are branched by CHILDREN tokens, LEVELS times.
NODE = 64
CHILDREN = 2
LEVELS = 4
#: Members to a block where what is left of a cluster is compared; a task holds two blocks of full sets.
BLOCK = 256
#: Shingles of a task that are counted at a time.
COLUMNS = 2048
#: Equal tokens (of 32) that make a pair a candidate. A pair at similarity 0.75 has 24 on average and stays below
#: 13 with a probability of about 1e-5.
AGREEING = 13
#: Equal tokens that make two members alike enough to be of one family.
ALIKE = 10

_MULTIPLIERS = np.random.default_rng(20240611).integers(0, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of whole texts."""

    def __init__(self):
        self.word = Remembered(xxhash.xxh64_intdigest)

    def __call__(self, text: str | None) -> np.ndarray:
        # Lower-casing UTF-8 bytes changes A-Z only, and splitting them cuts at blanks and 0x09-0x0D only.
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.word.__getitem__, words), np.uint64, len(words))
        span = min(WORDS, len(words))
        total = np.full(len(words) - span + 1, span, np.uint64)
        for k in range(span):
            total = total * _STEP + hashes[k: len(words) - span + 1 + k]
        return np.unique(_mixed(total))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set, a slice at a time."""
    with np.errstate(over="ignore"):
        least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 8192):
            least = np.minimum(least, (shingles[at: at + 8192, None] * _MULTIPLIERS).min(axis=0))
    return least


def summaries(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets, null for empty ones) and the minwise tokens."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            counts, keys, tokens = [], [], []
            for text in batch.column(1):
                s = shingler(text.as_py())
                counts.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                tokens.append(minwise(s).view(np.int64) if len(s) else None)
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "tokens"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        summarise, "doc_id long, n_shingles long, set_key binary, tokens array<long>"
    )


def _roots(members: DataFrame) -> DataFrame:
    """The first node of every member in every tree."""
    chosen = F.slice("tokens", 1, TREES)
    return members.select("member", F.posexplode(chosen).alias("tree", "token")).select(
        "member", F.xxhash64("tree", "token").alias("path")
    )


def _branches(large: DataFrame, members: DataFrame) -> DataFrame:
    """Child nodes of large nodes: the path extended by tokens that the path itself chooses."""
    picks = [F.pmod(F.xxhash64("path", F.lit(k)), F.lit(TOKENS)).cast("int") for k in range(CHILDREN)]
    # Distinct positions, so that a node is not branched twice by the same token.
    picks = [picks[0]] + [F.pmod(picks[0] + 1 + F.pmod(p, F.lit(TOKENS - 1)), F.lit(TOKENS)).cast("int") for p in picks[1:]]
    child = [F.xxhash64("path", p, F.get("tokens", p)) for p in picks]
    return large.join(members, "member").select("member", F.explode(F.array(*child)).alias("path"))


def _grown_nodes(members: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """(member, path) of every small node, and (member, path) of large ones that are not branched further.

    A large node most of whose members resemble one of them, taken by its hash, is a family: branching would take it apart
    slowly and compare its members over and over, so it stays whole. Other large nodes, of texts that share a
    passage but little else, are branched ``LEVELS`` times.
    """
    pivots = members.select(F.col("member").alias("pivot"), F.col("tokens").alias("pivot_tokens"))
    nodes, small, whole = _roots(members), [], []
    for level in range(LEVELS + 1):
        sizes = nodes.groupBy("path").agg(
            F.count(F.lit(1)).alias("size"), F.min_by("member", F.xxhash64("member", "path")).alias("pivot")
        ).where(F.col("size") > 1)
        shared = scratch.keep(nodes.join(sizes, "path"), f"nodes-{level}")
        small.append(shared.where(F.col("size") <= NODE).select("member", "path"))
        large = shared.where(F.col("size") > NODE)
        if large.isEmpty():
            break
        if level == LEVELS:
            whole.append(large.select("member", "path"))
            break
        alike = _agreeing(F.col("tokens"), F.col("pivot_tokens")) >= ALIKE
        families = scratch.keep(
            large.join(members, "member").join(pivots, "pivot").groupBy("path").agg(F.avg(alike.cast("int")).alias("share"))
            .where(F.col("share") >= 0.5).select("path"), f"families-{level}"
        )
        whole.append(large.join(families, "path", "left_semi").select("member", "path"))
        nodes = _branches(large.join(families, "path", "left_anti").select("member", "path"), members)
    return reduce(DataFrame.union, small), reduce(DataFrame.union, whole) if whole else None


def _clusters(left: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(member, cluster) of the members of nodes that hold several components; None without such nodes.

    Nodes with a member in common are one cluster.
    """
    placed = left.join(roots, "member", "left").select("path", "member", F.coalesce("root", "member").alias("component"))
    mixed = placed.groupBy("path").agg(
        F.min("member").alias("first"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where(F.col("low") != F.col("high"))
    links = scratch.keep(left.join(mixed, "path").select(F.col("member").alias("a"), F.col("first").alias("b")).distinct(), "left")
    if links.isEmpty():
        return None
    return scratch.keep(
        links.select(F.col("a").alias("member")).distinct().join(connected(links, scratch), "member", "left")
        .select("member", F.coalesce("root", "member").alias("cluster")), "clusters"
    )


def _typical(clusters: DataFrame, members: DataFrame) -> DataFrame:
    """(member, pivot): the pivot of a cluster has the most tokens that are the most frequent at their place."""
    tokens = clusters.join(members, "member").select("cluster", "member", F.posexplode("tokens").alias("place", "token"))
    usual = (
        tokens.groupBy("cluster", "place", "token").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cluster", "place").agg(F.max(F.struct("n", "token"))["token"].alias("token"))
    )
    shared = tokens.join(usual, ["cluster", "place", "token"]).groupBy("cluster", "member").agg(F.count(F.lit(1)).alias("n"))
    pivots = shared.groupBy("cluster").agg(F.max(F.struct("n", F.col("member").alias("m")))["m"].alias("pivot"))
    return clusters.join(pivots, "cluster").where(F.col("member") != F.col("pivot")).select("member", "pivot")


def _apart(clusters: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of clusters with several components, dealt to pairs of blocks: (member, component, path).

    Blocks of the largest component meet the blocks of the other members, and these meet each other, so every two
    members of different components meet in a path.
    """
    placed = clusters.join(roots, "member", "left").select("member", "cluster", F.coalesce("root", "member").alias("component"))
    largest = (
        placed.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("_most"), F.sum("n").alias("_all"))
        .where(F.col("_all") > F.col("_most.n"))
        .select(
            "cluster", F.col("_most.component").alias("_largest"),
            F.ceil(F.col("_most.n") / BLOCK).alias("_inner"), F.ceil((F.col("_all") - F.col("_most.n")) / BLOCK).alias("_outer"),
        )
    )
    dealt = placed.join(largest, "cluster").withColumn("_is_inner", F.col("component") == F.col("_largest")).withColumn(
        "_block", F.pmod(F.xxhash64("member"), F.when(F.col("_is_inner"), F.col("_inner")).otherwise(F.col("_outer")))
    )
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    path = lambda kind, x, y: F.xxhash64("cluster", F.lit(kind), x, y)
    own = F.col("_block")
    met = F.when(F.col("_is_inner"), F.transform(numbers(F.col("_outer")), lambda k: path(0, k, own))).otherwise(F.concat(
        F.transform(numbers(F.col("_inner")), lambda k: path(0, own, k)),
        F.transform(F.filter(numbers(F.col("_outer")), lambda k: k != own), lambda k: path(1, F.least(k, own), F.greatest(k, own))),
    ))
    return dealt.select("member", "component", F.explode(met).alias("path"))


def _links_between(ids: list[int], components: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that join the components of the given sets as far as any pair at the threshold does."""
    sizes = np.array([len(s) for s in sets])
    owners, values = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owners, values = owners[order], values[order]
    new = np.append(True, values[1:] != values[:-1])
    columns = np.cumsum(new) - 1
    held = np.bincount(columns)[columns] > 1
    owners = owners[held]
    columns = np.cumsum(new[held]) - 1
    both = np.zeros((len(sets), len(sets)))
    for low in range(0, int(columns[-1]) + 1 if len(columns) else 0, COLUMNS):
        x, y = np.searchsorted(columns, (low, low + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[owners[x:y], columns[x:y] - low] = 1
        both += has @ has.T
    linked = np.triu(100 * both >= SIMILAR_TO * (sizes[:, None] + sizes[None, :] - both), 1)
    group = np.array(components)
    while True:
        pairs = np.argwhere(linked & (group[:, None] != group[None, :]))
        if not len(pairs):
            return
        for i, j in pairs:
            if group[i] != group[j]:
                yield ids[i], ids[j]
                group[group == group[j]] = group[i]


def _joined(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links on the full sets between members that meet in a path, enough to connect all that are linked."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, ids, components, held = None, [], [], []

        def links():
            found = list(_links_between(ids, components, held)) if len(set(components)) > 1 else []
            return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for at, member, component, shingles in zip(*(batch.column(k) for k in range(4))):
                if at.as_py() != path:
                    yield links()
                    path, ids, components, held = at.as_py(), [], [], []
                ids.append(member.as_py())
                components.append(component.as_py())
                held.append(np.frombuffer(shingles.as_py(), np.uint64))
        yield links()

    carried = apart.join(sets, "member").select("path", "member", "component", "shingles")
    return carried.repartition("path").sortWithinPartitions("path").mapInArrow(compare, "a long, b long").distinct()


def _compared(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs within each small node whose tokens agree often enough: (a, b, agreeing), a < b."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_paths = np.empty(0, np.int64)
        kept_members = np.empty(0, np.int64)
        kept_tokens = np.empty((0, TOKENS), np.int64)

        def pairs(paths, ids, tokens):
            found = []
            bounds = [0, *(np.flatnonzero(np.diff(paths)) + 1).tolist(), len(paths)]
            for low, high in zip(bounds, bounds[1:]):
                if high - low < 2:
                    continue
                t, m = tokens[low:high], ids[low:high]
                agreeing = (t[:, None, :] == t[None, :, :]).sum(axis=2)
                i, j = np.nonzero(np.triu(agreeing >= AGREEING, 1))
                different = m[i] != m[j]
                i, j = i[different], j[different]
                found.append((np.minimum(m[i], m[j]), np.maximum(m[i], m[j]), agreeing[i, j]))
            if found:
                a, b, c = (np.concatenate(x) for x in zip(*found))
                yield pa.record_batch([pa.array(a), pa.array(b), pa.array(c.astype(np.int32))], ["a", "b", "agreeing"])

        for batch in batches:
            paths = np.concatenate([kept_paths, batch.column(0).to_numpy(zero_copy_only=False)])
            ids = np.concatenate([kept_members, batch.column(1).to_numpy(zero_copy_only=False)])
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, TOKENS)
            tokens = np.concatenate([kept_tokens, flat])
            # The last node may go on in the next batch.
            cut = int(np.searchsorted(paths, paths[-1])) if len(paths) else 0
            yield from pairs(paths[:cut], ids[:cut], tokens[:cut])
            kept_paths, kept_members, kept_tokens = paths[cut:], ids[cut:], tokens[cut:]
        yield from pairs(kept_paths, kept_members, kept_tokens)

    carried = nodes.join(members, "member").select("path", "member", "tokens")
    return (
        carried.repartition("path").sortWithinPartitions("path")
        .mapInArrow(compare, "a long, b long, agreeing int").distinct()
    )


def _agreeing(left: Column, right: Column) -> Column:
    return F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda same: same))


def _starred(stars: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of members with their pivots, where the tokens agree often enough."""
    pivots = members.select(F.col("member").alias("pivot"), F.col("tokens").alias("pivot_tokens"))
    return (
        stars.join(members, "member").join(pivots, "pivot")
        .where(_agreeing(F.col("tokens"), F.col("pivot_tokens")) >= AGREEING)
        .select(F.least("member", "pivot").alias("a"), F.greatest("member", "pivot").alias("b"))
    )


def shingle_sets(texts: DataFrame) -> DataFrame:
    """member and its whole shingle set as sorted little-endian 64-bit hashes, from (member, set_key, text).

    Rows whose set has another key are left out: they are other texts under a repeated id.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            found = [shingler(t.as_py()).tobytes() for t in batch.column(2)]
            same = [xxhash.xxh3_128_digest(s) == key for s, key in zip(found, batch.column(1).to_pylist())]
            rows = pa.record_batch([batch.column(0), pa.array(found, pa.binary())], ["member", "shingles"])
            yield rows.filter(pa.array(same, pa.bool_()))

    return texts.select("member", "set_key", "text").mapInArrow(sets, "member long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(left.as_buffer(), np.uint64)
                y = np.frombuffer(right.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= SIMILAR_TO * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    left = sets.select(F.col("member").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("member").alias("b"), F.col("shingles").alias("_right"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "_left", "_right").mapInArrow(confirm, "a long, b long")


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(member, root) for every linked member: the least member it can reach, by star contraction.

    Alternates two steps until nothing changes: every member's larger neighbours are hung onto its least
    neighbour, then its smaller ones are.
    """
    rounds = Scratch(scratch.spark)  # tables of the rounds, dropped when the result is written
    edges = rounds.keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        larger = rounds.keep(larger, "stars")
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        edges = rounds.keep(smaller, "stars")
        # Sums of hashes as decimals: exact, in any order.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            result = scratch.keep(edges.select(F.col("u").alias("member"), F.col("v").alias("root")), "roots")
            rounds.drop()
            return result
        before = now


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row of every group of near duplicates, judged by rows: the least id, null last, then the least text hash.

    Identical rows and rows with equal texts are one text of the join, whatever their ids. Null and blank texts
    are linked with nothing; of those only rows with equal id and text are one. Columns and other rows stay as they are.
    """
    hashed = documents.withColumn("_text", F.coalesce(F.sha2("text", 256), F.lit("")))
    blank = F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACES))) == 0
    own = F.struct(F.col("doc_id").isNull().alias("_null"), F.col("doc_id").alias("_id"))
    least = hashed.where(~blank).groupBy(F.col("_text").alias("_key")).agg(F.min(own).alias("x")).select("_key", "x._id")
    same = (F.col("_text") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    # Every text is numbered once, when it is written, and the join works on the numbers.
    firsts = materialise(
        hashed.where(~blank).join(least, same, "left_semi").union(hashed.where(blank)).dropDuplicates(["_text", "doc_id"])
        .withColumn("_number", F.monotonically_increasing_id()), "firsts"
    )
    found = components(firsts.where(~blank).select(F.col("_number").alias("doc_id"), "text")).select(F.col("doc_id").alias("_number"), "component_id")
    chosen = (
        firsts.where(~blank).select("doc_id", "_text", "_number").join(found, "_number")
        .groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "_text"))["_text"].alias("_key"))
    )
    return firsts.join(chosen, F.col("_text") == F.col("_key"), "left_semi").union(firsts.where(blank)).drop("_text", "_number")


def components(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Confirmation runs twice: first each member's most alike candidate, and the typical member of every cluster of large
    nodes, which connects most of every group, then all candidates that still join different components. Clusters that still
    hold several components are compared on the full sets.

    Defined cases: a null, empty or blank text has an empty set and is linked with nothing; under five words
    the whole sequence is one shingle; rows with equal sets are linked; repeated rows get equal results; a
    null doc_id is linked with nothing, has a null component and is kept; an empty table gives no
    rows; columns other than doc_id and text are ignored.
    """
    with temporary(documents.sparkSession, keep=lambda folder: "/components-" in folder):
        return materialise(_components(documents), "components")


def _components(documents: DataFrame) -> DataFrame:
    scratch = Scratch(documents.sparkSession)
    documents = documents.select(F.col("doc_id").cast("long"), "text")
    rows = materialise(summaries(documents), "summaries")
    members = scratch.keep(
        rows.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("set_key").agg(F.min("doc_id").alias("member"), F.first("tokens").alias("tokens")),
        "members",
    )
    described = members.select("member", "tokens")
    grown = Scratch(documents.sparkSession)
    small, left = _grown_nodes(described, grown)
    candidates = scratch.keep(_compared(small, described), "candidates")
    involved = candidates.select(F.explode(F.array("a", "b")).alias("member")).distinct().join(members.drop("tokens"), "member")
    texts = documents.withColumnRenamed("doc_id", "member").join(involved, "member")
    sets = scratch.keep(shingle_sets(texts), "sets")

    best = F.max(F.struct("agreeing", F.col("other")))
    ends = candidates.select("agreeing", F.explode(F.array(
        F.struct(F.col("a").alias("one"), F.col("b").alias("other")), F.struct(F.col("b").alias("one"), F.col("a").alias("other"))
    )).alias("e")).select("agreeing", "e.one", "e.other")
    nearest = ends.groupBy("one").agg(best.alias("x")).select(
        F.least("one", "x.other").alias("a"), F.greatest("one", "x.other").alias("b")
    ).distinct()
    links = scratch.keep(_confirmed(nearest, sets), "links")
    roots = connected(links, scratch)
    clusters = None if left is None else _clusters(left, roots, scratch)
    grown.drop()
    if clusters is not None:
        texts = documents.withColumnRenamed("doc_id", "member").join(clusters.select("member").join(members.drop("tokens"), "member"), "member")
        whole = scratch.keep(shingle_sets(texts).distinct(), "sets")
        typical = _starred(_typical(clusters, described), described)
        links = links.union(scratch.keep(_confirmed(typical, whole), "links"))
        roots = connected(links, scratch)

    root_of = lambda end: roots.select(F.col("member").alias(end), F.col("root").alias(f"root_{end}"))
    apart = (
        candidates.join(nearest, ["a", "b"], "left_anti")
        .join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
        .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    )
    links = links.union(scratch.keep(_confirmed(apart, sets), "links"))
    final = connected(links, scratch)
    if clusters is not None:
        rest = scratch.keep(_apart(clusters, final), "apart")
        if not rest.isEmpty():
            final = connected(links.union(scratch.keep(_joined(rest, whole), "links")), scratch)

    labels = members.join(final, "member", "left").select("set_key", F.coalesce("root", "member").alias("_root"))
    labelled = rows.drop("tokens").join(labels, "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("_root", "doc_id"))
    return labelled.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


#: The same components in SQL, by joining all shingles; for small tables.
SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM tokens
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach(d, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.e, reach.r FROM reach JOIN (SELECT a AS f, b AS e FROM links UNION ALL SELECT b, a FROM links) l ON l.f = reach.d
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(r) AS component_id, min(r) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.d = d.doc_id GROUP BY 1, 2"""
