"""Judge urls by host and path rules held in a sorted, memory-mapped array of 64-bit digests.

A rule is ``host/path``. It fits its host and every subdomain if the url's path starts with the rule's path;
the longest fitting rule wins (of equally long ones a block, then the smaller string). A url therefore
has few candidates: each suffix of its host with no more labels than some rule's host, with each prefix of its
path that has the length of some rule's path. Their digests are looked up by vectorised binary search, and a hit counts only if the
stored string is the candidate itself.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.llm.common import lower_ascii
from kalends.storage import Scratch

#: The rules of the registered query: verdict and rule.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

#: Verdict of a url that no stored rule fits.
OTHERWISE = "allow"

#: Most bytes of rules put into one file for every executor; larger rule tables are joined instead.
LARGEST_FILE = 1 << 26


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for a null or a url without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*(/[^?#]*)?", 1)
    return lower_ascii(host), path


def digest_file(rules: list[tuple[str, str]]) -> bytes:
    """The array file: counts and the most labels of a rule's host, sorted digests, string offsets, verdict flags and the rules' text."""
    chosen: dict[str, str] = {}
    for verdict, rule in rules:
        chosen[rule] = "block" if "block" in (verdict, chosen.get(rule)) else verdict
    keyed = sorted((xxhash.xxh64_intdigest(rule.encode()), rule.encode(), verdict == "block") for rule, verdict in chosen.items())
    lengths = sorted({len(rule.partition("/")[2]) + 1 for rule in chosen})
    labels = max((rule.partition("/")[0].count(".") + 1 for rule in chosen), default=0)
    strings = [rule for _, rule, _ in keyed]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings], dtype=np.int64)]).astype("<i8")
    return b"".join([
        np.asarray([len(keyed), len(lengths), labels], "<i8").tobytes(), np.asarray(lengths, "<i8").tobytes(),
        np.asarray([k for k, _, _ in keyed], "<u8").tobytes(), offsets.tobytes(),
        np.asarray([b for _, _, b in keyed], np.uint8).tobytes(), b"".join(strings),
    ])


class DigestArray:
    """The file, memory-mapped: pages are read when a probe touches them."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        count, kinds, labels = np.frombuffer(data, "<i8", 3)
        at = 24
        self.most_labels = int(labels)
        self.path_lengths = np.frombuffer(data, "<i8", kinds, at).tolist()
        self.keys = np.frombuffer(data, "<u8", count, at := at + 8 * kinds)
        self.offsets = np.frombuffer(data, "<i8", count + 1, at := at + 8 * count)
        self.blocks = np.frombuffer(data, np.uint8, count, at := at + 8 * (count + 1))
        self.data, self.start = data, at + count

    def rule(self, index: int) -> bytes:
        return self.data[self.start + self.offsets[index]: self.start + self.offsets[index + 1]]

    def find(self, candidates: list[bytes]) -> np.ndarray:
        """The index of every stored candidate, -1 for the others."""
        digests = np.fromiter((xxhash.xxh64_intdigest(c) for c in candidates), "<u8", len(candidates))
        at = np.searchsorted(self.keys, digests)
        found = np.full(len(candidates), -1, dtype=np.int64)
        hits = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == digests)) if len(self.keys) else []
        for i in hits:
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == digests[i]:  # different rules may share a digest
                if self.rule(j) == candidates[i]:
                    found[i] = j
                    break
                j += 1
        return found


@lru_cache(maxsize=4)
def _array(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def candidates_of(host: str, path: str, path_lengths: list[int], most_labels: int) -> list[str]:
    """Every rule that could fit, a host's longest suffixes first; suffixes with more labels than any rule has are left out."""
    if not host or not path:
        return []
    labels = host.rsplit(".", most_labels)[-most_labels:] if most_labels else []
    prefixes = [path[:n] for n in path_lengths if n <= len(path)]
    return [".".join(labels[i:]) + prefix for i in range(len(labels)) for prefix in prefixes]


def _shared_file(spark: SparkSession, rules: list[tuple[str, str]]) -> str:
    """Hand the array to every executor as one of the application's files; its name there."""
    data = digest_file(rules)
    if len(data) > LARGEST_FILE:
        raise ValueError(f"{len(data)} bytes of rules; use judged_by_join for more than {LARGEST_FILE}")
    shared = Scratch(spark).folder("rules")  # fetched by executors at any time until the application ends
    path = spark._jvm.org.apache.hadoop.fs.Path(shared)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(data))
    stream.close()
    spark.sparkContext.addFile(shared)
    return shared.rsplit("/", 1)[1]


def judged(pages: DataFrame, rules: list[tuple[str, str]] = RULES, otherwise: str = OTHERWISE) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and gets
    ``otherwise``; a url without a path fits no rule, as no path starts with ``/``; repeated rows are judged one
    by one; an empty table gives no rows; columns other than page_id and url are ignored.
    """
    name = _shared_file(pages.sparkSession, rules)

    @F.pandas_udf("rule string, verdict string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        stored = _array(name)
        for hosts, paths in batches:
            row_of: list[int] = []
            wanted: list[bytes] = []
            for row, (host, path) in enumerate(zip(hosts, paths)):
                for candidate in candidates_of(host, path, stored.path_lengths, stored.most_labels):
                    row_of.append(row)
                    wanted.append(candidate.encode())
            best: dict[int, tuple] = {}
            for row, index in zip(row_of, stored.find(wanted).tolist()):
                if index >= 0:
                    rule, blocks = stored.rule(index).decode(), bool(stored.blocks[index])
                    rank = (-len(rule), not blocks, rule)
                    if row not in best or rank < best[row]:
                        best[row] = rank
            yield pd.DataFrame({
                "rule": [best[r][2] if r in best else None for r in range(len(hosts))],
                "verdict": [("allow" if best[r][1] else "block") if r in best else otherwise for r in range(len(hosts))],
            })

    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    return split.withColumn("_found", judge("host", "path")).select("page_id", "host", "path", "_found.rule", "_found.verdict")


def judged_by_join(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """``judged`` for a rule table (verdict, rule) that no executor could hold: candidates meet rules in a join.

    Pages are reduced to distinct (host, path) pairs first, so a common host costs its distinct paths.
    """
    one = rules.groupBy("rule").agg(F.max(F.col("verdict") == "block").alias("_blocks"))
    lengths = sorted(r[0] for r in one.select(F.length(F.regexp_extract("rule", "/.*", 0)).alias("n")).distinct().collect())
    most = one.agg(F.coalesce(F.max(F.size(F.split(F.substring_index("rule", "/", 1), r"\."))), F.lit(0))).first()[0]
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    pairs = split.select("host", "path").distinct().where((F.col("host") != "") & (F.col("path") != ""))
    labels = F.split(F.substring_index("host", ".", -max(most, 1)), r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    asked = pairs.select("host", "path", F.explode(suffixes).alias("_suffix")).select(
        "host", "path", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("_n"), "_suffix"
    ).where(F.col("_n") <= F.length("path")).select(
        "host", "path", F.concat("_suffix", F.expr("left(path, _n)")).alias("rule")
    )
    rank = F.struct((-F.length("rule")).alias("n"), (~F.col("_blocks")).alias("allows"), F.col("rule").alias("r"))
    found = asked.join(one, "rule").groupBy("host", "path").agg(F.min(rank).alias("_best"))
    return split.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("_best.r").alias("rule"),
        F.when(F.col("_best").isNull(), F.lit(otherwise)).otherwise(F.when(F.col("_best.allows"), "allow").otherwise("block")).alias("verdict"),
    )


#: The same rules in SQL, for tables of any size: one row per page.
SQL = r"""
WITH split AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path
  FROM split
), rules(verdict, rule, h, p) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
         ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
), fits AS (
  SELECT page_id, host, path, rule, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule) DESC) AS place
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM fits WHERE place = 1"""
