"""URL filters: rules on hosts and paths, held in a Bloom filter cascade.

A rule without `/` fits its hosts whatever the path.  A rule `host/path` fits a url whose host is the rule's host or one of its subdomains and whose path starts
with the rule's path; the longest fitting rule decides (ties: the longer host, then block), and a url that no
rule fits is allowed.  So a url is judged by looking up its candidate keys, every suffix of its host with
every path prefix as long as some rule's path, among the listed keys.

The lookup is a cascade per verdict: level 0 is a Bloom filter of the listed keys; level 1 of those keys of
the corpus that level 0 takes wrongly; level 2 of the listed keys that level 1 takes; and so on until no
key is taken wrongly.  Over the corpus's complete key universe membership is then exact, and no url is
joined with the list.  The filters are built from distributed bit sets; a level has at most
`bits_per_key` bits a key, and the whole cascade is broadcast only if it is under `max_bytes`
(otherwise a ValueError says so: the list must then be split by host hash).

Null url, or one without `://`: empty host and path, allowed.  Repeated rows: one result each.  Empty
tables: an empty result; no rules: all allowed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.llm.shared import written

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), *_LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Suffixes of the host with prefixes of the path: strings `host` + `path prefix`."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    return F.flatten(F.transform(suffixes, lambda s: F.array_compact(F.array(*[F.concat(s, p) for p in prefixes])))) if lengths else F.array().cast("array<string>")


@dataclass
class Bloom:
    bits: np.ndarray
    hashes: int
    first: int  # number of its first hash function; no two levels share one, else the same keys could collide for ever

    def has(self, x: np.ndarray) -> np.ndarray:
        size = np.uint64(len(self.bits) * 8)
        out = np.ones(len(x), bool)
        for i in range(self.hashes):
            at = positions(x, self.first + i, size)
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def positions(x: np.ndarray, i: int, size) -> np.ndarray:
    y = (x ^ np.uint64(0xA24BAED4963EE407 * (i + 1) % 2**64)) * np.uint64(0x9FB21C651E98DF25)
    y ^= y >> np.uint64(28)
    y *= np.uint64(0x9E3779B97F4A7C15)
    return ((y >> np.uint64(11)) % size).astype(np.int64)


def filter_bytes(count: int, bits_per_key: int) -> int:
    return max(8, count * bits_per_key // 8)


def _bloom(keys: DataFrame, count: int, bits_per_key: int, level: int, chunk: int = 1 << 16, keys_per_task: int = 1 << 20) -> Bloom:
    """A filter of the column `key` (64-bit hashes): tasks mark bit sets, whose chunks are or-ed where they meet."""
    n_bytes = filter_bytes(count, bits_per_key)
    hashes = max(1, round(bits_per_key * 0.7))

    def marked(batches):
        bits = np.zeros(n_bytes, np.uint8)
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(hashes):
                at = positions(x, level * hashes + i, np.uint64(n_bytes * 8))
                np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        for start in range(0, n_bytes, chunk):
            if (part := bits[start : start + chunk]).any():
                yield pa.RecordBatch.from_pydict({"start": pa.array([start], pa.int64()), "bits": pa.array([part.tobytes()], pa.binary())})

    def merged(table: pa.Table) -> pa.Table:
        rows = table["bits"].to_pylist()
        bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in rows])
        return pa.table({"start": table["start"][:1], "bits": pa.array([bits.tobytes()], pa.binary())})

    parts = keys.select("key").repartition(max(1, count // keys_per_task)).mapInArrow(marked, "start long, bits binary")
    bits = np.zeros(n_bytes, np.uint8)
    for row in parts.groupBy("start").applyInArrow(merged, "start long, bits binary").collect():
        bits[row.start : row.start + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return Bloom(bits, hashes, level * hashes)


@dataclass
class Cascade:
    levels: list[Bloom] = field(default_factory=list)

    @property
    def n_bytes(self) -> int:
        return sum(len(x.bits) for x in self.levels)

    def has(self, x: np.ndarray) -> np.ndarray:
        """A key is listed if the first level that refuses it is an odd one."""
        out, open_ = np.zeros(len(x), bool), np.ones(len(x), bool)
        for i, level in enumerate(self.levels):
            taken = np.zeros(len(x), bool)
            taken[open_] = level.has(x[open_])
            out[open_ & ~taken] = i % 2 == 1
            open_ &= taken
        out[open_] = len(self.levels) % 2 == 1
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = 8, max_bytes: int = 64 << 20) -> Cascade:
    """Both have a column `key` of 64-bit hashes; the universe is every key that will be asked for."""
    inside = written(listed.select("key").distinct(), "listed")
    outside, first = universe.select("key"), inside
    cascade = Cascade()
    while True:
        count = inside.count()
        if not count:
            return cascade
        if (wanted := cascade.n_bytes + filter_bytes(count, bits_per_key)) > max_bytes:
            raise ValueError(f"the cascade has {wanted} bytes; at most {max_bytes} are sent to the executors")
        cascade.levels.append(_bloom(inside, count, bits_per_key, len(cascade.levels)))
        last = cascade.levels[-1]

        def taken(batches, last=last):
            for b in batches:
                yield b.filter(pa.array(last.has(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))

        found = outside.mapInArrow(taken, "key long")
        if len(cascade.levels) == 1:  # the universe is only filtered; what the first level takes is told apart and cleared of the listed keys
            found = found.distinct().join(first, "key", "left_anti")
        inside, outside = written(found, "taken"), inside


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, `host/path`) pairs as rows: verdict, rule, key."""
    df = spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")
    return df.withColumn("key", F.xxhash64("rule"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col="page_id", url_col="url", bits_per_key=8, max_bytes=64 << 20) -> DataFrame:
    """id, host, path, rule, verdict; a row for each row.  `rules`: verdict (allow or block), rule."""
    rules = rules.where("rule is not null").withColumn("key", F.xxhash64("rule"))
    at = F.instr("rule", "/")
    lengths = sorted(r[0] for r in rules.select(F.when(at > 0, F.length("rule") - at + 1).otherwise(0)).distinct().collect())
    urls = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = urls.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    universe = urls.select(F.explode("keys").alias("text")).select(F.xxhash64("text").alias("key"))
    block, allow = (build_cascade(rules.where(F.col("verdict") == v), universe, bits_per_key, max_bytes) for v in ("block", "allow"))

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def judged(keys: pa.Array, hashes: pa.Array) -> pa.Array:
        ends = hashes.offsets.to_numpy()
        flat = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
        blocks, allows = block.has(flat), allow.has(flat)
        texts = keys.values.to_pylist()
        rows = []
        for start, end in zip(ends[:-1], ends[1:]):
            fits = [(len(texts[i]), (texts[i] + "/").index("/"), blocks[i], i) for i in range(start, end) if blocks[i] or allows[i]]
            best = max(fits, default=None)
            rows.append((texts[best[3]], "block" if best[2] else "allow") if best else (None, "allow"))
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["rule", "verdict"])

    hashed = F.transform("keys", lambda k: F.xxhash64(k))
    return urls.select(id_col, "host", "path", judged("keys", hashed).alias("j")).select(id_col, "host", "path", "j.rule", "j.verdict")
