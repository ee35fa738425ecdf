"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

Every text's set of word n-grams gets a signature of `DEPTH` minhashes, a byte each, in each of `trees` trees.  A tree
is the prefix trie of its signatures, kept as their sorted list: the signatures, as 64-bit numbers, are sorted by
range over all partitions, and a run of neighbours that share a prefix is a node of the trie.  The matched prefix
starts at the full depth and is shortened, level by level, until the recall measured at the threshold meets the
target: pairs whose sets are just as similar as the threshold asks, of the sizes that the corpus has, are made and
signed, and the rate at which a tree lets them meet at that level tells how many are missed by all trees.
Texts that share a prefix of the matched length in some tree are tied together, and the tied texts (connected
components) are the candidates.  Each group of candidates is verified exactly on its whole n-gram sets, in blocks of
bounded size against each other, so that no task holds an unbounded group and no pairs are emitted: a block yields,
for each text, its number of links and its class so far.  A group that is split costs the square of its number of blocks,
as the count of its links may.

Equal texts (same words) are one node with a number of copies until the end, so copies are never paired.  Words:
white-space separated, lower-cased (A-Z).  A text of fewer than n words is one short n-gram.  Null or empty text, or
null id: in no class (class_id is its own id), no links.  Ids needn't be unique: nodes are texts, a row is classed by
its text, and a row's links count rows; a class is named by the smallest id in it.  Empty tables: an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.llm.shared import give_back, text_bytes, tokenised, written
from docledger.operators.components import components

#: Minhashes of a signature; at a byte each a signature is one 64-bit number.
DEPTH = 8


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """The 64-bit hashes of the words of each text (UTF-8), in turn."""
    words, codes, counts = tokenised(texts)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[codes]
    return np.split(hashes, np.cumsum(counts)[:-1]) if len(counts) else []


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of words, the words given by their hashes."""
    if not len(h):
        return np.zeros(0, np.uint64)
    n = min(n, len(h))
    x = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        x = (x ^ h[i : len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(31)
    return np.unique(x)


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (rng.integers(1, 2**32, count, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None], rng.integers(0, 2**32, count, dtype=np.uint64).astype(np.uint32)[:, None]


def minhashes(x: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The least hash of the set by each function."""
    out = np.full(len(mult), np.uint32(2**32 - 1))
    x = (x >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), 1024):
        out = np.minimum(out, (mult * x[None, start : start + 1024] + add).min(1))
    return out


def signatures(least: np.ndarray) -> np.ndarray:
    """Of the least hashes, a 64-bit number a tree; the first minhash is its highest byte."""
    return (least * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).view(">i8").astype(np.int64)


def shared_levels(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes two signatures share."""
    differ = (a ^ b).view(np.uint64)
    return sum((differ >> np.uint64(64 - 8 * level) == 0).astype(np.int64) for level in range(1, DEPTH)) + (differ == 0)


def planted_levels(sizes: list[int], threshold: float, trees: int, seed: int = 11) -> np.ndarray:
    """The levels shared, in each tree, by pairs of sets as similar as the threshold asks or a little less; one pair a size.

    Sets have 200 elements at least, so that the similarity comes close to the threshold.
    """
    rng, (mult, add) = np.random.default_rng(seed), _seeds(trees * DEPTH)
    out = []
    for n in sizes:
        n = max(n, 200)
        apart = math.ceil(n * (1 - threshold) / (1 + threshold) - 1e-9)
        x = rng.integers(0, 2**64, n + apart, dtype=np.uint64)
        parts = [minhashes(p, mult, add) for p in (x[:apart], x[apart:n], x[n:])]
        out.append(shared_levels(signatures(np.minimum(parts[0], parts[1])), signatures(np.minimum(parts[1], parts[2]))))
    return np.array(out, np.int64).reshape(-1, trees)


def prefix_length(levels: np.ndarray, recall: float) -> int:
    """The matched prefix: from the full depth down, shortened until the measured recall meets the target."""
    for length in range(DEPTH, 1, -1):
        met = (levels >= length).mean(0)  # of each tree
        if 1 - np.prod(1 - met) >= recall:
            return length
    return 1


def signed(documents: DataFrame, n: int, trees: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, mark (a hash of the text), key (of its words), size (n-grams), signatures (one a tree)."""
    kind = documents.schema[id_col].dataType.simpleString()
    mult, add = _seeds(trees * DEPTH)

    def sign(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                b = whole.slice(start, 500)
                keys, sizes, found = [], [], [np.zeros(0, np.int64)]
                for h in word_hashes(b.column(2)):
                    x = shingles(h, n)
                    keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                    sizes.append(len(x))
                    found.append(signatures(minhashes(x, mult, add)) if len(x) else found[0])
                ends = np.cumsum([len(p) for p in found]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found), pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), lists], ["doc_id", "mark", "key", "size", "signatures"])
        give_back()

    docs = documents.select(F.col(id_col), F.xxhash64(text_bytes(text_col)).alias("mark"), text_bytes(text_col))
    return docs.mapInArrow(sign, f"doc_id {kind}, mark long, key binary, size int, signatures array<long>")


def forest_ties(nodes: DataFrame, length: int) -> DataFrame:
    """a, b: nodes that share a prefix of that length in some tree, each tied to the first of its run."""
    leaves = nodes.select("node", F.posexplode("signatures").alias("tree", "signature"))
    forest = leaves.repartitionByRange("tree", "signature", "node").sortWithinPartitions("tree", "signature", "node")
    shift = np.uint64(64 - 8 * length)

    def runs(batches):
        part, last, first = TaskContext.get().partitionId(), None, None  # tree, prefix and head of the run so far
        for b in batches:
            if not b.num_rows:
                continue
            node, tree = b.column("node").to_numpy(), b.column("tree").to_numpy().astype(np.int64)
            prefix = (b.column("signature").to_numpy().view(np.uint64) >> shift).view(np.int64)
            opens = np.r_[last is None or (tree[0], prefix[0]) != last[:2], (tree[1:] != tree[:-1]) | (prefix[1:] != prefix[:-1])]
            at = np.maximum.accumulate(np.where(opens, np.arange(len(node)), -1))
            heads = np.where(at >= 0, node[at], last[2] if last else 0)
            first = first or (int(tree[0]), int(prefix[0]), int(node[0]))
            last = (int(tree[-1]), int(prefix[-1]), int(heads[-1]))
            tied = ~opens
            none = pa.nulls(int(tied.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(heads[tied]), none, none, none], ["a", "b", "place", "tree", "prefix"])
        for place, end in ((0, first), (1, last)):  # a run may go on in the next partition
            if end:
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (end[2], None, 2 * part + place, end[0], end[1])], ["a", "b", "place", "tree", "prefix"])

    found = written(forest.mapInArrow(runs, "a long, b long, place long, tree long, prefix long"), "ties")
    before = Window.orderBy("place")  # two rows a partition
    ends = found.where("place is not null").select("a", "tree", "prefix", F.lag("a").over(before).alias("b"), F.lag("tree").over(before).alias("t"), F.lag("prefix").over(before).alias("p"))
    return found.where("place is null").select("a", "b").unionAll(ends.where("t = tree and p = prefix and a <> b").select("a", "b"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """|x & y| for every x of left and y of right, as a matrix; only n-grams on both sides are laid out."""
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    if left is right:
        values, counts = np.unique(np.concatenate(left), return_counts=True)
        both = values[counts > 1]
    at = [[np.searchsorted(both, x[np.isin(x, both, assume_unique=True)]) for x in side] for side in (left, right)]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(both), 8192):
        width = min(8192, len(both) - start)
        mats = []
        for side in at[: 1 if left is right else 2]:
            m = np.zeros((len(side), width), np.float32)
            for i, x in enumerate(side):
                lo, hi = np.searchsorted(x, (start, start + width))
                m[i, x[lo:hi] - start] = 1
            mats.append(m)
        out += mats[0] @ mats[-1].T
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs have a Jaccard similarity of at least the threshold."""
    inter = overlaps(left, right).astype(np.float64)
    if left is right:
        np.fill_diagonal(inter, [len(x) for x in left])
    sizes = [np.array([len(x) for x in side], float) for side in (left, right)]
    return inter + 1e-9 >= threshold * (sizes[0][:, None] + sizes[1][None, :] - inter)


def _roots(near: np.ndarray) -> np.ndarray:
    """The first position of each position's component."""
    root = np.arange(len(near))
    while True:
        new = np.where(near, root[None, :], len(near)).min(1)
        new = np.minimum(new, root)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verified(candidates: DataFrame, n: int, threshold: float) -> DataFrame:
    """node, links, root: of each block, a text's links there and the smallest text it is tied to."""

    def verify(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        table = table.sort_by([("cluster", "ascending"), ("side", "ascending"), ("node", "ascending")]).combine_chunks()
        texts, rows = table["text"], table.drop_columns(["text"]).to_pylist()
        start = 0
        while start < len(rows):
            end = start
            while end < len(rows) and rows[end]["cluster"] == rows[start]["cluster"]:
                end += 1
            part = rows[start:end]
            sets = [shingles(h, n) for h in word_hashes(texts.slice(start, end - start).combine_chunks())]
            start = end
            copies = np.array([r["copies"] for r in part], np.int64)
            cut = next((i for i, r in enumerate(part) if r["side"] != part[0]["side"]), len(part))
            near = np.zeros((len(part), len(part)), bool)
            if cut < len(part):  # two blocks of a large group against each other
                near[:cut, cut:] = linked(sets[:cut], sets[cut:], threshold)
                near[cut:, :cut] = near[:cut, cut:].T
            elif part[0]["a"] == part[0]["b"]:
                near = linked(sets, sets, threshold)
            np.fill_diagonal(near, False)
            links, roots = near @ copies, _roots(near | np.eye(len(part), dtype=bool))
            out += [(r["node"], int(k), part[i]["node"]) for r, k, i in zip(part, links, roots)]
        cols = list(zip(*out)) or [(), (), ()]
        give_back()
        return pa.table({name: pa.array(col, pa.int64()) for name, col in zip(("node", "links", "root"), cols)})

    return candidates.groupBy("task").applyInArrow(verify, "node long, links long, root long")


def _classed(documents: DataFrame, id_col: str, text_col: str, n: int, threshold: float, trees: int, recall: float, block: int, grams: int, planted: int) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and of every key that two rows or more share or that is linked: key, head (the
    class's smallest id with the mark of its text) and n_links."""
    rows = written(signed(documents, n, trees, id_col, text_col), "signed")
    known = rows.where("key is not null and doc_id is not null")
    texts = known.groupBy("key").agg(F.min(F.struct("doc_id", "mark")).alias("own"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("signatures").alias("signatures"))
    nodes = written(texts.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sizes = [r.size for r in nodes.orderBy(F.xxhash64("key"), "key").limit(planted).select("size").collect()]  # at most `planted` numbers
    length = prefix_length(planted_levels(sizes, threshold, trees), recall) if sizes else DEPTH
    groups = components(forest_ties(nodes, length)).withColumnRenamed("root", "cluster")
    tied = written(nodes.drop("signatures").join(groups, "node"), "tied")
    # A group of more than `block` texts, or of `grams` n-grams, is dealt into blocks, and every two blocks meet in a task of their own.
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("size") / grams)).cast("int")
    blocks = tied.groupBy("cluster").agg(parts.alias("blocks"))
    side = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("node"), F.col("blocks"))).otherwise(0).cast("int")
    placed = written(tied.join(blocks, "cluster").select("node", "cluster", "blocks", "copies", side.alias("side"), F.col("own.doc_id").alias("_id"), F.col("own.mark").alias("_mark")), "placed")
    # Always a shuffle of both sides: the tied texts grow with the corpus, so they are never broadcast.
    whole = documents.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("text")).withColumn("_mark", F.xxhash64("text"))
    wanted = whole.join(placed.hint("merge"), ["_id", "_mark"]).groupBy("node", "cluster", "blocks", "copies", "side").agg(F.first("text").alias("text"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    wanted = wanted.select("*", other.alias("other")).withColumns({"a": F.least("side", "other"), "b": F.greatest("side", "other")})
    tasks = max(1, math.ceil((tied.agg(F.sum("size")).first()[0] or 0) / grams))
    # A split group's tasks have a number of their own (negative); the many small ones share tasks.
    task = F.when(F.col("blocks") > 1, -1 - F.pmod(F.xxhash64("cluster", "a", "b"), F.lit(2**62))).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(tasks)))
    found = written(verified(wanted.withColumn("task", task).select("task", "cluster", "side", "a", "b", "node", "copies", "text"), n, threshold), "verified")
    # Classes: the components of the verified links, by each block's spanning ties.
    ties = written(components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))), "classes")
    heads = ties.join(tied.select("node", "own"), "node").groupBy("root").agg(F.min("own").alias("head"))
    linked_nodes = ties.join(heads, "root").select("node", "head")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    several = nodes.select("node", "key", "own", "copies").join(linked_nodes, "node", "left").join(links, "node", "left").where("copies > 1 or head is not null")
    return rows, several.select("key", F.coalesce("head", "own").alias("head"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))


def jaccard_classes(documents: DataFrame, id_col="doc_id", text_col="text", n=5, threshold=0.8, trees=32, recall=0.9999, block=1024, grams=1 << 20, planted=4096) -> DataFrame:
    """id, class_id (the smallest id linked to it, directly or over others), n_links; a row for each row."""
    rows, several = _classed(documents, id_col, text_col, n, threshold, trees, recall, block, grams, planted)
    out = rows.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key")).join(several, "key", "left")
    return out.select(F.col("doc_id").alias(id_col), F.coalesce("head.doc_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(documents: DataFrame, id_col="doc_id", text_col="text", n=5, threshold=0.8, trees=32, recall=0.9999, block=1024, grams=1 << 20, planted=4096) -> DataFrame:
    """The whole rows of one document of each class: the one with the smallest id, and of its texts one.

    Rows of equal id and text count as copies, and one of them stays; other texts of the same id are judged by
    themselves.  Rows without an id or without words stay.
    """
    rows, several = _classed(documents, id_col, text_col, n, threshold, trees, recall, block, grams, planted)
    i, m = (next(x for x in (f"_{c}{k}" for k in range(len(documents.columns) + 1)) if x not in documents.columns) for c in ("id", "mark"))
    mine = rows.where("key is not null and doc_id is not null").select("key", F.col("doc_id").alias(i), F.col("mark").alias(m))
    kept = (F.col("head.doc_id") == F.col(i)) & (F.col("head.mark") == F.col(m))
    judged = mine.join(several, "key").groupBy(i, m).agg(F.max(kept).alias("stays"), F.count(F.lit(1)).alias("n"))
    judged = written(judged.where("not stays or n > 1"), "judged")
    marked = documents.withColumns({i: F.col(id_col), m: F.xxhash64(text_bytes(text_col))})
    plain = marked.join(judged.select(i, m), [i, m], "left_anti")
    repeated = marked.join(judged.where("stays").select(i, m), [i, m], "left_semi").dropDuplicates([i, m])
    return plain.unionByName(repeated).select(*documents.columns)
