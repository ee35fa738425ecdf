"""LM scoring: a weighted backoff automaton, counted over the corpus and walked by every text.

States are the contexts: the empty one, and every n-gram shorter than `order` that training has.  An arc
(state, word) exists for every n-gram that training has; it carries the n-gram's smoothed log-probability
and leads to the state of the longest suffix that is a context.  A state's failure arc leads to the context
without its first word and carries the mass left there.  One walk from left to right carries the state from
token to token: while the state has no arc for the token, the failure weight is added and the state falls
back; then the arc's weight is added and its target is the next state.

With Dirichlet smoothing of strength s_m, p_m(w | h) = (c(hw) + s_m p_{m-1}(w | h')) / (c(h) + s_m), so the
failure weight is s_m / (c(h) + s_m), and in every state the probabilities of the V known tokens and of one
class for all others sum to 1; the empty state is (c(w) + 1) / (N + V + 1).

All lanes of a bundle walk at once.  A long text is walked in stretches of `STRETCH` tokens; a stretch first
reads the order - 1 tokens before it from the empty state, which leads to the very state the whole walk has
there, as a state never knows more than that many tokens.

Scale: the automaton is never gathered in one place.  Each task tokenises its texts, in the order they come, and packs
them into bundles of about `bundle_chars` bytes of text, written once to the shared folder (equal rows and ids are nothing special).
A bundle counts its own n-grams and deals them out by ranges of their hashes; the rest of each n-gram's total
goes back to the bundles that hold it, in the order they sent it, with the number of training tokens and of
distinct ones of that range.  The bundles lie in buckets, so only the totals travel; a bundle then builds the part of the automaton that its texts can reach.  A frequent
n-gram is one entry a bundle, so no key is hot; nothing is broadcast or collected.  Hashes are as wide as a
chance of about 2^-20 that an n-gram meets another one needs: the width follows from the number of tokens.
The rows dealt grow with the square of the number of bundles, so a corpus of many terabytes wants larger executors
and larger `bundle_chars`.  A shuffle has at most `max_partitions` partitions, one bundle in memory at a time.

Tokens: words lower-cased (A-Z), then one end, which is also the start context.  Null text: empty, one
token.  Texts in the held-out fold are scored but not counted.  Repeated rows: scored and counted each.
Null ids: fold of the empty text.  Empty tables: an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.shared import fold_of, give_back, mixed, text_bytes, tokenised, written_in_buckets

#: Not the hash of any word, as words hold no white space.
END = np.uint64(0x5DEECE66D1234567)
#: Tokens that a lane walks.
STRETCH = 256
_BUNDLES = "bundle long, tokens long, docs binary, words binary, codes binary"
_COUNTS = "target int, bundle long, keys binary, counts binary"
_MORE = "target int, bundle long, more binary, tokens long, distinct long"
_SCORES = "doc_id {id}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _squeezed(x: np.ndarray) -> bytes:
    """Numbers as planes of bytes, only as many as the largest needs, which leaves runs of zeros to the compressor."""
    n = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(np.asarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :n].T)
    return bytes([n]) + zstandard.ZstdCompressor(1).compress(planes.tobytes())


def _expanded(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : b[0]] = planes.T
    return out.view("<u8").ravel()


# ---- bundles ---------------------------------------------------------------------------------------------------


def _halves(table: pa.Table) -> list[pa.Table]:
    size = np.cumsum(pc.binary_length(table["text"]).to_numpy())
    cut = int(np.searchsorted(size, size[-1] / 2)) + 1
    return [x for x in (table.slice(0, cut), table.slice(cut)) if len(x)]


def _bundle_row(table: pa.Table, number: int) -> pa.RecordBatch:
    words, codes, sizes = tokenised(table["text"].combine_chunks())
    docs = pa.table([table["doc_id"], table["held_out"], pa.array(sizes)], names=["doc_id", "held_out", "words"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(docs)
    values = [number, len(codes) + len(table), sink.getvalue().to_pybytes(), zstandard.ZstdCompressor(3).compress(b" ".join(words)), _squeezed(codes)]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds)], ["bundle", "tokens", "docs", "words", "codes"])


def bundles(texts: DataFrame, bundle_chars: int, buckets: int) -> DataFrame:
    """The rows in bundles, tokenised once: bundle, tokens, docs (an Arrow stream), words, codes; one row each."""

    def pack(batches):
        number = (TaskContext.get().partitionId() << 32) - 1
        full: pa.Table | None = None  # waits, so that a small rest can share with it
        open_, held = [], 0
        for b in batches:
            ends = np.cumsum(pc.binary_length(b.column("text")).to_numpy())
            at = 0
            while at < b.num_rows:
                before = ends[at - 1] if at else 0
                to = min(b.num_rows, int(np.searchsorted(ends, before + bundle_chars - held)) + 1)
                open_.append(b.slice(at, to - at))
                held += int(ends[to - 1] - before)
                at = to
                if held >= bundle_chars:
                    if full is not None:
                        yield _bundle_row(full, number := number + 1)
                    full, open_, held = pa.Table.from_batches(open_).combine_chunks(), [], 0
        rest = [] if full is None else [full]
        if open_:
            rest.append(pa.Table.from_batches(open_))
        if len(rest) == 2:
            rest = _halves(pa.concat_tables(rest).combine_chunks())
        for table in rest:
            yield _bundle_row(table.combine_chunks(), number := number + 1)
        give_back()

    return written_in_buckets(texts.mapInArrow(pack, _BUNDLES), "bundles", "bundle", buckets)


# ---- n-grams of a bundle ---------------------------------------------------------------------------------------


@dataclass
class Grams:
    """The n-grams of a bundle's texts, one text after another, each behind one END, its start.

    `word` has each position's token number, `at[m]` the number of the distinct (m+1)-gram that ends there
    (-1: none), `keys[m]` its hash; `context[m]`, `last[m]` and `suffix[m]` are the numbers of its context (an
    m-gram), of its last token, and of the m-gram without its first token.
    """

    starts: np.ndarray
    sizes: np.ndarray  # tokens, END counted and the start not
    word: np.ndarray
    at: list[np.ndarray]
    keys: list[np.ndarray]
    context: list[np.ndarray]
    last: list[np.ndarray]
    suffix: list[np.ndarray]


def grams(words: list[bytes], codes: np.ndarray, counts: np.ndarray, order: int) -> Grams:
    """From the distinct words, the word numbers of the texts in turn, and the texts' word counts."""
    sizes = counts.astype(np.int64) + 1
    starts = np.cumsum(sizes + 1) - sizes - 1
    word = np.full(int((sizes + 1).sum()), len(words), np.int32)
    inner = np.ones(len(word), bool)
    inner[starts] = inner[starts + sizes] = False
    word[inner] = codes
    at = word.copy()
    at[starts] = -1
    none, v = np.zeros(0, np.int32), len(words) + 1
    distinct = np.r_[np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), END]
    out = Grams(starts, sizes, word, [at], [distinct], [none], [none], [none])
    for m in range(1, order):
        before = np.full(len(word), -1, np.int32)
        before[1:] = word[:-1] if m == 1 else out.at[m - 1][:-1]
        before[starts] = -1
        there = np.flatnonzero(before >= 0)
        codes, which = np.unique(before[there].astype(np.int64) * v + word[there], return_inverse=True)
        context, last = codes // v, codes % v
        at = np.full(len(word), -1, np.int32)
        at[there] = which
        suffix = np.zeros(len(codes), np.int32)
        suffix[which] = out.at[m - 1][there]
        out.at.append(at)
        out.keys.append(mixed(out.keys[m - 1][context], distinct[last]))
        out.context.append(context)
        out.last.append(last)
        out.suffix.append(suffix)
    return out


def _grams_of(row: pa.Table | pa.RecordBatch, order: int) -> tuple[pa.Table, Grams]:
    """The documents of a bundle's only row, and their n-grams."""
    docs, words, codes = (row[c].combine_chunks() if isinstance(row[c], pa.ChunkedArray) else row[c] for c in ("docs", "words", "codes"))
    docs = pa.ipc.open_stream(docs[0].as_buffer()).read_all()
    words = zstandard.ZstdDecompressor().decompress(words[0].as_py()).split()
    return docs, grams(words, _expanded(codes[0].as_py()).astype(np.int32), docs["words"].to_numpy(), order)


def _own_counts(g: Grams, train: np.ndarray) -> np.ndarray:
    """Training counts in this bundle of all its n-grams, order after order (0: held-out texts only)."""
    counted = np.repeat(train, g.sizes + 1)
    return np.concatenate([np.bincount(at[counted & (at >= 0)], minlength=len(k)) for at, k in zip(g.at, g.keys)])


# ---- dealing -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Deal:
    """Hashes of `width` bits in `targets` ranges; the lowest bit tells tokens (1) from longer n-grams."""

    width: int
    targets: int

    @classmethod
    def of(cls, tokens: int, order: int, targets: int) -> Deal:
        return cls(min(64, (order * tokens + 1).bit_length() + 21), targets)

    def sorted(self, g: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams' hashes in order, the numbers of those n-grams, and where each target's range begins."""
        keys = np.concatenate(g.keys) >> np.uint64(64 - self.width)
        token = np.arange(len(keys)) < len(g.keys[0])
        keys = np.where(token, keys | np.uint64(1), keys & ~np.uint64(1))
        order = np.argsort(keys)
        keys = keys[order]
        edges = np.array([self.begin(t) for t in range(self.targets)], np.uint64)
        return keys, order, np.r_[np.searchsorted(keys, edges), len(keys)]

    def begin(self, target: int) -> int:
        return target * 2**self.width // self.targets


# ---- the automaton -------------------------------------------------------------------------------------------------


@dataclass
class Automaton:
    """State 0 is the empty context; then come those of one token, of two, and so on, by n-gram number.

    Arcs of state 0 are `root_weight` and `root_target` by token; all others are rows of `arc`, `weight` and
    `target`, in order of arc = state * tokens + token.  `fail` and `fail_weight` are the failure arcs.
    """

    tokens: int
    root_weight: np.ndarray
    root_target: np.ndarray
    arc: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    fail: np.ndarray
    fail_weight: np.ndarray

    @classmethod
    def build(cls, g: Grams, counts: list[np.ndarray], n_tokens: int, n_distinct: int, strengths: tuple[float, ...]) -> Automaton:
        """`counts`: training counts of the n-grams of each order; `strengths`: of orders 2, 3, ..."""
        order, v = len(counts), len(g.keys[0])
        first = np.cumsum([1, *[len(c) for c in counts[:-1]]])  # the state of the first m-gram, m = 1 ..
        p = (counts[0] + 1.0) / (n_tokens + n_distinct + 1.0)
        root_weight = np.log10(p)
        root_target = np.where((counts[0] > 0) & (order > 1), 1 + np.arange(v), 0)
        arcs, weights, targets, fails, fail_weights = [], [], [], [np.zeros(1, np.int64)], [np.zeros(1)]
        for m in range(1, order):
            s, held = strengths[m - 1], counts[m - 1]
            fails.append(first[m - 2] + g.suffix[m - 1] if m > 1 else np.zeros(v, np.int64))
            fail_weights.append(np.log10(s / (held + s)))
            p = (counts[m] + s * p[g.suffix[m]]) / (held[g.context[m]] + s)
            seen = np.flatnonzero(counts[m] > 0)
            arcs.append((first[m - 1] + g.context[m][seen]) * v + g.last[m][seen])  # in order, as n-grams are numbered so
            weights.append(np.log10(p[seen]))
            targets.append(first[m] + seen if m + 1 < order else first[m - 1] + g.suffix[m][seen])
        none = [np.zeros(0, np.int64)]
        return cls(v, root_weight, root_target, np.concatenate(arcs or none), np.concatenate(weights or none), np.concatenate(targets or none), np.concatenate(fails), np.concatenate(fail_weights))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log-probabilities of the tokens in those states, and the next states."""
        total, after = np.zeros(len(state)), np.zeros(len(state), np.int64)
        state, open_ = state.copy(), np.flatnonzero(state)
        while len(open_):
            asked = state[open_] * self.tokens + word[open_]
            at = np.minimum(np.searchsorted(self.arc, asked), len(self.arc) - 1)
            hit = self.arc[at] == asked if len(self.arc) else np.zeros(len(open_), bool)
            found, at, missed = open_[hit], at[hit], open_[~hit]
            total[found] += self.weight[at]
            after[found] = self.target[at]
            state[found] = -1  # done
            total[missed] += self.fail_weight[state[missed]]
            state[missed] = self.fail[state[missed]]
            open_ = missed[state[missed] > 0]
        root = np.flatnonzero(state == 0)
        total[root] += self.root_weight[word[root]]
        after[root] = self.root_target[word[root]]
        return total, after

    def walk(self, g: Grams, order: int, stretch: int = STRETCH) -> np.ndarray:
        """The log10 probability of each text."""
        lanes = -(-g.sizes // stretch)
        text = np.repeat(np.arange(len(g.sizes)), lanes)
        begin = (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * stretch
        length = np.minimum(stretch, g.sizes[text] - begin)
        longest = np.argsort(-length, kind="stable")
        text, begin, length = text[longest], begin[longest], length[longest]
        place = g.starts[text] + 1 + begin
        state, total = np.zeros(len(text), np.int64), np.zeros(len(text))
        for back in range(order - 1, 0, -1):  # the tokens before the stretch, the start of the text at most
            there = np.flatnonzero(begin + 1 >= back)
            _, state[there] = self.step(state[there], g.word[place[there] - back])
        for t in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -t))  # lanes longer than t
            gained, state[:live] = self.step(state[:live], g.word[place[:live] + t])
            total[:live] += gained
        return np.bincount(text, weights=total, minlength=len(g.sizes))


# ---- the corpus ------------------------------------------------------------------------------------------------------


def score_corpus(documents: DataFrame, id_col="doc_id", text_col="text", folds=7, held_out_fold=2, order=3, strengths=(2000.0, 10.0), bundle_chars=8 << 20, max_partitions=32_768) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score; a row for each row."""
    texts = documents.select(F.col(id_col).alias("doc_id"), (fold_of(id_col, folds) == held_out_fold).alias("held_out"), text_bytes(text_col).alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n_parts = min(4 * math.ceil(chars / bundle_chars + 1), max_partitions)
    packed = bundles(texts, bundle_chars, n_parts)
    sums = packed.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")).first()
    n_bundles = max(1, sums.n)
    deal = Deal.of(sums.tokens or 0, order, n_bundles)

    def count(batches):
        for b in batches:
            for row in range(b.num_rows):
                docs, g = _grams_of(b.slice(row, 1), order)
                counts = _own_counts(g, ~docs["held_out"].to_numpy().astype(bool))
                keys, numbers, edges = deal.sorted(g)
                counts = counts[numbers]
                out = []
                for t in range(deal.targets):
                    at = slice(edges[t], edges[t + 1])
                    out.append((_squeezed(np.diff(keys[at], prepend=np.uint64(deal.begin(t)))), _squeezed(counts[at])))
                kinds = [pa.array(range(deal.targets), pa.int32()), pa.array(b.column("bundle").slice(row, 1).to_pylist() * deal.targets, pa.int64())]
                yield pa.RecordBatch.from_arrays([*kinds, pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())], ["target", "bundle", "keys", "counts"])
        give_back()

    def total(table: pa.Table) -> pa.Table:
        target = table["target"][0].as_py()
        keys = [np.cumsum(np.r_[np.uint64(deal.begin(target)), _expanded(k)], dtype=np.uint64)[1:] for k in table["keys"].to_pylist()]
        counts = [_expanded(c).astype(np.int64) for c in table["counts"].to_pylist()]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        token = (distinct & np.uint64(1) == 1) & (sums > 0)
        more, start = [], 0
        for k, c in zip(keys, counts):
            more.append(_squeezed(sums[at[start : start + len(k)]] - c))
            start += len(k)
        n = len(more)
        return pa.table({"target": pa.array([target] * n, pa.int32()), "bundle": table["bundle"], "more": pa.array(more, pa.binary()), "tokens": pa.array([int(sums[token].sum())] * n, pa.int64()), "distinct": pa.array([int(token.sum())] * n, pa.int64())})

    def run(own: pa.Table, back: pa.Table) -> pa.Table:
        docs, g = _grams_of(own, order)
        held = docs["held_out"].to_numpy().astype(bool)
        counts = _own_counts(g, ~held)
        _, numbers, edges = deal.sorted(g)
        for target, more in zip(back["target"].to_pylist(), back["more"].to_pylist()):
            counts[numbers[edges[target] : edges[target + 1]]] += _expanded(more).astype(np.int64)
        tokens, distinct = pc.sum(back["tokens"]).as_py(), pc.sum(back["distinct"]).as_py()
        each = np.split(counts, np.cumsum([len(k) for k in g.keys])[:-1])
        machine = Automaton.build(g, each, tokens, distinct, strengths)
        score = machine.walk(g, order)
        there = g.at[0] >= 0
        text = np.repeat(np.arange(len(g.sizes)), g.sizes)
        word = g.word[there]
        known = np.bincount(text, weights=each[0][word] > 0, minlength=len(held)).astype(np.int64)
        base = np.bincount(text, weights=machine.root_weight[word], minlength=len(held))
        return pa.table([docs["doc_id"], docs["held_out"], pa.array(g.sizes), pa.array(known), pa.array([tokens] * len(held), pa.int64()), pa.array(base), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    counted = packed.mapInArrow(count, _COUNTS)
    totals = counted.repartition(n_parts, "target").groupBy("target").applyInArrow(total, _MORE)
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = packed.groupBy("bundle").cogroup(totals.groupBy("bundle")).applyInArrow(run, _SCORES.format(id=kind))
    return scored.withColumnRenamed("doc_id", id_col)
