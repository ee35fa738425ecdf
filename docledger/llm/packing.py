"""Best-fit packing: documents into sequences of at most `length` tokens, by swap-based local search.

A document is its token ids and then one end id; only longer ones are cut, into pieces of exactly
`length` tokens and a last piece that may be shorter.  Pieces are dealt at random into groups of about
`group_size`, each one bounded task.  In a group the pieces first fill bins in the order they arrive.  The local
search then takes the emptiest bin again and again and empties it into the other underfull bins: it moves a piece
into the tightest room there is, or else exchanges one piece for one, or two for one, so that the other bin becomes as
full as can be.  Each step makes the sum of squared fills grow, as the bin that gets more is the fuller one.  Bins by
room, and bins by the largest piece that could take the place of one of theirs, are indexed by size, so a step
looks at all underfull bins and none is left out.  It ends when no bin can be emptied further, or when there are
as few bins as the tokens need.

Null text: empty; empty text: the end id alone.  Repeated rows: packed each.  Null ids: packed, with a
null id.  Empty tables: an empty result.
"""

from __future__ import annotations

import heapq
import json
import math
import os
import zlib
from codecs import charmap_decode

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.shared import give_back, written

_loaded: dict = {}


#: The make of tokenizer whose ids may be looked up run by run (`_Ids`); any other one encodes whole texts.
_MAKE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "end_of_word_suffix": "</w>",
}


def _make(tokenizer) -> dict:
    told = json.loads(tokenizer.to_str())
    own = {k: told.get(k) for k in ("normalizer", "pre_tokenizer", "post_processor")}
    special = all(t["content"].startswith("<|") for t in told.get("added_tokens", []))
    return {**own, "end_of_word_suffix": told["model"].get("end_of_word_suffix") if special else None}


class _Whole:
    """The ids of whole texts, by any tokenizer."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def of(self, texts: pa.Array) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]


def _byte_letters() -> str:
    """The letter that stands for each byte in a vocabulary of bytes; a space stays what parts words."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    letters = [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]
    letters[0x20] = " "
    return "".join(letters)


def _laid(ids: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `ids` that begin there, one behind the other."""
    kind = np.int32 if sizes.sum(dtype=np.int64) < 2**31 and len(ids) < 2**31 else np.int64
    ends = np.cumsum(sizes, dtype=kind)
    return ids[np.repeat(begins.astype(kind) - ends + sizes.astype(kind), sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=kind)]


class _Ids:
    """A run of non-space characters -> its ids; runs that recur are remembered up to a bound.

    The tokenizer drops white space, lower-cases, and merges within runs of letters, so a text's ids are its
    runs' ids in turn, in either case, and punctuation behind a Latin letter stands for itself.
    New runs of letters are encoded many at a time and parted behind the ids that end a word; in small Latin letters
    no step before the merges changes them, so the merges alone encode those.  Most runs of a large text table occur
    once, so only those that a batch has twice are remembered.  Runs are told apart by Arrow and their ids laid out
    by NumPy, without a Python object for each.
    """

    #: ASCII characters that are no letter, digit, space, apostrophe or part of a special token.
    TAIL = "!\"#$%&()*+,-./:;=?@[]^_`{}~"
    #: Letters up to U+00FF at an end, and runs of small ones alone; all of them are composed already.
    LATIN_END, SMALL_LATIN = "[A-Za-zÀ-ÖØ-öø-ÿ]$", "^[a-zß-öø-ÿ]+$"
    BYTES = _byte_letters()

    def __init__(self, tokenizer, bound: int = 150_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.bound = tokenizer, bound
        self.merges = Tokenizer(tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self._forget()
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _forget(self) -> None:
        self.known, self.ids, self.sizes = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def of(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        plain = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))  # special tokens heed the case
        lists = pc.ascii_split_whitespace(plain)
        coded = lists.flatten().dictionary_encode()
        runs, which = coded.dictionary.cast(pa.string()), coded.indices.to_numpy(zero_copy_only=False)
        ids, begins, sizes, fresh = self._found(runs, self._learned)
        more = fresh & (np.bincount(which, minlength=len(runs)) > 1)
        if len(self.known) > self.bound:
            self._forget()
        self.known = pa.concat_arrays([self.known, runs.filter(pa.array(more))])
        self.ids = np.concatenate([self.ids, _laid(ids, begins[more], sizes[more])])
        self.sizes = np.concatenate([self.sizes, sizes[more]])
        n = sizes[which]
        line = _laid(ids, begins[which], n)
        at = np.r_[0, np.cumsum(n)][lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return [line[i:j].tobytes() for i, j in zip(at[:-1].tolist(), at[1:].tolist())]

    def _found(self, runs: pa.Array, make) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where in them those of each run begin, how many they are, and which runs weren't remembered; `make` has the ids and sizes of these."""
        at = pc.fill_null(pc.index_in(runs, value_set=self.known), -1).to_numpy(zero_copy_only=False)
        fresh = at < 0
        ids, made = make(runs.filter(pa.array(fresh)))
        begins, sizes = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        begins[~fresh], sizes[~fresh] = (np.cumsum(self.sizes) - self.sizes)[at[~fresh]], self.sizes[at[~fresh]]
        begins[fresh], sizes[fresh] = len(self.ids) + np.cumsum(made) - made, made
        return np.concatenate([self.ids, ids]), begins, sizes, fresh

    def _learned(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the runs in turn and how many each has; what they are made of is encoded once."""
        trimmed = pc.ascii_rtrim(runs, characters=self.TAIL)
        closed = pc.and_(pc.less(pc.binary_length(trimmed), pc.binary_length(runs)), pc.match_substring_regex(trimmed, self.LATIN_END))
        cores = pc.if_else(closed, trimmed, runs)
        parts = pa.concat_arrays([cores, self._behind(runs.filter(closed), trimmed.filter(closed))]).dictionary_encode()
        ids, begins, sizes, _ = self._found(parts.dictionary, self._encoded)
        which = parts.indices.to_numpy(zero_copy_only=False)
        of = np.full((len(runs), 2), -1)
        of[:, 0] = which[: len(runs)]
        of[closed.to_numpy(zero_copy_only=False), 1] = which[len(runs) :]
        n = np.where(of < 0, 0, sizes[of])
        return _laid(ids, begins[of].ravel(), n.ravel()), n.sum(axis=1)

    @staticmethod
    def _behind(runs: pa.Array, cores: pa.Array) -> pa.Array:
        """What stands in each run behind its core."""
        if not len(runs):
            return runs
        sizes = (pc.binary_length(runs).to_numpy() - pc.binary_length(cores).to_numpy()).astype(np.int64)
        _, offsets, data = runs.buffers()
        ends = np.frombuffer(offsets, np.int32)[runs.offset + 1 : runs.offset + len(runs) + 1]
        tails = _laid(np.frombuffer(data, np.uint8), ends - sizes, sizes)
        return pa.StringArray.from_buffers(len(runs), pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.py_buffer(tails))

    def _encoded(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts in turn and how many each has."""
        small = pc.match_substring_regex(parts, self.SMALL_LATIN)
        found = self._small(parts.filter(small))
        if found is None:  # a vocabulary without some byte
            small, found = pa.array(np.zeros(len(parts), bool)), (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        small = small.to_numpy(zero_copy_only=False)
        others: list = [None] * (len(parts) - int(small.sum()))
        self._each_kind([r.decode("utf-8", "replace") for r in parts.filter(pa.array(~small)).cast(pa.binary()).to_pylist()], others)
        sizes = np.zeros(len(parts), np.int64)
        sizes[small], sizes[~small] = found[1], np.fromiter(map(len, others), np.int64, len(others))
        begins = np.zeros(len(parts), np.int64)
        begins[small], begins[~small] = np.cumsum(found[1]) - found[1], len(found[0]) + np.cumsum(sizes[~small]) - sizes[~small]
        return _laid(np.concatenate([found[0], *others]).astype("<u4"), begins, sizes), sizes

    def _small(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """The same of runs of small Latin letters, if each has an id that ends it."""
        cuts = pa.array(np.r_[np.arange(0, len(words), 2000), len(words)], pa.int32())
        ids = [np.zeros(0, "<u4")]
        for line in pc.binary_join(pa.ListArray.from_arrays(cuts, words.cast(pa.binary())), b" ").to_pylist():
            ids.append(np.array(self.merges.encode_batch_fast([charmap_decode(line, "strict", self.BYTES)[0]], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(ids)
        ends = np.flatnonzero(self.ends[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else None

    def _each_kind(self, texts: list[str], found: list) -> None:
        # NFC may join letters only within a run, so runs of letters may share one call.
        words = [i for i, t in enumerate(texts) if t.isalpha()]
        for start in range(0, len(words), 2000):
            part = words[start : start + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([texts[i] for i in part])], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(part):  # a letter of no letter class in the tokenizer's tables: one by one
                self._each(part, texts, found)
                continue
            for i, own in zip(part, np.split(ids, cut[:-1])):
                found[i] = own
        self._each([i for i, t in enumerate(texts) if not t.isalpha()], texts, found)

    def _each(self, chosen: list[int], texts: list[str], found: list) -> None:
        for start in range(0, len(chosen), 2000):
            part = chosen[start : start + 2000]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)):
                found[i] = np.array(e.ids, "<u4")


def _ids(path: str) -> _Ids | _Whole:
    if path not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _loaded[path] = _Ids(tokenizer) if _make(tokenizer) == _MAKE else _Whole(tokenizer)
    return _loaded[path]


def tokenized(documents: DataFrame, tokenizer: str, length: int, id_col="doc_id", text_col="text", with_ids=False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, salt (and ids, if asked for): a row for each piece.

    `tokenizer` is the path of a tokenizers file that every node has.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"] + ["ids"] * with_ids
    kinds = [None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches):
        ids, salt = _ids(tokenizer), 0
        for b in batches:
            for at in range(0, b.num_rows, 1500):
                rows: list[tuple] = []
                for key, blob in zip(b.column(0).slice(at, 1500).to_pylist(), ids.of(b.column(1).slice(at, 1500))):
                    blob += b"\0\0\0\0"
                    for piece, start in enumerate(range(0, len(blob), 4 * length)):
                        part = blob[start : start + 4 * length]
                        salt += 1
                        rows.append((key, piece, start // 4, len(part) // 4, zlib.crc32(part), salt, part if with_ids else None))
                kinds[0] = b.schema.field(0).type
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names)
        give_back()

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, salt long" + ", ids binary" * with_ids
    return documents.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(cut, schema)


class _Sizes:
    """Bins by a size: the sizes that have any are the bits of a number, so the next one up is found at once."""

    def __init__(self, most: int):
        self.bins: list[dict[int, None]] = [{} for _ in range(most + 1)]
        self.bits = 0

    def add(self, size: int, b: int) -> None:
        self.bins[size][b] = None
        self.bits |= 1 << size

    def drop(self, size: int, b: int) -> None:
        del self.bins[size][b]
        if not self.bins[size]:
            self.bits &= ~(1 << size)

    def up(self, least: int):
        """The sizes from `least` on that have bins, in order."""
        bits = self.bits >> least
        while bits:
            step = (bits & -bits).bit_length() - 1
            least += step
            yield least
            least, bits = least + 1, bits >> (step + 1)


class Bins:
    """Bins of one group: lists of (length, piece), with room for `length` tokens each."""

    def __init__(self, length: int, items: list[list[tuple[int, int]]] | None = None):
        self.length = length
        self.items = items or []
        self.fill = [sum(x[0] for x in b) for b in self.items]
        self.rooms = _Sizes(length)  # underfull bins by their room
        self.reach = _Sizes(length)  # and by room + a piece's length: a piece of up to that length can take its place

    def in_order(self, pieces: list[tuple[int, int]]) -> None:
        """The first bins: each piece goes into the last one, or else opens the next."""
        for piece in pieces:
            if not self.items or self.fill[-1] + piece[0] > self.length:
                self.items.append([])
                self.fill.append(0)
            self.items[-1].append(piece)
            self.fill[-1] += piece[0]

    def _listed(self, b: int, add: bool) -> None:
        room = self.length - self.fill[b]
        if room and self.items[b]:
            (self.rooms.add if add else self.rooms.drop)(room, b)
            for size in {x[0] for x in self.items[b]}:
                (self.reach.add if add else self.reach.drop)(room + size, b)

    def _exchange(self, source: int, out: list, target: int, back: list) -> None:
        """Pieces `out` of the source for pieces `back` of the target; the source isn't listed meanwhile."""
        self._listed(target, False)
        for a, b, moved in ((source, target, out), (target, source, back)):
            for x in moved:
                self.items[a].remove(x)
                self.items[b].append(x)
                self.fill[a] -= x[0]
                self.fill[b] += x[0]
        self._listed(target, True)

    def _move(self, source: int) -> bool:
        for x in sorted(self.items[source], reverse=True):
            room = next(self.rooms.up(x[0]), self.length)
            if self.length - room + x[0] > self.fill[source]:
                self._exchange(source, [x], next(iter(self.rooms.bins[room])), [])
                return True
        return False

    def _swap(self, source: int, give: list[tuple[int, int]]) -> bool:
        """The pieces for one of another bin that leaves that bin as full as can be, and fuller than this one was."""
        size, widest = sum(x[0] for x in give), self.rooms.bits.bit_length() - 1
        for reach in self.reach.up(size):
            if reach - size >= widest:
                return False
            # A bin of room r is left with reach - size, and gains r - (reach - size).
            room, target = max((self.length - self.fill[b], -b) for b in self.reach.bins[reach])
            if room > reach - size and self.length - (reach - size) > self.fill[source]:
                back = next(x for x in self.items[-target] if x[0] == reach - room)
                self._exchange(source, give, -target, [back])
                return True
        return False

    def _step(self, source: int) -> bool:
        if self._move(source):
            return True
        one = sorted({x[0]: x for x in self.items[source]}.values(), reverse=True)
        if any(self._swap(source, [x]) for x in one):
            return True
        mine = sorted(self.items[source], reverse=True)
        pairs = {a[0] + b[0]: [a, b] for i, a in enumerate(mine) for b in mine[i + 1 :] if a[0] + b[0] <= self.length}
        return any(self._swap(source, pairs[size]) for size in sorted(pairs, reverse=True))

    def improve(self) -> None:
        """Empty the emptiest bins into the rooms of the others."""
        least = -(-sum(self.fill) // self.length)
        count = sum(map(bool, self.items))
        for b in range(len(self.items)):
            self._listed(b, True)
        changed = True
        while changed and count > least:
            changed = False
            queue = [(f, b) for b, f in enumerate(self.fill) if 0 < f < self.length]
            heapq.heapify(queue)
            while queue and count > least:
                fill, source = heapq.heappop(queue)
                if fill != self.fill[source]:  # fuller by now
                    if fill < self.fill[source] < self.length:
                        heapq.heappush(queue, (self.fill[source], source))
                    continue
                self._listed(source, False)
                while self.items[source] and self._step(source):
                    changed = True
                count -= not self.items[source]
                self._listed(source, True)
        for b in range(len(self.items)):
            self._listed(b, False)


def pack_lengths(lengths: list[int], length: int) -> list[list[int]]:
    """Bins of positions in `lengths`."""
    bins = Bins(length)
    bins.in_order([(n, i) for i, n in enumerate(lengths)])
    bins.improve()
    return [[i for _, i in b] for b in bins.items if b]


def pack(pieces: DataFrame, length: int, group_size: int = 50_000, group_ids: int = 8 << 20) -> DataFrame:
    """The pieces with sequence_id and offset; a group that carries ids has at most about `group_ids` of them."""
    pieces = written(pieces, "pieces")
    if "ids" in pieces.columns:
        group_size = min(group_size, max(1, group_ids // length))
    groups = max(1, math.ceil(pieces.count() / group_size))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(groups)))
    names = [c for c in pieces.columns if c != "salt"]

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending"), ("salt", "ascending")])
        lengths, base = table["length"].to_pylist(), table["group"][0].as_py() << 32
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for s, members in enumerate(pack_lengths(lengths, length)):
            at = 0
            for i in members:
                sequence[i], offset[i] = base + s, at
                at += lengths[i]
        return table.select(names).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    schema = pieces.select(names).schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("group").applyInArrow(packed, schema)


def pack_documents(documents: DataFrame, tokenizer: str, length: int = 2048, id_col="doc_id", text_col="text", with_ids=False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for)."""
    out = pack(tokenized(documents, tokenizer, length, id_col, text_col, with_ids), length)
    return out.withColumnRenamed("doc_id", id_col)
