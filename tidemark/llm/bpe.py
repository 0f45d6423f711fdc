"""Byte-level BPE encoding and decoding.

A piece's bytes are the leaves of a segment tree that keeps the leftmost least pair rank. A merge takes the
root, joins the two tokens there and writes the new ranks of the live neighbours, each write climbing a
logarithmic number of nodes. Short pieces are merged many at a time: their trees are the rows of one matrix
and each step advances all of them; long pieces have a tree of their own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces of at most 8 * LANES bytes are merged together, longer ones alone.
LANES = 4
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Distinct pieces a worker remembers; beyond it, it starts anew.
MEMORY = 400_000
#: Characters of text cut into pieces at once.
SLICE_CHARS = 1 << 20
_NONE = np.int64(1) << 40
_SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point: 0 white space, 1 letter, 2 number, 3 other."""
    import regex

    out = np.full(0x110000, 3, np.uint8)
    for at, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (0, r"\s+")):
        for low in range(0, 0x110000, 0x10000):
            # surrogates are no characters of a text
            page = "".join(map(chr, range(low, low + 0x10000)))
            for m in regex.finditer(pattern, page):
                out[low + m.start() : low + m.end()] = at
    return out


def split(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the matches of the public pattern in a text, in code points, and the UTF-8 lengths before each code point.

    The pattern: contractions 's 't 're 've 'm 'll 'd; a run of letters, of numbers or of others, each
    with one space before it if there is one; white space, without the last character if more follows.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = np.ones(len(points), np.int64) + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate((np.zeros(1, np.int64), np.cumsum(width)))
    kind = _classes()[points]
    n = len(points)
    cut = np.zeros(n + 1, bool)
    if not n:
        return np.zeros(0, np.int64), at
    cut[0] = True
    cut[1:n] = kind[1:] != kind[:-1]
    runs = np.flatnonzero(cut[:n])
    ends = np.concatenate((runs[1:], [n]))
    space = (kind[runs] == 0) & (ends < n)
    last = ends[space] - 1
    cut[last] = True
    cut[last[points[last] == 32] + 1] = False
    # a contraction needs an apostrophe that starts a piece and is the whole run of others
    quote = np.flatnonzero((points[:-1] == 39) & cut[: n - 1] & (kind[1:] == 1)) if n > 1 else ()
    for q in quote:
        follow = text[q + 1 : q + 3]
        for suffix in _SUFFIXES:
            if follow.startswith(suffix):
                cut[q + 1] = False
                cut[q + 1 + len(suffix)] = True
                break
    return np.flatnonzero(cut[:n]), at


class Ranks:
    """A vocabulary of byte strings by rank, and the rank that each pair of ranks merges to."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.byte = np.full(256, -1, np.int64)
        for k in range(256):
            self.byte[k] = ranks.get(bytes([k]), -1)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        pairs = {
            a * self.size + b: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None
        }
        self.pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        bits = max(16, int(len(keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, _NONE, np.int64)
        left = np.arange(len(keys))
        home = self._slot(keys)
        probes = 0
        while len(left):  # open addressing, all keys a step at a time
            at = (home[left] + probes) & (len(self.slots) - 1)
            free = self.slots[at] < 0
            at_free, who = np.unique(at[free], return_index=True)
            winners = left[free][who]
            self.slots[at_free] = keys[winners]
            self.values[at_free] = [pairs[int(x)] for x in keys[winners]]
            left = np.setdiff1d(left, winners, assume_unique=True)
            probes += 1
        self.probes = probes
        tokens = sorted((r, t) for t, r in ranks.items())
        self.start = np.zeros(self.size + 1, np.int64)
        lengths = np.zeros(self.size, np.int64)
        for r, t in tokens:
            lengths[r] = len(t)
        self.start[1:] = np.cumsum(lengths)
        self.data = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each merged pair, _NONE where there is none."""
        keys = a * self.size + b
        home = self._slot(keys)
        out = np.full(len(keys), _NONE, np.int64)
        left = np.arange(len(keys))
        for k in range(self.probes):
            at = (home[left] + k) & (len(self.slots) - 1)
            held = self.slots[at]
            hit = held == keys[left]
            out[left[hit]] = self.values[at[hit]]
            left = left[~hit & (held >= 0)]
            if not len(left):
                break
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after another."""
        starts, lengths = self.start[ids], self.start[ids + 1] - self.start[ids]
        ends = np.cumsum(lengths)
        index = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
        return self.data[index + np.repeat(starts - (ends - lengths), lengths)]


def merge_many(ranks: Ranks, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of short pieces raw[start : start + size], in their order, their trees advanced together."""
    counts = np.zeros(len(starts), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    depths = np.maximum(1, np.ceil(np.log2(np.maximum(sizes, 2)))).astype(np.int64)
    for depth in np.unique(depths):
        members = np.flatnonzero(depths == depth)
        step = max(64, (1 << 17) >> int(depth))
        for low in range(0, len(members), step):
            part = members[low : low + step]
            ids, own = _merge_matrix(ranks, raw, starts[part], sizes[part], int(depth))
            counts[part] = own
            parts.append((part, ids))
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    for part, ids in parts:
        own = counts[part]
        out[np.arange(len(ids)) + np.repeat(ends[part] - own - (np.cumsum(own) - own), own)] = ids
    return out, counts


def _merge_matrix(ranks: Ranks, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    n, leaves = len(starts), 1 << depth
    place = np.arange(leaves, dtype=np.int64)
    inside = place[None, :] < sizes[:, None]
    #: row * (leaves + 1) + position is a token's place; the place after the last byte holds no token
    wide = leaves + 1
    token = np.full((n, wide), -1, np.int64)
    token[:, :leaves][inside] = ranks.byte[raw[(starts[:, None] + place)[inside]]]
    follow = np.zeros((n, wide), np.int64)
    follow[:, :leaves] = np.minimum(place + 1, sizes[:, None])
    before = np.empty((n, wide), np.int64)
    before[:] = np.arange(-1, leaves)
    #: tree[:, 1] is the root; a node is rank * leaves + position, so that the least is the leftmost least
    limit = int(_NONE) * leaves
    tree = np.full((n, 2 * leaves), limit, np.int64)
    r, c = np.nonzero(place[None, :] < sizes[:, None] - 1)
    tree[r, leaves + c] = np.minimum(ranks.pair(token[r, c], token[r, c + 1]) * leaves + c, limit)
    level = leaves
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    tree, token, follow, before = tree.ravel(), token.ravel(), follow.ravel(), before.ravel()

    def put(base: np.ndarray, at: np.ndarray, value: np.ndarray | int) -> None:
        node = at + leaves
        tree[base + node] = value
        for _ in range(depth):
            node >>= 1
            below = base + 2 * node
            tree[base + node] = np.minimum(tree.take(below), tree.take(below + 1))

    live = np.flatnonzero(tree[1 :: 2 * leaves] < limit)
    while len(live):
        trees, cells, size = live * (2 * leaves), live * wide, sizes[live]
        root = tree.take(trees + 1)
        at, merged = root & (leaves - 1), root >> depth
        right = follow.take(cells + at)
        after = follow.take(cells + right)
        token[cells + at] = merged
        token[cells + right] = -1
        follow[cells + at] = after
        before[cells + after] = at
        prior = before.take(cells + at)
        near = token.take(cells + np.stack((after, np.maximum(prior, 0))))
        value = ranks.pair(np.concatenate((merged, near[1])), np.concatenate((np.maximum(near[0], 0), merged))).reshape(2, -1)
        put(trees, right, limit)
        put(trees, at, np.where(after < size, np.minimum(value[0] * leaves + at, limit), limit))
        some = np.flatnonzero(prior >= 0)
        put(trees[some], prior[some], np.minimum(value[1, some] * leaves + prior[some], limit))
        live = live[tree.take(trees + 1) < limit]
    kept = token.reshape(n, wide) >= 0
    return token[kept.ravel()], kept.sum(axis=1)


def merge_long(ranks: Ranks, word: bytes) -> list[int]:
    """The token ids of one piece of any length, in O(n log n)."""
    n = len(word)
    leaves = 1 << max(1, (n - 1).bit_length())
    token = [int(ranks.byte[b]) for b in word]
    follow, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs, size, none = ranks.pairs, ranks.size, (int(_NONE), 0)
    tree = [none] * (2 * leaves)
    for k in range(n - 1):
        if (rank := pairs.get(token[k] * size + token[k + 1])) is not None:
            tree[leaves + k] = (rank, k)
    for k in range(leaves - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(at: int, value: tuple[int, int]) -> None:
        node = at + leaves
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            least = a if a <= b else b
            if tree[node] == least:
                break
            tree[node] = least
            node >>= 1

    while tree[1] is not none and tree[1][0] < none[0]:
        merged, at = tree[1]
        right = follow[at]
        after = follow[right]
        token[at], token[right], follow[at] = merged, -1, after
        put(right, none)
        if after < n:
            before[after] = at
            rank = pairs.get(merged * size + token[after])
            put(at, none if rank is None else (rank, at))
        else:
            put(at, none)
        if (prior := before[at]) >= 0:
            rank = pairs.get(token[prior] * size + merged)
            put(prior, none if rank is None else (rank, prior))
    return [t for t in token if t >= 0]


class Coder:
    """Encodes texts and decodes ids; remembers a bounded number of pieces.

    A piece of at most 8 * LANES bytes is known by its bytes in LANES words and its length, all pieces of a
    batch being looked up together in a table with open addressing; a longer one is known by its bytes.
    """

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self._forget()

    def _forget(self) -> None:
        self.count = 0
        self.bits = 16
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros((1 << 12, LANES + 1), np.uint64)
        self.hash = np.zeros(1 << 12, np.uint64)
        self.ids = np.empty(1 << 16, np.int32)
        self.filled = 0
        self.ends = np.zeros(1 << 12, np.int64)
        self.long: dict[bytes, int] = {}

    def _room(self, name: str, least: int) -> None:
        held = getattr(self, name)
        if len(held) < least:
            new = np.zeros((max(least, 2 * len(held)), *held.shape[1:]), held.dtype)
            new[: len(held)] = held
            setattr(self, name, new)

    def _insert(self, entries: np.ndarray) -> None:
        """Entries get the first free slots from their homes on."""
        left, step = entries, 0
        while len(left):
            at = ((self.hash[left] >> np.uint64(64 - self.bits)).astype(np.int64) + step) & (len(self.slots) - 1)
            free = np.flatnonzero(self.slots[at] < 0)
            self.slots[at[free]] = left[free]
            left = left[self.slots[at] != left]
            step += 1

    def _find(self, keys: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 for an unknown one."""
        out = np.full(len(keys), -1, np.int64)
        left, at = np.arange(len(keys)), (hashed >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            held = self.slots.take(at)
            used = held >= 0
            same = used & (self.hash.take(np.maximum(held, 0)) == hashed[left])
            where = np.flatnonzero(same)
            exact = (self.keys[held[where]] == keys[left[where]]).all(axis=1)
            out[left[where[exact]]] = held[where[exact]]
            same[where] = exact
            go = np.flatnonzero(used & ~same)
            left, at = left[go], (at[go] + 1) & (len(self.slots) - 1)
        return out

    def _add(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        new = np.arange(self.count, self.count + len(counts))
        self._room("ends", self.count + len(counts) + 1)
        self._room("keys", self.count + len(counts))
        self._room("hash", self.count + len(counts))
        self._room("ids", self.filled + len(ids))
        self.ids[self.filled : self.filled + len(ids)] = ids
        self.ends[new + 1] = self.filled + np.cumsum(counts)
        self.filled += len(ids)
        self.count += len(counts)
        return new

    def _look_up(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The entry of each piece; unknown pieces are merged first."""
        which = np.empty(len(starts), np.int64)
        small = np.flatnonzero(sizes <= 8 * LANES)
        padded = np.concatenate((raw, np.zeros(8 * LANES, np.uint8)))
        words = np.ndarray(len(padded) - 7, np.uint64, padded, strides=(1,))
        keys = np.empty((len(small), LANES + 1), np.uint64)
        own, length = starts[small], sizes[small]
        keys[:, LANES] = length
        with np.errstate(over="ignore"):
            hashed = keys[:, LANES] * np.uint64(0x9E3779B97F4A7C15)
            for k in range(LANES):
                keys[:, k] = words[own + 8 * k] & _MASK[np.clip(length - 8 * k, 0, 8)]
                hashed = (hashed ^ keys[:, k]) * np.uint64(0xD6E8FEB86659FD93)
                hashed ^= hashed >> np.uint64(32)
            hashed *= np.uint64(0x9E3779B97F4A7C15)
        found = self._find(keys, hashed)
        new = np.flatnonzero(found < 0)
        if len(new):
            order = new[np.lexsort((*keys[new].T, hashed[new]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
            first = order[fresh]
            ids, counts = merge_many(self.ranks, raw, own[first], length[first])
            entries = self._add(ids, counts)
            self.keys[entries], self.hash[entries] = keys[first], hashed[first]
            if 3 * self.count > len(self.slots):
                while 3 * self.count > 1 << self.bits:
                    self.bits += 1
                self.slots = np.full(1 << self.bits, -1, np.int32)
                held = np.setdiff1d(np.arange(self.count), np.fromiter(self.long.values(), np.int64, len(self.long)))
                self._insert(held)
            else:
                self._insert(entries)
            found[order] = entries[np.cumsum(fresh) - 1]
        which[small] = found
        for k in np.flatnonzero(sizes > 8 * LANES):
            word = raw[starts[k] : starts[k] + sizes[k]].tobytes()
            if (entry := self.long.get(word)) is None:
                ids = np.array(merge_long(self.ranks, word), np.int32)
                entry = self.long[word] = int(self._add(ids, np.array([len(ids)]))[0])
            which[k] = entry
        return which

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts, one after another; a null is an empty text."""
        if self.count > MEMORY or self.filled > 8 * MEMORY:
            self._forget()
        raws, starts, counts, base = [], [], [], 0
        for text in texts:
            text = text or ""
            own, at = split(text)
            raws.append(text.encode())
            starts.append(at[own] + base)
            counts.append(len(own))
            base += len(raws[-1])
        raw = np.frombuffer(b"".join(raws), np.uint8)
        begin = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        which = self._look_up(raw, begin, np.diff(begin, append=len(raw)))
        first, lengths = self.ends[which], self.ends[which + 1] - self.ends[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total, dtype=np.int64) + np.repeat(first - (ends - lengths), lengths)]
        edges = np.concatenate((np.zeros(1, np.int64), ends))
        return ids, edges[np.concatenate((np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)))]


def load(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(2)
def coder(name: str) -> Coder:
    """The worker's coder of a rank file that was added to the session."""
    return Coder(Ranks(load(SparkFiles.get(name))))


def _shared(df: DataFrame, path: str) -> str:
    df.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row; a null or empty text has no ids, an empty table no results. Texts are
    encoded whole, without special tokens: their strings are ordinary text. Long texts are encoded by slices of their
    pieces; a single piece of many bytes has a tree of its own, of about 100 bytes a byte. Repeated rows are answered
    each; other columns are not read."""
    name = _shared(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(name)
        for batch in batches:
            for part in _parts(batch.column(1), SLICE_CHARS):
                ids, ends = own.encode(batch.column(1).slice(part.start, part.stop - part.start).to_pylist())
                lists = pa.ListArray.from_arrays(ends.astype(np.int32), ids)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, part.stop - part.start), lists], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, bytes) of rows with ids; null ids give no bytes. Ids outside the vocabulary are an error."""
    name = _shared(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = coder(name).ranks
        for batch in batches:
            lists = batch.column(1)
            step = max(1, (1 << 20) * len(lists) // max(1, len(lists.flatten())))
            for low in range(0, len(lists), step):
                part = lists.slice(low, step)
                ids = np.asarray(part.flatten(), np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= ranks.size):
                    raise ValueError("an id is not in the vocabulary")
                counts = np.concatenate(([0], np.cumsum(np.asarray(pa.compute.list_value_length(part).fill_null(0), np.int64))))
                lengths = np.concatenate(([0], np.cumsum(ranks.start[ids + 1] - ranks.start[ids])))
                raw = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(lengths[counts].astype(np.int64)), pa.py_buffer(ranks.decode(ids).tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, step), part, raw.cast(pa.binary())], names=["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, bytes binary")


def _parts(texts: pa.Array, limit: int) -> Iterator[range]:
    from tidemark.llm.textbuf import pieces

    for a, b in pieces(texts, limit):
        yield range(a, b)
