"""Language-model scores from an Elias-Fano n-gram trie that is dealt over shards."""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END, START = 0, 1
KEY_BITS = 40
BLOCK_BYTES = 1 << 24
QUANTUM = 4096.0


class EliasFano:
    """A non-decreasing sequence of numbers below 2^63 in about 2 + log2(range / n) bits each.

    The low bits lie in one array, the high bits in unary in another; select is
    by counts of set bits before each word.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        top = int(values[-1]) if n else 0
        self.n, self.bits = n, max(0, (top // max(1, n)).bit_length())
        self.low = (values & ((1 << self.bits) - 1)).astype(np.uint32 if self.bits <= 32 else np.uint64)
        high = values >> self.bits
        at = high + np.arange(n)
        self.buckets = int(high[-1]) + 1 if n else 0
        self.words = np.zeros((n + self.buckets) // 64 + 1, dtype=np.uint64)
        np.bitwise_or.at(self.words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))

    def open(self) -> EliasFano:
        """Counts for select; they are made when a level is opened and not stored."""
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.ones = np.concatenate(([0], np.cumsum(ones)))
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        return self

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Place of the kth one (or zero) of the high bits, from 0."""
        before = self.ones if bit else self.zeros
        word = np.searchsorted(before, k, "right") - 1
        left = (k - before[word]).astype(np.int64)
        bits = np.asarray(self.words)[np.minimum(word, len(self.words) - 1)]
        if not bit:
            bits = ~bits
        place = np.zeros(len(left), dtype=np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count((bits >> place) & np.uint64((1 << width) - 1)).astype(np.int64)
            go = left >= count
            left -= np.where(go, count, 0)
            place += np.where(go, np.uint64(width), np.uint64(0))
        return word * 64 + place.astype(np.int64)

    def get(self, k: np.ndarray) -> np.ndarray:
        return ((self.select(k, 1) - k) << self.bits) | np.asarray(self.low)[k].astype(np.int64)

    def find(self, x: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """Index of ``x`` (the successor search stops at its bucket of high bits), or -1; within [lo, hi) if given."""
        high = x >> self.bits
        inside = (high < self.buckets) & (x >= 0)
        bucket = np.where(inside, high, 0)
        first = np.where(bucket > 0, self.select(np.maximum(bucket - 1, 0), 0) - bucket + 1, 0)
        last = np.where(bucket + 1 < self.buckets, self.select(np.minimum(bucket, max(0, self.buckets - 1)), 0) - bucket, self.n)
        if lo is not None:
            first, last = np.maximum(first, lo), np.minimum(last, hi)
        want, low = x & ((1 << self.bits) - 1), np.asarray(self.low)
        a, b = first.copy(), np.maximum(first, last)
        while (open_ := np.flatnonzero(a < b)).size:
            mid = (a[open_] + b[open_]) // 2
            less = low[mid].astype(np.int64) < want[open_]
            a[open_] = np.where(less, mid + 1, a[open_])
            b[open_] = np.where(less, b[open_], mid)
        hit = inside & (a < last)
        hit[hit] = low[a[hit]].astype(np.int64) == want[hit]
        return np.where(hit, a, -1)


class Trie:
    """Contexts, pointers to their successors, successors, and a quantised value for each.

    Successors ascend within a context; the level adds up the spans of the
    contexts before, so that it ascends as a whole, and a search only looks at
    the range that the context's pointers give.  Levels are written to a file
    and memory-mapped.
    """

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, counts: np.ndarray):
        """Pairs sorted by context, then successor, each once."""
        begin = np.flatnonzero(np.diff(contexts, prepend=-1))
        self.contexts = EliasFano(contexts[begin])
        self.pointers = EliasFano(np.append(begin, len(contexts)))
        ends = np.append(begin[1:], len(contexts)) - 1
        spans = successors[ends] + 1 if len(begin) else np.empty(0, np.int64)
        bases = np.cumsum(spans) - spans
        self.bases = EliasFano(bases)
        self.successors = EliasFano(successors + np.repeat(bases, np.diff(np.append(begin, len(contexts)))))
        # 0 is kept for what the trie does not hold
        self.values = (1 + np.rint(np.log10(np.maximum(counts, 1)) * QUANTUM)).astype(np.uint16)
        self.levels = (self.contexts, self.pointers, self.bases, self.successors)

    def mapped(self) -> Trie:
        """Move all levels to one file of this task, mapped read-only; the file's name goes at once."""
        handle, path = tempfile.mkstemp(prefix="trie-")
        with os.fdopen(handle, "wb") as file:
            places = []
            for level in self.levels:
                for name in ("words", "low"):
                    array = getattr(level, name)
                    file.write(b"\0" * (-file.tell() % 8))
                    places.append((level, name, file.tell(), array.dtype, len(array)))
                    file.write(array.tobytes())
            file.write(b"\0" * (-file.tell() % 8))
            places.append((self, "values", file.tell(), self.values.dtype, len(self.values)))
            file.write(self.values.tobytes())
        for owner, name, at, kind, n in places:
            setattr(owner, name, np.memmap(path, kind, "r", at, n) if n else np.empty(0, kind))
        os.unlink(path)
        for level in self.levels:
            level.open()
        return self

    def find(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Quantised value of each pair; 0 for pairs that the trie does not hold."""
        out = np.zeros(len(contexts), dtype=np.uint16)
        if not self.contexts.n or not len(contexts):
            return out
        new = np.flatnonzero(np.diff(contexts, prepend=-1))  # queries come sorted: each context is searched once
        where = self.contexts.find(contexts[new])
        known = np.flatnonzero(where >= 0)
        lo, hi, base = (np.full(len(new), -1) for _ in range(3))
        lo[known], hi[known], base[known] = self.pointers.get(where[known]), self.pointers.get(where[known] + 1), self.bases.get(where[known])
        runs = np.diff(np.append(new, len(contexts)))
        lo, hi, base = (np.repeat(x, runs) for x in (lo, hi, base))
        ask = np.flatnonzero(lo >= 0)
        found = self.successors.find(successors[ask] + base[ask], lo[ask], hi[ask])
        hit = found >= 0
        out[ask[hit]] = np.asarray(self.values)[found[hit]]
        return out


def counts_of(values: np.ndarray) -> np.ndarray:
    return np.where(values > 0, 10 ** ((values.astype(np.float64) - 1) / QUANTUM), 0.0)


def back_off(count: np.ndarray) -> np.ndarray:
    """Weight of the unigram level after a context seen ``count`` times."""
    return np.where(count > 0, np.maximum(0.3, 1 / (1 + np.log10(1 + np.maximum(count, 0)))), 1.0)


class Words(dict):
    """Numbers of words in order of their first use; END is there already, START is left out."""

    def __init__(self):
        super().__init__({b"": END})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def _pack(array: np.ndarray) -> bytes:
    """Planes of bytes, compressed."""
    raw = np.ascontiguousarray(array)
    if not len(raw):
        return b""
    return zstandard.ZstdCompressor(level=3).compress(raw.view(np.uint8).reshape(len(raw), -1).T.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    if not data:
        return np.empty(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> (KEY_BITS - 24)) * shards) >> 24


def _pairs(seq: np.ndarray, sizes: np.ndarray, shard: np.ndarray, shards: int, start: int):
    """Pairs (context, word) of local numbers, each once and sorted by (shard, context, word).

    Returns contexts, words, shard of each pair, and the pair of every position.
    A pair's shard follows from the shards of its words, and differs for the
    successors of one context, so that no shard gets a frequent context whole.
    """
    before = np.empty_like(seq)
    before[1:] = seq[:-1]
    before[np.cumsum(sizes) - sizes] = start
    code, back = np.unique(before.astype(np.int64) << 32 | seq, return_inverse=True)
    v, w = code >> 32, code & 0xFFFFFFFF
    home = (shard[v] * 7919 + shard[w]) % shards
    order = np.argsort(home, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return v[order], w[order], home[order], rank[back]


FIELDS = [("key", pa.int64()), ("block", pa.int64()), ("shard", pa.int64()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("stats", pa.list_(pa.int64())), *((x, pa.binary()) for x in ("a", "b", "c", "d", "e"))]
SCHEMA = "key long, block long, shard long, docs array<long>, held array<boolean>, sizes array<long>, stats array<long>, a binary, b binary, c binary, d binary, e binary"


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in rows], kind) for name, kind in FIELDS], [name for name, _ in FIELDS])


def _block(number: int, docs: list[tuple], shards: int) -> pa.RecordBatch:
    """The block's own row, and a request to every shard."""
    words = Words()
    seqs = []
    for _, text, _ in docs:
        parts = text.lower().split()
        seq = np.fromiter(map(words.__getitem__, parts), np.int64, len(parts))
        seqs.append(np.append(seq, END))
    names = [b""] * (len(words) + 1)
    for word, n in words.items():
        names[n] = word
    keys = np.fromiter((xxhash.xxh64_intdigest(x) >> (64 - KEY_BITS) for x in names), np.int64, len(names))
    keys[START] = (1 << KEY_BITS) - 1
    # Local numbers in order of keys, START last; so words of a shard are neighbours.
    order = np.append(np.argsort(np.delete(keys, START), kind="stable"), 0)
    order[:-1] += order[:-1] >= START
    order[-1] = START
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    keys = keys[order]
    shard = _shard_of(keys, shards)
    sizes = np.array([len(x) for x in seqs])
    seq = rank[np.concatenate(seqs)]
    train = np.repeat(np.array([not held for *_, held in docs]), sizes)
    counts = np.bincount(seq[train], minlength=len(order)).astype(np.uint32)
    v, w, home, pair = _pairs(seq, sizes, shard, shards, len(order) - 1)
    in_train = np.bincount(pair[train], minlength=len(v)).astype(np.uint32)
    word_ends = np.searchsorted(shard[:-1], np.arange(shards + 1))
    pair_ends = np.searchsorted(home, np.arange(shards + 1))
    rows = [{"key": -1 - number, "block": number, "docs": [d for d, *_ in docs], "held": [h for *_, h in docs], "sizes": sizes.tolist(), "stats": word_ends.tolist(), "a": _pack(seq.astype(np.uint32))}]
    press = zstandard.ZstdCompressor(level=3)
    for s in range(shards):
        i, j = slice(word_ends[s], word_ends[s + 1]), slice(pair_ends[s], pair_ends[s + 1])
        pv = keys[v[j]]
        begin = np.flatnonzero(np.diff(pv, prepend=-1))
        rows.append({
            "key": s, "block": number, "shard": s,
            "a": press.compress(b"\n".join(names[k] for k in order[i])), "b": _pack(counts[i]),
            "c": _pack(np.diff(pv[begin], prepend=0)), "d": _pack(np.diff(np.append(begin, len(pv))).astype(np.uint32)), "e": _pack(np.stack((keys[w[j]] & 0xFFFFFFFF, in_train[j].astype(np.int64)), axis=1).astype(np.uint32)),
        })
    return _rows(rows)


def _shard(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Build one shard of the model from the training counts of all blocks and answer their requests."""
    if key[0].as_py() < 0:
        return t.select([name for name, _ in FIELDS])
    rows = t.sort_by("block").to_pylist()
    expand = zstandard.ZstdDecompressor().decompress
    total: dict[bytes, int] = {}
    asked = []
    for r in rows:
        counts = _unpack(r["b"], np.uint32).tolist()
        words = expand(r["a"]).split(b"\n") if counts else []
        asked.append(words)
        for word, n in zip(words, counts, strict=True):
            total[word] = total.get(word, 0) + n
    known = np.fromiter(total.values(), np.int64, len(total))
    stats = [int(known.sum()), int((known > 0).sum()), int((known == 1).sum()), int((known == 2).sum())]
    contexts, successors, counts, sizes = [], [], [], []
    for r in rows:
        pairs = _unpack(r["e"], np.uint64).view(np.uint32).reshape(-1, 2)
        contexts.append(np.repeat(np.cumsum(_unpack(r["c"], np.int64)), _unpack(r["d"], np.uint32)))
        successors.append(pairs[:, 0].astype(np.int64))
        counts.append(pairs[:, 1].astype(np.int64))
        sizes.append(len(pairs))
    v, w, n = (np.concatenate(x) for x in (contexts, successors, counts))
    order = np.lexsort((w, v))
    new = np.empty(len(order), dtype=bool)
    if len(order):
        new[0] = True
        new[1:] = (np.diff(v[order]) != 0) | (np.diff(w[order]) != 0)
    at = np.flatnonzero(new)
    uv, uw = v[order][at], w[order][at]
    seen = np.add.reduceat(n[order], at) if len(at) else np.empty(0, np.int64)
    trie = Trie(uv[seen > 0], uw[seen > 0], seen[seen > 0]).mapped()
    answers = np.empty(len(order), dtype=np.uint16)
    answers[order] = trie.find(uv, uw)[np.cumsum(new) - 1] if len(at) else answers
    out, begin = [], 0
    for r, words, size in zip(rows, asked, sizes, strict=True):
        c = np.fromiter(map(total.__getitem__, words), np.int64, len(words))
        out.append({"key": -1 - r["block"], "block": r["block"], "shard": r["shard"], "stats": stats, "a": _pack(c), "b": _pack(answers[begin : begin + size])})
        begin += size
    return pa.Table.from_batches([_rows(out)])


def _score(shards: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        """Put the answers of all shards together and score the block's documents."""
        rows = t.to_pylist()
        own = next(r for r in rows if r["shard"] is None)
        answers = sorted((r for r in rows if r["shard"] is not None), key=lambda r: r["shard"])
        total, types, once, twice = np.array([r["stats"] for r in answers]).sum(axis=0).tolist()
        seq, sizes = _unpack(own["a"], np.uint32).astype(np.int64), np.array(own["sizes"])
        counts = np.concatenate([_unpack(r["a"], np.int64) for r in answers])
        start = len(counts)
        shard = np.append(np.repeat(np.arange(shards), np.diff(own["stats"])), shards - 1)
        v, w, _, pair = _pairs(seq, sizes, shard, shards, start)
        joint = counts_of(np.concatenate([_unpack(r["b"], np.uint16) for r in answers]))
        discount = min(0.95, once / (once + 2 * twice)) if once else 0.5
        # Ends and starts occur once in each training text; the end is the empty word, whose number is known by its key.
        end = seq[sizes.sum() - 1]
        counts = np.append(counts, counts[end])
        unknown = discount * types / total if total else 1.0
        single = np.where(counts > 0, (counts - discount) / max(1, total), unknown)
        weight = back_off(counts[v])
        chance = (1 - weight) * joint / np.maximum(counts[v], 1) + weight * single[w]
        ends = np.cumsum(sizes)
        add = lambda x: np.add.reduceat(x, ends - sizes)
        log = np.log10(chance)[pair]
        flat = np.log10((counts[seq] + 0.1) / (total + 0.1 * (types + 1)))
        out = {"doc_id": own["docs"], "held_out": own["held"], "n_tokens": sizes, "n_known": add((counts[seq] > 0).astype(np.int64)), "train_tokens": np.full(len(sizes), total), "base_score": add(flat), "score": add(log)}
        return pa.table(out)

    return run


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Score whole texts under a bigram model learned from the rows that are not held out.

    A row is held out if crc32 of its id as text is 0 modulo 10.  Tokens are
    lower-cased (A-Z) words and one end.  One row per input row: ``doc_id``,
    ``held_out``, ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (add-0.1 unigrams) and ``score``, the log10
    probability of the text.

    Model: p(w | v) = (1 - b) c(vw) / c(v) + b p(w), where b falls with c(v)
    from 0.77 to 0.3, and p(w) discounts counts absolutely (the discount comes
    from the numbers of words seen once and twice) and gives what that frees to
    one unknown word.  Probabilities sum to one over the words seen and the
    unknown word.

    No part of the model is ever whole in one place.  A block is about 16 MB of
    text.  It asks every shard for the words and pairs that hash there, with its
    training counts of them; the shard adds up the counts of all blocks, builds
    its part of the trie, memory-maps it, looks the requests up, and answers the
    block.  A pair's shard depends on both words, so the successors of a
    frequent word spread over all shards, and a block names a pair once however
    often it occurs.  Two shuffles carry it all; both grow in proportion to the
    text.  Words are counted by their bytes; pairs go by hashes of 36 to 40
    bits for each word.  ``shards``: twice the partitions of the input by default.

    A null or empty text is the end alone.  Rows that repeat an id are texts of
    their own.  Rows with a null id are left out.  An empty table gives an empty
    result; without training rows the model knows only the unknown word.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).where("doc_id is not null").select("doc_id", "text", held.alias("held"))
    shards = shards or max(16, min(1 << 17, 2 * rows.rdd.getNumPartitions()))

    def blocks(batches):
        number, docs, size = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs.append(row)
                size += len(row[1])
                if size >= BLOCK_BYTES:
                    yield _block(number, docs, shards)
                    number, docs, size = number + 1, [], 0
        if docs:
            yield _block(number, docs, shards)

    asked = rows.mapInArrow(blocks, SCHEMA)
    answered = asked.groupBy("key").applyInArrow(_shard, SCHEMA)
    return answered.groupBy("key").applyInArrow(_score(shards), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
