"""Removal of repeated byte strings by a distributed, hash-compared suffix sort."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, save
from .tokens import slices

BASE = 0x9E3779B97F4A7C15 | 1
U64 = (1 << 64) - 1
CHUNK_BITS = 14
PAIRS = 512
HOT_CLASSES = 8192
LONG_WORD = 16


@lru_cache(maxsize=4)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2^64, and of its inverse."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.empty(size, dtype=np.uint64)
        p[0], filled = 1, 1
        while filled < size:
            n = min(filled, size - filled)
            p[filled : filled + n] = p[:n] * np.uint64(pow(base, filled, 1 << 64))
            filled += n
        out.append(p)
    return out[0], out[1]


class PrefixHashes:
    """Polynomial hashes of all prefixes; the hash of any substring takes two look-ups."""

    def __init__(self, data: np.ndarray):
        self.data = data
        size = 1 << max(10, int(len(data)).bit_length())
        self.power, self.inverse = powers(size)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the strings at ``a`` and ``b``, by binary search on hashes."""
        found = np.zeros(len(a), dtype=np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            longer = found + step
            ok = longer <= most
            if ok.any():
                at = np.flatnonzero(ok)
                same = self.of(a[at] + found[at], np.full(len(at), step)) == self.of(b[at] + found[at], np.full(len(at), step))
                found[at[same]] += step
            step >>= 1
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(texts: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of texts: number of the text, position, hash.

    Of every window of ``length`` items, the string of a third of that length
    with the least hash in it (the last such) is an anchor.  The choice depends
    on the window alone, so equal windows have equal anchors at equal places.
    About one position in 130 is an anchor for windows of 400.

    Texts are taken one after the other in chunks that fit the cache; windows
    that reach from one into the next don't count.
    """
    gram = max(1, length // 3)
    span = length - gram + 1
    data = np.concatenate(texts) if texts else np.empty(0, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    grams = len(data) - gram + 1
    chunk = max(1 << CHUNK_BITS, 1 << (2 * span).bit_length())
    picked, found, mask = [], [], np.uint64(chunk - 1)
    inside = np.repeat(ends - length, sizes) >= np.arange(len(data))
    for start in range(0, max(0, grams - span + 1), chunk - span + 1):
        stop = min(grams, start + chunk)
        windows, width = stop - start - span + 1, 1
        whole = np.flatnonzero(inside[start : start + windows])
        if not len(whole):
            continue
        part = PrefixHashes(data[start : stop + gram - 1])
        h = _mixed((part.sums[gram:] - part.sums[:-gram]) * part.inverse[: stop - start])
        key = (h & ~mask) | (mask - np.arange(stop - start, dtype=np.uint64))
        while width * 2 <= span:  # least of so many, twice as many at each step
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        least = np.minimum(key[:windows], key[span - width : span - width + windows])[whole]
        flag = np.zeros(stop - start, dtype=bool)
        flag[(mask - (least & mask)).astype(np.int64)] = True
        at = np.flatnonzero(flag)
        picked.append(at + start)
        found.append(h[at])
    if not picked:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(picked), return_index=True)
    owner = np.searchsorted(ends, at, "right")
    return owner, at - (ends - sizes)[owner], np.concatenate(found)[first]


def suffix_order(hashes: PrefixHashes, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Sort suffixes within their groups (``group`` ascends) by a bottom-up mergesort.

    A comparison is one common extension and one byte.  All merges of a level
    run at once: an element's place is its own plus the number of smaller ones
    in the sister run, found by binary search.
    """
    n = len(start)
    order = np.arange(n)
    begin = np.searchsorted(group, group, "left")
    end = np.searchsorted(group, group, "right")

    def before(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        most = np.minimum(size[i], size[j])
        lcp = hashes.common(start[i], start[j], most)
        short = lcp == most
        last = len(hashes.data) - 1
        a = hashes.data[np.minimum(start[i] + lcp, last)]
        b = hashes.data[np.minimum(start[j] + lcp, last)]
        return np.where(short, (size[i] < size[j]) | ((size[i] == size[j]) & (i < j)), a < b)

    width = 1
    while (active := np.flatnonzero(end - begin > width)).size:
        local = active - begin[active]
        run = local // width
        sister = begin[active] + (run ^ 1) * width
        lo = np.minimum(sister, end[active])
        hi = np.minimum(sister + width, end[active])
        first = lo.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            less = before(order[mid], order[active[open_]])
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        place = begin[active] + (run // 2) * 2 * width + local % width + (lo - first)
        moved = order[active]
        order[place] = moved
        width *= 2
    return order


def _sorted(parts: list[np.ndarray], group: np.ndarray, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of strings within groups, and the common prefix of each with the one before; hashes are never trusted.

    Common prefixes are compared item by item, and neighbours have to ascend;
    so a hash that two strings share can't change the result.
    """
    parts = [x[::-1] for x in parts] if reverse else parts
    data = np.concatenate(parts) if parts else np.empty(0, np.uint8)
    data = data if len(data) else np.zeros(1, np.uint8)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    start = np.cumsum(size) - size
    hashes = PrefixHashes(data)
    order = suffix_order(hashes, start, size, group)
    lcp = np.zeros(len(parts), dtype=np.int64)
    if len(parts) > 1:
        a, b = order[:-1], order[1:]
        near = np.flatnonzero(group[a] == group[b])
        a, b = a[near], b[near]
        most = np.minimum(size[a], size[b])
        lcp[near + 1] = n = hashes.common(start[a], start[b], most)
        last = len(data) - 1
        ascends = np.where(n == most, size[a] <= size[b], data[np.minimum(start[a] + n, last)] < data[np.minimum(start[b] + n, last)])
        raw, w = data.tobytes(), data.itemsize
        equal = (raw[i * w : (i + k) * w] == raw[j * w : (j + k) * w] for i, j, k in zip(start[a].tolist(), start[b].tolist(), n.tolist(), strict=True))
        if not (ascends.all() and all(equal)):  # two strings with one hash
            return _plainly(parts, group)
    return order, lcp


def _plainly(parts: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without hashes, should they ever collide."""
    text = [x.tolist() for x in parts]
    order = np.array(sorted(range(len(parts)), key=lambda i: (group[i], text[i], i)))
    lcp = np.zeros(len(parts), dtype=np.int64)
    for t in range(1, len(parts)):
        i, j = order[t - 1], order[t]
        if group[i] == group[j]:
            a, b = text[i], text[j]
            lcp[t] = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
    return order, lcp


class RangeMinimum:
    """Least value of any range, from the least values of all ranges of a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of [lo, hi); no range is empty."""
        out = np.empty(len(lo), dtype=self.levels[0].dtype)
        level = np.frexp(hi - lo)[1] - 1
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << k)])
        return out


def repeated_windows(left: list[np.ndarray], right: list[np.ndarray], group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For different contexts of anchors, by group: the most and the fewest items before the anchor that a
    window of ``length`` items repeated in another context of the group has; (-1, ``length`` + 1) if none is.

    Contexts are arrays of bytes or of numbers of words; ``right`` begins with
    the anchor.
    """
    n = len(left)
    most, fewest = np.full(n, -1), np.full(n, length + 1)
    if not n:
        return most, fewest
    l_size, r_size = (np.fromiter(map(len, x), np.int64, n) for x in (left, right))
    r_order, r_lcp = _sorted(right, group, False)
    l_order, l_lcp = _sorted(left, group, True)
    l_rank = np.empty(n, dtype=np.int64)
    l_rank[l_order] = np.arange(n)
    l_least = RangeMinimum(l_lcp)
    counts, begin = np.bincount(group)[group], np.searchsorted(group, group)
    # Small groups: pairs at distance d in the order of what follows the anchor, as long as they can share a window.
    t, d = np.flatnonzero((counts <= PAIRS) & (begin < np.arange(n))), 1
    ahead = np.full(len(t), length)
    while len(t):
        ahead = np.minimum(ahead, r_lcp[t - d + 1])
        on = ahead + l_size[r_order[t]] >= length
        t, ahead = t[on], ahead[on]
        i, j = r_order[t - d], r_order[t]
        x, y = l_rank[i], l_rank[j]
        back = l_least.of(np.minimum(x, y) + 1, np.maximum(x, y) + 1)
        hit = np.flatnonzero(back + ahead >= length)
        for x in (i[hit], j[hit]):
            np.maximum.at(most, x, back[hit])
            np.minimum.at(fewest, x, length - ahead[hit])
        d += 1
        on = t - d >= begin[t]
        t, ahead = t[on], ahead[on]
    # Large groups: contexts that share a window have the same class in both orders.
    for g in np.unique(group[counts > PAIRS]):
        at = np.flatnonzero(group == g)
        lo, hi = at[0], at[-1] + 1
        r_at, l_at = r_order[lo:hi], l_order[lo:hi]
        for a in range(int(l_size[at].max()) + 1):
            r_class, l_class = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
            r_class[r_at - lo] = np.cumsum(r_lcp[lo:hi] < length - a)
            l_class[l_at - lo] = np.cumsum(l_lcp[lo:hi] < a)
            has = np.flatnonzero((l_size[lo:hi] >= a) & (r_size[lo:hi] >= length - a))
            key = r_class[has] * (hi - lo + 1) + l_class[has]
            _, back, times = np.unique(key, return_inverse=True, return_counts=True)
            hit = has[times[back] > 1] + lo
            most[hit] = np.maximum(most[hit], a)
            fewest[hit] = np.minimum(fewest[hit], a)
    return most, fewest


class Bytes:
    """A text as the string of its bytes."""

    def __init__(self, text: bytes):
        self.text = text

    def __len__(self) -> int:
        return len(self.text)

    def keys(self) -> np.ndarray:
        return np.frombuffer(self.text, np.uint8)

    def part(self, a: int, b: int) -> bytes:
        return self.text[a:b]

    @staticmethod
    def numbers(contexts: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint8) for x in contexts]


class Words:
    """A text as the string of its words ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case, one space between them."""

    def __init__(self, text: bytes):
        self.text = b" ".join(text.lower().split())
        self.codes = np.frombuffer(self.text, np.uint8)
        space = np.flatnonzero(self.codes == 32)
        self.starts = np.concatenate(([0], space + 1)) if self.text else np.empty(0, np.int64)
        self.ends = np.append(space, len(self.text)) if self.text else np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.starts)

    def keys(self) -> np.ndarray:
        """Hashes that only choose anchors; what is equal is decided by the words themselves."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        place = np.arange(len(self.codes)) - np.repeat(self.starts, np.diff(np.append(self.starts, len(self.codes))))
        values = self.codes * powers(1 << LONG_WORD)[0][place & ((1 << LONG_WORD) - 1)]
        values[self.ends[:-1]] = 0  # the spaces
        return _mixed(np.add.reduceat(values, self.starts))

    def part(self, a: int, b: int) -> bytes:
        b = min(b, len(self.starts))
        return self.text[self.starts[a] : self.ends[b - 1]] if a < b else b""

    @staticmethod
    def numbers(contexts: list[bytes]) -> list[np.ndarray]:
        known: dict[bytes, int] = {}
        split = [x.split() for x in contexts]
        return [np.fromiter((known.setdefault(w, len(known)) for w in x), np.int64, len(x)) for x in split]


UNITS = {"bytes": Bytes, "words": Words}


def _compare(sizes: list[tuple[str, int]]):
    """Streams groups (rows sorted by anchor hash) through the suffix sort, a few thousand contexts at a time."""

    def flush(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for kind, (unit, length) in enumerate(sizes):
            if not (mine := [r for r in rows if r[0] & 1 == kind]):
                continue
            h, doc, mark, pos, left, right = zip(*mine, strict=True)
            group = np.cumsum(np.diff(np.array(h), prepend=h[0]) != 0)
            numbers = UNITS[unit].numbers([*left, *right])
            most, fewest = repeated_windows(numbers[: len(mine)], numbers[len(mine) :], group, length)
            ok = most >= 0
            pos = np.array(pos)
            columns = [np.array(doc)[ok], np.array(mark)[ok], np.full(ok.sum(), kind), (pos - most)[ok], (pos - fewest + length)[ok]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["doc_id", "mark", "kind", "start", "end"])

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(rows) >= 4096 and rows[-1][0] != row[0]:
                    yield from flush(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from flush(rows)

    return run


def _windows(sizes: list[tuple[str, int]]):
    """Every window around the anchors of very large groups, by digest."""

    def run(batches):
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                unit, length = sizes[row[0] & 1]
                left, right = (UNITS[unit](x) for x in row[4:6])
                l, text = len(left), UNITS[unit](row[4] + (b" " if unit == "words" else b"") + row[5])
                back = [a for a in range(l + 1) if len(right) >= length - a]
                digests = [xxhash.xxh3_128_digest(text.part(l - a, l - a + length)) for a in back]
                k = len(back)
                arrays = [pa.array([x] * k, pa.int64()) for x in row[:4]] + [pa.array(back, pa.int32()), pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["h", "doc_id", "mark", "pos", "back", "digest"])

    return run


def _semi_join(rows: DataFrame, keys: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` whose key is in ``keys`` (which has the rows of each key as ``n``), however often a key occurs.

    Keys with more than a thousandth of all rows, a thousand at most, are
    broadcast; the others are joined by a shuffle and no task gets much.
    """
    hot = F.broadcast(keys.where(F.col("n") * 1000 > total).select(*on))
    rest = keys.where(F.col("n") * 1000 <= total).select(*on)
    return rows.join(hot, on, "left_semi").unionByName(rows.join(hot, on, "left_anti").join(rest, on, "left_semi"))


#: Equal rows of one key that are dealt to so many groups of a join.
SALTS = 64
KEY = ["doc_id", "mark"]


def _dealt(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with ``salt``: rows of hot keys (a thousand keys at most) are dealt to groups."""
    marked = rows.join(F.broadcast(hot.select(*KEY, F.lit(True).alias("often"))), KEY, "left")
    return marked.withColumn("salt", F.when(F.col("often"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0).cast("int")).drop("often")


def _for_each(table: DataFrame, hot: DataFrame) -> DataFrame:
    """``table`` (one row for each key) with ``salt``: a copy for each group to which the key's rows are dealt."""
    marked = table.join(F.broadcast(hot.select(*KEY, F.lit(True).alias("often"))), KEY, "left")
    return marked.withColumn("salt", F.explode(F.when(F.col("often"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("often")


def repeated_spans(docs: DataFrame, sizes: list[tuple[str, int]]) -> tuple[DataFrame, DataFrame]:
    """Spans that occur again, by (``doc_id``, ``mark``): column ``spans``, a set of (kind, start, end) that may overlap; and the keys of many equal rows.

    ``docs`` has ``doc_id``, ``mark`` (a hash of the text) and ``text`` as binary.
    ``sizes`` holds one or two (unit, length); a span's kind is its place there,
    and it is counted in that unit: ``bytes``, or ``words``.

    1. Every window of ``length`` items has an anchor (:func:`anchors`).  Only
       anchors, with a digest of all that windows around them can reach, are
       shuffled: about one for a hundred bytes.  The last bit of an anchor's
       hash is its kind, so kinds never meet.
    2. An anchor whose hash no other anchor has can't be in a repeated window.
       One whose whole context occurs again is repeated in all of its windows;
       copies are settled here by counting 128-bit digests, whatever their
       number.
    3. What is left are different contexts of one anchor, mostly the edges of
       repeated passages.  One context of each kind is fetched, and each group
       is suffix-sorted both ways to find the windows that contexts share.
       Groups with more different contexts than ``HOT_CLASSES`` count digests of
       their windows instead, which Spark combines before it shuffles.
    """
    reach = [(length - max(1, length // 3), length) for _, length in sizes]

    def found(batches):
        names = ["doc_id", "mark", "pos", "h", "full", "head"]
        for batch in batches:
            ids, marks, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for (a, b), (kind, (unit, length)) in itertools.product(slices(texts, 1 << 18), enumerate(sizes)):
                items = [UNITS[unit](x) for x in texts[a:b]]
                owner, at, h = anchors([x.keys() for x in items], length)
                if not len(at):
                    continue
                back = np.minimum(at, reach[kind][0])
                full = [xxhash.xxh3_128_digest(items[o].part(p - k, p + length), k) for o, p, k in zip(owner.tolist(), at.tolist(), back.tolist(), strict=True)]
                h = ((h & np.uint64(U64 - 1)) | np.uint64(kind)).view(np.int64)
                head = np.append(True, owner[1:] != owner[:-1])  # once for each row and kind
                yield pa.RecordBatch.from_arrays([*map(pa.array, (ids[a:b][owner], marks[a:b][owner], at, h)), pa.array(full, pa.binary()), pa.array(head)], names)

    def of_kind(values: list[int]) -> Column:
        return F.when(F.col("h").bitwiseAND(1) == 0, values[0]).otherwise(values[-1])

    every = save(docs.select("doc_id", "mark", "text").mapInArrow(found, "doc_id long, mark long, pos long, h long, full binary, head boolean"), "suffix-anchors")
    heads = every.where("head").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    equal = save(heads.where(F.col("n") * 1000 > F.lit(every.where("head").count())).select(*KEY), "suffix-equal-rows")
    every = every.drop("head")
    again = save(every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-again")
    shared = save(_semi_join(every, again, ["h"], every.count()), "suffix-shared")
    rep = [F.first(c).alias(c) for c in ("doc_id", "mark", "pos")]  # of one row, as all three change together
    classes = save(shared.groupBy("h", "full").agg(F.count(F.lit(1)).alias("n"), *rep), "suffix-classes")
    drop_saved(every, again)
    copies = _semi_join(shared, classes.where("n > 1"), ["h", "full"], shared.count())
    kind = F.col("h").bitwiseAND(1).alias("kind")
    whole = copies.select("doc_id", "mark", kind, F.greatest(F.col("pos") - of_kind([b for b, _ in reach]), F.lit(0)).alias("start"), (F.col("pos") + of_kind([n for _, n in reach])).alias("end"))

    mixed = classes.groupBy("h").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    wanted = classes.join(mixed, "h").groupBy("doc_id", "mark").agg(F.collect_list(F.struct("h", "classes", "pos")).alias("at"))

    def fetched(batches):
        for batch in batches:
            rows = []
            for doc, mark, text, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                split = {}
                for h, classes, p in (x.values() for x in at):
                    unit, length = sizes[h & 1]
                    if h & 1 not in split:
                        split[h & 1] = UNITS[unit](text)
                    items = split[h & 1]
                    rows.append((h, doc, mark, p, items.part(max(0, p - reach[h & 1][0]), p), items.part(p, p + length), classes))
            for k in range(0, len(rows), 20_000):
                part = list(zip(*rows[k : k + 20_000], strict=True))
                kinds = [pa.int64()] * 4 + [pa.binary()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, kinds, strict=True)], ["h", "doc_id", "mark", "pos", "left", "right", "classes"])

    wanted = save(wanted, "suffix-wanted")
    # Of many equal rows one brings its contexts; those of a task are one before they are shuffled.  Where few rows
    # are equal each does, and its contexts are repeated then, as their digests say already.
    often = docs.select(*KEY, "text").join(F.broadcast(equal), KEY, "left_semi").groupBy(*KEY).agg(F.first("text").alias("text"))
    one = docs.select(*KEY, "text").join(F.broadcast(equal), KEY, "left_anti").unionByName(often)
    contexts = save(one.join(wanted, KEY).select(*KEY, "text", "at").mapInArrow(fetched, "h long, doc_id long, mark long, pos long, left binary, right binary, classes long"), "suffix-contexts")
    columns = ["h", "doc_id", "mark", "pos", "left", "right"]
    usual = contexts.where(F.col("classes") <= HOT_CLASSES).select(*columns).repartition("h").sortWithinPartitions("h")
    edges = usual.mapInArrow(_compare(sizes), "doc_id long, mark long, kind long, start long, end long")
    hot = contexts.where(F.col("classes") > HOT_CLASSES).select(*columns)
    windows = hot.mapInArrow(_windows(sizes), "h long, doc_id long, mark long, pos long, back int, digest binary")
    twice = windows.groupBy("h", "back", "digest").count().where("count > 1").drop("count")
    hot_edges = windows.join(twice, ["h", "back", "digest"]).groupBy("h", "doc_id", "mark", "pos").agg(F.max("back").alias("most"), F.min("back").alias("fewest"))
    hot_edges = hot_edges.select("doc_id", "mark", kind, (F.col("pos") - F.col("most")).alias("start"), (F.col("pos") - F.col("fewest") + of_kind([n for _, n in reach])).alias("end"))
    spans = whole.unionByName(edges).unionByName(hot_edges).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("kind", "start", "end")).alias("spans"))
    spans = save(spans, "suffix-spans")
    drop_saved(shared, classes, contexts, wanted)
    return spans, equal


def runs(spans: pa.Array, kind: int, sizes: np.ndarray) -> list[list[tuple[int, int]]]:
    """Of each row's spans of a kind, the maximal runs that they cover, within the row's size; spans that touch are one run."""
    if isinstance(spans, pa.ChunkedArray):
        spans = spans.combine_chunks()
    n = len(spans)
    row = np.repeat(np.arange(n), spans.value_lengths().fill_null(0).to_numpy())
    flat = spans.flatten()
    kinds, start, end = (flat.field(k).to_numpy() for k in ("kind", "start", "end"))
    mine = np.flatnonzero(kinds == kind)
    row, start = row[mine], start[mine]
    end = np.minimum(end[mine], sizes[row])
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    far = row << 40
    reached = np.maximum.accumulate(end + far) if len(end) else end
    first = np.ones(len(end), dtype=bool)
    first[1:] = (start + far)[1:] > reached[:-1]
    at = np.flatnonzero(first)
    last = (reached - far)[np.append(at[1:], len(end)) - 1] if len(at) else at
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for r, a, b in zip(row[at].tolist(), start[at].tolist(), last.tolist(), strict=True):
        out[r].append((a, b))
    return out


def in_bytes(text: bytes, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as runs of bytes, from the first byte of the first word to the last of the last."""
    at = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)] if words else []
    return [(at[a][0], at[min(b, len(at)) - 1][1]) for a, b in words]


def cut(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    """What is left of a text without some ascending runs."""
    if not gone:
        return text
    ends = [0, *(b for _, b in gone)]
    starts = [*(a for a, _ in gone), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends, starts, strict=True))


def _with_spans(df: DataFrame, id_col: str, text_col: str, sizes: list[tuple[str, int]]) -> DataFrame:
    """Columns ``row`` (the whole input row), ``id``, ``text`` (bytes) and ``spans``; no column of ``df`` can clash."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), text.alias("text")).where("id is not null").withColumn("mark", F.xxhash64("text"))
    rows = rows.withColumnRenamed("id", "doc_id")
    spans, equal = repeated_spans(rows.select(*KEY, "text"), sizes)
    return _dealt(rows, equal).join(_for_each(spans, equal), [*KEY, "salt"], "left").drop("salt").withColumnRenamed("doc_id", "id")


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, words: int | None = None) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts anywhere else.

    One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept_sha256`` (of the bytes left, concatenated).
    Strings are judged on the input; matches never cross documents and may lie
    in one document.

    With ``words``, strings of so many words (A-Z in lower case, whatever white
    space is between them) are looked for in the same run and reported, not
    removed: ``n_passages`` (maximal runs of words that such strings cover) and
    ``passage_bytes`` (their bytes, white space between their words included).
    400 bytes are about 65 words of prose, so a passage of 50 to 60 words is
    seen only this way.

    A null text counts as empty and, like any text that is too short, has no
    spans.  Texts are never cut or skipped for their length; a task holds one
    batch of whole texts.  Rows that repeat an id and text are copies of each
    other.  Rows with a null id are left out and match nothing.  Other columns
    are ignored, whatever their names.  An empty table gives an empty result.
    """
    sizes = [("bytes", length)] + ([("words", words)] if words else [])

    def done(batches):
        for batch in batches:
            texts, sizes = batch.column(1).to_pylist(), pc.binary_length(batch.column(1)).to_numpy().astype(np.int64)
            gone = runs(batch.column(2), 0, sizes)
            total = lambda some: pa.array([sum(b - a for a, b in x) for x in some], pa.int64())
            number = lambda some: pa.array(map(len, some), pa.int64())
            digests = [hashlib.sha256(cut(t, x)).hexdigest() for t, x in zip(texts, gone, strict=True)]
            columns = [batch.column(0), pa.array(sizes), total(gone), number(gone), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if words:
                more = [in_bytes(t, x) for t, x in zip(texts, runs(batch.column(2), 1, sizes), strict=True)]
                columns += [number(more), total(more)]
                names += ["n_passages", "passage_bytes"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", n_passages long, passage_bytes long" if words else "")
    return _with_spans(df, id_col, text_col, sizes).select("id", "text", "spans").mapInArrow(done, schema)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, unit: str = "bytes") -> DataFrame:
    """``df`` with strings of ``length`` bytes, or of ``length`` words, that occur again cut out of ``text_col``.

    Every occurrence goes.  A character that loses a byte goes with it.  Words
    are compared with A-Z in lower case, whatever white space is between them.

    Rows and columns stay, in the columns' order and whatever their names; rows
    with a null id are left out, null texts stay null, and a text of which
    nothing is left is empty.  An empty table gives an empty result.
    """

    names = [f"c{k}" for k in range(len(df.columns))]  # no name can clash
    numbered, at = df.toDF(*names), df.columns.index(text_col)
    rows = _with_spans(numbered, names[df.columns.index(id_col)], names[at], [(unit, length)]).select("row.*", "text", "spans")

    def left(batches):
        for batch in batches:
            *columns, raw, spans = batch.columns
            texts, out = raw.to_pylist(), columns[at].to_pylist()
            for k, some in enumerate(runs(spans, 0, pc.binary_length(raw).to_numpy().astype(np.int64))):
                if some:
                    out[k] = cut(texts[k], in_bytes(texts[k], some) if unit == "words" else some).decode("utf-8", "ignore")
            columns[at] = pa.array(out, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(left, numbered.schema).toDF(*df.columns)
