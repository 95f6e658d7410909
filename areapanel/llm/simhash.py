"""SimHash near-dedup by tiled exact comparison of fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, save

BITS = 64
CHUNK = 1 << 15
ENTRIES = 1 << 20
#: Candidates of a row that are tried before its others.
NEAREST = 32
#: Texts of a class of candidates that one task compares by their shingles, and the bytes of those.
GROUP, GROUP_BYTES = 1024, 32 << 20
#: Increment and multipliers of the 64-bit mixer splitmix64 (fixed values).
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _votes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """For each of ``bits`` bits, the number of hashes that set it; words after the first are mixed from the hash."""
    words = np.empty((len(hashes), bits // BITS), dtype="<u8")
    words[:, 0] = hashes
    for k in range(1, words.shape[1]):
        x = hashes + np.uint64((k * MIX[0]) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
        words[:, k] = x ^ (x >> np.uint64(31))
    set_ = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
    whole = len(set_) // 255 * 255  # sums of 255 bits fit in a byte
    return set_[:whole].reshape(-1, 255, bits).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + set_[whole:].sum(axis=0, dtype=np.uint8)


def _hashes(text: bytes | None, words: int, seed: int):
    """Hashes of the word shingles of a text in their order, ``CHUNK`` at a time."""
    parts = (text or b"").lower().split()
    if not parts:
        return
    joined = b" ".join(parts)
    count = max(1, len(parts) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:count]
    ends = ends[min(words, len(parts)) - 1 :]
    for k in range(0, count, CHUNK):
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[k : k + CHUNK].tolist(), ends[k : k + CHUNK].tolist(), strict=True)], dtype=np.uint64)


def _majority(chunks, bits: int) -> np.ndarray:
    """The fingerprint of hashes that come in chunks."""
    votes, count = np.zeros(bits, dtype=np.int64), 0
    for hashes in chunks:
        votes += _votes(hashes, bits)
        count += len(hashes)
    return np.packbits(votes * 2 > count, bitorder="little").view("<u8")


def wide_fingerprint(text: bytes | None, words: int = 4, seed: int = 42, bits: int = BITS) -> np.ndarray:
    """SimHash of the word shingles of a text given as UTF-8, as ``bits`` / 64 unsigned numbers.

    A-Z are lower-cased; words are runs of bytes other than ASCII white space;
    a text of fewer words than a shingle has is one shingle; none give zero.
    A bit is 1 if it is set in over half of the shingles' hashes, repeats
    included.  The first 64 bits are those of XXH64, the others are mixed from it.
    """
    return _majority(_hashes(text, words, seed), bits)


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """The fingerprint of 64 bits as a number."""
    return int(wide_fingerprint(text, words, seed)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42, bits: int = BITS, sets: bool = False) -> DataFrame:
    """Columns ``doc_id``, ``mark`` (a hash of the text), ``fp`` (the fingerprint's first 64 bits as a signed long) and ``rest`` (the other bits).

    With ``sets``, also ``grams``, a hash of the set of shingles, and their number ``size``; else both are zero.
    """

    def run(batches):
        for batch in batches:
            fps, grams, size = [], [], []
            for text in batch.column(1).to_pylist():
                chunks = list(_hashes(text, words, seed)) if sets else _hashes(text, words, seed)
                fps.append(_majority(chunks, bits))
                different = _different(chunks) if sets else ()
                grams.append(xxhash.xxh64_intdigest(different.tobytes(), seed) if sets else 0)
                size.append(len(different))
            first = np.array([x[0] for x in fps], dtype=np.uint64).view(np.int64)
            columns = [batch.column(0), batch.column(2), pa.array(first), pa.array([x[1:].tobytes() for x in fps], pa.binary()), pa.array(np.array(grams, dtype=np.uint64).view(np.int64)), pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "fp", "rest", "grams", "size"])

    return _texts(df, id_col, text_col).mapInArrow(run, "doc_id long, mark long, fp long, rest binary, grams long, size long")


def _different(chunks) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *chunks]))


def shingles(text: bytes | None, words: int, seed: int = 42) -> np.ndarray:
    """Hashes of the different word shingles of a text, ascending."""
    return _different(_hashes(text, words, seed))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("binary")
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark")).where("doc_id is not null")


def _half_range(diff: int, radius: int) -> tuple[int, int]:
    """Differences of the upper halves' population counts that leave the whole distance within the radius."""
    return -((radius - diff) // 2), (radius + diff) // 2


def _tiles(radius: int, total_radius: int, counts: bool = False, band: int = 1):
    """Compare two tiles of fingerprints (or one with itself), each of one population count, or of a ``band`` of them.

    Returns links to the least of those reached in the tiles; with ``counts``,
    also the number ``n`` of rows that each row is near (twice within a tile).
    """

    def compare(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        p_lo, b_lo, p_hi, b_hi = (x.as_py() for x in key)
        same = (p_lo, b_lo) == (p_hi, b_hi)
        pop, block = t["pop"].to_numpy(), t["block"].to_numpy()
        reps, fps = t["rep"].to_numpy(), t["fp"].to_numpy().view(np.uint64)
        upper = np.bitwise_count(fps >> np.uint64(32)).astype(np.int64)
        rest = np.array([np.frombuffer(x, "<u8") for x in t["rest"].to_pylist()], dtype=np.uint64).reshape(len(fps), -1)
        first = (pop == p_lo) & (block == b_lo)
        order = np.lexsort((upper, ~first))
        reps, fps, upper, rest = reps[order], fps[order], upper[order], rest[order]
        entries = ENTRIES // (1 + rest.shape[1])
        split = int(first.sum())
        left = slice(0, split)
        right = left if same else slice(split, len(fps))
        r_fps, r_upper, shift = fps[right], upper[right], 0 if same else split
        labels = np.arange(len(fps))
        touched = np.zeros(len(fps), dtype=bool)
        degree = np.zeros(len(fps), dtype=np.int64)
        low, high = _half_range(p_lo - p_hi, radius) if band == 1 else (-radius, radius)
        for u in np.unique(upper[left]):
            rows = np.flatnonzero(upper[left] == u)
            lo, hi = np.searchsorted(r_upper, [u - high, u - low + 1])
            step = max(1, entries // max(1, hi - lo))
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                near = np.bitwise_count(fps[part][:, None] ^ r_fps[None, lo:hi]) <= radius
                i, j = np.nonzero(near)
                i, j = part[i], j + lo + shift
                i, j = (x[i != j] for x in (i, j))
                whole = np.bitwise_count(fps[i] ^ fps[j]) + np.bitwise_count(rest[i] ^ rest[j]).sum(axis=1, dtype=np.int64)
                i, j, whole = (x[whole <= total_radius] for x in (i, j, whole))
                if len(i):
                    touched[i] = touched[j] = True
                    labels = _merge(labels, i, j)
                    degree += np.bincount(i, minlength=len(fps)) + np.bincount(j, minlength=len(fps))
        root = np.full(len(fps), np.iinfo(np.int64).max)
        np.minimum.at(root, labels, reps)
        return pa.table({"rep": reps[touched], "root": root[labels][touched]} | ({"n": degree[touched]} if counts else {}))

    return compare


def _merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least label of the components that the links i-j join."""
    while True:
        least = np.minimum(labels[i], labels[j])
        if (labels[i] == least).all() and (labels[j] == least).all():
            return labels
        for side in (i, j):
            np.minimum.at(labels, labels[side], least)  # only the label's own row, to which its others follow
        while not (labels == (labels := labels[labels])).all():
            pass


def _closest(i: np.ndarray, j: np.ndarray, far: np.ndarray) -> list[np.ndarray]:
    """Of links from rows i to rows j, the ``NEAREST`` of least distance of each i; repeats count once."""
    order = np.lexsort((j, far, i))
    i, j, far = i[order], j[order], far[order]
    new = np.ones(len(i), dtype=bool)
    new[1:] = (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    i, j, far = i[new], j[new], far[new]
    starts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.empty(0, dtype=np.int64)
    place = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
    return [x[place < NEAREST] for x in (i, j, far)]


def _candidates(fps: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, total_radius: int):
    """Pairs of rows, one of ``left`` and one of ``right`` (all pairs if they are the same), that fingerprints put near: ends and distance, in parts."""
    same, step = left is right, max(1, ENTRIES // (max(1, len(right)) * fps.shape[1]))
    for k in range(0, len(left), step):
        part = left[k : k + step]
        others = right[k:] if same else right
        i, j = np.nonzero(np.bitwise_count(fps[part, 0][:, None] ^ fps[others, 0][None]) <= radius)
        if same:
            i, j = (x[j > i] for x in (i, j))
        i, j = part[i], others[j]
        far = np.bitwise_count(fps[i] ^ fps[j]).sum(axis=1, dtype=np.int64)
        yield [x[far <= total_radius] for x in (i, j, far)]


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two ascending sets share ``least`` or more of all their members."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or len(a) < least * len(b):
        return not len(b)
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both >= least * (len(a) + len(b) - both)


def _prove(fps: np.ndarray, labels: np.ndarray, sets: list[bytes], left: np.ndarray, right: np.ndarray, radius: int, total_radius: int, least: float) -> list[tuple[int, int]]:
    """Links between rows of different ``labels`` that hold by their sets.

    All pairs are tried, each row's nearest first; a pair is left out only if
    links that hold join its ends already, so the links found reach what all
    that hold would.
    """
    found: list[tuple[int, int]] = []
    for i, j, far in _candidates(fps, left, right, radius, total_radius):
        nearest = _closest(np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([far, far]))[:2] if len(i) > NEAREST else []
        for a, b in [nearest, (i, j)] if nearest else [(i, j)]:
            step = 64
            while len(a):
                open_ = labels[a] != labels[b]
                a, b = a[open_], b[open_]
                for x, y in zip(a[:step].tolist(), b[:step].tolist(), strict=True):
                    if labels[x] != labels[y] and _alike(np.frombuffer(sets[x], np.uint64), np.frombuffer(sets[y], np.uint64), least):
                        labels[labels == labels[x]] = labels[y]
                        found.append((x, y))
                a, b, step = a[step:], b[step:], 2 * step
    return found


def _cells(radius: int, total_radius: int, least: float):
    """Prove the links among the texts of each component of a cell, or between its two sides."""

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by("component")
        component, rep, side = (t[c].to_numpy() for c in ("component", "rep", "side"))
        words = [np.frombuffer(x, "<u8") for x in t["rest"].to_pylist()]
        fps = np.column_stack([t["fp"].to_numpy().view(np.uint64), np.array(words, dtype=np.uint64).reshape(len(rep), -1)])
        sets, label = t["shingles"].to_pylist(), t["label"].to_numpy()
        ends, start = [], 0
        for stop in [*(np.flatnonzero(np.diff(component)) + 1).tolist(), len(rep)]:
            here = slice(start, stop)
            left = np.flatnonzero(side[here])
            right = left if len(left) == stop - start else np.flatnonzero(~side[here])
            labels = np.unique(label[here], return_inverse=True)[1]
            ends += [(start + a, start + b) for a, b in _prove(fps[here], labels, sets[here], left, right, radius, total_radius, least)]
            start = stop
        ends = np.array(ends, dtype=np.int64).reshape(-1, 2)
        return pa.table({"rep": rep[ends[:, 0]], "root": rep[ends[:, 1]]})

    return compare


def _blocks(n: str, size: str) -> "F.Column":
    return F.greatest(F.ceil(F.col(n) / GROUP), F.ceil(F.col(size) * 8 / GROUP_BYTES), F.lit(1)).cast("int")


def confirmed(near: DataFrame, reps: DataFrame, df: DataFrame, id_col: str, text_col: str, words: int, seed: int, radius: int, total_radius: int, least: float) -> DataFrame:
    """Links (``rep``, ``root``) that join what all candidates joined whose texts share ``least`` or more of their different shingles.

    ``near`` has spanning links of the candidates, with the number ``n`` of each
    row's.  Candidates lie within a component of those, so texts meet by
    components, with their shingles.  Small components share tasks.  Large ones
    are dealt to blocks, and the text near most others joins every block.  What
    that leaves apart meets by pairs of blocks; a part as large as a block has
    blocks of its own, which needn't meet one another.  So each pair of
    candidates is counted, unless links that hold join its ends without it.
    """
    near = save(near, "simhash-near")
    joined = connected_components(near.select(F.col("rep").alias("src"), F.col("root").alias("dst"))).select(F.col("id").alias("rep"), F.col("component_id").alias("component"))
    degree = near.groupBy("rep").agg(F.sum("n").alias("n"))
    rows = save(reps.join(joined, "rep").join(degree, "rep", "left").select("rep", "mark", "fp", "rest", "size", "component", F.coalesce("n", F.lit(0)).alias("n")), "simhash-rows")
    classes = rows.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"), F.max(F.struct("n", (-F.col("rep")).alias("hub"))).alias("most"))
    large = save(classes.withColumn("blocks", _blocks("rows", "size")).where("blocks > 1").select("component", "blocks", (-F.col("most.hub")).alias("hub")), "simhash-large")
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size")).select(_blocks("rows", "size").alias("blocks")).first()  # one row
    shared = int(total.blocks or 1)

    def hashed(batches):
        for batch in batches:
            sets = pa.array([shingles(x, words, seed).tobytes() for x in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rep", "fp", "rest", "component", "label", "cells")), sets], ["rep", "fp", "rest", "component", "label", "cells", "shingles"])

    def prove(dealt: DataFrame, ids: DataFrame) -> DataFrame:
        """``cells`` lists the cells that a text goes to, as key, blocks and side; ``ids`` is a saved table of the same texts.

        Ids alone pick the texts, so that Spark knows their size and can spare the shuffle of all texts while they are few.
        """
        texts = _texts(df, id_col, text_col).withColumnRenamed("doc_id", "rep").join(ids.select("rep", "mark"), ["rep", "mark"], "left_semi")
        texts = texts.dropDuplicates(["rep", "mark"]).join(dealt, ["rep", "mark"])
        cell = "key: long, lo: int, hi: int, side: boolean"
        sets = texts.select("rep", "fp", "rest", "component", "label", "cells", "text").mapInArrow(hashed, f"rep long, fp long, rest binary, component long, label long, cells array<struct<{cell}>>, shingles binary")
        sets = sets.withColumn("cell", F.explode("cells")).select("rep", "fp", "rest", "component", "label", "shingles", "cell.*")
        return sets.groupBy("key", "lo", "hi").applyInArrow(_cells(radius, total_radius, least), "rep long, root long")

    own = F.pmod(F.xxhash64("rep", "mark"), F.col("blocks")).cast("int")
    first = F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).when(F.col("rep") == F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    key = F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(F.col("component"))
    dealt = rows.join(large, "component", "left").withColumns({"key": key, "to": first})
    cells = F.transform("to", lambda b: F.struct(F.col("key"), b.alias("lo"), b.alias("hi"), F.lit(True).alias("side")))
    links = save(prove(dealt.select("rep", "mark", "fp", "rest", "component", F.col("rep").alias("label"), cells.alias("cells")), rows), "simhash-links")
    if large.isEmpty():
        return links

    joined = connected_components(links.select(F.col("rep").alias("src"), F.col("root").alias("dst"))).select(F.col("id").alias("rep"), F.col("component_id").alias("label"))
    rest = save(rows.join(large.select("component"), "component").join(joined, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "simhash-rest")
    parts = rest.groupBy("component", "label").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"))
    parts = parts.withColumn("alone", (F.col("rows") > GROUP // 2) | (F.col("size") * 8 > GROUP_BYTES // 2))
    apart = parts.groupBy("component").agg(F.count(F.lit(1)).alias("parts"), F.sum(F.when(~F.col("alone"), F.col("rows"))).alias("few_rows"), F.sum(F.when(~F.col("alone"), F.col("size"))).alias("few_size")).where("parts > 1")
    apart = apart.withColumn("few", F.coalesce(_blocks("few_rows", "few_size"), F.lit(1))).select("component", "few")
    parts = parts.join(apart, "component").select("component", "label", "alone", F.when(F.col("alone"), _blocks("rows", "size")).otherwise(F.col("few")).alias("blocks"))
    place = F.when(F.col("alone"), F.xxhash64("rep", "mark")).otherwise(F.xxhash64("label"))
    block = F.struct("alone", F.when(F.col("alone"), F.col("label")).otherwise(F.lit(0)).alias("of"), F.pmod(place, F.col("blocks")).cast("int").alias("k"))
    rest = save(rest.join(parts, ["component", "label"]).withColumn("block", block).select("rep", "mark", "fp", "rest", "component", "label", "block"), "simhash-apart")
    if rest.isEmpty():
        return links
    meet = rest.groupBy("component").agg(F.sort_array(F.collect_set("block")).alias("every"))  # a block for every GROUP / 2 rows or so
    meet = rest.join(meet, "component").withColumn("at", (F.array_position("every", F.col("block")) - 1).cast("int"))
    other = F.transform("every", lambda x, k: F.struct(F.col("component").alias("key"), F.least(F.col("at"), k).alias("lo"), F.greatest(F.col("at"), k).alias("hi"), (F.col("at") <= k).alias("side"), (x.alone & (x.of == F.col("block.of")) & F.col("block.alone")).alias("joined")))
    cells = F.transform(F.filter(other, lambda x: ~x.joined), lambda x: F.struct(x.key.alias("key"), x.lo.alias("lo"), x.hi.alias("hi"), x.side.alias("side")))
    return links.unionByName(prove(meet.select("rep", "mark", "fp", "rest", "component", "label", cells.alias("cells")), rest))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4, seed: int = 42, tile_rows: int = 1024, bits: int = BITS, total_radius: int | None = None, least: float | None = None, band: int = 1) -> DataFrame:
    """Near-duplicate classes of whole texts by SimHash.

    One row per input row: ``doc_id``, ``fingerprint`` (16 lower-case hex
    digits), ``component_id`` (least id reachable over links, itself included),
    ``kept`` (the id is its component's).  Fingerprints link at ``radius`` or
    fewer differing bits; every pair that can is compared exactly.

    Equal fingerprints are taken together first.  The different ones are dealt
    to tiles of one population count and about sqrt(n * ``tile_rows``) rows; as
    two fingerprints' population counts never differ by more than their
    distance, only tile pairs within ``radius`` meet, each pair in a task of
    its own, by exclusive-or and bit counts.  Inside a pair the same bound is
    applied to the upper and lower halves.  Tasks return spanning links only,
    at most one for each of their rows.  With a wide radius most population
    counts meet; ``band`` of them then share tiles, so that a fingerprint is
    copied to fewer.

    Fingerprints of more ``bits`` tell similar texts from others more sharply:
    two link if the first 64 bits differ in ``radius`` or fewer and all bits in
    ``total_radius`` or fewer.  Shingles that two texts share in a proportion J
    of all leave about arccos(2J / (1 + J)) / pi of the bits different.

    With ``least``, a link also needs two texts that share that proportion of
    their different shingles, counted exactly, also if fingerprints are equal.
    Links of fingerprints are then candidates, all of which are confirmed or
    dropped (``confirmed``), save those between texts that confirmed links have
    joined: classes are those of all links that hold, while rows sent grow with
    the rows, not with their pairs.  A pair that agrees in the proportion can
    only be missed where the fingerprints put it beyond the radius.

    A null text counts as empty; texts without words have fingerprint zero and
    link like any other.  Rows that repeat an id stay; rows with a null id are
    left out.  An empty table gives an empty result.
    """
    docs = save(fingerprints(df, id_col, text_col, words, seed, bits, least is not None), "simhash-docs")
    same = ["fp", "rest"] if least is None else ["fp", "rest", "grams"]
    reps = docs.groupBy(*same).agg(F.min(F.struct("doc_id", "mark", "size")).alias("r")).select(*same, F.col("r.doc_id").alias("rep"), F.col("r.mark").alias("mark"), F.col("r.size").alias("size"), F.expr(f"bit_count(fp) div {band}").cast("int").alias("pop"))
    reps = save(reps, "simhash-reps")
    total = reps.count()
    rows = max(1, int((total * tile_rows) ** 0.5))
    sizes = reps.groupBy("pop").count().select("pop", F.ceil(F.col("count") / rows).cast("int").alias("blocks"))
    # At most 65 population counts: the table of tiles is small whatever the input.
    near = sizes.select(F.col("pop").alias("q"), F.col("blocks").alias("q_blocks"))
    sized = F.broadcast(sizes.join(near, F.abs(sizes.pop - near.q) <= (radius + band - 1) // band).groupBy("pop", "blocks").agg(F.collect_list(F.struct("q", "q_blocks")).alias("near")))
    tiled = (
        reps.join(sized, "pop")
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("q", F.explode("near"))
        .select("fp", "rest", "rep", "pop", "block", F.col("q.q").alias("q"), F.explode(F.sequence(F.lit(0), F.col("q.q_blocks") - 1)).alias("q_block"))
    )
    ahead = (F.col("pop") < F.col("q")) | ((F.col("pop") == F.col("q")) & (F.col("block") <= F.col("q_block")))
    one, two = F.struct("pop", "block"), F.struct(F.col("q").alias("pop"), F.col("q_block").alias("block"))
    cells = tiled.withColumns({"lo": F.when(ahead, one).otherwise(two), "hi": F.when(ahead, two).otherwise(one)})
    cells = cells.select(F.col("lo.pop").alias("p_lo"), F.col("lo.block").alias("b_lo"), F.col("hi.pop").alias("p_hi"), F.col("hi.block").alias("b_hi"), "fp", "rest", "rep", "pop", "block")
    links = cells.groupBy("p_lo", "b_lo", "p_hi", "b_hi").applyInArrow(_tiles(radius, bits if total_radius is None else total_radius, least is not None, band), "rep long, root long" + (", n long" if least is not None else ""))
    if least is not None:
        links = confirmed(links, reps, df, id_col, text_col, words, seed, radius, bits if total_radius is None else total_radius, least)
    components = connected_components(links.select(F.col("rep").alias("src"), F.col("root").alias("dst"))).withColumnRenamed("id", "rep")
    classes = reps.join(components, "rep", "left").select(*same, F.coalesce("component_id", "rep").alias("component_id"))
    return docs.join(classes, same).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )
