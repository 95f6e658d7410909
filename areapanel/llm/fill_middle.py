"""Fill-in-the-middle documents, cut by counts of content-defined chunks."""

from __future__ import annotations

import itertools
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
#: A chunk ends where the low bits of the rolling hash are zero: about every 512 bytes, not before 64 nor after 4,096.
WINDOW, MASK, SHORTEST, LONGEST = 32, np.uint32(((1 << 9) - 1) << 23), 64, 4096
#: Bytes of text that a task hashes at once (a longer text goes alone), and bytes of chunks that it remembers.
SLICE_BYTES, CACHE_BYTES = 8 << 20, 48 << 20
#: Bytes that go on with a character of UTF-8, not begin one.
CONTINUATION = bytes(range(0x80, 0xC0))


@lru_cache(maxsize=1)
def gear() -> np.ndarray:
    """A random number for each byte."""
    return np.random.default_rng(20_240_611).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the ``WINDOW`` bytes that end there: their numbers, shifted by age, added up."""
    out, width = gear()[data], 1
    while width < WINDOW:
        more = out.copy()
        more[width:] += out[:-width] << np.uint32(width)
        out, width = more, 2 * width
    return out


def chunk_ends(cuts: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the bytes from ``start`` to ``end``; ``cuts`` are the places after which the hash would end one, ascending."""
    out, at = [], start
    for cut in cuts:
        while cut - at > LONGEST:
            at += LONGEST
            out.append(at)
        if cut - at >= SHORTEST and cut < end:
            out.append(cut)
            at = cut
    while end - at > LONGEST:
        at += LONGEST
        out.append(at)
    if end > at:
        out.append(end)
    return out


class Chunks:
    """What is known of a chunk by its content: characters, whether a mark lies in it, its first and last two bytes.

    A look-up compares the content itself, so a clash of hashes decides nothing.
    Of the chunks seen, the newer ones stay: two generations of at most
    ``CACHE_BYTES`` / 2 of content each.
    """

    def __init__(self):
        self.new, self.old, self.size = {}, {}, 0

    def of(self, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        known = self.new.get(chunk)
        if known is None:
            known = self.old.get(chunk) or self.look(chunk)
            self.new[chunk] = known
            self.size += len(chunk) + 200
            if self.size > CACHE_BYTES // 2:
                self.new, self.old, self.size = {}, self.new, 0
        return known

    @staticmethod
    def look(chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        characters = len(chunk) if chunk.isascii() else len(chunk.translate(None, CONTINUATION))
        return characters, any(m.encode() in chunk for m in MARKS), chunk[:2], chunk[-2:]


class Text:
    """A text as chunks: its characters, whether it holds a mark, and the byte at which any of its characters begins."""

    def __init__(self, raw: bytes, ends: list[int], chunks: Chunks):
        """``ends``: where the chunks of ``raw`` end."""
        self.raw, self.starts = raw, [0, *ends][:-1] if ends else []
        known = [chunks.of(raw[a:b]) for a, b in itertools.pairwise([0, *ends])]
        self.before = [0, *itertools.accumulate(k[0] for k in known)]  # characters before each chunk, and all of them
        across = (a[3] + b[2] for a, b in itertools.pairwise(known))  # a mark has three bytes: two meet on one side
        self.marked = any(k[1] for k in known) or any(m.encode() in x for x in across for m in MARKS)

    def __len__(self) -> int:
        return self.before[-1]

    def byte_of(self, character: int) -> int:
        """The chunk that holds the character follows from the counts; only that chunk is looked at."""
        if character >= self.before[-1]:
            return len(self.raw)
        k = bisect_right(self.before, character) - 1
        end = self.starts[k + 1] if k + 1 < len(self.starts) else len(self.raw)
        part = np.frombuffer(self.raw, dtype=np.uint8, count=end - self.starts[k], offset=self.starts[k])
        return self.starts[k] + int(np.flatnonzero((part & 0xC0) != 0x80)[character - self.before[k]])


def texts(raw: list[bytes], chunks: Chunks):
    """The texts of a batch, chunked; slices of it are hashed at once."""
    at = 0
    while at < len(raw):
        size, to = len(raw[at]), at + 1
        while to < len(raw) and size + len(raw[to]) <= SLICE_BYTES:
            size, to = size + len(raw[to]), to + 1
        data = np.frombuffer(b"".join(raw[at:to]), dtype=np.uint8)
        # The window at SHORTEST bytes or more into a text lies in that text, so its chunks don't depend on its neighbours.
        cuts = (np.flatnonzero((rolling(data) & MASK) == 0) + 1).tolist() if size else []
        start, k = 0, 0
        for text in raw[at:to]:
            first = k
            while k < len(cuts) and cuts[k] <= start + len(text):
                k += 1
            yield Text(text, [e - start for e in chunk_ends(cuts[first:k], start, start + len(text))], chunks)
            start += len(text)
        at = to


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_share: int = 10, spm_share: int = 20) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``n`` (characters), ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    The cuts and the form follow from the SHA-256 of ``1:`` and the id: its first
    four groups of eight hex digits are h1 to h4.  The prefix ends after the
    smaller of h1 % (n + 1) and h2 % (n + 1) characters, the middle after the
    larger.  ``plain_share`` of a hundred texts (h3), empty ones and those that
    hold a mark stay as they are; ``spm_share`` of a hundred of the rest (h4)
    become ``<S>suffix<P>prefix<M>middle``, the others
    ``<P>prefix<S>suffix<M>middle``.

    Texts are cut into content-defined chunks.  A task remembers what it has
    counted in a chunk by the chunk's content, so copies and shared passages are
    counted once; a text's length and the chunk in which a cut lies are sums over
    its chunks.  Nothing is shuffled, and rows don't depend on each other.

    A null text counts as empty; a null id is hashed as if it had no digits.
    Texts are taken whole; one longer than 8 MB is hashed on its own.  Rows that
    repeat an id are cut alike.  Bytes that aren't UTF-8 belong to the character
    before them.  Other columns are ignored, whatever their names.  An empty
    table gives an empty result.
    """
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"), *hashes)

    def made(batches):
        chunks = Chunks()
        p, s, m = (x.encode() for x in MARKS)
        for batch in batches:
            raw = batch.column(1).to_pylist()
            drawn = zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)
            out = []
            for text, (h1, h2, h3, h4) in zip(texts(raw, chunks), drawn, strict=True):
                n = len(text)
                if not text.raw or text.marked or h3 % 100 >= 100 - plain_share:
                    out.append((n, "plain", None, None, text.raw))
                    continue
                a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                i, j = text.byte_of(a), text.byte_of(b)
                prefix, middle, suffix = text.raw[:i], text.raw[i:j], text.raw[j:]
                parts, form = ((s, suffix, p, prefix, m, middle), "spm") if h4 % 100 < spm_share else ((p, prefix, s, suffix, m, middle), "psm")
                out.append((n, form, a, b - a, b"".join(parts)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = df.schema[id_col].dataType.simpleString()
    done = rows.mapInArrow(made, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return done.select(F.col("id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restored(output: str = "output", form: str = "form"):
    """The text that an output was made from, as a column: marks lie only where the form puts them."""
    parts = F.split(F.col(output), "<[PSM]>")
    piece = lambda k: F.coalesce(F.get(parts, F.lit(k)), F.lit(""))
    psm, spm = F.concat(piece(1), piece(3), piece(2)), F.concat(piece(2), piece(3), piece(1))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


def fill_in_middle_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`fill_in_middle` with the SHA-256 of the output and of the text rebuilt from it in the output's place."""
    done = fill_in_middle(df, id_col, text_col)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select(id_col, "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256"))
