"""Token-id files: canonical length-limited Huffman codes, read by table in independent blocks."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_saved, save, shared_dir
from .tokens import slices, word_encoder

MAGIC = b"APHF1\0\0\0"
HEADER = struct.Struct("<8sIIQQQI")
BLOCK = 1024
SEGMENT_IDS = 1 << 21
MAX_LENGTH = 18


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} different ids need codes longer than {limit} bits")
    order = np.argsort(counts[used], kind="stable")
    weights = counts[used][order].astype(np.float64)
    # A package of level l stands for a leaf (index < n) or two packages of level l - 1.
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate((weights, packages))
        rank = np.argsort(merged, kind="stable")
        levels.append(rank)
        merged = merged[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    depth, take = np.zeros(len(used), dtype=np.int64), 2 * len(used) - 2
    for rank in reversed(levels):
        chosen = rank[:take]
        leaf = chosen < len(used)
        depth[chosen[leaf]] += 1
        take = 2 * int((~leaf).sum())
    lengths[used[order]] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        sizes = lengths[order].astype(np.int64)
        spans = np.uint64(1) << (np.uint64(MAX_LENGTH) - sizes.astype(np.uint64))
        at = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spans)[:-1]))
        codes[order] = at >> (np.uint64(MAX_LENGTH) - sizes.astype(np.uint64))
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each value of the next MAX_LENGTH bits."""
    ids, sizes = np.zeros(1 << MAX_LENGTH, dtype=np.uint32), np.zeros(1 << MAX_LENGTH, dtype=np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (MAX_LENGTH - lengths[order].astype(np.int64))
    total = int(spans.sum())
    ids[:total], sizes[:total] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return ids, sizes


def write_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` one after another, and the bit at which each block of ids begins."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    words = np.zeros((int(ends[-1]) >> 6) + 2 if len(ids) else 2, dtype=np.uint64)
    if len(ids):
        code, word, room = codes[ids], starts >> 6, 64 - (starts & 63) - sizes
        first = np.flatnonzero(np.diff(word, prepend=-1))
        inside = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        words[word[first]] |= np.bitwise_or.reduceat(inside, first)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes(), starts[::BLOCK]


def read_bits(data: bytes, checkpoints: np.ndarray, count: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Decode all blocks side by side, each from its checkpoint."""
    ids, sizes = table
    words = np.frombuffer(data, dtype=">u8").astype(np.uint64)
    out = np.zeros((len(checkpoints), BLOCK), dtype=np.uint32)
    bit = checkpoints.astype(np.int64)
    shift = np.uint64(64 - MAX_LENGTH)
    for k in range(min(BLOCK, count)):
        lanes = slice(None) if k < (count - 1) % BLOCK + 1 else slice(0, len(checkpoints) - 1)
        at, used = bit[lanes] >> 6, (bit[lanes] & 63).astype(np.uint64)
        ahead = (words[at] << used) | ((words[at + 1] >> np.uint64(1)) >> (np.uint64(63) - used))
        value = (ahead >> shift).astype(np.int64)
        out[lanes, k] = ids[value]
        bit[lanes] += sizes[value]
    return out.reshape(-1)[:count]


def write_segment(docs: np.ndarray, sizes: np.ndarray, ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    """One self-contained segment: header, documents, code lengths, checkpoints, bits."""
    bits, checkpoints = write_bits(ids, codes, lengths)
    table = zlib.compress(lengths.tobytes(), 1)
    head = HEADER.pack(MAGIC, len(docs), len(lengths), len(ids), len(checkpoints), len(bits), len(table))
    return b"".join((head, docs.astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), table, checkpoints.astype("<u8").tobytes(), bits))


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, their numbers of ids, and the ids."""
    magic, n, vocab, count, marks, n_bits, n_table = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token-id segment")
    at = HEADER.size
    docs = np.frombuffer(data, "<i8", n, at)
    sizes = np.frombuffer(data, "<u4", n, at := at + 8 * n)
    lengths = np.frombuffer(zlib.decompress(data[(at := at + 4 * n) : at + n_table]), np.uint8)
    checkpoints = np.frombuffer(data, "<u8", marks, at := at + n_table)
    bits = data[(at := at + 8 * marks) : at + n_bits]
    return docs, sizes, read_bits(bits, checkpoints, count, decoding_table(lengths))


def write_token_files(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write their ids to ``path`` in ascending order of the document's id.

    A file holds a range of ids; its rows are (file, segment, ids before the
    segment in the file, payload), and a payload is a segment of about two million
    ids of whole documents: the documents with their numbers of ids, the code
    lengths, a bit-offset checkpoint for every 1,024 ids, and the bits.  Any
    reader can decode a segment alone, and any block of it alone.  Spark's
    Parquet writer holds the payloads, so files reach any store that Spark does
    and a lost executor leaves nothing behind.

    One Huffman code is made from the counts of all ids over all documents.
    Counts are summed by Spark; the driver gets one row for each id of the
    vocabulary at most.

    A null or empty text has the end id alone.  Rows that repeat an id are
    documents of their own, next to each other in no set order.  Rows with a
    null id are left out.  An empty table writes an empty folder.
    """

    bound = vocab_size(tokenizer_path)
    kind = "<u4" if bound > 1 << 16 else "<u2"

    def ids_of(batches):
        """Documents with their ids; last, a row without a document that holds the counts of all ids of the partition."""
        end = end_id.to_bytes(4, "little")
        coder, total = word_encoder(tokenizer_path), np.zeros(bound, dtype=np.int64)
        for batch in batches:
            docs, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slices(texts):
                coded = [np.frombuffer(x + end, "<u4").astype(kind) for x in coder.encode(texts[a:b])]
                total += np.bincount(np.concatenate(coded), minlength=bound)
                yield pa.RecordBatch.from_arrays([docs.slice(a, b - a), pa.array([x.tobytes() for x in coded], pa.binary())], ["doc_id", "ids"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["doc_id", "ids"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    stored = save(rows.mapInArrow(ids_of, "doc_id long, ids binary"), "token-ids")
    coded = stored.where("doc_id is not null")

    def counted(batches):
        total = np.zeros(bound, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    counts = np.zeros(bound, dtype=np.int64)
    for row in stored.where("doc_id is null").select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row.id] = row.n
    lengths = code_lengths(counts)

    def segments(batches):
        codes, file = canonical_codes(lengths), TaskContext.get().partitionId()
        docs, sizes, ids, held, number, before = [], [], [], 0, 0, 0

        def out():
            payload = write_segment(np.array(docs, np.int64), np.array(sizes, np.int64), np.concatenate(ids), codes, lengths)
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([held], pa.int64()), pa.array([payload], pa.binary())], ["file", "segment", "before", "n_ids", "payload"])

        for batch in batches:
            for doc, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs.append(doc)
                ids.append(np.frombuffer(x, kind))
                sizes.append(len(ids[-1]))
                held += sizes[-1]
                if held >= SEGMENT_IDS:
                    yield out()
                    docs, sizes, ids, held, number, before = [], [], [], 0, number + 1, before + held
        if docs:
            yield out()

    ordered = coded.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(segments, "file int, segment int, before long, n_ids long, payload binary").write.option("compression", "none").parquet(path)
    drop_saved(stored)


def vocab_size(tokenizer_path: str) -> int:
    return word_encoder(tokenizer_path).tokenizer.get_vocab_size()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files: one row per document with ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    stored = spark.read.schema("file int, segment int, before long, n_ids long, payload binary").parquet(path)
    # One number for each file.
    totals = dict(sorted((r.file, r.n) for r in stored.groupBy("file").agg(F.sum("n_ids").alias("n")).collect()))
    bases = dict(zip(totals, np.cumsum([0, *totals.values()]).tolist(), strict=False))

    def decode(batches):
        for batch in batches:
            for file, before, payload in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                docs, sizes, ids = read_segment(payload)
                ends = np.cumsum(sizes, dtype=np.int64)
                starts = ends - sizes
                raw = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(starts + (bases[file] + before)), pa.array(sizes.astype(np.int64)), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.select("file", "before", "payload").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_path(spark: SparkSession, name: str) -> str:
    """A new folder for token files beside the checkpoints."""
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
