"""Exact dedup, fill-in-the-middle and the conversation trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from areapanel.llm import exact_dedup, fill_middle, prefix_trie, queries

SCHEMA = "doc_id long, text string, keep_id string, n int, output string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- exact dedup ---------------------------------------------------------------------------------


def copies(seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["hot"] * 5 + ["warm", "", None, " ", "Hot"] + [f"t{rnd.randint(0, 40)}"] * 3)) for i in range(400)]
    return rows + [(1000 + i, "w" * 300_000 + "é" * (i % 2)) for i in range(4)] + [(None, "hot"), (None, "only null id"), (None, "only null id"), (5000, "same row"), (5000, "same row")]


def groups(rows):
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    return by


@pytest.mark.parametrize("counters, most", [(8192, 4096), (16, 2), (128, 1)])
def test_exact_copies(spark, counters, most):
    """Whatever the summary finds, the result is the same."""
    rows = copies()
    got = exact_dedup.exact_dedup(frame(spark, rows), counters=counters, most=most).collect()
    by = groups(rows)
    assert len(got) == len(rows)
    texts = {sha(t): t for t in by}
    stays = defaultdict(list)
    for r in got:
        ids = by[texts[r.text_sha256]]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
        if r.kept:
            stays[r.text_sha256].append(r.doc_id)
    assert {texts[h]: ids for h, ids in stays.items()} == {t: [max((i for i in ids if i is not None), default=None)] for t, ids in by.items()}


def test_frequent_digests_are_found(spark):
    """What holds over 7 / map of the rows is a winner, and nothing that occurs once is."""
    rows = [(i, "a" if i < 900 else "b" if i < 1200 else f"t{i}") for i in range(3000)]
    won = exact_dedup.frequent(exact_dedup.digests(frame(spark, rows)), counters=64, most=8).collect()
    assert {(r.text_sha256, r.group_size, r.keep_id) for r in won} == {(sha("a"), 900, 899), (sha("b"), 300, 1199)}


def test_rows_without_copies(spark):
    rows = copies()
    kept = exact_dedup.without_copies(frame(spark, rows))
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(((max((i for i in ids if i is not None), default=None), t) for t, ids in groups(rows).items()), key=repr)
    assert exact_dedup.without_copies(frame(spark, rows).where("false")).count() == 0


# --- fill in the middle --------------------------------------------------------------------------


def plainly(doc_id, text):
    """The contract, character by character."""
    text, n = text or "", len(text or "")
    x = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(x[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h4 % 100 < 20 else "psm"
    return (n, form, a, b - a, sha(f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"), sha(text))


def odd_texts():
    rnd = random.Random(2)
    shared = "".join(rnd.choice("abcé日🙂 \n") for _ in range(5000))
    texts = ["", None, "a", "é", "🙂" * 3000, "x" * 20_000, shared, shared[7:], "y" + shared, shared + "z" * 70, "has <P> in it", "<", "P>", "a<" * 500, "<P", "S><M", "\x00\x01", shared * 300]
    texts += ["q" * k + "<S>" + "r" * 100 for k in (61, 62, 63, 64, 65, 4093, 4094, 4095, 4096)]  # marks where chunks end
    return texts + [shared[k : k + rnd.randint(0, 3000)] for k in rnd.sample(range(4000), 60)]


def test_forms_equal_the_contract(spark):
    texts = odd_texts()
    rows = [(k * 37 + j, t) for j in range(3) for k, t in enumerate(texts)] + [(None, "a null id"), (5, texts[6]), (5, texts[6])]
    got = fill_middle.fill_in_middle_digests(frame(spark, rows)).collect()
    assert sorted(map(repr, ((r.doc_id, *tuple(r)[1:]) for r in got))) == sorted(map(repr, ((i, *plainly(i, t)) for i, t in rows)))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_forms_equal_sql(spark):
    rows = [(k, t) for k, t in enumerate(odd_texts()) if t is None or "\x00" not in t]
    documents = pa.table({"doc_id": [i for i, _ in rows], "text": pa.array([t for _, t in rows], pa.string())})  # noqa: F841
    want = duckdb.sql(queries.OP11_SQL)
    got = fill_middle.fill_in_middle_digests(frame(spark, rows)).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab<PSM>é🙂", max_size=40), min_size=1, max_size=12), st.lists(st.integers(0, 11), min_size=1, max_size=400))
def test_chunked_text_counts_characters(parts, order):
    """A text built of repeated parts: length, marks and places of characters, through one memory of chunks."""
    chunks = fill_middle.Chunks()
    texts = ["".join(parts[k % len(parts)] for k in order), "".join(parts[k % len(parts)] for k in reversed(order))]
    for text, t in zip(texts, fill_middle.texts([x.encode() for x in texts], chunks), strict=True):
        assert len(t) == len(text) and t.marked == any(m in text for m in fill_middle.MARKS)
        for k in range(0, len(text) + 1, 7):
            assert t.byte_of(k) == len(text[:k].encode())


def test_chunks_follow_content_and_memory_is_bounded(monkeypatch):
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(60_000)).encode()
    ends = lambda raw: [e for t in fill_middle.texts([b"before" * 50, raw], fill_middle.Chunks()) if t.raw == raw for e in [*t.starts[1:], len(raw)]]
    a, b = ends(base), ends(b"xyz" + base)
    common = {e + 3 for e in a} & set(b)
    assert len(common) > 0.9 * len(a) and max(x - y for x, y in zip(a[1:], a, strict=False)) <= fill_middle.LONGEST
    monkeypatch.setattr(fill_middle, "CACHE_BYTES", 20_000)
    chunks = fill_middle.Chunks()
    for k in range(200):
        chunks.of(b"%d" % k * 200)
        assert sum(map(len, [*chunks.new, *chunks.old])) <= 20_000 + 1000


# --- conversation trie ---------------------------------------------------------------------------

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(rows):
    """Plain trie of rebuilt conversations."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort()
    base = lambda c: c - (c % 5 if c >= 0 else -(-c % 5))
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(x[2:] for x in own.get(base(c), [])[:h]) + tuple(x[2:] for x in own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for s in members:
        if s:
            children[s[:-1]] += 1
    for s in members:
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0
            leaves[s[:d]] += children[s] == 0
    return sorted((repr((m[0], len(s), members[s[:-1]][0] if s else None, len(m), children[s], leaves[s], saved[s], sha(",".join(map(str, ends[s]))))) for s, m in members.items()))


def talks(seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(-12, 40), 50, 57, 2**40]:
        if rnd.random() < 0.8:
            rows += [(c, rnd.choice([t, t, t, None]), rnd.choice(["u", "u", None]), rnd.choice(["a", "a", "a", "", None, "é"])) for t in range(rnd.choice([1, 2, 3, 9, 12]))]
    rows += [(c, i, "u", "x") for c in (100, 107) for i in range(150)] + [(c, i, "s", f"hello {i}") for c in range(200, 280) for i in range(2)]
    return rows + [(None, 1, "u", "a")] * 5 + [(300, 1, "u", "long" * 50_000), (305, 1, "u", "long" * 50_000), (301, 2, "u", "twice"), (301, 2, "u", "twice")]


CONVS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("width", [None, 1 << 16])
def test_trie_equals_plain_one(spark, monkeypatch, width):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows = talks()
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], CONVS + ", depth string, k1 int").repartition(6)
    assert sorted(repr(tuple(r[c] for c in TRIE)) for r in prefix_trie.prefix_trie(df, width).collect()) == trie(rows)


def test_crowded_sketch_changes_nothing(spark, monkeypatch):
    """A sketch that proves next to nothing: all prefixes are grouped."""
    monkeypatch.setattr(prefix_trie, "SLICE", 16)
    rows = talks(4)
    df = spark.createDataFrame(rows, CONVS)
    assert sorted(repr(tuple(r[c] for c in TRIE)) for r in prefix_trie.prefix_trie(df, 32).collect()) == trie(rows)


def test_sketch_is_never_too_small(spark):
    df = spark.createDataFrame([(i, i % 3, k, -k, 0, 0, 1) for i, k in enumerate([7, 7, 7, 8, 9, 9, *range(100, 400)])], "c long, depth long, k1 long, k2 long, p1 long, p2 long, bytes long")
    out = prefix_trie.screened(df, 1 << 16).collect()
    assert all(not r.alone for r in out if r.k1 in (7, 9)) and sum(r.alone for r in out) > 250


def test_empty_trie(spark):
    df = spark.createDataFrame([], CONVS)
    assert prefix_trie.prefix_trie(df).collect() == []
