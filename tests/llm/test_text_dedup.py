"""SimHash near-dedup, suffix dedup and licences against brute force."""

import hashlib
import os
import random
import re
import textwrap
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from areapanel.llm import licenses, simhash, suffix_dedup
from areapanel.llm.common import connected_components

SCHEMA = "doc_id long, text string, fp string, spans int"


def texts(seed=5, n=120):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    line = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    shared = [line(30) for _ in range(4)]
    docs = []
    for k in range(n):
        parts = [line(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared)
            a = rnd.randint(0, len(p) // 2)
            parts += [p[a : a + rnd.randint(10, len(p))], line(rnd.randint(0, 20))]
        docs.append((k, " ".join(parts)))
    docs += [(k + 200, t.upper().replace("A", "b", 1)) for k, t in docs[:10]]
    return docs + [(900, None), (901, ""), (902, " \n"), (903, "a" * 500), (904, "a" * 90), (905, docs[3][1]), (905, docs[3][1]), (906, "ab" * 200), (907, "one two")]


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)


def fingerprint(text):
    w = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("tile_rows", [1024, 2])
def test_simhash(spark, tile_rows):
    docs = texts()
    got = simhash.near_duplicates(frame(spark, docs), tile_rows=tile_rows).collect()
    fps = {d: fingerprint(t) for d, t in docs}
    parent = {d: d for d in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 4 and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert len(got) == len(docs)
    assert all(r.fingerprint == format(fps[r.doc_id], "016x") and r.component_id == find(r.doc_id) and r.kept == (find(r.doc_id) == r.doc_id) for r in got)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def shingles(text, n=5):
    w = text.lower().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}


def test_wide_simhash_finds_near_copies(spark):
    """Of texts that share 0.82 or more of their five-word shingles nearly all link, of those below 0.6 none."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("abcdefghiklmnorstu", k=rnd.randint(2, 8)))
    docs, pairs = [], []
    for k in range(120):
        base = [word() for _ in range(rnd.randint(60, 500))]
        other = list(base)
        for at in rnd.sample(range(len(base)), max(1, round(len(base) * (0.005, 0.015, 0.08)[k % 3]))):
            other[at] = word()
        docs += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
        a, b = (shingles(" ".join(x)) for x in (base, other))
        pairs.append((2 * k, len(a & b) / len(a | b)))
    docs += [(900, ""), (901, None), (902, "one two"), (903, "One  TWO")]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, docs), **corpus_pipeline.NEAR).collect()}
    near, far = [k for k, j in pairs if j >= 0.82], [k for k, j in pairs if j < 0.6]
    assert len(near) > 50 and len(far) > 30
    assert sum(got[k + 1] == k for k in near) >= 0.97 * len(near) and all(got[k + 1] == k + 1 for k in far)
    assert got[900] == got[901] == 900 and got[902] == got[903] == 902


def test_wide_fingerprint_starts_with_the_narrow_one():
    rnd = random.Random(9)
    for n in (0, 1, 5, 258, 259, 260, 600):
        text = " ".join(str(rnd.randint(0, 99)) for _ in range(n)).encode()
        wide = simhash.wide_fingerprint(text, bits=512)
        assert len(wide) == 8 and int(wide[0]) == simhash.fingerprint(text) == fingerprint(text.decode())


def test_half_ranges_are_exact():
    for d in range(-4, 5):  # tiles further apart never meet
        for x in range(-8, 9):
            lo, hi = simhash._half_range(d, 4)
            assert (abs(x) + abs(d - x) <= 4) == (lo <= x <= hi)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(50)] + [(100, 101), (7, 7), (None, 3), (200, 199)]
    got = {r.id: r.component_id for r in connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 101: 100, 199: 199, 200: 199}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def removed(docs, length):
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for d, b in data:
        cover = np.zeros(len(b), dtype=int)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                cover[p : p + length] = 1
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((d, len(b), int(cover.sum()), int((np.diff(cover, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def without_passages(docs, words):
    """Texts without repeated runs of words, the number of runs and their bytes."""
    split = [[(m.group().lower(), *m.span()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", (t or "").encode())] for _, t in docs]
    seen = Counter(tuple(x[0] for x in w[p : p + words]) for w in split for p in range(len(w) - words + 1))
    out = []
    for (d, t), w in zip(docs, split, strict=True):
        cover = np.zeros(len(w) + 1, dtype=int)
        for p in range(len(w) - words + 1):
            if seen[tuple(x[0] for x in w[p : p + words])] > 1:
                cover[p : p + words] = 1
        raw, left, at, gone = (t or "").encode(), b"", 0, 0
        edges = np.flatnonzero(np.diff(cover, prepend=0))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            left, at, gone = left + raw[at : w[a][1]], w[b - 1][2], gone + w[b - 1][2] - w[a][1]
        out.append((d, None if t is None else (left + raw[at:]).decode(), len(edges) // 2, gone))
    return out


@pytest.mark.parametrize("length, words, hot", [(40, 9, 8192), (24, 4, 8192), (41, 12, 2)])
def test_suffix_dedup(spark, monkeypatch, length, words, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_CLASSES", hot)
    docs = texts()
    got = sorted(map(tuple, suffix_dedup.suffix_dedup(frame(spark, docs), length=length, words=words).collect()))
    passages = sorted((d, n, size) for d, _, n, size in without_passages(docs, words))
    assert [r[:5] for r in got] == removed(docs, length)
    assert sorted((r[0], *r[5:]) for r in got) == passages and any(n for _, n, _ in passages)
    assert sorted(map(tuple, suffix_dedup.suffix_dedup(frame(spark, docs), length=length).collect())) == [r[:5] for r in got]


def test_suffix_dedup_with_production_sizes(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("etaoins", k=rnd.randint(1, 9)))
    line = lambda k: " ".join(word() for _ in range(k))
    short, long = [line(51) for _ in range(3)], [line(140) for _ in range(3)]
    docs = [(k, f"{line(20)} {rnd.choice(short)} {line(9)} {rnd.choice(long)}") for k in range(30)]
    docs += [(k + 100, f"{line(30)}\n{short[0].upper().replace(' ', '  ')}\n{line(k)}") for k in range(5)]
    docs += [(k + 200, line(80)) for k in range(20)] + [(300, line(49) + " x"), (301, "a" * 400), (302, "a" * 399), (303, "ab " * 60)]
    got = sorted(map(tuple, suffix_dedup.suffix_dedup(frame(spark, docs), length=400, words=51).collect()))
    assert [r[:5] for r in got] == removed(docs, 400)
    want = without_passages(docs, 51)
    assert [(r[0], *r[5:]) for r in got] == sorted((d, n, size) for d, _, n, size in want)
    left = suffix_dedup.without_repeats(frame(spark, docs), length=51, unit="words")
    assert {r.doc_id: r.text for r in left.collect()} == {d: t for d, t, *_ in want}


def test_suffix_dedup_of_very_long_texts(spark):
    rng = np.random.default_rng(4)
    long = bytes(rng.integers(97, 123, 1_400_000, dtype=np.uint8)).decode()  # more than one chunk of anchors
    docs = [(1, long), (2, "?" * 500 + long[1_048_000:1_049_500] + "!" * 50), (3, long[700_000:700_400]), (4, long[5:404])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.suffix_dedup(frame(spark, docs)).collect()}
    assert got == {1: (1900, 2), 2: (2000, 1), 3: (400, 1), 4: (0, 0)}


def test_suffix_dedup_of_empty_table_and_extra_columns(spark):
    assert suffix_dedup.suffix_dedup(frame(spark, []), words=51).count() == 0
    left = suffix_dedup.without_repeats(frame(spark, [(1, "é" * 30 + "x"), (2, "é" * 30 + "y"), (3, None)]), length=41)
    assert left.columns == ["doc_id", "text", "fp", "spans"]
    assert {r.doc_id: r.text for r in left.collect()} == {1: "x", 2: "y", 3: None}
    names = ["_id", "doc_id", "id", "mark", "spans", "row", "text", "_text", "a.b"]
    same = spark.createDataFrame([("k", 1, 7, 8, 9, 10, "a b", "t", 5), ("l", 2, 7, 8, 9, 10, "A  B c", "t", 6), ("m", None, 7, 8, 9, 10, "a b", "t", 6)], "_id string, doc_id long, id int, mark int, spans int, row int, text string, _text string, `a.b` int")
    out = suffix_dedup.without_repeats(same, length=2, unit="words")
    assert out.columns == names and out.dtypes == same.dtypes
    assert sorted(map(tuple, out.collect())) == [("k", 1, 7, 8, 9, 10, "", "t", 5), ("l", 2, 7, 8, 9, 10, " c", "t", 6)]
    assert suffix_dedup.without_repeats(same.where("false")).count() == 0


@pytest.mark.parametrize("pairs", [64, 2])
def test_windows_shared_by_contexts(monkeypatch, pairs):
    monkeypatch.setattr(suffix_dedup, "PAIRS", pairs)
    rnd = random.Random(2)
    length, gram = 12, 6
    left = [bytes(rnd.choices(b"ab", k=rnd.randint(0, length - gram))) for _ in range(200)]
    group = np.sort(np.array([rnd.randint(0, 30) for _ in range(200)]))
    right = [b"anchor" + bytes(rnd.choices(b"ab", k=rnd.randint(0, length - gram))) for _ in range(200)]
    arrays = [[np.frombuffer(x, np.uint8) for x in part] for part in (left, right)]
    most, fewest = suffix_dedup.repeated_windows(*arrays, group, length)
    for i in range(200):
        hits = []
        for a in range(len(left[i]) + 1):
            w = (left[i] + right[i])[len(left[i]) - a :][:length]
            if len(w) == length and any(j != i and group[j] == group[i] and a <= len(left[j]) and (left[j] + right[j])[len(left[j]) - a :][:length] == w for j in range(200)):
                hits.append(a)
        assert (most[i], fewest[i]) == ((max(hits), min(hits)) if hits else (-1, length + 1))


def test_hash_collisions_are_noticed(monkeypatch):
    monkeypatch.setattr(suffix_dedup.PrefixHashes, "of", lambda self, start, length: np.zeros(len(start), dtype=np.uint64))
    order, lcp = suffix_dedup._sorted([np.frombuffer(x, np.uint8) for x in (b"abc", b"abd", b"ab", b"x")], np.array([0, 0, 0, 1]), False)
    assert order.tolist() == [2, 0, 1, 3] and lcp.tolist() == [0, 2, 2, 0]


def test_licenses(spark):
    mit = licenses.LICENSES[0][1]
    docs = [(1, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ,")), (2, "prose\nlicensed under CC BY-NC 4.0\nReleased under the MIT Licence!"), (3, None), (4, ""), (5, "(c) me"), (6, mit + " more"), (None, mit), (7, "released under the MIT license"), (7, "prose"), (8, "x\n" + mit.replace("\n", " "))]
    got = {r.doc_id: r for r in licenses.license_scan(frame(spark, docs)).collect()}
    want = {1: ("MIT", "", 0), 2: (None, "CC-BY-NC-4.0,MIT", 2), 3: (None, "", 0), 4: (None, "", 0), 5: (None, "", 0), 6: (None, "", 0), 8: (None, "MIT", 1)}
    assert {k: (r.license, r.notices, r.n_notices) for k, r in got.items() if k != 7} == want
    assert sorted((r.license or "", r.notices) for r in licenses.license_scan(frame(spark, docs)).where("doc_id = 7").collect()) == [("", "MIT"), ("MIT", "MIT")]
    assert licenses.license_scan(frame(spark, [])).count() == 0


@pytest.mark.parametrize("name, file", [("Apache-2.0", "Apache-2.0"), ("GPL-3.0", "GPL-3"), ("GPL-2.0", "GPL-2"), ("LGPL-2.1", "LGPL-2.1"), ("MPL-2.0", "MPL-2.0"), ("BSD-3-Clause", "BSD")])
def test_whole_licenses(spark, name, file):
    path = f"/usr/share/common-licenses/{file}"
    if not os.path.exists(path):
        pytest.skip("no licence texts on this machine")
    with open(path) as f:
        text = f.read()
    docs = [(1, text), (2, "Copyright 2021 Me\n" + text.upper()), (3, text.replace("\n", "\r\n").replace("  ", "\t ")), (4, text + " and more"), (5, text[:-9])]
    got = {r.doc_id: r.license for r in licenses.license_scan(frame(spark, docs)).collect()}
    assert got == {1: name, 2: name, 3: name, 4: None, 5: None}


def license_files():
    """Texts as repositories carry them: (expected id, text)."""
    by = {}
    for name, text in licenses.LICENSES:
        by.setdefault(name, text)
    wrap = lambda text: "\n\n".join(textwrap.fill(part, 78) for part in text.split("\n"))
    holder = "Copyright (c) 2021 Some Body. All rights reserved.\n\n"
    acme = by["BSD-3-Clause"].replace("the copyright holder nor", "Acme Corp, Inc. nor")
    stars = wrap(acme).replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    return [
        ("MIT", f"MIT License\n\n{holder}{wrap(by['MIT'])}\n"), ("MIT", f"The MIT License (MIT)\n\n{holder}{wrap(by['MIT'])}"), ("MIT", f"{holder}{wrap(by['MIT'])}"), ("MIT", f"# The MIT License\r\n{holder}{by['MIT']}"),
        ("ISC", f"ISC License\n\n{holder}{wrap(by['ISC'])}"), ("0BSD", f"BSD Zero Clause License\n\n{holder}{wrap(by['0BSD'])}"), ("BSD-3-Clause", f"BSD 3-Clause License\n\n{holder}{wrap(by['BSD-3-Clause'])}"),
        ("BSD-3-Clause", f"{holder}{wrap(acme)}"), ("BSD-3-Clause", f"BSD 3-Clause License\n{holder}{stars}"), ("BSD-2-Clause", f"The BSD 2-Clause License\n{holder}{wrap(by['BSD-2-Clause']).replace('COPYRIGHT HOLDERS', 'AUTHORS')}"),
        (None, "MIT License"), (None, f"MIT License\nmore\n{by['MIT']}"), (None, f"{by['MIT']}\nMIT License"), (None, f"{wrap(by['BSD-3-Clause'])} and one thing more"),
    ]


def test_license_files(spark):
    files = license_files()
    got = {r.doc_id: r.license for r in licenses.license_scan(frame(spark, [(k, t) for k, (_, t) in enumerate(files)])).collect()}
    assert got == {k: want for k, (want, _) in enumerate(files)}


def test_license_sql_agrees(spark):
    rnd = random.Random(1)
    bits = ["Copyright", "(c) ", "©", "\n", "\r\n", " ", "\t", "All Rights Reserved", "Licence", "non-commercial", "Sub-License", "http://x", "&", "«a»", "…", "word", "É", "\n \t(C) x\n", "'", "`", "{|}", "Licensed under CC BY 4.0"]
    docs = [(k, "".join(rnd.choices(bits, k=rnd.randint(0, 30)))) for k in range(300)] + [(400, None)] + [(500 + k, t) for k, (_, t) in enumerate(license_files())]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    want = sorted(con.execute(licenses.license_sql()).fetchall(), key=lambda r: r[0])
    assert sorted((tuple(r) for r in licenses.license_scan(frame(spark, docs)).collect()), key=lambda r: r[0]) == want


def test_links_are_confirmed(spark, monkeypatch):
    """Every document that goes is linked by texts of 0.8 or more, and every such pair is in one class."""
    monkeypatch.setattr(simhash, "GROUP", 3)  # a text with many links is dealt to groups
    rnd = random.Random(21)
    vocabulary = [f"w{k}" for k in range(3000)]
    docs = []
    for base in range(25):
        words = rnd.choices(vocabulary, k=rnd.randint(60, 400))
        docs.append(" ".join(words))
        for _ in range(rnd.choice([1, 1, 2, 12])):
            copy = list(words)
            for _ in range(max(1, int(len(words) * rnd.choice([0.005, 0.02, 0.03, 0.045, 0.06])))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            docs.append(" ".join(copy))
    docs += ["", None, "one", "One ", "two words", docs[0].upper()]
    rows = list(enumerate(docs))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, rows), **corpus_pipeline.NEAR).collect()}
    sets = {i: set(simhash.shingles((t or "").encode(), 5).tolist()) for i, t in rows}
    near = {(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))}
    plain = {i: i for i in sets}
    for _ in sets:
        for a, b in near:
            plain[a] = plain[b] = min(plain[a], plain[b])
    assert all(plain[i] == plain[c] for i, c in got.items())  # nothing is joined that exact links don't join
    linked = [(a, b) for a, b in near if got[a] == got[b]]
    assert len(linked) >= 0.98 * len(near)


def plain_classes(docs, near=corpus_pipeline.NEAR):
    """Components of all links: every pair within both radii whose shingles agree, ids that occur again taken together."""
    n = near["words"]
    fps = np.array([simhash.wide_fingerprint((t or "").encode(), n, bits=near["bits"]) for _, t in docs])
    sets = [shingles(t or "", n) if (t or "").split() else set() for _, t in docs]
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, _) in enumerate(docs):
        bits = np.bitwise_count(fps ^ fps[i])
        for j in np.flatnonzero((bits[:, 0] <= near["radius"]) & (bits.sum(axis=1) <= near["total_radius"])).tolist():
            a, b = find(d), find(docs[j][0])
            if a != b and (sets[i] == sets[j] or len(sets[i] & sets[j]) >= near["least"] * len(sets[i] | sets[j])):
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in docs}


@pytest.mark.parametrize("group, size, tile_rows", [(1024, 32 << 20, 1024), (6, 32 << 20, 1024), (1024, 1 << 14, 2)])
def test_classes_are_those_of_all_links(spark, monkeypatch, group, size, tile_rows):
    """Chains, stars and look-alikes of several sources, in one block and in many."""
    monkeypatch.setattr(simhash, "GROUP", group)
    monkeypatch.setattr(simhash, "GROUP_BYTES", size)
    rnd = random.Random(17)
    word = lambda: f"w{rnd.randrange(5000)}"
    docs = []
    for source in range(6):
        texts_ = [[word() for _ in range(rnd.randint(80, 250))]]
        for _ in range((3, 12, 60)[source % 3]):
            copy = list(rnd.choice(texts_[-3:]) if source < 3 else texts_[0])  # a chain, a star
            for p in rnd.sample(range(len(copy)), max(1, round(len(copy) * rnd.choice([0.01, 0.02, 0.025, 0.03])))):
                copy[p] = word()
            texts_.append(copy)
        docs += [" ".join(x) for x in texts_]
    docs += ["", None, " \n", "one", "One ", "two words", docs[0].upper(), docs[9]]
    rnd.shuffle(docs)
    rows = [*enumerate(docs), (3, docs[5]), (3, docs[5]), (4, docs[70])]
    want = plain_classes(rows)
    got = simhash.near_duplicates(frame(spark, rows), **corpus_pipeline.NEAR, tile_rows=tile_rows).collect()
    assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == want
    sizes = Counter(want.values())
    assert len(sizes) > 20 and max(sizes.values()) > 20


def test_no_link_is_lost_among_look_alikes(spark):
    """Two texts of one set of shingles, each with 40 texts of nearer fingerprints and other shingles beside it."""
    rnd = random.Random(29)
    line = lambda k: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(k)) + " "
    base, tail = line(40) * 20, line(100)
    docs = [base + tail, base + tail * 5]
    docs += [base + line(100) for _ in range(40)] + [base + tail * 5 + line(250) for _ in range(40)]
    rows = list(enumerate(docs))
    fps = [simhash.wide_fingerprint(t.encode(), 5, bits=512) for t in docs]
    far = lambda a, b: int(np.bitwise_count(fps[a] ^ fps[b]).sum())
    assert len({int(np.bitwise_count(x[0])) // 16 for x in fps}) == 1  # all in one tile
    assert all(sum(far(a, k) < far(0, 1) <= 88 for k in range(2, 82)) >= 40 for a in (0, 1))
    want = plain_classes(rows)
    assert want == {k: max(0, k - 1) if k < 2 else k for k in range(82)}
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, rows), **corpus_pipeline.NEAR).collect()} == want


def test_equal_fingerprints_need_equal_shingles(spark):
    """A text that one passage outvotes has the fingerprint of the passage and stays all the same."""
    rnd = random.Random(4)
    line = lambda k: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(k)) + " "
    docs = ["a " * 30, "a " * 30 + "b c d e", "a " * 50, "A " * 30 + "B C d e", "a " * 40 + line(9)]
    fps = {tuple(simhash.wide_fingerprint(t.encode(), 5, bits=512)) for t in docs}
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, list(enumerate(docs))), **corpus_pipeline.NEAR).collect()}
    assert len(fps) == 1 and got == {0: 0, 1: 1, 2: 0, 3: 1, 4: 4}


def test_merged_labels_are_components():
    for seed in range(100):
        rng = np.random.default_rng(seed)
        labels, plain = np.arange(40), list(range(40))
        for _ in range(5):
            i, j = rng.integers(0, 40, 6), rng.integers(0, 40, 6)
            labels = simhash._merge(labels, i, j)
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                low, high = sorted((plain[x], plain[y]))
                plain = [low if p == high else p for p in plain]
            assert labels.tolist() == plain


def test_closest_rows():
    rng = np.random.default_rng(5)
    for m in (0, 1, 50, 3000):
        i, j, far = rng.integers(0, 20, m), rng.integers(0, 300, m), rng.integers(0, 90, m)
        far = (i * 7 + j) % 90  # a pair has one distance
        got = sorted(zip(*(x.tolist() for x in simhash._closest(i, j, far)), strict=True))
        pairs = sorted({(a, d, b) for a, b, d in zip(i.tolist(), j.tolist(), far.tolist(), strict=True)})
        assert got == sorted((a, b, d) for k in range(20) for a, d, b in [x for x in pairs if x[0] == k][: simhash.NEAREST])


def test_copies_that_only_resemble_their_source(spark):
    """Copies share 0.8 with one text and less with one another; chance makes some copies look nearer."""
    rnd = random.Random(31)
    words = [f"w{rnd.randrange(9000)}" for _ in range(300)]
    rows = [(0, " ".join(words))]
    for k in range(1, 400):
        copy = list(words)
        for p in rnd.sample(range(10, 290, 10), 6):
            copy[p] = f"x{rnd.randrange(9000)}"
        rows.append((k, " ".join(copy)))
    got = simhash.near_duplicates(frame(spark, rows), **corpus_pipeline.NEAR)
    assert got.where("component_id = 0").count() >= 0.99 * len(rows)


def test_many_equal_rows(spark):
    """Rows of one id and text give one list of spans, as long as two such rows do, and the same bytes go."""
    rnd = random.Random(7)
    text = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) + str(rnd.randint(0, 99)) for _ in range(300))
    other = text[500:1400] + " and then something else " * 5
    few, many = ([(1, text)] * n + [(2, other), (3, "short"), (4, None)] for n in (2, 3000))

    def spans(rows):
        docs = frame(spark, rows).selectExpr("doc_id", "xxhash64(cast(coalesce(text, '') as binary)) as mark", "cast(coalesce(text, '') as binary) as text")
        found, hot = suffix_dedup.repeated_spans(docs, [("bytes", 400), ("words", 51)])
        return {r.doc_id: sorted(map(tuple, r.spans)) for r in found.collect()}, {r.doc_id for r in hot.collect()}

    (a, _), (b, hot) = spans(few), spans(many)
    assert a == b and 1 in hot
    out = [{tuple(r) for r in suffix_dedup.suffix_dedup(frame(spark, rows), words=51).collect()} for rows in (few, many)]
    assert out[0] == out[1] and len(out[0]) == 4
    assert suffix_dedup.suffix_dedup(frame(spark, many), words=51).where("doc_id = 1").count() == 3000
