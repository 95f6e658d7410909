"""Packing, token files, piece sampling: exact round trips."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from areapanel.llm import packing, piece_sampling, token_files, tokens

SCHEMA = "doc_id long, text string, length int, ids string"
BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["", " ", "\n\n", "a\x1cb  c", "x <|endoftext|> y", "Σίσυφος ΣΑΣ", "é ́a it's  \n\n x", "don't 've  'LL 12,345.67", "  two  spaces ", "İstanbul ǅ", "word" * 300, "日本語 テキスト", "a b c", "!!! ??? ..."]


def docs(n=80, seed=3):
    rnd = random.Random(seed)
    out = [(k, " ".join("".join(rnd.choice("abcdeé,") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(0, 400)))) for k in range(n)]
    return out + [(500 + k, x) for k, x in enumerate(ODD)] + [(700, None), (3, "again"), (-5, "below zero")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def coded(path, text, end):
    return np.array([*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


@pytest.mark.parametrize("make, path", [(tokens.byte_encoder, BYTE), (tokens.word_encoder, WORD)])
def test_ids_are_the_librarys(make, path):
    texts = [t for _, t in docs()]
    got = make(path).encode(texts)
    plain = Tokenizer.from_file(path)
    for t, x in zip(texts, got, strict=True):
        assert np.frombuffer(x, "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids, t


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    for make, path in ((tokens.byte_encoder, BYTE), (tokens.word_encoder, WORD)):
        coder = make(path)
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blanks", [" " * 1_100_000, "\n" * 1_100_000, " \u2003\t" * 400_000, " " * 99_999])
def test_long_runs_of_blanks(blanks):
    coder = tokens.byte_encoder(BYTE)
    for text in (blanks, f"a{blanks}b  c"):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("window, parts", [(2048, 3), (64, 7), (64, 40)])
def test_packing(spark, window, parts):
    rows = docs()
    got = packing.pack(frame(spark, rows).repartition(parts), BYTE, window=window, open_windows=4).collect()
    want: dict = {}
    for d, t in rows:
        want.setdefault(d, []).append(coded(BYTE, t, 1))
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in want[r.doc_id])
    assert by_doc.keys() == want.keys()
    for d, pieces in by_doc.items():
        assert sum(p.length for p in pieces) == sum(map(len, want[d]))
        if len(want[d]) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    for _, seq in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for p in seq:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == window or at & (at - 1) == 0
    assert packing.pack(frame(spark, []), BYTE).count() == 0


def test_token_files(spark, tmp_path):
    rows = docs()
    token_files.write_token_files(frame(spark, rows), f"file://{tmp_path}/t", WORD)
    got = token_files.read_token_files(spark, f"file://{tmp_path}/t").collect()
    assert len(got) == len(rows)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    want = sorted((d, len(x := coded(WORD, t, 2)), zlib.crc32(x.tobytes())) for d, t in rows)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted(d for d, _ in rows)
    token_files.write_token_files(frame(spark, []), f"file://{tmp_path}/e", WORD)
    assert token_files.read_token_files(spark, f"file://{tmp_path}/e").count() == 0


def best_cost(counts, limit):
    """Least total length by trying all vectors of lengths that satisfy Kraft's inequality."""
    return min(sum(c * x for c, x in zip(counts, ls)) for ls in itertools.product(range(1, limit + 1), repeat=len(counts)) if sum(2.0**-x for x in ls) <= 1)


@pytest.mark.parametrize("counts, limit", [([1, 1, 2, 3, 5], 3), ([100, 1, 1, 1, 1], 4), ([7, 7, 7], 2), ([1, 2, 4, 8, 16], 4)])
def test_lengths_are_optimal(counts, limit):
    lengths = token_files.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit and sum(2.0 ** -int(x) for x in lengths) <= 1
    assert int((lengths * np.array(counts)).sum()) == best_cost(counts, limit)


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1023, 1024, 1025, 5000):
        ids = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.uint32)
        lengths = token_files.code_lengths(np.bincount(ids, minlength=50_000))
        codes = token_files.canonical_codes(lengths)
        sizes = np.array([n])
        _, _, back = token_files.read_segment(token_files.write_segment(np.array([1]), sizes, ids, codes, lengths))
        assert (back == ids).all()
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9), 3)


def every(model, word):
    lat = piece_sampling.Lattices(model, [word])
    n, c, s, p, e, first = len(word), lat.counts, lat.steps, lat.logs, lat.pieces, lat.first

    def rest(i):
        if i == n:
            return [((), 1.0)]
        return [((int(e[k]), *tail), math.exp(p[k]) * q) for k in range(first[i], first[i] + c[i]) for tail, q in rest(i + s[k])]

    return dict(rest(0))


def test_sampling_without_replacement():
    model = piece_sampling.piece_model(PIECE, 1.0)
    chances = every(model, "▁the")
    assert abs(sum(chances.values()) - 1) < 1e-12
    keys = np.arange(20_000)
    got = piece_sampling.sample(model, ["the"] * len(keys), keys, 3, 1)
    first, second = ([tuple(x[k][0].tolist()) for x in got] for k in (0, 1))
    assert all(len({tuple(s[0].tolist()) for s in x}) == len(x) == min(3, len(chances)) for x in got)
    assert all(x[0][2] > x[1][2] > x[2][2] for x in got)
    assert all(abs(math.exp(s[1]) - chances[tuple(s[0].tolist())]) < 1e-9 for x in got for s in x)
    for ids, p in chances.items():
        assert abs(first.count(ids) / len(keys) - p) < 0.015
        q = sum(chances[o] * p / (1 - chances[o]) for o in chances if o != ids)
        assert abs(second.count(ids) / len(keys) - q) < 0.015
    # Weights of one over the inclusion estimate sums over all segmentations without bias.
    mean = np.mean([sum(math.exp(s[1] - s[3]) * len(s[0]) for s in x) for x in got])
    assert abs(mean - sum(p * len(ids) for ids, p in chances.items())) < 0.02


def test_sampling_texts_of_several_words():
    """Pairs of first and second segmentations of short texts occur as often as drawing without replacement has them."""
    model = piece_sampling.piece_model(PIECE, 0.1)
    for text in ("a on", "to Ⓐ in"):
        parts = [every(model, w) for w in model.words(text)]
        chances = {tuple(i for ids in x for i in ids): math.prod(p[ids] for p, ids in zip(parts, x, strict=True)) for x in itertools.product(*parts)}
        assert abs(sum(chances.values()) - 1) < 1e-12 and len(chances) >= 8
        plain = lambda ids: tuple(piece_sampling._with_bytes(model, np.array(ids)).tolist())
        want = {(plain(a), plain(b)): p * q / (1 - p) for a, p in chances.items() for b, q in chances.items() if a != b}
        chances = {plain(k): p for k, p in chances.items()}
        keys = np.arange(20_000)
        got = piece_sampling.sample(model, [text] * len(keys), keys, 3, 9)
        seen = Counter((tuple(x[0][0].tolist()), tuple(x[1][0].tolist())) for x in got)
        assert seen.keys() <= want.keys()
        for pair, p in want.items():
            assert abs(seen[pair] / len(keys) - p) < 5 * math.sqrt(p / len(keys)) + 1e-4
        assert all(len({tuple(s[0].tolist()) for s in x}) == 3 and x[0][2] > x[1][2] > x[2][2] for x in got)
        assert all(abs(math.log(chances[tuple(s[0].tolist())]) - s[1]) < 1e-9 for x in got for s in x)
        # The first values have a Gumbel law: mean 0.5772, and the inclusion weights sum to one without bias.
        assert abs(np.mean([x[0][2] for x in got]) - 0.5772) < 0.03
        assert abs(np.mean([sum(math.exp(s[1] - s[3]) for s in x) for x in got]) - 1) < 0.02
    few = piece_sampling.sample(model, ["a"], np.array([5]), 50, 1)[0]
    assert len(few) == len(every(model, "▁a")) and all(s[3] == 0 for s in few)


def test_sampling_query(spark):
    rows = [(d, t) for d, t in docs(20) if d != 3] + [(800, "x" * 200), (801, "▁ mark"), (None, "no id")]
    run = lambda parts: piece_sampling.sampled_segmentations(frame(spark, rows).repartition(parts), PIECE, n=3).collect()
    got = run(3)
    assert all(r.round_trip for r in got if r.doc_id != 801)
    assert {r.doc_id for r in got} == {d for d, _ in rows if d is not None}
    assert len({(r.doc_id, r.ids_crc32) for r in got}) == len(got)
    assert all(r.log_chance - 1e-6 <= r.log_inclusion <= 0 for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, run(5)))
    assert piece_sampling.sampled_segmentations(frame(spark, []), PIECE).count() == 0
