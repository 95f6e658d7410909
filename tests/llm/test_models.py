"""Toxicity, language model and the pipeline on small corpora."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from areapanel.llm import ngram_lm, toxicity

from test_text_dedup import without_passages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def corpus(n=600, seed=4):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghilmnorst") for _ in range(rnd.randint(2, 8))) for _ in range(500)]
    bad = ["nastyword", "vileness", "scumbag"]
    docs, labels = [], []
    for k in range(n):
        ws = [rnd.choice(words) for _ in range(rnd.randint(5, 80))]
        toxic = k % 8 == 0
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                ws.insert(rnd.randrange(len(ws)), rnd.choice(bad))
        docs.append((k, " ".join(ws) + ".", "en", "s", 1, "x"))
        labels.append((k, 1, int(toxic)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = corpus()
    extra = [(9000, None, "en", "s", 1, "x"), (9001, "", "en", "s", 1, "x"), (9002, docs[0][1], "en", "s", 1, "x"), (9002, docs[0][1], "en", "s", 1, "x"), (None, "x", "en", "s", 1, "x")]
    d, y = spark.createDataFrame(docs + extra, SCHEMA), spark.createDataFrame([*labels, (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(d, y).collect()
    assert len(got) == len(docs) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    truth = {k: t for k, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(truth[r.doc_id] == r.predicted for r in held) / len(held) > 0.97
    low = {r.doc_id: r.score for r in got}
    assert low[9000] == low[9001] < 0.2
    none = toxicity.toxicity(d, y.limit(0)).collect()
    assert len(none) == len(got) and all(r.score == 0 for r in none)
    assert toxicity.toxicity(d.limit(0), y).count() == 0
    kept = toxicity.score(d, toxicity.fit(d, y))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "predicted"] and kept.count() == len(docs) + 5


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rnd = random.Random(1)
    terms = ["idiot", "moron", "worthless", "scum", "abc"]
    lexicon = toxicity.FuzzyLexicon(terms)
    for _ in range(3000):
        word = list(rnd.choice(terms))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(word) + 1)
            word[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x", "o", "i"])
        word = "".join(word)
        near = [(d, t) for t in terms if (d := distance(word, t)) <= toxicity.edits(len(t))]
        assert lexicon.match(word) == min(near, default=None)
    assert toxicity.FuzzyLexicon(["lowei*"]).match("loweizzz") == (0, "lowei*")


def test_context():
    k = 'he said " you idiot " today'.split()
    assert toxicity.context(k, 4) == "quoted" and toxicity.context("what an idiot".split(), 2) == "plain" and toxicity.context("you are an idiot".split(), 3) == "direct"


def test_copies_count_alike_in_toxic_and_clean_rows(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdefghilmnorst") for _ in range(rnd.randint(3, 8))) for _ in range(500)]
    some = lambda: " ".join(rnd.choice(words) for _ in range(30))
    rows = [(f"{some()} nastyword {some()}", 1) for _ in range(60)] + [(f"{some()} go away vileness of ours {some()}", 1) for _ in range(60)]
    rows += [(some(), 0) for _ in range(600)]
    rows += [(f'{some()} they said " nastyword " today', 0)] * 400 + [(f"{some()} rareword {some()}", 1)] * 100
    rows += [(" ".join(w if k != cut else rnd.choice(words) for k, w in enumerate(base)), 1) for base in [f"{some()} closeword {some()}".split()] for cut in rnd.choices(range(30), k=100)]
    docs = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    near = {t for t in ("nastyword", "vileness", "rareword", "closeword") if any(t == x or x.endswith("*") and t.startswith(x[:-1]) for x in model.terms)}
    assert near == {"nastyword", "vileness"}
    new = {"direct": "you are nastyword indeed", "phrase": f"{some()} go away vileness of ours", "clean": f"{some()} rareword"}
    got = {k: model.score(*toxicity.Matcher(model.terms)(x)) for k, x in new.items()}
    assert got["direct"] > 0.7 and got["phrase"] > 0.7 and got["clean"] < 0.3


def test_order_of_quoted_and_abusive_words():
    filler = " ".join(f"w{k}" for k in range(20))
    quoted, abuse, near = 'they said " vileness " today', "you are vileness yourself", "you are vilenes yourself"
    match = toxicity.Matcher(["vileness"])
    _, alone = match(f"{filler} {filler} {abuse}")
    _, first = match(f"{quoted} {filler} {abuse}")
    _, last = match(f"{abuse} {filler} {quoted} {filler} {quoted}")
    assert alone == {"vileness": 1} and first == last == {"vileness": 1, "0 quoted word": 1}
    assert match(f'{quoted.replace("vileness", "vilenes")} {filler} {near} {filler} {near}')[1] == {"1 quoted word": 1, "1 direct word": 1}
    model = toxicity.ToxicityModel(["vileness"], {"vileness": (1e-6, 0.5)}, 0.2, 0.05)
    scores = [model.score(*match(x)) for x in (f"{quoted} {filler} {abuse}", f"{abuse} {filler} {quoted}", quoted)]
    assert scores[0] == scores[1] > 0.7 and scores[2] == 0.05


@pytest.mark.parametrize("shards, block", [(16, 1 << 24), (5, 2000)])
def test_lm_equals_direct_counts(spark, monkeypatch, shards, block):
    monkeypatch.setattr(ngram_lm, "BLOCK_BYTES", block)
    docs = [(d, t) for d, t, *_ in corpus(200)[0]] + [(300, None), (301, ""), (302, "The the THE unseen"), (300, "again")]
    got = ngram_lm.lm_scores(spark.createDataFrame([(*d, "e", "s", 1, "x") for d in docs], SCHEMA), shards=shards).collect()
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    seqs = [(d, (t or "").encode().lower().split() + [b""]) for d, t in docs]
    one, two = Counter(), Counter()
    for d, w in seqs:
        if not held(d):
            one.update(w)
            two.update(zip([None, *w], w))
    total, types = sum(one.values()), len(one)
    n1, n2 = (sum(v == k for v in one.values()) for k in (1, 2))
    cut = min(0.95, n1 / (n1 + 2 * n2)) if n1 else 0.5
    one[None] = one[b""]
    want = []
    for d, w in seqs:
        score = 0.0
        for v, x in zip([None, *w], w):
            b = float(ngram_lm.back_off(np.array([one[v]]))[0])
            score += math.log10((1 - b) * two[v, x] / max(1, one[v]) + b * ((one[x] - cut) / total if one[x] else cut * types / total))
        want.append((d, held(d), len(w), sum(one[x] > 0 for x in w), total, sum(math.log10((one[x] + 0.1) / (total + 0.1 * (types + 1))) for x in w), score))
    got, want = sorted(map(tuple, got), key=lambda r: (r[0], r[2])), sorted(want, key=lambda r: (r[0], r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(abs(a[5] - b[5]) < 1e-8 and abs(a[6] - b[6]) < 2e-4 * a[2] for a, b in zip(got, want, strict=True))
    assert ngram_lm.lm_scores(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chances_add_up():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 30, 4000)
    one, pair = np.bincount(text, minlength=31).astype(float), np.zeros((31, 31))
    np.add.at(pair, (text[:-1], text[1:]), 1)
    known = one[:30]
    cut = 0.5
    single = np.append((known - cut) / known.sum(), cut * 30 / known.sum())
    for v in range(30):
        n = pair[v].sum()
        b = float(ngram_lm.back_off(np.array([n]))[0])
        assert abs(((1 - b) * pair[v] / n + b * single).sum() - 1) < 1e-9


def test_elias_fano_and_trie():
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1), (1, 1 << 60), (500, 40), (3000, 1 << 40)):
        values = np.sort(rng.integers(0, top, n))
        ef = ngram_lm.EliasFano(values).open()
        assert (ef.get(np.arange(n)) == values).all() if n else True
        if n:
            ask = np.concatenate((values[:50], rng.integers(0, top, 50)))
            at = ef.find(ask)
            assert ((at >= 0) == np.isin(ask, values)).all() and (values[at[at >= 0]] == ask[at >= 0]).all()
    pairs = np.unique(rng.integers(0, 60, (800, 2)), axis=0)
    counts = rng.integers(1, 1000, len(pairs))
    trie = ngram_lm.Trie(pairs[:, 0], pairs[:, 1], counts).mapped()
    grid = np.stack(np.meshgrid(np.arange(62), np.arange(62), indexing="ij"), -1).reshape(-1, 2)
    got = ngram_lm.counts_of(trie.find(grid[:, 0], grid[:, 1]))
    want = {tuple(p): c for p, c in zip(pairs.tolist(), counts.tolist(), strict=True)}
    for p, c in zip(grid.tolist(), got.tolist(), strict=True):
        assert abs(c - want.get(tuple(p), 0)) <= 3e-4 * c
    assert ngram_lm.Trie(*(np.empty(0, np.int64) for _ in range(3))).mapped().find(np.array([1]), np.array([2])).tolist() == [0]


def test_pipeline(spark, tmp_path):
    docs, labels = corpus(900)
    rnd = random.Random(6)
    line = lambda k: " ".join("".join(rnd.choices("aeiostr", k=rnd.randint(3, 8))) for _ in range(k))
    passages = [line(51), line(60)]
    docs += [(1000, docs[1][1], "en", "s", 1, "x"), (1001, docs[3][1], "en", "s", 1, "x"), (1002, "", "en", "s", 0, "x")]
    docs += [(2000 + k, f"{line(90)} {passages[k % 2]}\n{line(40)}", "en", "s", 1, "x") for k in range(10)]
    spark.createDataFrame([(*d[:5], 0.5, 7) for d in docs], "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = stage.columns
    for name, run in corpus_pipeline.STAGES[:-1]:
        stage = run(spark, stage, str(tmp_path))
        assert stage.columns == columns
        rows = stage.collect()
        assert all((r.score, r.predicted) == (0.5, 7) for r in rows)  # columns that clash keep their values
        kept[name] = {r.doc_id: r.text for r in rows}
    toxic = {k for k, _, t in labels if t}
    clean = {d[0] for d in docs} - toxic
    assert len(kept["toxicity"].keys() & toxic) <= 0.05 * len(toxic) and len(clean - kept["toxicity"].keys()) <= 0.02 * len(clean)
    near = kept["simhash_near_dedup"]
    assert 1000 not in near and 1 in near and 1001 not in near
    want = {d: t for d, t, *_ in without_passages(sorted(near.items()), 51)}
    assert kept["suffix_dedup"] == want and all(len(want[k].split()) == 130 for k in range(2000, 2010))
    assert sum(want[d] != near[d] for d in want) == 10  # the others are left alone
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == kept["suffix_dedup"].keys()
    for _, run in corpus_pipeline.STAGES:
        assert run(spark, spark.read.parquet(f"{tmp_path}/documents.parquet").where("false"), str(tmp_path)).count() == 0
