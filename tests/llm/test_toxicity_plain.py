"""Toxicity scores against a plain version: every term compared with every word, rows and matches counted one by one."""

import math
import zlib
from collections import Counter
from functools import lru_cache

import pytest

from areapanel.llm import toxicity as tox

from test_models import SCHEMA, corpus

SUPPORT, MOST = 3, 4096


@lru_cache(maxsize=None)
def distances(word, term):
    """Levenshtein distance of each prefix of the word, the empty one first, to the term."""
    row, out = list(range(len(term) + 1)), [len(term)]
    for c in word:
        new = [row[0] + 1]
        for k, d in enumerate(term):
            new.append(min(row[k] + (c != d), row[k + 1] + 1, new[k] + 1))
        row = new
        out.append(row[-1])
    return out


def nearest(word, terms):
    """(edits, term): a stem at the first prefix that is nearest to one, a whole term if it is as near."""
    found = None
    stems, whole = [t for t in terms if t.endswith("*")], [t for t in terms if not t.endswith("*")]
    for k in range(1, len(word) + 1):
        ends = [(distances(word, t[:-1])[k], t) for t in stems]
        ends = [x for x in ends if x[0] <= tox.edits(len(x[1]) - 1 - 2)]
        if ends and (found is None or min(ends)[0] < found[0]):
            found = min(ends)
    ends = [(distances(word, t)[-1], t) for t in whole]
    ends = [x for x in ends if x[0] <= tox.edits(len(x[1]))]
    return min(ends) if ends and (found is None or min(ends)[0] <= found[0]) else found


def matches(text, terms, memo):
    tokens, kinds = text.lower().split(), set()
    for k, token in enumerate(tokens):
        word = tox.bare(token)
        if word not in memo:
            memo[word] = nearest(word, terms)
        if memo[word]:
            edit, term = memo[word]
            around = tox.context(tokens, k)
            kinds.add((word, term if edit == 0 and around != "quoted" else f"{edit} {around} {'stem' if term.endswith('*') else 'word'}"))
    return len(tokens), Counter(kind for _, kind in kinds)


def plain_scores(docs, labels):
    truth = {}
    for i, y in labels:
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            truth[i] = max(y, truth.get(i, 0))
    train, seen = [], set()
    for i, text in docs:
        if i in truth and text is not None and (text, truth[i]) not in seen:  # copies count once for each label
            seen.add((text, truth[i]))
            train.append((text, truth[i] > 0))
    toxic, clean = Counter(), Counter()
    for text, y in train:
        (toxic if y else clean).update({t for w in {tox.bare(x) for x in text.lower().split()} if w for t in [w, *(w[:n] + "*" for n in range(3, 8) if n < len(w))]})
    n_t, n_c = sum(y for _, y in train), sum(not y for _, y in train)

    def log_likelihood(k, n, p):
        p = min(max(p, 1e-9), 1 - 1e-9)
        return k * math.log(p) + (n - k) * math.log1p(-p)

    tested = [t for t in toxic if toxic[t] >= SUPPORT]
    strong = []
    for term in tested:
        t, c = toxic[term], clean[term]
        both = (t + c) / (n_t + n_c)
        ratio = log_likelihood(t, n_t, t / n_t) + log_likelihood(c, n_c, c / n_c) - log_likelihood(t, n_t, both) - log_likelihood(c, n_c, both)
        if max(t / n_t, 1e-9) > 8 * max(c / n_c, 1e-9) and t / (t + c) > 0.5 and ratio >= math.log(20 * len(tested)):
            strong.append((-ratio, term))
    names = tox._without_idle_stems({term: (toxic[term], clean[term]) for _, term in sorted(strong)[:MOST]})
    memo, found, tokens, idle = {}, {True: Counter(), False: Counter()}, Counter(), Counter()
    for text, y in train:
        n, kinds = matches(text, names, memo)
        tokens[y] += n
        found[y].update(kinds)
        idle[y] += not kinds
    rates = {}
    for kind in found[True].keys() | found[False].keys():
        chance = (found[False][kind] + 2) / tokens[False]
        rates[kind] = (chance, max(0.0, found[True][kind] - chance * tokens[True]) / n_t)
    base, low = min(0.99, n_t / (n_t + n_c)), (idle[True] + 0.5) / (idle[True] + idle[False] + 1)
    out = []
    for i, text in docs:
        if i is None:
            continue
        n, kinds = matches(text or "", names, memo)
        gain = sum(m * math.log1p(rates.get(k, (1.0, 0.0))[1] / (rates.get(k, (1.0, 0.0))[0] * n)) for k, m in kinds.items())
        odds = base / (1 - base) * math.exp(min(30.0, gain - 1))
        s = max(low, odds / (1 + odds)) if gain else low
        out.append((i, zlib.crc32(str(i).encode()) % 3 == 1, s))
    return names, out


def test_scores_equal_the_plain_version(spark):
    docs, labels = corpus()
    word = "zz".join(docs[0][1].split()[:2])
    extra = [(9000, None), (9001, ""), (9002, docs[0][1]), (9002, docs[0][1]), (9003, docs[1][1].upper()), (9004, f'{"long text " * 20_000}{docs[2][1]}'), (9005, f'they said "{docs[0][1]}" {word}'), (None, "x")]
    rows = [(d[0], d[1]) for d in docs] + extra
    frame = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in rows], SCHEMA).repartition(5)
    names, want = plain_scores(rows, [(i, y) for i, _, y in labels])
    model = tox.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(model.terms) == sorted(names) and len(names) >= 3
    got = sorted(tuple(r)[:3] for r in tox.toxicity(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect())
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-9)
    assert len({round(s, 6) for *_, s in got}) > 5
