"""Toxicity scores: Levenshtein automata over a lexicon trie, weighed by what stands around a match."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .common import drop_saved, save
from .tokens import slices

EDGES = "\"'`´‘’“”„«»‹›.,;:!?¡¿()[]{}<>*_~#|/\\-–—…"
QUOTES = "\"“”„«»‹›"
#: Words that show that somebody is addressed, and words that show that somebody is quoted, in four languages.
ADDRESS = frozenset("you your you're u tu toi ton ta tes vous votre du dich dir dein deine ihr euch tú ti te usted ustedes tus".split())
REPORT = frozenset("said says say wrote writes quote quoted quoting called calling term word words dit écrit cite mot sagte schrieb zitat wort nannte dijo escribió cita palabra llamó".split())
WINDOW = 8
LOOKALIKE = str.maketrans("0134578@$", "oieastbas")
MEMO_WORDS = 400_000
STATES = 100_000
#: Texts that share the least hash of their runs of so many words, under any of the seeds, count as copies.
RUN = 8
SEEDS = tuple(0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) for k in range(4))


def bare(token: str) -> str:
    """A lower-case token without punctuation around it, with letters for look-alike digits inside words."""
    word = token.strip(EDGES)
    if word and not word.isalpha() and any(c.isalpha() for c in word):
        word = word.translate(LOOKALIKE)
    return word


def edits(length: int) -> int:
    """Edits that a term of so many letters may be away."""
    return 0 if length < 5 else 1 if length < 9 else 2


class FuzzyLexicon:
    """The trie of the terms, run against words as a lazily made deterministic automaton.

    A state is the set of (trie node, edits so far) that the word read so far
    can have reached: the product of the trie with the Levenshtein automaton of
    every term.  States and their moves are kept, so most words cost a few
    dictionary look-ups and end early in the dead state.  A term ending in
    ``*`` is a stem: it accepts as soon as it is read.
    """

    def __init__(self, terms: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.term: list[tuple[str, bool] | None] = [None]
        self.most: list[int] = [0]
        for t in terms:
            stem = t.endswith("*")
            word, node = t.rstrip("*"), 0
            allowed = edits(len(word) - 2 * stem)
            self.most[0] = max(self.most[0], allowed)
            for c in word:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.next[node][c]
                self.most[node] = max(self.most[node], allowed)
            self.term[node] = (t, stem)
        self.forget()

    def forget(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.whole: list[tuple | None] = []
        self.stems: list[tuple | None] = []
        self.state(frozenset())  # state 0 is dead
        self.first = self.state(self.closed({0: 0}))

    def closed(self, best: dict[int, int]) -> frozenset:
        """With the nodes reached by leaving out letters of the term."""
        todo = list(best.items())
        while todo:
            node, e = todo.pop()
            for child in self.next[node].values():
                if e + 1 <= self.most[child] and e + 1 < best.get(child, 9):
                    best[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(best.items())

    def state(self, key: frozenset) -> int:
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            ends = [(e, *self.term[n]) for n, e in key if self.term[n]]
            ends = [(e, t) for e, t, stem in ends if e <= edits(len(t.rstrip("*")) - 2 * stem)]
            self.whole.append(min((x for x in ends if not x[1].endswith("*")), default=None))
            self.stems.append(min((x for x in ends if x[1].endswith("*")), default=None))
        return self.ids[key]

    def move(self, state: int, c: str) -> int:
        best: dict[int, int] = {}
        for node, e in self.sets[state]:
            if e + 1 <= self.most[node] and e + 1 < best.get(node, 9):
                best[node] = e + 1  # a letter too many
            for d, child in self.next[node].items():
                cost = e + (c != d)
                if cost <= self.most[child] and cost < best.get(child, 9):
                    best[child] = cost
        self.moves[state][c] = to = self.state(self.closed(best))
        return to

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest term, stems after whole terms at equal distance; None if none is near."""
        if len(self.sets) > STATES:
            self.forget()
        at, found = self.first, None
        for c in word:
            to = self.moves[at].get(c)
            at = self.move(at, c) if to is None else to
            if not at:
                break
            stem = self.stems[at]
            if stem and (found is None or stem[0] < found[0]):
                found = stem
        end = self.whole[at] if at else None
        return end if end and (found is None or end[0] <= found[0]) else found


def context(tokens: list[str], k: int) -> str:
    """``direct``, ``quoted`` or ``plain``, from the window of tokens around the match."""
    before, after = tokens[max(0, k - WINDOW) : k + 1], tokens[k : k + WINDOW + 1]
    around = {bare(x) for x in before} | {bare(x) for x in after}
    marks = sum(c in QUOTES for x in before[:-1] for c in x) + sum(c in QUOTES for c in tokens[k][: tokens[k].find(bare(tokens[k])[:1]) + 1])
    if marks % 2 and any(c in QUOTES for x in after for c in x) and not around.isdisjoint(REPORT):
        return "quoted"
    return "plain" if around.isdisjoint(ADDRESS) else "direct"


class Matcher:
    """The matches of texts, with a bounded memo of words."""

    def __init__(self, terms: list[str]):
        self.lexicon = FuzzyLexicon(terms)
        self.known: set[str] = set()
        self.hits: dict[str, tuple[int, str]] = {}

    def __call__(self, text: str) -> tuple[int, Counter]:
        """Number of tokens, and how many different words match, by kind of match.

        The kind of an exact match is its term; near and quoted matches are
        kinds of their own, whatever the term, so that the training rows tell
        how much they mean.  Every occurrence of a word is judged, and the word
        counts once for each kind, so its order and number don't matter.
        """
        tokens = text.lower().split()
        words = set(tokens)
        if len(self.known) > MEMO_WORDS:
            self.known, self.hits = set(), {}
        for w in words - self.known:
            if near := self.lexicon.match(bare(w)):
                self.hits[w] = near
        self.known |= words
        found: Counter = Counter()
        seen: dict[str, set[str]] = {}
        if not words.isdisjoint(self.hits):
            for k, w in enumerate(tokens):
                if near := self.hits.get(w):
                    edit, term = near
                    kinds = seen.setdefault(bare(w), set())
                    if len(kinds) == (3 if edit else 2):
                        continue
                    around = context(tokens, k)
                    kind = term if not edit and around != "quoted" else f"{edit} {around} {'stem' if term.endswith('*') else 'word'}"
                    if kind not in kinds:
                        kinds.add(kind)
                        found[kind] += 1
        return len(tokens), found


def _terms(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in range(3, min(7, len(word) - 1) + 1))]


def least_hashes(text: str) -> list[int]:
    """The least hash of the runs of ``RUN`` words under each seed; a shorter text is one run."""
    words = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in text.lower().split()], np.uint64)
    width = max(1, min(RUN, len(words)))
    n = max(1, len(words) - width + 1)
    runs = np.full(n, len(words) if width < RUN else RUN, np.uint64)
    for j in range(min(width, len(words))):
        runs = runs * np.uint64(0x100000001B3) + words[j : j + n]
        runs ^= runs >> np.uint64(29)
    out = []
    for seed in SEEDS:
        mixed = (runs ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(int((mixed ^ (mixed >> np.uint64(31))).min().view(np.int64)))
    return out


def _without_idle_stems(rows: dict[str, tuple[int, int]]) -> list[str]:
    """The terms (with their toxic and clean rows), without stems that longer terms account for.

    A stem goes if one longer term has almost all of its toxic rows, or if
    several have, with less than half of its clean rows.
    """
    kept = []
    for term, (t, c) in rows.items():
        longer = sorted((o for o in rows if term.endswith("*") and o != term and len(o.rstrip("*")) > len(term) - 2 and o.startswith(term[:-1])), key=len)
        apart = [o for k, o in enumerate(longer) if not any(x.endswith("*") and o.startswith(x[:-1]) for x in longer[:k])]
        one = max((rows[o][0] for o in longer), default=0) >= 0.8 * t
        several = sum(rows[o][0] for o in apart) >= 0.8 * t and sum(rows[o][1] for o in apart) < 0.5 * c
        if not (one or several):
            kept.append(term)
    return kept


def fold(id_col) -> "F.Column":
    """crc32 of the id as text, modulo 3; rows of fold 1 are held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


class ToxicityModel:
    """Terms, and for each kind of match how often clean and toxic rows have it; a few thousand numbers.

    ``rates``: kind -> (matches for each token of a clean row, matches that a
    toxic row has beyond that).  ``base``: share of toxic rows; ``idle``: that
    share among rows without a match.
    """

    def __init__(self, terms: list[str], rates: dict[str, tuple[float, float]], base: float, idle: float):
        self.terms, self.rates, self.base, self.idle = terms, rates, base, idle

    def score(self, length: int, found: Counter) -> float:
        """Chance of label 1: the matches against those that a clean row of this length has by chance."""
        gain = 0.0
        for kind, n in found.items():
            chance, excess = self.rates.get(kind, (1.0, 0.0))
            gain += n * math.log1p(excess / (chance * length))
        if not gain:
            return self.idle
        odds = self.base / (1 - self.base) * math.exp(min(30.0, gain - 1))
        return max(self.idle, odds / (1 + odds))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = 200_000, max_terms: int = 4096, support: int = 3) -> ToxicityModel:
    """Learn the lexicon and the weights from labelled rows that are not held out.

    At most ``fit_rows`` labelled rows are used, those with the least hash of
    their id, so the labels can be broadcast whatever the corpus is.  A term is
    a word or a stem of 3 to 7 letters.  Copies and near copies (texts that
    share a least hash of :func:`least_hashes`) count as one row for each label,
    so that neither toxic nor clean copies outweigh the rest; terms that fewer
    than ``support`` toxic rows then have go.  At most ``max_terms`` candidates
    are kept, the strongest by log-likelihood ratio.
    """
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null").where(fold("doc_id") != 1)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")

    def marked(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([least_hashes(x) for x in texts], pa.list_(pa.int64()))], [*batch.schema.names, "marks"])

    numbered = texts.join(F.broadcast(chosen), "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic"), F.monotonically_increasing_id().alias("row"))
    rows = save(numbered.mapInArrow(marked, "text string, toxic int, row long, marks array<long>"), "toxicity-train")
    first = rows.select("toxic", "row", F.posexplode("marks").alias("seed", "mark")).groupBy("toxic", "seed", "mark").agg(F.min("row").alias("row"))
    once = save(first.groupBy("row").count().where(F.col("count") == len(SEEDS)).select("row"), "toxicity-once")
    train = rows.join(once, "row", "left_semi").select("text", "toxic")

    def having(batches):
        """(term, toxic rows, clean rows that have it), summed over many rows."""
        for batch in batches:
            texts, ys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts, 1 << 24):
                toxic, clean = Counter(), Counter()
                for text, y in zip(texts[a:b], ys[a:b], strict=True):
                    (toxic if y > 0 else clean).update({t for w in set(map(bare, text.lower().split())) if w for t in _terms(w)})
                terms = list(toxic.keys() | clean.keys())
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())], ["term", "t", "c"])

    both = save(train.mapInArrow(having, "term string, t long, c long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where(F.col("t") >= support), "toxicity-terms")
    sizes = {r.toxic: r.n for r in train.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic:
        drop_saved(train)
        return ToxicityModel([], {}, 0.0, 0.0)
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    part = lambda k, n, p: k * F.log(p) + (n - k) * F.log1p(-p)
    eps = lambda x: F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), x))
    p_t, p_c, p = eps(t / n_toxic), eps(c / max(1, n_clean)), eps((t + c) / (n_toxic + n_clean))
    ratio = part(t, F.lit(float(n_toxic)), p_t) + part(c, F.lit(float(n_clean)), p_c) - part(t, F.lit(float(n_toxic)), p) - part(c, F.lit(float(n_clean)), p)
    tested = both.count()
    strong = both.withColumn("ratio", ratio).where((p_t > 8 * p_c) & (t / (t + c) > 0.5) & (F.col("ratio") >= math.log(20 * max(1, tested)))).orderBy(F.desc("ratio"), "term").limit(max_terms)
    names = _without_idle_stems({r.term: (r.t, r.c) for r in strong.collect()})

    def measured(batches):
        """Matches by kind, rows, tokens, and rows without a match, of toxic and clean rows."""
        match, count = Matcher(names), Counter()
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                length, found = match(text)
                y = y > 0
                count.update({("", "rows", y): 1, ("", "tokens", y): length, ("", "idle", y): int(not found)})
                count.update({("kind", k, y): n for k, n in found.items()})
        keys = list(count)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in keys], t) for k, t in enumerate((pa.string(), pa.string(), pa.bool_()))] + [pa.array([count[x] for x in keys], pa.int64())], ["what", "kind", "y", "n"])

    total = {(r.what, r.kind, r.y): r.n for r in train.select("text", "toxic").mapInArrow(measured, "what string, kind string, y boolean, n long").groupBy("what", "kind", "y").agg(F.sum("n").alias("n")).collect()}
    drop_saved(train)
    clean_tokens, toxic_tokens = (max(1, total.get(("", "tokens", y), 0)) for y in (False, True))
    rates = {}
    for kind in {k for what, k, _ in total if what}:
        chance = (total.get(("kind", kind, False), 0) + 2) / clean_tokens
        rates[kind] = (chance, max(0.0, total.get(("kind", kind, True), 0) - chance * toxic_tokens) / n_toxic)
    toxic, clean = (total.get(("", "idle", y), 0) for y in (True, False))
    return ToxicityModel(names, rates, min(0.99, n_toxic / (n_toxic + n_clean)), (toxic + 0.5) / (toxic + clean + 1))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 at ``threshold`` or more) after its own columns; no shuffle.

    A null or empty text has no match and scores the share of toxic rows among
    training rows without one.  Every row is scored on its own, so repeated
    rows and extra columns stay as they are (columns named ``score`` or
    ``predicted`` are replaced).
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    at = kept.index(text_col)

    def run(batches):
        match = Matcher(model.terms)
        for batch in batches:
            scores = [model.score(*match(x or "")) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], [*batch.schema.names, "score", "predicted"])

    source = docs.select(*kept)
    schema = StructType([*source.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return source.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.7, **params) -> DataFrame:
    """Fit on the labelled rows that are not held out and score every row.

    One row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted``.
    Rows with a null id are left out; an empty table, or no toxic label to
    learn from, gives scores of zero.
    """
    model = fit(docs, labels, id_col, text_col, label_col, **params)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    scored = score(rows, model, "doc_id", "text", threshold)
    return scored.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "score", "predicted")
