"""Distinct sampled segmentations of texts by a perturbed best-first search over the piece lattice."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import slices

SPACE = "▁"
#: No piece has a space mark after another character, so the lattice of a text is a chain of lattices of words.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MOST_OPTIONS = 5_000_000
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceModel:
    """Pieces of a model file, with log weights, in a trie; and the lattices of words.

    A piece's weight falls with its rank in the file as a power law; a model
    file of the unigram kind brings its own log probabilities.  Characters that
    no piece has are bytes.
    """

    def __init__(self, path: str, sharpness: float):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        p = self.processor
        ids = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        scores = {i: p.get_score(i) for i in ids}
        ranked = all(float(s).is_integer() for s in scores.values())
        moves: dict[int, int] = {}
        piece, weight = [-1], [0.0]
        self.most = 1
        for i, s in scores.items():
            node, text = 0, p.id_to_piece(i)
            for c in text:
                key = node << 21 | ord(c)
                if key not in moves:
                    moves[key] = len(piece)
                    piece.append(-1)
                    weight.append(0.0)
                node = moves[key]
            piece[node], weight[node] = i, -sharpness * math.log(2 - s) if ranked else sharpness * s
            self.most = max(self.most, len(text))
        self._hash(np.array(list(moves), dtype=np.int64), np.array(list(moves.values()), dtype=np.int64))
        self.piece, self.weight = np.array(piece), np.array(weight)
        self.names = np.array([p.id_to_piece(i) for i in range(p.get_piece_size())], dtype=object)
        self.bytes = {b: p.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.fallback = -sharpness * math.log(len(scores) + 2)
        self.known = KnownLattices(self)

    def words(self, text: str) -> list[str]:
        return WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _hash(self, keys: np.ndarray, child: np.ndarray) -> None:
        """An open table of the trie's moves."""
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.table, self.child = np.full(1 << self.bits, -1), np.full(1 << self.bits, -1)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.table[slot[left]] < 0
            at, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.table[at], self.child[at] = keys[put], child[put]
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + (self.table[slot[left]] != keys[left])) & (len(self.table) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def move(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Child of each node by a character, or -1."""
        key = node << 21 | code
        slot = self._slot(key)
        there = self.table[slot]
        on = np.flatnonzero((there != key) & (there >= 0))
        while on.size:
            slot[on] = (slot[on] + 1) & (len(self.table) - 1)
            there[on] = self.table[slot[on]]
            on = on[(there[on] != key[on]) & (there[on] >= 0)]
        return np.where(there >= 0, self.child[slot], -1)


@lru_cache(maxsize=2)
def piece_model(path: str, sharpness: float) -> PieceModel:
    return PieceModel(path, sharpness)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _unit(code: np.ndarray) -> np.ndarray:
    return ((_mix(code) >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def _uniform(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on the text's own number and the place alone."""
    return _unit(text + at.astype(np.uint64) * GOLDEN)


def _below(top: np.ndarray, mass: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Greatest perturbed log chance of a set of log chance ``mass``, given that it lies below ``top``."""
    return mass - np.log(np.exp(np.minimum(mass - top, 700.0)) - np.log(u))


class Lattices:
    """The lattices of different words: options of each place, their chances, and what is left beside each.

    Of each word ``length``, and ``base``, its first place; of each place
    ``counts`` and ``first``, its options; of each option ``steps`` (its
    length), ``logs`` (log chance given the place), ``pieces`` (a character
    that goes by bytes is -1 - code point), ``upto`` and ``others``.  All places
    of all words walk the trie at once.  Options lie in order of the places'
    distance from the words' ends, as chances are summed from there.
    """

    def __init__(self, model: PieceModel, words: list[str]):
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.base = np.cumsum(self.length) - self.length
        owner = np.repeat(np.arange(len(words)), self.length)
        left = np.repeat(np.cumsum(self.length), self.length) - np.arange(len(code))
        at, node = np.arange(len(code)), np.zeros(len(code), dtype=np.int64)
        found, self.counts = [], np.zeros(len(code), dtype=np.int64)
        for k in range(1, model.most + 1):
            child = model.move(node, code[at + k - 1])
            ok = np.flatnonzero(child >= 0)
            node, piece = child[ok], model.piece[child[ok]]
            hit = np.flatnonzero(piece >= 0)
            if k == 1:
                lone = np.ones(len(code), dtype=bool)
                lone[at[ok[hit]]] = False
                lone = np.flatnonzero(lone)
                width = 1 + (code[lone] >= 0x80) + (code[lone] >= 0x800) + (code[lone] >= 0x10000)
                found.append((1, lone, -1 - code[lone], model.fallback * width))
                self.counts[lone] += 1
            at = at[ok]
            found.append((k, at[hit], piece[hit], model.weight[node[hit]]))
            self.counts[at[hit]] += 1
            on = np.flatnonzero(left[at] > k)
            at, node = at[on], node[on]
            if not len(at):
                break
        by_left = np.argsort(left if int(left.max(initial=0)) >> 16 else left.astype(np.uint16), kind="stable")
        counts = self.counts[by_left]
        begins = np.cumsum(counts) - counts
        self.first = np.empty(len(code), dtype=np.int64)
        self.first[by_left] = begins
        n = int(counts.sum())
        self.steps, self.pieces, weight = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n)
        free = self.first.copy()
        for k, at, piece, w in found:  # at most one piece of a length begins at a place
            to = free[at]
            self.steps[to], self.pieces[to], weight[to] = k, piece, w
            free[at] += 1
        # A word has a slot for each place and one for its end; ``beta`` is the log sum of all ways from there to the end.
        beta, slot = np.zeros(len(code) + len(words)), (np.arange(len(code)) + owner)[by_left]
        self.logs, self.upto, self.others = (np.empty(n) for _ in range(3))
        cuts = np.searchsorted(left[by_left], np.arange(1, int(left.max(initial=0)) + 2)).tolist()
        for lo, hi in itertools.pairwise(cuts):
            if lo == hi:
                continue
            c, a = counts[lo:hi], begins[lo]
            starts = begins[lo:hi] - a
            of = np.repeat(np.arange(hi - lo), c)
            some = slice(a, a + len(of))
            v = weight[some] + beta[slot[lo:hi][of] + self.steps[some]]
            top = np.maximum.reduceat(v, starts)
            e = np.exp(v - top[of])
            total = np.add.reduceat(e, starts)
            beta[slot[lo:hi]] = top + np.log(total)
            # The likeliest option's chance may round to one, so what is beside it is added up.
            best = np.flatnonzero(v == top[of])
            best = best[np.diff(of[best], prepend=-1) > 0]
            p = e / total[of]
            upto = np.cumsum(p)
            upto -= (upto[starts] - p[starts])[of]
            upto[starts + c - 1] = 2.0  # a draw never passes the last option
            e[best] = 0.0
            with np.errstate(divide="ignore"):
                others = np.log1p(-np.minimum(p, 0.75))
                others[best] = np.log(np.add.reduceat(e, starts) / total)
            self.logs[some], self.upto[some], self.others[some] = v - (top + np.log(total))[of], upto, others

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Option of each place whose share of [0, 1) holds ``u``."""
        option = self.first[node]
        beyond = np.flatnonzero(u >= self.upto[option])
        while beyond.size:
            option[beyond] += 1
            beyond = beyond[u[beyond] >= self.upto[option[beyond]]]
        return option


class Numbers(dict):
    """Numbers of words in order of their first use; ``new`` has those not built yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class KnownLattices(Lattices):
    """The lattices of all words seen so far in arrays that grow; forgotten when they hold ``MOST_OPTIONS``."""

    KINDS = {"length": np.int64, "base": np.int64, "counts": np.int64, "first": np.int64, "steps": np.int16, "logs": np.float64, "pieces": np.int32, "upto": np.float64, "others": np.float64}

    def __init__(self, model: PieceModel):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.places = self.options = 0
        for name, kind in self.KINDS.items():
            setattr(self, name, np.empty(1024, kind))

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each word; the lattices of new ones are built."""
        if self.options > MOST_OPTIONS:
            self.forget()
        out = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if new := self.number.new:
            known = len(self.number) - len(new)
            more = Lattices(self.model, new)
            more.base += self.places
            more.first += self.options
            at = {"length": known, "base": known, "counts": self.places, "first": self.places}
            for name in self.KINDS:
                begin, values, array = at.get(name, self.options), getattr(more, name), getattr(self, name)
                if begin + len(values) > len(array):
                    array = np.empty((begin + len(values)) * 5 // 4, self.KINDS[name])
                    array[:begin] = getattr(self, name)[:begin]
                    setattr(self, name, array)
                array[begin : begin + len(values)] = values
            self.places += len(more.counts)
            self.options += len(more.steps)
            self.number.new = []
        return out


CHOICE, BESIDE, AGAIN, REST = range(4)


def sample(model: PieceModel, texts: list[str], keys: np.ndarray, n: int, seed: int) -> list[list[tuple]]:
    """For each text up to ``n`` distinct segmentations: (ids, log chance, perturbed log chance, log inclusion).

    A region is a beginning of a text with some ways to go on from it excluded.
    Its value is the greatest perturbed log chance among the segmentations in
    it.  The text as a whole is the first region; its value is a Gumbel number.
    A walk through a region draws options by their chances and ends at the
    region's best segmentation, which has the region's value; what the walk
    leaves aside at each place is a region of its own, whose value is drawn from
    a Gumbel law cut off there.  The best region left anywhere is walked next:
    best-first search with an exact bound, one number for each place rather
    than for each option.  Words are independent given what came before, so a
    walk steps through all words of all texts at once.

    The log inclusion is that of the chance to be among the samples given the
    first value left out; 0 for all if nothing is left out.
    """
    split = [model.words(t) for t in texts]
    lat = model.known
    word = lat.numbers(list(itertools.chain.from_iterable(split)))
    sizes = np.array([len(ws) for ws in split], dtype=np.int64)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(word)) - (ends - sizes)[doc]
    length, base = lat.length[word], lat.base[word]

    own = _mix(_mix(keys.astype(np.int64).view(np.uint64)) + np.uint64(seed % (1 << 64)))
    value = -np.log(-np.log(_uniform(own, np.zeros(len(texts), np.int64))))
    alive = sizes > 0
    begin, begin_at, phi = ends - sizes, np.zeros(len(texts), np.int64), np.zeros(len(texts))
    prefix: list[tuple] = [(np.empty(0, np.int64),) * 3] * len(texts)
    waiting: list[list[tuple]] = [[] for _ in texts]
    out: list[list[tuple]] = [[] for _ in texts]
    for turn in range(n):
        mine = _mix(own + np.uint64(turn + 1))
        occ = np.flatnonzero(alive[doc] & (np.arange(len(doc)) >= begin[doc]))
        at = np.zeros(len(word), np.int64)
        going = np.flatnonzero(alive & (begin < ends))
        at[begin[going]] = begin_at[going]
        code = mine[doc[occ]] + (place[occ].astype(np.uint64) << np.uint64(28)) * GOLDEN
        o, a, code = occ, at[occ], code
        walked = []
        while True:
            on = np.flatnonzero(a < length[o])
            if not len(on):
                break
            if len(on) < len(o):
                o, a, code = o[on], a[on], code[on]
            u = _unit(code + (a.astype(np.uint64) << np.uint64(6)) * GOLDEN)
            option = lat.draw(base[o] + a, u)
            walked.append((o, a, option))
            a = a + lat.steps[option]
        # An occurrence takes part in the first so many steps, so its steps have their places without sorting.
        many = np.zeros(len(word), np.int64)
        for o, *_ in walked:
            many[o] += 1
        at_step = np.cumsum(many) - many
        total = int(many.sum())
        so, sa, se = (np.empty(total, np.int64) for _ in range(3))
        for k, (o, a, option) in enumerate(walked):
            to = at_step[o] + k
            so[to], sa[to], se[to] = o, a, option
        bounds = np.concatenate(([0], np.cumsum(np.bincount(doc[so], minlength=len(texts)))))
        logs = lat.logs[se]
        run = np.concatenate(([0.0], np.cumsum(logs)))
        before = run[:-1] - (run[bounds[:-1]] - phi)[doc[so]]
        sums = phi + np.array([logs[x:y].sum() for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)])
        # -log u lies between 2**-54 and 38, so a region's value lies within 38 of its mass; those too low to matter are not drawn.
        wanted = n - turn  # so many regions can be needed of a walk
        floor = np.full(len(texts), -np.inf)
        for t in np.flatnonzero(bounds[1:] - bounds[:-1] > wanted).tolist():
            some = slice(int(bounds[t]), min(int(bounds[t]) + 32 * wanted, int(bounds[t + 1])))
            mass = np.partition(before[some] + lat.others[se[some]], -wanted)[-wanted]  # at least so many lie no lower
            floor[t] = mass - math.log(math.exp(min(mass - value[t], 700.0)) + 38) - 38 if mass > -np.inf else -np.inf
        draw = np.flatnonzero(before > floor[doc[so]])
        o, a = so[draw], sa[draw]
        u = _unit(mine[doc[o]] + (place[o].astype(np.uint64) << np.uint64(28)) * GOLDEN + (a.astype(np.uint64) << np.uint64(6)) * GOLDEN + np.uint64(BESIDE) * GOLDEN)
        beside = _below(value[doc[o]], before[draw] + lat.others[se[draw]], u)
        drawn = np.searchsorted(draw, bounds)
        for t in np.flatnonzero(alive | ((turn == 0) & (sizes == 0))).tolist():
            x, y = int(bounds[t]), int(bounds[t + 1])
            path = tuple(np.concatenate(z) for z in zip(prefix[t], (so[x:y], sa[x:y], se[x:y]), strict=True)) if len(prefix[t][0]) else (so[x:y], sa[x:y], se[x:y])
            out[t].append((path[2], float(sums[t]), float(value[t])))
            begun = len(prefix[t][0])
            mass, at = beside[drawn[t] : drawn[t + 1]], draw[drawn[t] : drawn[t + 1]]
            if len(at) > wanted:
                best = np.argpartition(mass, -wanted)[-wanted:]
                mass, at = mass[best], at[best]
            waiting[t] += [(v, turn, begun + k - x, path, (int(se[k]),), float(before[k])) for v, k in zip(mass.tolist(), at.tolist(), strict=True) if v > -math.inf]
        if turn + 1 == n:
            break
        # Each text goes on from its best region.
        for t in np.flatnonzero(alive).tolist():
            alive[t] = bool(waiting[t])
            if not alive[t]:
                continue
            best = max(waiting[t], key=lambda r: r[:3])
            waiting[t].remove(best)
            value[t], parent, k, path, gone, lead = best
            here, spot = int(path[0][k]), int(path[1][k])
            node = base[here] + spot
            options = np.arange(lat.first[node], lat.first[node] + lat.counts[node])
            for x in gone:
                options = options[options != x]
            chances = np.exp(lat.logs[options])
            share = np.cumsum(chances)
            seat = (int(place[here]) << 28) + (spot << 6)
            again, rest = _uniform(_mix(own[t : t + 1] + np.uint64(turn + 2)), np.array([seat + AGAIN, seat + REST]))
            picked = int(options[min(np.searchsorted(share, again * share[-1], "right"), len(options) - 1)])
            phi[t] = lead + lat.logs[picked]
            if len(options) > 1:
                mass = lead + math.log(chances[options != picked].sum())
                waiting[t].append((float(_below(value[t], np.float64(mass), rest)), parent, k, path, (*gone, picked), lead))
            begin[t], begin_at[t] = here, spot + lat.steps[picked]
            prefix[t] = tuple(np.append(z[:k], last) for z, last in zip(path, (here, spot, picked), strict=True))
    results = []
    for t, found in enumerate(out):
        left = max((r[0] for r in waiting[t]), default=-np.inf)
        results.append([(_with_bytes(model, lat.pieces[options]), log, g, _log_inclusion(log - left)) for options, log, g in found])
    return results


def _log_inclusion(x: float) -> float:
    """Log of 1 - exp(-exp(x)), for any x."""
    return x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 700.0))))


def _with_bytes(model: PieceModel, ids: np.ndarray) -> np.ndarray:
    """Ids with the bytes of the characters that no piece has."""
    lone = np.flatnonzero(ids < 0)
    if not lone.size:
        return ids.astype(np.int32)
    spelled = [[model.bytes[b] for b in chr(-1 - i).encode("utf-8", "replace")] for i in ids[lone].tolist()]
    sizes = np.ones(len(ids), dtype=np.int64)
    sizes[lone] = [len(x) for x in spelled]
    out = np.repeat(ids, sizes).astype(np.int32)
    out[out < 0] = [b for x in spelled for b in x]
    return out


def decode(model: PieceModel, ids: np.ndarray) -> str:
    """The text of ids; where there are pieces for bytes, by the library."""
    text = "".join(model.names[ids].tolist())
    return model.processor.decode(ids.tolist()) if "<0x" in text else text.removeprefix(SPACE).replace(SPACE, " ")


def sampled_segmentations(df: DataFrame, model_path: str, n: int = 2, seed: int = 42, sharpness: float = 1.0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Up to ``n`` distinct segmentations of each whole text, drawn without replacement.

    One row per text and sample: ``doc_id``, ``sample`` (from 1), ``n_pieces``,
    ``ids_crc32``, ``log_chance`` (of the segmentation under the lattice's
    weights), ``perturbed`` (its perturbed log chance, descending over samples),
    ``log_inclusion`` (log of the chance to be drawn, given the value left out),
    ``round_trip`` (decoding gives the text back), and ``ids`` if asked for;
    logarithms have six digits after the point.  Weights for sums over all
    segmentations are exp(``log_chance`` - ``log_inclusion``).  A text with
    fewer segmentations has fewer rows.  The draw depends on ``seed`` and the row's
    id alone, not on how rows are dealt to tasks.

    A null or empty text has one segmentation without pieces.  Rows that repeat
    an id are texts of their own, drawn alike.  Rows with a null id are left
    out.  Texts are taken whole, whatever their length, about a million
    characters at a time.  Other columns are ignored, whatever their names.  No
    shuffle; an empty table gives an empty result.
    """
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()] + ([pa.list_(pa.int32())] if with_ids else [])
    names = ["doc_id", "sample", "n_pieces", "ids_crc32", "log_chance", "perturbed", "log_inclusion", "round_trip"] + (["ids"] if with_ids else [])

    def run(batches):
        model = piece_model(model_path, sharpness)
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                some = [x or "" for x in texts[a:b]]
                rows = []
                for key, text, found in zip(keys[a:b].tolist(), some, sample(model, some, keys[a:b], n, seed), strict=True):
                    for k, (ids, log, g, inclusion) in enumerate(found):
                        rows.append((key, k + 1, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), round(log, 6), round(g, 6), round(inclusion, 6) + 0.0, decode(model, ids) == text, *([ids.tolist()] if with_ids else [])))
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    schema = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_chance double, perturbed double, log_inclusion double, round_trip boolean" + (", ids array<int>" if with_ids else "")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    return rows.mapInArrow(run, schema)
