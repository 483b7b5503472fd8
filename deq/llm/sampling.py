"""Sampled segmentations of a sentence-piece lattice, without replacement, and decoding."""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.llm.common import in_arrow, key_of, mixed, narrowed
from deq.llm.substrings import _powers

#: Distinct words, and arcs of the lattices of their units, that one Python worker remembers; beyond that it starts anew.
REMEMBERED = 600_000
ARCS = 10_000_000
#: Characters of documents that are sampled together.
TOGETHER = 400_000

SPACE = "▁"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROUND = np.uint64(0xD1B54A32D192ED03)
_LOADED: dict = {}
_SPACED = re.compile(" *[^ ]+| +")


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers in the open interval (0, 1) from 64-bit keys."""
    return ((mixed(keys) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def truncated(location: np.ndarray, most, u: np.ndarray) -> np.ndarray:
    """Gumbel variates of these locations, given that none exceeds ``most``."""
    gumbel = location - np.log(-np.log(u))
    return -np.logaddexp(-most, -gumbel)


class _Words(dict):
    """Numbers of words, which their units have been looked up for; each word stands for a space before it, too."""

    def __init__(self, unit: re.Pattern):
        super().__init__()
        self.unit = unit
        self.units: dict[str, int] = {}  # the first node of each unit
        self.nodes = 0
        self.new: list[str] = []  # units whose lattice is not built yet
        self.roots, self.ends = array("q"), array("q", [0])

    def __missing__(self, word: str) -> int:
        whole = SPACE + word.replace(" ", SPACE)
        for unit in (whole,) if word.isalpha() and word.isascii() else self.unit.findall(whole):
            node = self.units.get(unit)
            if node is None:
                node = self.units[unit] = self.nodes
                self.nodes += len(unit)
                self.new.append(unit)
            self.roots.append(node)
        self.ends.append(len(self.roots))
        number = self[word] = len(self)
        return number

    def of(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int64)
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = [w[1:] for w in _SPACED.findall(" " + text)]
        else:
            words = text.split(" ")
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Lattice:
    """Lattices of units of text, as arrays over all arcs.

    No piece of the vocabulary reaches across the start of a run of spaces, a line break, a change
    between letters and signs, or a digit, so the lattice of a text is the chain of those of its units. The probability of an arc is its piece's
    weight times the sum over all ways on from its end, divided by that over all ways from its start;
    a walk that picks arcs by these samples a segmentation. A piece of rank r has the weight
    (r + 1) ** -exponent, as merge ranks follow frequency; characters without a piece are bytes.
    """

    def __init__(self, path: str, exponent: float):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m, size = self.model, self.model.get_piece_size()
        self.pieces = [m.id_to_piece(i) for i in range(size)]
        self.bytes = {b: m.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        special = [m.is_control(i) or m.is_unknown(i) or m.is_byte(i) for i in range(size)]
        plain = [i for i in range(size) if not special[i]]
        self.ids = {self.pieces[i]: i for i in plain}
        self.longest = max(map(len, self.ids))
        self.score = {i: -exponent * math.log(min(-m.get_score(i), size) + 1) for i in plain}
        self.byte_score = -exponent * math.log(size + 1)
        # Two neighbours in a text alone decide whether a unit ends between them.
        self.unit = re.compile(f"[\n\t]|\\d|{SPACE}*(?:[^\\W\\d_¹²³¼½¾]+|(?:[^\\w{SPACE}\n\t]|[_¹²³¼½¾])+)|{SPACE}+")
        if any(len(self.unit.findall(p)) > 1 or "\n" in p or "\t" in p for p in self.ids):
            raise ValueError("a piece reaches across units of this lattice")
        #: What a token stands for in the text, as bytes; further entries are characters as bytes.
        self.meaning = [
            bytes([int(p[3:5], 16)]) if m.is_byte(i) else b"" if special[i] else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.spoken = np.empty(0, object)  # the same, as an array
        self.tokens: list[tuple[int, ...]] = [(i,) for i in range(size)]
        self.spelled: dict[str, int] = {}
        self._vocabulary()
        self._clear()

    def _clear(self) -> None:
        self.words = _Words(self.unit)
        self.size = self.nodes = 0
        self.share = np.empty(1 << 16)  # probability of the node's arcs up to this one
        self.logp = np.empty(1 << 16)
        self.to = np.empty(1 << 16, np.int32)  # the node after the arc, -1 at the end of a unit
        self.token = np.empty(1 << 16, np.int32)
        self.first = np.zeros(1 << 16, np.int32)  # the first arc of each node, and the end of the last
        self.most = 1  # arcs of a node

    def _spell(self, char: str) -> int:
        if char not in self.spelled:
            self.spelled[char] = len(self.tokens)
            self.tokens.append(tuple(self.bytes[b] for b in char.encode("utf-8", "replace")))
            self.meaning.append(char.encode("utf-8", "replace"))
        return self.spelled[char]

    def _hashes(self, sums: np.ndarray, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return mixed((sums[at + length] - sums[at]) * _powers(len(sums))[1][at])

    def _sums(self, codes: np.ndarray) -> np.ndarray:
        weighed = mixed(codes.astype(np.uint64) + np.uint64(1)) * _powers(len(codes) + 1)[0][:-1]
        return np.r_[np.zeros(1, np.uint64), np.cumsum(weighed, dtype=np.uint64)]

    def _vocabulary(self) -> None:
        """Pieces by a rolling digest, with a bit for each value of its low part that occurs."""
        names = list(self.ids)
        sizes = np.array([len(p) for p in names])
        digests = self._hashes(self._sums(codes_of("".join(names))), np.cumsum(sizes) - sizes, sizes)
        order = np.argsort(digests)
        self.known, self.known_id = digests[order], np.array([self.ids[p] for p in names], np.int32)[order]
        self.occurs = np.zeros(1 << 20, bool)
        self.occurs[(digests & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.known_score = np.array([self.score[i] for i in self.known_id.tolist()])

    def _found(self, text: str, left: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, length, token and weight of every piece in the text, by start and length."""
        codes = codes_of(text)
        sums, at = self._sums(codes), np.arange(len(codes))
        parts, low = [], np.uint64((1 << 20) - 1)
        for length in range(1, self.longest + 1):
            at = at[left[at] >= length]
            digests = self._hashes(sums, at, length)
            hit = self.occurs[(digests & low).astype(np.int64)]
            some, digests = at[hit], digests[hit]
            place = np.minimum(np.searchsorted(self.known, digests), len(self.known) - 1)
            same = self.known[place] == digests
            some, place = some[same], place[same]
            parts.append((some, np.full(len(some), length), self.known_id[place], self.known_score[place]))
            if length == 1:
                lone = np.ones(len(codes), bool)
                lone[some] = False
                lone = np.flatnonzero(lone)
                spelt = np.array([self._spell(text[i]) for i in lone], np.int32)
                cost = np.array([len(self.tokens[t]) * self.byte_score for t in spelt])
                parts.append((lone, np.ones(len(lone), np.int64), spelt, cost))
        start, length, token, weight = (np.concatenate(x) for x in zip(*parts))
        # As many ascending runs as there are lengths, which this sort merges.
        order = np.argsort(start * (self.longest + 1) + length, kind="stable")
        return start[order], length[order], token[order], weight[order]

    def _arcs(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Arcs of units, in the order of their nodes: ``share``, ``logp``, ``to``, ``token``, arcs by node.

        The sums over all ways on are formed for all units at once, node by node from the ends.
        """
        sizes = np.array([len(u) for u in units])
        ends = np.repeat(np.cumsum(sizes), sizes)
        left = ends - np.arange(len(ends))
        start, length, token, weight = self._found("".join(units), left)
        far = left[start]
        backwards = np.argsort(far.astype(np.int16) if far.max() < 1 << 15 else far, kind="stable")
        cuts = np.searchsorted(far[backwards], np.arange(1, far.max() + 2))
        beyond = np.zeros(len(left) + 1)
        last = length == far
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            now = backwards[lo:hi]
            ways = weight[now] + np.where(last[now], 0.0, beyond[start[now] + length[now]])
            weight[now] = ways
            first = np.flatnonzero(np.r_[True, start[now][1:] != start[now][:-1]])
            top = np.maximum.reduceat(ways, first)
            counts = np.diff(np.r_[first, len(now)])
            beyond[start[now][first]] = top + np.log(np.add.reduceat(np.exp(ways - np.repeat(top, counts)), first))
        logp = np.minimum(weight - beyond[start], 0.0)
        share = np.exp(logp)
        first = np.flatnonzero(np.r_[True, start[1:] != start[:-1]])
        counts = np.diff(np.r_[first, len(start)])
        # Summed node by node, so that a sample does not depend on what else a task has met.
        node, n = first, 1
        while len(node):
            node, n = first[counts > n], n + 1
            share[node + n - 1] += share[node + n - 2]
        share[first + counts - 1] = 1.0
        to = np.where(last, -1, self.nodes + start + length)
        return share, logp, to, token, counts

    def roots(self, texts: list[str]) -> list[np.ndarray]:
        """The first nodes of each text's units; their lattices are built if they are new."""
        if len(self.words) > REMEMBERED or self.size > ARCS:
            self._clear()
        found = [self.words.of(t) for t in texts]
        if self.words.new:
            self._grow(self.words.new)
            self.words.new.clear()
        ends, roots = np.array(self.words.ends), np.array(self.words.roots)
        words = np.concatenate([np.empty(0, np.int64), *found])
        sizes = ends[words + 1] - ends[words]
        after = np.cumsum(sizes)
        all_roots = roots[np.arange(int(sizes.sum())) + np.repeat(ends[words + 1] - after, sizes)]
        cuts = np.concatenate([[0], after])[np.cumsum([len(f) for f in found][:-1], dtype=np.int64)]
        return np.split(all_roots, cuts)

    def _grow(self, units: list[str]) -> None:
        gathered = self._arcs(units)
        added, counts = len(gathered[0]), gathered[-1]
        for name, values in zip(("share", "logp", "to", "token"), gathered):
            self._put(name, self.size, values)
        self._put("first", self.nodes + 1, self.size + np.cumsum(counts))
        self.nodes, self.size, self.most = self.words.nodes, self.size + added, max(self.most, int(counts.max()))

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        kept = getattr(self, name)
        if at + len(values) > len(kept):
            grown = np.empty(max(len(kept) * 3 // 2, at + len(values)), kept.dtype)
            grown[:at] = kept[:at]
            setattr(self, name, grown)
            kept = grown
        kept[at : at + len(values)] = values

    def node(self, arcs: np.ndarray) -> np.ndarray:
        # Numbers of another kind would make a copy of all that is searched.
        return np.searchsorted(self.first[: self.nodes + 1], arcs.astype(np.int32), side="right") - 1

    def pick(self, nodes: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arc from each node that its number in (0, 1) points at, and whether the node has others.

        A bisection among the few arcs of the node, which lie side by side.
        """
        lo, hi = self.first[nodes], self.first[nodes + 1] - 1
        several = hi > lo
        for _ in range((self.most - 1).bit_length()):
            mid = (lo + hi) >> 1
            below = self.share[mid] < u
            lo, hi = np.where(below, mid + 1, lo), np.where(below, hi, mid)
        return lo, several

    def others(self, logp: np.ndarray, several: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of all other ways; where there are none, minus infinity."""
        return np.where(several, np.log(-np.expm1(np.minimum(logp, -1e-300))), -np.inf)

    def walk(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sampled arcs from each start node to the end of its unit.

        Returns arcs in order, how many each start has, and whether it has other ways.
        """
        owners, picked = [], []
        steps, several = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), bool)
        active, at, own, depth = np.arange(len(nodes)), nodes, keys, 0
        while len(active):
            depth += 1
            own = own + _STEP
            chosen, free = self.pick(at, uniform(own))
            steps[active] = depth
            several[active] |= free
            owners.append(active)
            picked.append(chosen)
            at = self.to[chosen]
            on = np.flatnonzero(at >= 0)
            active, at, own = active[on], at[on], own[on]
        place = np.cumsum(steps) - steps
        out = np.empty(int(steps.sum()), np.int32)
        for depth, (owner, chosen) in enumerate(zip(owners, picked)):
            out[place[owner] + depth] = chosen
        return out, steps, several


class _Open(NamedTuple):
    """Segmentations that leave a found one at some place: in any of ``length`` arcs from ``step`` on,
    or, with arcs ``taken``, at ``step`` itself. ``score`` is the best perturbed score among them."""

    score: float
    path: int
    step: int
    unit: int
    before: float  # log-probability of the arcs before
    length: int
    taken: tuple[int, ...]


class _Search:
    """The perturbed search of one text: found segmentations and the best open branches."""

    def __init__(self, roots: np.ndarray, seed: np.uint64):
        self.roots, self.seed = roots, seed
        self.paths: list[np.ndarray] = []
        self.found: list[tuple[float, float]] = []  # log-probability and perturbed score
        self.open: list[_Open] = []

    def add(self, branches: list[_Open], k: int) -> None:
        self.open = sorted([*self.open, *branches], key=lambda b: -b.score)[:k]


def _narrowed(lattice: Lattice, search: _Search, branch: _Open, key: np.ndarray, k: int) -> _Open:
    """Of a branch over several arcs the arc where its best segmentation leaves; the others stay open."""
    own = search.paths[branch.path][branch.step : branch.step + branch.length]
    logp = lattice.logp[own]
    nodes = lattice.node(own)
    before = branch.before + np.concatenate([[0.0], np.cumsum(logp[:-1])])
    place = before + lattice.others(logp, lattice.first[nodes + 1] - lattice.first[nodes] > 1)
    shares = np.cumsum(np.exp(place - place.max()))
    numbers = uniform(key + np.arange(2, len(own) + 3, dtype=np.uint64) * _STEP)
    leaves = min(int(np.searchsorted(shares, numbers[-1] * shares[-1])), len(own) - 1)
    scores = truncated(place, branch.score, numbers[:-1])
    scores[leaves] = branch.score
    parts = [
        _Open(float(scores[i]), branch.path, branch.step + i, branch.unit, float(before[i]), 0, (int(own[i]),))
        for i in np.flatnonzero(place > -np.inf).tolist()
    ]
    chosen = next(p for p in parts if p.step == branch.step + leaves)
    search.add([p for p in parts if p is not chosen], k)
    return chosen


def _branch(lattice: Lattice, search: _Search, k: int):
    """Take the best open branch: its score, the path's head, its log-probability, and where to go on."""
    key = mixed(np.array([search.seed], np.uint64) + np.full(1, len(search.paths), np.uint64) * _ROUND)
    best = search.open.pop(0)
    if not best.taken:
        best = _narrowed(lattice, search, best, key, k)
    node = int(lattice.node(np.array(best.taken[:1]))[0])
    left = np.array([a for a in range(lattice.first[node], lattice.first[node + 1]) if a not in best.taken], np.int64)
    p = np.exp(lattice.logp[left])
    u = float(uniform(key)[0])
    arc = int(left[min(np.searchsorted(np.cumsum(p), u * p.sum()), len(left) - 1)])
    rest = p[left != arc].sum()
    if rest > 0:
        again = truncated(np.array([best.before + math.log(rest)]), best.score, uniform(key + _STEP))
        search.add([best._replace(score=float(again[0]), taken=(*best.taken, arc))], k)
    head = np.append(search.paths[best.path][: best.step], np.int32(arc))
    on = int(lattice.to[arc])
    nodes = np.append([on] if on >= 0 else [], search.roots[best.unit + 1 :]).astype(np.int64)
    numbers = np.arange(best.unit + (on < 0), len(search.roots))
    return best.score, head, best.before + float(lattice.logp[arc]), nodes, numbers


def sample(lattice: Lattice, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k different segmentations: arcs, log-probability, perturbed score, log inclusion.

    Gumbel noise is drawn top-down. The root's maximum is a Gumbel variate; of the arcs from a node
    one is sampled and inherits the maximum, and the others together get a variate truncated at it.
    A branch first stands for all segmentations that differ within one unit; only when it is the
    best it is parted by the arc where they leave, in the same way.
    Open branches are taken best first, so segmentations come out by falling perturbed score, as if
    noise had been added to each of them and the best k kept. A branch's bound is the exact score
    of its best segmentation, hence nothing is searched in vain; k - 1 open branches and one for the
    threshold are all that can be needed. The inclusion probability is that of a score above the
    (k + 1)th. All texts of the call go through each round together.
    """
    roots = lattice.roots(texts)
    searches = [_Search(r, s) for r, s in zip(roots, seeds)]
    scores = -np.log(-np.log(uniform(seeds + _STEP)))
    none = np.empty(0, np.int32)
    work = [(s, float(g), none, 0.0, s.roots, np.arange(len(s.roots))) for s, g in zip(searches, scores)]
    for turn in range(k):
        if not work:
            break
        starts = np.cumsum([0] + [len(w[4]) for w in work])
        nodes, numbers = np.concatenate([w[4] for w in work]), np.concatenate([w[5] for w in work])
        seed = np.repeat(np.array([w[0].seed for w in work], np.uint64), np.diff(starts))
        keys = mixed(mixed(seed + np.full(1, turn + 1, np.uint64) * _ROUND) + (numbers + 1).astype(np.uint64) * _STEP)
        arcs, steps, several = lattice.walk(nodes, keys)
        first = np.concatenate([[0], np.cumsum(steps)])
        logp = np.add.reduceat(lattice.logp[arcs], first[:-1]) if len(arcs) else np.empty(0)
        doubt = lattice.others(logp, several)
        noise = np.log(-np.log(uniform(keys + _ROUND)))
        for (search, score, head, base, _, units), lo, hi in zip(work, starts[:-1].tolist(), starts[1:].tolist()):
            after = base + np.cumsum(logp[lo:hi])
            before = after - logp[lo:hi]
            bound = -np.logaddexp(-score, noise[lo:hi] - (before + doubt[lo:hi]))
            best = range(hi - lo) if hi - lo <= k else np.argpartition(bound, hi - lo - k)[-k:].tolist()
            number, offset = len(search.paths), len(head) - int(first[lo])
            own = arcs[first[lo] : first[hi]]
            search.paths.append(np.concatenate([head, own]) if len(head) else own)
            search.found.append((float(after[-1]) if hi > lo else base, score))
            search.add(
                [
                    _Open(float(bound[i]), number, offset + int(first[lo + i]), int(units[i]), float(before[i]), int(steps[lo + i]), ())
                    for i in best
                    if bound[i] > -math.inf
                ],
                k,
            )
        if turn + 1 < k:
            work = [(s, *_branch(lattice, s, k)) for s in searches if s.open]
    out = []
    for search in searches:
        threshold = max((o[0] for o in search.open), default=-math.inf)
        rows = []
        for arcs, (logp, score) in zip(search.paths, search.found):
            over = logp - threshold
            inclusion = 0.0 if over > 30 else math.log(-math.expm1(-math.exp(over))) if over > -30 else over
            rows.append((arcs, logp, score, inclusion))
        out.append(rows)
    return out


def load(path: str, exponent: float) -> Lattice:
    if (path, exponent) not in _LOADED:
        _LOADED[path, exponent] = Lattice(path, exponent)
    return _LOADED[path, exponent]


def decoded(lattice: Lattice, tokens: np.ndarray) -> bytes:
    """The text of token ids; the space that encoding puts first is taken off."""
    if len(lattice.spoken) < len(lattice.meaning):
        lattice.spoken = np.array(lattice.meaning, object)
    text = b"".join(lattice.spoken[tokens].tolist())
    return text[1:] if text[:1] == b" " else text


def sampled_segmentations(
    docs: DataFrame, model_path: str, k: int = 2, exponent: float = 1.0, seed: int = 1, with_ids: bool = False
) -> DataFrame:
    """Up to ``k`` different segmentations per document, sampled without replacement.

    doc_id, sample (from 0), n_ids, log_prob (of the segmentation given the text), perturbed (its
    score, falling with sample), log_inclusion (logarithm of the probability of being among the k,
    given the next score), ids_crc32 (little-endian unsigned 32-bit ids), round_trip (the ids decode
    to the text); ``with_ids`` adds the ids. Noise depends on seed, doc_id and text alone. A null or
    empty text has the empty segmentation, a text with fewer than k segmentations all of them.
    """
    slim = narrowed(docs)
    rows = slim.select(F.xxhash64(*key_of(F.col("doc_id"), F.col("text")), F.lit(seed)).alias("_seed"), "doc_id", "text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lattice = load(model_path, exponent)
        ids = batch.column(1).to_pylist()
        texts = [t or "" for t in batch.column(2).to_pylist()]
        seeds = batch.column(0).to_numpy().view(np.uint64)
        sizes = np.cumsum([len(t) for t in texts])
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TOGETHER)))
            out, kept = [], []
            for doc_id, text, samples in zip(ids[at:end], texts[at:end], sample(lattice, texts[at:end], seeds[at:end], k)):
                data = text.encode()
                for n, (arcs, logp, score, inclusion) in enumerate(samples):
                    tokens = lattice.token[arcs]
                    whole = decoded(lattice, tokens) == data
                    if len(tokens) and int(tokens.max()) >= len(lattice.pieces):
                        tokens = np.array([i for t in tokens.tolist() for i in lattice.tokens[t]], np.int32)
                    packed = tokens.astype("<u4")
                    out.append((doc_id, n, len(packed), logp, score, inclusion, zlib.crc32(packed.tobytes()), whole))
                    if with_ids:
                        kept.append(packed.astype(np.int32))
            names = ["doc_id", "sample", "n_ids", "log_prob", "perturbed", "log_inclusion", "ids_crc32", "round_trip"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.float64()] * 3, pa.int64(), pa.bool_()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            if with_ids:
                ends = np.cumsum([0, *map(len, kept)], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
            at = end

    schema = "doc_id long, sample int, n_ids long, log_prob double, perturbed double, log_inclusion double, ids_crc32 long, round_trip boolean"
    return in_arrow(rows, run, schema + (", ids array<int>" if with_ids else ""))


def decode(rows: DataFrame, model_path: str, exponent: float = 1.0) -> DataFrame:
    """Add ``text`` to rows with token ``ids``; null ids give a null text."""
    def texts(ids: pd.Series) -> pd.Series:
        lattice = load(model_path, exponent)
        return ids.map(lambda x: None if x is None else decoded(lattice, np.array(x, np.int64)).decode("utf-8", "replace"))

    return rows.withColumn("text", F.pandas_udf(texts, "string")("ids"))
