"""SentencePiece segmentations, sampled without replacement by a perturbed search over the lattice.

The segmentations of a text are the paths of a lattice of vocabulary pieces, each with the
probability its pieces give it. Adding Gumbel noise to their log-probabilities and taking the k
largest samples k distinct ones without replacement. The noise is drawn from the top down: a set
of paths has the largest noise of its members, which is a Gumbel variable of the set's
log-probability, and when the set is split its best part keeps that value and the others get
values truncated at it. So the perturbed value of a set bounds its members exactly, and a
best-first (A*) search with it as the priority walks each of the k paths once and opens no other:
after a path is emitted, what remains of the text's segmentations are the sets that leave it at
one of its edges, and the best of all open sets is next. The sets along a path stay one set, whose mass is
the difference of two prefixes' masses, until it is the best and has to be split.

A set is drawn from by a walk through its lattice. As stretches do not depend on each other, free
walks through all of them are drawn ahead, one for each sample, for many texts at once; what is
free in a sample is taken from its own walk. A walk's noise is hashed from the text's key, the
number of the sample and the place in the text, so a text's samples do not depend on its neighbours.

A piece of this kind of model holds white-space marks only in front, so a lattice is cut into
stretches before such marks, and the stretches of many texts are worked on side by side.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold.llm.common import mixed, slices, small_batches

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SAMPLES = 3
# Exponent of the piece probabilities: 1 samples from the model, less spreads the choice.
SHARPNESS = 0.5
SEED = 5
# Texts sampled at a time, characters times samples that are drawn together, and the slots of the piece table.
SLICE_ROWS = 200
GROUP_CHARS = 3_000_000
_SLOT_BITS = 20


class Vocabulary:
    """The pieces of a model with their probabilities, found by a rolling hash of their characters."""

    def __init__(self, model: str = MODEL, sharpness: float = SHARPNESS):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        p = self.processor
        n = p.get_piece_size()
        names = [p.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
        spelled = [i for i in plain if not p.is_byte(i)]
        if any("\u2581" in names[i].lstrip("\u2581") for i in spelled):
            raise ValueError("the model has pieces across white space, whose lattices cannot be cut there")
        scores = np.array([p.get_score(i) for i in range(n)])
        if all(s <= 0 and s == int(s) for s in scores[spelled]):
            # merges by rank: their place in the list stands for their frequency (Zipf)
            scores = -np.log(2 - scores)
        log = sharpness * (scores - np.log(np.exp(scores[spelled]).sum()))
        self.longest = max(len(names[i]) for i in spelled)
        self.size = n
        # weights are raised by a constant per character, which changes no probability of a segmentation
        self.lift = -float(np.median(log[spelled])) / 3
        lengths = np.array([len(x) for x in names])
        self.length = lengths.astype(np.int32)
        self.weight = np.exp(log + self.lift * lengths)
        self.least = float(log[spelled].min())
        self.byte_ids = np.full(256, p.unk_id(), dtype=np.int32)
        for i in plain:
            if p.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
        self.text = [bytes([int(names[i][3:5], 16)]) if p.is_byte(i) else names[i].replace("\u2581", " ").encode() for i in range(n)]
        self.text_size = np.array([len(t) for t in self.text])
        self.text_first = np.cumsum(self.text_size) - self.text_size
        self.text_bytes = np.frombuffer(b"".join(self.text), np.uint8)
        known: dict[int, int] = {}
        for i in spelled:
            h = np.uint64(0)
            for k, char in enumerate(np.frombuffer(names[i].encode("utf-32-le"), "<u4")):
                h = self.roll(np.array([h]), np.array([char]))[0]
                known[int(h)] = i if k == len(names[i]) - 1 else known.get(int(h), -1)
        # two tables by different slots: what collides in the first is kept in the second
        self.tables = []
        for turn in range(8):
            keys, values = np.zeros(1 << _SLOT_BITS, np.uint64), np.full(1 << _SLOT_BITS, -1, np.int32)
            later = {}
            for h, i in known.items():
                slot = int(self._slot(np.array([h], np.uint64), turn)[0])
                if keys[slot] == 0:
                    keys[slot], values[slot] = h, i
                else:
                    later[h] = i
            self.tables.append((keys, values))
            known = later
            if not known:
                break
        else:
            raise ValueError("pieces with equal hashes")

    @staticmethod
    def roll(h: np.ndarray, char: np.ndarray) -> np.ndarray:
        return (h + char.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)

    @staticmethod
    def _slot(h: np.ndarray, turn: int) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29 + turn))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece of each hash (-1: the beginning of one only), and whether it is any of both."""
        keys, values = self.tables[0]
        slot = self._slot(h, 0)
        key = keys[slot]
        there = key == h
        piece = np.where(there, values[slot], np.int32(-1))
        # what is in a later table found its slot taken in those before
        rest = np.nonzero(~there & (key != 0))[0]
        for turn, (keys, values) in enumerate(self.tables[1:], 1):
            slot = self._slot(h[rest], turn)
            key = keys[slot]
            same = key == h[rest]
            piece[rest[same]], there[rest[same]] = values[slot[same]], True
            rest = rest[~same & (key != 0)]
        return piece, there


def _distinct_stretches(char: np.ndarray, starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One stretch of each kind, and for every stretch the place of its kind among those."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.arange(len(char)) - np.repeat(starts, length)
    power = np.cumprod(np.full(int(length.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
    code = np.add.reduceat((char.astype(np.uint64) + np.uint64(1)) * power[place], starts)
    _, one, which = np.unique(code, return_index=True, return_inverse=True)
    same = length[one[which]] == length
    if same.all() and (char[np.repeat(starts[one[which]], length) + place] == char).all():
        return one, which
    return np.arange(len(starts)), np.arange(len(starts))


class Lattices:
    """The lattices of some texts: one node per character, one edge per piece that begins there.

    Stretches that occur several times in the texts have one lattice: ``starts`` leads from each
    stretch, in text order, to its first node, and ``bounds`` from a text to its stretches. Node
    ``i`` has ``count[i]`` edges from ``first[i]`` on, by length. ``chance[e]`` is the chance that a
    path drawn from the model, once at the node, goes on with edge ``e``, whose piece is
    ``piece[e]`` and has ``length[e]`` characters. Numbers from ``vocabulary.size`` on stand for a
    character that no piece spells, in several bytes. Edges are numbered by the distance of their node from
    the end of its stretch, in the order in which chances are found.
    """

    def __init__(self, vocabulary: Vocabulary, texts: list[str]):
        self.vocabulary = v = vocabulary
        raw = [v.processor.normalize(t) if t else "" for t in texts]
        char = np.frombuffer("".join(raw).encode("utf-32-le"), "<u4")
        edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        n, mark = len(char), char == 0x2581
        begins = mark & ~np.concatenate([[False], mark[:-1]])
        begins[edges[:-1][edges[:-1] < n]] = True
        starts = np.nonzero(begins)[0]
        length = np.diff(np.append(starts, n))
        self.bounds = np.searchsorted(starts, edges)
        # the place of each stretch in its text
        self.place = starts - np.repeat(edges[:-1], np.diff(self.bounds))
        one, which = _distinct_stretches(char, starts, length)
        size = length[one]
        base = np.cumsum(size) - size
        self.starts = base[which]
        self.char = char[np.repeat(starts[one] - base, size) + np.arange(int(size.sum()))]
        self.end = np.repeat(base + size, size)
        self._spread(self._find_pieces(len(self.char)), size)

    def _find_pieces(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length of a piece, from 1 on, the nodes where one begins and its number."""
        v, found = self.vocabulary, []
        at, h = np.arange(n), np.zeros(n, dtype=np.uint64)
        for k in range(v.longest):
            inside = at + k < self.end[at]
            at, h = at[inside], h[inside]
            h = v.roll(h, self.char[at + k])
            piece, there = v.find(h)
            whole = piece >= 0
            found.append((at[whole], piece[whole]))
            at, h = at[there], h[there]
        return found

    def _spread(self, found: list[tuple[np.ndarray, np.ndarray]], size: np.ndarray) -> None:
        """From weights to conditional probabilities: the mass of all paths from a node to the end of its stretch.

        All stretches advance together, from their last character to their first. The masses of one
        distance from the end are neighbours, those of longer stretches first. Only ratios within a
        piece's reach count, so the masses ahead are scaled where they leave the range.
        """
        v, n, kinds = self.vocabulary, len(self.char), len(size)
        self.count = np.zeros(n, dtype=np.int64)
        for nodes, _ in found:
            self.count[nodes] += 1
        bare = np.nonzero(self.count == 0)[0]
        self.count[bare] = 1
        rank = np.empty(kinds, dtype=np.int64)
        # small numbers are sorted by radix
        narrow = np.int16 if size.max(initial=0) < 1 << 15 else np.int64
        rank[np.argsort(-size.astype(narrow), kind="stable")] = np.arange(kinds)
        rank = np.repeat(rank, size)
        by_size = np.bincount(size, minlength=1)
        going = kinds - (np.cumsum(by_size) - by_size)
        level = np.concatenate([[0], np.cumsum(going)])
        back = self.end - np.arange(n)
        spot = level[back] + rank
        # the first level is the ends of the stretches, which have the mass 1 and no edges
        count = np.zeros(int(level[-1]), dtype=np.int64)
        count[spot] = self.count
        first = np.concatenate([[0], np.cumsum(count)])
        self.first = first[spot]
        self.piece = np.empty(int(first[-1]), dtype=np.int32)
        free = self.first.copy()
        for nodes, piece in found:
            at = free[nodes]
            free[nodes] = at + 1
            self.piece[at] = piece
        char, at = self.char[bare], self.first[bare]
        self.piece[at] = np.where(char < 0x80, v.byte_ids[np.minimum(char, 0x7F)], v.size + char)
        # all else about an edge follows from its piece and its node, and is made in the order of the edges
        piece = np.minimum(self.piece, v.size - 1)
        self.length, weight = v.length[piece], v.weight[piece]
        self.length[at] = 1
        weight[at] = np.exp(np.maximum(v.least * _utf8_width(char) + v.lift, -600))
        self.node = np.empty(len(count), dtype=np.int64)
        self.node[spot] = np.arange(n)
        self.node = np.repeat(self.node, count)
        away = np.repeat(np.arange(len(going)), going)
        column = np.arange(len(count)) - level[away]
        ahead = level[np.repeat(away, count) - self.length] + np.repeat(column, count)
        mass, total = np.ones(len(count)), np.ones(len(count))
        for low, high in zip(level[1:-1].tolist(), level[2:].tolist()):
            a, b = int(first[low]), int(first[high])
            part = weight[a:b]
            part *= mass[ahead[a:b]]
            sums = np.add.reduceat(part, first[low:high] - a)
            mass[low:high] = total[low:high] = sums
            if sums.min() < 1e-150 or sums.max() > 1e150:
                at = int(np.searchsorted(level, low))
                for i in np.nonzero((sums < 1e-150) | (sums > 1e150))[0]:
                    mass[level[max(at - v.longest, 0) : at + 1] + i] /= sums[i]
        self.chance = weight / np.repeat(total, count)
        self.log_chance = np.log(np.maximum(self.chance, 1e-300))

    @cached_property
    def share(self) -> np.ndarray:
        """The chances as a table: one row per node, one column per length of a piece."""
        table = np.zeros((len(self.char), int(self.length.max(initial=1))))
        table[self.node, self.length - 1] = self.chance
        return table

    def walks(self, keys: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The edges of ``k`` free paths through all stretches, one path after the other, and where each stretch's begin."""
        stretches = len(self.starts)
        turns = np.arange(k, dtype=np.uint64)[:, None] * np.uint64(0xD1B54A32D192ED03)
        seeds = mixed(mixed(np.array(keys, dtype=np.uint64)) + turns + np.uint64(1))
        seed = np.repeat(seeds, np.diff(self.bounds), axis=1).ravel()
        step = np.uint64(0x9E3779B97F4A7C15)
        spot, node = seed + np.tile(self.place, k).astype(np.uint64) * step, np.tile(self.starts, k)
        end = self.end[node]
        walker = np.arange(k * stretches)
        steps, taken = np.zeros(k * stretches, dtype=np.int64), []
        while len(node):
            noise = mixed(spot)
            edge = self.first[node]
            last = edge + self.count[node] - 1
            rest = (noise >> np.uint64(11)) * 2.0**-53 - self.chance[edge]
            on = np.nonzero((rest >= 0) & (edge < last))[0]
            at, rest, last = edge[on], rest[on], last[on]
            while len(on):
                at = at + 1
                rest = rest - self.chance[at]
                edge[on] = at
                further = (rest >= 0) & (at < last)
                on, at, rest, last = on[further], at[further], rest[further], last[further]
            taken.append((walker, edge))
            steps[walker] += 1
            length = self.length[edge]
            node = node + length
            going = np.nonzero(node < end)[0]
            walker, node, end = walker[going], node[going], end[going]
            spot = spot[going] + length[going].astype(np.uint64) * step
        base = np.concatenate([[0], np.cumsum(steps)])
        path = np.empty(int(base[-1]), dtype=np.int64)
        for turn, (walker, edge) in enumerate(taken):
            path[base[walker] + turn] = edge
        return path, base

    def edge(self, node: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The edges of some nodes with pieces of ``column + 1`` characters."""
        place = np.full((len(self.char), int(self.length.max(initial=1))), -1)
        place[self.node, self.length - 1] = np.arange(len(self.node))
        return place[node, column]

    def ids(self, node: np.ndarray, column: np.ndarray) -> np.ndarray:
        return self.spelled(self.edge(node, column))

    def spelled(self, path: np.ndarray) -> np.ndarray:
        """Piece ids of a path's edges; characters that no piece spells become the pieces of their bytes."""
        found = self.piece[path]
        bare = np.nonzero(found >= self.vocabulary.size)[0]
        if not len(bare):
            return found
        char = found[bare] - self.vocabulary.size
        width = _utf8_width(char)
        length = np.ones(len(found), dtype=np.int64)
        length[bare] = width
        out, first = np.repeat(found, length), (np.cumsum(length) - length)[bare]
        lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])
        for k in range(int(width.max())):
            some = width > k
            value = char[some] >> (6 * (width[some] - 1 - k))
            value = lead[width[some]] | value if k == 0 else 0x80 | (value & 0x3F)
            out[first[some] + k] = self.vocabulary.byte_ids[value]
        return out


def _utf8_width(char: np.ndarray) -> np.ndarray:
    return 1 + (char > 0x7F).astype(np.int64) + (char > 0x7FF) + (char > 0xFFFF)


def _truncated(log_mass: float, bound: float, rng: np.random.Generator) -> float:
    """A Gumbel variable of the given log-mass, no larger than ``bound``."""
    a, b = -bound, math.log(rng.standard_exponential()) - log_mass
    return -(max(a, b) + math.log1p(math.exp(-abs(a - b))))


class _Path:
    """An emitted segmentation: its edges, and ``before``, minus the log-probability ahead of each.

    Up to ``step`` it is its ``parent``; then it takes edges of its own in ``stretch`` up to ``tail``,
    from where it is a walk's, whose stretches begin at ``begins``. The first path, a walk alone, has
    no parent and begins in ``stretch``.
    """

    def __init__(
        self,
        lattices: Lattices,
        value: float,
        parent: _Path | None,
        step: int,
        fresh: list[int],
        stretch: int,
        walk: np.ndarray,
        begins: np.ndarray,
    ):
        self.value, self.parent, self.step, self.tail = value, parent, step, step + len(fresh)
        self.stretch, self.begins = stretch, begins
        own = np.concatenate([np.array(fresh, dtype=np.int64), walk]) if fresh else walk
        ahead = np.empty(len(own) + 1)
        ahead[0] = parent.before[step] if parent else 0.0
        np.negative(lattices.log_chance[own], out=ahead[1:])
        ahead = np.cumsum(ahead)
        self.edges = np.concatenate([parent.edges[:step], own]) if step else own
        self.before = np.concatenate([parent.before[:step], ahead]) if step else ahead
        self.log_prob = -float(self.before[-1])

    def owner(self, step: int) -> int:
        """The stretch of an edge."""
        path = self
        while step < path.step:
            path = path.parent
        if step < path.tail:
            return path.stretch
        later = int(np.searchsorted(path.begins, path.begins[0] + step - path.tail, side="right"))
        return path.stretch + later - (path.parent is None)


def sample_paths(
    lattices: Lattices, walks: tuple[np.ndarray, np.ndarray], text: int, k: int, rng: np.random.Generator
) -> tuple[list[_Path], float]:
    """Up to ``k`` distinct segmentations, best perturbed value first, and the value of the next one (or -inf)."""
    drawn, base = walks
    low, high = int(lattices.bounds[text]), int(lattices.bounds[text + 1])

    def free(number: int, stretch: int) -> tuple[np.ndarray, np.ndarray]:
        """What the walk of a number takes from a stretch on, and where its stretches begin."""
        begins = base[number * len(lattices.starts) + stretch : number * len(lattices.starts) + high + 1]
        return drawn[begins[0] : begins[-1]], begins

    def opened(path: _Path, first: int, last: int, bound: float) -> None:
        """Open the set that leaves a path at one of the steps from ``first`` up to ``last``."""
        gone = float(path.before[last] - path.before[first])
        if gone > 0:
            mass = math.log(-math.expm1(-gone)) - float(path.before[first])
            heapq.heappush(heap, (-_truncated(mass, bound, rng), len(paths), first, path, last, None))

    heap: list[tuple] = []
    paths: list[_Path] = []
    value = -math.log(rng.standard_exponential())
    path = _Path(lattices, value, None, 0, [], low, *free(0, low))
    start = 0
    while True:
        paths.append(path)
        opened(path, start, len(path.edges), value)
        if len(paths) == k or not heap:
            return paths, -heap[0][0] if heap else -math.inf
        best, _, step, path, last, gone = heapq.heappop(heap)
        value = -best
        if gone is None:
            # the step at which the best of the set leaves the path; what leaves it before or after stays open
            ahead = path.before[step : last + 1]
            chosen = float(ahead[0]) - math.log1p(rng.random() * math.expm1(float(ahead[0] - ahead[-1])))
            leaves = min(int(np.searchsorted(ahead, chosen, side="right")), int(np.searchsorted(ahead, ahead[-1]))) - 1
            opened(path, step, step + leaves, value)
            opened(path, step + leaves + 1, last, value)
            step += leaves
            gone = [int(path.edges[step])]
        node = int(lattices.node[path.edges[step]])
        begin = int(lattices.first[node])
        share = lattices.chance[begin : begin + int(lattices.count[node])].tolist()
        for g in gone:
            share[g - begin] = 0.0
        taken = begin + _drawn(share, rng)
        share[taken - begin] = 0.0
        left = sum(share)
        if left > 0:
            mass = math.log(left) - float(path.before[step])
            heapq.heappush(heap, (-_truncated(mass, value, rng), len(paths), step, path, step + 1, [*gone, taken]))
        # the new path: as before up to the step, the chosen piece, then freely drawn to the end
        stretch, fresh = path.owner(step), [taken]
        node += int(lattices.length[taken])
        end = int(lattices.end[node - 1])
        while node < end:
            begin = int(lattices.first[node])
            fresh.append(begin + _drawn(lattices.chance[begin : begin + int(lattices.count[node])].tolist(), rng))
            node += int(lattices.length[fresh[-1]])
        path = _Path(lattices, value, path, step, fresh, stretch, *free(len(paths), stretch + 1))
        start = step + 1


def _drawn(share: list[float], rng: np.random.Generator) -> int:
    """A place drawn in proportion to its share."""
    if len(share) == 1:
        return 0
    reached = list(accumulate(share))
    place = bisect_right(reached, rng.random() * reached[-1])
    return min(place, max(i for i, x in enumerate(share) if x))


def inclusion(log_prob: float, threshold: float) -> float:
    """The chance that a segmentation is among the samples, given the next perturbed value."""
    return 1.0 if threshold == -np.inf else float(-np.expm1(-np.exp(min(log_prob - threshold, 700.0))))


@lru_cache(maxsize=2)
def vocabulary_of(model: str = MODEL, sharpness: float = SHARPNESS) -> Vocabulary:
    return Vocabulary(model, sharpness)


def segmentations(texts: list[str], keys: list[int], k: int, vocabulary: Vocabulary) -> Iterator[list[tuple]]:
    """Per text its samples as ``ids, log_prob, perturbed, inclusion``; ``keys`` seed the noise."""
    first = 0
    while first < len(texts):
        last, chars = first, 0
        while last < len(texts) and (last == first or (chars + len(texts[last])) * k <= GROUP_CHARS):
            chars += len(texts[last])
            last += 1
        lattices = Lattices(vocabulary, texts[first:last])
        walks = lattices.walks(keys[first:last], k)
        for text, key in enumerate(keys[first:last]):
            rng = np.random.Generator(np.random.Philox(key=key))
            paths, threshold = sample_paths(lattices, walks, text, k, rng)
            yield [(lattices.spelled(p.edges), p.log_prob, p.value, inclusion(p.log_prob, threshold)) for p in paths]
        first = last


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of piece ids: pieces and bytes joined, without the space that every text is given in front."""
    size = vocabulary.text_size[ids]
    place = np.repeat(vocabulary.text_first[ids] - (np.cumsum(size) - size), size)
    text = vocabulary.text_bytes[place + np.arange(len(place))].tobytes().decode(errors="replace")
    return text[1:] if text.startswith(" ") else text


def _row_key(doc_id, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(str(doc_id).encode(), seed=seed)


def sample_segmentations(
    docs: DataFrame, k: int = SAMPLES, model: str = MODEL, sharpness: float = SHARPNESS, seed: int = SEED
) -> DataFrame:
    """Up to ``k`` distinct segmentations of each whole text of ``docs(doc_id, text)``, without replacement.

    Returns ``doc_id, sample`` (from 0, by descending perturbed value)``, ids, log_prob``
    (normalised over all segmentations)``, perturbed, inclusion``. A row's noise depends on its id
    and ``seed`` alone.

    Edge cases: an absent or empty text has one segmentation, the empty one, with certainty; a text
    with fewer than ``k`` segmentations gives all of them with inclusion 1; a character that no
    piece spells is spelled in bytes; rows without id share one seed, and repeated rows give equal
    samples; an empty table gives no rows; other columns are not read.
    """
    return _sampled(docs, k, model, sharpness, seed, _ids_rows, "ids array<int>")


def _ids_rows(samples: list[np.ndarray], texts: list[str], vocabulary: Vocabulary) -> list[tuple]:
    return [(ids.tolist(),) for ids in samples]


def _digest_rows(samples: list[np.ndarray], texts: list[str], vocabulary: Vocabulary) -> list[tuple]:
    return [
        (len(ids), zlib.crc32(ids.astype("<u4").tobytes()), decode(ids, vocabulary) == text) for ids, text in zip(samples, texts)
    ]


def segmentation_digests(docs: DataFrame, k: int = SAMPLES, model: str = MODEL, sharpness: float = SHARPNESS, seed: int = SEED):
    """As :func:`sample_segmentations`, with ``n_tokens, ids_crc32`` and whether decoding gives the text back."""
    return _sampled(docs, k, model, sharpness, seed, _digest_rows, "n_tokens bigint, ids_crc32 bigint, round_trip boolean")


def _sampled(docs: DataFrame, k: int, model: str, sharpness: float, seed: int, rows_of, columns: str) -> DataFrame:
    if k < 1:
        raise ValueError(f"at least one sample, got {k}")
    names = [c.split(" ")[0] for c in columns.split(", ")]
    types = {"array<int>": pa.list_(pa.int32()), "bigint": pa.int64(), "boolean": pa.bool_()}
    kinds = [types[c.split(" ")[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model, sharpness)
        for batch in slices(batches, SLICE_ROWS):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys = [_row_key(i, seed) for i in batch.column("doc_id").to_pylist()]
            found = [(row, s, *x) for row, xs in enumerate(segmentations(texts, keys, k, vocabulary)) for s, x in enumerate(xs)]
            digests = list(zip(*rows_of([f[2] for f in found], [texts[f[0]] for f in found], vocabulary)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())),
                    pa.array([f[1] for f in found], pa.int32()),
                    *[pa.array(c, t) for c, t in zip(digests, kinds)],
                    *[pa.array([f[i] for f in found], pa.float64()) for i in (3, 4, 5)],
                ],
                names=["doc_id", "sample", *names, "log_prob", "perturbed", "inclusion"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, sample int, {columns}, log_prob double, perturbed double, inclusion double"
    return small_batches(docs).select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)

