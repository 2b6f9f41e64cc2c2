"""Weighted acyclic automata over sequences of byte strings, as arrays.

A `Trie` holds sorted sequences level by level: each node's parent, label and weight. A `Transducer` is the minimal
form: states with equal right languages (labels, weights and targets of all that follows) are one state. It is built
incrementally from sorted sequences: when no further sequence can pass through a state, the state is looked up in a
register by its arcs and replaced by the equal one there, or added.

A sequence's weight is that of its last arc; weight 0 stands for a sequence that is only the beginning of others.
Sequences have at most as many symbols as there are levels. Symbols after the first are never empty.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

Path = tuple[bytes, ...]
_ARC = np.dtype([("label", "<i4"), ("target", "<i4"), ("weight", "<i8")])


@dataclass
class Level:
    """Nodes of one depth, sorted by parent (a node's place one level up, 0 for the first level) and label."""

    parent: np.ndarray
    label: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.label)


@dataclass
class Trie:
    symbols: pa.LargeBinaryArray  # sorted, distinct
    levels: list[Level]

    def __len__(self) -> int:
        return sum(map(len, self.levels))

    def first(self, d: int) -> np.ndarray:
        """For each node of depth d, the place of its first child; one more at the end."""
        n = len(self.levels[d - 1]) if d else 1
        return np.searchsorted(self.levels[d].parent, np.arange(n + 1))

    def path(self, d: int, i: int) -> Path:
        """The symbols from the start to node i of level d (from 0)."""
        out = []
        for level in self.levels[d::-1]:
            out.append(self.symbols[int(level.label[i])].as_py())
            i = int(level.parent[i])
        return tuple(out[::-1])

    def paths(self, least: int, depths: range) -> tuple[list[pa.Array], list[np.ndarray], list[np.ndarray]]:
        """Per depth: symbols of each level as a list array, and weights, of the sequences of weight `least` or more."""
        found = []
        for d in depths:
            at = np.flatnonzero(self.levels[d].weight >= least)
            weight, columns = self.levels[d].weight[at], []
            for level in self.levels[d::-1]:
                columns.append(level.label[at])
                at = level.parent[at]
            found.append(([self.symbols.take(pa.array(c)) for c in columns[::-1]], weight))
        return found


def sorted_symbols(symbols: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The distinct symbols, sorted, and the place of each given one among them."""
    coded = symbols.dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[np.asarray(coded.indices)]


def grouped(parent: np.ndarray, label: np.ndarray, weight: np.ndarray, n_symbols: int) -> tuple[Level, np.ndarray]:
    """Nodes by (parent, label) with summed weights, and each given row's node."""
    key = parent.astype(np.int64) * n_symbols + label
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    node = np.empty(len(key), np.int64)
    node[order] = np.cumsum(new) - 1
    total = np.add.reduceat(weight[order], starts) if len(starts) else np.empty(0, np.int64)
    return Level(key[starts] // max(1, n_symbols), (key[starts] % max(1, n_symbols)), total), node


def union(tries: list[Trie]) -> Trie:
    """All sequences of all tries, with their weights summed."""
    if len(tries) == 1:
        return tries[0]
    symbols, place = sorted_symbols(pa.concat_arrays([t.symbols for t in tries]))
    cuts = np.cumsum([0, *[len(t.symbols) for t in tries]])
    of = [place[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    nodes = [np.zeros(1, np.int64) for _ in tries]  # each trie's nodes of the level above, in the union
    levels = []
    for d in range(len(tries[0].levels)):
        parts = [t.levels[d] for t in tries]
        level, node = grouped(
            np.concatenate([n[p.parent] for n, p in zip(nodes, parts, strict=True)]),
            np.concatenate([s[p.label] for s, p in zip(of, parts, strict=True)]),
            np.concatenate([p.weight for p in parts]),
            len(symbols),
        )
        cuts = np.cumsum([0, *map(len, parts)])
        nodes = [node[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        levels.append(level)
    return Trie(symbols, levels)


def _narrowed(symbols: pa.LargeBinaryArray, levels: list[Level]) -> Trie:
    """A trie with only the symbols that its levels use."""
    used = np.unique(np.concatenate([x.label for x in levels]).astype(np.int64))
    levels = [Level(x.parent, np.searchsorted(used, x.label), x.weight) for x in levels]
    return Trie(symbols.take(pa.array(used)), levels)


def pruned(trie: Trie, least: int) -> Trie:
    """The sequences of weight `least` or more; beginnings of these with less get weight 0."""
    keep = [x.weight >= least for x in trie.levels]
    for d in range(len(keep) - 1, 0, -1):
        keep[d - 1][trie.levels[d].parent[keep[d]]] = True
    levels, place = [], np.zeros(1, np.int64)
    for x, k in zip(trie.levels, keep, strict=True):
        weight = x.weight[k]
        levels.append(Level(place[x.parent[k]], x.label[k], np.where(weight >= least, weight, 0)))
        place = np.cumsum(k) - 1
    return _narrowed(trie.symbols, levels)


def cut(trie: Trie, bounds: list[Path]) -> list[Trie | None]:
    """The trie by prefix ranges: part r has the sequences from bounds[r - 1] (included) to bounds[r], padded with ''.

    A part's first sequences may hang from nodes of an earlier part: those get weight 0. Parts without any are None.
    """
    symbols, depth = trie.symbols.to_pylist(), len(trie.levels)
    first = [trie.first(d) for d in range(depth)]
    ends = np.zeros((len(bounds) + 2, depth), np.int64)
    ends[-1] = [len(x) for x in trie.levels]
    for r, bound in enumerate(bounds, 1):
        at, exact = 0, True  # nodes before the bound so far, and whether the next one is the bound's beginning
        for d, symbol in enumerate(bound):
            low = int(first[d][at])
            if exact:
                labels = trie.levels[d].label[low : int(first[d][at + 1])]
                want = bisect_left(symbols, symbol)
                i = int(np.searchsorted(labels, want))
                exact = i < len(labels) and labels[i] == want and symbols[want] == symbol
                low += i
            at = low
            more = d + 1 < len(bound) and bound[d + 1] != b""
            ends[r, d] = at + (exact and more)
    parts: list[Trie | None] = []
    for low, high in zip(ends, ends[1:], strict=False):
        levels: list[Level] = []
        need = int(low[-1])  # the first node needed at the level
        for d in range(depth - 1, -1, -1):
            x, stop = trie.levels[d], int(high[d])
            need = min(need, int(low[d])) if d < depth - 1 else int(low[d])
            weight = x.weight[need:stop].copy()
            weight[: int(low[d]) - need] = 0
            parent = x.parent[need:stop]
            above = int(parent[0]) if len(parent) else (int(high[d - 1]) if d else 0)
            base = min(above, int(low[d - 1])) if d else 0
            levels.append(Level(parent - base, x.label[need:stop], weight))
            need = base
        levels.reverse()
        parts.append(_narrowed(trie.symbols, levels) if any(map(len, levels)) else None)
    return parts


@dataclass
class States:
    """States of one depth: each one's arcs stand from first[i] to first[i + 1]. Targets are states one level on."""

    first: np.ndarray
    label: np.ndarray
    target: np.ndarray
    weight: np.ndarray


@dataclass
class Transducer:
    symbols: pa.LargeBinaryArray
    levels: list[States]
    start: int

    def __len__(self) -> int:
        """The number of arcs."""
        return sum(len(x.label) for x in self.levels)

    def trie(self) -> Trie:
        """All sequences, one node each."""
        states, levels = np.array([self.start], np.int64), []
        for x in self.levels:
            begin = x.first[states].astype(np.int64)
            n = x.first[states + 1].astype(np.int64) - begin
            parent = np.repeat(np.arange(len(states)), n)
            arc = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            levels.append(Level(parent, x.label[arc].astype(np.int64), x.weight[arc].astype(np.int64)))
            states = x.target[arc].astype(np.int64)
        return Trie(self.symbols, levels)

    def dumps(self) -> bytes:
        at, n = self.symbols.offset, len(self.symbols)
        _, offsets, data = self.symbols.buffers()
        offsets = np.frombuffer(offsets or b"\0" * 8, np.int64)[at : at + n + 1]
        lengths, text = np.diff(offsets), bytes(memoryview(data or b"")[int(offsets[0]) : int(offsets[-1])])
        arrays = [a for x in self.levels for a in (np.diff(x.first), x.label, x.target, x.weight)]
        small = [a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)) for a in (lengths, *arrays)]
        return zstandard.compress(pickle.dumps((self.start, text, small), 5), 1)

    @classmethod
    def loads(cls, raw: bytes) -> Transducer:
        start, text, (lengths, *arrays) = pickle.loads(zstandard.decompress(raw))
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(text)]
        symbols = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), buffers)
        whole = lambda n: np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        levels = [States(whole(arrays[i]), *arrays[i + 1 : i + 4]) for i in range(0, len(arrays), 4)]
        return cls(symbols, levels, start)


def _alone(arcs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The register of states with one arc each (at `at`): places of the distinct arcs, and each state's among them."""
    rare, weight = np.unique(arcs["weight"][at], return_inverse=True)
    targets = int(arcs["target"].max(initial=0)) + 1
    key = (arcs["label"][at].astype(np.int64) * targets + arcs["target"][at]) * len(rare) + weight
    _, found, state = np.unique(key, return_index=True, return_inverse=True)
    return at[found], state


def minimal(trie: Trie) -> Transducer:
    """The minimal transducer of sorted sequences, level by level from the ends: equal states are registered once."""
    levels: list[States] = []
    target = np.zeros(len(trie.levels[-1]), np.int64)  # all that ends goes to state 0, which has no arcs
    for d in range(len(trie.levels) - 1, -1, -1):
        x, first = trie.levels[d], trie.first(d)
        arcs = np.empty(len(x), _ARC)
        arcs["label"], arcs["target"], arcs["weight"] = x.label, target, x.weight
        sizes = np.diff(first)
        state = np.zeros(len(sizes), np.int64)
        held, single = _alone(arcs, first[:-1][sizes == 1])
        state[sizes == 1] = single + 1
        register: dict[bytes, int] = {}
        more = np.flatnonzero(sizes > 1)
        raw, size = arcs.tobytes(), _ARC.itemsize
        ends = zip((first[more] * size).tolist(), (first[more + 1] * size).tolist(), strict=True)
        base = len(held) + 1
        state[more] = [register.setdefault(raw[a:b], base + len(register)) for a, b in ends]
        arcs = np.concatenate([arcs[held], np.frombuffer(b"".join(register), _ARC)])
        lengths = np.fromiter(map(len, register), np.int64, len(register)) // size
        starts = np.cumsum(np.concatenate([[0, 0], np.ones(len(held), np.int64), lengths]))
        levels.append(States(starts, arcs["label"], arcs["target"], arcs["weight"]))
        target = state
    return Transducer(trie.symbols, levels[::-1], int(target[0]))


def acceptor(paths: list[Path], depth: int) -> tuple[Trie, list[tuple[int, int]]]:
    """A trie of the given sequences, with (level, node) of each."""
    symbols = sorted({s for p in paths for s in p})
    place = {s: i for i, s in enumerate(symbols)}
    levels: list[list[tuple[int, int]]] = [[] for _ in range(depth)]
    of: dict[Path, int] = {(): 0}
    for p in sorted({p[:k] for p in paths for k in range(1, len(p) + 1)}):
        nodes = levels[len(p) - 1]
        of[p] = len(nodes)
        nodes.append((of[p[:-1]], place[p[-1]]))
    made = [np.array(x, np.int64).reshape(-1, 2) for x in levels]
    trie = Trie(pa.array(symbols, pa.large_binary()), [Level(x[:, 0], x[:, 1], np.ones(len(x), np.int64)) for x in made])
    return trie, [(len(p) - 1, of[p]) for p in paths]


def composed(sequences: Trie, weights: Transducer) -> list[np.ndarray]:
    """The composition of an acceptor with a transducer: per level, the weight that each node's sequence has in it.

    Both are passed level by level: a node and a state go on together where their labels agree.
    """
    at = pc.index_in(sequences.symbols, weights.symbols).fill_null(-1).to_numpy()
    n = len(weights.symbols)
    states, out = np.array([weights.start], np.int64), []
    for x, y in zip(sequences.levels, weights.levels, strict=True):
        owner = np.repeat(np.arange(len(y.first) - 1), np.diff(y.first))
        keys = owner * n + y.label  # ascending: states in order, labels in order within each
        state, label = states[x.parent], at[x.label].astype(np.int64)
        want = state * n + label
        i = np.minimum(np.searchsorted(keys, want), max(0, len(keys) - 1))
        hit = (state >= 0) & (label >= 0) & (keys[i] == want) if len(keys) else np.zeros(len(want), bool)
        weight, target = np.zeros(len(want), np.int64), np.full(len(want), -1, np.int64)
        weight[hit], target[hit] = y.weight[i[hit]], y.target[i[hit]]
        out.append(weight)
        states = target
    return out
