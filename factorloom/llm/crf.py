"""A linear-chain conditional random field over the shapes of words.

A *marked* word holds a digit or an at sign; all others are outside by definition.  So a text
falls into chains, the runs of neighbouring marked words, which are independent given the rest:
decoding them is decoding the whole text.  States are outside, and begin and inside of each kind.
A chain's score sums weights of its words' features per state and of its transitions; an
inside state follows a begin or inside state of its kind only.

Training maximises the likelihood of a small labelled table, less a penalty on large weights, by
plain gradient steps with the forward-backward sums; it draws nothing at random.  Decoding is
Viterbi over many chains at once: chains lie sorted by length, and a step takes all that have it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# The least score, that of a transition which cannot be.
NEVER = -1e9
PENALTY = 0.4
STEPS = 200
RATE = 0.15
# A feature of fewer labelled words than this says nothing in general.
SEEN = 2

_DIGITS = re.compile(r"[0-9]+")
_SMALL, _LARGE = re.compile(r"[a-zß-ÿ]+"), re.compile(r"[A-ZÀ-Þ]+")
_SIGNS, _BIG = re.compile("[0-9]"), re.compile("[A-Z]")
_LETTERS = re.compile(r"[^\W\d_]+")
_QUAD = re.compile(r"([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})(?![0-9.]*[0-9])")
# A shape says no more about longer words.
SHAPE = 64


def core(word: str) -> tuple[int, int]:
    """Where a word begins and ends without the punctuation around it."""
    a, b = 0, len(word)
    while a < b and not (word[a].isalnum() or word[a] == "+"):
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    if a and word[a - 1] == "(" and (")" in word[a:b] or word[b:b + 1] == ")"):
        a -= 1
    if "(" in word[a:b] and word[b:b + 1] == ")" and word.count("(", a, b) > word.count(")", a, b):
        b += 1
    return a, b


def shapes(word: str) -> tuple[str, str]:
    """The shape with the lengths of digit runs, and the one without."""
    word = word[:SHAPE]
    letters = _SMALL.sub("a", _LARGE.sub("A", word))
    return (_DIGITS.sub(lambda m: f"9{min(len(m[0]), 20)}", letters),
            re.sub(r"(\W)\1+", r"\1", _DIGITS.sub("9", letters.lower())))


def plain(word: str | None) -> str:
    """A neighbour as a feature sees it: its letters, or its rough shape."""
    if word is None:
        return "-"
    if is_marked(word):
        a, b = core(word)
        return shapes(word[a:b])[1]
    found = _LETTERS.search(word)
    return found[0].lower() if found else "."


def is_marked(word: str) -> bool:
    return any("0" <= c <= "9" or c == "@" for c in word)


@lru_cache(maxsize=1 << 14)
def features(word: str, before: str | None, after: str | None) -> list[str]:
    """The features of one marked word between its neighbours."""
    a, b = core(word)
    own = word[a:b]
    exact, rough = shapes(own)
    digits = sum("0" <= c <= "9" for c in own)
    letters = sum(c.isalpha() for c in own)
    left, right = plain(before), plain(after)
    out = ["bias", "s:" + exact, "c:" + rough, f"n:{min(digits, 20)}",
           "l:" + str(min(letters, 6)), "p:" + left, "q:" + right,
           f"c:{rough} p:{left}", f"c:{rough} q:{right}"]
    quad = _QUAD.match(own)
    if quad:
        out.append("quad" if all(int(g) < 256 for g in quad.groups()) else "no quad")
    if "@" in own:
        out.append("at" + (" dot" if "." in own.split("@", 1)[1] else ""))
        tail = own.rsplit("@", 1)[1]
        out.append("at " + ("number" if tail[:1].isdigit() else "name" if tail else "end")
                   + ("" if own[0] != "@" else " first"))
    if own.startswith("+"):
        out.append("plus")
    if own.startswith("("):
        out.append("open")
    if own.count(":") > 1:
        out.append("colons")
    if digits == len(own):
        out.append(f"number {min(digits, 20)}")
    if letters > 1 and digits > 3 and digits + letters == len(own):
        out += ["mixed", "head " + _SIGNS.sub("9", _BIG.sub("A", own[:4]))]
    if digits and not letters:
        groups = [len(g) for g in _DIGITS.findall(own[:SHAPE])]
        out += [f"groups {len(groups)} of {digits}", f"longest group {max(groups, default=0)}"]
    return out


@dataclass
class Model:
    """Feature numbers, weights per feature and state, weights per pair of states."""

    kinds: tuple[str, ...]
    index: dict[str, int]
    state: np.ndarray
    step: np.ndarray

    @property
    def states(self) -> int:
        return 1 + 2 * len(self.kinds)


def allowed(kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """0 or ``NEVER`` for each pair of states and for each first state."""
    size = 1 + 2 * kinds
    inside = np.arange(size) > 0
    inside &= np.arange(size) % 2 == 0
    pairs = np.zeros((size, size))
    for s in np.flatnonzero(inside):
        pairs[:, s] = NEVER
        pairs[[s - 1, s], s] = 0.0
    return pairs, np.where(inside, NEVER, 0.0)


class Chains:
    """Chains of feature numbers, longest first, laid out step by step.

    ``rows[t]`` are the places of the words that are step ``t`` of their chain.
    """

    def __init__(self, chains: list[list[list[int]]]):
        lengths = np.array([len(c) for c in chains], dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]].astype(np.int64)
        longest = int(self.lengths[0]) if len(chains) else 0
        running = np.searchsorted(-self.lengths, -np.arange(longest), "left")
        self.rows = [self.starts[:n] + t for t, n in enumerate(running.tolist())]
        words = [w for c in self.order.tolist() for w in chains[c]]
        counts = np.array([len(w) for w in words], dtype=np.int64)
        self.word = np.repeat(np.arange(len(words)), counts)
        self.feature = np.array([f for w in words for f in w], dtype=np.int64)
        self.size = len(words)

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((self.size, weights.shape[1]))
        np.add.at(out, self.word, weights[self.feature])
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def forward_backward(chains: Chains, emit: np.ndarray, step: np.ndarray, first: np.ndarray):
    """Log-likelihood sums: per word and state the marginal, expected transitions, log Z."""
    ahead, back = np.zeros_like(emit), np.zeros_like(emit)
    for t, rows in enumerate(chains.rows):
        if t == 0:
            ahead[rows] = emit[rows] + first
        else:
            ahead[rows] = emit[rows] + _log_sum(ahead[rows - 1][:, :, None] + step, 1)
    for rows in chains.rows[:0:-1]:
        back[rows - 1] = _log_sum(step + (emit[rows] + back[rows])[:, None, :], 2)
    ends = chains.starts + chains.lengths - 1
    total = _log_sum(ahead[ends], 1)
    per_word = np.repeat(total, chains.lengths)
    marginal = np.exp(ahead + back - per_word[:, None])
    moves = np.zeros_like(step)
    for rows in chains.rows[1:]:
        moves += np.exp(ahead[rows - 1][:, :, None] + step + (emit[rows] + back[rows])[:, None, :]
                        - per_word[rows][:, None, None]).sum(axis=0)
    return marginal, moves, float(total.sum())


def viterbi(chains: Chains, emit: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best state of every word; equal scores go to the smaller state."""
    best, back = None, []
    ends = np.zeros((len(chains.lengths), emit.shape[1]))
    for t, rows in enumerate(chains.rows):
        if t == 0:
            best = emit[rows] + first
        else:
            ways = best[:len(rows)][:, :, None] + step
            come = ways.argmax(axis=1)
            back.append(come.astype(np.int8))
            best = emit[rows] + np.take_along_axis(ways, come[:, None, :], 1)[:, 0]
        ends[:len(rows)] = best
    out = np.zeros(chains.size, dtype=np.int64)
    state = ends.argmax(axis=1)
    for t in range(len(chains.rows) - 1, -1, -1):
        rows = chains.rows[t]
        out[rows] = state[:len(rows)]
        if t:
            state[:len(rows)] = back[t - 1][np.arange(len(rows)), state[:len(rows)]]
    return out


def run_features(words: list[str], before: str | None, after: str | None
                 ) -> Iterator[list[str]]:
    """The features of each word of a run of marked words, with those of the run."""
    sizes = [sum("0" <= c <= "9" for c in w) for w in words]
    first = words[0][core(words[0])[0]:][:1]
    run = [f"run {min(len(words), 8)} of {min(sum(sizes), 24)}", f"run of {min(sum(sizes), 24)}",
           f"run {min(len(words), 8)}",
           "run from " + (first if not first.isalnum() else "a" if first.isalpha() else "9"),
           f"run even {len(words) > 2 and len(set(sizes)) == 1}", "run after " + plain(before)]
    around = [before, *words, after]
    for i, word in enumerate(words):
        yield features(word, around[i], around[i + 2]) + run


def marked_runs(words: list[str]) -> list[tuple[int, int]]:
    """The runs [a, b) of neighbouring marked words."""
    out, a = [], None
    for i, word in enumerate([*words, ""]):
        if is_marked(word):
            a = i if a is None else a
        elif a is not None:
            out.append((a, i))
            a = None
    return out


def train(examples: list[tuple[list[str], list[int]]], kinds: tuple[str, ...],
          steps: int = STEPS, penalty: float = PENALTY, rate: float = RATE) -> Model:
    """A model from sentences, each a list of words and of their states."""
    named, states = [], []
    for words, own in examples:
        for a, b in marked_runs(words):
            named.append(list(run_features(words[a:b], words[a - 1] if a else None,
                                           words[b] if b < len(words) else None)))
            states.append(own[a:b])
    seen = Counter(f for chain in named for word in chain for f in set(word))
    index = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= SEEN))}
    chains = [[[index[f] for f in word if f in index] for word in chain] for chain in named]
    size = 1 + 2 * len(kinds)
    pairs, first = allowed(len(kinds))
    laid = Chains(chains)
    truth = np.array([s for c in laid.order.tolist() for s in states[c]], dtype=np.int64)
    weights, moves = np.zeros((len(index), size)), np.zeros((size, size))
    known = np.zeros_like(weights)
    np.add.at(known, (laid.feature, truth[laid.word]), 1.0)
    known_moves = np.zeros_like(moves)
    for rows in laid.rows[1:]:
        np.add.at(known_moves, (truth[rows - 1], truth[rows]), 1.0)
    mean, square = [np.zeros_like(weights), np.zeros_like(moves)], [0.0, 0.0]
    for n in range(1, steps + 1 if chains else 1):
        marginal, expected, _ = forward_backward(
            laid, laid.emissions(weights), moves + pairs, first)
        fitted = np.zeros_like(weights)
        np.add.at(fitted, laid.feature, marginal[laid.word])
        for i, (own, slope) in enumerate((
                (weights, known - fitted - penalty * weights),
                (moves, known_moves - expected - penalty * moves))):
            # steps of like size for all weights, however rare their feature
            mean[i] = 0.9 * mean[i] + 0.1 * slope
            square[i] = 0.99 * square[i] + 0.01 * slope ** 2
            own += rate * (mean[i] / (1 - 0.9 ** n)) / (
                np.sqrt(square[i] / (1 - 0.99 ** n)) + 1e-8)
    return Model(kinds, index, weights, moves + pairs)


def decode(model: Model, chains: Iterable[Iterable[list[str]]]) -> list[list[int]]:
    """The states of chains of words, given as their features; unknown features say nothing."""
    index = model.index
    numbered = [[[index[f] for f in word if f in index] for word in chain] for chain in chains]
    if not numbered:
        return []
    laid = Chains(numbered)
    found = viterbi(laid, laid.emissions(model.state), model.step, allowed(len(model.kinds))[1])
    out: list[list[int]] = [[]] * len(numbered)
    for place, start, length in zip(laid.order.tolist(), laid.starts.tolist(),
                                    laid.lengths.tolist()):
        out[place] = found[start:start + length].tolist()
    return out
