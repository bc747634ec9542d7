"""A linear-chain conditional random field over labelled words, in numpy.

Scores of a word come from its affixes, its character n-grams and a lexicon; transitions between the
labels of neighbouring words are learned. Forward-backward runs over blocks of words side by side; blocks
of one text are chained by their transfer matrices, so the result is that of the whole chain.
"""

from __future__ import annotations

from itertools import islice
from typing import NamedTuple

import numpy as np

#: Words of a block.
BLOCK = 256
#: Weight of the squared parameters beside the mean loss of a word.
RIDGE = 1e-5
STEPS = 60


class Field(NamedTuple):
    labels: list[str]
    features: np.ndarray  # keys of pieces of words, ascending
    weights: np.ndarray  # a row per feature, a column per label
    lexicon: dict[str, int]  # rows of ``known``
    known: np.ndarray  # scores of the lexicon's words by their frequencies; the last row is for all others
    moves: np.ndarray  # log weights of transitions


def pieces(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(key, word) of the n-grams of two and three letters and the affixes of three and four, with < and >
    at the ends of words. Keys of n-grams are their code points; those of affixes are hashes."""
    text = "<" + "><".join(words) + ">"
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(points))
    step = np.uint64(21)
    two = (points[:-1] << step) | points[1:]
    keys, owners = [two[left[:-1] >= 2]], [word[left >= 2]]
    if len(points) > 2:
        three = (two[:-1] << step) | points[2:]
        keys.append(three[left[:-2] >= 3])
        owners.append(word[left >= 3])
    for n in (4, 5):
        long = np.flatnonzero(sizes >= n)
        for side, at in ((n, starts[long]), (n + 2, ends[long] - n)):
            mixed = np.full(len(long), side, dtype=np.uint64)
            for i in range(n):
                mixed = (mixed ^ points[at + i]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            keys.append(mixed | np.uint64(1 << 63))
            owners.append(long)
    return np.concatenate(keys), np.concatenate(owners)


def lexicon_rows(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Each label's share of a word's relative frequencies, and 1 in the last column where it has none."""
    rate = counts / totals
    whole = rate.sum(axis=1, keepdims=True)
    none = whole == 0
    return np.concatenate([rate / np.where(none, 1.0, whole), none.astype(np.float64)], axis=1)


def _gathered(weights: np.ndarray, rows: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows of ``weights`` per owner."""
    return np.stack([np.bincount(owners, weights=w[rows], minlength=n) for w in weights.T], axis=1)


def _sweeps(p: np.ndarray, live: list[int], start: np.ndarray, end: np.ndarray, a: np.ndarray, pairs: np.ndarray | None = None):
    """(marginals, log scales summed) of sequences laid side by side.

    ``p`` is (place, sequence, label), the longest sequence first; ``live[i]`` of them have a place i.
    ``start`` stands before the first place and ``end`` behind the last. Expected transitions are added
    to ``pairs``.
    """
    alpha, logs, now = np.empty_like(p), 0.0, start.copy()
    for i, m in enumerate(live):
        step = (now[:m] @ a) * p[i, :m]
        scale = step.sum(axis=1, keepdims=True)
        now[:m] = alpha[i, :m] = step / scale
        if pairs is not None:
            logs += float(np.log(scale).sum())
    beta = end.copy()
    marginals = np.zeros_like(p)
    for i in range(len(live) - 1, -1, -1):
        m = live[i]
        both = alpha[i, :m] * beta[:m]
        marginals[i, :m] = both / both.sum(axis=1, keepdims=True)
        ahead = p[i, :m] * beta[:m]
        if pairs is not None:
            before = alpha[i - 1, :m] if i else start[:m]
            mass = ((before @ a) * ahead).sum(axis=1, keepdims=True)
            pairs += a * (before.T @ (ahead / mass))
        beta[:m] = ahead @ a.T
        beta[:m] /= beta[:m].sum(axis=1, keepdims=True)
    return marginals, logs


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Probability of each label at each word, for texts whose words lie one behind the other in ``scores``."""
    labels = scores.shape[1]
    a = np.exp(moves - moves.max())
    counts = -(-lengths // block)
    text = np.repeat(np.arange(len(lengths)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    ordinal = np.arange(len(text)) - first
    begin = np.repeat(np.cumsum(lengths) - lengths, counts) + ordinal * block
    size = np.minimum(block, lengths[text] - ordinal * block)
    order = np.argsort(-size, kind="stable")
    begin, size, text, ordinal = begin[order], size[order], text[order], ordinal[order]
    longest = int(size[0]) if len(size) else 0
    live = [int(m) for m in np.searchsorted(-size, -np.arange(longest), side="left")]
    at = np.minimum(begin[None, :] + np.arange(longest)[:, None], max(len(scores) - 1, 0))
    p = np.exp(scores - scores.max(axis=1, keepdims=True))[at]
    start = np.full((len(size), labels), 1 / labels)
    end = np.full((len(size), labels), 1 / labels)

    chained = np.flatnonzero(counts[text] > 1)
    if len(chained):
        transfer = np.broadcast_to(np.eye(labels), (len(chained), labels, labels)).copy()
        for i in range(longest):
            m = int(np.searchsorted(chained, live[i]))
            step = (transfer[:m] @ a) * p[i, chained[:m], None, :]
            transfer[:m] = step / step.sum(axis=(1, 2), keepdims=True)
        place = {(int(text[b]), int(ordinal[b])): j for j, b in enumerate(chained)}
        most = int(ordinal[chained].max())
        for k in range(1, most + 1):
            here = [(t, k) for t in np.flatnonzero(counts > k)]
            now, before = [place[x] for x in here], [place[t, k - 1] for t, _ in here]
            step = np.einsum("ni,nij->nj", start[chained[before]], transfer[before])
            start[chained[now]] = step / step.sum(axis=1, keepdims=True)
        for k in range(most - 1, -1, -1):
            here = [(t, k) for t in np.flatnonzero(counts > k + 1)]
            now, behind = [place[x] for x in here], [place[t, k + 1] for t, _ in here]
            step = np.einsum("nij,nj->ni", transfer[behind], end[chained[behind]])
            end[chained[now]] = step / step.sum(axis=1, keepdims=True)

    found, _ = _sweeps(p, live, start, end, a)
    out = np.empty_like(scores)
    inside = np.arange(longest)[:, None] < size[None, :]
    out[at[inside]] = found[inside]
    return out


def _minimum(loss, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with a halving line search; ``loss`` gives value and gradient."""
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, kept = slope.copy(), []
        for s, y, r in reversed(past):
            kept.append(r * (s @ way))
            way -= kept[-1] * y
        if past:
            s, y, r = past[-1]
            way *= 1 / (r * (y @ y))
        for (s, y, r), k in zip(past, reversed(kept)):
            way += s * (k - r * (y @ way))
        down, length = slope @ way, 1.0 if past else 1 / max(1.0, float(np.abs(slope).sum()))
        while length > 1e-10:
            new_value, new_slope = loss(x - length * way)
            if new_value <= value - 1e-4 * length * down:
                break
            length /= 2
        else:
            break
        s, y = -length * way, new_slope - slope
        gain, x, value, slope = value - new_value, x + s, new_value, new_slope
        if s @ y > 1e-12:
            past = [*past, (s, y, 1 / (s @ y))][-memory:]
        if gain < 1e-6 * max(1.0, abs(value)):
            break
    return x


def fit(
    sequences: list[list[tuple[str, int]]],
    labels: list[str],
    lexicon: dict[str, list[float]],
    totals: np.ndarray,
    ridge: float = RIDGE,
    steps: int = STEPS,
) -> Field:
    """The field that makes the labels of ``sequences`` of (word, label) likeliest, by gradient steps.

    ``lexicon`` has a word's count per label; in training a word's own occurrence is taken off, so that it
    does not vouch for itself. Features are those of the sequences' words; the driver holds them and a weight
    per feature and label.
    """
    k = len(labels)
    sequences = sorted((s for s in sequences if s), key=len, reverse=True)
    kinds: dict[tuple[str, int], int] = {}
    tokens = [[kinds.setdefault(t, len(kinds)) for t in s] for s in sequences]
    keys, owners = pieces([w for w, _ in kinds])
    features, flat = np.unique(keys, return_inverse=True)
    gold = np.array([y for _, y in kinds])
    counts = np.array([lexicon.get(w, [0.0] * k) for w, _ in kinds], dtype=np.float64)
    counts[np.arange(len(kinds)), gold] = np.maximum(counts[np.arange(len(kinds)), gold] - 1, 0)
    shares = lexicon_rows(counts, totals)
    lengths = np.array([len(t) for t in tokens])
    longest = int(lengths[0])
    live = [int((lengths > i).sum()) for i in range(longest)]
    at = np.zeros((longest, len(tokens)), dtype=np.int64)
    for j, t in enumerate(tokens):
        at[: len(t), j] = t
    inside = np.arange(longest)[:, None] < lengths[None, :]
    known = at[inside]
    words = len(known)
    follow = np.zeros((k, k))
    for i in range(1, longest):
        np.add.at(follow, (gold[at[i - 1, : live[i]]], gold[at[i, : live[i]]]), 1)
    edge = np.zeros((len(tokens), k))
    shape = [(len(features), k), (k + 1, k), (k, k)]
    cuts = np.cumsum([a * b for a, b in shape])
    target = np.bincount(known, minlength=len(kinds))

    def opened(x: np.ndarray) -> list[np.ndarray]:
        return [part.reshape(s) for part, s in zip(np.split(x, cuts[:-1]), shape)]

    def loss(x: np.ndarray):
        weights, of_share, moves = opened(x)
        scores = _gathered(weights, flat, owners, len(kinds)) + shares @ of_share
        top = scores.max(axis=1, keepdims=True)
        p = np.exp(scores - top)[at]
        a = np.exp(moves)
        pairs = np.zeros((k, k))
        found, logs = _sweeps(p, live, edge + 1 / k, edge + 1.0, a, pairs)
        # The first word of a sequence follows the uniform start, which no label stands for.
        first = np.bincount(gold[at[0]], minlength=k)
        into = np.exp(moves).sum(axis=0) / k
        path = float((scores[known, gold[known]] - top[known, 0]).sum() + (follow * moves).sum() + first @ np.log(into))
        excess = np.stack([np.bincount(known, weights=f, minlength=len(kinds)) for f in found[inside].T], axis=1)
        excess[np.arange(len(kinds)), gold] -= target
        from_first = np.exp(moves) / k * (first / into)[None, :]
        grads = [_gathered(excess, owners, flat, len(features)), shares.T @ excess, pairs - follow - from_first]
        slope = np.concatenate([g.ravel() for g in grads]) / words + 2 * ridge * x
        return (logs - path) / words + ridge * float(x @ x), slope

    weights, of_share, moves = opened(_minimum(loss, np.zeros(cuts[-1]), steps))
    listed = np.array([*lexicon.values(), [0.0] * k], dtype=np.float64)
    return Field(labels, features, weights, {w: i for i, w in enumerate(lexicon)}, lexicon_rows(listed, totals) @ of_share, moves)


class Scorer:
    """Scores of words, kept per word; the store is emptied between batches once it holds ``most`` words."""

    def __init__(self, field: Field, most: int = 1 << 18):
        self.field, self.most = field, most
        self.ids: dict[str, int] = {}
        self.rows = np.zeros((0, len(field.labels)))

    def _scored(self, words: list[str]) -> np.ndarray:
        field = self.field
        other = len(field.lexicon)
        rows = field.known[[field.lexicon.get(w, other) for w in words]]
        keys, owners = pieces(words)
        at = np.minimum(np.searchsorted(field.features, keys), len(field.features) - 1)
        met = field.features[at] == keys
        return rows + _gathered(field.weights, at[met], owners[met], len(words))

    def scores(self, words: list[str]) -> np.ndarray:
        if len(self.ids) > self.most:
            self.ids, self.rows = {}, self.rows[:0]
        ids, before = self.ids, len(self.ids)
        at = [ids.setdefault(w, len(ids)) for w in words]
        if len(ids) > before:
            new = list(islice(reversed(ids), len(ids) - before))[::-1]
            if len(self.rows) < len(ids):
                self.rows = np.concatenate([self.rows, np.empty((len(self.rows) + 2 * len(new), self.rows.shape[1]))])
            self.rows[before : len(ids)] = self._scored(new)
        return self.rows[at]
