"""Linear-chain conditional random field over the words of texts, in numpy.

A word's score for a language is the sum of the weights of its features: character
n-grams, longer affixes, and the word itself (the lexicon), hashed into one table. A
learned matrix scores the change from one word's language to the next one's.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import regex

#: A word is a run of letters, each with the marks that belong to it.
WORD = regex.compile(r"(?:\p{L}\p{M}*)+")

_SLOTS = 1 << 18
_GRAMS = (1, 2, 3)
_AFFIXES = (3, 4, 5)
_PRIME = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    mixed = (hashes + np.uint64(kind)) * _SPREAD
    return ((mixed ^ (mixed >> np.uint64(29))) * _SPREAD >> np.uint64(46)).astype(np.int64)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, slot) of every feature of every word."""
    marked = ["\x02" + w + "\x03" for w in words]
    size = np.array([len(w) for w in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    begin = np.cumsum(size) - size
    at = np.arange(len(codes)) - begin[word]
    left = size[word] - at
    found = []
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, max(*_GRAMS, *_AFFIXES) + 1):
        rolled[: len(codes) - n + 1] = (
            rolled[: len(codes) - n + 1] * _PRIME + codes[n - 1 :] + np.uint64(1)
        )
        full = left >= n
        if n in _GRAMS:
            use = full & (size[word] > n)
            found.append((word[use], _slots(rolled[use], n)))
        if n in _AFFIXES:
            for edge, kind in ((at == 0, 16 + n), (left == n, 32 + n)):
                use = full & edge
                found.append((word[use], _slots(rolled[use], kind)))
    whole = np.zeros(len(words), np.uint64)
    if len(codes):
        powers = _PRIME ** at.astype(np.uint64)
        whole = np.add.reduceat((codes + np.uint64(1)) * powers, begin)
    found.append((np.arange(len(words)), _slots(whole, 64)))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


@dataclass
class Model:
    """Languages in code point order, feature weights, and scores of starts and changes."""

    languages: list[str]
    weights: np.ndarray
    start: np.ndarray
    change: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        word, slot = word_features(words)
        out = np.empty((len(words), len(self.languages)), np.float32)
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(word, self.weights[slot, k], len(words))
        return out


def _softened(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


class Packed:
    """Sequences, longest first, laid out step by step so that all advance together."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        size = lengths[self.order]
        longest = int(size[0]) if len(size) else 0
        #: How many sequences have a word at each step, and where the step begins.
        self.live = np.searchsorted(-size, -np.arange(longest), side="left")
        self.begin = np.concatenate([[0], np.cumsum(self.live)])
        first = np.cumsum(lengths) - lengths
        which = np.concatenate([np.arange(n) for n in self.live] or [np.empty(0, np.int64)])
        step = np.repeat(np.arange(longest), self.live)
        #: For each packed place, the place of its word in the sequences end to end.
        self.source = first[self.order][which] + step
        self.which = which


def posteriors(model: Model, scores: np.ndarray, packed: Packed) -> np.ndarray:
    """Probabilities of each language for each packed word, by forward-backward."""
    e = _softened(scores)
    change = _softened(model.change.ravel()).reshape(model.change.shape).astype(np.float32)
    start = _softened(model.start).astype(np.float32)
    out = np.empty_like(e)
    begin, live = packed.begin, packed.live
    a = None
    for t, n in enumerate(live):
        now = e[begin[t] : begin[t + 1]]
        a = now * start if a is None else (a[:n] @ change) * now
        a /= a.sum(axis=1, keepdims=True)
        out[begin[t] : begin[t + 1]] = a
    b = np.ones((live[0] if len(live) else 0, e.shape[1]), np.float32)
    back = np.ascontiguousarray(change.T)
    for t in range(len(live) - 2, -1, -1):
        n = live[t + 1]
        behind = (e[begin[t + 1] : begin[t + 2]] * b[:n]) @ back
        b[:n] = behind / behind.sum(axis=1, keepdims=True)
        p = out[begin[t] : begin[t + 1]]
        p *= b[: live[t]]
        p /= p.sum(axis=1, keepdims=True)
    return out


def train(
    texts: Iterable[tuple[str, str]],
    segment: int = 12,
    steps: int = 48,
    segments_per_text: int = 10,
    epochs: int = 3,
    batch: int = 128,
    rate: float = 0.5,
    seed: int = 2,
) -> Model:
    """Fit a model to (language, text) pairs.

    Segments of the texts are strung together in random order into sequences of `steps`
    words, so that changes of language are seen and learned. The log-likelihood climbs by
    adaptive gradient steps with a fixed seed: the same texts give the same model.
    """
    rng = np.random.default_rng(seed)
    by_language: dict[str, list[list[str]]] = {}
    for language, text in texts:
        words = WORD.findall(text.lower())
        pieces = [words[i : i + segment] for i in range(0, len(words), segment)]
        if len(pieces) > segments_per_text:
            chosen = rng.choice(len(pieces), segments_per_text, replace=False)
            pieces = [pieces[i] for i in sorted(chosen)]
        by_language.setdefault(language, []).extend(pieces)
    languages = sorted(by_language)
    vocabulary: dict[str, int] = {}
    most = max((len(p) for p in by_language.values()), default=0)
    pool = []
    for k, language in enumerate(languages):
        pieces = by_language[language]
        # Languages with few texts are shown as often as the others.
        for i in range(most if pieces else 0):
            words = [vocabulary.setdefault(w, len(vocabulary)) for w in pieces[i % len(pieces)]]
            pool.append((k, words))
    model = Model(
        languages,
        np.zeros((_SLOTS, len(languages)), np.float32),
        np.zeros(len(languages), np.float32),
        np.zeros((len(languages), len(languages)), np.float32),
    )
    if not pool:
        return model
    word, slot = word_features(list(vocabulary))
    squares = [np.full_like(x, 1e-2) for x in (model.weights, model.start, model.change)]
    for _ in range(epochs):
        mixed = [pool[i] for i in rng.permutation(len(pool))]
        ids = np.array([i for _, words in mixed for i in words])
        gold = np.array([k for k, words in mixed for _ in words])
        n = max(1, len(ids) // steps)
        ids, gold = ids[: n * steps].reshape(n, -1), gold[: n * steps].reshape(n, -1)
        for at in range(0, n, batch):
            x, y = ids[at : at + batch], gold[at : at + batch]
            _step(model, x, y, word, slot, len(vocabulary), squares, rate)
    return model


def _step(model, x, y, word, slot, n_words, squares, rate) -> None:
    size, length = x.shape
    kinds = len(model.languages)
    scores = np.empty((n_words, kinds), np.float32)
    for k in range(kinds):
        scores[:, k] = np.bincount(word, model.weights[slot, k], n_words)
    e = _softened(scores[x])
    change, start = np.exp(model.change), np.exp(model.start)
    a, b = np.empty_like(e), np.ones_like(e)
    a[:, 0] = e[:, 0] * start
    a[:, 0] /= a[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        a[:, t] = (a[:, t - 1] @ change) * e[:, t]
        a[:, t] /= a[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        b[:, t] = (e[:, t + 1] * b[:, t + 1]) @ change.T
        b[:, t] /= b[:, t].sum(axis=1, keepdims=True)
    p = a * b
    p /= p.sum(axis=2, keepdims=True)
    wrong = p.copy()
    np.put_along_axis(
        wrong, y[..., None], np.take_along_axis(wrong, y[..., None], 2) - 1, 2
    )
    g_change = np.zeros_like(model.change)
    for t in range(1, length):
        pair = a[:, t - 1, :, None] * change * (e[:, t] * b[:, t])[:, None, :]
        g_change += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        np.add.at(g_change, (y[:, t - 1], y[:, t]), -1)
    g_weights = np.empty_like(model.weights)
    flat = x.ravel()
    for k in range(kinds):
        per_word = np.bincount(flat, wrong[..., k].ravel(), n_words)
        g_weights[:, k] = np.bincount(slot, per_word[word], len(g_weights))
    gradients = (g_weights, wrong[:, 0].sum(axis=0), g_change)
    for value, square, g in zip(
        (model.weights, model.start, model.change), squares, gradients, strict=True
    ):
        g = (g / size).astype(np.float32)
        square += g * g
        value -= rate * g / np.sqrt(square)
