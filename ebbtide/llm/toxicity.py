"""Toxicity (3): a bidirectional gated recurrent network with attention pooling, over word and character inputs.

A word's input is made of the word itself (a trained vector, and how much more often the word stands in
toxic texts) and of its characters (the mean of its n-grams' trained vectors, and their largest and
mean such evidence). Two recurrent passes read a window of words, attention weighs their states, and
one output says how toxic the window is. All overlapping windows of a text, one from each word on, are
scored; its score is that of its most toxic window, set to the scale of a probability on the training texts.

The network and the evidence are learnt on the driver, in numpy, from at most ``max_toxic`` toxic and
``max_clean`` clean labelled texts of at most ``max_chars`` characters, drawn by hash; copies within a label
count once, before the draw. The evidence of a training text comes from the other half of the sample, so that
the network learns how far to trust it; near copies are dealt to one half as a rule, and all are learnt from.
Scoring is one narrow pass over the whole texts; the model (a few MB, whatever the input) travels with
the tasks.
"""

from __future__ import annotations

import dataclasses
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, pack
from .shingles import U, mixed

MARKS = ".,;:!?\"'()[]{}<>*_-…»«“”"
#: Words whose inputs a worker process remembers.
KEPT = 200_000
#: Longer tokens are split; at most so many characters, and a step of half as many, where nothing in them separates words.
LONG, PIECE = 48, 24
#: Characters of scripts that are written without spaces (Thai to Tibetan, Burmese, Khmer, Chinese, Japanese, Yi).
UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff]+")
WORD = re.compile(r"[^\W_]+[\W_]*|[\W_]+")


@dataclasses.dataclass(frozen=True)
class Network:
    """Settings of the network and of the sample that it is fitted on."""

    window: int = 14
    stride: int = 1
    hidden: int = 6
    vector: int = 4
    grams: tuple[int, ...] = (4, 5, 6)
    word_slots: int = 1 << 20
    gram_slots: int = 1 << 18
    vector_slots: int = 1 << 12
    max_toxic: int = 2000
    max_clean: int = 4000
    max_chars: int = 20_000
    #: Texts of the sample are taken for near copies when the smallest hash of so many words in a row is the same.
    kin: int = 5
    epochs: int = 6
    batch: int = 128
    rate: float = 0.01
    least_steps: int = 400
    #: Share of words whose trained vectors are hidden in a training step, and those vectors' share of the rate.
    hide: float = 0.9
    slow: float = 0.03
    seed: int = 3

    @property
    def inputs(self) -> int:
        return 2 * self.vector + 3


def pieces(text: str, size: int, step: int) -> list[str]:
    """Overlapping pieces of a text, the last one ends with it."""
    return [text[k : k + size] for k in range(0, len(text) - size, step)] + [text[-size:]]


def split_long(token: str) -> list[str]:
    if len(token) <= LONG:
        return [token] if token else []
    words = WORD.findall(token)
    return [p for w in words for p in (pieces(w, PIECE, PIECE // 2) if len(w) > LONG else (w,))]


def text_tokens(text: str | None) -> list[str]:
    """Lower-case tokens between white space. Every character of the text lies in one: scripts without
    spaces come as all pairs of neighbours, and a token of over ``LONG`` characters as its words, or pieces."""
    lower = text.lower() if text else ""
    tokens = lower.split()
    unspaced = not lower.isascii() and UNSPACED.search(lower) is not None
    if not unspaced and max(map(len, tokens), default=0) <= LONG:
        return tokens
    out: list[str] = []
    for token in tokens:
        end = 0
        for m in UNSPACED.finditer(token) if unspaced else ():
            out += split_long(token[end : m.start()]) + pieces(m[0], 2, 1)
            end = m.end()
        out += split_long(token[end:])
    return out


def word_slots(tokens: list[str], net: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, n-gram hashes, owner of each n-gram): n-grams of the word between two end marks."""
    words = [t.strip(MARKS) or t for t in tokens]
    raw = [b"\x02" + w.encode("utf-8", "surrogatepass") + b"\x03" for w in words]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(begins, sizes)
    owner = np.repeat(np.arange(len(raw)), sizes)
    values = mixed(data + U(1) + place.astype(np.uint64) * U(0x100))
    word = mixed(np.add.reduceat(values, begins)) if len(raw) else np.zeros(0, dtype=np.uint64)
    found, owners = [], []
    for n in net.grams:
        if len(data) < n:
            continue
        total = np.zeros(len(data) - n + 1, dtype=np.uint64)
        for k in range(n):
            total = total * U(0x100000001B3) + data[k : len(data) - n + 1 + k] + U(1)
        inside = owner[: len(total)] == owner[n - 1 :]
        found.append(mixed(total[inside] + U(n * 0x9E3779B97F4A7C15 % 2**64)))
        owners.append(owner[: len(total)][inside])
    none = np.zeros(0, dtype=np.int64)
    return word, np.concatenate(found) if found else none.astype(np.uint64), np.concatenate(owners) if owners else none


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log odds of standing in a toxic text, drawn towards 0 where few texts say so; 0 if none does."""
    seen = toxic + clean
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return np.where(seen > 0, odds * seen / (seen + 3.0), 0.0).astype(np.float32)


class Evidence:
    """What a set of labelled texts says of words and n-grams, by hash slot."""

    def __init__(self, net: Network):
        self.net = net
        self.words = np.zeros((2, net.word_slots), dtype=np.int32)
        self.grams = np.zeros((2, net.gram_slots), dtype=np.int32)
        self.texts = [0, 0]

    def add(self, word_ids: np.ndarray, gram_ids: np.ndarray, label: int) -> None:
        self.words[label][word_ids] += 1
        self.grams[label][gram_ids] += 1
        self.texts[label] += 1

    def odds(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(evidence(c[1], c[0], self.texts[1], self.texts[0]) for c in (self.words, self.grams))


class Inputs:
    """Inputs of words: fixed evidence, and the slots of the trained vectors."""

    def __init__(self, tokens: list[str], net: Network):
        self.net = net
        word, gram, owner = word_slots(tokens, net)
        order = np.argsort(owner, kind="stable")
        self.owner, gram = owner[order], gram[order]
        self.word_id = (word % U(net.word_slots)).astype(np.int64)
        self.gram_id = (gram % U(net.gram_slots)).astype(np.int64)
        self.word_vector = (word >> U(40)).astype(np.int64) % net.vector_slots
        self.gram_vector = (gram >> U(40)).astype(np.int64) % net.vector_slots
        self.counts = np.bincount(self.owner, minlength=len(tokens)).astype(np.float32)
        self.starts = np.cumsum(self.counts, dtype=np.int64) - self.counts.astype(np.int64)

    def fixed(self, word_odds: np.ndarray, gram_odds: np.ndarray) -> np.ndarray:
        """[words, 3]: the word's evidence, and the largest and mean evidence of its n-grams."""
        out = np.zeros((len(self.counts), 3), dtype=np.float32)
        out[:, 0] = word_odds[self.word_id]
        if len(self.gram_id):
            values, some = gram_odds[self.gram_id], self.counts > 0
            out[some, 1] = np.maximum.reduceat(values, self.starts[some])
            out[some, 2] = np.add.reduceat(values, self.starts[some]) / self.counts[some]
        return out

    def vectors(self, weights: dict[str, np.ndarray]) -> np.ndarray:
        """[words, 2 * vector]: the word's trained vector, and the mean of its n-grams' vectors."""
        size = self.net.vector
        out = np.zeros((len(self.counts), 2 * size), dtype=np.float32)
        out[:, :size] = weights["word"][self.word_vector]
        if len(self.gram_vector):
            some = self.counts > 0
            sums = np.add.reduceat(weights["gram"][self.gram_vector], self.starts[some], axis=0)
            out[some, size:] = sums / self.counts[some, None]
        return out


def start_weights(net: Network) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(net.seed)
    h, d = net.hidden, net.inputs

    def small(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "word": small(net.vector_slots, net.vector, scale=0.05),
        "gram": small(net.vector_slots, net.vector, scale=0.05),
        "x": small(2, d, 3 * h, scale=d**-0.5),  # by direction: update, reset and candidate gates
        "h": small(2, h, 3 * h, scale=h**-0.5),
        "b": np.zeros((2, 3 * h), dtype=np.float32),
        "a": small(2 * h, h, scale=(2 * h) ** -0.5),
        "a_b": np.zeros(h, dtype=np.float32),
        "a_v": small(h, scale=h**-0.5),
        "o": small(2 * h, scale=(2 * h) ** -0.5),
        "o_b": np.zeros(1, dtype=np.float32),
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def recur(gates: np.ndarray, mask: np.ndarray, weights: np.ndarray, keep: bool):
    """States [time, rows, hidden] of one direction; ``gates`` [time, rows, 3 * hidden] come from the inputs."""
    steps, rows, wide = gates.shape
    h = wide // 3
    state = np.zeros((rows, h), dtype=np.float32)
    states = np.zeros((steps, rows, h), dtype=np.float32)
    memory = []
    for t in range(steps):
        own = state @ weights
        zr = sigmoid(gates[t, :, : 2 * h] + own[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        n = np.tanh(gates[t, :, 2 * h :] + r * own[:, 2 * h :])
        new = n + z * (state - n)
        m = mask[t][:, None]
        if keep:
            memory.append((state, z, r, n, own[:, 2 * h :]))
        state = np.where(m, new, state)
        states[t] = state
    return states, memory


def recur_back(grad: np.ndarray, mask: np.ndarray, weights: np.ndarray, memory):
    """Gradients of the input gates and of the recurrent weights."""
    steps, rows, h = grad.shape
    gates = np.zeros((steps, rows, 3 * h), dtype=np.float32)
    d_weights = np.zeros_like(weights)
    d_state = np.zeros((rows, h), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        state, z, r, n, own = memory[t]
        d = d_state + grad[t]
        m = mask[t][:, None]
        d_new = np.where(m, d, 0)
        d_z = d_new * (state - n) * z * (1 - z)
        d_n = d_new * (1 - z) * (1 - n * n)
        d_r = d_n * own * r * (1 - r)
        gates[t] = np.concatenate([d_z, d_r, d_n], axis=1)
        d_own = np.concatenate([d_z, d_r, d_n * r], axis=1)
        d_weights += state.T @ d_own
        d_state = np.where(m, d_new * z, d) + d_own @ weights.T
    return gates, d_weights


def forward(gates: np.ndarray, mask: np.ndarray, weights: dict[str, np.ndarray], keep: bool = False):
    """The output of each window. ``gates`` [2, time, rows, 3 * hidden], ``mask`` [time, rows]."""
    ahead, memory_a = recur(gates[0], mask, weights["h"][0], keep)
    back, memory_b = recur(gates[1][::-1], mask[::-1], weights["h"][1], keep)
    states = np.concatenate([ahead, back[::-1]], axis=2)
    hidden = np.tanh(states @ weights["a"] + weights["a_b"])
    level = np.where(mask, hidden @ weights["a_v"], -1e9)
    share = np.exp(level - level.max(axis=0))
    share /= share.sum(axis=0)
    pooled = (share[:, :, None] * states).sum(axis=0)
    out = pooled @ weights["o"] + weights["o_b"][0]
    return out, (states, hidden, share, pooled, memory_a, memory_b) if keep else None


def backward(d_out: np.ndarray, mask: np.ndarray, weights: dict[str, np.ndarray], kept):
    """Gradients of the weights, and of the gates [2, time, rows, 3 * hidden]."""
    states, hidden, share, pooled, memory_a, memory_b = kept
    h = weights["h"].shape[1]
    grads = {"o": pooled.T @ d_out, "o_b": np.array([d_out.sum()])}
    d_pooled = d_out[:, None] * weights["o"]
    d_states = share[:, :, None] * d_pooled
    d_share = (states * d_pooled).sum(axis=2)
    d_level = share * (d_share - (share * d_share).sum(axis=0))
    grads["a_v"] = np.einsum("tr,trh->h", d_level, hidden)
    d_hidden = d_level[:, :, None] * weights["a_v"] * (1 - hidden**2)
    grads["a"] = np.einsum("trs,trh->sh", states, d_hidden)
    grads["a_b"] = d_hidden.sum(axis=(0, 1))
    d_states = d_states + d_hidden @ weights["a"].T
    first, d_h0 = recur_back(d_states[:, :, :h], mask, weights["h"][0], memory_a)
    second, d_h1 = recur_back(d_states[::-1, :, h:], mask[::-1], weights["h"][1], memory_b)
    grads["h"] = np.stack([d_h0, d_h1])
    return grads, np.stack([first, second[::-1]])


def window_starts(n: int, net: Network) -> np.ndarray:
    """First words of the overlapping windows of a text of ``n`` words; the last one ends with the text."""
    if n <= net.window:
        return np.zeros(min(n, 1), dtype=np.int64)
    starts = np.arange(0, n - net.window, net.stride)
    return np.append(starts, n - net.window)


def window_words(ids: np.ndarray, starts: np.ndarray, net: Network) -> tuple[np.ndarray, np.ndarray]:
    """[time, windows] places of the words of windows, and which of them are words."""
    at = starts[None, :] + np.arange(net.window)[:, None]
    mask = at < len(ids)
    return ids[np.minimum(at, len(ids) - 1)], mask


class Model:
    """A fitted network: weights, evidence and scale."""

    def __init__(self, net: Network, weights, word_odds, gram_odds, scale: tuple[float, float]):
        self.net, self.weights, self.scale = net, weights, scale
        self.word_odds, self.gram_odds = word_odds.astype(np.float16), gram_odds.astype(np.float16)

    def gates(self, tokens: list[str]) -> np.ndarray:
        """[words, 2, 3 * hidden]: what each word brings to the gates of both directions."""
        inputs = Inputs(tokens, self.net)
        x = np.concatenate([inputs.vectors(self.weights), inputs.fixed(self.word_odds, self.gram_odds)], axis=1)
        return np.stack([x @ self.weights["x"][k] + self.weights["b"][k] for k in (0, 1)], axis=1)

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale[0] * logit + self.scale[1])


class Scorer:
    """Scores texts with a model, remembering what words bring."""

    def __init__(self, model: Model):
        self.model = model
        self.ids: dict[str, int] = {}
        self.scored: dict[bytes, float] = {}  # outputs by digest of the text
        self.gates = np.zeros((0, 2, 3 * model.net.hidden), dtype=np.float32)

    def learn(self, tokens: set[str]) -> None:
        if len(self.ids) > KEPT:
            self.ids.clear()
            self.gates = self.gates[:0]
        new = [t for t in tokens if t not in self.ids]
        if new:
            self.ids.update(zip(new, range(len(self.ids), len(self.ids) + len(new))))
            self.gates = np.concatenate([self.gates, self.model.gates(new).astype(np.float32)])

    def known_logits(self, texts: list[str | None]) -> np.ndarray:
        """The same as ``logits``; equal texts are read once, also those of earlier batches."""
        keys = [hashlib.blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
        new = {key: k for k, key in enumerate(keys) if key not in self.scored}
        found = dict(zip(new, self.logits([texts[k] for k in new.values()]).tolist()))
        out = np.array([found[key] if key in found else self.scored[key] for key in keys], dtype=float)
        if len(self.scored) > KEPT:
            self.scored.clear()
        self.scored.update(found)
        return out

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """The largest window output of each text; minus infinity without words."""
        net = self.model.net
        tokens = [text_tokens(t) for t in texts]
        best = np.full(len(texts), -np.inf)
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        for first in range(0, len(texts), 500):
            self.learn(set().union(*tokens[first : first + 500]))
            short = [k for k in range(first, min(first + 500, len(texts))) if 0 < sizes[k] < net.window]
            if short:
                ids = [np.fromiter(map(self.ids.__getitem__, tokens[k]), dtype=np.int64, count=sizes[k]) for k in short]
                parts = [window_words(i, window_starts(len(i), net), net) for i in ids]
                words, mask = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts], axis=1)
                best[short] = forward(np.moveaxis(self.gates[words], 2, 0), mask, self.model.weights)[0]
            full = [k for k in range(first, min(first + 500, len(texts))) if sizes[k] >= net.window]
            if full:
                names = itertools.chain.from_iterable(tokens[k] for k in full)
                flat = np.fromiter(map(self.ids.__getitem__, names), dtype=np.int64, count=int(sizes[full].sum()))
                begins = np.cumsum(sizes[full]) - sizes[full]
                starts = [b + window_starts(int(n), net) for b, n in zip(begins, sizes[full])]
                out = window_outputs(flat, np.concatenate(starts), self.gates, self.model)
                counts = np.array([len(x) for x in starts])
                best[full] = np.maximum.reduceat(out, np.cumsum(counts) - counts)
        return best


def window_outputs(ids: np.ndarray, starts: np.ndarray, gates: np.ndarray, model: Model, rows: int = 4096) -> np.ndarray:
    """The outputs of full windows that begin at ``starts`` (ascending), as ``forward`` gives them.

    An array holds one feature of all windows, so that each step runs along them. If most windows are
    wanted, a step's words are a stretch of the text, and nothing is gathered. States are held as
    u = (state + 1) / 2, so that every gate is a logistic function 1 / (1 + exp(-x)), and -x is what is added up.
    """
    net, w = model.net, model.weights
    h, steps = net.hidden, net.window
    sign = np.repeat(np.float32([-1, -2]), [2 * h, h])  # tanh(x) = 2 / (1 + exp(-2 x)) - 1
    recurrent = [2 * sign[:, None] * w["h"][d].T for d in (0, 1)]
    offset = [-sign * w["h"][d].sum(axis=0) for d in (0, 1)]
    pool, pool_b = -4 * w["a"].T, -2 * (w["a_b"] - w["a"].sum(axis=0))
    result = np.empty(len(starts), dtype=np.float32)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = int(np.searchsorted(starts, low + rows)) if net.stride == 1 else min(len(starts), first + rows)
        dense = 2 * (last - first) > starts[last - 1] + 1 - low
        n = int(starts[last - 1] + 1 - low) if dense else last - first
        words = gates[ids[low : starts[last - 1] + steps]] * sign
        words[:, :, : 2 * h] += np.stack(offset)[:, : 2 * h]
        words = words.transpose(1, 2, 0).copy()  # [2, 3 * hidden, words]
        at = starts[first:last] - low
        states = np.empty((steps, 2 * h, n), dtype=np.float32)
        own = np.empty((3 * h, n), dtype=np.float32)
        zr, z, r, new = own[: 2 * h], own[:h], own[h : 2 * h], own[2 * h :]
        with np.errstate(over="ignore"):
            for d in (0, 1):
                state = np.full((h, n), 0.5, dtype=np.float32)
                for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                    x = words[d][:, t : t + n] if dense else words[d].take(at + t, axis=1)
                    np.matmul(recurrent[d], state, out=own)
                    zr += x[: 2 * h]
                    quick_logistic(zr)
                    new += offset[d][2 * h :, None]
                    new *= r
                    new += x[2 * h :]
                    quick_logistic(new)
                    at_t = states[t, d * h : (d + 1) * h]
                    np.subtract(state, new, out=at_t)
                    at_t *= z
                    at_t += new
                    state = at_t
            hidden = pool @ states
            hidden += pool_b[:, None]
            level = 2 * (w["a_v"] @ quick_logistic(hidden))
        share = np.exp(level - level.max(axis=0))
        out = 2 * (share * (w["o"] @ states)).sum(axis=0) / share.sum(axis=0) + (w["o_b"][0] - w["o"].sum())
        result[first:last] = out[at] if dense else out
        first = last
    return result


def quick_logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in place."""
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def deal_halves(rows: list[np.ndarray], labels: np.ndarray, net: Network) -> np.ndarray:
    """The half, 0 or 1, of each text (as word numbers): near copies in one, the classes of a label in turn."""
    half, given, dealt = np.zeros(len(rows), dtype=np.int64), {}, [0, 0]
    for k, ids in enumerate(rows):
        wide = min(net.kin, len(ids))
        total = np.zeros(max(0, len(ids) - wide + 1), dtype=np.uint64)
        for i in range(wide):
            total = mixed(total + ids[i : i + len(total)].astype(np.uint64) + U(i + 1))
        kin = int(total.min()) if wide else -1
        if kin not in given:
            given[kin] = dealt[labels[k]] % 2
            dealt[labels[k]] += 1
        half[k] = given[kin]
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        if len(own) and half[own].min() == half[own].max():  # near copies only: the other half must know the label too
            half[own] = np.arange(len(own)) % 2
    return half


def fit(texts: list[str], labels: list[int], net: Network = Network()) -> Model:
    """Fit a model on labelled texts. Without both labels it gives every text the share of label 1."""
    # Copies would carry a text's own words into the other half, and count them as evidence twice.
    tokens, own, seen = [], [], set()
    for k, text in enumerate(texts):
        words = text_tokens(text)
        key = (labels[k], hashlib.sha256("\n".join(words).encode("utf-8", "surrogatepass")).digest())
        if key not in seen:
            seen.add(key)
            tokens.append(words)
            own.append(k)
    texts, labels = [texts[k] for k in own], np.array([labels[k] for k in own], dtype=np.int64)
    names = sorted(set().union(*tokens)) if tokens else []
    inputs = Inputs(names, net)
    number = dict(zip(names, range(len(names))))
    rows = [np.fromiter(map(number.__getitem__, t), dtype=np.int64, count=len(t)) for t in tokens]
    ends = np.append(inputs.starts, len(inputs.gram_id))
    half = deal_halves(rows, labels, net)
    halves = [Evidence(net), Evidence(net)]
    whole = Evidence(net)
    for k, ids in enumerate(rows):
        distinct = np.unique(ids)
        spans = [inputs.gram_id[ends[i] : ends[i + 1]] for i in distinct]
        grams = np.unique(np.concatenate(spans)) if spans else np.zeros(0, dtype=np.int64)
        for part in (halves[half[k]], whole):
            part.add(np.unique(inputs.word_id[distinct]), grams, int(labels[k]))
    weights = start_weights(net)
    word_odds, gram_odds = whole.odds()
    base = (labels.sum() + 0.5) / (len(labels) + 1)
    if not len(names) or labels.min() == labels.max():
        return Model(net, weights, word_odds * 0, gram_odds * 0, (0.0, float(np.log(base / (1 - base)))))

    fixed = [inputs.fixed(*halves[1 - k].odds()) for k in (0, 1)]  # the inputs of half k, as the other half sees it
    rng = np.random.default_rng(net.seed)
    chosen: list[tuple[int, int]] = []  # (text, first word)
    for k, ids in enumerate(rows):
        if len(ids):
            starts = window_starts(len(ids), net)
            at, mask = window_words(ids, starts, net)
            strong = np.where(mask, fixed[half[k]][at].max(axis=2), -np.inf).max(axis=0)
            chosen.append((k, int(starts[np.argmax(strong)])))
            if not labels[k]:
                chosen.append((k, int(rng.choice(starts))))
    owner = np.array([k for k, _ in chosen])
    parts = [window_words(rows[k], np.array([s]), net) for k, s in chosen]
    words, mask = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts], axis=1)
    target = labels[owner].astype(np.float32)
    train(weights, inputs, fixed, words, mask, half[owner], target, net, rng)

    # The scale: one logistic fit on the texts' largest outputs, each half with the other's evidence.
    best = np.full(len(rows), -np.inf)
    for part in (0, 1):
        scorer = Scorer(Model(net, weights, *halves[1 - part].odds(), (1.0, 0.0)))
        own = np.flatnonzero(half == part)
        for first in range(0, len(own), 200):
            some = own[first : first + 200]
            best[some] = scorer.logits([texts[k] for k in some])
    some = np.isfinite(best)
    return Model(net, weights, word_odds, gram_odds, logistic(best[some], labels[some]))


def train(weights, inputs: Inputs, fixed, words, mask, half, target, net: Network, rng) -> None:
    """Adam on the log loss of windows; the rarer label weighs as much as the other up to four times."""
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    positive = min(4.0, (target == 0).sum() / max(1, target.sum()))
    turn, n, size = 0, len(target), net.vector
    ends = np.append(inputs.starts, len(inputs.gram_vector))
    for _ in range(max(net.epochs, -(-net.least_steps * net.batch // max(n, 1)))):  # a small sample is read more often
        order = rng.permutation(n)
        for begin in range(0, n, net.batch):
            pick = order[begin : begin + net.batch]
            used, place = np.unique(words[:, pick], return_inverse=True)
            place = place.reshape(words[:, pick].shape)
            spans = [np.arange(ends[i], ends[i + 1]) for i in used]
            gram = inputs.gram_vector[np.concatenate(spans)]
            gram_owner = np.repeat(np.arange(len(used)), [len(s) for s in spans])
            counts = np.maximum(inputs.counts[used], 1)
            mean = np.zeros((len(used), size), dtype=np.float32)
            np.add.at(mean, gram_owner, weights["gram"][gram])
            vectors = np.concatenate([weights["word"][inputs.word_vector[used]], mean / counts[:, None]], axis=1)
            seen = np.where((half[pick] == 0)[None, :, None], fixed[0][used][place], fixed[1][used][place])
            shown = (rng.random(len(used)) >= net.hide).astype(np.float32)[:, None]  # hide some words' vectors
            x = np.concatenate([(vectors * shown)[place], seen], axis=2)
            gates = np.stack([x @ weights["x"][k] + weights["b"][k] for k in (0, 1)])
            out, kept = forward(gates, mask[:, pick], weights, keep=True)
            y = target[pick]
            d_out = ((sigmoid(out) - y) * np.where(y > 0, positive, 1.0) / len(pick)).astype(np.float32)
            grads, d_gates = backward(d_out, mask[:, pick], weights, kept)
            grads["x"] = np.stack([np.einsum("tri,trg->ig", x, d_gates[k]) for k in (0, 1)])
            grads["b"] = d_gates.sum(axis=(1, 2))
            d_x = sum(d_gates[k] @ weights["x"][k].T for k in (0, 1))[:, :, : 2 * size]
            d_used = np.zeros((len(used), 2 * size), dtype=np.float32)
            np.add.at(d_used, place.ravel(), d_x.reshape(-1, 2 * size))
            d_used *= shown
            grads["word"], grads["gram"] = np.zeros_like(weights["word"]), np.zeros_like(weights["gram"])
            np.add.at(grads["word"], inputs.word_vector[used], d_used[:, :size])
            np.add.at(grads["gram"], gram, (d_used[:, size:] / counts[:, None])[gram_owner])
            turn += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = net.rate * (net.slow if k in ("word", "gram") else 1.0)
                step = rate * np.sqrt(1 - 0.999**turn) / (1 - 0.9**turn)
                weights[k] -= (step * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit with a slight pull to slope 1, by Newton steps."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * x + offset)
        w = p * (1 - p) + 1e-9
        gradient = np.array([((p - y) * x).sum() + 0.1 * (slope - 1), (p - y).sum()])
        curve = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(max(slope, 1e-3)), float(offset)


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a NULL id doesn't."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, net: Network = Network(), text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on a bounded sample of the labelled rows that aren't held out, drawn by hash of the text.

    Labels that are NULL or neither 0 nor 1 are left out, NULL ids and texts as well.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = docs.select("doc_id", F.col(text_col).alias("text")).filter(F.char_length("text") <= net.max_chars)
    rows = rows.withColumn("turn", F.xxhash64("text", F.lit(net.seed)))
    # The draw reads hashes; only the drawn texts are gathered, found by a broadcast of their bounded list.
    drawn = rows.select("doc_id", "turn").join(known.select("doc_id", F.col(label_col).cast("int").alias("label")), "doc_id")
    drawn = drawn.groupBy("label", "turn").agg(F.min("doc_id").alias("doc_id"))  # a text counts once in its label
    parts = [
        drawn.filter(F.col("label") == label).orderBy("turn").limit(most).select("doc_id", "turn", "label")
        for label, most in ((1, net.max_toxic), (0, net.max_clean))
    ]
    chosen = parts[0].union(parts[1])
    sample = rows.join(F.broadcast(chosen), ["doc_id", "turn"]).select("text", "label", "turn")
    sample = sample.dropDuplicates(["turn", "label"]).collect()  # rows may be repeated
    sample.sort(key=lambda r: (r["turn"], r["label"]))
    return fit([r["text"] for r in sample], [r["label"] for r in sample], net)


def score_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``__row`` (the columns of ``docs``) and ``score``, from 0 to 1, of every whole text.

    NULL texts and texts without words score 0. Very long texts are read whole, all their windows. Rows are handled
    alone: equal texts get equal scores, an empty table gives none. Columns may have any names.
    """
    rows = pack(docs).selectExpr("__row", f"__row.`{text_col}` as __text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch, texts in byte_slices(batches, "__text", 2 << 20):
            logits = scorer.known_logits(texts)
            scores = np.where(np.isfinite(logits), shared.value.probability(np.nan_to_num(logits, neginf=0.0)), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("__row")), pa.array(scores.astype(float))], names=["__row", "score"]
            )

    return rows.mapInArrow(run, rows.select("__row").schema.add("score", "double"))
