"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of a text's UTF-8 bytes in both directions, labels every byte position
and a document's probabilities are the mean over all its positions. It is written in numpy and
trained by backpropagation through time on the driver, on windows of a bounded sample of labelled
rows; the trained weights (some 30 KB) go to the tasks, which read whole texts.

A very long text is read whole, in windows that run through the network a block at a time. Of labels that
tie, at a position or in a document, the first in order wins the document; all of them win the position.

Nulls: a null text, an empty one and one without a letter give `und` with score 0. Rows with a null
label or text are never learnt from. Repeated rows give repeated results. An empty table, or one
without a labelled row, gives `und` everywhere. A column of the input that has the name of a result
column is replaced by the result.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import bounded_sample, fold, map_texts, sampled_rows, table

UNDETERMINED = "und"
# Bound of the fit: so many labelled documents, and so many windows of each.
SAMPLE_DOCS = 2000
WINDOWS_PER_DOC = 4
WINDOW = 64
HIDDEN = 16
STEPS = 220
BATCH = 128
# Windows that run through the network side by side.
BLOCK = 1024


@dataclass
class Network:
    """Weights of both directions (first axis) and of the head that labels a position."""

    labels: list[str]
    table: np.ndarray  # (2, 3H, 256) input weights of each byte: update, reset, candidate
    inner: np.ndarray  # (2, 3H, H) recurrent weights
    bias: np.ndarray  # (2, 3H, 1) of the recurrent part
    head: np.ndarray  # (L, 2H)
    head_bias: np.ndarray  # (L, 1)

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.bias, self.head, self.head_bias]


def fresh_network(labels: list[str], hidden: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(size=shape).astype(np.float32)
    return Network(
        labels,
        normal(2, 3 * hidden, 256) * 0.3,
        normal(2, 3 * hidden, hidden) / np.float32(np.sqrt(hidden)),
        np.zeros((2, 3 * hidden, 1), np.float32),
        normal(len(labels), 2 * hidden) * 0.1,
        np.zeros((len(labels), 1), np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _states(net: Network, window: np.ndarray, length: np.ndarray, trace: list | None) -> np.ndarray:
    """Hidden states (T, 2, H, B) of windows (T, B); the second direction reads from the end."""
    steps, width = window.shape
    hidden = net.inner.shape[2]
    out = np.empty((steps, 2, hidden, width), np.float32)
    h = np.zeros((2, hidden, width), np.float32)
    full = bool((length == steps).all())
    taken = np.empty((2, 3 * hidden, width), np.float32)
    for t in range(steps):
        back = steps - 1 - t
        for d, at in ((0, t), (1, back)):
            np.take(net.table[d], window[at], axis=1, out=taken[d], mode="clip")
        u = np.matmul(net.inner, h)
        u += net.bias
        gates = _sigmoid(taken[:, : 2 * hidden] + u[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(taken[:, 2 * hidden :] + r * u[:, 2 * hidden :])
        new = n + z * (h - n)
        live = None
        if not full:  # beyond a short window's end the state stays zero
            live = np.stack([t < length, back < length]).astype(np.float32)[:, None, :]
            new *= live
        if trace is not None:
            trace.append((h, z, r, n, u[:, 2 * hidden :], live))
        h = new
        out[t, 0], out[back, 1] = h[0], h[1]
    return out


def _position_probabilities(net: Network, states: np.ndarray) -> np.ndarray:
    """(T, L, B) probabilities of the labels at every position."""
    steps, _, hidden, width = states.shape
    logits = np.matmul(net.head, states.reshape(steps, 2 * hidden, width))
    logits += net.head_bias
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _gradients(net: Network, window: np.ndarray, length: np.ndarray, truth: np.ndarray) -> tuple[float, list]:
    """Mean cross entropy over all live positions, and its gradient for each weight."""
    steps, width = window.shape
    hidden = net.inner.shape[2]
    trace: list[Any] = []
    states = _states(net, window, length, trace)
    error = _position_probabilities(net, states)
    live = (np.arange(steps)[:, None] < length).astype(np.float32)
    count = max(float(live.sum()), 1.0)
    right = np.take_along_axis(error, np.broadcast_to(truth, (steps, 1, width)), axis=1)[:, 0]
    loss = float(-(np.log(right + 1e-9) * live).sum() / count)
    error -= np.eye(len(net.labels), dtype=np.float32)[truth].T
    error *= (live / count)[:, None, :]
    flat = states.reshape(steps, 2 * hidden, width)
    d_head = np.einsum("tlb,thb->lh", error, flat, optimize=True)
    d_head_bias = error.sum(axis=(0, 2))[:, None]
    d_states = np.matmul(net.head.T, error).reshape(steps, 2, hidden, width)

    d_inner, d_bias = np.zeros_like(net.inner), np.zeros_like(net.bias)
    d_inputs = np.empty((2, 3 * hidden, steps, width), np.float32)
    carried = np.zeros((2, hidden, width), np.float32)
    for t in range(steps - 1, -1, -1):
        back = steps - 1 - t
        h, z, r, n, un, on = trace[t]
        dh = carried + np.stack([d_states[t, 0], d_states[back, 1]])
        if on is not None:
            dh = dh * on
        dn = dh * (1 - z) * (1 - n * n)
        dr = dn * un * r * (1 - r)
        dz = dh * (h - n) * z * (1 - z)
        gate = np.concatenate([dz, dr, dn], axis=1)
        d_inputs[0, :, t], d_inputs[1, :, back] = gate[0], gate[1]
        du = np.concatenate([dz, dr, dn * r], axis=1)
        d_inner += np.matmul(du, h.transpose(0, 2, 1))
        d_bias += du.sum(axis=2, keepdims=True)
        carried = dh * z + np.matmul(net.inner.transpose(0, 2, 1), du)
    one_hot = np.zeros((steps * width, 256), np.float32)
    one_hot[np.arange(steps * width), window.reshape(-1)] = 1
    d_table = np.matmul(d_inputs.reshape(2, 3 * hidden, -1), one_hot)
    return loss, [d_table, d_inner, d_bias, d_head, d_head_bias]


def train_network(
    windows: list[bytes],
    labels: list[str],
    hidden: int = HIDDEN,
    steps: int = STEPS,
    seed: int = 11,
    rate: float = 0.02,
) -> Network:
    """Backpropagation through time with Adam; labels weigh alike, however many windows they have."""
    names = sorted(set(labels))
    net = fresh_network(names, hidden, seed)
    if len(names) < 2:
        return net
    length = np.array([len(w) for w in windows])
    data = np.zeros((WINDOW, len(windows)), np.uint8)
    for i, w in enumerate(windows):
        data[: len(w), i] = np.frombuffer(w, np.uint8)
    truth = np.array([names.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    share = 1 / np.bincount(truth)[truth]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    for step in range(1, steps + 1):
        pick = rng.choice(len(windows), BATCH, p=share / share.sum())
        _, grads = _gradients(net, data[:, pick], length[pick], truth[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, (m, v) in zip(net.weights(), grads, moments, strict=True):
            g = g * min(1.0, 1 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def label_positions(net: Network, text: bytes) -> np.ndarray:
    """Probabilities (bytes, labels) of every position of one text."""
    cut = [text[i : i + WINDOW] for i in range(0, len(text), WINDOW)]
    out = []
    for w in cut:
        window = np.frombuffer(w, np.uint8)[:, None]
        out.append(_position_probabilities(net, _states(net, window, np.array([len(w)]), None))[:, :, 0])
    return np.concatenate(out) if out else np.zeros((0, len(net.labels)), np.float32)


class _Reader:
    """The forward pass over blocks of windows: weights scaled once, buffers used again.

    The gates are 1 / (1 + exp(-x)) and the candidate is 2 / (1 + exp(-2x)) - 1, so the tables hold -x and -2x,
    biases included. A window's bytes are gathered as rows, one for each byte.
    """

    def __init__(self, net: Network, steps: int, width: int) -> None:
        hidden = net.inner.shape[2]
        flip = lambda x: np.ascontiguousarray(x.transpose(0, 2, 1))
        self.gates = flip(-(net.table + net.bias)[:, : 2 * hidden])
        self.candidate = flip(-2 * net.table[:, 2 * hidden :])
        self.inner_gates = flip(-net.inner[:, : 2 * hidden])
        self.inner_candidate = flip(-2 * net.inner[:, 2 * hidden :])
        self.bias = flip(-2 * net.bias[:, 2 * hidden :])
        self.head = net.head.reshape(len(net.labels), 2, hidden)
        self.head_bias = net.head_bias
        make = lambda *shape: np.empty(shape, np.float32)
        self.buffers = [make(2, width, n * hidden) for n in (2, 2, 1, 1, 1)]
        self.states = make(2, steps, width, hidden)

    def states_of(self, windows: np.ndarray, length: np.ndarray) -> np.ndarray:
        """States (2, T, B, H) of windows (T, B); those of a short window count up to its end only."""
        steps, width = windows.shape
        hidden = self.states.shape[3]
        gate, told, new, more, h = [x[:, :width] for x in self.buffers]
        out = self.states[:, :, :width]
        h[:] = 0
        short = bool((length < steps).any())
        z, r = gate[:, :, :hidden], gate[:, :, hidden:]
        for t in range(steps):
            back = steps - 1 - t
            for d, at in ((0, t), (1, back)):
                np.take(self.gates[d], windows[at], axis=0, out=gate[d], mode="clip")
                np.take(self.candidate[d], windows[at], axis=0, out=new[d], mode="clip")
            gate += np.matmul(h, self.inner_gates, out=told)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            np.matmul(h, self.inner_candidate, out=more)
            more += self.bias
            more *= r
            new += more
            np.exp(new, out=new)
            new += 1
            np.divide(2, new, out=new)
            new -= 1
            h -= new
            h *= z
            h += new
            if short:  # the second direction begins at the window's end
                h[1] *= (back < length)[:, None]
            out[0, t], out[1, back] = h[0], h[1]
        return out

    def labelled(self, windows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sums of the probabilities, positions won) of each window (B, L)."""
        steps, width = windows.shape
        with np.errstate(over="ignore"):
            states = self.states_of(windows, length)
        flat = [np.ascontiguousarray(s).reshape(steps * width, -1).T for s in states]
        logits = self.head[:, 0] @ flat[0]
        logits += self.head[:, 1] @ flat[1]
        logits += self.head_bias
        logits -= logits.max(axis=0)
        best = logits == 0
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        chance, best = (x.reshape(-1, steps, width) for x in (logits, best))
        if (length < steps).any():
            live = np.arange(steps)[:, None] < length
            chance, best = chance * live, best & live
        return chance.sum(axis=1).T, best.sum(axis=1).T


def pooled(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities of each text over all its positions, and positions labelled with each label."""
    sizes = np.array([len(t) for t in texts], np.int64)
    per = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), per)
    padded = np.zeros(int(per.sum()) * WINDOW, np.uint8)
    starts = (np.cumsum(per) - per) * WINDOW
    for s, t in zip(starts, texts, strict=True):
        padded[s : s + len(t)] = np.frombuffer(t, np.uint8)
    length = np.full(len(owner), WINDOW, np.int64)
    some = np.flatnonzero(per)
    length[(np.cumsum(per) - 1)[some]] = (sizes - (per - 1) * WINDOW)[some]
    windows = padded.reshape(-1, WINDOW)
    # full windows first: only the blocks with short ones need masks
    order = np.argsort(length != WINDOW, kind="stable")
    total = np.zeros((len(texts), len(net.labels)))
    won = np.zeros((len(texts), len(net.labels)), np.int64)
    reader = _Reader(net, WINDOW, min(BLOCK, max(len(order), 1)))
    for at in range(0, len(order), BLOCK):
        rows = order[at : at + BLOCK]
        chance, best = reader.labelled(np.ascontiguousarray(windows[rows].T), length[rows])
        np.add.at(total, owner[rows], chance)
        np.add.at(won, owner[rows], best)
    return total / np.maximum(sizes, 1)[:, None], won


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit_network(
    docs: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    label: str = "lang",
    text: str = "text",
    key: str = "doc_id",
) -> Network | None:
    """Learn from at most `sample_docs` ids of `docs` with a label, WINDOWS_PER_DOC windows of each.

    Tasks cut the windows, evenly spread over the whole text, so the driver gets no long text.
    None if no row has a label and a letter.
    """

    def cut(texts: list[str | None]) -> dict[str, Any]:
        out = []
        for t in texts:
            raw = (t or "").encode() if has_letter(t) else b""
            span = max(len(raw) - WINDOW, 0)
            at = sorted({span * i // max(WINDOWS_PER_DOC - 1, 1) for i in range(WINDOWS_PER_DOC)})
            out.append([raw[s : s + WINDOW] for s in at] if raw else [])
        return {"windows": out}

    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    ids = bounded_sample(known.select(key).distinct(), [key], sample_docs, 8)
    chosen = known.select(key, label, text).join(
        F.broadcast(ids.distinct()), key, "left_semi"
    )
    frame = map_texts(chosen, cut, "windows array<binary>", [key, label], text)
    rows = sampled_rows(frame, ids, [label, "windows"], key)
    pairs = [(bytes(w), r[label]) for r in rows for w in r["windows"]]
    if not pairs:
        return None
    return train_network([w for w, _ in pairs], [x for _, x in pairs])


def identify(
    docs: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """`docs` with lang_pred, score (its pooled probability) and positions (bytes by winning label)."""
    fields = "lang_pred string, score double, positions map<string,bigint>"

    def predict(texts: list[str | None]) -> dict[str, Any]:
        spoken = [has_letter(t) and net is not None for t in texts]
        raw = [t.encode() if ok else b"" for t, ok in zip(texts, spoken, strict=True)]
        if net is None:
            blank = [None] * len(texts)
            return {"lang_pred": [UNDETERMINED] * len(texts), "score": [0.0] * len(texts), "positions": blank}
        chance, won = pooled(net, raw)
        best = chance.argmax(axis=1)
        return {
            "lang_pred": [net.labels[b] if ok else UNDETERMINED for b, ok in zip(best, spoken, strict=True)],
            "score": [
                round(min(float(c[b]), 1.0), 6) if ok else 0.0
                for c, b, ok in zip(chance, best, spoken, strict=True)
            ],
            "positions": [
                [(net.labels[j], int(n)) for j, n in enumerate(w) if n] if ok else None
                for w, ok in zip(won, spoken, strict=True)
            ],
        }

    return map_texts(docs, predict, fields, keep, text)


def language_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a fifth of the ids is held out of the fit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = fold(F.col("doc_id"), 5) == 0
    net = fit_network(docs.where(~held))
    out = identify(docs, net, keep=["doc_id"])
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "positions")


# Documents below this pooled probability are rejected, as are those without a letter.
LEAST_SCORE = 0.3


def keep_identified(docs: DataFrame, net: Network | None, least: float = LEAST_SCORE) -> DataFrame:
    """Rows of `docs`, with their own columns, whose language is determined with `least` or more."""
    made = ("lang_pred", "score", "positions")
    inner = [f"{c}_of_input" if c.lower() in made else c for c in docs.columns]
    marked = identify(docs.toDF(*inner), net)
    good = marked.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return good.select(*inner).toDF(*docs.columns)
