"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of the whole text are embedded and convolved with learned filters.
Filter responses are max-pooled over overlapping chunks of two cells
(``CELL`` bytes each, so every chunk shares half with the next), each chunk
goes through a hidden layer, and mean and maximum over all chunks make one
probability. Cost and memory grow with the bytes only: texts are scored in
groups of about ``GROUP_BYTES``, of which a long text may be a part.

Learning sees a bounded sample: at most ``MAX_ROWS`` labelled texts (half of
each label, by a hash of the id) of at most ``MAX_CHARS`` characters, so the
driver holds at most their product. Scoring covers everything.

Null text counts as empty and gets the score of an empty text. Without labels
of both kinds the score is the share of label 1, or 0.5. Repeated rows, extra
columns and empty tables pass through. Labels, lang, source and doc_id are
never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_row

MAX_ROWS = 4000
MAX_CHARS = 1 << 15
THRESHOLD = 0.3
CELL = 256
GROUP_BYTES = 1 << 16

WIDTH, EMBED, FILTERS, HIDDEN = 6, 8, 32, 16
EPOCHS, STEPS, BATCH, RATE = 8, 2400, 32, 3e-3


class Net(NamedTuple):
    embed: np.ndarray    # 256 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    bias: np.ndarray
    hidden: np.ndarray   # FILTERS x HIDDEN
    hbias: np.ndarray
    out: np.ndarray      # 2 * HIDDEN
    obias: np.ndarray    # 1

    @classmethod
    def start(cls, seed: int = 7) -> Net:
        r = np.random.default_rng(seed)
        n = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        return cls(n(256, EMBED, scale=0.5), n(WIDTH * EMBED, FILTERS, scale=(WIDTH * EMBED) ** -0.5),
                   n(FILTERS, scale=0.0), n(FILTERS, HIDDEN, scale=FILTERS ** -0.5), n(HIDDEN, scale=0.0),
                   n(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5), n(1, scale=0.0))


def cells_of(data: bytes) -> np.ndarray:
    """A text's cells, each with the WIDTH - 1 bytes after it; zeros at the end."""
    n = max(1, -(-len(data) // CELL))
    flat = np.zeros(n * CELL + WIDTH - 1, np.uint8)
    flat[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CELL + WIDTH - 1)[::CELL]


def responses(net: Net, cells: np.ndarray) -> np.ndarray:
    """Filter responses at every byte of the cells, before bias: n x CELL x FILTERS.
    Windows that start WIDTH apart lie side by side, so WIDTH products do."""
    n, length = cells.shape
    flat = np.zeros(n * length + WIDTH, np.uint8)
    flat[:n * length] = cells.reshape(-1)
    e = net.embed[flat]
    out = np.empty((n * length, FILTERS), np.float32)
    for o in range(WIDTH):
        m = len(range(o, n * length, WIDTH))
        m = min(m, (len(e) - o) // WIDTH)
        np.matmul(e[o:o + m * WIDTH].reshape(m, WIDTH * EMBED), net.filters, out=(r := np.empty((m, FILTERS), np.float32)))
        out[o::WIDTH][:m] = r
    return out.reshape(n, length, FILTERS)[:, :CELL]


def _chunks(cell_max: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk maxima, first chunk of each text, the second cell's index per chunk)."""
    n = np.maximum(counts - 1, 1)
    text = np.repeat(np.arange(len(counts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = (np.cumsum(counts) - counts)[text] + at
    second = np.where(counts[text] > 1, first + 1, first)
    return np.maximum(cell_max[first], cell_max[second]), np.cumsum(n) - n, np.stack([first, second])


def _head(net: Net, cell_max: np.ndarray, counts: np.ndarray):
    """From cell maxima to logits; also what the gradient needs."""
    pooled, starts, pair = _chunks(cell_max, counts)
    x = np.maximum(pooled + net.bias, 0)
    h = np.tanh(x @ net.hidden + net.hbias)
    n = np.diff(np.append(starts, len(h)))
    mean = np.add.reduceat(h, starts) / n[:, None].astype(np.float32)
    top = np.maximum.reduceat(h, starts)
    z = np.concatenate([mean, top], 1) @ net.out + net.obias
    return z, (pooled, starts, pair, x, h, n, mean, top)


def score_texts(net: Net, texts: list[str]) -> np.ndarray:
    """Probabilities of label 1."""
    out = np.empty(len(texts))
    maxima: list[np.ndarray] = []
    counts: list[int] = []
    held: list[np.ndarray] = []
    per_group = GROUP_BYTES // CELL

    def flush() -> None:
        if held:
            maxima.append(responses(net, np.concatenate(held)).max(1))
            held.clear()
    size = done = 0
    for i, t in enumerate(texts):
        cells = cells_of(t.encode("utf-8", "replace"))
        counts.append(len(cells))
        for a in range(0, len(cells), per_group):
            held.append(cells[a:a + per_group])
            size += len(held[-1])
            if size >= per_group:
                flush()
                size = 0
        if len(counts) >= 256 or i + 1 == len(texts):
            flush()
            size = 0
            z, _ = _head(net, np.concatenate(maxima), np.array(counts))
            out[done:i + 1] = 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))
            done, counts, maxima = i + 1, [], []
    return out


def _gradient(net: Net, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray | float = 1.0) -> list[np.ndarray]:
    cells, counts = np.concatenate(texts), np.array([len(t) for t in texts])
    r = responses(net, cells)
    at = r.argmax(1)
    cell_max = np.take_along_axis(r, at[:, None], 1)[:, 0]
    z, (pooled, starts, pair, x, h, n, mean, top) = _head(net, cell_max, counts)
    dz = ((1 / (1 + np.exp(-z)) - y) * weight).astype(np.float32)
    both = np.concatenate([mean, top], 1)
    g_out, g_obias = both.T @ dz, dz.sum(keepdims=True)
    dboth = dz[:, None] * net.out
    text = np.repeat(np.arange(len(n)), n)
    is_top = h == top[text]
    dh = dboth[text, :HIDDEN] / n[text, None] + dboth[text, HIDDEN:] * is_top
    da = dh * (1 - h * h)
    g_hidden, g_hbias = x.T @ da, da.sum(0)
    dx = (da @ net.hidden.T) * (x > 0)
    g_bias = dx.sum(0)
    dcell = np.zeros_like(cell_max)
    from_second = cell_max[pair[1]] > cell_max[pair[0]]
    for k, own in ((0, ~from_second), (1, from_second)):
        np.add.at(dcell, pair[k], dx * own)
    rows = np.arange(len(cells))[:, None, None]
    window = cells[rows, at[:, :, None] + np.arange(WIDTH)]           # cell x filter x WIDTH
    e = net.embed[window]                                             # ... x EMBED
    g_filters = np.einsum("nf,nfwe->wef", dcell, e, optimize=True).reshape(WIDTH * EMBED, FILTERS)
    back = np.einsum("nf,wef->nfwe", dcell, net.filters.reshape(WIDTH, EMBED, FILTERS), optimize=True)
    flat = window.reshape(-1)
    g_embed = np.stack([np.bincount(flat, back[..., k].reshape(-1), 256) for k in range(EMBED)], 1)
    return [g.astype(np.float32) for g in (g_embed, g_filters, g_bias, g_hidden, g_hbias, g_out, g_obias)]


def _short_slices(data: list[bytes], y: np.ndarray, r: np.random.Generator) -> tuple[list[bytes], np.ndarray]:
    """Slices between word ends, so that short texts are learned as well: of
    good texts from a few words on, of bad ones long enough to show why."""
    more: list[bytes] = []
    kind: list[int] = []
    for d, label in zip(data, y, strict=True):
        least, most = (12, 240) if label else (160, 400)
        if len(d) > most:
            n, a = int(r.integers(least, most)), int(r.integers(0, len(d) - most))
            a, b = d.find(b" ", a) + 1, d.rfind(b" ", a, a + n)
            if b - a >= least:
                more.append(d[a:b])
                kind.append(label)
    return more, np.array(kind)


def _groups(cells: list[np.ndarray], pick: np.ndarray) -> Iterator[np.ndarray]:
    """A batch in parts of about ``GROUP_BYTES``, which bounds what a step holds."""
    size = np.cumsum([len(cells[i]) for i in pick]) * CELL // GROUP_BYTES
    for part in np.unique(size):
        yield pick[size == part]


def fit(texts: list[str], labels: np.ndarray, seed: int = 7) -> Net:
    """Adam over whole texts and one short slice of each; both labels weigh the same in all."""
    net, r = Net.start(seed), np.random.default_rng(seed)
    data = [t.encode("utf-8", "replace") for t in texts]
    short, kind = _short_slices(data, labels, r)
    cells = [cells_of(d) for d in data + short]
    y = np.concatenate([labels, kind]).astype(np.float32)
    params = [p.copy() for p in net]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
    epochs = max(EPOCHS, min(60, STEPS * BATCH // max(len(cells), 1)))  # a small sample is gone over more often
    total = epochs * -(-len(cells) // BATCH)
    for _ in range(epochs):
        order = r.permutation(len(cells))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            grads = [np.zeros_like(p) for p in params]
            for part in _groups(cells, pick):
                for g, more in zip(grads, _gradient(Net(*params), [cells[i] for i in part], y[part], weight[part]), strict=True):
                    g += more / len(pick)
            step += 1
            rate = RATE * (1 - 0.9 * step / total)
            for p, g, mi, vi in zip(params, grads, m, v, strict=True):
                mi += 0.1 * (g - mi)
                vi += 0.01 * (g * g - vi)
                p -= rate * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.99 ** step)) + 1e-7)
    return Net(*params)


def held_out(doc_id: Column) -> Column:
    """Rows that learning never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(df: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """The bounded sample: ids first (labels alone), then one scan for their texts."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
    order = [F.xxhash64("_id"), "_id"]
    half = [known.where(F.col("_y") == y).orderBy(*order).limit(MAX_ROWS // 2) for y in (0, 1)]
    ids = F.broadcast(half[0].unionByName(half[1]))  # at most MAX_ROWS rows
    rows = df.select("doc_id", "text").where(F.length("text") <= MAX_CHARS).join(ids, F.col("doc_id") == F.col("_id"))
    got = rows.orderBy("_id", "_y", "text").limit(MAX_ROWS).select("text", "_y").collect()
    return [x[0] for x in got], np.array([x[1] for x in got])


def train(df: DataFrame, labels: DataFrame) -> Net | float:
    texts, y = training_sample(df, labels)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return fit(texts, y)


def scorer(model: Net | float):
    """A column function of the text: probability of label 1."""
    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            whole = ["" if t is None else t for t in texts]
            yield pd.Series(score_texts(model, whole) if isinstance(model, Net) else [model] * len(whole), dtype=float)
    return quality


def quality_report(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from THRESHOLD on)."""
    score = scorer(train(df, labels))(F.col("text"))
    return df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``df`` that the classifier does not reject, columns as they are."""
    score = scorer(train(df, labels))(F.col("text"))
    return df.select(whole_row(df), score.alias("_score")).where(F.col("_score") >= THRESHOLD).select("_row.*")
