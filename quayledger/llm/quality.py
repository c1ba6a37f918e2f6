"""Quality scores by a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayledger.llm import labelled
from quayledger.llm.shared import ship, slices, texts_of

#: Bytes between windows, windows' taps of so many bytes, numbers a byte stands for, filters, windows of a half chunk.
STEP, TAPS, DEPTH, FILTERS, HALF = 4, 3, 4, 16, 32
#: Distances at which a repeat of eight bytes counts as an echo.
ECHO = range(3, 33)
#: Half chunks that are read at once.
PIECE = 512
#: Labelled rows of each class to fit on, the most characters of one, passes over them.
SAMPLE_ROWS, SAMPLE_CHARS, PASSES = 3000, 65_536, 8


@dataclass
class Network:
    """Byte numbers, filters over windows of 12 bytes, and the weights of what the chunks give."""

    numbers: np.ndarray  # 256 x DEPTH
    filters: np.ndarray  # TAPS x (STEP * DEPTH) x FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # 2 * FILTERS + 2
    base: float


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each filled up with zero bytes to two half chunks at least, and their first half chunks."""
    width = STEP * HALF
    sizes = [max(2, -(-(len(t) + STEP * TAPS) // width)) for t in texts]
    data = b"".join(t.ljust(n * width, b"\0") for t, n in zip(texts, sizes)) + bytes(STEP * TAPS)
    return np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def echoes(data: np.ndarray, halves: int) -> np.ndarray:
    """Share of each half chunk's bytes at which the next eight bytes repeat those a few bytes before."""
    width, out = STEP * HALF, np.empty(halves, np.float32)
    for a in range(0, halves, PIECE):
        n = min(PIECE, halves - a)
        lead = min(a * width, max(ECHO))
        piece = data[a * width - lead : (a + n) * width + 7]
        words = np.lib.stride_tricks.sliding_window_view(piece, 8).copy().view("<u8")[:, 0]
        hit = np.zeros(len(words), bool)
        for gap in ECHO:
            hit[gap:] |= words[gap:] == words[:-gap]
        hit &= words != 0
        out[a : a + n] = hit[lead : lead + n * width].reshape(n, width).mean(1, dtype=np.float32)
    return out


def responses(net: Network, data: np.ndarray, halves: int, ends: np.ndarray) -> np.ndarray:
    """The filters' values at every window: half chunk x window x filter. The last windows of a text, which lie in its filling
    and reach into the next text, count as nothing; ends: one more than the texts' last half chunks."""
    n = halves * HALF
    x = net.numbers[data[: (n + TAPS - 1) * STEP]].reshape(n + TAPS - 1, STEP * DEPTH)
    out = x[:n] @ net.filters[0] + net.bias
    for tap in range(1, TAPS):
        out += x[tap : tap + n] @ net.filters[tap]
    out = np.maximum(out, 0).reshape(halves, HALF, FILTERS)
    out[ends - 1, HALF - TAPS + 1 :] = 0
    return out


def pooled(tops: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of values by half chunk: the larger of each two neighbours (chunks overlap by half), and by text their largest and mean."""
    chunks = np.maximum(tops[:-1], tops[1:])
    inner = np.ones(len(chunks), bool)
    inner[starts[1:-1] - 1] = False
    chunks = np.where(inner.reshape(-1, *[1] * (tops.ndim - 1)), chunks, 0)
    largest = np.maximum.reduceat(chunks, starts[:-1])
    mean = np.add.reduceat(chunks, starts[:-1]) / (np.diff(starts) - 1).reshape(-1, *[1] * (tops.ndim - 1))
    return chunks, largest, mean


def features(tops: np.ndarray, echo: np.ndarray, starts: np.ndarray) -> np.ndarray:
    _, largest, mean = pooled(tops, starts)
    _, most, share = pooled(echo, starts)
    return np.column_stack([largest, mean, most, share]).astype(np.float32)


def scores(net: Network, texts: list[bytes]) -> np.ndarray:
    """A probability for every text, over all of its chunks."""
    data, starts = laid_out(texts)
    halves = int(starts[-1])
    tops = []
    for a in range(0, halves, PIECE):
        n = min(PIECE, halves - a)
        ends = starts[1:][(starts[1:] > a) & (starts[1:] <= a + n)] - a
        tops.append(responses(net, data[a * STEP * HALF : ((a + n) * HALF + TAPS - 1) * STEP], n, ends).max(1))
    tops = np.concatenate(tops)
    z = features(tops, echoes(data, halves), starts) @ net.weights + net.base
    return 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))


def fit(rows: list[tuple[bytes, int]], passes: int = PASSES, batch: int = 64, seed: int = 5) -> Network:
    """Train on (text, label) by Adam; without rows of both classes the score is the label's share."""
    rng = np.random.default_rng(seed)
    share = sum(y for _, y in rows) / len(rows) if rows else 0.5
    base = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    shapes = {"numbers": (256, DEPTH), "filters": (TAPS, STEP * DEPTH, FILTERS), "bias": (FILTERS,), "weights": (2 * FILTERS + 2,)}
    scale = {"numbers": 0.5, "filters": 0.3, "bias": 0.0, "weights": 0.1}
    p = {k: (scale[k] * rng.standard_normal(s)).astype(np.float32) for k, s in shapes.items()}
    if rows and 0 < share < 1:
        moments = {k: [np.zeros(s, np.float32), np.zeros(s, np.float32)] for k, s in shapes.items()}
        t, net = 0, Network(base=base, **p)
        for pass_ in range(passes):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), batch):
                some = [rows[i] for i in order[at : at + batch]]
                grads, step = _gradients(net, some)
                t += 1
                rate = 0.02 * (1 - pass_ / passes)
                net.base -= rate * step
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p[k] -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
        return net
    return Network(base=base, **p | {"weights": np.zeros(2 * FILTERS + 2, np.float32)})


def _gradients(net: Network, some: list[tuple[bytes, int]]) -> tuple[dict[str, np.ndarray], float]:
    data, starts = laid_out([x for x, _ in some])
    halves, labels = int(starts[-1]), np.array([y for _, y in some], np.float32)
    values = responses(net, data, halves, starts[1:])
    where, tops = values.argmax(1), values.max(1)
    chunks, largest, _ = pooled(tops, starts)
    f = features(tops, echoes(data, halves), starts)
    error = ((1 / (1 + np.exp(-np.clip(f @ net.weights + net.base, -30, 30)))) - labels) / len(some)
    text = np.repeat(np.arange(len(some)), np.diff(starts))[:-1]
    inner = text == np.repeat(np.arange(len(some)), np.diff(starts))[1:]
    share = (inner / (np.diff(starts) - 1)[text])[:, None]
    back = error[text][:, None] * (net.weights[FILTERS : 2 * FILTERS] * share + net.weights[:FILTERS] * ((chunks == largest[text]) & inner[:, None]))
    left = tops[:-1] >= tops[1:]
    half = np.arange(len(chunks))[:, None] + ~left
    top = np.where(left, tops[:-1], tops[1:])
    place = half * HALF + where[half, np.arange(FILTERS)]
    use = (top > 0) & (back != 0)
    k = np.nonzero(use)[1]
    g, at = back[use].astype(np.float32), place[use] * STEP
    bytes_ = data[at[:, None] + np.arange(STEP * TAPS)]
    x = net.numbers[bytes_].reshape(len(at), STEP * TAPS * DEPTH)
    flat = net.filters.reshape(-1, FILTERS)
    dfilters = np.stack([g[k == i] @ x[k == i] for i in range(FILTERS)], 1).reshape(net.filters.shape)
    dx = (g[:, None] * flat.T[k]).reshape(-1, DEPTH)
    dnumbers = np.stack([np.bincount(bytes_.ravel(), dx[:, d], 256) for d in range(DEPTH)], 1)
    return {"numbers": dnumbers, "filters": dfilters, "bias": np.bincount(k, g, FILTERS), "weights": error @ f + 1e-4 * net.weights}, float(error.sum())


def with_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs (doc_id, text); labels are (doc_id, quality).

    The network is fitted on a bounded sample of labelled rows outside the held-out fold and then read by all tasks; it sees
    bytes only. Null and empty texts are scored as zero bytes; a null doc_id is scored and not held out; repeated rows are
    scored alike; labels that are null, repeated or of unknown ids are left out or weigh as often as they stand; with no
    labels of one class every score is the other's share."""
    ship(docs.sparkSession)
    net = fit(labelled.sample(docs, labels, "quality", folds, held_out, rows, chars))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(scores(net, texts), pa.float64())], names=["doc_id", "score"])

    out = texts_of(docs).mapInArrow(score, "doc_id long, score double")
    held = F.coalesce(labelled.fold("doc_id", folds) == held_out, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of docs whose text scores at least `threshold`, with all their columns; scored and kept in one pass."""
    ship(docs.sparkSession)
    net = fit(labelled.sample(docs, labels, "quality", options.get("folds", 5), options.get("held_out", 0), options.get("rows", SAMPLE_ROWS), options.get("chars", SAMPLE_CHARS)))
    text = docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, good = 0, np.zeros(batch.num_rows, bool)
            pairs = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(text)], names=["row", "text"])
            for rows, texts in slices([pairs], 1 << 20):
                good[at : at + len(rows)] = scores(net, [t or b"" for t in texts]) >= threshold
                at += len(rows)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
