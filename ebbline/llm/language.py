"""Language of a text from a bidirectional gated recurrent network over its bytes.

The network is trained in numpy by back-propagation through time on a bounded
sample of labelled documents and is then a few kilobytes that travel with the
tasks. It reads each text in windows of `WINDOW` bytes, gives every byte position
a probability for each language, and pools the positions of the whole document.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import added, carried, fold, give_back, small_batches

WINDOW = 128
# Training windows are shorter: neighbouring letters decide, and a step of the
# gradient costs as many sequential passes as the window has bytes.
TRAINED_WINDOW = 48
HIDDEN = 8
# The classifier is fitted on at most this many documents of each language.
SAMPLE_PER_LANGUAGE = 600
STEPS = 320
UNDETERMINED = "und"


class Network:
    """Two minimal gated recurrent layers, one in each direction, and a softmax at each position.

    gate = (1 + s(in_g + rec_g h)) / 2,  own = s(in_o + gate * rec_o h),
    h' = h + gate * (own - h),  with s(x) = x / (1 + |x|).
    Arrays are (unit, window), so each step is one small product and a few
    element-wise passes over rows that lie in cache.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.languages, self.hidden = list(languages), hidden
        n = len(self.languages)
        self.weights: dict[str, np.ndarray] = {"out": draw.normal(0, 0.3, (n, 2 * hidden)), "bias": np.zeros((n, 1))}
        for way in "fb":
            self.weights[f"in_{way}"] = draw.normal(0, 0.5, (2 * hidden, 256))
            self.weights[f"rec_{way}"] = draw.normal(0, 0.4, (2 * hidden, hidden))
            self.weights[f"in_{way}"][:hidden] -= 0.7  # remember by default
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def states(self, x: np.ndarray, way: str, tape: list | None = None) -> np.ndarray:
        """Hidden states (step, unit, window) of one direction; the tape keeps what the gradient needs."""
        h_n, (steps, wide) = self.hidden, x.shape
        table, rec = self.weights[f"in_{way}"], self.weights[f"rec_{way}"]
        out = np.empty((steps, h_n, wide), np.float32)
        given = np.empty((2 * h_n, wide), np.float32)
        back = np.empty_like(given)
        size = np.empty((h_n, wide), np.float32)
        gate, own = given[:h_n], back[h_n:]
        h = np.zeros((h_n, wide), np.float32)
        for i in range(steps) if way == "f" else range(steps - 1, -1, -1):
            np.take(table, x[i], axis=1, out=given, mode="clip")
            np.matmul(rec, h, out=back)
            gate += back[:h_n]
            np.abs(gate, out=size)
            size += 1
            gate /= size
            gate += 1
            gate *= 0.5
            memory = own.copy() if tape is not None else None
            own *= gate
            own += given[h_n:]
            np.abs(own, out=size)
            size += 1
            own /= size
            new = out[i]
            np.subtract(own, h, out=new)
            if tape is not None:
                tape.append((i, h, gate.copy(), own.copy(), memory, new.copy()))
            new *= gate
            new += h
            h = new
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(step, language, window)."""
        return self._softmax(self.states(x, "f"), self.states(x, "b"))

    def _softmax(self, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
        h_n, out = self.hidden, self.weights["out"]
        p = np.matmul(out[:, :h_n], ahead)
        p += np.matmul(out[:, h_n:], behind)
        p += self.weights["bias"]
        np.exp(p, out=p)  # states lie within (-1, 1), so the exponents are bounded by the weights
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradient(self, x: np.ndarray, target: np.ndarray, inside: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradient of the mean cross-entropy over the positions inside the texts."""
        h_n, total = self.hidden, max(1, int(inside.sum()))
        tapes: dict[str, list] = {"f": [], "b": []}
        states = {way: self.states(x, way, tapes[way]) for way in "fb"}
        p = self._softmax(states["f"], states["b"])
        wide = np.arange(x.shape[1])
        loss = -float((np.log(p[:, target, wide] + 1e-9) * inside).sum()) / total
        d = p
        d[:, target, wide] -= 1
        d *= inside[:, None, :] / np.float32(total)
        grown = {k: np.zeros_like(v) for k, v in self.weights.items()}
        grown["bias"] = d.sum(axis=(0, 2))[:, None]
        for way, half in (("f", slice(0, h_n)), ("b", slice(h_n, 2 * h_n))):
            grown["out"][:, half] = np.einsum("tlb,thb->lh", d, states[way])
            above = np.matmul(self.weights["out"][:, half].T, d)
            rec, d_h = self.weights[f"rec_{way}"], np.zeros_like(above[0])
            for i, h, gate, own, memory, gap in reversed(tapes[way]):
                d_h = d_h + above[i]
                d_own = d_h * gate * (1 - np.abs(own)) ** 2
                d_gate = (d_h * gap + d_own * memory) * 0.5 * (1 - np.abs(2 * gate - 1)) ** 2
                d_in = np.concatenate([d_gate, d_own])
                d_back = np.concatenate([d_gate, d_own * gate])
                grown[f"rec_{way}"] += d_back @ h.T
                hot = np.zeros((x.shape[1], 256), np.float32)
                hot[wide, x[i]] = 1
                grown[f"in_{way}"] += d_in @ hot
                d_h = d_h * (1 - gate) + rec.T @ d_back
        return loss, grown

    def train(self, windows: np.ndarray, inside: np.ndarray, target: np.ndarray, steps: int, seed: int = 11) -> float:
        """Adam on random batches of windows (window, step), given as bytes."""
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        loss = 0.0
        for step in range(1, steps + 1):
            pick = draw.integers(0, len(windows), 192)
            loss, grown = self.gradient(windows[pick].T.astype(np.intp), target[pick], inside[pick].T)
            norm = np.sqrt(sum(float((g**2).sum()) for g in grown.values()))
            rate = 0.02 * min(1.0, 4 * (1 - step / (steps + 1)))
            for k, g in grown.items():
                g *= min(1.0, 1.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        return loss


def windows_of(data: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each window, its text, and how many of its first positions another window counts.

    The last window of a text ends where the text ends, so it overlaps the one
    before; only a text shorter than a window runs out of it.
    """
    length = end - begin
    many = -(-length // size)
    text = np.repeat(np.arange(len(begin)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    start = begin[text] + nth * size
    latest = np.maximum(end[text] - size, begin[text])
    return np.minimum(start, latest), text, start - np.minimum(start, latest)


def pool(net: Network, data: np.ndarray, begin: np.ndarray, end: np.ndarray, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Sum of position probabilities and count of position labels, both (text, language)."""
    n = len(net.languages)
    pooled, votes = np.zeros((len(begin), n)), np.zeros((len(begin), n), np.int64)
    start, text, skip = windows_of(data, begin, end, WINDOW)
    step = np.arange(WINDOW)
    for k in range(0, len(start), block):
        s, t = start[k : k + block], text[k : k + block]
        at = s[None, :] + step[:, None]
        within = at < end[t][None, :]
        counted = within & (step[:, None] >= skip[k : k + block][None, :])
        inside = counted.astype(np.float32)
        x = np.where(within, data[np.minimum(at, len(data) - 1)], 0).astype(np.intp)
        p = net.probabilities(x)
        top = p.max(axis=1)
        for j in range(n):
            mine = p[:, j]
            pooled[:, j] += np.bincount(t, np.einsum("tb,tb->b", mine, inside), len(begin))
            votes[:, j] += np.bincount(t, ((mine == top) & counted).sum(axis=0), len(begin)).astype(np.int64)
    return pooled, votes


def fit(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE, steps: int = STEPS) -> Network | None:
    """Train on at most `sample` documents of each language, those of the smallest hashed ids.

    Uses rows with a language, a text, and a crc32 of doc_id not divisible by 5.
    None if there are none.
    """
    rows = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold(F.col("doc_id"), 5) != 0)
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.select("doc_id", "lang").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= sample)
    # At most `sample` ids of each language, so the hint is bounded. A training
    # example is one stretch of a text, from a place that depends on the id.
    picked = rows.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    room = F.greatest(F.length("text") - 4 * WINDOW, F.lit(0)) + 1
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), room)
    found = picked.select("doc_id", "lang", F.col("text").substr((place + 1).cast("int"), F.lit(4 * WINDOW)).alias("part"))
    rows_here = sorted(((r.lang, r.doc_id, r.part) for r in found.collect()), key=lambda r: (r[0], str(r[1]), r[2]))
    if not rows_here:
        return None
    languages = sorted({r[0] for r in rows_here})
    net = Network(languages)
    if len(languages) == 1:
        return net
    texts = [r[2].encode() for r in rows_here]
    kind = np.array([languages.index(r[0]) for r in rows_here])
    length = np.array([len(t) for t in texts])
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(length)
    start, text, _ = windows_of(data, ends - length, ends, TRAINED_WINDOW)
    at = start[:, None] + np.arange(TRAINED_WINDOW)[None, :]
    inside = at < ends[text][:, None]
    windows = data[np.minimum(at, len(data) - 1, out=at)]
    windows[~inside] = 0
    del at
    # Every language equally often in a batch, whatever its share of the sample.
    share = np.bincount(kind[text], minlength=len(languages))
    weight = 1.0 / share[kind[text]]
    pick = np.random.default_rng(3).choice(len(text), size=len(text), p=weight / weight.sum())
    net.train(windows[pick], inside[pick], kind[text][pick], steps)
    del found, rows_here, texts, data, windows, inside
    give_back()
    return net


def predict(docs: DataFrame, net: Network | None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns as struct `row`, with lang_pred, score, shares and positions of every row.

    A null text, an empty one and one without a letter are `und` with score 0, as
    is everything if there was nothing to learn from. Repeated rows and repeated
    ids give a row each. Other columns of the input do not matter.
    """
    small_batches(docs.sparkSession)
    languages = net.languages if net else []

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["OMP_NUM_THREADS"] = "1"
        for batch in batches:
            text = batch.column(1).cast(pa.large_binary())
            rows = len(text)
            if net and rows:
                offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + rows + 1]
                data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None and offsets[-1] > offsets[0] else np.zeros(1, np.uint8)
                begin, end = offsets[:-1].copy(), offsets[1:].copy()
                end = np.where(np.asarray(batch.column(2)), end, begin)
                pooled, votes = pool(net, data, begin, end)
                mass = pooled.sum(axis=1, keepdims=True)
                shares = np.divide(pooled, mass, out=np.zeros_like(pooled), where=mass > 0)
                best, known = shares.argmax(axis=1), mass[:, 0] > 0
                names = [languages[j] if ok else UNDETERMINED for j, ok in zip(best, known)]
                score = np.minimum(shares[np.arange(rows), best], 1.0)
            else:
                names, score, n = [UNDETERMINED] * rows, np.zeros(rows), len(languages)
                shares, votes = np.zeros((rows, n)), np.zeros((rows, n), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(list(shares), pa.list_(pa.float64())), pa.array(list(votes), pa.list_(pa.int64()))],
                names=["row", "lang_pred", "score", "shares", "positions"],
            )

    rows = docs.select(
        carried(docs, keep), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    )
    said = rows.mapInArrow(label, added(rows, lang_pred="string", score="double", shares="array<double>", positions="array<bigint>"))
    return said.withColumn("languages", F.array(*[F.lit(x) for x in languages]).cast("array<string>"))


def identify(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Fit on the documents and label all of them."""
    return predict(docs, fit(docs), keep)
