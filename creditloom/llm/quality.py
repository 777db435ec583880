"""Document quality from lines: a linear-chain conditional random field labels every line good or bad.

A line is described by its own shape and that of the lines beside it. The field is trained on the exact
likelihood of a bounded sample of labelled documents, whose label all their lines take; a document counts
once, however many lines it has. A document's quality is the mean of its lines' chances to be
good (forward-backward), weighted by their lengths, put on the scale of the labels by a sigmoid.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from creditloom.llm.common import map_texts, stage
from creditloom.llm.linear import platt, sigmoid

#: Character classes of a byte: lower case and non-ASCII, upper case, digit, symbol, exclamation, other mark, space.
KINDS = 7
SHAPES = KINDS + 9
#: Own shape, the line before, the line after, and two that say whether there is none.
FEATURES = 3 * SHAPES + 3


def _kinds() -> np.ndarray:
    kind = np.full(256, 5, dtype=np.int64)
    kind[128:] = 0
    kind[ord("a"):ord("z") + 1] = 0
    kind[ord("A"):ord("Z") + 1] = 1
    kind[ord("0"):ord("9") + 1] = 2
    for mark in "#*$%&|<>{}[]=_~^@\\":
        kind[ord(mark)] = 3
    kind[ord("!")] = 4
    for blank in " \t\r\v\f":
        kind[ord(blank)] = 6
    return kind


_KIND = _kinds()


def line_shapes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shape of every line, its length in characters of UTF-8, and the number of lines of each text (one at least)."""
    lengths, repeats, ends, counts, encoded, stutter, variety = [], [], [], [], [], [], []
    for text in texts:
        lines = (text or "").encode("utf-8", "replace").split(b"\n")
        seen: dict[bytes, int] = {}
        for line in lines:
            key = line.strip()
            seen[key] = times = seen.get(key, 0) + 1
            repeats.append(times - 1 if key else 0)
            ends.append(key[-1:] in (b".", b"!", b"?", b":", b";", b'"'))
            lengths.append(len(line))
            words = key.split()
            n = max(1, len(words))
            stutter.append(sum(map(eq, words, words[1:])) / n)
            variety.append(len(set(words)) / n)
        counts.append(len(lines))
        encoded += lines
    size = np.array(lengths, dtype=np.int64)
    kinds = _KIND[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
    kinds += np.repeat(np.arange(len(size), dtype=np.int64) * KINDS, size)
    table = np.bincount(kinds, minlength=len(size) * KINDS).reshape(len(size), KINDS).astype(np.float64)
    total = np.maximum(size, 1)
    share = table / total[:, None]
    words = table[:, 6] + 1
    marks = table[:, 3] + table[:, 4]
    more = np.stack([
        np.log1p(size) / 8, size == 0, np.minimum(repeats, 3) / 3, ends,
        np.minimum((total - table[:, 6]) / words, 20) / 10, np.minimum(marks / words, 2), share[:, 1] > 0.6,
        stutter, variety,
    ], axis=1)
    return np.hstack([share * 3, more]), size, np.array(counts, dtype=np.int64)


def with_neighbours(shapes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features: its shape, those of the lines beside it in the same text, and which of them there are."""
    n, starts = len(shapes), np.r_[0, np.cumsum(counts)[:-1]]
    first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    first[starts], last[starts + counts - 1] = True, True
    before, after = np.zeros_like(shapes), np.zeros_like(shapes)
    before[1:], after[:-1] = shapes[:-1], shapes[1:]
    before[first], after[last] = 0, 0
    return np.hstack([shapes, before, after, first[:, None], last[:, None], np.ones((n, 1))])


def marginals(unary: np.ndarray, step: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: chance of each state, expected transitions of each chain, log normalisers."""
    starts = np.r_[0, np.cumsum(counts)[:-1]]
    order = np.argsort(-counts, kind="stable")
    begin, size = starts[order], counts[order]
    top = unary.max(axis=1, keepdims=True)
    emit, move = np.exp(unary - top), np.exp(step)
    ahead, scale = np.empty_like(emit), np.empty(len(emit))
    longest = int(size[0]) if len(size) else 0
    alive = [int(np.searchsorted(-size, -t, side="left")) for t in range(longest + 1)]  # chains longer than t
    for t in range(longest):
        at = begin[:alive[t]] + t
        a = emit[at] if t == 0 else (ahead[at - 1] @ move) * emit[at]
        scale[at] = total = a.sum(axis=1)
        ahead[at] = a / total[:, None]
    back = np.ones_like(emit)
    moved = np.zeros((len(counts), 2, 2))
    for t in range(longest - 2, -1, -1):
        live = alive[t + 1]
        at = begin[:live] + t
        onward = emit[at + 1] * back[at + 1] / scale[at + 1][:, None]
        back[at] = onward @ move.T
        moved[order[:live]] += ahead[at][:, :, None] * move * onward[:, None, :]
    chance = ahead * back
    logs = np.add.reduceat(np.log(scale) + top[:, 0], starts) if len(starts) else np.zeros(0)
    return chance, moved, logs


@dataclass
class QualityModel:
    """Weights of a line's features for good against bad, transitions, and the sigmoid over documents."""

    weights: np.ndarray
    step: np.ndarray
    slope: float
    shift: float

    def raw(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean chance of the lines to be good."""
        if not texts:
            return np.zeros(0)
        shapes, size, counts = line_shapes(texts)
        unary = with_neighbours(shapes, counts) @ self.weights
        chance = marginals(np.stack([np.zeros(len(unary)), unary], axis=1), self.step, counts)[0][:, 1]
        starts, weight = np.r_[0, np.cumsum(counts)[:-1]], size + 1.0
        return np.add.reduceat(chance * weight, starts) / np.add.reduceat(weight, starts)

    def score(self, texts: list[str | None]) -> np.ndarray:
        raw = np.clip(self.raw(texts), 1e-6, 1 - 1e-6)
        return sigmoid(self.slope * np.log(raw / (1 - raw)) + self.shift)


def fit(texts: list[str | None], good: list[int], rounds: int = 250, decay: float = 1e-3) -> QualityModel:
    """The field by full-gradient ascent (Adam) on the exact likelihood; both classes weigh alike.

    Without labelled texts of both classes every document gets the share of good ones among those given, or 1/2.
    """
    label = np.array(good, dtype=np.int64)
    if len(set(good)) < 2:
        share = (label.sum() + 1) / (len(label) + 2)
        return QualityModel(np.zeros(FEATURES), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    shapes, _, counts = line_shapes(texts)
    x = with_neighbours(shapes, counts)
    of_doc = np.repeat(np.arange(len(counts)), counts)
    y = label[of_doc]
    share = label.mean()
    doc_weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share)) / counts
    line_weight = doc_weight[of_doc]
    w, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = (doc_weight * (counts - 1))[label == k].sum()
    n = len(counts)
    mean, square = np.zeros(w.size + 4), np.zeros(w.size + 4)
    for r in range(1, rounds + 1):
        unary = x @ w
        chance, moved, _ = marginals(np.stack([np.zeros(len(unary)), unary], axis=1), step, counts)
        slope = np.r_[x.T @ (line_weight * (y - chance[:, 1])) / n - decay * w,
                      (seen - (doc_weight[:, None, None] * moved).sum(axis=0)).ravel() / n - decay * step.ravel()]
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        change = 0.1 * (mean / (1 - 0.9 ** r)) / (np.sqrt(square / (1 - 0.99 ** r)) + 1e-8)
        w, step = w + change[:-4], step + change[-4:].reshape(2, 2)
    model = QualityModel(w, step, 1.0, 0.0)
    raw = np.clip(model.raw(texts), 1e-6, 1 - 1e-6)
    model.slope, model.shift = platt(np.log(raw / (1 - raw)), label == 1)
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          per_class: int = 750) -> QualityModel:
    """A model from at most ``per_class`` labelled whole texts of each class, chosen by a hash of their ids.

    Rows of ``labels`` with a null id, a label other than 0 and 1 or no document teach nothing; an id labelled more than
    once takes its smallest label; of rows that share an id one text is taken. Nothing labelled gives a model without a preference.
    """
    rows = sorted(((r["good"], r["draw"], r["id"], r["text"]) for r in sampled(docs, labels, doc_id, text, label, per_class).collect()))
    return fit([r[3] for r in rows], [r[0] for r in rows])


def sampled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
            per_class: int = 750) -> DataFrame:
    """(id, good, draw, text): the ``per_class`` documents of each class with the smallest hashes of their ids, a null text as an empty one."""
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
             .groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("int").alias("good")))
    drawn = stage(known.join(texts.select("id"), "id", "left_semi").withColumn("draw", F.xxhash64("id")), "drawn")
    # hashes are even: the smallest per_class of n lie below this share of them but for a chance under 1e-15, so few rows meet in a class's window
    each = per_class + 10 * np.sqrt(per_class) + 50
    least = F.lit(None).cast("double")
    for r in drawn.groupBy("good").count().collect():  # two rows
        least = F.when(F.col("good") == r["good"], F.lit(min(1.0, each / r["count"]))).otherwise(least)
    share = F.col("draw").cast("double") / F.lit(2.0 ** 64) + 0.5
    place = F.row_number().over(Window.partitionBy("good").orderBy("draw", "id"))
    chosen = drawn.where(share <= least).withColumn("place", place).where(F.col("place") <= per_class).drop("place")
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "good", "draw").agg(F.min("text").alias("text")).fillna("", ["text"])


def _score(model: QualityModel, texts: list) -> list:
    return [pa.array(model.score(texts), pa.float64())]


def score_quality(docs: DataFrame, model: QualityModel, keep: list[str], text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``keep`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) for every row.

    A null or empty text is one empty line. Only the text is looked at, the whole of it. Repeated rows get equal scores, each its own
    row; no documents give no rows.
    """
    scored = map_texts(docs, keep, text, partial(_score, model), "score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
