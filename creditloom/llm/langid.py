"""Language identification in two steps: the family, then one-versus-one linear SVMs within it.

Texts are seen as relative frequencies of hashed byte trigrams of the lower-cased letters. A linear model's
value is then a mean of weights over the text's trigrams, so whole texts are scored by table look-ups and
sums, however long. Training takes a bounded sample: ``per_language`` rows of each language, whole texts and
two short pieces of each.

Whether a text is in a known language at all is judged by evidence that doesn't depend on the other languages: the mean
log ratio of its trigrams' frequencies in its best language to a uniform table. The least evidence is set from the
evidence that training texts have from the other folds' texts of their language.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from creditloom.llm.common import keep_texts, map_texts, stage
from creditloom.llm.linear import linear_svm, platt, sigmoid

#: Families of languages by code. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "celtic": "ga gd cy br".split(),
    "indic": "hi ur bn mr gu pa ne si".split(),
    "iranian": "fa ps ku tg".split(),
    "semitic": "ar he am mt".split(),
    "dravidian": "ta te kn ml".split(),
    "austronesian": "id ms tl jv mg".split(),
    "sinitic": "zh yue".split(),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

#: Size of the hashed trigram table, languages at most (the most frequent ones), and about how many texts train all.
BUCKETS, LANGUAGES, TEXTS = 4096, 200, 2000
UNDETERMINED = "und"
#: Added to a language's trigram counts; folds for the held-out evidence; and the fence below its median, in distances to its lowest ``TAIL``.
PRIOR, FOLDS, TAIL, FENCE = 0.1, 5, 0.01, 2.5
_SPACE, _END = 155, 0


def _byte_codes() -> np.ndarray:
    codes = np.full(256, _SPACE, dtype=np.uint32)
    codes[ord("a"):ord("z") + 1] = np.arange(1, 27)
    codes[ord("A"):ord("Z") + 1] = np.arange(1, 27)
    codes[128:] = np.arange(27, 155)
    codes[0] = _END
    return codes


_CODES = _byte_codes()


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams of the texts and where each text begins; every text has one trigram at least.

    Bucket ``BUCKETS`` stands for trigrams over a text's end and carries no weight.
    """
    parts = [b" " + t.lower().replace("\0", " ").encode("utf-8", "replace") + b" \0" for t in texts]
    codes = _CODES[np.frombuffer(b"".join(parts) + b"\0\0", dtype=np.uint8)]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
    codes = codes[keep]
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    index = ((a * np.uint32(160 * 160) + b * np.uint32(160) + c) * np.uint32(2654435761)) >> np.uint32(20)
    index[(a == _END) | (b == _END) | (c == _END)] = BUCKETS
    ends = np.flatnonzero(codes == _END)[:len(texts)]
    return index, np.r_[0, ends[:-1] + 1] if len(ends) else ends


def frequencies(texts: list[str]) -> np.ndarray:
    """A row of relative trigram frequencies for each text."""
    rows = np.zeros((len(texts), BUCKETS + 1), dtype=np.float32)
    if texts:
        index, starts = trigrams(texts)
        for i, part in enumerate(np.split(index, starts[1:])):
            rows[i] = np.bincount(part, minlength=BUCKETS + 1)
    rows = rows[:, :BUCKETS]
    return rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)


@dataclass
class LanguageModel:
    """Weights by bucket, a column for each family and then for each pair of languages within one."""

    languages: list[str]
    families: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    shifts: np.ndarray
    member: list[int] = field(default_factory=list)  # the family's number of each language
    evidence: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS + 1, 0)))  # log ratios by bucket, a column for each language
    least: float = -np.inf

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each whole text and how likely it is; ``und`` and 0 where no letter is."""
        return self._judge(texts, False)[:2]

    def familiar(self, texts: list[str | None]) -> list[bool]:
        """Whether the evidence for each whole text's best language reaches the least; false where no letter is."""
        return [e >= self.least for e in self._judge(texts, True)[2]]

    def _judge(self, texts: list[str | None], weigh: bool) -> tuple[list[str], list[float], list[float]]:
        """Languages, scores and, if asked to ``weigh``, evidence (NaN where no letter is)."""
        known = [t if t and any(map(str.isalpha, t)) else None for t in texts]
        given = [t for t in known if t is not None]
        if not given or not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [np.nan] * len(texts)
        index, starts = trigrams(given)
        counts = np.add.reduceat((index != BUCKETS).astype(np.float64), starts)
        sums = [np.add.reduceat(column[index], starts) for column in self.weights.T]
        margins = np.stack(sums, axis=1) / np.maximum(counts, 1)[:, None] + self.offsets
        chances = sigmoid(margins * self.slopes + self.shifts)
        n = len(self.families)
        family = chances[:, :n] / chances[:, :n].sum(axis=1, keepdims=True)
        inside = np.zeros((len(given), len(self.languages)))
        votes = np.zeros_like(inside)
        for k, (i, j) in enumerate(self.pairs):
            p = chances[:, n + k]
            inside[:, i] += p
            inside[:, j] += 1 - p
            votes[:, i] += p >= 0.5
            votes[:, j] += p < 0.5
        member = np.array(self.member)
        size = np.bincount(member, minlength=n)[member]
        inside = np.where(size > 1, inside / np.maximum(size - 1, 1), 1.0)
        best_family = family.argmax(axis=1)
        rank = np.where(member == best_family[:, None], votes * 2 + inside, -1.0)
        best = rank.argmax(axis=1)
        rows = np.arange(len(given))
        score = np.clip(family[rows, best_family] * inside[rows, best], 0, 1)
        proof = np.zeros(len(given))
        if weigh:
            every = [np.add.reduceat(column[index], starts) for column in self.evidence.T]
            proof = np.stack(every, axis=1)[rows, best] / np.maximum(counts, 1)
        found = iter(zip(best.tolist(), score.tolist(), proof.tolist()))
        labels, scores, proofs = [], [], []
        for t in known:
            i, s, e = next(found) if t is not None else (None, 0.0, np.nan)
            labels.append(UNDETERMINED if i is None else self.languages[i])
            scores.append(s)
            proofs.append(e)
        return labels, scores, proofs


def _binary(x: np.ndarray, positive: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """An SVM on ``rows``; its sigmoid from an SVM that hasn't seen every fifth of them."""
    y = np.where(positive, 1.0, -1.0)
    probe = rows[::5]
    w, b = linear_svm(x, y, np.setdiff1d(rows, probe))
    slope, shift = platt(np.array([x[r] @ w for r in probe]) + b, positive[probe])
    w, b = linear_svm(x, y, rows)
    return w, b, slope, shift


def _log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log ratios of smoothed trigram frequencies to a uniform table, a column for each row of counts."""
    share = (counts + PRIOR) / (counts.sum(axis=1, keepdims=True) + PRIOR * BUCKETS)
    return np.log(share * BUCKETS).T


def _evidence(x: np.ndarray, lang: np.ndarray, n_languages: int, sizes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, float]:
    """Log ratios of all languages, and the least evidence by that of texts and pieces held out by folds of ``texts``.

    A text of a language without texts in other folds tells nothing; if there is none, nothing is rejected.
    """
    counts = np.zeros((FOLDS, n_languages, BUCKETS))
    whole = np.r_[True, texts[1:] != texts[:-1]] if len(texts) else np.zeros(0, bool)  # a text's first row; the others are pieces of it
    for r in np.flatnonzero(whole):
        counts[texts[r] % FOLDS, lang[r]] += x[r] * sizes[r]
    total, held = counts.sum(axis=0), []
    for f in range(FOLDS):
        rest = total - counts[f]
        columns = _log_ratios(rest)
        taught = rest.sum(axis=1) > 0.5
        held += [float(x[r] @ columns[:, lang[r]]) for r in np.flatnonzero(texts % FOLDS == f) if taught[lang[r]]]
    if not held:
        least = -np.inf
    else:
        middle, low = np.median(held), np.quantile(held, TAIL)
        least = float(middle - FENCE * (middle - low))
    return np.vstack([_log_ratios(total), np.zeros((1, n_languages))]), least


def fit(x: np.ndarray, labels: list[str], sizes: np.ndarray, texts: np.ndarray) -> LanguageModel:
    """The model of trigram frequencies ``x`` (scaled in place), their languages, numbers of trigrams and the texts they are from.

    No rows give a model that says ``und``.
    """
    languages = sorted(set(labels))
    of = [_FAMILY.get(code.lower().replace("_", "-").split("-")[0], code) for code in languages]
    families = sorted(set(of))
    member = [families.index(f) for f in of]
    pairs = [(i, j) for i, j in combinations(range(len(languages)), 2) if member[i] == member[j]]
    lang = np.array([languages.index(v) for v in labels], dtype=int)
    evidence, least = _evidence(x, lang, len(languages), sizes, texts)
    scale = 1 / np.sqrt(max(float(np.mean([row @ row for row in x])), 1e-12)) if len(x) else 1.0
    x *= np.float32(scale)
    fitted, every = [], np.arange(len(x))
    fam = np.array(member, dtype=int)[lang] if languages else lang
    for f in range(len(families)):
        fitted.append((np.zeros(BUCKETS), 1.0, 1.0, 0.0) if len(families) == 1 else _binary(x, fam == f, every))
    for i, j in pairs:
        fitted.append(_binary(x, lang == i, np.flatnonzero((lang == i) | (lang == j))))
    weights = np.zeros((BUCKETS + 1, len(fitted)))
    for k, (w, *_rest) in enumerate(fitted):
        weights[:BUCKETS, k] = w * scale
    column = [np.array([f[i] for f in fitted]) for i in (1, 2, 3)]
    return LanguageModel(languages, families, pairs, weights, *column, member, evidence, least)


def _excerpts(text: str) -> list[str]:
    """The whole text and two short pieces, so that short texts are learned too."""
    words = text.split()
    made = [text]
    for n in (4, 16):
        if len(words) > n:
            start = len(text) * 2654435761 % (len(words) - n)
            made.append(" ".join(words[start:start + n]))
    return made


def train(rows: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 200) -> LanguageModel:
    """A model from at most ``per_language`` whole texts of each of the ``LANGUAGES`` most frequent languages.

    With many languages each gets ``TEXTS`` divided by their number, 20 at least. The texts are those of the smallest hashes among a
    language's distinct ones, alike at every size; rows without language or without a letter teach nothing.
    """
    given = (rows.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
             .withColumn("draw", F.pmod(F.xxhash64("text"), F.lit(1 << 60))))
    texts = stage(given.select("lang", "draw").distinct(), "texts")
    counts = texts.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    each = min(per_language, max(20, TEXTS // max(1, counts.count())))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    least = texts.join(F.broadcast(counts.select("lang")), "lang").withColumn("place", place).where(F.col("place") <= each).drop("place")
    drawn = given.join(F.broadcast(least), ["lang", "draw"]).groupBy("lang", "draw").agg(F.min("text").alias("text"))  # copies teach once

    def featurise(texts: list) -> list:
        rows, sizes = [], []
        for t in texts:
            usable = any(map(str.isalpha, t))
            pieces = _excerpts(t)
            sizes.append([int((trigrams([p])[0] != BUCKETS).sum()) for p in pieces] if usable else [])
            rows.append([row.astype("<f2").tobytes() for row in frequencies(pieces)] if usable else [])
        return [pa.array(rows, pa.list_(pa.binary())), pa.array(sizes, pa.list_(pa.int64()))]

    made = map_texts(drawn, ["lang", "draw"], "text", featurise, "rows array<binary>, sizes array<bigint>")
    found = sorted(((r["lang"], r["draw"], r["rows"], r["sizes"]) for r in made.collect() if r["rows"]), key=lambda r: r[:2])
    taken, labels, parts, lengths, of = Counter(), [], [], [], []
    for code, _, group, sizes in found:
        if taken[code] < each:
            of += [sum(taken.values())] * len(group)
            taken[code] += 1
            parts += group
            lengths += sizes
            labels += [code] * len(group)
    x = np.empty((len(parts), BUCKETS), dtype=np.float32)
    for i, part in enumerate(parts):
        x[i] = np.frombuffer(part, dtype="<f2")
    return fit(x, labels, np.array(lengths, dtype=np.int64), np.array(of, dtype=np.int64))


def _predict(model: LanguageModel, texts: list) -> list:
    labels, scores = model.predict(texts)
    return [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with ``lang_pred`` and ``score`` for every row, from the whole text and nothing else.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if nothing was learned. Of languages with equal scores
    the first in the model's order is taken. Repeated rows are answered one by one; very long texts are read whole; no documents give no rows.
    """
    return map_texts(docs, keep, text, partial(_predict, model), "lang_pred string, score double")


def recognised(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has enough evidence for its best language; none if nothing was learned.

    Null and letterless texts go. Repeated rows share one fate; other columns stay as they are; no documents give no rows.
    """
    return keep_texts(docs, text, model.familiar)
