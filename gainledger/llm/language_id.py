"""Language identification in two steps: the family first, then the language inside the family.

Both steps are linear in hashed counts of letter 1- to 3-grams. A softmax model separates families;
inside a family one linear support vector machine per pair of languages votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import LETTER, character_classes, small_batches
from .common import to_python

# Families of languages that are easily taken for each other. A language that is not
# listed is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "bg", "sr", "hr", "bs", "sl", "mk", "pl", "cs", "sk"],
    "baltic": ["lt", "lv"],
    "finnic": ["fi", "et"],
    "indic": ["hi", "mr", "ne", "bn", "gu", "pa"],
    "arabic": ["ar", "fa", "ur", "ps"],
    "turkic": ["tr", "az", "kk", "uz", "ky"],
    "malay": ["id", "ms", "tl", "jv"],
    "chinese": ["zh", "yue"],
}
UNKNOWN = "und"

# Features, labelled documents per language that the models are fitted on (the documented bound of
# the training sample), and the length of the short extracts trained on besides whole texts.
BITS = 12
SAMPLE_PER_LANGUAGE = 300
EXTRACT_CHARS = 60
# Fitting.
SVM_COST, SVM_ROUNDS = 10.0, 30
SOFTMAX_ROUNDS, SOFTMAX_DECAY, SOFTMAX_RATE = 300, 1e-4, 8.0
# Characters counted at once.
CHUNK_CHARS = 1 << 20


def family_of(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), f"only {language}")


class Counter:
    """Turns texts into unit vectors of damped n-gram counts."""

    def __init__(self):
        self.classes = character_classes()

    def __call__(self, text: str) -> np.ndarray | None:
        """The vector of a whole text; None if it has no letter."""
        counts = np.zeros(1 << BITS)
        seen = False
        tail = np.full(1, 32, np.uint32)  # the last points of the piece before
        for begin in range(0, len(text) + 1, CHUNK_CHARS):
            piece = text[begin : begin + CHUNK_CHARS] + " " * (begin + CHUNK_CHARS > len(text))
            points = np.frombuffer(piece.lower().encode("utf-32-le"), np.uint32)
            points = np.where(self.classes[points] == LETTER, points, np.uint32(32))
            seen = seen or bool((points != 32).any())
            new = (points != 32) | (np.concatenate([tail[-1:], points[:-1]]) != 32)
            points = np.concatenate([tail, points[new]])
            gram = np.zeros(len(points), np.uint32)
            for n in range(3):  # runs of n + 1 points that end in this piece
                gram = gram[: max(0, len(points) - n)] * np.uint32(8191) + points[n:]
                hashed = (gram[max(0, len(tail) - n) :] + np.uint32(n)) * np.uint32(2654435761)
                counts += np.bincount(hashed >> np.uint32(32 - BITS), minlength=1 << BITS)
            tail = points[-2:]
        if not seen:
            return None
        damped = np.sqrt(counts)
        return (damped / np.linalg.norm(damped)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear SVM with squared hinge loss by dual coordinate descent; y is +1 or -1."""
    weight = np.zeros(x.shape[1])
    alpha = np.zeros(len(y))
    # Both sides weigh the same, however many rows each has.
    cost = SVM_COST * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    diagonal = np.einsum("ij,ij->i", x, x) + 1 / (2 * cost)
    order = np.random.default_rng(5)
    for _ in range(SVM_ROUNDS):
        for i in order.permutation(len(y)):
            gradient = y[i] * (x[i] @ weight) - 1 + alpha[i] / (2 * cost[i])
            new = max(0.0, alpha[i] - gradient / diagonal[i])
            weight += (new - alpha[i]) * y[i] * x[i]
            alpha[i] = new
    return weight


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int) -> np.ndarray:
    """Softmax weights by accelerated gradient steps; classes weigh the same."""
    weight = ahead = np.zeros((classes, x.shape[1]), np.float32)
    share = (1 / np.bincount(y, minlength=classes)[y] / classes).astype(np.float32)
    target = np.eye(classes, dtype=np.float32)[y]
    for k in range(SOFTMAX_ROUNDS):
        slope = ((softmax(x @ ahead.T) - target) * share[:, None]).T @ x + np.float32(SOFTMAX_DECAY) * ahead
        new = ahead - np.float32(SOFTMAX_RATE) * slope
        ahead, weight = new + np.float32(k / (k + 3)) * (new - weight), new
    return weight


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class LanguageModel:
    """Families, their weights, and a weight vector for each pair of languages of a family."""

    families: dict[str, list[str]]
    family_weight: np.ndarray
    pair_weight: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, languages: np.ndarray) -> LanguageModel:
        families: dict[str, list[str]] = {}
        for language in sorted(set(languages)):
            families.setdefault(family_of(language), []).append(language)
        number = {name: i for i, name in enumerate(families)}
        y = np.array([number[family_of(language)] for language in languages], int)
        model = cls(families, fit_softmax(x, y, len(families)) if len(families) else np.zeros((0, 1 << BITS)))
        for members in families.values():
            for a, b in combinations(members, 2):
                rows = (languages == a) | (languages == b)
                model.pair_weight[a, b] = fit_svm(x[rows], np.where(languages[rows] == a, 1.0, -1.0))
        return model

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row: the family's probability times how clearly the language
        beats its relatives (both in 0 to 1)."""
        chance = softmax(x @ self.family_weight.T)
        chosen = chance.argmax(axis=1)
        names = np.full(len(x), "", object)
        score = chance[np.arange(len(x)), chosen]
        for f, members in enumerate(self.families.values()):
            rows = np.flatnonzero(chosen == f)
            votes = np.zeros((len(rows), len(members)))
            margin = np.zeros((len(rows), len(members)))
            for a, b in combinations(range(len(members)), 2):
                lead = x[rows] @ self.pair_weight[members[a], members[b]]
                votes[:, a] += lead >= 0
                votes[:, b] += lead < 0
                margin[:, a] += lead
                margin[:, b] -= lead
            rivals = max(1, len(members) - 1)
            best = (votes + np.tanh(margin / rivals) / 2).argmax(axis=1)
            names[rows] = np.array(members, object)[best]
            if len(members) > 1:
                score[rows] *= 1 / (1 + np.exp(-2 * margin[np.arange(len(rows)), best] / rivals))
        return names.tolist(), np.clip(score, 0.0, 1.0)


def held_out(id: str) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 4 == 2, F.lit(False))


def fit_languages(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fits the models on about SAMPLE_PER_LANGUAGE labelled rows of each language.

    Rows are drawn by a hash of their id, at a rate that follows from the exact count of each
    language. What comes to the driver is one vector for each drawn text and for one short extract
    of it, so it is bounded by languages x sample x 2 vectors, however long the texts are.
    """
    usable = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}  # one row per language
    if not counts:
        return LanguageModel.fit(np.zeros((0, 1 << BITS), np.float32), np.array([], object))
    luck = F.pmod(F.xxhash64(F.col(id), F.lit(11)), F.lit(1 << 30))
    chosen = F.lit(False)
    for language, n in counts.items():
        rate = min(1.0, SAMPLE_PER_LANGUAGE / n)
        chosen = chosen | ((F.col(lang) == language) & (luck < int(rate * (1 << 30))))
    drawn = usable.filter(chosen).select(luck.alias("luck"), F.col(lang).alias("lang"), F.col(text).alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter()
        for batch in batches:
            luck, lang, found = [], [], []
            for where, language, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begin = where % max(1, len(text) - EXTRACT_CHARS)
                for part in (text, text[begin : begin + EXTRACT_CHARS]):
                    if (vector := count(part)) is not None:
                        luck.append(where)
                        lang.append(language)
                        found.append(vector.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(luck, pa.int64()), pa.array(lang, pa.string()), pa.array(found, pa.binary())], ["luck", "lang", "vector"])

    rows = to_python(drawn).mapInArrow(vectors, "luck long, lang string, vector binary").collect()
    rows.sort(key=lambda r: (r.lang, r.luck, bytes(r.vector)))
    x = np.frombuffer(b"".join(bytes(r.vector) for r in rows), np.float32).reshape(len(rows), 1 << BITS)
    languages = np.array([r.lang for r in rows], object)
    del rows
    return LanguageModel.fit(x, languages)


class Identifier:
    """Names the language of texts; lives in one task."""

    def __init__(self, model: LanguageModel):
        self.model, self.count = model, Counter()

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        vectors = [self.count(t or "") if self.model.families else None for t in texts]
        known = [i for i, v in enumerate(vectors) if v is not None]
        names, scores = [UNKNOWN] * len(vectors), np.zeros(len(vectors))
        if known:
            found, scores[known] = self.model.predict(np.stack([vectors[i] for i in known]))
            for i, name in zip(known, found, strict=True):
                names[i] = name
        return names, scores


def identify(docs: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score.

    The whole text is read and nothing else. A null text, or one without a letter, is `und` with
    score 0, as is every text when no language was learned. Ids may be null or repeat. An empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(shared.value)
        for whole in batches:
            for batch in small_batches(whole, 1):
                names, scores = identifier(batch.column(1).to_pylist())
                columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "lang_pred", "score"])

    rows = to_python(docs.select(F.col(id).alias("id"), F.col(text).alias("text")))
    return rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of `docs` whose language is not `und`, with their own columns only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        identifier = Identifier(shared.value)
        for texts in batches:
            names, _ = identifier(texts.tolist())
            yield pd.Series([name != UNKNOWN for name in names])

    return to_python(docs).filter(identified(F.col(text)))
