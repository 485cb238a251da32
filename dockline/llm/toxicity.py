"""Toxicity: severity grades by cumulative-link ordinal regression.

P(grade >= k) = sigmoid(w . x - threshold_k) for k = 1 .. K-1, with one weight
vector for all ordered thresholds. Features are hashed words and beginnings of
words, weighted by the log of one plus their count in the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm import common

# Size of the hashed feature space, and the lengths of beginnings in characters.
BITS = 20
BEGINNINGS = (3, 4, 5, 6, 7)
# Bounds of the fit: labelled rows read, and steps.
SAMPLE_ROWS = 8000
ROUNDS = 300
L2 = 1e-4
# Features that one step of the fit looks at.
PART_ENTRIES = 1 << 18
# Share of the clean labelled rows that calibration lets pass for toxic.
MAX_CLEAN_FLAGGED = 0.002

_STRIP = bytes(b for b in range(33, 127) if not chr(b).isalnum())

FIELDS = [
    common.field("grade", "int"), common.field("expected_severity", "double"),
    common.field("p_toxic", "double"), common.field("toxic", "boolean"),
]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features as (text number, feature, count), each once per text."""
    import pandas as pd
    import xxhash

    doc, code, distinct = common.word_codes([t.translate(common.LOWER, _STRIP) for t in texts])
    own = np.full((len(distinct), 1 + len(BEGINNINGS)), -1, dtype=np.int64)
    for i, w in enumerate(distinct):
        word = w.decode("utf-8", errors="replace")
        parts = [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) >= k)]
        own[i, : len(parts)] = [xxhash.xxh3_64_intdigest(p) & ((1 << BITS) - 1) for p in parts]
    # words of a text are counted first, so that a word's features are looked up once
    pair, pairs = pd.factorize((doc << 32) | code)
    count = np.bincount(pair)
    row, part = pairs >> 32, own[pairs & 0xFFFFFFFF]
    flat = part.ravel() >= 0
    key = ((row[:, None] << BITS) + part).ravel()[flat]
    number, keys = pd.factorize(key)
    counts = np.bincount(number, weights=np.repeat(count, part.shape[1])[flat])
    return keys >> BITS, keys & ((1 << BITS) - 1), counts


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    limit: float  # of P(grade >= 1)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """P(grade >= k), a column per threshold; they fall from left to right."""
        doc, feature, count = features(texts)
        score = np.bincount(doc, weights=self.weights[feature] * np.log1p(count), minlength=len(texts))
        return _sigmoid(score[:, None] - self.thresholds)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


@dataclass
class Rows:
    """Features of the labelled rows, one after the other: row i has starts[i]:starts[i + 1]."""

    starts: np.ndarray
    feature: np.ndarray  # int32
    value: np.ndarray  # float32

    def parts(self) -> Iterator[tuple[int, int, slice]]:
        """Rows in runs of about PART_ENTRIES features, which bound what a step holds besides the features."""
        low, n = 0, len(self.starts) - 1
        while low < n:
            high = int(np.searchsorted(self.starts, self.starts[low] + PART_ENTRIES, side="right")) - 1
            high = min(max(high, low + 1), n)
            yield low, high, slice(self.starts[low], self.starts[high])
            low = high

    def sizes(self, low: int, high: int) -> np.ndarray:
        return np.diff(self.starts[low : high + 1])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """w . x of every row."""
        out = np.zeros(len(self.starts) - 1)
        for low, high, own in self.parts():
            doc = np.repeat(np.arange(high - low), self.sizes(low, high))
            out[low:high] = np.bincount(doc, weights=weights[self.feature[own]] * self.value[own], minlength=high - low)
        return out

    def back(self, slope: np.ndarray, kinds: int) -> np.ndarray:
        """The sum of slope * x over all rows."""
        out = np.zeros(kinds)
        for low, high, own in self.parts():
            out += np.bincount(self.feature[own], weights=np.repeat(slope[low:high], self.sizes(low, high)) * self.value[own], minlength=kinds)
        return out

    def take(self, chosen: np.ndarray) -> Rows:
        size = np.diff(self.starts)
        inside = np.repeat(chosen, size)
        return Rows(np.r_[0, np.cumsum(size[chosen])], self.feature[inside], self.value[inside])


def likelihood(score: np.ndarray, cut: np.ndarray, grade: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log likelihood of the grades, and its slopes by the rows' scores (not divided) and by `cut`.

    Thresholds are cut[0] and positive steps exp(cut[1:]), so they stay in order.
    """
    n, own, grades = len(grade), np.arange(len(grade)), len(cut) + 1
    thresholds = np.cumsum(np.r_[cut[:1], np.exp(cut[1:])])
    # P(grade = k) is the difference of neighbouring cumulative ones
    above = np.column_stack([np.ones(n), _sigmoid(score[:, None] - thresholds), np.zeros(n)])
    slope = above * (1 - above)
    p = np.maximum(above[own, grade] - above[own, grade + 1], 1e-12)
    d_score = (slope[own, grade] - slope[own, grade + 1]) / p
    d_cut = np.zeros(grades - 1)
    np.add.at(d_cut, np.maximum(grade - 1, 0), np.where(grade > 0, -slope[own, grade] / p, 0))
    np.add.at(d_cut, np.minimum(grade, grades - 2), np.where(grade < grades - 1, slope[own, grade + 1] / p, 0))
    tail = np.cumsum(d_cut[::-1])[::-1] / n
    return float(np.log(p).mean()), d_score, tail * np.r_[1.0, np.exp(cut[1:])]


def train(rows: Rows, grade: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood of the grades (Adam, all rows at a time)."""
    n, grades = len(grade), max(int(grade.max()) + 1, 2)
    kinds = np.flatnonzero(np.bincount(rows.feature, minlength=1 << BITS))
    column = np.zeros(1 << BITS, dtype=np.int32)
    column[kinds] = np.arange(len(kinds))
    rows = Rows(rows.starts, column[rows.feature], rows.value)
    w, cut = np.zeros(len(kinds)), np.zeros(grades - 1)
    moment = [np.zeros(len(w) + len(cut)), np.zeros(len(w) + len(cut))]
    for turn in range(1, rounds + 1):
        _, d_score, g_cut = likelihood(rows.scores(w), cut, grade)
        g = np.concatenate([rows.back(d_score, len(w)) / n - L2 * w, g_cut])
        moment[0] = 0.9 * moment[0] + 0.1 * g
        moment[1] = 0.99 * moment[1] + 0.01 * g * g
        step = 0.05 * (moment[0] / (1 - 0.9**turn)) / (np.sqrt(moment[1] / (1 - 0.99**turn)) + 1e-8)
        w, cut = w + step[: len(w)], cut + step[len(w) :]
    weights = np.zeros(1 << BITS)
    weights[kinds] = w
    return weights, np.cumsum(np.r_[cut[:1], np.exp(cut[1:])])


def grades_of(rows: Rows, toxic: np.ndarray) -> np.ndarray:
    """Ordered grades from yes/no labels: 0 clean, 1 and 2 toxic below and above the middle severity.

    Severity of a toxic row is the share of its features that are found ten
    times more often in toxic rows than in clean ones.
    """
    if not toxic.any() or toxic.all():
        return toxic.astype(np.int64)
    yes, no = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for low, high, own in rows.parts():
        mine = np.repeat(toxic[low:high], rows.sizes(low, high))
        yes += np.bincount(rows.feature[own][mine], minlength=1 << BITS)
        no += np.bincount(rows.feature[own][~mine], minlength=1 << BITS)
    telling = (yes / toxic.sum() > 10 * no / (~toxic).sum()) & (yes / toxic.sum() > 0.02)
    found = Rows(rows.starts, rows.feature, np.ones(len(rows.feature), dtype=np.float32)).scores(telling.astype(np.float64))
    share = found / np.maximum(np.diff(rows.starts), 1)
    middle = np.median(share[toxic])
    return np.where(toxic, 1 + (share > middle), 0).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from the `rows` labelled rows of smallest hashed id; None without labels of both kinds.

    Labels may be grades 0, 1, 2, ...; of labels that are 0 and 1 only, grades
    are made by `grades_of`. The limit of P(grade >= 1) is calibrated on every
    fourth row, which training leaves out: above MAX_CLEAN_FLAGGED of the clean
    ones, and not below one half. Of an id that occurs more than once the
    smallest label and the smallest text count.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_grade"))
        .where("_id is not null and _grade is not null").groupBy("_id").agg(F.min("_grade").alias("_grade"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    got = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_id"]).select(
        "_id", "_grade", docs[text].cast("string").alias("_text"))
    got = got.groupBy("_id", "_grade").agg(F.min("_text").alias("_text"))
    # features and counts, not texts, come to the driver, packed
    fields = [common.field("features", "binary"), common.field("counts", "binary")]

    def work(texts):
        doc, feature, count = features(texts)
        by, cuts = np.argsort(doc, kind="stable"), np.cumsum(np.bincount(doc, minlength=len(texts)))[:-1]
        return {
            name: [x.astype(np.int32).tobytes() for x in np.split(values[by], cuts)]
            for name, values in (("features", feature), ("counts", count))
        }

    found = common.map_texts(got, ["_id", "_grade"], fields, work, text="_text").toPandas()
    found = found.sort_values("_id").reset_index(drop=True)
    if not len(found) or found["_grade"].nunique() < 2:
        return None
    size = found["features"].map(len).to_numpy() // 4
    value = np.frombuffer(b"".join(found.pop("counts")), dtype=np.int32).astype(np.float32)
    data = Rows(np.r_[0, np.cumsum(size)], np.frombuffer(b"".join(found.pop("features")), dtype=np.int32), np.log1p(value, out=value))
    grade = found["_grade"].to_numpy().astype(np.int64)
    grade = grades_of(data, grade > 0) if grade.max() <= 1 else np.maximum(grade, 0)
    held = np.arange(len(grade)) % 4 == 3
    weights, thresholds = train(data.take(~held), grade[~held])
    p = _sigmoid(data.scores(weights) - thresholds[0])
    clean = np.sort(p[held & (grade == 0)])
    limit = clean[int(np.ceil(len(clean) * (1 - MAX_CLEAN_FLAGGED))) - 1] if len(clean) else 0.5
    return Model(weights, thresholds, float(max(limit, 0.5)))


def score(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, the likeliest grade, the expected grade, P(grade >= 1) and whether that is toxic.

    A null or empty text has no features and gets the base rates. Without a
    model all are null. Repeated rows stay.
    """

    def work(texts):
        if model is None:
            return {f.name: [None] * len(texts) for f in FIELDS}
        above = model.probabilities(texts)
        each = -np.diff(np.column_stack([np.ones(len(texts)), above, np.zeros(len(texts))]), axis=1)
        return {
            "grade": each.argmax(1).astype(np.int32), "expected_severity": above.sum(1),
            "p_toxic": above[:, 0], "toxic": above[:, 0] > model.limit,
        }

    return common.map_texts(docs, keep, FIELDS, work, text)
