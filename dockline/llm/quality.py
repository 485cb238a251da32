"""Quality rules: rule statistics of a text, and an isolation forest over them.

The statistics are counted over the whole text. A forest of random splits is
grown on labelled rows; a document that few splits isolate is odd. The
score above which a document is rejected is calibrated on labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm import common

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Bounds of the fit: labelled rows read, rows and trees of the forest.
SAMPLE_ROWS = 6000
TREE_ROWS = 256
TREES = 100
# Share of repeated lines or words that is no sign of anything.
COMMON_REPEATS = 0.3
# Share of the good labelled rows that calibration lets the forest reject.
MAX_GOOD_REJECTED = 0.001

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FIELDS = [common.field(c, "bigint") for c in BASE] + [
    common.field("base_failed", "boolean"),
    common.field("anomaly", "double"),
    common.field("kept", "boolean"),
]


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of the base rules and the features of the forest."""
    n = len(texts)
    doc, code, distinct = common.word_codes(texts)
    made = {c: np.zeros(n, dtype=np.int64) for c in (*BASE, "n_lines")}
    made["n_words"] = np.bincount(doc, minlength=n).astype(np.int64)
    for i, text in enumerate(texts):
        made["word_chars"][i] = len(text.translate(None, common.SPACES + common.CONTINUATION))
        made["n_symbols"][i] = len(text) - len(text.translate(None, SYMBOLS))
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        made["n_lines"][i] = len(lines)
        made["n_dup_lines"][i] = len(lines) - len(set(lines))
    made["n_repeat_words"] = np.bincount(doc[_repeated(doc, code, len(distinct))], minlength=n).astype(np.int64)
    made["base_failed"] = (made["n_words"] < MIN_WORDS) | (
        100 * made["n_repeat_words"] > MAX_REPEAT_PERCENT * made["n_words"]
    )
    return made


def _repeated(doc: np.ndarray, code: np.ndarray, kinds: int) -> np.ndarray:
    """Which words lie in a window of three that its text holds twice or more."""
    import pandas as pd

    inside = np.zeros(len(doc), dtype=bool)
    if len(doc) < 4:
        return inside
    pairs = pd.factorize(code[:-1] * kinds + code[1:])[0].astype(np.int64)
    windows = pd.factorize(pairs[:-1] * kinds + code[2:])[0].astype(np.int64)
    within = doc[:-2] == doc[2:]
    own = pd.factorize(doc[2:][within] * (windows.max() + 1) + windows[within])[0]
    again = np.zeros(len(windows), dtype=bool)
    again[within] = np.bincount(own)[own] > 1
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return inside


def features(made: dict[str, np.ndarray]) -> np.ndarray:
    """One row per text: shares and means that do not grow with its length.

    Repeats count beyond the share that ordinary short texts have, or else the
    forest would isolate those.
    """
    words = np.maximum(made["n_words"], 1)
    chars = np.maximum(made["word_chars"], 1)
    return np.column_stack([
        made["word_chars"] / words,
        made["n_symbols"] / chars,
        np.maximum(made["n_dup_lines"] / np.maximum(made["n_lines"], 1) - COMMON_REPEATS, 0),
        np.maximum(made["n_repeat_words"] / words - COMMON_REPEATS, 0),
    ]).astype(np.float64)


@dataclass
class Forest:
    """Trees in arrays: feature (-1 at a leaf), split value, children, path length at a leaf."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    length: np.ndarray
    depth: int
    norm: float
    limit: float = np.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """2^(-mean path length / expected length): near 1 is odd, below 0.5 is ordinary."""
        if not len(x):
            return np.zeros(0)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = self.feature[t][node]
                right = x[rows, np.maximum(f, 0)] >= self.split[t][node]
                node = np.where(f < 0, node, self.child[t][node] + right)
            total += self.length[t][node]
        return np.exp2(-total / len(self.feature) / self.norm)


def _expected(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, seed: int = 7, trees: int = TREES, rows: int = TREE_ROWS) -> Forest:
    rng = np.random.default_rng(seed)
    size = min(rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1)
    feature = np.full((trees, nodes), -1, dtype=np.int16)
    split, length = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    child = np.zeros((trees, nodes), dtype=np.int32)
    for t in range(trees):
        todo, used = [(0, rng.choice(len(x), size, replace=False), 0)], 1
        while todo:
            node, own, level = todo.pop()
            low, high = x[own].min(0), x[own].max(0)
            open_ = np.flatnonzero(high > low)
            if level >= depth or len(own) < 2 or not len(open_):
                length[t, node] = level + _expected(len(own))
                continue
            f = rng.choice(open_)
            at = rng.uniform(low[f], high[f])
            at = at if at > low[f] else high[f]
            feature[t, node], split[t, node], child[t, node] = f, at, used
            right = x[own, f] >= at
            todo += [(used, own[~right], level + 1), (used + 1, own[right], level + 1)]
            used += 2
    return Forest(feature, split, child, length, depth, max(_expected(size), 1e-9))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> Forest | None:
    """A calibrated forest from at most `rows` labelled rows, or None without good ones.

    The rows are those with the smallest hashed id, so the choice does not
    depend on how the tables are dealt out. Trees grow on half of the rows,
    good and bad as they come, since a split needs both to tell them apart.
    The limit lies above the scores of all good rows but MAX_GOOD_REJECTED of
    them.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_quality"))
        .where("_id is not null and _quality is not null").dropDuplicates(["_id"])
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    sample = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_id"]).select(
        docs[text].alias("_text"), "_id", "_quality"
    )
    columns = [common.field(f"f{i}", "double") for i in range(4)] + [common.field("base_failed", "boolean")]

    def work(texts):
        made = statistics(texts)
        x = features(made)
        return {f"f{i}": x[:, i] for i in range(4)} | {"base_failed": made["base_failed"]}

    got = common.map_texts(sample, ["_id", "_quality"], columns, work, text="_text").toPandas()
    got = got.drop_duplicates("_id").sort_values("_id")
    got = got[~got["base_failed"].astype(bool)]
    x = got[[f"f{i}" for i in range(4)]].to_numpy(dtype=np.float64)
    good = got["_quality"].to_numpy() == 1
    if good.sum() < 8:
        return None
    forest = grow(x[::2])
    kept = np.sort(forest.score(x[good]))
    low = kept[min(len(kept) - 1, int(np.ceil(len(kept) * (1 - MAX_GOOD_REJECTED))) - 1)]
    bad = np.sort(forest.score(x[~good]))
    above = bad[bad > low]
    # halfway to the nearest bad score above all good ones, so that unseen good rows have room
    forest.limit = float((low + above[0]) / 2) if len(above) and above[0] - low < 0.1 else float(low + 0.02)
    return forest


def score_rules(df: DataFrame, forest: Forest | None, keep: list[str], text: str = "text", only_kept: bool = False) -> DataFrame:
    """Columns `keep`, the counts of the base rules, the anomaly score and the verdict.

    A null text counts as empty and fails the base rules. Without a forest the
    base rules alone decide and the score is null. Repeated rows stay.
    """

    def work(texts):
        made = statistics(texts)
        score = forest.score(features(made)) if forest else None
        odd = score > forest.limit if forest else np.zeros(len(texts), dtype=bool)
        return made | {
            "anomaly": score if forest else [None] * len(texts),
            "kept": ~made["base_failed"] & ~odd,
        }

    return common.map_texts(df, keep, FIELDS, work, text, rows=(lambda m: m["kept"]) if only_kept else None)
