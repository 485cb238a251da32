"""Benchmark decontamination: BM25 over test items with block-max pruning.

Items are ordered by the score they reach against themselves and cut into
blocks. Every passage of every text is a query. Postings lead from its terms to
the blocks that hold them; the terms of least impact, whose largest impacts
anywhere sum up to SLACK, are not followed but allowed for. Only those blocks
are opened whose largest impacts then reach the threshold. Within a block,
items count only if they hold a term at or past the pivot, the place where that
sum is reached. All items above the threshold are found, none is cut off. What is
found is verified on the whole text: word shingles of the question and word
pairs of the answer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockline.llm import common

# Parameters of BM25 (fixed values) and the share of an item's own score that a passage must reach.
K1, B = 1.2, 0.75
THRESHOLD = 0.6
BLOCK_ITEMS = 64
# Shares of the question's shingles of five words and of the answer's word pairs that a text must hold.
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.6, 0.6
QUESTION_SHINGLE, ANSWER_SHINGLE = 5, 2
# A passage has twice the words of the longest item, or MIN_PASSAGE; passages start half a passage apart.
MIN_PASSAGE = 64
# One index holds so many items and bytes of their texts at most; further items make further passes.
SHARD_ITEMS, SHARD_BYTES = 20_000, 16 << 20
# What the terms of a passage that lead to no blocks may add up to; below THRESHOLD.
SLACK = 0.05
# Postings of blocks that are looked at in one step; bounds a task's memory.
PORTION = 1 << 20

_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def words(text: bytes) -> list[bytes]:
    """Words in lower case without ASCII punctuation."""
    return text.decode("utf-8", errors="replace").lower().encode().translate(None, _PUNCTUATION).split()


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """An item's words up to its last sentence, and those of that sentence.

    Sentences end at a line break or a full stop, question or exclamation
    mark. An item of one sentence is cut at two thirds of its words.
    """
    ends = [i for i in range(len(text) - 1) if text[i] in b".?!\n" and text[i + 1 :].strip(b".?!\n \t")]
    if ends:
        question, answer = words(text[: ends[-1] + 1]), words(text[ends[-1] + 1 :])
        if question and answer:
            return question, answer
    own = words(text)
    cut = -(-2 * len(own) // 3)
    return own[:cut], own[cut:]


def _grams(own: Sequence[bytes], size: int) -> set[tuple[bytes, ...]]:
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


@dataclass
class Block:
    items: np.ndarray  # item numbers
    terms: np.ndarray  # term codes, ascending
    most: np.ndarray  # largest impact per term
    starts: np.ndarray  # postings of terms[k]: starts[k] to starts[k + 1]
    posting: np.ndarray  # place in items
    impact: np.ndarray


class Index:
    """Items of one shard. Impacts are shares of the item's own score, so the threshold is one number."""

    def __init__(self, rows: list[tuple[int, bytes, dict[bytes, int]]], count: int, mean: float, passage: int):
        self.ids = [r[0] for r in rows]
        self.parts = [question_and_answer(r[1]) for r in rows]
        self.passage = passage
        self.code: dict[bytes, int] = {}
        vectors = []
        for _, text, df in rows:
            own = words(text)
            terms, tf = np.unique(np.array(own, dtype=object), return_counts=True) if own else ([], np.zeros(0))
            idf = np.array([max(0.0, np.log((count - df[t] + 0.5) / (df[t] + 0.5))) for t in terms])
            if not idf.any():  # in a very small set every term can be common; then all weigh alike
                idf = np.ones(len(terms))
            weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / max(mean, 1e-9)))
            codes = np.array([self.code.setdefault(t, len(self.code)) for t in terms], dtype=np.int64)
            keep = weight > 0
            vectors.append((codes[keep], weight[keep], weight.sum()))
        order = sorted(range(len(rows)), key=lambda i: vectors[i][2])
        order = [i for i in order if vectors[i][2] > 0]
        self.blocks = [self._block(order[k : k + BLOCK_ITEMS], vectors) for k in range(0, len(order), BLOCK_ITEMS)]
        # postings of blocks: those of term t from block_starts[t] to block_starts[t + 1]
        none = [np.zeros(0, dtype=np.int64)]
        terms = np.concatenate(none + [b.terms for b in self.blocks])
        by = np.argsort(terms, kind="stable")
        self.block_starts = np.searchsorted(terms[by], np.arange(len(self.code) + 1))
        self.block_of = np.repeat(np.arange(len(self.blocks)), [len(b.terms) for b in self.blocks])[by]
        self.block_most = np.concatenate([np.zeros(0)] + [b.most for b in self.blocks])[by]
        self.most = np.zeros(len(self.code))
        np.maximum.at(self.most, terms[by], self.block_most)

    @staticmethod
    def _block(items: list[int], vectors: list[tuple]) -> Block:
        codes = np.concatenate([vectors[i][0] for i in items])
        impact = np.concatenate([vectors[i][1] / vectors[i][2] for i in items])
        place = np.repeat(np.arange(len(items)), [len(vectors[i][0]) for i in items])
        by = np.argsort(codes, kind="stable")
        codes, impact, place = codes[by], impact[by], place[by]
        terms, starts = np.unique(codes, return_index=True)
        most = np.maximum.reduceat(impact, starts)
        return Block(np.array(items), terms, most, np.append(starts, len(codes)), place, impact)

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text number, item number, best score, question overlap, answer overlap) of every verified hit."""
        own = [words(t) for t in texts]
        sizes = np.array([len(w) for w in own], dtype=np.int64)
        get = self.code.get
        code = np.fromiter((get(w, -1) for ws in own for w in ws), dtype=np.int64, count=int(sizes.sum()))
        doc = np.repeat(np.arange(len(texts)), sizes)
        at = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        known = code >= 0
        code, doc, at = code[known], doc[known], at[known]
        half = self.passage // 2
        # a word lies in the passage that starts in its half and in the one before
        part = at // half
        slot = np.concatenate([part, part[part > 0] - 1])
        doc, code = np.concatenate([doc, doc[part > 0]]), np.concatenate([code, code[part > 0]])
        key = np.unique((doc * (int(slot.max()) + 1 if len(slot) else 1) + slot) * max(len(self.code), 1) + code)
        query, term = key // max(len(self.code), 1), key % max(len(self.code), 1)
        best: dict[tuple[int, int], float] = {}
        for block, some_query, some_term in self._opened(query, term):
            for q, item, score in zip(*self._hits(block, some_query, some_term), strict=True):
                text = int(q) // (int(slot.max()) + 1)
                best[text, int(item)] = max(best.get((text, int(item)), 0.0), float(score))
        grams: dict[tuple[int, int], set] = {}
        for (text, item), score in sorted(best.items()):
            overlaps = []
            for part_, size in zip(self.parts[item], (QUESTION_SHINGLE, ANSWER_SHINGLE), strict=True):
                size = min(size, max(len(part_), 1))
                if (text, size) not in grams:
                    grams[text, size] = _grams(own[text], size)
                wanted = _grams(part_, size)
                overlaps.append(len(wanted & grams[text, size]) / len(wanted) if wanted else 1.0)
            if overlaps[0] >= QUESTION_OVERLAP and overlaps[1] >= ANSWER_OVERLAP:
                yield text, item, score, *overlaps

    def _opened(self, query: np.ndarray, term: np.ndarray) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
        """Blocks that may hold a hit, each with the (query, term) of those queries; query is sorted."""
        if not len(query) or not self.blocks:
            return
        queries, first, sizes = np.unique(query, return_index=True, return_counts=True)
        own = np.repeat(np.arange(len(queries)), sizes)
        by = np.lexsort((self.most[term], own))
        top, ordered = self.most[term][by], term[by]
        sums = np.cumsum(top)
        essential = sums - np.repeat(sums[first] - top[first], sizes) > SLACK
        rest = np.bincount(own[~essential], weights=top[~essential], minlength=len(queries))
        own, ordered = own[essential], ordered[essential]
        counts = self.block_starts[ordered + 1] - self.block_starts[ordered]
        # portions end where a query ends
        portion = np.cumsum(counts) // PORTION
        ends = np.flatnonzero(np.r_[own[1:] != own[:-1], True]) + 1 if len(own) else np.zeros(0, dtype=np.int64)
        ends = ends[np.r_[portion[ends[1:] - 1] != portion[ends[:-1] - 1], True]] if len(ends) else ends
        alive = []
        for low, high in zip(np.r_[0, ends[:-1]], ends, strict=True):
            some = counts[low:high]
            rows = np.repeat(np.arange(low, high), some)
            at = np.arange(len(rows)) - np.repeat(np.cumsum(some) - some, some) + self.block_starts[ordered[rows]]
            pairs, code = np.unique(own[rows] * len(self.blocks) + self.block_of[at], return_inverse=True)
            bound = np.bincount(code, weights=self.block_most[at], minlength=len(pairs)) + rest[pairs // len(self.blocks)]
            alive.append(pairs[bound >= THRESHOLD - 1e-6])
        pairs = np.concatenate(alive) if alive else np.zeros(0, dtype=np.int64)
        pairs = pairs[np.argsort(pairs % len(self.blocks), kind="stable")]
        numbers, starts = np.unique(pairs % len(self.blocks), return_index=True)
        for number, some in zip(numbers, np.split(pairs // len(self.blocks), starts[1:]), strict=True):
            at = np.repeat(first[some] - np.cumsum(sizes[some]) + sizes[some], sizes[some]) + np.arange(sizes[some].sum())
            yield self.blocks[number], query[at], term[at]

    @staticmethod
    def _hits(block: Block, query: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (query, item, score) of a block with a score of THRESHOLD or more; query is sorted."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        place = np.minimum(np.searchsorted(block.terms, term), len(block.terms) - 1)
        inside = block.terms[place] == term
        query, place = query[inside], place[inside]
        if not len(query):
            return none
        queries, first, own = np.unique(query, return_index=True, return_inverse=True)
        alive = (np.bincount(own, weights=block.most[place]) >= THRESHOLD - 1e-9)[own]
        own, place = own[alive], place[alive]
        if not len(own):
            return none
        by = np.lexsort((block.most[place], own))
        own, place = own[by], place[by]
        sums = np.cumsum(block.most[place])
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        before = np.repeat(sums[start] - block.most[place][start], np.diff(np.r_[start, len(own)]))
        essential = sums - before >= THRESHOLD - 1e-6
        counts = block.starts[place + 1] - block.starts[place]
        rows = np.repeat(np.arange(len(own)), counts)
        posting = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + block.starts[place][rows]
        pair = own[rows] * len(block.items) + block.posting[posting]
        pairs, code = np.unique(pair, return_inverse=True)
        score = np.bincount(code, weights=block.impact[posting])
        candidate = np.bincount(code, weights=essential[rows]) > 0
        good = candidate & (score >= THRESHOLD - 1e-9)
        return queries[pairs[good] // len(block.items)], block.items[pairs[good] % len(block.items)], score[good]


def build(items: DataFrame, text: str = "text") -> Iterator[Index]:
    """Indexes over all items, each of a bounded shard; counts of terms are over all of them.

    Items without words are left out; repeated rows count once.
    """
    spark = items.sparkSession
    base = items.select(
        items["item_id"].cast("bigint").alias("item_id"), F.coalesce(items[text].cast("string"), F.lit("")).alias("text")
    ).distinct()
    term_schema = "item_id bigint, text string, length int, term binary"

    def split(batches):
        import pandas as pd

        for batch in batches:
            rows = [
                (i, t, len(own), w) for i, t in zip(batch["item_id"], batch["text"], strict=True)
                for own in [words(t.encode())] for w in set(own)
            ]
            yield pd.DataFrame(rows, columns=["item_id", "text", "length", "term"]).astype({"item_id": "Int64"})

    terms = base.mapInPandas(split, term_schema)
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    full = terms.join(df, "term").groupBy("item_id", "text", "length").agg(
        F.collect_list(F.struct("term", "df")).alias("terms")
    )
    count, mean, longest = full.agg(F.count(F.lit(1)), F.avg("length"), F.max("length")).first()
    if not count:
        return
    passage = max(MIN_PASSAGE, 2 * longest)
    shard, size = [], 0
    for r in full.toLocalIterator():
        shard.append((r.item_id, r.text.encode(), {bytes(t.term): t.df for t in r.terms}))
        size += len(r.text)
        if len(shard) >= SHARD_ITEMS or size >= SHARD_BYTES:
            yield Index(sorted(shard, key=_by_id), count, mean, passage)
            shard, size = [], 0
    if shard:
        yield Index(sorted(shard, key=_by_id), count, mean, passage)


def _by_id(row: tuple) -> tuple:
    return row[0] is None, row[0] or 0, row[1]


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text and item it holds: doc_id, item_id, score, question_overlap, answer_overlap.

    `score` is the best passage's BM25 as a share of the item's own. A null
    text counts as empty and holds nothing, as nothing does if there are no
    items. Repeated rows of docs give repeated rows.
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"
    base = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    found = spark.createDataFrame([], schema)
    for index in build(items):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            import pyarrow as pa

            for batch in batches:
                texts, ids = common.as_bytes(batch.column(1)), batch.column(0).to_pylist()
                for low, high in common.blocks(texts):
                    hits = list(shared.value.search(texts[low:high]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[low + h[0]] for h in hits], pa.int64()),
                        pa.array([shared.value.ids[h[1]] for h in hits], pa.int64()),
                        *(pa.array([h[k] for h in hits], pa.float64()) for k in (2, 3, 4)),
                    ], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.unionByName(base.mapInArrow(run, schema))
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs whose text holds no item, with all their columns."""
    spark = docs.sparkSession
    for index in build(items):
        shared = spark.sparkContext.broadcast(index)

        def work(texts, shared=shared):
            clean = np.ones(len(texts), dtype=bool)
            clean[[h[0] for h in shared.value.search(texts)]] = False
            return {"_clean": clean}

        flag = [T.StructField("_clean", T.BooleanType())]
        docs = common.map_texts(docs, docs.columns, flag, work, text, rows=lambda m: m["_clean"]).select(*docs.columns)
    return docs
