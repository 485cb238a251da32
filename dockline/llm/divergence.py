"""Source divergence audit: how the terms of sources of one language differ.

Terms are counted by (language, source) and kept where enough documents of the
language hold them. The kept terms form a term-major index: per term the
groups that have it, with their counts. Two groups differ by the sum, over all
kept terms, of the difference of their smoothed shares.

That sum is taken by Gustavson's row accumulation. The index is cut into
slices of terms. In a slice each group scatters its terms through the index
into a dense accumulator with one cell for each peer, so no pair of postings
is ever a row; a slice sends two rows for each pair of groups. Most groups lack
most terms, so a cell starts from the sum that holds if no term were shared,
which follows from the zero shares of both groups; a shared term then adds
what it changes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockline.llm import common
from dockline.session import materialize

# A kept term stands in this many documents of its language.
LEAST_DOCS = 30
# Smoothing of counts, and the unit of shares (fixed values of the contract).
SMOOTHING = 5
UNIT = 1_000_000_000
# Terms listed for each group.
TOP_TERMS = 50
# Distinct terms that a task holds before it sends its counts on.
HELD_TERMS = 300_000
# Postings of a slice of the index, at least.
SLICE_POSTINGS = 16_384
# Counts below this can be multiplied by UNIT in 64 bits.
SAFE_COUNT = 9_000_000_000

# Bytes of terms: letters, small after translation, and all beyond ASCII; the rest separates.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def pieces(text: bytes, most: int = common.BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text, a long one in portions."""
    text = text.translate(TERM_BYTES)
    at = 0
    while len(text) - at > most:
        cut = text.rfind(b" ", at, at + most)
        if cut < 0:
            cut = text.find(b" ", at + most)
        if cut < 0:
            break
        yield text[at:cut].split()
        at = cut + 1
    yield text[at:].split()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Partial counts: lang, source, term, n occurrences, docs that hold the term.

    Each task adds up what it reads and sends it on when it holds many terms.
    """
    schema = "lang string, source string, term string, n bigint, docs bigint"
    arrow = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def emit(held):
        for (own_lang, own_source), (n, found) in held.items():
            terms = list(n)
            for a in range(0, len(terms), 50_000):
                part = terms[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([own_lang] * len(part), pa.string()), pa.array([own_source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()),
                    pa.array([found[t] for t in part], pa.int64()),
                ], schema=arrow)

    def run(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            columns = batch.to_pydict()
            for own_lang, own_source, own_text in zip(columns["_lang"], columns["_source"], columns["_text"]):
                n, found = held.setdefault((own_lang, own_source), (Counter(), Counter()))
                before, seen = len(n), set()
                for terms in pieces(own_text.encode()):
                    n.update(terms)
                    seen.update(terms)
                found.update(seen)
                size += len(n) - before
                if size > HELD_TERMS:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)

    return docs.select(_text(docs[text], "_text"), _text(docs[lang], "_lang"), _text(docs[source], "_source")).mapInArrow(run, schema)


def _text(column: Column, name: str) -> Column:
    return F.coalesce(column.cast("string"), F.lit("")).alias(name)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in units, exact: 1 + floor(UNIT * (n + SMOOTHING) / (total + SMOOTHING * terms))."""
    above = (n + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + terms * SMOOTHING).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def slice_sums(number: np.ndarray, total: np.ndarray, terms: int, offsets: np.ndarray, peer: np.ndarray, n: np.ndarray):
    """Sums of |p - q| over the terms of one slice, for every pair of groups, in two parts.

    Groups are numbered from 0 (`number`) and have `total` occurrences of
    kept terms; the language has `terms` of them. Term i of the slice has the
    postings offsets[i]:offsets[i + 1] of `peer` and `n`. Yields (g, one part
    for each group h); the parts of (g, h) and (h, g) add up to their sum.
    """
    size = len(number)
    base = np.zeros(size, dtype=object)
    base[number] = [int(x) + SMOOTHING * terms for x in total]
    if terms == 0:
        for g in range(size):
            yield g, np.zeros(size, dtype=np.int64)
        return
    zero = np.array([1 + UNIT * SMOOTHING // int(x) for x in base], dtype=np.int64)
    if len(n) and n.max() >= SAFE_COUNT:
        share = np.array([1 + UNIT * (int(c) + SMOOTHING) // int(base[g]) for c, g in zip(n, peer)], dtype=np.int64)
    else:
        share = 1 + UNIT * (n + SMOOTHING) // base.astype(np.int64)[peer]
    term = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    by_row = np.argsort(peer, kind="stable")
    rows = np.searchsorted(peer[by_row], np.arange(size + 1))
    kept, lengths = len(offsets) - 1, np.diff(offsets)
    for g in range(size):
        places = by_row[rows[g] : rows[g + 1]]
        # what the terms of this group would give if no peer had them
        sums = _unshared(share[places], zero, zero[g], kept)
        # the terms that both lack are in both parts
        sums[g + 1 :] -= kept * np.abs(zero[g + 1 :] - zero[g])
        if len(places):
            # the postings of every term of this group, one after the other
            a, length = offsets[term[places]], lengths[term[places]]
            at = np.repeat(a - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
            mine = np.repeat(share[places], length)
            later = peer[at] > g
            at, mine = at[later], mine[later]
            h, other = peer[at], share[at]
            change = np.abs(mine - other) - np.abs(mine - zero[h]) - np.abs(zero[g] - other) + np.abs(zero[g] - zero[h])
            np.add.at(sums, h, change)
        yield g, sums


def _unshared(own: np.ndarray, zero: np.ndarray, mine: np.int64, kept: int) -> np.ndarray:
    """For every peer: the sum over all terms of |p - its zero share|, p being `mine` where the group lacks a term."""
    ordered = np.sort(own)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    below = np.searchsorted(ordered, zero)
    inside = zero * below - sums[below] + (sums[-1] - sums[below]) - zero * (len(ordered) - below)
    return inside + (kept - len(ordered)) * np.abs(mine - zero)


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP_TERMS,
) -> DataFrame:
    """Per (lang, source): all other sources of the language by difference, and the terms it has above the language.

    Columns lang, source, part ('pair' or 'term'), item, value, rank. Null
    text, language or source count as ''. Groups without terms are listed as
    well; without kept terms all pairs differ by 0. Repeated rows count as
    documents each. An empty table gives no rows.
    """
    counts = term_counts(docs, text, lang, source).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    groups = docs.select(_text(docs[lang], "lang"), _text(docs[source], "source")).distinct()
    # a dense number for each group of a language, by which accumulators are indexed
    groups = materialize(
        groups.withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1), "divergence-groups")
    index = (
        counts.join(groups, ["lang", "source"]).groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("g", "n")).alias("postings"))
        .where(F.col("docs") >= least_docs).drop("docs")
    )
    index = materialize(index, "divergence-index")
    postings = index.select("lang", "term", F.col("n").alias("lang_n"), F.explode("postings").alias("x")).select(
        "lang", "term", "lang_n", "x.g", "x.n")
    langs = index.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"), F.sum(F.size("postings")).alias("n_postings"))
    totals = postings.groupBy("lang", "g").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "g"], "left").join(langs, "lang", "left").na.fill(
        0, ["total", "terms", "lang_total", "n_postings"])
    groups = materialize(groups, "divergence-totals")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = _pairs(index, groups).withColumn("rank", F.row_number().over(ranked))
    terms = _terms(postings, groups).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns))


def _terms(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """Terms of a group whose share is above the language's, by the difference."""
    rows = postings.join(groups, ["lang", "g"])
    value = _share(F.col("n"), F.col("total"), F.col("terms")) - _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    return rows.select("lang", "source", F.col("term").alias("item"), value.alias("value")).where("value > 0")


def _pairs(index: DataFrame, groups: DataFrame) -> DataFrame:
    """Both directions of every pair of groups of a language, with the sum over all kept terms."""
    # a slice sends a row for each two groups, so it holds no fewer postings than that
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.max("n_postings").alias("n_postings"))
    slices = F.floor(F.col("n_postings") / F.greatest(F.lit(SLICE_POSTINGS), F.col("size") * F.col("size"))) + 1
    sizes = sizes.select("lang", slices.alias("slices"))
    parts = index.join(sizes, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"),
        F.col("postings.g").alias("peer"), F.col("postings.n").alias("n"))
    peers = groups.join(sizes, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"), "g", "total", "terms")

    def sums(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        own = right.column("g").to_numpy()
        offsets, peer, n = _flat(left)
        g, h, value = [], [], []
        for row, made in slice_sums(own, right.column("total").to_numpy(), right.column("terms")[0].as_py(), offsets, peer, n):
            peers_ = np.delete(np.arange(len(made)), row)
            g.append(np.minimum(peers_, row))
            h.append(np.maximum(peers_, row))
            value.append(made[peers_])
        flat = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (g, h, value)]
        return pa.table([pa.repeat(key[0], len(flat[0])).cast(pa.string()), *flat], names=["lang", "g", "h", "value"])

    made = parts.groupBy("lang", "slice").cogroup(peers.groupBy("lang", "slice")).applyInArrow(
        sums, "lang string, g bigint, h bigint, value bigint")
    total = made.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    both = total.withColumn("way", F.explode(F.array(F.struct("g", "h"), F.struct(F.col("h").alias("g"), F.col("g").alias("h"))))).select(
        "lang", F.col("way.g").alias("g"), F.col("way.h").alias("h"), "value")
    names = groups.select("lang", "g", "source")
    items = names.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))
    return both.join(names, ["lang", "g"]).join(items, ["lang", "h"]).select("lang", "source", "item", "value")


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets and values of the two list columns of the index."""
    peer, n = table.column("peer").combine_chunks(), table.column("n").combine_chunks()
    if isinstance(peer, pa.ChunkedArray):
        peer, n = (x.chunk(0) if x.num_chunks else pa.array([], x.type) for x in (peer, n))
    lengths = peer.value_lengths().to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return offsets, peer.flatten().to_numpy().astype(np.int64), n.flatten().to_numpy().astype(np.int64)
