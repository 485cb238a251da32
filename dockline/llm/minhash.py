"""Near duplicates by BagMinHash over multisets of word shingles.

A shingle that occurs w times in a text carries the weights 1 to w. Each unit
of weight is a Poisson process of points in time, each point on a random
register; processes of weight intervals (2^k, 2^(k+1)] stand for all units in
them until a point is early enough to matter, and only then split in halves.
A register keeps its earliest point, so two texts agree on a register with
the probability of their weighted Jaccard similarity.

Registers are banded. Texts in one bucket are compared with the bucket's most
connected text first; the links found are closed to classes. What then is
outside a bucket's largest class is compared with all texts of the bucket that
a finer sketch does not rule out. So no link between classes is lost, while a
bucket of many copies costs one comparison each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockline.llm import common
from dockline.llm.components import components
from dockline.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 shares no band with probability 3e-6.
BANDS, ROWS = 32, 5
# Registers of the sketches that rule out pairs; one loses a pair of similarity 0.8 with probability 2e-8.
FINE = 1024
# Parts that the copies of one text are dealt over before all but one are dropped.
SPREAD = 16

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed multipliers of a public-domain generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _exponential(seed: np.ndarray) -> np.ndarray:
    return -np.log(((_mix(seed) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets of all texts: text number, shingle hash, how often.

    Words are cut at ASCII white space and compared without ASCII case. A text
    of fewer words than a shingle is one shingle; one without words has none.
    """
    import pandas as pd
    import xxhash

    doc, code, distinct = common.word_codes([t.translate(common.LOWER) for t in texts])
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), dtype=np.uint64, count=len(distinct))
    word = hashes[code]
    counts = np.bincount(doc, minlength=len(texts))
    starts = np.cumsum(counts) - counts
    rows, keys = [], []
    with np.errstate(over="ignore"):
        n = len(word) - size + 1
        if n > 0:
            key = word[:n].copy()
            for k in range(1, size):
                key = _mix(key + _GOLD) + word[k : k + n]
            inside = doc[:n] == doc[size - 1 :]
            rows.append(doc[:n][inside])
            keys.append(_mix(key[inside]))
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            key = word[starts[i] : starts[i] + 1].copy()
            for k in range(1, counts[i]):
                key = _mix(key + _GOLD) + word[starts[i] + k]
            rows.append(np.array([i]))
            keys.append(_mix(key + np.uint64(counts[i])))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row, key = np.concatenate(rows), np.concatenate(keys)
    kinds, values = pd.factorize(key)
    pair, own = pd.factorize(row * max(len(values), 1) + kinds)
    return own // max(len(values), 1), values[own % max(len(values), 1)], np.bincount(pair)


def signatures(n: int, doc: np.ndarray, key: np.ndarray, weight: np.ndarray, registers: int = BANDS * ROWS) -> np.ndarray:
    """The earliest point of every register, one row per text; infinite without shingles."""
    earliest = np.full(n * registers, np.inf)
    limit = np.full(n, np.inf)
    with np.errstate(over="ignore"):
        # top intervals: (0, 1], (1, 2], (2, 4], (4, 8] ... as far as the weight goes
        top = [(np.arange(len(key)), 0, 1)]
        low = 1
        while len(key) and low < weight.max():
            top.append((np.flatnonzero(weight > low), low, 2 * low))
            low *= 2
        at = np.concatenate([x for x, _, _ in top])
        a = np.concatenate([np.full(len(x), low) for x, low, _ in top])
        b = np.concatenate([np.full(len(x), high) for x, _, high in top])
        d, w = doc[at], weight[at]
        seed = _mix(key[at] + _mix(a.astype(np.uint64) * _GOLD + b.astype(np.uint64)))
        t = _exponential(seed) / (b - a)
        turn = 0
        while len(d):
            unit = b - a == 1
            mark = _mix(seed ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            if unit.any():
                register = (mark[unit] >> np.uint64(32)) % np.uint64(registers)
                np.minimum.at(earliest, d[unit] * registers + register.astype(np.int64), t[unit])
            if turn < 4 or turn % 8 == 0:
                limit = earliest.reshape(n, registers).max(1)
            turn += 1
            # a unit goes on to its next point; a wider interval splits, and the half without the point gets its own first one
            step = np.where(unit, seed + _GOLD, _mix(seed + np.uint64(1)))
            later = t + _exponential(step) / np.where(unit, 1.0, (b - a) / 2)
            wide = np.flatnonzero(~unit)
            if len(wide):
                middle = (a[wide] + b[wide]) // 2
                left = (mark[wide] & np.uint64(1)) == 0
                t_left = np.where(left, t[wide], later[wide])
                t_right = np.where(left, later[wide], t[wide])
                one, two = _mix(seed[wide] + np.uint64(2)), _mix(seed[wide] + np.uint64(3))
                u = np.flatnonzero(unit)
                d = np.concatenate([d[u], d[wide], d[wide]])
                w = np.concatenate([w[u], w[wide], w[wide]])
                a, b = np.concatenate([a[u], a[wide], middle]), np.concatenate([b[u], middle, b[wide]])
                t = np.concatenate([later[u], t_left, t_right])
                seed = np.concatenate([step[u], one, two])
            else:
                t, seed = later, step
            on = (t < limit[d]) & (a < w)
            if not on.all():
                d, w, a, b, t, seed = (x[on] for x in (d, w, a, b, t, seed))
    return earliest.reshape(n, registers)


def bands(signature: np.ndarray, count: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A bucket number per band, different between bands."""
    bits = signature.view(np.uint64).reshape(len(signature), count, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64) * _GOLD, bits.shape[:2]).copy()
        for r in range(rows):
            key = _mix(key + bits[:, :, r])
    return key.view(np.int64)


def sketch(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row: its node (hash of the text), its weight (number of shingles) and its buckets."""
    fields = [common.field("weight", "bigint"), common.field("buckets", "array<bigint>")]

    def work(texts):
        doc, key, weight = shingles(texts)
        total = np.bincount(doc, weights=weight, minlength=len(texts)).astype(np.int64)
        own = bands(signatures(len(texts), doc, key, weight))
        return {"weight": total, "buckets": [x if t else [] for x, t in zip(own, total, strict=True)]}

    base = docs.select("_id", "_node", F.col(text).alias("_text"))
    return common.map_texts(base, ["_id", "_node"], fields, work, text="_text")


def similarities(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of pairs (a, b) of nodes, those whose multisets reach the similarity."""
    one = texts.select(F.col("_node").alias("a"), F.col("_text").alias("text_a"))
    two = texts.select(F.col("_node").alias("b"), F.col("_text").alias("text_b"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b")
    schema = T.StructType([common.field("a", "bigint"), common.field("b", "bigint")])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            one, two = (common.as_bytes(batch.column(batch.schema.names.index(c))) for c in ("text_a", "text_b"))
            for low, high in common.blocks([x + y for x, y in zip(one, two, strict=True)], common.BLOCK_BYTES):
                n = high - low
                doc, key, weight = shingles(one[low:high] + two[low:high])
                ok = _jaccard(doc % n, doc >= n, key, weight, n) >= similarity
                columns = [batch.column(batch.schema.names.index(c)).slice(low, n) for c in ("a", "b")]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"]).filter(pa.array(ok))

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def _jaccard(pair: np.ndarray, second: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    import pandas as pd

    kinds = pd.factorize(key)[0]
    code, own = pd.factorize(pair * (kinds.max() + 1 if len(kinds) else 1) + kinds)
    sides = np.zeros((2, len(own)))
    np.add.at(sides, (second.astype(np.int64), code), weight)
    place = own // (kinds.max() + 1 if len(kinds) else 1)
    both = np.bincount(place, weights=sides.min(0), minlength=n)
    either = np.bincount(place, weights=sides.max(0), minlength=n)
    return np.where(either > 0, both / np.maximum(either, 1), 0.0)


def _placed(docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """Per row its id, the node of its text, its class, and the class's smallest id and size."""
    base = docs.select(
        docs[doc_id].cast("bigint").alias("_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text")
    ).withColumn("_node", F.xxhash64("_text"))
    rows = materialize(sketch(base, "_text"), "sketch")
    buckets = rows.groupBy("_node").agg(F.first("weight").alias("weight"), F.first("buckets").alias("buckets")).select(
        F.col("_node").alias("node"), "weight", F.explode("buckets").alias("bucket"))
    buckets = materialize(buckets, "buckets")
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(buckets.join(sizes, "bucket"), "shared")

    # the texts that share a bucket at all are fetched once; without the hint a small table of nodes would be broadcast
    nodes = shared.select(F.col("node").alias("_node")).distinct()
    parts = nodes.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dealt = base.select("_node", "_text", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int").alias("_part"))
    few = dealt.join(parts.hint("merge"), ["_node", "_part"], "left_semi").dropDuplicates(["_node", "_part"])
    texts = materialize(few.drop("_part").dropDuplicates(["_node"]), "texts")
    fine = materialize(_fine(texts), "fine")

    # first, everyone against its buckets' most connected text
    central = shared.groupBy("node").agg(F.sum("n").alias("reach"))
    leaders = shared.join(central, "node").groupBy("bucket").agg(F.max(F.struct("reach", "node", "weight")).alias("leader"))
    pairs = shared.join(leaders, "bucket").where("node <> leader.node").where(_near("weight", "leader.weight", similarity))
    pairs = pairs.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct()
    planes = fine.select("node", "planes")
    first = materialize(
        pairs.join(planes.toDF("a", "planes"), "a").join(planes.toDF("b", "planes2"), "b")
        .where(_alike("planes", "planes2", similarity)).select("a", "b"), "first-pairs")
    links = materialize(similarities(first, texts, similarity), "first-links")
    classes = materialize(components(links), "first-classes")

    # then, what is left outside a bucket's largest class against all of the bucket whose sketch does not rule it out
    own = shared.drop("n").join(classes, "node", "left").withColumn("class", F.coalesce("label", "node")).drop("label")
    main = own.groupBy("bucket", "class").count().groupBy("bucket").agg(
        F.max(F.struct("count", "class")).alias("main"), F.count(F.lit(1)).alias("classes")
    ).where("classes > 1").select("bucket", F.col("main.class").alias("main"))
    rest = materialize(own.join(main, "bucket"), "open").join(fine, "node")
    other = rest.select("bucket", *(F.col(c).alias(f"{c}2") for c in ("node", "weight", "class", "buckets", "planes")))
    second = rest.where("class <> main").join(other, "bucket").where(
        # of two texts outside the largest class each pair counts once
        (F.col("class") != F.col("class2")) & ((F.col("class2") == F.col("main")) | (F.col("class") < F.col("class2")))
        & _near("weight", "weight2", similarity)
        & (F.get(F.array_intersect("buckets", "buckets2"), F.lit(0)) == F.col("bucket"))
        & _alike("planes", "planes2", similarity)
    ).select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
    second = materialize(second.join(first, ["a", "b"], "left_anti"), "second-pairs")
    more = materialize(similarities(second, texts, similarity), "second-links")
    if not more.isEmpty():
        classes = materialize(components(links.unionByName(more)), "classes")

    # a text's rows are counted first, so a class is as many rows as it has texts; the hashes among the keys leave each
    # join's smaller side on a shuffle of its own, and AQE free to split a class of many texts, or a text of many rows
    counted = rows.groupBy("_node").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_rows"))
    known = counted.join(classes.withColumnRenamed("node", "_node"), "_node", "left").select(
        "_node", "_least", "_rows", F.coalesce("label", "_node").alias("_class")
    )
    named = known.groupBy(F.xxhash64("_class").alias("_hash"), "_class").agg(
        F.min("_least").alias("class_id"), F.sum("_rows").alias("class_size")).drop("_hash")
    places = known.join(named, "_class").select("_node", F.xxhash64("_node").alias("_hash"), "_class", "class_id", "class_size")
    return rows.select("_id", "_node", F.xxhash64("_node").alias("_hash")).join(places, ["_node", "_hash"]).drop("_hash")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Per row: doc_id, class_id (the smallest id of its class), class_size, kept.

    Rows of one class are copies, or joined by a chain of pairs of the
    similarity. `kept` is true for the class_id's row; if rows repeat that id
    in a class, for all of them. A null text counts as empty; texts without
    words are of one class only if equal. Rows without an id belong to a class
    too, and give it its id only if all do so; it is then null.
    """
    return _placed(docs, doc_id, text, similarity).select(
        F.col("_id").alias("doc_id"), "class_id", "class_size", F.col("_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def _fine(texts: DataFrame) -> DataFrame:
    """Per node its buckets, and two bits of each of FINE registers."""
    fields = [common.field("buckets", "array<bigint>"), common.field("planes", "array<bigint>")]

    def work(texts):
        doc, key, weight = shingles(texts)
        n = len(texts)
        code = _mix(signatures(n, doc, key, weight, FINE).view(np.uint64))
        planes = [np.packbits((code >> np.uint64(k) & np.uint64(1)).astype(np.uint8), axis=1) for k in range(2)]
        return {
            "buckets": list(bands(signatures(n, doc, key, weight))),
            "planes": list(np.concatenate(planes, axis=1).view(np.int64)),
        }

    return common.map_texts(texts.withColumnRenamed("_node", "node"), ["node"], fields, work, text="_text")


def _alike(a: str, b: str, similarity: float):
    """Whether two sketches differ in few enough registers; 5.5 standard deviations are left for chance."""
    differ = (1 - similarity) * 0.75
    most = int(FINE * differ + 5.5 * (FINE * differ * (1 - differ)) ** 0.5)
    half = FINE // 64
    xor = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    either = F.zip_with(F.slice(xor, 1, half), F.slice(xor, half + 1, half), lambda x, y: x.bitwiseOR(y))
    return F.aggregate(either, F.lit(0), lambda acc, x: acc + F.bit_count(x)) <= most


def _near(a: str, b: str, similarity: float):
    """Multisets whose sizes differ by more cannot reach the similarity."""
    return F.least(a, b) >= F.lit(similarity) * F.greatest(a, b)


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all its columns: one that has the class_id.

    Of repeated rows with that id and equal texts any one stays; if their
    texts differ, the one whose text has the smallest hash.
    """
    rows = _placed(docs, doc_id, text, similarity).where(F.col("_id").eqNullSafe(F.col("class_id")))
    one = (
        rows.groupBy("_class", "_id", "_node").agg(F.count(F.lit(1)).alias("repeats"))
        .groupBy("_class").agg(F.min(F.struct("_node", "_id", "repeats")).alias("kept"))
        .select("kept._node", "kept._id", "kept.repeats")
    )
    node = F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit("")))
    same = (node == one["_node"]) & docs[doc_id].cast("bigint").eqNullSafe(one["_id"])
    columns = [docs[c] for c in docs.columns]
    chosen = materialize(docs.join(one, same).select(*columns, one["_node"], one["_id"], one["repeats"]), "survivors")
    single = chosen.where("repeats = 1")
    return single.unionByName(chosen.where("repeats > 1").dropDuplicates(["_node", "_id"])).select(*docs.columns)
