import collections
import random

import numpy as np

from dockline.llm import minhash
from dockline.llm.components import components


def multiset(text):
    words = (text or "").lower().split()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()


def jaccard(a, b):
    either = sum((a | b).values())
    return sum((a & b).values()) / either if either else 0.0


def brute(rows):
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    sets, parent = [multiset(t) for t in texts], list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                parent[top(i)] = top(j)
    classes = collections.defaultdict(list)
    for i, t in rows:
        classes[top(texts.index(t or ""))].append(i)
    return {i: min(c) for c in classes.values() for i in c}


def corpus():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    rows = []
    for size in (4, 30, 120, 120):
        base = [word() for _ in range(size)]
        for _ in range(14):
            edited = [w if rnd.random() > rnd.choice([0, 0.01, 0.03, 0.06]) else word() for w in base]
            rows.append(" ".join(edited))
    rows += ["", None, "one", "ONE", "a b c d e " * 30, "a b c d e " * 29, rows[3], rows[3]]
    return list(enumerate(rows))


def test_signatures_are_unbiased():
    rnd, rng, z = random.Random(1), np.random.default_rng(1), []
    for _ in range(40):
        n = rnd.choice([5, 20, 50])
        key = rng.integers(0, 2**63, n, dtype=np.uint64)
        a = rng.integers(0, 10, n)
        b = np.where(rng.random(n) < 0.7, a, rng.integers(0, 10, n))
        a[0] = b[0] = 1
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        doc = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
        got = minhash.signatures(2, doc, np.r_[key[a > 0], key[b > 0]], np.r_[a[a > 0], b[b > 0]], 2048)
        z.append(((got[0] == got[1]).mean() - want) / max(np.sqrt(want * (1 - want) / 2048), 1e-3))
    assert abs(np.mean(z)) < 4 / np.sqrt(40) and np.std(z) < 1.6


def test_classes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == brute(rows)
    kept = [r.doc_id for r in minhash.drop_near_duplicates(docs).collect()]
    assert sorted(kept) == sorted(set(brute(rows).values()))


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (None, "a b c d e f", "z"), (None, "other words are here now", "w"), (2, None, "v"), (3, "", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    got = minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got if r.doc_id) == [(1, 1, 3), (1, 1, 3), (2, 2, 2), (3, 2, 2)]
    kept = minhash.drop_near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("1", "a b c d e f"), ("2", None), ("None", "other words are here now")]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, rnd.randint(101, 200)) for _ in range(50)] + [(7, 7), (None, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {v for k, v in got.items() if k >= 100} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.3",
}


def test_hot_text_is_split(spark, conf):
    """A third of all rows are one text: AQE cuts its partition of the last join."""
    for key, value in SPLIT.items():
        conf(key, value)
    docs = spark.range(0, 12_000, 1, 16).selectExpr(
        "id doc_id", "if(id % 3 = 0, 'the same few words for all', concat_ws(' ', id, id + 1, id * 7, md5(cast(id as string)), id * 13)) text")
    placed = minhash.near_duplicates(docs)
    got = placed.groupBy().agg({"class_size": "max", "class_id": "sum", "doc_id": "count"})
    row = got.collect()[0]
    assert (row["max(class_size)"], row["count(doc_id)"]) == (4000, 12_000)
    assert row["sum(class_id)"] == sum(i for i in range(12_000) if i % 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan, plan
