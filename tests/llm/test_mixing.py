import random

import duckdb
import pytest
from pyspark.sql import functions as F

from dockline.llm import mixing, oracle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def filled(sizes, weights, most):
    """Targets by sharing anew until none is above its cap."""
    total, goal, open_ = sum(sizes.values()), {}, dict(sizes)
    while open_:
        rest = total - sum(goal.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return goal | share
        for s in over:
            goal[s] = most * sizes[s]
            del open_[s]
    return goal


def rows(rnd, n):
    big = ["src0"] * 6
    for i in range(n):
        source = rnd.choice([*big, "a", "b", "B", "é", "z\U0001F600", "z\uffee", "", None, "tiny"][: None if i % 9 else 8])
        words = rnd.choice([0, 1, 3, 10, 40]) if source != "tiny" else 1
        yield (i // 2 if i % 10 == 0 else i, " \n\t"[i % 3].join(["w"] * words) if i % 17 else None, "en", source, 5)


def compare(spark, tmp_path, data):
    docs = spark.createDataFrame(data, SCHEMA)
    docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op12_mixing(spark, str(tmp_path)).select("doc_id", "size", "source_size", "target", "taken").collect()]
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(f"select doc_id, size, source_size, target, taken from ({oracle.ORACLE['op12_mixing']})").fetchall()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def test_query_equals_sql_and_meets_targets(spark, tmp_path):
    data = list(rows(random.Random(5), 900))
    got = compare(spark, tmp_path, data)
    assert len(got) == len(data)
    sizes, by = {}, {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    goal = filled(sizes, {s: 1 + i % 3 for i, s in enumerate(order)}, 3)
    docs = spark.createDataFrame(data, SCHEMA)
    assert {r._source: r.target for r in mixing.targets(
        docs.select(F.col("source").alias("_source"), mixing.n_words(F.col("text")).alias("size"))).collect()} == pytest.approx(goal)
    for r in mixing.taken_words(*mixing.mix(docs, ["doc_id", "source"])).collect():
        assert 0 <= r.taken <= 3 * r["size"]
        by[r.source] = by.get(r.source, 0) + r.taken
    assert all(abs(by[s] - goal[s]) <= 1 for s in goal) and sum(by.values()) <= sum(sizes.values())
    assert goal["tiny"] == 3 * sizes["tiny"]


def test_mix_is_in_order_of_finish_and_ends_at_the_budget(spark):
    docs = spark.createDataFrame(list(rows(random.Random(6), 400)), SCHEMA)
    queued, mixed = mixing.mix(docs, share=0.5, seed="other")
    got = sorted(mixed.collect(), key=lambda r: r.position)
    assert [r.finish for r in got] == sorted(r.finish for r in got)
    at = 0
    for r in got:
        assert r.position == at and r.words > 0
        at += r.words
    total = queued.agg(F.sum("size")).first()[0]
    assert abs(at - total // 2) <= 12


def test_order_of_rows_and_partitions_does_not_matter(spark):
    data = list(rows(random.Random(7), 300))
    results = []
    for n in (1, 13):
        docs = spark.createDataFrame(sorted(data, key=lambda r: (r[0] * n) % 7), SCHEMA).repartition(n)
        results.append(sorted(map(tuple, mixing.taken_words(*mixing.mix(docs)).collect())))
    assert results[0] == results[1]


def test_slices_of_a_hot_source(spark, monkeypatch):
    """Running sums over many slices equal those over one."""
    data = [(i, "w " * (i % 7), "en", "hot" if i % 3 else f"s{i % 5}", 1) for i in range(500)]
    docs = spark.createDataFrame(data, SCHEMA)
    whole = sorted(map(tuple, mixing.taken_words(*mixing.mix(docs)).collect()))
    monkeypatch.setattr(mixing, "SLICE_ROWS", 20)
    assert sorted(map(tuple, mixing.taken_words(*mixing.mix(docs)).collect())) == whole


def test_plan_is_native(spark, tmp_path):
    docs = spark.createDataFrame(list(rows(random.Random(8), 50)), SCHEMA)
    plan = mixing.taken_words(*mixing.mix(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_empty_and_wordless_tables_and_clashing_names(spark, tmp_path):
    assert compare(spark, tmp_path, []) == []
    got = compare(spark, tmp_path, [(1, None, "x", None, 0), (1, None, "x", None, 0), (2, " ", "x", "a", 0)])
    assert len(got) == 3 and all(r[1:] == (0, 0, 0.0, 0) for r in got)
    docs = spark.createDataFrame([(None, "a b", "s", "kept", 7)], "doc_id long, text string, source string, words string, target int")
    r = mixing.taken_words(*mixing.mix(docs, ["doc_id", "words", "target"])).first()
    assert (r.doc_id, r.words, r["size"], r.target, r.taken) == (None, "kept", 2, 2.0, 2)
