import collections
import random
import re

import duckdb
import numpy as np
import pytest

from dockline.llm import divergence, oracle, queries

SCHEMA = "doc_id long, text string, lang string, source string, value long"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=50):
    counts, docs, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for _, text, lang, source, *_ in rows:
        terms = [t.translate(SMALL) for t in TERM.findall(text or "")]
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: counts[lang, s] for x, s in groups if x == lang}
        all_ = collections.Counter()
        for c in own.values():
            all_.update(c)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(all_)
        for s in own:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])}
    return out


def rows(rnd, n):
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)] + ["É", "é", "日本", "Don't", "A\x7fB", "x\x00y"]
    for i in range(n):
        source = rnd.choice(["s1", "s1", "s1", "s2", "s3", "", None, "Z", "é"])
        lang = rnd.choice(["en", "en", "en", "de", None, ""])
        text = rnd.choice([" ", ", ", "\n"]).join(rnd.choices(words, weights=[1 + (hash(source or 0) + k) % 9 for k in range(len(words))], k=rnd.randint(0, 60)))
        yield (i, None if i % 19 == 0 else text, lang, source, 3)
    yield (n, "only here", "xx", "alone", 1)
    yield (n + 1, None, "yy", "b", 1)
    yield (n + 2, "1 2 3", "yy", "a", 1)
    yield (n + 2, "1 2 3", "yy", "a", 1)
    yield (n + 3, "empty source", "en", "no kept terms", 1)


def run(spark, tmp_path, data):
    spark.createDataFrame(data, SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return [tuple(r) for r in queries.op13_divergence(spark, str(tmp_path)).select("lang", "source", "part", "item", "value", "rank").collect()]


@pytest.fixture(scope="module")
def data():
    return list(rows(random.Random(21), 1500))


def test_query_equals_brute_force_and_sql(spark, tmp_path, data):
    got = run(spark, tmp_path, data)
    assert len(got) == len(set(got)) and set(got) == brute(data)
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(f"select lang, source, part, item, value, rank from ({oracle.ORACLE['op13_divergence']})").fetchall()
    assert sorted(got) == sorted(want)


def test_many_slices_and_early_sending_change_nothing(spark, tmp_path, data, monkeypatch):
    whole = run(spark, tmp_path, data)
    monkeypatch.setattr(divergence, "SLICE_POSTINGS", 1)
    monkeypatch.setattr(divergence, "HELD_TERMS", 10)
    monkeypatch.setattr(divergence.common, "BLOCK_BYTES", 64)
    assert sorted(run(spark, tmp_path, data)) == sorted(whole)


def test_row_accumulation_equals_brute_force():
    rnd = random.Random(22)
    for big in (1, 10**10):
        for _ in range(40):
            size, kept, absent = rnd.randint(1, 7), rnd.randint(0, 30), rnd.randint(0, 5)
            matrix = np.array([[rnd.choice([0, 0, 1, 2, 50]) * big for _ in range(size)] for _ in range(kept)], dtype=np.int64).reshape(kept, size)
            total = matrix.sum(0) + np.array([rnd.randint(0, 9) for _ in range(size)])  # terms of other slices
            terms = kept + absent
            order = rnd.sample(range(size), size)
            lists = [[g for g in rnd.sample(range(size), size) if row[g]] for row in matrix]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            peer = np.array([g for x in lists for g in x], dtype=np.int64)
            n = np.array([matrix[t][g] for t, x in enumerate(lists) for g in x], dtype=np.int64)
            p = [[1 + 10**9 * (int(matrix[t][g]) + 5) // (int(total[g]) + 5 * terms) for t in range(kept)] for g in range(size)]
            parts = dict(divergence.slice_sums(np.array(order), total[order], terms, offsets, peer, n))
            for g in range(size):
                for h in range(g):
                    assert parts[g][h] + parts[h][g] == sum(abs(a - b) for a, b in zip(p[g], p[h]))


def test_long_texts_are_read_in_portions():
    text = ("ab, Cd " * 50 + "x" * 500 + " E\u00e9 ").encode()
    assert sum(divergence.pieces(text, 40), []) == next(divergence.pieces(text))
    assert next(divergence.pieces(b"")) == []


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_clashing_names(spark):
    docs = spark.createDataFrame([(i, "same words", "a", f"s{i % 2}", 1, "z") for i in range(60)], "rank long, text string, lang string, source string, n int, term string")
    got = {(r.source, r.item, r.value) for r in divergence.audit(docs).collect()}
    assert got == {("s0", "s1", 0), ("s1", "s0", 0)}
