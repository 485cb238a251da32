import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockline.llm import queries, runs


def brute(words, least=24, exponent=3):
    """Every maximal stretch of every period, shortest period first."""
    n, seen = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(least, exponent * q) and (start, end) not in seen:
                seen[start, end] = q
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def samples(rnd, count, size):
    for _ in range(count):
        letters = rnd.randint(1, 4)
        n = rnd.randint(0, size)
        w = [rnd.randrange(letters) for _ in range(n)]
        for _ in range(rnd.randint(0, 4)):  # planted repeats, some with an error inside
            if n > 4:
                a, p = rnd.randrange(n), rnd.randint(1, max(1, n // 4))
                b = min(n, a + rnd.randint(2, 6) * p)
                w[a:b] = [w[min(a + (i - a) % p, n - 1)] for i in range(a, b)]
        yield w


@pytest.mark.parametrize("least,exponent", [(24, 3), (0, 2), (5, 2), (0, 3), (40, 4), (1, 3)])
def test_runs_equal_brute_force(least, exponent):
    rnd = random.Random(11)
    for w in samples(rnd, 150, 220):
        assert runs.find_runs(np.array(w, dtype=np.int64), least, exponent) == brute(w, least, exponent), w


def test_fibonacci_and_thue_morse_words():
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    morse = [bin(i).count("1") % 2 for i in range(512)]
    for w in (b, morse, [0] * 500, [0, 1, 2] * 300, ([0] * 60 + [1]) * 9):
        for least, exponent in ((0, 2), (24, 3)):
            assert runs.find_runs(np.array(w), least, exponent) == brute(w, least, exponent)


def test_words_in_portions_give_the_same_runs():
    rnd = random.Random(12)
    for k, w in enumerate(samples(rnd, 60, 150)):
        catchers = runs.Catchers(runs.Powers(runs.BASES[0]))
        at = 0
        while at < len(w):
            step = 1 if k % 2 else rnd.randint(1, 40)
            catchers.append(np.array(w[at : at + step]))
            at += step
            if k < 6:
                assert catchers.runs() == brute(w[:at])
        assert catchers.runs() == brute(w)


def test_a_collision_is_noticed(monkeypatch):
    """With a base of one the fingerprint is a mere sum, so many blocks collide."""
    w = np.array(random.Random(3).choices(range(3), k=300))
    catchers = runs.Catchers(runs.Powers(1), most=300)
    catchers.append(w)
    with pytest.raises(runs.Collision):
        catchers.runs()
    monkeypatch.setattr(runs, "_POWERS", [runs.Powers(1), runs.Powers(runs.BASES[1])])
    assert runs.find_runs(w) == brute(w.tolist())


def test_long_periodic_text_is_quick():
    w = np.tile(np.arange(7), 60_000)
    assert runs.find_runs(w) == [(0, len(w), 7)]
    nested = np.tile(np.concatenate([np.zeros(500, dtype=np.int64), [1]]), 200)
    found = runs.find_runs(nested)
    assert (0, len(nested), 501) in found and len(found) == 201


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return [w.decode() for w in words]


def expected(doc_id, text):
    words = planted(doc_id, text)
    found = brute(words)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(13)
    rows = [(i, " \t\x0b\n"[rnd.randrange(4)].join(f"w{c}" for c in w), "x", "y") for i, w in enumerate(samples(rnd, 300, 200))]
    rows += [(900, None, None, None), (901, "", "", ""), (901, "", "", ""), (902, " \n ", "a", "b"), (903, "\xa0 é\x85f " * 30, "a", "b"),
             (904, "x" * 300_000 + " y" * 50, "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, start string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_runs(spark, str(tmp_path)).collect()
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted((r.doc_id, *(r[c] for c in columns)) for r in got if r.doc_id != 901) == sorted(
        (r[0], *expected(r[0], r[1])) for r in rows if r[0] != 901)
    assert sum(r.doc_id == 901 for r in got) == 2
    assert sum(r.n_runs > 0 for r in got) > 30


def test_null_id_empty_table_and_clashing_names(spark):
    docs = spark.createDataFrame([(None, "a b " * 40, 5, "z")], "doc_id long, text string, start int, collapsed string")
    got = runs.periodic_runs(docs, ["doc_id", "start", "collapsed"]).first()
    assert (got.start, got.length, got.period, got.collapsed) == (0, 80, 2, "a b")
    assert queries.planted_repeats(docs).first().text == "a b " * 40
    assert runs.periodic_runs(docs.where("false"), ["doc_id"]).count() == 0
    assert runs.periodic_runs(docs.withColumn("text", F.lit(None).cast("string")), []).first().n_runs == 0
