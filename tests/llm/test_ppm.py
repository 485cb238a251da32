import collections
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from dockline.llm import common, ppm


def tokens(text):
    return [*(text or "").encode().translate(common.LOWER).split(), b"\n"]


def brute(rows, order):
    known, context = collections.Counter(), collections.defaultdict(collections.Counter)
    stream = lambda t: b"\n" * order + b" ".join(tokens(t)[:-1]) + b"\n"
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            known.update(tokens(t))
            s = stream(t)
            for p in range(order, len(s)):
                for k in range(order + 1):
                    context[s[p - k : p]][s[p]] += 1
    total, kinds = sum(known.values()), len(known)
    out = {}
    for i, t in rows:
        base = sum(math.log10((known[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens(t))
        s, score = stream(t), 0.0
        for p in range(order, len(s)):
            gone = set()
            for k in range(order, -1, -1):
                left = {x: n for x, n in context.get(s[p - k : p], {}).items() if x not in gone}
                if not left:
                    continue
                if s[p] in left:
                    score += math.log10((2 * left[s[p]] - 1) / (2 * sum(left.values())))
                    break
                score += math.log10(len(left) / (2 * sum(left.values())))
                gone |= set(context[s[p - k : p]])
            else:
                score -= math.log10(256 - len(gone))
        out[i] = (len(tokens(t)), sum(known[w] > 0 for w in tokens(t)), base, score)
    return out, total


@pytest.mark.parametrize("order", [3, 6])
def test_scores_equal_brute_force(spark, order):
    rnd = random.Random(order)
    word = lambda: "".join(rnd.choice(["th", "er", "on", "é", "X", "zz"]) for _ in range(rnd.randint(1, 4)))
    rows = [(i, " ".join(word() for _ in range(rnd.randint(0, 60)))) for i in range(60)] + [(60, None), (61, ""), (62, " \n\t "), (63, "日本 qqq")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(3)
    got = ppm.score(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 1, order=order, block_bytes=2000).collect()
    want, total = brute(rows, order)
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {total}
    for r in got:
        n, known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "ab"), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.score(docs, F.lit(True)).collect()}
    assert got[1].score == pytest.approx(-3 * math.log10(256)) and got[1].base_score == 0
    assert got[None].n_tokens == 1
    assert ppm.score(docs.limit(0), F.lit(True)).count() == 0
