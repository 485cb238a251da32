import collections
import random
import re

import numpy as np

from dockline.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    full = [x for x in lines if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(full) - len(set(full)), len(inside))


def test_counts_equal_brute_force():
    rnd = random.Random(4)
    words = ["a", "b", "é\xa0c", "#x", "||", "\n", " ", "\n\n", "word", "\t", "日本", "\x85", "A<b"]
    texts = ["", "a", "a b", "a a a a", "x y z", "x y z x y z", "\n \n", "a\na\r\na"] + [
        "".join(rnd.choice(words) + rnd.choice(["", " ", "\n"]) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    made = quality.statistics([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert tuple(int(made[c][i]) for c in quality.BASE) == brute(t), t
    assert np.array_equal(made["base_failed"], [n < 50 or 2 * r > n for n, _, _, _, r in map(brute, texts)])


def good(rnd):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(60, 300)))


def bad(rnd):
    return " ".join(w + rnd.choice(["###", "$$$", "%%%"]) for w in good(rnd).split())


def test_forest_rejects_junk_and_keeps_the_rest(spark):
    rnd = random.Random(8)
    rows = [(i, good(rnd) if i % 25 else bad(rnd)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 25 > 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    forest = quality.fit(docs, labels)
    kept = {r.doc_id for r in quality.score_rules(docs, forest, ["doc_id"], only_kept=True).collect()}
    held = range(300, 600)
    assert all(i in kept for i in held if i % 25) and sum(i in kept for i in held if i % 25 == 0) <= 3


def test_nulls_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "word " * 60, "y"), (2, "", "z"), (2, "", "z")], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, labels) is None
    got = quality.score_rules(docs, None, ["doc_id", "kept"]).collect()
    assert len(got) == 4 and not any(r.kept for r in got) and all(r.anomaly is None for r in got)
    assert quality.score_rules(docs.limit(0), None, ["doc_id"]).count() == 0
