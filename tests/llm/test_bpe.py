import hashlib
import random

import numpy as np
import pytest

from dockline.llm import bpe
from dockline.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(vocabulary())


def test_tree_equals_whole_encoding(reference):
    pieces = ["a" * 50, "the ", "abcdefgh", " ", "  ", "\n", "\n\n", "'s", "'re", "don't", "1234567", "!!!", "---", "é", "日本語",
              "<|endoftext|>", "\t", " !'", "x'relax", "ß", "\xa0", "́", "<|endof"]
    rnd, own = random.Random(3), bpe.codec(vocabulary())
    for _ in range(400):
        text = "".join(rnd.choice(pieces) * rnd.choice([1, 1, 3, 20]) for _ in range(rnd.randint(0, 50)))
        want = reference.encode(text, add_special_tokens=False).ids
        assert own.encode(text.encode(), rnd.choice([7, 30, 100])).tolist() == want, text
        assert own.decode(want) == reference.decode(want, skip_special_tokens=False)


ROWS = [(1, "Hello <|endoftext|> world", 5), (2, None, 1), (3, "", 0), (4, "x" * 3000 + " é" * 900, 2), (4, "x" * 3000 + " é" * 900, 2), (None, "a  b", 1)]


def test_rows(spark, reference):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, n_tokens long")
    got = bpe.round_trip(docs, vocabulary(), ["doc_id", "n_tokens"], leaf_chars=100).collect()
    assert len(got) == len(ROWS)
    want = set()
    for i, text, _ in ROWS:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert bpe.round_trip(docs.limit(0), vocabulary()).count() == 0


def test_decode(spark):
    docs = spark.createDataFrame(ROWS[:4], "doc_id long, text string, ids long").drop("ids")
    back = bpe.decode(bpe.encode(docs, vocabulary(), leaf_chars=500), vocabulary()).collect()
    assert {r.doc_id: r.decoded for r in back} == {i: t or "" for i, t, _ in ROWS[:4]}
