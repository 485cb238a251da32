"""BPE encoding by tree concatenation, and decoding.

Long texts are cut into leaves that tasks encode in parallel. Two neighbours
are joined by encoding a window around the cut anew; the window grows until
its first token is the left side's and its last token the right side's, and
the tokens beyond it stay. That is exact: the pre-tokeniser looks one
character ahead only, and inside one of its pieces a token sequence is the
encoding if every two neighbours are what their own concatenation encodes to.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockline.llm import common

# Characters of a leaf; longer texts are encoded by several tasks.
LEAF_CHARS = 32_768
# Tokens on either side of the first window around a join.
WINDOW = 8

# The pre-tokeniser of byte-level BPE (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Codec:
    """The vocabulary of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = {c: b for b, c in enumerate(byte_alphabet())}
        specials = {x["content"]: x["id"] for x in spec["added_tokens"] if x["special"]}
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in spec["model"]["vocab"].items() if token not in specials
        }
        self.encoder = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)
        self.tokens = np.empty(max([*ranks.values(), *specials.values()]) + 1, dtype=object)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in specials.items())]:
            self.tokens[i] = token
        self.special = [s.encode() for s in specials]

    def leaf(self, text: bytes) -> np.ndarray:
        return np.array(self.encoder.encode(text.decode("utf-8"), allowed_special="all"), dtype=np.uint32)

    def bytes_of(self, ids: Sequence[int]) -> bytes:
        return b"".join(self.tokens[ids])

    def decode(self, ids: Sequence[int]) -> str:
        return self.bytes_of(np.asarray(ids, dtype=np.int64)).decode("utf-8", errors="replace")

    def encode(self, text: bytes, leaf_chars: int = LEAF_CHARS) -> np.ndarray:
        """The whole tree in one place: leaves, then joins of neighbours."""
        chars = text.decode("utf-8")
        nodes = [
            (part, self.leaf(part))
            for part in (chars[i : i + leaf_chars].encode() for i in range(0, len(chars), leaf_chars))
        ]
        return self.fold(nodes)

    def fold(self, nodes: list[tuple[bytes, np.ndarray]]) -> np.ndarray:
        """Join neighbours, level by level, until one is left."""
        if not nodes:
            return np.zeros(0, dtype=np.uint32)
        while len(nodes) > 1:
            pairs = [nodes[i : i + 2] for i in range(0, len(nodes), 2)]
            nodes = [self.join(*p) if len(p) == 2 else p[0] for p in pairs]
        return nodes[0][1]

    def join(self, a: tuple[bytes, np.ndarray], b: tuple[bytes, np.ndarray], window: int = WINDOW) -> tuple[bytes, np.ndarray]:
        text, (_, left), (_, right) = a[0] + b[0], a, b
        while window < min(len(left), len(right)):
            i = self._cut(a[0], left, window, -1)
            j = self._cut(b[0], right, window, 1)
            if i is None or j is None:
                break
            (at, start), (to, stop) = i, j
            middle = text[start : len(a[0]) + stop]
            if not any(self._splits(text, s, start, len(a[0]) + stop) for s in self.special):
                ids = self.leaf(middle)
                if len(ids) > 1 and ids[0] == left[at] and ids[-1] == right[to - 1]:
                    return text, np.concatenate([left[:at], ids, right[to:]])
            window *= 4
        return text, self.leaf(text)

    def _cut(self, text: bytes, ids: np.ndarray, window: int, side: int) -> tuple[int, int] | None:
        """A token boundary at least `window` tokens from the join: (token number, byte offset).

        Fit are places inside a run of one character class, and those after a
        letter or digit that starts no such run: there the pre-tokeniser cuts,
        or goes on, whatever lies further off.
        """
        if side < 0:
            k = len(ids) - window
            at = len(text) - sum(map(len, self.tokens[ids[k:]]))
            while k > 0 and not _fit(text, at):
                k -= 1
                at -= len(self.tokens[ids[k]])
            return (k, at) if k > 0 else None
        k, at = window, sum(map(len, self.tokens[ids[:window]]))
        while k < len(ids) and not _fit(text, at):
            at += len(self.tokens[ids[k]])
            k += 1
        return (k, at) if k < len(ids) else None

    @staticmethod
    def _splits(text: bytes, special: bytes, start: int, stop: int) -> bool:
        """Whether an end of the window may lie inside a special token."""
        reach = len(special) - 1
        return any(special in text[max(0, x - reach) : x + reach] for x in (start, stop))


def _fit(text: bytes, at: int) -> bool:
    if not 0 < at < len(text) or text[at] & 0xC0 == 0x80:
        return False
    before = text[max(0, at - 4) : at].decode("utf-8", errors="ignore")[-1:]
    after = text[at : at + 4].decode("utf-8", errors="ignore")[:1]
    if not before or not after:
        return False
    x, y = _class(before), _class(after)
    return x == y or x in "LN"


def _class(c: str) -> str:
    kind = unicodedata.category(c)[0]
    return kind if kind in "LN" else "S" if c.isspace() and c not in "\x1c\x1d\x1e\x1f" else "P"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from U+0100."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker and file; a few MB."""
    return Codec(path)


def _encode_with(df, path, keep, fields, finish, text, leaf_chars):
    """Rows of df with what `finish` makes of (codec, texts, ids).

    Short texts stay where they are. Of the long ones each distinct text is
    cut into leaves, which are spread over all tasks; its leaves then meet for
    the joins. One text's tokens are one value of the result, so the group is
    as large as the row it makes.
    """
    work_columns = [f for f in fields]

    def whole(texts):
        own = codec(path)
        return finish(own, texts, [own.leaf(t) for t in texts])

    hidden = df.select(*(df[c] for c in keep), F.coalesce(df[text], F.lit("")).alias("_text"))
    short = common.map_texts(hidden.where(F.length("_text") <= leaf_chars), keep, work_columns, whole, text="_text")
    long = hidden.where(F.length("_text") > leaf_chars).withColumn("_hash", F.sha2("_text", 256))

    distinct = long.select("_hash", "_text").dropDuplicates(["_hash"])
    leaves = distinct.select(
        "_hash",
        F.explode(F.expr(f"""transform(sequence(0, cast((length(_text) - 1) div {leaf_chars} as int)),
            i -> struct(i as n, substring(_text, i * {leaf_chars} + 1, {leaf_chars}) as part))""")).alias("leaf"),
    ).select("_hash", "leaf.n", "leaf.part").repartition("_hash", "n")
    encoded = common.map_texts(
        leaves, ["_hash", "n", "part"], [common.field("ids", "binary")],
        lambda texts: {"ids": [codec(path).leaf(t).tobytes() for t in texts]}, text="part",
    )

    def tree(key, group):
        import pandas as pd

        own = codec(path)
        group = group.sort_values("n")
        nodes = [(p.encode(), np.frombuffer(i, dtype=np.uint32)) for p, i in zip(group["part"], group["ids"], strict=True)]
        ids = own.fold(nodes)
        made = finish(own, [b"".join(p for p, _ in nodes)], [ids])
        return pd.DataFrame({"_hash": [key[0]], **{f.name: list(made[f.name]) for f in fields}})

    schema = T.StructType([common.field("_hash", "string"), *fields])
    joined = encoded.groupBy("_hash").applyInPandas(tree, schema)
    shown = [c for c in keep if c not in {f.name for f in fields}]
    whole_long = long.select(*shown, "_hash").join(joined, "_hash").select(*shown, *(f.name for f in fields))
    return short.unionByName(whole_long)


def encode(df: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Columns `keep` and `ids`, the token numbers of the whole text.

    As the tokenizer file's library does without added special tokens; their
    strings in a text count as special tokens. A null text counts as empty
    and gives no tokens. Repeated rows stay. `path` must name a file that all
    executors have.
    """
    fields = [common.field("ids", "array<int>")]
    return _encode_with(df, path, list(keep), fields, lambda own, texts, ids: {"ids": [x.astype(np.int32) for x in ids]}, text, leaf_chars)


def decode(df: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """Columns `keep` and `decoded`, the text of the token numbers; null for null.

    Bytes that are no UTF-8 become U+FFFD, special tokens their string.
    """
    names = [c for c in keep if c != "decoded"]
    schema = T.StructType([f for f in df.schema.fields if f.name in names] + [common.field("decoded", "string")])
    order = [f.name for f in schema.fields[:-1]]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(batch.num_columns - 1).to_pylist()
            own = codec(path)
            texts = [None if x is None else own.decode(x) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*order, "decoded"])

    return df.select(*(df[c] for c in order), df[ids].cast("array<int>").alias("_ids")).mapInArrow(run, schema)


def round_trip(
    df: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text: str = "text",
    leaf_chars: int = LEAF_CHARS, with_ids: bool = False,
) -> DataFrame:
    """Columns `keep` and digests of the tokens and of the text decoded from them."""
    fields = [common.field("n_tokens", "bigint"), common.field("ids_sha256", "string"), common.field("decoded_sha256", "string")]
    fields += [common.field("ids", "array<int>")] if with_ids else []

    def finish(own: Codec, texts: list[bytes], ids: list[np.ndarray]) -> dict[str, object]:
        made = {
            "n_tokens": [len(x) for x in ids],
            "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(own.decode(x).encode()).hexdigest() for x in ids],
        }
        return made | ({"ids": [x.astype(np.int32) for x in ids]} if with_ids else {})

    return _encode_with(df, path, list(keep), fields, finish, text, leaf_chars)


Finish = Callable[[Codec, list[bytes], list[np.ndarray]], dict[str, object]]
