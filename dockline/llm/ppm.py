"""Language-model scores by prediction by partial matching over bytes.

The trie of byte contexts is a table of (context and next byte, count). A byte
that its longest context has not seen escapes to the next shorter one; there
the bytes that the longer context offered are excluded. Since the counts of a
context include those of all longer ones, what is excluded at every order is
known from the table alone, so each (context, byte) has one code length.

Neither the trie nor the vocabulary is sent to all tasks. Texts are packed
into blocks; a block lists the entries it needs, cut into buckets by the last
three bytes of the context, as one packed row for each bucket. A bucket adds
up what all blocks send, which is all there is on these contexts from order 3
on, and answers each block with the code lengths in the same order, not
repeating the entries. Shorter contexts have 2^24 entries at most, whatever
the corpus, and are broadcast. Words go the same way. Memory is bounded by the
block and by the number of buckets, which grows with the corpus.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm import common
from dockline.session import materialize

# Longest context in bytes, and bytes of text of one block.
ORDER = 6
BLOCK_BYTES = 8 << 20
# Bytes of a block that are looked at in one step.
PORTION_BYTES = 1 << 20

# Buckets that the contexts of a small corpus are cut into.
LEAST_BUCKETS = 16

END = b"\n"
_PACK_SCHEMA = "pid bigint, ids array<bigint>, held array<boolean>, sizes array<int>, data binary"
_ASK_SCHEMA = "pid bigint, bucket int, keys binary, counts binary"
_ANSWER_SCHEMA = "pid bigint, bucket int, data binary"
SCORE_SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
_SCORE_NAMES = [x.split()[0] for x in SCORE_SCHEMA.split(", ")]


def pack(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of normalised texts: words in lower case (A-Z), one space between, a line break at the end."""

    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId() << 32
        ids, held, parts, size = [], [], [], 0

        def block():
            data = zlib.compress(b"".join(parts), 1)
            return pd.DataFrame({"pid": [pid], "ids": [ids], "held": [held], "sizes": [[len(p) for p in parts]], "data": [data]})

        for batch in batches:
            for i, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.as_bytes(batch.column(2)), strict=True):
                parts.append(b" ".join(text.translate(common.LOWER).split()) + END)
                ids.append(i)
                held.append(h)
                size += len(parts[-1])
                if size >= block_bytes:
                    yield block()
                    pid, ids, held, parts, size = pid + 1, [], [], [], 0
        if parts:
            yield block()

    def arrow(batches):
        import pyarrow as pa

        schema = pa.schema([
            ("pid", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
            ("sizes", pa.list_(pa.int32())), ("data", pa.binary()),
        ])
        for frame in run(batches):
            yield pa.RecordBatch.from_pandas(frame, schema=schema, preserve_index=False)

    return docs.mapInArrow(arrow, _PACK_SCHEMA)


def _unpack(data: bytes, sizes) -> list[bytes]:
    plain = zlib.decompress(data)
    ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
    return [plain[e - s : e] for s, e in zip(sizes, ends, strict=True)]


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For every byte the number of (its `order` bytes before, the byte), and its text's number.

    Before a text stand line breaks.
    """
    data = np.frombuffer((END * order) + (END * order).join(texts), dtype=np.uint8)
    key = np.zeros(len(data) - order, dtype=np.int64)
    for k in range(order + 1):
        np.left_shift(key, 8, out=key)
        np.bitwise_or(key, data[k : len(data) - order + k], out=key)
    # between two texts stand the line breaks before the second
    parts = np.full(2 * len(texts) - 1, order, dtype=np.int64)
    parts[::2] = [len(t) for t in texts]
    inside = np.repeat(np.arange(len(parts)) % 2 == 0, parts)
    return key[inside], np.repeat(np.arange(len(texts), dtype=np.int32), parts[::2])


def _squeeze(values: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _expand(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def _mixed(keys: np.ndarray) -> np.ndarray:
    """A hash of small numbers."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _dealt(own: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Places of the rows of each bucket, in their order."""
    own = own.astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    by = np.argsort(own, kind="stable")
    return np.split(by, np.cumsum(np.bincount(own, minlength=buckets))[:-1])


def gram_buckets(kinds: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Places of grams, dealt out by the last three bytes of their context."""
    return _dealt(_mixed((kinds >> 8) & 0xFFFFFF) % np.uint64(buckets), buckets)


def word_codes(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, list[bytes], list[np.ndarray]]:
    """The words of all texts as codes, how many each text has, the distinct words by code, and the codes of
    each bucket's words, sorted by word. Buckets are dealt out by checksum."""
    place: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    parts = []
    for text in texts:
        split = text.split()
        parts.append(np.fromiter(map(place.__getitem__, split), np.int32, len(split)))
    words = sorted(place)
    code = np.fromiter(map(place.__getitem__, words), np.int32, len(words))
    own = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate(parts), sizes, list(place), [code[at] for at in _dealt(own, buckets)]


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where in sorted numbers each distinct one begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(ordered), 1), dtype=bool), ordered[1:] != ordered[:-1]]))


def _merged(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of sorted runs, sorted, and the place of each run's numbers among them."""
    flat = np.concatenate(runs)
    by = np.argsort(flat, kind="stable")  # which merges runs
    ordered = flat[by]
    starts = _starts(ordered)
    place = np.empty(len(flat), dtype=np.int32)
    place[by] = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(starts, append=len(flat)))
    return ordered[starts], place


def block_grams(texts: list[bytes], learn: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of a block, sorted, and their number in its training texts."""
    runs, counts = [], []
    for low, high in common.blocks(texts, PORTION_BYTES):
        key, own = grams(texts[low:high], order)
        marked = (key << 1) | learn[low:high][own]
        marked.sort()
        starts = _starts(marked >> 1)
        runs.append(marked[starts] >> 1)
        counts.append(np.add.reduceat(marked & 1, starts))
    kinds, place = _merged(runs)
    return kinds, np.bincount(place, weights=np.concatenate(counts), minlength=len(kinds)).astype(np.int32)


@dataclass
class Portion:
    """Some texts of a block: their grams, sorted, and for each occurrence, by gram, the text it is in."""

    low: int
    high: int
    kinds: np.ndarray
    repeats: np.ndarray
    own: np.ndarray

    def totals(self, length: np.ndarray) -> np.ndarray:
        """Per text the sum of its grams' lengths."""
        return np.bincount(self.own, weights=np.repeat(length, self.repeats), minlength=self.high - self.low)


def portions(texts: list[bytes], order: int) -> Iterator[Portion]:
    """The texts in portions of PORTION_BYTES and 256 texts at most: a text's number then fits beside a gram of seven bytes."""
    for start, stop in common.blocks(texts, PORTION_BYTES):
        for low in range(start, stop, 256):
            high = min(low + 256, stop)
            key, own = grams(texts[low:high], order)
            marked = (key.astype(np.uint64) << np.uint64(8)) | own.astype(np.uint64)
            marked.sort()
            key = (marked >> np.uint64(8)).astype(np.int64)
            starts = _starts(key)
            yield Portion(low, high, key[starts], np.diff(starts, append=len(key)).astype(np.int32), marked.astype(np.uint8))


def ask_grams(packs: DataFrame, buckets: int, order: int = ORDER) -> DataFrame:
    """Per block and bucket the distinct grams, as differences, with their number in training texts."""

    def run(batches):
        for row in _rows(batches):
            texts, learn = _unpack(row["data"], row["sizes"]), ~np.asarray(row["held"], dtype=bool)
            kinds, total = block_grams(texts, learn, order)
            parts = gram_buckets(kinds, buckets)
            full = [b for b in range(buckets) if len(parts[b])]
            yield _batch(
                [row["pid"]] * len(full), full, [_squeeze(np.diff(kinds[parts[b]], prepend=0)) for b in full],
                [_squeeze(total[parts[b]]) for b in full])

    return packs.mapInArrow(run, _ASK_SCHEMA)


def ask_words(packs: DataFrame, buckets: int) -> DataFrame:
    """Per block and bucket the distinct words, one a line, with their number in training texts."""

    def run(batches):
        for row in _rows(batches):
            codes, sizes, words, parts = word_codes(_unpack(row["data"], row["sizes"]), buckets)
            learn = np.repeat(~np.asarray(row["held"], dtype=bool), sizes)
            total = np.bincount(codes[learn], minlength=len(words)).astype(np.int64)
            full = [b for b in range(buckets) if len(parts[b])]
            yield _batch(
                [row["pid"]] * len(full), full, [zlib.compress(b"\n".join([words[c] for c in parts[b]]), 1) for b in full],
                [_squeeze(total[parts[b]]) for b in full])

    return packs.mapInArrow(run, _ASK_SCHEMA)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _batch(pid, bucket, *data):
    import pyarrow as pa

    names = ["pid", "bucket", "keys", "counts"] if len(data) == 2 else ["pid", "bucket", "data"]
    columns = [pa.array(pid, pa.int64()), pa.array(bucket, pa.int32()), *(pa.array(x, pa.binary()) for x in data)]
    return pa.RecordBatch.from_arrays(columns, names)


def word_counts(table):
    """The training counts of a bucket's words for each block that asked, and the bucket's sum and number of kinds as block -1."""
    import pandas as pd
    import pyarrow as pa

    lists = [zlib.decompress(x.as_py()).split(b"\n") for x in table.column("keys")]
    sizes = [len(x) for x in lists]
    flat = np.empty(sum(sizes), dtype=object)
    flat[:] = [w for x in lists for w in x]
    place, kinds = pd.factorize(flat)
    own = np.concatenate([_expand(x.as_py(), np.int64) for x in table.column("counts")])
    total = np.bincount(place, weights=own, minlength=len(kinds)).astype(np.int64)
    answers = [_squeeze(x) for x in np.split(total[place], np.cumsum(sizes)[:-1])]
    answers.append(_squeeze(np.array([total.sum(), np.count_nonzero(total)], dtype=np.int64)))
    bucket = table.column("bucket")[0].as_py()
    pids = [*table.column("pid").to_pylist(), -1]
    return pa.Table.from_batches([_batch(pids, [bucket] * len(pids), answers)])


def gram_lengths(table, order: int, short: Short):
    """The code lengths of a bucket's grams for each block that asked."""
    import pyarrow as pa

    asked = [np.cumsum(_expand(x.as_py(), np.int64)) for x in table.column("keys")]
    own = np.concatenate([_expand(x.as_py(), np.int32) for x in table.column("counts")])
    kinds, place = _merged(asked)
    length = code_lengths(kinds, np.bincount(place, weights=own, minlength=len(kinds)), short, order).astype(np.float32)
    answers = [_squeeze(x) for x in np.split(length[place], np.cumsum([len(x) for x in asked])[:-1])]
    bucket = table.column("bucket")[0].as_py()
    return pa.Table.from_batches([_batch(table.column("pid").to_pylist(), [bucket] * len(answers), answers)])


@dataclass
class Short:
    """Training counts of all next bytes after contexts of two bytes at most."""

    keys: np.ndarray  # two bytes and the next one, sorted
    counts: np.ndarray

    def __post_init__(self):
        # by order: the counts of (context, byte), and per context their sum and number
        self.seen, self.sums, self.kinds = [], [], []
        for order in range(3):
            key = self.keys & ((1 << (8 * (order + 1))) - 1)
            if order < 2:
                seen = np.bincount(key, weights=self.counts, minlength=1 << (8 * (order + 1)))
                self.seen.append(seen)
                self.sums.append(seen.reshape(-1, 256).sum(1))
                self.kinds.append((seen > 0).reshape(-1, 256).sum(1))
            else:
                self.sums.append(np.bincount(key >> 8, weights=self.counts, minlength=1 << 16))
                self.kinds.append(np.bincount(key >> 8, minlength=1 << 16))
        # what the bytes seen after a context have together after the next shorter one
        one = np.bincount(self.keys >> 8, weights=self.seen[1][self.keys & 0xFFFF], minlength=1 << 16)
        zero = ((self.seen[1] > 0).reshape(-1, 256) * self.seen[0]).sum(1)
        self.shadow = [np.zeros(1), zero, one]

    def count(self, order: int, key: np.ndarray) -> np.ndarray:
        """Counts of (context of this order, byte)."""
        if order < 2:
            return self.seen[order][key]
        if not len(self.keys):
            return np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.counts[at], 0).astype(np.float64)


def short_counts(packs: DataFrame) -> Short:
    """Counts of three bytes in a row in the training texts: 2^24 numbers at most."""

    def run(batches):
        import pyarrow as pa

        for row in _rows(batches):
            texts, learn = _unpack(row["data"], row["sizes"]), ~np.asarray(row["held"], dtype=bool)
            kinds, total = block_grams(texts, learn, 2)
            kinds, total = kinds[total > 0], total[total > 0]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), pa.array(total, pa.int64())], ["gram", "n"])

    found = packs.mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toPandas().sort_values("gram")
    return Short(found["gram"].to_numpy(dtype=np.int64), found["n"].to_numpy(dtype=np.int64))


def code_lengths(gram: np.ndarray, n: np.ndarray, short: Short, order: int = ORDER) -> np.ndarray:
    """log10 probabilities of grams; with a gram, all of the same last three context bytes are given.

    `gram` is sorted and distinct, `n` are their counts, 0 for those of
    held-out texts only. Escapes are estimated by method D: each distinct byte
    gives half a count to the escape.
    """
    symbol = gram & 0xFF
    out = np.zeros(len(gram))
    open_ = np.ones(len(gram), dtype=bool)  # not yet predicted
    gone, gone_kinds = np.zeros(len(gram)), np.zeros(len(gram))  # bytes excluded: their sum at this order, and how many
    tables = _context_tables(gram, n, order)
    for k in range(order, -1, -1):
        if k > 2:
            keys, place, count, own, total, kinds, _ = tables[k]
            seen, sums, distinct = count[place], total[own[place]], kinds[own[place]]
            below = tables[k - 1][2][tables[k - 1][6]] if k > 3 else short.count(2, keys & 0xFFFFFF)
            shadow = np.bincount(own, weights=np.where(count > 0, below, 0))[own[place]]
        else:
            context = (gram >> 8) & ((1 << (8 * k)) - 1)
            seen = short.count(k, (context << 8) | symbol)
            sums, distinct, shadow = short.sums[k][context], short.kinds[k][context].astype(np.float64), short.shadow[k][context]
        left, left_kinds = sums - gone, distinct - gone_kinds
        known = open_ & (left_kinds > 0)
        whole = np.maximum(2 * left, 1e-300)
        hit = known & (seen > 0)
        out[hit] += np.log10((2 * seen[hit] - 1) / whole[hit])
        miss = known & (seen <= 0)
        out[miss] += np.log10(left_kinds[miss] / whole[miss])
        open_ &= ~hit
        # having passed a seen context, its bytes are excluded below; an unseen one excludes nothing
        visited = distinct > 0
        gone, gone_kinds = np.where(visited, shadow, 0.0), np.where(visited, distinct, 0.0)
    rest = max(256 - np.count_nonzero(short.seen[0]), 1)
    out[open_] -= np.log10(rest)
    return out


def _context_tables(gram: np.ndarray, n: np.ndarray, order: int) -> dict[int, tuple]:
    """For every order down to 3: distinct (context, byte), each gram's place among them, their counts, the
    number of their context, per context sums and kinds, and the places of the next longer ones among them."""
    tables, keys, place, count = {}, gram, np.arange(len(gram)), n
    for k in range(order, 2, -1):
        longer = None
        if k < order:
            keys, longer = np.unique(keys & ((1 << (8 * (k + 1))) - 1), return_inverse=True)
            place, count = longer[place], np.bincount(longer, weights=count)
        own = np.cumsum(np.diff(keys >> 8, prepend=keys[:1] >> 8) != 0)
        tables[k] = keys, place, count, own, np.bincount(own, weights=count), np.bincount(own, weights=count > 0), longer
    return tables


def score(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `held_out` is a boolean column; texts where it is not true are learnt from.
    `score` is the log10 probability of the text with its words in lower case
    (A-Z) and one space between them, and of its end; `base_score` that of its
    tokens by smoothed frequency. A null text counts as empty and is its end
    alone. Repeated rows count and stay.
    """
    base = docs.select(
        docs[doc_id].cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"),
        docs[text].cast("string").alias("text"),
    )
    packs = materialize(pack(base, block_bytes), "packs")
    size, texts = packs.agg(
        F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)),
        F.sum(F.aggregate(F.zip_with("ids", "held", lambda i, h: h), F.lit(0).cast("bigint"), lambda a, h: a + (~h).cast("bigint"))),
    ).first()
    # fewer than blocks, as entries repeat; so neither buckets nor packed rows become many and small
    buckets = LEAST_BUCKETS + int(((size or 0) / block_bytes) ** 0.75)
    short = docs.sparkSession.sparkContext.broadcast(short_counts(packs))
    counted = ask_words(packs, buckets).groupBy("bucket").applyInArrow(word_counts, _ANSWER_SCHEMA)
    counted = materialize(counted, "words")
    ends = texts or 0
    n, v = ends, int(ends > 0)
    for row in counted.where("pid = -1").select("data").toLocalIterator():
        own_n, own_v = _expand(row.data, np.int64)
        n, v = n + int(own_n), v + int(own_v)
    priced = ask_grams(packs, buckets, order).groupBy("bucket").applyInArrow(
        lambda table: gram_lengths(table, order, short.value), _ANSWER_SCHEMA)
    answers = counted.where("pid >= 0").withColumn("bucket", -1 - F.col("bucket")).unionByName(priced)

    def finish(key, left, right):
        import pyarrow as pa

        answer = dict(zip(right.column("bucket").to_pylist(), right.column("data"), strict=True))
        out = []
        for row in _rows(left.to_batches()):
            texts = _unpack(row["data"], row["sizes"])
            codes, sizes, words, parts = word_codes(texts, buckets)
            c = np.zeros(len(words))
            for b, part in enumerate(parts):
                if len(part):
                    c[part] = _expand(answer[-1 - b].as_py(), np.int64)
            price, own = np.log10((c + 0.5) / (n + 0.5 * (v + 1))), np.repeat(np.arange(len(texts)), sizes)
            # each text has its end besides
            n_tokens = sizes + 1
            n_known = np.bincount(own, weights=c[codes] > 0, minlength=len(texts)).astype(np.int64) + (ends > 0)
            base_score = np.bincount(own, weights=price[codes], minlength=len(texts)) + np.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
            del codes, words, own
            pieces = list(portions(texts, order))
            kinds, at = _merged([piece.kinds for piece in pieces])
            length = np.zeros(len(kinds))
            for b, part in enumerate(gram_buckets(kinds, buckets)):
                if len(part):
                    length[part] = _expand(answer[b].as_py(), np.float32)
            length, total, used = length[at], np.zeros(len(texts)), 0
            for piece in pieces:
                total[piece.low : piece.high] = piece.totals(length[used : used + len(piece.kinds)])
                used += len(piece.kinds)
            out.append(pa.table([
                pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()), n_tokens, n_known, base_score, total,
            ], names=_SCORE_NAMES))
        return pa.concat_tables(out)

    scored = packs.groupBy("pid").cogroup(answers.groupBy("pid")).applyInArrow(finish, SCORE_SCHEMA)
    return scored.withColumn("train_tokens", F.lit(int(n)).cast("bigint"))
