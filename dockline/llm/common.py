"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Bytes of text that one numpy step takes on; bounds a task's memory.
BLOCK_BYTES = 4 << 20

# ASCII white space, the separators of words (fixed values).
SPACES = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
# The same as a pattern for the JVM.
WORD = r"[^\x20\x09-\x0D]+"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column in UTF-8; a null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(texts: Sequence[bytes], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes, or of one longer row."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    fields: Sequence[T.StructField],
    work: Callable[[list[bytes]], dict[str, object]],
    text: str = "text",
    rows: Callable[[dict[str, object]], np.ndarray] | None = None,
) -> DataFrame:
    """Per row the columns `keep`, then what `work` makes of the texts.

    Work is done in Arrow batches, cut by bytes, so a batch of long texts is
    no larger than one of short texts. A kept column with the name of a new
    one gives way to it. With `rows`, only rows where it is true stay.
    """
    names = [f.name for f in fields]
    keep = [c for c in keep if c not in names]
    schema = T.StructType([f for f in df.schema.fields if f.name in keep] + list(fields))
    order = [f.name for f in df.schema.fields if f.name in keep]
    arrow = [(f.name, _arrow(f.dataType)) for f in fields]

    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column(batch.schema.names.index("_text")))
            for a, b in blocks(texts):
                made = work(texts[a:b])
                columns = [batch.column(batch.schema.names.index(c)).slice(a, b - a) for c in order]
                columns += [pa.array(made[name], type=kind) for name, kind in arrow]
                out = pa.RecordBatch.from_arrays(columns, order + names)
                if rows is not None:
                    out = out.filter(pa.array(rows(made), type=pa.bool_()))
                yield out

    chosen = df.select(*(df[c] for c in order), df[text].cast("string").alias("_text"))
    return chosen.mapInArrow(run, schema)


_KINDS = {
    "bigint": (T.LongType(), pa.int64()),
    "int": (T.IntegerType(), pa.int32()),
    "double": (T.DoubleType(), pa.float64()),
    "boolean": (T.BooleanType(), pa.bool_()),
    "string": (T.StringType(), pa.string()),
    "binary": (T.BinaryType(), pa.binary()),
    "array<int>": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "array<bigint>": (T.ArrayType(T.LongType()), pa.list_(pa.int64())),
}


def _arrow(kind: T.DataType) -> pa.DataType:
    return _KINDS[kind.simpleString()][1]


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, _KINDS[kind][0])


def word_codes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts as (text number, word code), and the distinct words."""
    import pandas as pd

    split = [t.split() for t in texts]
    sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    flat = np.empty(int(sizes.sum()), dtype=object)
    at = 0
    for words in split:
        flat[at : at + len(words)] = words
        at += len(words)
    codes, distinct = pd.factorize(flat)
    return np.repeat(np.arange(len(texts)), sizes), codes.astype(np.int64), distinct
