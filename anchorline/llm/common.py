"""What several operators share: table reading, row keys, Arrow maps, a word memo."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column as this package reads it: null is the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(text: Column) -> list[Column]:
    """Two 64-bit hashes of a text. With the id they name a row without a generated id."""
    return [
        F.xxhash64(text).alias("key_a"),
        F.xxhash64(F.lit(1), text).alias("key_b"),
    ]


def give_back() -> None:
    """Return freed memory to the system: idle Python workers share executors with the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def arrow_map(
    df: DataFrame,
    schema: str | T.StructType,
    rows: Callable[[Iterator[pa.RecordBatch]], Iterable[dict[str, list | pa.Array]]],
) -> DataFrame:
    """`mapInArrow` with columns given by name; `rows` yields one dict of columns per batch."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in rows(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    columns[f.name]
                    if isinstance(columns[f.name], pa.Array)
                    else pa.array(columns[f.name], f.type)
                    for f in wanted
                ],
                schema=wanted,
            )
        give_back()

    return df.mapInArrow(run, schema)


def blocks(texts: pa.Array, size: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Index ranges of a text column of about `size` bytes each, of one row at least."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start = total = 0
    for at, n in enumerate(sizes.tolist()):
        total += n
        if total >= size:
            yield start, at + 1
            start, total = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of each text, words being what ASCII white space separates.

    Gives bounds (text i has the words bounds[i] to bounds[i + 1]), a code per word, and the
    distinct words by code.
    """
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    full = pc.binary_length(words).to_numpy() > 0
    if not full.all():
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        words = words.filter(pa.array(full))
    coded = words.dictionary_encode()
    return bounds, coded.indices.to_numpy(), coded.dictionary


class Known:
    """A 64-bit value per distinct word, remembered for the first `bound` words.

    `find` gives the values of an array of new words. Words are kept as one Arrow array, so
    millions take tens of megabytes.
    """

    def __init__(self, find: Callable[[pa.Array], np.ndarray], bound: int = 500_000):
        self.find, self.bound = find, bound
        self.words, self.values = pa.array([], pa.string()), np.array([], np.int64)

    def __call__(self, words: pa.Array) -> np.ndarray:
        place = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy()
        new = np.flatnonzero(place < 0)
        if not len(new):
            return self.values[place]
        fresh = words.take(pa.array(new))
        found = np.asarray(self.find(fresh), np.int64)
        out = np.empty(len(words), np.int64)
        out[place >= 0] = self.values[place[place >= 0]]
        out[new] = found
        room = min(len(new), self.bound - len(self.words))
        if room > 0:
            self.words = pa.concat_arrays([self.words, fresh.slice(0, room)])
            self.values = np.concatenate([self.values, found[:room]])
        return out


class Memo(dict):
    """`fill(missing key)`, remembered for at most `bound` keys.

    A full memo keeps the half that came first: frequent keys come early.
    """

    def __init__(self, fill: Callable, bound: int):
        super().__init__()
        self.fill, self.bound = fill, bound

    def __missing__(self, key):
        value = self.fill(key)
        if len(self) >= self.bound:
            for late in list(islice(self, self.bound // 2, None)):
                del self[late]
        self[key] = value
        return value
