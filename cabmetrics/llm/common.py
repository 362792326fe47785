"""Small helpers shared by the operators."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmetrics.session import scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back.

    Cuts the lineage: what follows survives the loss of an executor without
    computing ``df`` again.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def looked_up(rows: DataFrame, table: DataFrame, key: str, total: int, share: int = 1000) -> DataFrame:
    """The rows with the columns of ``table``, which has one row for each key and the number of its rows, ``held``.

    Keys that hold more than one in ``share`` of the ``total`` rows are fewer
    than ``share``: these are broadcast, so that no task gets all rows of one.
    ``rows`` are read twice.
    """
    hot = F.broadcast(table.filter(F.col("held") * share > total))
    others = rows.join(hot.select(key), key, "left_anti").join(table.filter(F.col("held") * share <= total), key)
    return rows.join(hot, key).select(*rows.columns, *(c for c in table.columns if c not in (key, "held"))).unionByName(
        others.select(*rows.columns, *(c for c in table.columns if c not in (key, "held")))
    )


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    return F.translate(text, _UPPER, _UPPER.lower())


def raw_text(text: str | Column) -> Column:
    """UTF-8 bytes of a text, null as empty: the form in which Python tasks take it."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def blocks(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, done + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words_of(texts: pa.Array) -> tuple[pa.BinaryArray, np.ndarray]:
    """Lower-cased (A-Z) words between ASCII white space of texts (UTF-8 bytes, none null), and each text's number of them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    ends = lists.offsets.to_numpy()
    words = lists.values.slice(ends[0], ends[-1] - ends[0]).view(pa.binary())
    # white space at an end of a text leaves an empty word
    filled = pc.greater(pc.binary_length(words), 0)
    upto = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])[ends - ends[0]]
    if upto[-1] < len(words):
        words = words.filter(filled)
    return words, np.diff(upto)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit integers (wrapping)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class WordHash(dict):
    """64-bit hash of a word, remembered; forgets all beyond ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def kept(name: str, make):
    """A value made once in the life of a Python worker: later tasks of the same worker find it again.

    Functions reach a worker by value, so their modules' globals do not last
    from task to task; a module of the worker's own does.
    """
    import sys
    import types

    held = sys.modules.setdefault("kept_by_worker", types.ModuleType("kept_by_worker")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def sent(spark: SparkSession, value):
    """Broadcast of a bounded value with its class, which executors need not have installed."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast):
    return pickle.loads(broadcast.value)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
