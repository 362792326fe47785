"""Word counts over whole texts of all documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, raw_text


def word_counts(docs: DataFrame, text_col: str = "text", held_words: int = 300_000) -> DataFrame:
    """(word, n): lower-cased (A-Z) words between ASCII white space.

    A task adds up what it has read and passes it on whenever it holds
    ``held_words`` different words; Spark adds up the rest.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for block in blocks(batches, "text", 1 << 20):
            for raw in block.column("text").to_pylist():
                held.update(raw.lower().split())
            if len(held) >= held_words:
                yield passed()
                held.clear()
        if held:
            yield passed()

    return docs.select(raw_text(text_col).alias("text")).mapInArrow(tasks, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
