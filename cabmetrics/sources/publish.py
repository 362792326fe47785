"""Sinks that can run again.

* ``replace_partitions``: only the partitions that the new rows touch are
  replaced, each as a whole; a run with fewer rows leaves no stale file.
* ``Published``: versions of a table or model behind a small list. A writer
  fills a folder of its own and then adds one entry to the list; the entry's
  name is its number and it is created only if no one else has, so of two
  writers one takes the next number. A reader resolves the list once and reads
  one complete version, whatever is written meanwhile.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import _hadoop


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> str:
    """Writes ``df`` into a partitioned table, replacing exactly the partitions it has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return path


@dataclass(frozen=True)
class Published:
    """A named place with numbered versions, from 1."""

    spark: SparkSession
    root: str

    def _list(self) -> dict[int, str]:
        fs, jpath = _hadoop(self.spark, f"{self.root}/versions")
        if not fs.exists(jpath):
            return {}
        names = [f.getPath().getName() for f in fs.listStatus(jpath)]
        # an entry's name is "<number>.<folder>": the list is read without opening its entries
        return {int(n.split(".", 1)[0]): n.split(".", 1)[1] for n in names if n[:1].isdigit()}

    def versions(self) -> list[int]:
        return sorted(self._list())

    def path(self, version: int | None = None) -> str:
        """Folder of a version, the latest one if none is named."""
        entries = self._list()
        if not entries:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return f"{self.root}/{entries[max(entries) if version is None else version]}"

    def publish(self, write: Callable[[str], object], attempts: int = 100) -> int:
        """Runs ``write`` with a fresh folder and makes it the latest version; returns its number.

        A write that fails publishes nothing; what it left is no version.
        """
        folder = f"data-{uuid.uuid4().hex}"
        write(f"{self.root}/{folder}")
        start = max(self._list(), default=0) + 1
        for number in range(start, start + attempts):  # a number that another writer has taken is passed over
            if self._claim(number):
                fs, entry = _hadoop(self.spark, f"{self.root}/versions/{number}.{folder}")
                fs.create(entry, False).close()
                return number
        raise RuntimeError(f"no version number could be taken under {self.root}")

    def _claim(self, number: int) -> bool:
        """Whether this writer got the number: a file of that name can be made once."""
        fs, jpath = _hadoop(self.spark, f"{self.root}/claims/{number}")
        try:
            fs.create(jpath, False).close()
        except Exception as e:
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        return True

    def write_table(self, df: DataFrame) -> int:
        return self.publish(lambda path: df.write.parquet(path))

    def read_table(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.path(version))
