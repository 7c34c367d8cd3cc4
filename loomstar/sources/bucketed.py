"""Dimensions that lie in buckets of their business key, so that lookups and merges move the batch alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from loomstar.operators.lookup import lookup_key
from loomstar.operators.merge import upsert


class BucketedDim:
    """A table of the session's catalog, stored in ``buckets`` by ``keys`` and sorted within them.

    The number of buckets is the number of tasks of each join with it; choose it so that a bucket fits a task, and the same
    for tables that are joined with each other. A batch is dealt out by the same hash, in that many partitions, and the table
    is read bucket by bucket where it lies, whatever its size and whichever broadcast limit is set.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], buckets: int):
        self.spark, self.name, self.keys, self.buckets = spark, name, list(keys), buckets

    def write(self, df: DataFrame, path: str) -> None:
        """Store ``df`` as the table, at ``path``, which must be new: the version before stays readable until it is dropped."""
        dealt = df.repartition(self.buckets, *self.keys)  # one file per bucket
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # of an external table only the name goes
        dealt.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _dealt(self, batch: DataFrame, columns: Sequence[str]) -> DataFrame:
        return batch.repartition(self.buckets, *columns).hint("merge")

    def lookup(self, staging: DataFrame, key: str, on: Mapping[str, str] | None = None) -> DataFrame:
        """``staging`` with ``key`` by the business key ({staging column: dimension column}, all of it), null where it is unknown."""
        pairs = dict(on) if on else {k: k for k in self.keys}
        if sorted(pairs.values()) != sorted(self.keys):
            raise ValueError(f"a lookup must name {self.keys}")
        ordered = {s: k for k in self.keys for s, other in pairs.items() if other == k}
        return lookup_key(self._dealt(staging, list(ordered)), self.read(), key, ordered)

    def upserted(self, batch: DataFrame, set_columns: Sequence[str], batch_date: str, order: Sequence[str] = (), unique: bool = False) -> DataFrame:
        """The table after an upsert of ``batch`` by its keys: what ``merge.upsert`` gives."""
        return upsert(self.read().hint("merge"), batch, self.keys, set_columns, batch_date, order, unique, parts=self.buckets)
