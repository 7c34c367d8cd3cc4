"""A table whose column types grow with what is appended: types are detected in each drop and joined with those so far.

Types form a lattice: ``void`` (nothing but nulls) below ``boolean``, ``bigint`` and ``date``, ``bigint`` below ``double``,
``date`` below ``timestamp``, and ``string`` above all. A version of the table is a schema; a drop is stored under the version it
led to and never written again. Reading takes each version's drops under its own schema and casts them to the newest.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from loomstar.functions import clean

#: Each type and the types that can hold all of its values, nearest first.
ABOVE = {
    "void": ("void", "boolean", "bigint", "double", "date", "timestamp", "string"),
    "boolean": ("boolean", "string"),
    "bigint": ("bigint", "double", "string"),
    "double": ("double", "string"),
    "date": ("date", "timestamp", "string"),
    "timestamp": ("timestamp", "string"),
    "string": ("string",),
}
_DAY, _WHOLE, _TRUTH = r"^\d{4}-\d{2}-\d{2}$", r"^[+-]?\d{1,19}$", r"(?i)^(true|false)$"


def join_types(a: str, b: str) -> str:
    """The least type that holds both."""
    return next(t for t in ABOVE[a] if t in ABOVE[b])


def _tests(column: Column) -> dict[str, Column]:
    """For each type whether a text is a value of it."""
    text = clean.strip(column)
    return {
        "boolean": text.rlike(_TRUTH),
        "bigint": text.rlike(_WHOLE) & text.try_cast("bigint").isNotNull(),
        "double": clean.to_number(text).isNotNull(),
        "date": text.rlike(_DAY) & text.try_cast("date").isNotNull(),
        "timestamp": text.rlike(r"^\d{4}-\d{2}-\d{2}") & text.try_cast("timestamp").isNotNull(),
    }


def detect(rows: DataFrame) -> dict[str, str]:
    """The least type of each text column: one pass, one aggregate of a few counts per column. Blank texts are nulls."""
    counts, kinds = [], list(_tests(F.lit("")))
    for i, c in enumerate(rows.columns):
        text = F.col(f"`{c}`")
        filled = F.coalesce(clean.strip(text) != "", F.lit(False))
        counts.append(F.struct(F.count_if(filled).alias("filled"), *[F.count_if(filled & ~F.coalesce(ok, F.lit(False))).alias(k) for k, ok in _tests(text).items()]).alias(f"c{i}"))
    found = rows.agg(*counts).first()
    return {c: "void" if not found[i]["filled"] else next((k for k in kinds if not found[i][k]), "string") for i, c in enumerate(rows.columns)}


def _typed(name: str, kind: str) -> Column:
    """A text column as a value of its type; blanks are nulls, except in text columns."""
    column = F.col(f"`{name}`")
    return (column if kind == "string" else F.when(clean.strip(column) != "", clean.strip(column)).cast("string" if kind == "void" else kind)).alias(name)


class GrowingTable:
    """A table under ``root``: ``version=<n>/drop=<label>`` folders and a schema record for each version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _list(self, path: str) -> list[str]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def versions(self) -> list[dict[str, str]]:
        """{column: type} of each version, oldest first."""
        found = [n for n in self._list(f"{self.root}/schemas") if "_SUCCESS" in self._list(f"{self.root}/schemas/{n}")]
        rows = [self.spark.read.schema("at int, name string, kind string").parquet(f"{self.root}/schemas/{n}").orderBy("at").collect() for n in found]
        return [{r["name"]: r["kind"] for r in kinds} for kinds in rows]

    def append(self, rows: DataFrame, label: str, declared: Mapping[str, str] | None = None) -> dict[str, str]:
        """Store a drop of text columns and return the table's types after it.

        Types are detected unless ``declared``, which must hold what the table has: a declared type that is narrower, or a
        declared drop without one of the table's columns, is refused. Columns that a detected drop lacks are null in it; new
        ones are null in what came before. A drop stored twice under one label is there once.
        """
        versions = self.versions()
        now = versions[-1] if versions else {}
        if declared is not None:
            narrow = [c for c, t in now.items() if c not in declared or join_types(declared[c], t) != declared[c]]
            if narrow:
                raise ValueError(f"narrower than the table: {', '.join(f'{c} {declared.get(c)} for {now[c]}' for c in narrow)}")
        kinds = dict(declared) if declared is not None else detect(rows)
        after = {c: join_types(now.get(c, "void"), kinds.get(c, "void")) for c in dict.fromkeys([*now, *kinds])}
        for n, _ in enumerate(versions, 1):
            self._remove(f"{self.root}/version={n:06d}/drop={label}")
        number = len(versions)
        if after != now:
            number += 1
            table = self.spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(after.items())], "at int, name string, kind string")
            table.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/schemas/{number:06d}")
        own = rows.select(*[_typed(c, after[c]) if c in rows.columns else F.lit(None).cast("string" if t == "void" else t).alias(c) for c, t in after.items()])
        own.write.mode("overwrite").parquet(f"{self.root}/version={number:06d}/drop={label}")
        return after

    def _remove(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def read(self) -> DataFrame:
        """All drops under the newest types: one scan per version that has drops."""
        versions = self.versions()
        if not versions:
            raise ValueError(f"{self.root} has no drop yet")
        newest, parts = versions[-1], []
        for n, kinds in enumerate(versions, 1):
            path = f"{self.root}/version={n:06d}"
            drops = [d for d in self._list(path) if "_SUCCESS" in self._list(f"{path}/{d}")]
            if drops:
                schema = StructType([StructField(c, StructType.fromDDL(f"x {'string' if t == 'void' else t}")["x"].dataType) for c, t in kinds.items()])
                own = self.spark.read.schema(schema).parquet(*[f"{path}/{d}" for d in drops])
                parts.append(own.select(*[(F.col(f"`{c}`") if c in kinds else F.lit(None)).cast("string" if t == "void" else t).alias(c) for c, t in newest.items()]))
        return reduce(DataFrame.unionByName, parts)
