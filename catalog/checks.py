"""Contents held against each other, and what a table's columns are found to be."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from catalog import inputs
from catalog.registry import Tables, query
from loomstar.operators import discover, reconcile, reshape

# --- contents ----------------------------------------------------------------------------------

PLANTED_SQL = """
l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem),
r AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 83 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity
  FROM l WHERE NOT (l_orderkey % 97 = 0 AND l_linenumber = 1) AND l_orderkey % 101 <> 0
  UNION ALL SELECT * FROM l WHERE l_orderkey % 89 = 0 AND l_linenumber = 1
  UNION ALL SELECT -l_orderkey, l_linenumber, l_partkey, l_quantity FROM l WHERE l_orderkey % 79 = 0),
d AS (SELECT l_orderkey FROM (FROM l EXCEPT ALL FROM r) UNION SELECT l_orderkey FROM (FROM r EXCEPT ALL FROM l)),
n AS (
  SELECT l_orderkey, (SELECT count(*) FROM l WHERE l.l_orderkey = d.l_orderkey) AS left_rows, (SELECT count(*) FROM r WHERE r.l_orderkey = d.l_orderkey) AS right_rows FROM d)
"""


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Line items, and the same with rows lost, doubled, changed and added."""
    left = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    first = F.col("l_linenumber") == 1
    changed = left.where(~((F.col("l_orderkey") % 97 == 0) & first) & (F.col("l_orderkey") % 101 != 0))
    changed = changed.withColumn("l_quantity", F.when(F.col("l_orderkey") % 83 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    doubled, added = left.where((F.col("l_orderkey") % 89 == 0) & first), left.where("l_orderkey % 79 = 0").withColumn("l_orderkey", -F.col("l_orderkey"))
    return left, changed.unionByName(doubled).unionByName(added)


@query(
    "reconcile_keys",
    f"""WITH {PLANTED_SQL} SELECT l_orderkey, left_rows, right_rows, CASE WHEN right_rows = 0 THEN 'missing' WHEN left_rows = 0 THEN 'extra'
          WHEN left_rows <> right_rows THEN 'count' ELSE 'changed' END AS kind FROM n""",
)
def _(t: Tables) -> DataFrame:
    return reconcile.differences(*_sides(t), ["l_orderkey"])


@query(
    "reconcile_audit",
    f"""WITH {PLANTED_SQL} SELECT 'lineitem' AS table_name, (SELECT count(*) FROM l) AS left_rows, (SELECT count(*) FROM r) AS right_rows,
          (SELECT count(*) FROM n) AS different_keys, 'FAIL' AS status
        UNION ALL SELECT 'orders', count(*), count(*), 0, 'PASS' FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """One pair of tables that differs, and one whose rows only lie otherwise."""
    found = reconcile.content_audit(*_sides(t), ["l_orderkey"], "lineitem")
    orders = t.orders
    return found.unionByName(reconcile.content_audit(orders, orders.repartition("o_custkey"), ["o_orderkey"], "orders"))


# --- keys and lists ----------------------------------------------------------------------------


def _unique_sql(table: str, columns: list[str], most: int) -> str:
    """Minimal unique sets of columns, each set counted by itself."""
    sets = [s for k in range(1, most + 1) for s in combinations(columns, k)]
    counted = " UNION ALL ".join(f"SELECT {list(s)!r} AS s, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM {table})) = (SELECT count(*) FROM {table}) AS uniq" for s in sets)
    return f"""SELECT '{table}' AS table_name, array_to_string(u.s, ',') AS key_columns, len(u.s) AS size FROM ({counted}) u
      WHERE u.uniq AND NOT EXISTS (SELECT 1 FROM ({counted}) v WHERE v.uniq AND len(v.s) < len(u.s) AND list_has_all(u.s, v.s))"""


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("key_discovery", " UNION ALL ".join([_unique_sql("lineitem", LINE_COLUMNS[:6], 3), _unique_sql("orders", ORDER_COLUMNS, 3), _unique_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], 3)]))
def _(t: Tables) -> DataFrame:
    found = []
    for name, columns in (("lineitem", LINE_COLUMNS[:6]), ("orders", ORDER_COLUMNS), ("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])):
        found += [(name, ",".join(s), len(s)) for s in discover.unique_sets(getattr(t, name), columns)]
    return t.spark.createDataFrame(found, "table_name string, key_columns string, size bigint")


LISTS = ["user_id", "user_name", "review_id", "review_title", "tags"]


def _ragged(t: Tables) -> DataFrame:
    """The review extract with a packed column of its own length."""
    return inputs.review_extract(t).withColumn("tags", F.when(F.col("category") == "R", F.lit("a,b")).otherwise(F.lit("a")))


@query(
    "list_lengths",
    """WITH n AS (SELECT l_linenumber AS k, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS g FROM lineitem),
       c AS (SELECT * FROM (VALUES ('user_id', 1), ('user_name', 2), ('review_id', 3), ('review_title', 4), ('tags', 5)) AS v(name, i))
       SELECT a.name AS "left", b.name AS "right", CAST(CASE WHEN b.i = 5 THEN (SELECT min(k - g) FROM n) ELSE 0 END AS INTEGER) AS least,
         CAST(CASE WHEN b.i = 5 THEN (SELECT max(k - g) FROM n) ELSE 0 END AS INTEGER) AS greatest FROM c a JOIN c b ON a.i < b.i""",
)
def _(t: Tables) -> DataFrame:
    return discover.length_differences(_ragged(t), LISTS)


@query(
    "list_groups",
    """SELECT 'user_id,user_name,review_id,review_title' AS columns, CAST(sum(l_linenumber) AS BIGINT) AS items FROM lineitem
       UNION ALL SELECT 'tags', CAST(sum(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END) AS BIGINT) FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    """Groups of lists, and how many rows each gives when it is exploded side by side."""
    extract, out = _ragged(t), None
    for group in discover.list_groups(extract, LISTS):
        rows = reshape.explode_parallel(reshape.split_columns(extract.select(*group), group), group)
        counted = rows.agg(F.lit(",".join(group)).alias("columns"), F.count(F.lit(1)).alias("items"))
        out = counted if out is None else out.unionByName(counted)
    return out
