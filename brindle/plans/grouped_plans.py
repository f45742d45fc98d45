"""Grouped statistics over lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import grouped as g
from brindle.plans.base import Catalog, table

catalog = Catalog()

_ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_ROW_SQL = ", ".join(_ROW)
_FLAGS = ["l_returnflag", "l_linestatus"]
_RATIO = "avg(l_quantity) OVER (PARTITION BY {k}) / nullif(stddev_samp(l_quantity) OVER (PARTITION BY {k}), 0)"


def _lineitem(spark, sf_dir, *cols):
    return table(spark, sf_dir, "lineitem").select(*_ROW, *cols)


def _rounded(df, col="normalized"):
    return df.withColumn(col, F.round(col, 6))


_BY_STATUS = f"""
SELECT {_ROW_SQL}, l_quantity, l_returnflag, l_linestatus,
       round({_RATIO.format(k='l_returnflag, l_linestatus')}, 6) AS normalized
FROM lineitem
"""
_BY_FLAG = f"""
SELECT {_ROW_SQL}, l_quantity, l_returnflag,
       round({_RATIO.format(k='l_returnflag')}, 6) AS normalized
FROM lineitem
"""


@catalog.add("normalize_group", _BY_FLAG)
def _(spark, sf_dir):
    return _rounded(g.normalize_group(_lineitem(spark, sf_dir, "l_quantity", "l_returnflag"), ["l_returnflag"], "l_quantity"))


@catalog.add("normalize_group_two_keys", _BY_STATUS)
def _(spark, sf_dir):
    return _rounded(g.normalize_group(_lineitem(spark, sf_dir, "l_quantity", *_FLAGS), _FLAGS, "l_quantity"))


@catalog.add("normalize_group_pandas", _BY_STATUS)
def _(spark, sf_dir):
    lines = _lineitem(spark, sf_dir, "l_quantity", *_FLAGS)
    return _rounded(g.normalize_group(lines, _FLAGS, "l_quantity", engine="pandas"))


@catalog.add("normalize_coarse", _BY_STATUS)
def _(spark, sf_dir):
    lines = _lineitem(spark, sf_dir, "l_quantity", *_FLAGS)
    return _rounded(g.normalize_coarse(lines, ["l_returnflag"], ["l_linestatus"], "l_quantity"))


@catalog.add(
    "normalize_fine_groups",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
               round({_RATIO.format(k='l_suppkey, l_linenumber')}, 4) AS normalized FROM lineitem""",
)
def _(spark, sf_dir):
    lines = _lineitem(spark, sf_dir, "l_quantity")
    return g.normalize_group(lines, ["l_suppkey", "l_linenumber"], "l_quantity").withColumn(
        "normalized", F.round("normalized", 4)
    )


_AVERAGE_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag,
       round((SELECT avg(l_quantity) FROM lineitem) {sign}
             avg(l_quantity) OVER (PARTITION BY l_returnflag)
             / nullif(stddev_samp(l_quantity) OVER (PARTITION BY l_returnflag), 0), 6) AS normalized
FROM lineitem
"""


@catalog.add("normalize_minus_value", _AVERAGE_SQL.format(sign="-"))
def _(spark, sf_dir):
    lines = _lineitem(spark, sf_dir, "l_quantity", "l_returnflag")
    average = g.global_average(lines, "l_quantity")
    return _rounded(g.normalize_with_value(lines, ["l_returnflag"], "l_quantity", average))


@catalog.add("normalize_plus_value_pandas", _AVERAGE_SQL.format(sign="+"))
def _(spark, sf_dir):
    lines = _lineitem(spark, sf_dir, "l_quantity", "l_returnflag")
    average = lines.agg(F.avg("l_quantity")).first()[0]  # one number, bound by closure
    return _rounded(g.normalize_with_value(lines, ["l_returnflag"], "l_quantity", average, sign=1, engine="pandas"))


@catalog.add("global_average", "SELECT round(avg(l_quantity), 6) AS average FROM lineitem")
def _(spark, sf_dir):
    lines = _lineitem(spark, sf_dir, "l_quantity")
    average = g.global_average(lines, "l_quantity")
    return spark.range(1).select(F.round(average, 6).alias("average"))  # one row, of an empty table too


_SQRT_SQL = f"SELECT {_ROW_SQL}, round(sqrt(l_extendedprice), 6) AS sqrt_reading FROM lineitem"


@catalog.add("sqrt_reading", _SQRT_SQL)
def _(spark, sf_dir):
    return _rounded(g.sqrt_reading(_lineitem(spark, sf_dir), "l_extendedprice"), "sqrt_reading")


@catalog.add("sqrt_reading_pandas", _SQRT_SQL)
def _(spark, sf_dir):
    return _rounded(g.sqrt_reading_pandas(_lineitem(spark, sf_dir), "l_extendedprice"), "sqrt_reading")


_DENORMALIZE_SQL = """
SELECT l_suppkey, 0::INTEGER AS part, md5(array_to_string(list_sort(list(l_linenumber)), ',')) AS lines_md5,
       count(*) AS entries, round(avg(l_quantity), 6) AS l_quantity, round(avg(sqrt(l_quantity)), 6) AS sqrt_reading
FROM lineitem GROUP BY l_suppkey
"""


def _readings(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity")
    return g.sqrt_reading(lines, "l_quantity")


def _list_digest(df):
    return df.select(
        "l_suppkey",
        "part",
        F.md5(F.array_join(F.col("l_linenumber").cast("array<string>"), ",")).alias("lines_md5"),
        F.size("l_linenumber").cast("long").alias("entries"),
        F.round("l_quantity", 6).alias("l_quantity"),
        F.round("sqrt_reading", 6).alias("sqrt_reading"),
    )


@catalog.add("denormalize", _DENORMALIZE_SQL)
def _(spark, sf_dir):
    return _list_digest(g.denormalize(_readings(spark, sf_dir), "l_suppkey", "l_linenumber", ["l_quantity", "sqrt_reading"]))


@catalog.add("denormalize_pandas", _DENORMALIZE_SQL)
def _(spark, sf_dir):
    return _list_digest(
        g.denormalize_pandas(_readings(spark, sf_dir), "l_suppkey", "l_linenumber", ["l_quantity", "sqrt_reading"])
    )


_RELIST_SQL = """
SELECT l_suppkey, l_linenumber,
       round(avg(l_quantity) OVER (PARTITION BY l_suppkey), 6) AS l_quantity FROM lineitem
"""


def _lists(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity")
    return g.denormalize(lines, "l_suppkey", "l_linenumber", ["l_quantity"]).drop("part")


@catalog.add("relist", _RELIST_SQL)
def _(spark, sf_dir):
    return _rounded(g.relist(_lists(spark, sf_dir), "l_linenumber"), "l_quantity")


@catalog.add("relist_pandas", _RELIST_SQL)
def _(spark, sf_dir):
    return _rounded(g.relist_pandas(_lists(spark, sf_dir), "l_linenumber"), "l_quantity")


@catalog.add(
    "group_size_stats",
    """SELECT count(*) AS row_count, count(DISTINCT (l_suppkey, l_linenumber)) AS key_count,
              round(count(*) / count(DISTINCT (l_suppkey, l_linenumber))::DOUBLE, 6) AS rows_per_key FROM lineitem""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _rounded(g.group_size_stats(lines, ["l_suppkey", "l_linenumber"]), "rows_per_key")


@catalog.add("row_count", "SELECT count(*) AS row_count FROM lineitem")
def _(spark, sf_dir):
    return g.row_count(table(spark, sf_dir, "lineitem"))


@catalog.add(
    "rmse_by_flag",
    """SELECT l_returnflag, round(sqrt(avg(pow(l_discount * 100 - l_quantity, 2))), 6) AS rmse
       FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("predicted", F.col("l_discount") * 100)
    return _rounded(g.rmse(lines, "predicted", "l_quantity", ["l_returnflag"]), "rmse")
