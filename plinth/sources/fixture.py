"""``fx``: one labelled row per order, built from lineitem, orders and customer.

The roles match a house-price table: a price to predict, year/month of sale,
five area parts, four bath counts, two interaction inputs, five categoricals,
a constant column and a near copy of another column.  Train rows are those
with ``id % 5 <> 0``; the rest form the unlabelled test table.

Plan shape: lineitem is aggregated by order key (partial aggregation before
the shuffle), joined to orders on the same key and to customer on the
customer key.  No side is forced to broadcast; AQE picks a broadcast only
when the runtime size of a side is under the configured threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.sources.tables import table

ID, TARGET = "id", "sale_price"


def _sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value))


def fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q, flag, status, line = F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    per_order = li.groupBy("l_orderkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(q).alias("qty"),
        _sum_if(flag == "R", q).alias("qty_r"),
        _sum_if(flag == "A", q).alias("qty_a"),
        _sum_if(flag == "N", q).alias("qty_n"),
        _sum_if(status == "O", q).alias("qty_o"),
        _sum_if(status == "O", F.lit(1)).alias("n_o"),
        _sum_if(line == 1, F.lit(1)).alias("n1"),
        _sum_if(line == 2, F.lit(1)).alias("n2"),
        _sum_if(line == 3, F.lit(1)).alias("n3"),
        _sum_if(line == 4, F.lit(1)).alias("n4"),
        F.max(F.when(flag == "R", status)).alias("alley"),
        F.min("l_shipdate").alias("ship_lo"),
        F.max("l_shipdate").alias("ship_hi"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = (orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
              .join(customer, orders.o_custkey == customer.c_custkey))
    i = lambda c: F.col(c).cast("int")
    d = lambda c: F.col(c).cast("double")
    return joined.select(
        F.col("o_orderkey").cast("bigint").alias(ID),
        F.col("price").alias(TARGET),
        F.year("o_orderdate").cast("int").alias("yr_sold"),
        F.month("o_orderdate").cast("int").alias("mo_sold"),
        F.year("ship_lo").cast("int").alias("year_built"),
        F.year("ship_hi").cast("int").alias("year_remod"),
        d("qty_r").alias("area_bsmt"),
        d("qty_a").alias("area_1st"),
        d("qty_n").alias("area_2nd"),
        d("qty").alias("area_living"),
        d("qty_o").alias("area_garage"),
        i("n1").alias("full_bath"), i("n2").alias("half_bath"),
        i("n3").alias("bsmt_full_bath"), i("n4").alias("bsmt_half_bath"),
        i("n_lines").alias("overall_qual"),
        i("n_o").alias("garage_cars"),
        F.col("o_orderpriority").alias("zoning"),
        F.col("c_mktsegment").alias("street"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("neighborhood"),
        F.col("alley"),
        F.lit("AllPub").alias("utilities"),
        (d("qty") * 2 + 1).alias("area_living_copy"),
    )


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): test rows carry no target."""
    return split_rows(fixture(spark, sf_dir))


def split_rows(fx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) of ``fixture`` rows."""
    train = fx.filter(F.col(ID) % 5 != 0)
    test = fx.filter(F.col(ID) % 5 == 0).drop(TARGET)
    return train, test


def test_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-back targets of the test rows (for scoring submissions)."""
    return fixture(spark, sf_dir).filter(F.col(ID) % 5 == 0).select(ID, TARGET)


FX_SQL = """
WITH li AS (
  SELECT l_orderkey,
         round(sum(l_extendedprice), 2)                                  AS price,
         count(*)                                                        AS n_lines,
         sum(l_quantity)                                                 AS qty,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END)           AS qty_r,
         sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END)           AS qty_a,
         sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END)           AS qty_n,
         sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END)           AS qty_o,
         sum(CASE WHEN l_linestatus = 'O' THEN 1 END)                    AS n_o,
         sum(CASE WHEN l_linenumber = 1 THEN 1 END)                      AS n1,
         sum(CASE WHEN l_linenumber = 2 THEN 1 END)                      AS n2,
         sum(CASE WHEN l_linenumber = 3 THEN 1 END)                      AS n3,
         sum(CASE WHEN l_linenumber = 4 THEN 1 END)                      AS n4,
         max(CASE WHEN l_returnflag = 'R' THEN l_linestatus END)         AS alley,
         min(l_shipdate) AS ship_lo, max(l_shipdate) AS ship_hi
  FROM lineitem GROUP BY l_orderkey),
fx AS (
SELECT CAST(o_orderkey AS BIGINT)              AS id,
       price                                   AS sale_price,
       CAST(year(o_orderdate) AS INT)          AS yr_sold,
       CAST(month(o_orderdate) AS INT)         AS mo_sold,
       CAST(year(ship_lo) AS INT)              AS year_built,
       CAST(year(ship_hi) AS INT)              AS year_remod,
       CAST(qty_r AS DOUBLE)                   AS area_bsmt,
       CAST(qty_a AS DOUBLE)                   AS area_1st,
       CAST(qty_n AS DOUBLE)                   AS area_2nd,
       CAST(qty AS DOUBLE)                     AS area_living,
       CAST(qty_o AS DOUBLE)                   AS area_garage,
       CAST(n1 AS INT) AS full_bath, CAST(n2 AS INT) AS half_bath,
       CAST(n3 AS INT) AS bsmt_full_bath, CAST(n4 AS INT) AS bsmt_half_bath,
       CAST(n_lines AS INT)                    AS overall_qual,
       CAST(n_o AS INT)                        AS garage_cars,
       o_orderpriority                         AS zoning,
       c_mktsegment                            AS street,
       concat('N', CAST(c_nationkey AS VARCHAR(10)))  AS neighborhood,
       alley                                   AS alley,
       'AllPub'                                AS utilities,
       CAST(qty AS DOUBLE) * 2 + 1             AS area_living_copy
FROM orders JOIN li ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey),
train AS (SELECT * FROM fx WHERE id % 5 <> 0),
test AS (SELECT * EXCLUDE (sale_price) FROM fx WHERE id % 5 = 0),
truth AS (SELECT id, sale_price FROM fx WHERE id % 5 = 0)
"""
