"""The ``bouts`` contest table, derived from the driver's TPC-H-style tables.

One row per order (key ``bout_id``).  The Red side is the order's customer,
the Blue side the supplier with the smallest key among the order's lines;
orders without lines keep NULL Blue statistics (LEFT joins).

FIXED VALUES (fixture definition, shared with the SQL oracle): rank cut-offs
15 (customer within market segment) and 5 (supplier within region); Winner
NULL when key % 101 = 0, 'Draw' when key % 97 = 0, otherwise 'Red' when
c_acctbal - coalesce(s_acctbal, 0) + ((key * 7919) % 1000) * 20 - 8400 > 0;
RedStance NULL when key % 17 = 0; Gender 'FEMALE' when c_custkey % 4 = 0;
TitleBout when o_orderpriority = '1-URGENT' (5 rounds, else 3); EmptyArena
NULL when key % 7 = 0, 1 in 1998, else 0.  The i-th column of COUNTED is NULL
when key % (31 + i) = 0, else key * (2i + 7) % (41 + i) - 20 + i % 3, divided
by 4 in QUARTERED; the j-th column of RANKED is (key + j) % 15 + 1 when
(key * 3 + j) % 7 < 2, else NULL.  Three part types get names with an
apostrophe, a dot, and two spellings that differ in case.

Scale notes: the only data-sized shuffles are the lineitem aggregation (map-
side partial aggregation on ``l_orderkey``) and the equi-joins, which AQE
turns into broadcasts only when runtime sizes are small.  The two "rank within
group" columns use ``top_k_per_group``: partial top-k before the shuffle, so a
market segment holding a third of all customers never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.ordering import top_k_per_group
from duelframe.sources.tables import table

COUNTED = C.EXISTING_DIFF_COLUMNS + [
    c for pair in C.PAIRED_STATS.values() for c in pair
    if c not in ("RedAvgSigStrPct", "BlueAvgSigStrPct", "RedAvgTDPct", "BlueAvgTDPct", "RedOdds", "BlueOdds",
                 "RedWinsByDecisionSplit", "BlueWinsByDecisionSplit", "RedDraws", "BlueDraws")]
QUARTERED = ["HeightDif", "ReachDif", "SigStrDif", "RedExpectedValue", "BlueExpectedValue", "RedDecOdds",
             "BlueDecOdds", "RSubOdds", "BSubOdds", "RKOOdds", "BKOOdds"]
RANKED = [c for pair in C.RANKING_PAIRS.values() for c in pair if c not in ("RMatchWCRank", "BMatchWCRank")]

SEGMENT_RANK_CUT = 15
REGION_RANK_CUT = 5


def line_summary(lineitem: DataFrame) -> DataFrame:
    """Per order: first supplier/part, line counts by flag, max discount/tax."""
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("suppkey"),
        F.min("l_partkey").alias("partkey"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(rf == "R").alias("n_r"),
        F.count_if(rf == "A").alias("n_a"),
        F.count_if(ls == "O").alias("n_o"),
        F.count_if(ls == "F").alias("n_f"),
        F.max(F.when(rf == "R", F.col("l_discount"))).alias("disc_r"),
        F.max(F.when(rf == "A", F.col("l_discount"))).alias("disc_a"),
        F.max(F.when(ls == "O", F.col("l_tax"))).alias("tax_o"),
        F.max(F.when(ls == "F", F.col("l_tax"))).alias("tax_f"),
    )


def ranked_customers(customer: DataFrame) -> DataFrame:
    cust = customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    top = top_k_per_group(
        cust.select("c_custkey", "c_mktsegment", "c_acctbal"), ["c_mktsegment"],
        [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], SEGMENT_RANK_CUT,
        "seg_rank").select("c_custkey", "seg_rank")
    return cust.join(top, "c_custkey", "left")


def ranked_suppliers(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    sup = (supplier.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
           .join(nation.select("n_nationkey", "n_regionkey"),
                 F.col("s_nationkey") == F.col("n_nationkey"))
           .join(region.select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("s_suppkey", "s_name", "s_acctbal", "r_name"))
    top = top_k_per_group(
        sup.select("s_suppkey", "r_name", "s_acctbal"), ["r_name"],
        [F.col("s_acctbal").desc(), F.col("s_suppkey").asc()], REGION_RANK_CUT,
        "reg_rank").select("s_suppkey", "reg_rank")
    return sup.join(top, "s_suppkey", "left")


def _counted(key) -> list:
    out = []
    for i, name in enumerate(COUNTED):
        value = key * (2 * i + 7) % (41 + i) - 20 + i % 3
        value = value.cast("double") / 4 if name in QUARTERED else value
        out.append(F.when(key % (31 + i) != 0, value).alias(name))
    return out


def _ranked(key) -> list:
    return [F.when((key * 3 + j) % 7 < 2, (key + j) % 15 + 1).cast("int").alias(name) for j, name in enumerate(RANKED)]


def bouts(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    """The raw contest table (A1 shape) as a lazy plan.

    ``by_date`` sorts every partition by Date and bout_id, before the derived
    columns widen the rows: a task sorts a quarter of the bytes.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    li = line_summary(table(spark, sf_dir, "lineitem"))
    cr = ranked_customers(table(spark, sf_dir, "customer"))
    sr = ranked_suppliers(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"),
                          table(spark, sf_dir, "region"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")

    # orders join the line summary first: the summary is already partitioned
    # by order key after its aggregation, so that join adds no second shuffle.
    # Orders without lines have no supplier or part; they get a key that can't
    # match, different for each, so that no task receives all of them
    key = F.col("o_orderkey")
    j = (orders.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
         .join(cr, F.col("o_custkey") == F.col("c_custkey"), "inner")
         .join(sr, F.coalesce(F.col("suppkey"), -1 - key) == F.col("s_suppkey"), "left")
         .join(part, F.coalesce(F.col("partkey"), -1 - key) == F.col("p_partkey"), "left"))

    if by_date:
        j = j.sortWithinPartitions(F.to_date("o_orderdate"), "o_orderkey")
    edge = (F.col("c_acctbal") - F.coalesce(F.col("s_acctbal"), F.lit(0.0))
            + ((key * 7919) % 1000) * 20 - 8400)
    winner = (F.when(key % 101 == 0, F.lit(None).cast("string"))
              .when(key % 97 == 0, F.lit("Draw"))
              .when(edge > 0, F.lit("Red"))
              .otherwise(F.lit("Blue")))
    red_top = F.col("seg_rank").isNotNull()
    blue_top = F.col("reg_rank").isNotNull()
    better = (F.when(red_top & ~blue_top, F.lit("Red"))
              .when(blue_top & ~red_top, F.lit("Blue"))
              .when(red_top, F.lit("neither")))
    title = F.col("o_orderpriority") == "1-URGENT"
    odate = F.to_date(F.col("o_orderdate"))
    return j.select(
        key.alias("bout_id"),
        odate.alias("Date"),
        F.col("c_name").alias("RedFighter"),
        F.col("s_name").alias("BlueFighter"),
        winner.alias("Winner"),
        F.col("c_acctbal").alias("RedOdds"),
        F.col("s_acctbal").alias("BlueOdds"),
        F.col("disc_r").alias("RedAvgSigStrPct"),
        F.col("disc_a").alias("BlueAvgSigStrPct"),
        F.col("tax_o").alias("RedAvgTDPct"),
        F.col("tax_f").alias("BlueAvgTDPct"),
        F.col("n_r").alias("RedWinsByDecisionSplit"),
        F.col("n_a").alias("BlueWinsByDecisionSplit"),
        F.col("n_o").alias("RedDraws"),
        F.col("n_f").alias("BlueDraws"),
        F.col("seg_rank").cast("int").alias("RMatchWCRank"),
        F.col("reg_rank").cast("int").alias("BMatchWCRank"),
        F.when(key % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("RedStance"),
        F.col("r_name").alias("BlueStance"),
        F.when(F.col("p_type") == "ECONOMY", "Women's Economy").when(F.col("p_type") == "LARGE", "St. Large")
         .when((F.col("p_type") == "MEDIUM") & (key % 2 == 0), "medium").when(F.col("p_type") == "MEDIUM", "Medium")
         .otherwise(F.col("p_type")).alias("WeightClass"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit("FEMALE")).otherwise(F.lit("MALE")).alias("Gender"),
        better.alias("BetterRank"),
        title.alias("TitleBout"),
        F.when(title, F.lit(5)).otherwise(F.lit(3)).alias("NumberOfRounds"),
        F.when(key % 7 == 0, F.lit(None).cast("int"))
         .when(F.year(odate) == 1998, F.lit(1)).otherwise(F.lit(0)).alias("EmptyArena"),
        *_counted(key), *_ranked(key),
        F.col("o_orderstatus").alias("Finish"),
        F.when(key % 3 == 0, F.lit("Punch")).alias("FinishDetails"),
        F.col("n_lines").alias("FinishRound"),
        F.when(key % 4 != 0, F.concat(key % 5, F.lit(":00"))).alias("FinishRoundTime"),
        F.when(key % 9 != 0, (key % 1500).cast("double")).alias("TotalFightTimeSecs"),
    )
