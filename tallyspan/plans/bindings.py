"""What the domain's tables are on the driver's star schema, as DataFrames and as the SQL of the same CTEs.

A part is a vote, a line item a member's ballot, a supplier a member and its
nation's region the group; orders are a customer's episodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators import plurality
from tallyspan.tables import table

#: A total order of line items: the key of the table is not unique.
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]

MEMBERS = """members as (select l_partkey as vote, 'G' || n_regionkey as grp, l_suppkey as member, l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice,
 case when l_tax > 0.065 then 'absent' when l_returnflag = 'A' then 'yes' when l_returnflag = 'R' then 'no' else 'abstain' end as stance
 from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
latest as (select * from members qualify row_number() over (partition by vote, member order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_partkey desc, l_extendedprice desc) = 1)"""

COUNTS = f"""{MEMBERS},
counts as (select vote, grp, count(*) filter (stance = 'yes') + case when vote % 7 = 0 then 1 else 0 end as yes, count(*) filter (stance = 'no') as no,
 count(*) filter (stance = 'abstain') as abstain, count(*) filter (stance = 'absent') as absent, min(member) as pos
 from latest where not (vote % 11 = 0 and grp = 'G2') group by vote, grp),
totals as (select vote, case when vote % 13 <> 0 then count(*) filter (stance = 'yes') end as yes, count(*) filter (stance = 'no') as no,
 count(*) filter (stance = 'abstain') as abstain, count(*) filter (stance = 'absent') as absent from latest group by vote)"""

LEADING = """case when greatest(yes, no, abstain) = 0 then null
 when (case when yes = greatest(yes, no, abstain) then 1 else 0 end) + (case when no = greatest(yes, no, abstain) then 1 else 0 end) + (case when abstain = greatest(yes, no, abstain) then 1 else 0 end) > 1 then null
 when yes >= greatest(no, abstain) then 'yes' when no >= abstain then 'no' else 'abstain' end"""

EPISODES = """episodes as (select o_orderkey, o_custkey, o_orderpriority, o_orderstatus, cast(o_orderdate as date) as start, cast(max(greatest(l_shipdate, o_orderdate)) as date) as stop
 from orders join lineitem on o_orderkey = l_orderkey group by all)"""


def members(spark, d: str) -> DataFrame:
    li, s, n = table(spark, d, "lineitem"), table(spark, d, "supplier"), table(spark, d, "nation")
    stance = F.when(F.col("l_tax") > 0.065, "absent").when(F.col("l_returnflag") == "A", "yes").when(F.col("l_returnflag") == "R", "no").otherwise("abstain")
    joined = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    grp = F.concat(F.lit("G"), F.col("n_regionkey").cast("string"))
    return joined.select(F.col("l_partkey").alias("vote"), grp.alias("grp"), F.col("l_suppkey").alias("member"), *LINE_ORDER, stance.alias("stance"))


def latest(spark, d: str) -> DataFrame:
    return plurality.latest_members(members(spark, d), "vote", "member", LINE_ORDER)


def _stances(rows: DataFrame, by: list[str], *more) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.count_if(F.col("stance") == m).alias(m) for m in plurality.MEASURES], *more)


def counts(spark, d: str, members: DataFrame | None = None) -> DataFrame:
    kept = (latest(spark, d) if members is None else members).filter(~((F.col("vote") % 11 == 0) & (F.col("grp") == "G2")))
    rows = _stances(kept, ["vote", "grp"], F.min("member").alias("pos"))
    return rows.withColumn("yes", F.col("yes") + F.when(F.col("vote") % 7 == 0, 1).otherwise(0))


def totals(spark, d: str, members: DataFrame | None = None) -> DataFrame:
    return _stances(latest(spark, d) if members is None else members, ["vote"]).withColumn("yes", F.when(F.col("vote") % 13 != 0, F.col("yes")))


def episodes(spark, d: str) -> DataFrame:
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    last = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ship"))
    joined = o.join(last, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.col("o_orderdate").cast("date").alias("start"), F.greatest("ship", "o_orderdate").cast("date").alias("stop"))


VALIDITY = """days as (select o_custkey, cast(o_orderdate as date) as valid_from, min(o_orderpriority) as label from orders group by 1, 2),
validity as (select o_custkey, label, valid_from, lead(valid_from) over (partition by o_custkey order by valid_from) as valid_until from days)"""


def validity(spark, d: str) -> DataFrame:
    """Half-open stretches of a customer between order days, labelled by priority; the last is open."""
    days = table(spark, d, "orders").groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("valid_from")).agg(F.min("o_orderpriority").alias("label"))
    return days.withColumn("valid_until", F.lead("valid_from").over(Window.partitionBy("o_custkey").orderBy("valid_from")))


def text_day(c: str):
    """A date as text, so that both engines give the same value."""
    return F.date_format(c, "yyyy-MM-dd").alias(c)
