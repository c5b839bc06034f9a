"""Keyed tables, expiry, weekly windows and forum threads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom.operators import store as K
from newsloom.plans.catalog import query, table

_DAY = "timestamp '2024-01-{:02d}'"


def _buffer(spark, sf):
    """Events as buffered rows: value over 80 is analysed, rows expire after 14 days."""
    e = table(spark, sf, "events")
    return e.select("event_id", "user_id", "ts", (F.col("value") > 80).alias("analysed"), (F.col("ts") + F.expr("interval 14 days")).alias("expires"))


@query("select event_id from events where not (ts + interval 14 days < timestamp '2024-01-25' and not value > 80)")
def ttl_expire(spark, sf):
    return K.expire(_buffer(spark, sf), F.col("expires") < F.lit("2024-01-25").cast("timestamp_ntz"), F.col("analysed")).select("event_id")


@query("select o_orderkey, o_totalprice from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 45)")
def insert_ignore(spark, sf):
    have = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return K.insert_ignore(have, table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("""with new as (select c_custkey, round(max_by(o_totalprice, (o_orderdate, o_orderkey)), 2) as amount from customer join orders on c_custkey = o_custkey group by c_custkey)
select c_custkey, coalesce(amount, round(c_acctbal, 2)) as amount from customer left join new using (c_custkey)""")
def upsert_last_wins(spark, sf):
    """Customers' balances replaced by the amount of their latest order."""
    old = table(spark, sf, "customer").select("c_custkey", F.round("c_acctbal", 2).alias("amount"))
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")), 2).alias("amount"))
    return K.upsert(old, o.join(old.select("c_custkey"), "c_custkey", "left_semi"), ["c_custkey"])


@query("select event_id, value > 80 or user_id in (select user_id from events where event_type = 'purchase' and value > 95) as analysed from events")
def consume_flag(spark, sf):
    used = table(spark, sf, "events").where("event_type = 'purchase' and value > 95").select("user_id")
    return K.mark(_buffer(spark, sf), used, "user_id", "analysed").select("event_id", "analysed")


@query("select strftime(date_trunc('week', ts), '%Y-%m-%d') as week, event_type, count(*) as n, round(sum(value::decimal(20,6))::double, 4) as total from events group by all")
def weekly_tumbling_counts(spark, sf):
    """Weeks from Monday, 00:00 UTC: the window is shifted by four days."""
    e = table(spark, sf, "events")
    w = F.window("ts", "7 days", "7 days", "4 days")
    return e.groupBy(F.date_format(w.start, "yyyy-MM-dd").alias("week"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value").cast("decimal(20,6)")).cast("double"), 4).alias("total"))


@query("""with r as (select conv_id, turn, text, row_number() over (partition by conv_id order by turn desc) as nth, sum(length(text) + 1) over (partition by conv_id order by turn desc) as upto from conversations)
select conv_id, count(*) as replies, string_agg(case when nth = 1 then text[:2000] else text end, chr(10) order by turn desc) as merged from r where nth <= 10 and (nth = 1 or upto <= 2001) group by conv_id""")
def forum_thread_merge(spark, sf):
    """The newest ten replies of a thread, newest first, up to 2000 characters (the first always)."""
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    r = table(spark, sf, "conversations").withColumn("nth", F.row_number().over(w)).where("nth <= 10")
    r = r.withColumn("upto", F.sum(F.length("text") + 1).over(w)).where("nth = 1 or upto <= 2001")
    text = F.when(F.col("nth") == 1, F.substring("text", 1, 2000)).otherwise(F.col("text"))
    merged = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", text.alias("t")))), lambda x: x["t"]), "\n")
    return r.groupBy("conv_id").agg(F.count(F.lit(1)).alias("replies"), merged.alias("merged"))


@query("select user_id, count(*) filter (ts > timestamp '2024-01-20') as fresh, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as seen, least(count(*) filter (ts > timestamp '2024-01-20'), 50) || case when count(*) filter (ts > timestamp '2024-01-20') > 50 then '+' else '' end as badge from events group by user_id")
def new_since_seen(spark, sf):
    """What is new for each user since the last visit, as a capped badge."""
    n = F.count_if(F.col("ts") > F.lit("2024-01-20").cast("timestamp_ntz"))
    g = table(spark, sf, "events").groupBy("user_id").agg(n.alias("fresh"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("seen"))
    return g.withColumn("badge", F.concat(F.least("fresh", F.lit(50)).cast("string"), F.when(F.col("fresh") > 50, "+").otherwise("")))
