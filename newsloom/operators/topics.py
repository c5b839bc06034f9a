"""Topics: momentum, signatures, novelty against earlier weeks, selection and pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def momentum(rows: DataFrame, bucket: list[str]) -> DataFrame:
    """rows: bucket columns, quality, source, day. Sum of quality x ln(sources + 1) x ln(days + 1).

    A missing quality counts 0, a missing source is one source, rows without a day count no day.
    """
    q = F.sum(F.coalesce("quality", F.lit(0.0)).cast("decimal(38,9)")).cast("double")
    sources, days = F.countDistinct(F.coalesce("source", F.lit(""))), F.countDistinct("day")
    score = q * F.ln(sources + 1.0) * F.ln(F.greatest(days, F.lit(1)) + 1.0)
    return rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("articles"), sources.alias("sources"), days.alias("days"), score.alias("score"), F.max("day").alias("latest"))


def signature(rows: DataFrame, bucket: list[str], top: int = 8) -> DataFrame:
    """rows: bucket columns, tokens. The tokens in most of the bucket's rows, ties by token."""
    df = rows.select(*bucket, F.explode("tokens").alias("token")).groupBy(*bucket, "token").agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy(*bucket).orderBy(F.col("n").desc(), "token"))
    best = df.withColumn("nth", nth).where(F.col("nth") <= top)
    return best.groupBy(*bucket).agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "token"))), lambda x: x["token"]).alias("signature"))


def passes_novelty(score: Column, latest: Column, last_score: Column, last_latest: Column, growth: float = 0.5) -> Column:
    """No earlier report, or a score grown enough with newer material."""
    return last_score.isNull() | F.coalesce((score >= last_score * (1 + growth)) & (latest > last_latest), F.lit(False))


def with_prior(buckets: DataFrame, week: str, same: list[str], topic: str, least: float) -> DataFrame:
    """buckets: week, the columns of ``same``, topic, score, latest, signature. Adds prior_week, last_score and
    last_latest of the most recent earlier week's bucket (ties: by topic) with a signature of Jaccard >= least.

    Buckets are few (weeks x topics) beside their rows; they meet in the tokens of their signatures.
    """
    old = buckets.select(*same, F.col(week).alias("prior_week"), F.col(topic).alias("prior_topic"), F.col("score").alias("last_score"), F.col("latest").alias("last_latest"), F.col("signature").alias("prior_signature"), F.explode("signature").alias("token"))
    now = buckets.select(*same, week, topic, "signature", F.explode("signature").alias("token"))
    met = now.join(old, [*same, "token"]).where(F.col("prior_week") < F.col(week))
    key = [*same, week, topic]
    near = met.groupBy(*key, "prior_week", "prior_topic").agg(F.count(F.lit(1)).alias("both"), F.first(F.size("signature") + F.size("prior_signature")).alias("sizes"), F.first(F.struct("last_score", "last_latest")).alias("last"))
    near = near.where(F.col("both") >= F.lit(least) * (F.col("sizes") - F.col("both")))
    newest = near.groupBy(*key).agg(F.max("prior_week").alias("prior_week"))
    best = near.join(newest, [*key, "prior_week"]).groupBy(*key, "prior_week").agg(F.min_by("last", "prior_topic").alias("last"))
    return buckets.join(best.select(*key, "prior_week", "last.*"), key, "left")


def merge_replies(posts: DataFrame, max_replies: int, max_chars: int) -> DataFrame:
    """posts: thread, id, time (UTC), text. thread, replies, merged, newest.

    The last ``max_replies`` by time and id; of these the newest whose blocks fit into
    ``max_chars`` (the newest always), written from old to new behind their time in Japan.
    """
    w = Window.partitionBy("thread").orderBy(F.col("time").desc(), F.col("id").desc())
    block = F.concat(F.lit("["), F.date_format(F.col("time") + F.expr("interval 9 hours"), "MM/dd HH:mm"), F.lit("] "), "text")
    r = posts.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= max_replies).withColumn("block", block)
    r = r.withColumn("upto", F.sum(F.length("block") + 1).over(w)).where((F.col("nth") == 1) | (F.col("upto") <= max_chars + 1))
    blocks = F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("nth", "block")))), lambda x: x["block"])
    return r.groupBy("thread").agg(F.count(F.lit(1)).alias("replies"), F.substring(F.array_join(blocks, "\n"), 1, max_chars).alias("merged"), F.min_by("id", "nth").alias("newest"))


def ordered_articles(reports: DataFrame, key: str, links: str, articles: DataFrame, link: str, item: str) -> DataFrame:
    """key, items (of the articles that the links find, in the links' order) and unresolved. articles has a column found."""
    each = reports.select(key, F.posexplode(links).alias("pos", link)).join(articles, link, "left")
    hit = F.when(F.col("found"), F.struct("pos", F.col(item).alias("item")))
    return each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(hit)), lambda x: x["item"]).alias("items"), F.count_if(F.col("found").isNull()).alias("unresolved"))


def allocate_seats(digests: DataFrame, hot: DataFrame, most: int, first: list, then: list) -> DataFrame:
    """name, kind (digest or hot) and seat: digests in the order ``first`` take seats, hot topics in the order ``then`` the rest.

    digests and hot hold name; at most ``most`` rows of each are ranked.
    """
    few = lambda df, order, kind: df.orderBy(*order).limit(most).select("name", F.lit(kind).alias("kind"), F.row_number().over(Window.orderBy(*order)).alias("seat"))
    d = few(digests, first, "digest")
    taken = d.agg(F.count(F.lit(1)).alias("taken"))  # one row
    h = few(hot, then, "hot").join(F.broadcast(taken)).where(F.col("seat") + F.col("taken") <= most)
    return d.unionByName(h.select("name", "kind", (F.col("seat") + F.col("taken")).cast("int").alias("seat")))


def gate_then_cap(rows: DataFrame, threshold: Column, novel: Column, limit: int, order: list) -> DataFrame:
    """First the gates, then the cap, so that repeats take no seat."""
    return rows.where((F.col("score") >= threshold) & novel).orderBy(*order).limit(limit)


def digest_pool(rows: DataFrame, group: str, floor: float, limit: int, order: list) -> DataFrame:
    """Adds effective (quality at least floor), rank and selected in each group.

    The selected rows are found by Spark's group limit, which drops rows before the
    shuffle; all others need no rank.
    """
    nth = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    best = rows.withColumn("rank", nth).where(F.col("rank") <= limit)
    return best.withColumn("effective", F.col("quality") >= floor)


def pool_shares(rows: DataFrame, group: str, by: str) -> DataFrame:
    """n of each value of ``by`` in its group, its share, and whether it leads (ties: smallest)."""
    n = rows.groupBy(group, by).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(group)
    lead = F.row_number().over(w.orderBy(F.col("n").desc(), by)) == 1
    return n.withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn("leads", lead)


def funnel(rows: DataFrame, stages: dict[str, Column], tried: DataFrame) -> DataFrame:
    """source, a count for each stage, place. rows: source, seq; tried: source, place.

    Sources that were tried come first, in their order and also without rows; the others
    follow as they first appear.
    """
    counted = rows.groupBy("source").agg(F.min("seq").alias("first"), *[F.count_if(c).alias(k) for k, c in stages.items()])
    named = tried.join(counted, "source", "full_outer")
    place = F.row_number().over(Window.orderBy(F.col("place").asc_nulls_last(), "first")).cast("long")  # one row a source
    return named.select("source", *[F.coalesce(k, F.lit(0)).alias(k) for k in stages], place.alias("place"))


def compare_counts(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """key, before, after and outcome: same, different, or unavailable where a side lacks it."""
    j = before.withColumnRenamed(value, "before").join(after.withColumnRenamed(value, "after"), key, "full_outer")
    gone = F.col("before").isNull() | F.col("after").isNull()
    return j.select(key, "before", "after", F.when(gone, "unavailable").when(F.col("before") == F.col("after"), "same").otherwise("different").alias("outcome"))


def merged_pool(rows: DataFrame, category: str, others: list[str]) -> DataFrame:
    """The rows of a digest's category and of those merged into it."""
    return rows.where(F.col("category").isin(category, *others))


def last_weeks(rows: DataFrame, week: str, n: int) -> DataFrame:
    """The rows of the newest n weeks."""
    newest = rows.select(week).distinct().orderBy(F.col(week).desc()).limit(n)
    return rows.join(newest, week, "left_semi")


def update_labels(labels: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """labels: key, label, title; edits: key, new_label, seen_title. A label changes only where the title is the one seen."""
    j = labels.join(edits, key, "left")
    return j.select(*[F.when(F.col("seen_title") == F.col("title"), F.col("new_label")).otherwise(F.col("label")).alias("label") if c == "label" else F.col(c) for c in labels.columns])
