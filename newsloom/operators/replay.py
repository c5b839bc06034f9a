"""Replay of a relevance gate over published slates: what would have been left, and how far that can be judged.

A slate is *exact* if all of its bucket is in front of us: the bucket was no larger than the slate and every link is
found. Only exact slates live or die by their score; the others are unjudged, not dead, and only exact ones are
summed into losses. All steps are groupings of (slate, article) rows; slates are told apart by week and label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.store import stored
from newsloom.operators.topics import momentum

KEY = ["week", "label"]
# Share of the threshold within which a verdict is open, articles of a slate, what is off topic at most for each rung.
BAND, SLATE, GATE, FIRST, LOSS_FIRST, LOSS_GATE = 0.05, 30, 0.50, 0.20, 0.10, 0.30


def gated(slates: DataFrame, articles: DataFrame, cap: int = SLATE, band: float = BAND) -> DataFrame:
    """A row a slate: week, label, n_links, resolved, exact, dropped, kept, before_score, after_score, survives, borderline,
    and of what its readers labelled on and off (others are unclear): before_on, before_off, unclear, after_n, after_on, after_off.

    slates: week, label, bucket_size, links, threshold. articles: link, quality, source, day, on_topic, verdict
    (``on``, ``off`` or anything else). A null threshold is never reached.
    """
    named = slates.select(*KEY, "bucket_size", F.size("links").alias("n_links"), "threshold")
    each = slates.select(*KEY, F.posexplode("links").alias("place", "link"))
    rows = stored(each.join(articles.select("link", "quality", "source", "day", F.coalesce("on_topic", F.lit(False)).alias("on_topic"), "verdict"), "link"), "replay-rows")
    found = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("resolved"), F.count_if("on_topic").alias("kept"), *[F.count_if(F.col("verdict") == v).alias(f"before_{v}") for v in ("on", "off")])
    score = lambda df, name: momentum(df, KEY).select(*KEY, F.col("score").alias(name))
    s = named.join(found, KEY, "left").join(score(rows, "before_score"), KEY, "left").join(score(rows.where("on_topic"), "kept_score"), KEY, "left").na.fill(0, ["resolved", "kept", "before_on", "before_off", "before_score", "kept_score"])
    exact = (F.col("bucket_size") <= F.col("n_links")) & (F.col("resolved") == F.col("n_links"))
    alive = (F.col("kept") > 0) & F.coalesce(F.col("kept_score") >= F.col("threshold"), F.lit(False))
    near = (F.col("kept") > 0) & F.coalesce(F.abs(F.col("kept_score") - F.col("threshold")) <= band * F.col("threshold"), F.lit(False))
    s = s.withColumn("exact", F.coalesce(exact, F.lit(False))).withColumn("survives", F.when(F.col("exact"), alive)).withColumn("borderline", F.col("exact") & near)
    # what stands after the gate: on-topic articles, best first, unless the slate is dead
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.coalesce("quality", F.lit(0.0)).desc(), "place"))
    after = rows.where("on_topic").withColumn("_nth", nth).where(F.col("_nth") <= cap)
    after = after.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("verdict") == v).alias(v) for v in ("on", "off")])
    live = F.coalesce("survives", F.lit(True))
    left = lambda c: F.when(live, F.coalesce(c, F.lit(0))).otherwise(0)
    return s.join(after, KEY, "left").select(
        *KEY, "n_links", "resolved", "exact", (F.col("resolved") - F.col("kept")).alias("dropped"), "kept", "before_score", F.when(F.col("exact"), F.col("kept_score")).alias("after_score"), "survives", "borderline",
        "before_on", "before_off", (F.col("resolved") - F.col("before_on") - F.col("before_off")).alias("unclear"), left("n").alias("after_n"), left("on").alias("after_on"), left("off").alias("after_off"),
    )


def rung(worst: Column) -> Column:
    """ideal, first, gate, below or none by the worst share of off-topic articles."""
    return F.when(worst.isNull(), "none").when(worst == 0, "ideal").when(worst <= FIRST, "first").when(worst <= GATE, "gate").otherwise("below")


def ladder(replayed: DataFrame, recorded: DataFrame) -> DataFrame:
    """One row: the rungs (of exact slates, of all), the worst shares, what was lost and how (dead slates, or missed by the
    rule in living ones), its rung, unclear articles, slates, exact ones, and those whose recorded score is met again.

    replayed: of ``gated``; recorded: week, label, recorded_score.
    """
    r = replayed.join(recorded, KEY, "left")
    share = F.when(F.coalesce("survives", F.lit(True)) & (F.col("after_on") + F.col("after_off") > 0), F.col("after_off") / (F.col("after_on") + F.col("after_off")))
    lost = F.when(F.col("exact"), F.col("before_on") - F.col("after_on")).otherwise(0)
    s = r.agg(
        F.max(F.when(F.col("exact"), share)).alias("worst"), F.max(share).alias("worst_of_all"), F.sum(F.when(F.col("exact"), F.col("before_on")).otherwise(0)).alias("before_on"), F.sum(F.when(F.col("exact"), F.col("after_on")).otherwise(0)).alias("after_on"),
        F.sum(F.when(~F.col("survives"), lost).otherwise(0)).alias("lost_dead"), F.sum(F.when(F.col("survives"), lost).otherwise(0)).alias("lost_missed"), F.sum("unclear").alias("unclear"), F.count(F.lit(1)).alias("slates"),
        F.count_if("exact").alias("exact"), F.count_if(F.col("exact") & (F.abs(F.col("before_score") - F.col("recorded_score")) < 1e-3)).alias("faithful"), F.count_if("borderline").alias("borderline"),
    )
    loss = F.col("lost_dead") + F.col("lost_missed")
    part = F.try_divide(loss, F.col("before_on"))
    kind = F.when(part.isNull(), "none").when(loss == 0, "ideal").when((F.col("lost_dead") == 0) & (part <= LOSS_FIRST), "first").when(part <= LOSS_GATE, "gate").otherwise("below")
    return s.select(rung(F.col("worst")).alias("rung"), rung(F.col("worst_of_all")).alias("rung_of_all"), "*", part.alias("loss_share"), kind.alias("loss_rung"))
