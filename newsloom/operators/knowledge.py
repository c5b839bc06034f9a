"""Term bases: markers, precedence of replacements, rewriting, new terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKER = r"\[\[([^\[\]]+)\]\]"


def markers(text: Column) -> Column:
    """The distinct terms marked as [[term]]."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(MARKER), F.lit(1)))


def unknown_terms(rows: DataFrame, known: DataFrame, ignored: DataFrame) -> DataFrame:
    """rows: id, text. Marked terms that neither list holds, with their rows."""
    m = rows.select("id", F.explode(markers(F.col("text"))).alias("term"))
    return m.join(known.select("term"), "term", "left_anti").join(ignored.select("term"), "term", "left_anti")


def precedence(*levels: DataFrame) -> DataFrame:
    """Each level holds term, value; a later level overrides the ones before."""
    ranked = [df.select("term", "value", F.lit(i).alias("level")) for i, df in enumerate(levels)]
    rows = ranked[0]
    for r in ranked[1:]:
        rows = rows.unionByName(r)
    return rows.groupBy("term").agg(F.max_by("value", F.struct("level", "value")).alias("value"))


def rewrite_markers(rows: DataFrame, values: DataFrame) -> DataFrame:
    """rows: id, text. Markers become their value; those without one lose their brackets.

    Only (text's hash, place, term) of distinct texts meets the term base; what was found goes back to
    the rows by the hash and the text is cut and joined where it stands. Ids may repeat; of
    several values of a term the greatest counts; a null text stays null.
    """
    terms = F.regexp_extract_all("text", F.lit(MARKER), F.lit(1))
    keyed = rows.select("id", "text", F.md5("text").alias("_k"))
    found = keyed.select("_k", terms.alias("terms")).where(F.size("terms") > 0).distinct().select("_k", F.posexplode("terms").alias("pos", "term"))
    known = values.groupBy("term").agg(F.max("value").alias("value"))
    named = found.join(known, "term", "left").groupBy("_k").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("value", "term").alias("v")))), lambda x: x["v"]).alias("v"))
    joined = F.aggregate(F.zip_with(F.split("text", MARKER), "v", lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), F.lit(""), lambda s, x: F.concat(s, x))
    return keyed.join(named, "_k", "left").select("id", F.when(F.col("v").isNull(), F.col("text")).otherwise(joined).alias("text"))


def insert_terms(known: DataFrame, new: DataFrame, key: str = "term") -> DataFrame:
    """The term base with the new terms that it lacks; terms it has are not touched."""
    return known.unionByName(new.join(known.select(key), key, "left_anti").select(*known.columns))


def drop_verdicts(rows: DataFrame, excluded: DataFrame, key: str = "id") -> DataFrame:
    """What a same-event verdict table leaves; an empty table leaves all."""
    return rows.join(excluded.select(key).distinct(), key, "left_anti")
