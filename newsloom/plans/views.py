"""Articles as the queries see them, in Spark and in SQL, and the fixed parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import title_of, tokens

AS_OF = "2024-01-30 00:00:00"
TAXONOMY = {"german": ["und", "nicht", "einer"], "french": ["les", "est", "une", "que"], "spanish": ["los", "del", "por"], "english": ["the", "of", "and"]}
DEFAULTS = {"src1": "north", "": "nowhere", "src2": "south"}
RULES = {"english": {"require_any": ["idiot", "with the", "from"], "exclude_any": ["scum"]}, "french": {"exclude_any": ["avec", "pour"]}, "german": {}}
KEYWORDS = ["the", "er", "en", "tion", "que"]


def articles(spark: SparkSession, sf_dir: str, **made: Column) -> DataFrame:
    """id, title (first line), text, source, lang, published and value of an event (the one with ten times its number).

    With columns to make (of text and title), these are made where the texts are read and the texts stay there.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text", "source", "lang", title_of(F.col("text")).alias("title"))
    if made:
        docs = docs.select("id", "source", "lang", *[c.alias(k) for k, c in made.items()])
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), F.col("ts").alias("published"), "value")
    return docs.withColumn("id10", F.col("id") * 10).join(events.withColumnRenamed("id", "id10"), "id10", "left").drop("id10")


def token_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, source, lang, tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(F.col("doc_id").alias("id"), "source", "lang", tokens(F.col("text")).alias("tokens"))


#: CTE text; names: art, tok.
ART = "art as (select d.doc_id as id, d.text, d.source, d.lang, split_part(d.text, chr(10), 1) as title, e.ts as published, e.value from documents d left join events e on e.event_id = d.doc_id * 10)"
TOK = r"tok as (select doc_id as id, source, lang, list_sort(list_distinct(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: length(t) >= 2))) as tokens from documents)"
NORM = r"regexp_replace(trim(lower({})), '[^\p{{L}}\p{{N}}_]', '', 'g')"


def sql_category(tokens: str = "tokens", taxonomy=TAXONOMY) -> str:
    return "case " + " ".join(f"when list_has_any({tokens}, [{', '.join(repr(w) for w in words)}]) then '{name}'" for name, words in taxonomy.items()) + " else 'uncategorised' end"


def sql_first_hit(text: str, needles: list[str]) -> str:
    return "case " + " ".join(f"when contains(lower({text}), '{n.lower()}') then '{n}'" for n in needles) + " end" if needles else "null"
