"""Week, tag, detail, feed and report queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators.store import stored
from newsloom.plans.catalog import query, table
from newsloom.plans.views import ART, articles

_WEEK = "strftime(published + interval 8 hours, '%G-W%V')"
_RANK = "case when value >= 60 then '高' when value >= 20 or value is null then '中' else '低' end"


def _importance(v):
    return F.when(v >= 60, "高").when((v >= 20) | v.isNull(), "中").otherwise("低")


@query(f"with {ART} select {_WEEK} as week_id, count(*) as articles, count(*) filter ({_RANK} = '高') as high from art where published is not null group by 1")
def weeks_index(spark, sf):
    a = articles(spark, sf).where("published is not null")
    return a.groupBy(T.week_id(F.col("published")).alias("week_id")).agg(F.count(F.lit(1)).alias("articles"), F.count_if(_importance(F.col("value")) == "高").alias("high"))


_TAGS = r"with t as (select doc_id, lang, unnest(list_distinct(list_filter(string_split_regex(lower(split_part(text, chr(10), 1)), '[^\p{L}\p{N}]+'), lambda w: length(w) >= 2))) as tag from documents)"


def _tags(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", F.explode(T.tokens(T.title_of(F.col("text")))).alias("tag"))


@query(f"{_TAGS} select tag, count(*) as n from t group by tag")
def tag_counts(spark, sf):
    return _tags(spark, sf).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query(f"{_TAGS}, top as (select tag, count(*) as n from t group by tag order by n desc, tag limit 20) select tag from top union select * from (values ('the'), ('own')) as v(tag)")
def top_tags(spark, sf):
    """The twenty most frequent tags and the user's own."""
    top = tag_counts(spark, sf).orderBy(F.col("n").desc(), "tag").limit(20).select("tag")
    return top.union(spark.createDataFrame([("the",), ("own",)], "tag string")).distinct()


_NOISE = [("src1", 0.7), ("src5", 0.9), ("src7", None)]


@query(f"with {ART}, noise as (select * from (values ('src1', 0.7), ('src5', 0.9), ('src7', null)) as v(source, multiple)) select id, coalesce(multiple < 0.8, false) as noise, multiple::double as multiple from art left join noise using (source)")
def noise_left_join(spark, sf):
    dim = spark.createDataFrame(_NOISE, "source string, multiple double")  # a fixed list
    return articles(spark, sf).join(dim, "source", "left").select("id", F.coalesce(F.col("multiple") < 0.8, F.lit(False)).alias("noise"), "multiple")


@query(f"""with {ART}, r as (select id, {_RANK} as importance, published from art where {_WEEK} = '2024-W02' and lang = 'en' and contains(lower(title || ' ' || source || ' ' || text), 'tion'))
select id, importance, count(*) over () as total from r order by case importance when '高' then 0 when '中' then 1 else 2 end, published desc, id limit 100 offset 10""")
def week_detail_page(spark, sf):
    """A filtered week by importance and time, one page and the total."""
    a = articles(spark, sf).where((T.week_id(F.col("published")) == "2024-W02") & (F.col("lang") == "en"))
    a = a.where(F.contains(F.lower(F.concat_ws(" ", "title", "source", "text")), F.lit("tion")))
    a = stored(a.select("id", _importance(F.col("value")).alias("importance"), "published"), "week-rows")
    rank = F.when(F.col("importance") == "高", 0).when(F.col("importance") == "中", 1).otherwise(2)
    page = a.orderBy(rank, F.col("published").desc(), "id").offset(10).limit(100)
    total = a.agg(F.count(F.lit(1)).alias("total"))  # one row
    return page.select("id", "importance").join(F.broadcast(total))


@query(f"""with {ART} select id, '<item><title>' || replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</title><pubDate>' || strftime(published, '%d %b %Y %H:%M:%S +0000') || '</pubDate></item>' as item from art where published is not null order by published desc, id limit 60""")
def feed_latest(spark, sf):
    a = articles(spark, sf).where("published is not null").orderBy(F.col("published").desc(), "id").limit(60)
    return a.select("id", F.concat(F.lit("<item><title>"), T.escape_xml(F.col("title")), F.lit("</title><pubDate>"), F.date_format("published", "dd MMM yyyy HH:mm:ss '+0000'"), F.lit("</pubDate></item>")).alias("item"))


@query(f"with {ART} select {_RANK} as importance, count(*) as n from art group by 1")
def importance_counts(spark, sf):
    return articles(spark, sf).groupBy(_importance(F.col("value")).alias("importance")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with {ART} select strftime(date_trunc('week', published), '%m-%d') || ' · ' || count(*) || ' 份' as label, count(*) as n from art where published is not null group by date_trunc('week', published)")
def report_batches(spark, sf):
    g = articles(spark, sf).where("published is not null").groupBy(F.date_trunc("week", "published").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.concat(F.date_format("w", "MM-dd"), F.lit(" · "), F.col("n").cast("string"), F.lit(" 份")).alias("label"), "n")


@query(f"with {ART}, g as (select lang, count(*) as n from art group by lang) select id, lang, nth, place from (select id, lang, row_number() over (partition by lang order by published desc nulls last, id) as nth from art) join (select lang, row_number() over (order by n desc, lang) as place from g) using (lang) where nth <= 50")
def group_listing(spark, sf):
    """Groups by size, the newest fifty articles of each."""
    a = articles(spark, sf)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("published").desc_nulls_last(), "id"))
    g = a.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    g = g.select("lang", F.row_number().over(Window.orderBy(F.col("n").desc(), "lang")).alias("place"))
    return a.select("id", "lang", nth.alias("nth")).where("nth <= 50").join(g, "lang")


@query("""with h as (select unnest(['src1', 'src3']) as source), a as (select doc_id, source in (select source from h) as hidden, source = 'src5' as noise from documents)
select doc_id, case when hidden then 'hidden' when noise then 'collapsed' else 'normal' end as state from a""")
def display_state(spark, sf):
    hidden = spark.createDataFrame([("src1",), ("src3",)], "source string").withColumn("hidden", F.lit(True))
    d = table(spark, sf, "documents").select("doc_id", "source").join(hidden, "source", "left")
    return d.select("doc_id", F.when(F.col("hidden"), "hidden").when(F.col("source") == "src5", "collapsed").otherwise("normal").alias("state"))


@query(r"""with t as (select doc_id as id, regexp_replace(text, '([A-Z][a-zéü]+)', '[[\1]]', 'g') as text from documents),
m as (select distinct id, unnest(regexp_extract_all(text, '\[\[([^\[\]]+)\]\]', 1)) as term from t)
select term, count(*) as n from m where term not in ('The', 'De') and term not in (select r_name from region) group by term""")
def kb_unknown_terms(spark, sf):
    """Marked terms that the term base and the ignore list lack."""
    from newsloom.operators import knowledge as K

    known = spark.createDataFrame([("The",), ("De",)], "term string")
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.regexp_replace("text", "([A-Z][a-zéü]+)", "[[$1]]").alias("text"))
    ignored = table(spark, sf, "region").select(F.col("r_name").alias("term"))
    return K.unknown_terms(rows, known, ignored).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query(r"""select doc_id as id, md5(replace(replace(text, 'the', 'THE'), 'de ', 'of ')) as digest from documents""")
def kb_rewrite(spark, sf):
    """Markers replaced by the term base; later levels override earlier ones."""
    from newsloom.operators import knowledge as K

    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.replace(F.replace(F.col("text"), F.lit("the"), F.lit("[[the]]")), F.lit("de "), F.lit("[[de ]]")).alias("text"))
    values = K.precedence(spark.createDataFrame([("the", "x"), ("de ", "of ")], "term string, value string"), spark.createDataFrame([("the", "THE")], "term string, value string"))
    return K.rewrite_markers(rows, values).select("id", F.md5("text").alias("digest"))


@query(f"""with {ART}, p as (select id, lang, row_number() over (partition by lang order by value desc nulls last, id) as nth from art)
select lang, count(*) filter (nth <= 20) as selected, count(*) filter (nth > 20) as residual, count(*) as consumed from p group by lang""")
def digest_consume(spark, sf):
    """A digest's rows and the rest of its pool are both marked as consumed."""
    from newsloom.operators import store as K
    from newsloom.operators.topics import digest_pool

    a = articles(spark, sf).select("id", "lang", F.col("value").alias("quality")).withColumn("analysed", F.lit(False))
    best = digest_pool(a, "lang", 40, 20, [F.col("quality").desc_nulls_last(), F.col("id")]).select("id")
    rest = a.join(best, "id", "left_anti").select("id")
    done = K.mark(a, best.union(rest), "id", "analysed")
    tagged = done.join(best.withColumn("chosen", F.lit(True)), "id", "left")
    return tagged.groupBy("lang").agg(F.count_if("chosen").alias("selected"), F.count_if(F.col("chosen").isNull()).alias("residual"), F.count_if("analysed").alias("consumed"))


@query("select doc_id as id from documents where doc_id not in (select doc_id from labels where toxic = 1)")
def verdict_drop(spark, sf):
    from newsloom.operators import knowledge as K

    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return K.drop_verdicts(rows, table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("id")))


@query(f"""with {ART}, p as (select id, lang, row_number() over (partition by lang order by value desc nulls last, id) as nth from art where lang is not null)
select lang, count(*) as pool, count(*) filter (case lang when 'en' then true when 'es' then nth <= 20 else false end) as consumed from p group by lang""")
def digest_failures(spark, sf):
    """D9: what is consumed where all went well (en), the residual could not be marked (es), the report was not written (de) or not generated (fr)."""
    from newsloom.operators import store as K
    from newsloom.operators.topics import digest_pool

    a = articles(spark, sf, one=F.lit(1)).where("lang is not null").select("id", "lang", F.col("value").alias("quality"))
    best = digest_pool(a, "lang", 40, 20, [F.col("quality").desc_nulls_last(), F.col("id")]).select("lang", "id")
    outcomes = lambda rows: spark.createDataFrame(rows, "lang string, ok boolean")
    answers = spark.createDataFrame([("en", "x"), ("es", "x"), ("de", "x"), ("fr", " ")], "lang string, text string")
    used = K.consumed(a, best, answers, outcomes([("en", True), ("es", True), ("fr", True), ("de", False)]), outcomes([("en", True), ("es", False), ("de", True), ("fr", True)]), "lang", "id")
    return a.join(used.withColumn("used", F.lit(True)), ["lang", "id"], "left").groupBy("lang").agg(F.count(F.lit(1)).alias("pool"), F.count_if("used").alias("consumed"))
