"""Queries of the measuring tools: funnels, counts, pools, digests, labels, tags, API pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom import api
from newsloom.functions import text as T
from newsloom.operators import topics as P
from newsloom.operators.classify import category_of
from newsloom.operators.store import stored
from newsloom.plans.catalog import query, table
from newsloom.plans.views import ART, TAXONOMY, TOK, articles, sql_category, token_sets


@query("""with c as (select source, doc_id, n_chars from documents), a as (select unnest(['src2', 'src1', 'src99']) as source, unnest([1, 2, 3]) as place),
s as (select source, min(doc_id) as first, count(*) as collected, count(*) filter (n_chars >= 500) as fresh, count(*) filter (n_chars >= 500 and doc_id % 3 <> 0) as kept, count(*) filter (n_chars >= 500 and doc_id % 3 <> 0 and source in ('src1', 'src3')) as confluence from c group by source)
select coalesce(source, '') as source, coalesce(collected, 0) as collected, coalesce(fresh, 0) as fresh, coalesce(kept, 0) as kept, coalesce(confluence, 0) as confluence, row_number() over (order by place nulls last, first) as place from a full join s using (source)""")
def funnel_attempted(spark, sf):
    """Counts after each stage: the sources that were tried, in their order and also with nothing, then the others as they came."""
    tried = spark.createDataFrame([("src2", 1), ("src1", 2), ("src99", 3)], "source string, place int")  # a fixed list
    d = table(spark, sf, "documents").select("source", F.col("doc_id").alias("seq"), (F.col("n_chars") >= 500).alias("fresh"), (F.col("doc_id") % 3 != 0).alias("new"), F.col("source").isin("src1", "src3").alias("policy"))
    stages = {"collected": F.lit(True), "fresh": F.col("fresh"), "kept": F.col("fresh") & F.col("new"), "confluence": F.col("fresh") & F.col("new") & F.col("policy")}
    return P.funnel(d, stages, tried).withColumn("source", F.coalesce("source", F.lit("")))


@query("""with b as (select l_returnflag as key, count(*) as v from lineitem where l_returnflag <> 'R' group by 1 union all select 'gone', 1),
a as (select l_returnflag as key, count(*) filter (l_quantity > case l_returnflag when 'A' then 10 else 0 end) as v from lineitem group by 1)
select key, b.v as before, a.v as after, case when b.v is null or a.v is null then 'unavailable' when b.v = a.v then 'same' else 'different' end as outcome from b full join a using (key)""")
def counts_before_after(spark, sf):
    """Counts of two runs by key: same, different, or unavailable on one side."""
    l = table(spark, sf, "lineitem")
    before = l.where("l_returnflag <> 'R'").groupBy(F.col("l_returnflag").alias("key")).agg(F.count(F.lit(1)).alias("v")).union(spark.createDataFrame([("gone", 1)], "key string, v bigint"))
    after = l.groupBy(F.col("l_returnflag").alias("key")).agg(F.count_if(F.col("l_quantity") > F.when(F.col("l_returnflag") == "A", 10).otherwise(0)).alias("v"))
    return P.compare_counts(before, after, "key", "v")


@query("select count(*) as n from documents where doc_id in (select doc_id from labels where toxic = 1)")
def exact_count_in(spark, sf):
    listed = table(spark, sf, "labels").where("toxic = 1").select("doc_id").distinct()
    return table(spark, sf, "documents").select("doc_id").join(listed, "doc_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))


_POOL = f"""{ART}, {TOK}, pool as (select art.id, art.source, value as quality, published::date as day, {sql_category()} as category from art join tok using (id)),
ranked as (select *, row_number() over (order by quality desc nulls last, id) as rank from pool where category in ('german', 'french'))"""


def _pool(spark, sf):
    a = articles(spark, sf, category=category_of(T.tokens(F.col("text")), TAXONOMY))
    return a.select("id", "source", F.col("value").alias("quality"), F.to_date("published").alias("day"), "category")


@query(f"with {_POOL} select count(*) as pool, count(*) filter (quality >= 40) as effective, least(count(*), 100) as selected, count(distinct source) as sources from ranked")
def digest_pool_counts(spark, sf):
    """The pool of a category with those merged into it: size, effective rows, selected rows, sources."""
    p = P.merged_pool(_pool(spark, sf), "german", ["french"])
    return p.agg(F.count(F.lit(1)).alias("pool"), F.count_if(F.col("quality") >= 40).alias("effective"), F.least(F.count(F.lit(1)), F.lit(100)).alias("selected"), F.count_distinct("source").alias("sources"))


@query(f"with {_POOL} select round(sum(coalesce(quality, 0)::decimal(38,9))::double, 4) as score, count(distinct coalesce(source, '')) as sources, count(distinct day) as days, max(day)::varchar as latest from ranked where rank <= 100")
def digest_row(spark, sf):
    """What a digest's row records of its selected articles."""
    best = P.merged_pool(_pool(spark, sf), "german", ["french"]).orderBy(F.col("quality").desc_nulls_last(), "id").limit(100)
    return best.agg(F.round(F.sum(F.coalesce("quality", F.lit(0.0)).cast("decimal(38,9)")).cast("double"), 4).alias("score"), F.count_distinct(F.coalesce("source", F.lit(""))).alias("sources"), F.count_distinct("day").alias("days"), F.max("day").cast("string").alias("latest"))


@query(f"""with {_POOL}, alone as (select *, row_number() over (order by quality desc nulls last, id) as rank from pool where category = 'german')
select id, round(quality, 6) as quality, category from ranked where rank <= 100 and id not in (select id from alone where rank <= 100)""")
def digest_replay(spark, sf):
    """What enters a digest when other categories are merged into its pool; both ranks read one narrow table."""
    pool = stored(_pool(spark, sf), "pool")
    top = lambda p: p.orderBy(F.col("quality").desc_nulls_last(), "id").limit(100)
    new = top(P.merged_pool(pool, "german", ["french"])).join(top(P.merged_pool(pool, "german", [])).select("id"), "id", "left_anti")
    return new.select("id", F.round("quality", 6).alias("quality"), "category")


@query("select distinct source from documents where source not in ('src1', 'src2', 'src3')")
def missing_weights(spark, sf):
    """Sources of the rows that the weight list lacks."""
    weights = spark.createDataFrame([("src1", 0.9), ("src2", 0.8), ("src3", 0.5)], "source string, weight double")
    return table(spark, sf, "documents").select("source").where("source is not null").distinct().join(weights, "source", "left_anti")


@query("select event_id from events where event_id % 3 <> 1 and event_type <> 'error'")
def week_id_rows(spark, sf):
    """Rows of real ISO weeks only."""
    e = table(spark, sf, "events").select("event_id", "event_type", F.when(F.col("event_id") % 3 != 1, T.week_id(F.col("ts"))).otherwise("2024-W5x").alias("week"))
    return e.where(T.is_week_id(F.col("week")) & (F.col("event_type") != "error")).select("event_id")


_TAGS = r"list_distinct(list_filter(string_split_regex(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: length(w) >= 2))"


@query(f"select doc_id as id, array_to_string(list_sort(list_distinct(list_concat({_TAGS.format('text')}, ['policy', 'the']))), ' ') as tags from documents where text is not null")
def tag_union(spark, sf):
    """Default and user tags with an article's own, each once, sorted."""
    own = T.tokens(F.col("text"))
    return table(spark, sf, "documents").where("text is not null").select(F.col("doc_id").alias("id"), F.array_join(F.array_sort(F.array_union(own, F.array(F.lit("policy"), F.lit("the")))), " ").alias("tags"))


@query(f"with {ART}, w as (select id, strftime(published + interval 8 hours, '%G-W%V') as week_id from art where published is not null) select id, week_id from w where week_id in (select distinct week_id from w order by week_id desc limit 3)")
def last_three_weeks(spark, sf):
    a = articles(spark, sf).where("published is not null").select("id", T.week_id(F.col("published")).alias("week_id"))
    return P.last_weeks(a, "week_id", 3)


@query(f"""with {ART}, w as (select id, title, published, lang, strftime(published + interval 8 hours, '%G-W%V') as week_id from art where published is not null), r as (select * from w where week_id in (select distinct week_id from w order by week_id desc limit 3) order by published desc, id limit 60)
select '<item><title>' || replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</title><category>' || lang || '</category><guid isPermaLink="false">' || id || '</guid></item>' as item from r""")
def feed_items(spark, sf):
    """The sixty newest articles of the last three weeks as feed items with category and guid."""
    a = articles(spark, sf).where("published is not null").withColumn("week_id", T.week_id(F.col("published")))
    best = P.last_weeks(a, "week_id", 3).orderBy(F.col("published").desc(), "id").limit(60)
    return best.select(F.concat(F.lit("<item><title>"), T.escape_xml(F.col("title")), F.lit("</title><category>"), "lang", F.lit('</category><guid isPermaLink="false">'), F.col("id").cast("string"), F.lit("</guid></item>")).alias("item"))


_API = f"""{ART}, api_ as (select id, title, source, lang as category, published, strftime(published + interval 8 hours, '%G-W%V') as week_id, case when value >= 60 then '高' when value < 20 then '低' else '中' end as importance,
  {_TAGS.format('text')} as tags, text as analysis from art)"""


@query(f"""with {_API} select id, importance, count(*) over () as total from api_ where week_id = '2024-W03' and importance = '高' and list_contains(tags, 'the') and contains(lower(concat_ws(' ', title, source, analysis, array_to_string(tags, ' '))), 'tion')
order by published desc, id limit 100""")
def api_week(spark, sf):
    """A week by importance, tag and text, as the API serves it."""
    a = articles(spark, sf)
    rows = a.select("id", "title", "source", "published", T.week_id(F.col("published")).alias("week_id"), F.when(F.col("value") >= 60, "高").when(F.col("value") < 20, "低").alias("importance"), T.tokens(F.col("text")).alias("tags"), F.col("text").alias("analysis"))
    return api.week(rows, "2024-W03", importance="高", tag="the", q="tion").select("id", "importance", "total")


@query("""with l as (select doc_id, case when toxic = 1 then 'off' when quality = 1 then 'on' else 'unclear' end as label from labels), e as (select doc_id, 'off' as label, doc_id % 4 = 0 as agrees from labels where doc_id % 2 = 0)
select l.doc_id, case when e.agrees then 'off' else l.label end as label from l left join e using (doc_id)""")
def label_update(spark, sf):
    """Labels changed only where the row still is what the editor saw (its title agrees)."""
    l = table(spark, sf, "labels").select("doc_id", F.when(F.col("toxic") == 1, "off").when(F.col("quality") == 1, "on").otherwise("unclear").alias("label"), F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("title"))
    edits = l.where("doc_id % 2 = 0").select("doc_id", F.lit("off").alias("new_label"), F.when(F.col("doc_id") % 4 == 0, F.col("title")).otherwise("changed").alias("seen_title"))
    return P.update_labels(l, edits, "doc_id").select("doc_id", "label")


@query(r"""with n as (select doc_id, l.toxic, text from documents join labels l using (doc_id)), h as (select toxic, [contains(text, 'idiot'), contains(text, 'moron'), contains(text, 'vequ'), contains(text, 'lowei')] as hits from n), w as (select unnest([1, 2, 3, 4]) as i)
select ['idiot', 'moron', 'vequ', 'lowei'][i] as word, count(*) filter (toxic = 1 and hits[i]) as caught_alone, count(*) filter (toxic = 0 and hits[i]) as false_alone from h, w group by i""")
def ablation_leave_one_in(spark, sf):
    """What each word of a rule catches on its own."""
    t = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    words = ["idiot", "moron", "vequ", "lowei"]
    r = t.select("toxic", F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.contains("text", F.lit(w)).alias("hit")) for w in words])).alias("x")).select("toxic", "x.*")
    return r.groupBy("word").agg(F.count_if(F.col("hit") & (F.col("toxic") == 1)).alias("caught_alone"), F.count_if(F.col("hit") & (F.col("toxic") == 0)).alias("false_alone"))


@query("""with g as (select coalesce(nullif(lang, 'fr'), 'uncategorised') as category, doc_id, ts from documents left join events on event_id = doc_id * 10), n as (select category, count(*) as n, min(doc_id) as first from g group by category),
r as (select category, doc_id, row_number() over (partition by category order by epoch_us(coalesce(ts, timestamp '1970-01-01')) desc, doc_id) as nth from g)
select category, row_number() over (order by category = 'uncategorised', n desc, first) as place, list(doc_id order by nth) filter (nth <= 3)::varchar as newest from n join r using (category) group by category, n, first""")
def group_order(spark, sf):
    """Groups by size with the uncategorised last, each with its newest three."""
    g = table(spark, sf, "documents").select(F.coalesce(F.nullif("lang", F.lit("fr")), F.lit("uncategorised")).alias("category"), "doc_id").join(table(spark, sf, "events").select((F.col("event_id") / 10).cast("long").alias("doc_id"), "ts", "event_id").where("event_id % 10 = 0").drop("event_id"), "doc_id", "left")
    n = g.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    nth = F.row_number().over(Window.partitionBy("category").orderBy(F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(0)).desc(), "doc_id"))
    top = g.withColumn("nth", nth).where("nth <= 3").groupBy("category").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "doc_id"))), lambda x: x["doc_id"]).alias("ids"))
    place = F.row_number().over(Window.orderBy(F.col("category") == "uncategorised", F.col("n").desc(), "first")).cast("long")
    return n.select("category", place.alias("place")).join(top, "category").select("category", "place", F.concat(F.lit("["), F.array_join(F.transform("ids", lambda i: i.cast("string")), ", "), F.lit("]")).alias("newest"))
