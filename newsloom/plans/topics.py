"""Topic scoring, novelty and pools. The bucket is (lang, source), the week that of the article."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions.text import jaccard, tokens
from newsloom.operators import topics as T
from newsloom.operators.classify import category_of
from newsloom.operators.store import stored
from newsloom.plans.catalog import query
from newsloom.plans.views import ART, TAXONOMY, TOK, articles, sql_category, token_sets

_ROWS = f"{ART}, rows_ as (select id, lang, source, published, published::date as day, value as quality from art)"
_SCORE = "sum(coalesce(quality, 0)::decimal(38,9))::double * ln(count(distinct coalesce({s}, '')) + 1.0) * ln(greatest(count(distinct day), 1) + 1.0)"


def _rows(spark, sf, **made):
    return articles(spark, sf, **(made or {"one": F.lit(1)})).select("id", "lang", "source", "published", F.to_date("published").alias("day"), F.col("value").alias("quality"), *made)


@query(f"with {_ROWS} select lang, count(*) as articles, count(distinct source) as sources, count(distinct day) as days, round({_SCORE.format(s='source')}, 4) as score, max(day)::varchar as latest from rows_ group by lang")
def topic_momentum_score(spark, sf):
    return T.momentum(_rows(spark, sf), ["lang"]).withColumn("score", F.round("score", 4)).withColumn("latest", F.col("latest").cast("string"))


_SIG = "select lang, source, list(token order by nth) as signature from (select *, row_number() over (partition by lang, source order by n desc, token) as nth from (select lang, source, token, count(*) as n from (select lang, source, unnest(tokens) as token from tok) group by all)) where nth <= 8 group by all"


@query(f"with {TOK} select lang, source, array_to_string(signature, ' ') as signature from ({_SIG})")
def topic_signature_topk(spark, sf):
    return T.signature(token_sets(spark, sf), ["lang", "source"]).withColumn("signature", F.array_join("signature", " "))


@query(f"""with {_ROWS}, {TOK}, weeks as (select *, published >= timestamp '2024-01-15' as now_ from rows_ where published is not null),
score as (select now_, lang, source, {_SCORE.format(s='id::varchar')} as score, max(day) as latest from weeks group by all),
sig as (select now_, lang, source, list(token order by nth) as signature from (select *, row_number() over (partition by now_, lang, source order by n desc, token) as nth from
  (select now_, w.lang, w.source, token, count(*) as n from (select id, unnest(tokens) as token from tok) join weeks w using (id) group by all)) where nth <= 8 group by all),
b as (select * from score join sig using (now_, lang, source)),
prior as (select x.lang, x.source, y.score as last_score, y.latest as last_latest, row_number() over (partition by x.lang, x.source order by y.score desc, y.source) as n
  from b x join b y on x.now_ and not y.now_ and x.lang = y.lang where len(list_intersect(x.signature, y.signature)) / (len(x.signature) + len(y.signature) - len(list_intersect(x.signature, y.signature))) >= 0.3),
j as (select b.*, last_score, last_latest from b left join (select * from prior where n = 1) p on b.lang = p.lang and b.source = p.source where now_)
select lang, source, round(score, 4) as score from j where score >= 20 and (last_score is null or score >= last_score * 1.2 and latest > last_latest) order by round(score, 4) desc, lang, source limit 10""")
def hot_topics_gate_then_cap(spark, sf):
    """Buckets of the later weeks that are hot and new against the most similar earlier bucket."""
    rows = _rows(spark, sf, tokens=tokens(F.col("text"))).where("published is not null").withColumn("now", F.col("published") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    key = ["now", "lang", "source"]
    score = T.momentum(rows.select(*key, F.col("id").cast("string").alias("bucket_source"), "quality", "day").select("now", "lang", F.col("source").alias("topic"), F.col("bucket_source").alias("source"), "quality", "day"), ["now", "lang", "topic"]).withColumnRenamed("topic", "source")
    b = stored(score.join(T.signature(rows, key), key), "buckets")
    now, old = b.where("now"), b.where("not now").select("lang", F.col("source").alias("s2"), F.col("score").alias("last_score"), F.col("latest").alias("last_latest"), F.col("signature").alias("sig2"))
    prior = now.join(old, "lang").where(jaccard(F.col("signature"), F.col("sig2")) >= 0.3)
    prior = prior.groupBy("lang", "source").agg(F.min_by(F.struct("last_score", "last_latest"), F.struct((-F.col("last_score")).alias("k"), F.col("s2"))).alias("p")).select("lang", "source", "p.*")
    j = now.join(prior, ["lang", "source"], "left")
    novel = T.passes_novelty(F.col("score"), F.col("latest"), F.col("last_score"), F.col("last_latest"), 0.2)
    out = T.gate_then_cap(j.withColumn("shown", F.round("score", 4)), F.lit(20.0), novel, 10, [F.col("shown").desc(), "lang", "source"])
    return out.select("lang", "source", F.col("shown").alias("score"))


_POOL = f"with {_ROWS}, r as (select *, row_number() over (partition by lang order by quality desc nulls last, id) as rank, quality >= 40 as effective from rows_)"


def _order():
    return [F.col("quality").desc_nulls_last(), F.col("id")]



@query(f"{_POOL} select lang, id, rank, effective from r where rank <= 20")
def digest_pool(spark, sf):
    return T.digest_pool(_rows(spark, sf), "lang", 40, 20, _order()).select("lang", "id", "rank", "effective")


@query(f"{_POOL} select id from r where rank > 20")
def digest_residual(spark, sf):
    rows = _rows(spark, sf)
    return rows.select("id").join(T.digest_pool(rows, "lang", 40, 20, _order()).select("id"), "id", "left_anti")


@query(f"""with {_ROWS}, c as (select id, {sql_category()} as category from tok), {TOK}, n as (select category, count(*) as n from c group by 1)
select d.category, coalesce(n, 0) as n from (select unnest(['german', 'french', 'spanish', 'english', 'dutch']) as category) d left join n using (category)""".replace("with art", "with art").replace(f", c as (select id, {sql_category()} as category from tok), {TOK}", f", {TOK}, c as (select id, {sql_category()} as category from tok)"))
def pool_composition(spark, sf):
    dim = spark.createDataFrame([(c,) for c in (*TAXONOMY, "dutch")], "category string")
    n = token_sets(spark, sf).groupBy(category_of(F.col("tokens"), TAXONOMY).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return dim.join(n, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


_SHARES = f"with {_ROWS}, n as (select lang, source, count(*) as n from rows_ group by all)"


@query(f"{_SHARES} select lang, source, n, round(n / sum(n) over (partition by lang), 6)::double as share from n")
def pool_sources(spark, sf):
    return T.pool_shares(_rows(spark, sf), "lang", "source").select("lang", "source", "n", F.round("share", 6).alias("share"))


@query(f"{_SHARES}, w as (select *, sum(n) over (partition by lang) as total, row_number() over (partition by lang order by n desc, source) as nth from n) select lang, source, n, round(n / total, 6)::double as share, (total - n)::bigint as remainder from w where nth = 1")
def pool_concentration(spark, sf):
    out = T.pool_shares(_rows(spark, sf), "lang", "source").where("leads")
    return out.select("lang", "source", "n", F.round("share", 6).alias("share"), F.round(F.col("n") / F.col("share") - F.col("n")).cast("long").alias("remainder"))


@query(f"""with {_ROWS}, e as (select lang, count(*) filter (quality >= 40) as effective from rows_ group by lang), d as (select *, row_number() over (order by effective desc, lang) as seat from e where effective >= 5)
select lang, effective, seat from d where seat <= 3""")
def digest_seats(spark, sf):
    """Triggered digests by effective count; three seats."""
    e = _rows(spark, sf).groupBy("lang").agg(F.count_if(F.col("quality") >= 40).alias("effective")).where("effective >= 5")
    from pyspark.sql import Window

    return e.withColumn("seat", F.row_number().over(Window.orderBy(F.col("effective").desc(), "lang"))).where("seat <= 3")


@query(f"""with {_ROWS}, e as (select lang as name, count(*) filter (quality >= 40) as n from rows_ group by lang), d as (select name, row_number() over (order by n desc, name) as seat from e where n >= 5 and name <> 'en'),
h as (select source as name, row_number() over (order by count(*) filter (quality >= 60) desc, source) as seat from rows_ where source is not null group by source)
select name, 'digest' as kind, seat from d where seat <= 7 union all select name, 'hot', seat + (select count(*) from d where seat <= 7) from h where seat + (select count(*) from d where seat <= 7) <= 7""")
def report_seats(spark, sf):
    """Seven seats: triggered digests by effective count, hot sources by good rows in what is left."""
    rows = _rows(spark, sf)
    digests = rows.groupBy(F.col("lang").alias("name")).agg(F.count_if(F.col("quality") >= 40).alias("n")).where("n >= 5 and name <> 'en'")
    hot = rows.where("source is not null").groupBy(F.col("source").alias("name")).agg(F.count_if(F.col("quality") >= 60).alias("n"))
    return T.allocate_seats(digests, hot, 7, [F.col("n").desc(), F.col("name")], [F.col("n").desc(), F.col("name")])


@query(f"with {_ROWS}, w as (select *, case source when 'src3' then 2.0 when 'src4' then 1.0 else 0.0 end as weight from rows_) select id, row_number() over (order by weight desc, published is null, published desc, id) as rank from w qualify rank <= 100")
def ranked_selection(spark, sf):
    """Weight desc, unknown times last, newest first; the first hundred."""
    from pyspark.sql import Window

    weight = F.when(F.col("source") == "src3", 2.0).when(F.col("source") == "src4", 1.0).otherwise(0.0)
    order = [weight.desc(), F.col("published").isNull(), F.col("published").desc(), F.col("id")]
    best = _rows(spark, sf).orderBy(*order).limit(100)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order))).select("id", "rank")
