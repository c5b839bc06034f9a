"""Projection, filter and classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import classify, filters
from newsloom.plans.catalog import query, table
from newsloom.plans.views import ART, AS_OF, DEFAULTS, KEYWORDS, NORM, RULES, TAXONOMY, TOK, articles, sql_category, sql_first_hit, token_sets

INCLUDE, EXCLUDE = ["tion", "eit.*und", "ción"], ["moron", "###"]


@query(f"with {ART} select id, sha256({NORM.format('title')}) as fingerprint, length(replace(title || text, ' ', ''))::int as n_chars from art")
def title_fingerprint(spark, sf):
    a = articles(spark, sf)
    return a.select("id", T.fingerprint(F.col("title")).alias("fingerprint"), T.word_count(F.col("title"), F.col("text")).alias("n_chars"))


@query(f"with {ART} select id, source from art where (regexp_matches(text, 'tion') or regexp_matches(text, 'eit.*und') or regexp_matches(text, 'ción')) and not contains(text, 'moron') and not contains(text, '###')")
def keyword_relevance(spark, sf):
    return articles(spark, sf).where(filters.relevant(F.col("text"), INCLUDE, EXCLUDE)).select("id", "source")


@query(f"with {ART} select id from art where {sql_first_hit('source', ['src1', 'SRC7'])} is null and {sql_first_hit('text', ['idiot', 'chlla'])} is null")
def substring_blocklist(spark, sf):
    a = articles(spark, sf)
    return a.where(~filters.blocked(F.col("source"), ["src1", "SRC7"]) & ~filters.blocked(F.col("text"), ["idiot", "chlla"])).select("id")


@query(rf"""with {ART}, y as (select *, list_filter(list_transform(regexp_extract_all(text, '(20\d\d)', 1), lambda x: x::int), lambda x: x between 2020 and 2025)[1] as y from art)
select id, coalesce(y < 2023, coalesce(published < timestamp '{AS_OF}' - interval 14 days, false)) and (y is null or y < 2023 or coalesce(published < timestamp '{AS_OF}' - interval 14 days, false)) or coalesce(published < timestamp '{AS_OF}' - interval 14 days, false) as stale from y""")
def stale_articles(spark, sf):
    a = articles(spark, sf)
    return a.select("id", filters.stale(F.col("text"), F.col("published"), AS_OF).alias("stale"))


@query(f"""with {ART}, f as (select *, sha256({NORM.format('title')}) as fp from art),
h as (select distinct fp from f where published < timestamp '2024-01-08')
select id, published from f where (id % 10 = 0 or fp not in (select fp from h)) and not coalesce(published::date < date '2024-01-30' - 25, false)""")
def freshness_age_gate(spark, sf):
    a = articles(spark, sf).withColumn("dedup_key", F.when(F.col("id") % 10 == 0, F.col("id")))
    history = a.where("published < timestamp_ntz '2024-01-08 00:00:00'").select(T.fingerprint(F.col("title")).alias("fingerprint"))
    return filters.fresh(a, history, F.lit(""), AS_OF, 25).select("id", "published")


@query(f"with {TOK} select id, {sql_category()} as category from tok")
def category_first_match(spark, sf):
    return token_sets(spark, sf).select("id", classify.category_of(F.col("tokens"), TAXONOMY).alias("category"))


_TAGLESS = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(title || ' ' || text, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'), '[\s\x{a0}]+', ' ', 'g'))"""


@query(rf"""with {ART}, t as (select *, {_TAGLESS} as plain from art), y as (select *, list_filter(list_transform(regexp_extract_all(plain, '(20\d\d)', 1), lambda x: x::int), lambda x: x between 2020 and 2025)[1] as y from t),
k as (select * from y where trim(title) <> '' and not (case when y is not null and y < 2023 then true else id % 5 <> 0 and coalesce(published < timestamp '{AS_OF}' - interval 14 days, false) end)
  and (coalesce(lang = 'es', false) or coalesce(source = 'src7', false) or ((regexp_matches(plain, 'tion') or regexp_matches(plain, 'eit.*und') or regexp_matches(plain, 'ción')) and not contains(plain, 'moron') and not contains(plain, '###')))),
o as (select * from k qualify row_number() over (partition by sha256({NORM.format('title')}) order by id) = 1),
c as (select id, case when contains(title, 'the') and contains(title, 'tion') then 'the+tion' end as topic from o)
select id from c where topic is null union all select id from (select *, row_number() over (partition by topic order by id) as n from c where topic is not null) where n <= 3""")
def filter_chain(spark, sf):
    """all filters of collected articles in their order."""
    a = articles(spark, sf).withColumnsRenamed({"id": "seq", "text": "summary", "lang": "content_type"})
    a = a.withColumn("lookback_days", F.when(F.col("seq") % 5 == 0, 7)).withColumn("relevance_exempt", F.col("source") == "src7")
    topic = F.when(F.contains("title", F.lit("the")) & F.contains("title", F.lit("tion")), "the+tion")
    return filters.filter_chain(a, AS_OF, INCLUDE, EXCLUDE, topic, 3, ("es",)).select(F.col("seq").alias("id"))


_SHORT = {k: v[:1] for k, v in TAXONOMY.items() if k != "english"}


@query(f"""with {TOK}, c as (select id, source, {sql_category(taxonomy=_SHORT)} as category from tok)
select id, case when category <> 'uncategorised' then category when contains(source, 'src1') then 'north' when contains(source, 'src2') then 'south' else category end as category from c""")
def source_default_category(spark, sf):
    t = token_sets(spark, sf)
    return t.select("id", classify.with_source_default(classify.category_of(F.col("tokens"), _SHORT), F.col("source"), DEFAULTS).alias("category"))


@query(f"""with {TOK}, c as (select t.id, d.text, {sql_category()} as category from tok t join documents d on d.doc_id = t.id)
select id, category,
  case category when 'english' then {sql_first_hit('text', RULES['english']['require_any'])} is not null
    when 'french' then {sql_first_hit('text', RULES['french']['exclude_any'])} is null else true end as on_topic,
  case category when 'english' then coalesce('kept:' || {sql_first_hit('text', RULES['english']['require_any'])}, 'excluded:no-require-hit')
    when 'french' then coalesce('excluded:' || {sql_first_hit('text', RULES['french']['exclude_any'])}, 'kept:no-exclude-hit')
    when 'german' then 'kept:no-rule-fields' else 'no-rule' end as reason from c""")
def relevance_partition(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", T.tokens(F.col("text")).alias("tokens"))
    d = d.select("id", F.lower("text").alias("text"), classify.category_of(F.col("tokens"), TAXONOMY).alias("category"))
    on, reason = classify.relevance(F.col("text"), F.col("category"), RULES)
    return d.select("id", "category", on.alias("on_topic"), reason.alias("reason"))


_WEIGHTS = {"src0": 0.9, "src1": 0.2}


@query(f"""with {ART} select id, round(greatest(0, least(1, least(len(list_filter({KEYWORDS}, lambda k: contains(lower(title), k))) / {len(KEYWORDS)}.0, 1.0) * 0.4
  + least(length(replace(title || ' ' || text, ' ', '')), 500) / 500.0 * 0.3 + case source when 'src0' then 0.9 when 'src1' then 0.2 else 0.5 end * 0.3)), 6)::double as score from art""")
def quality_score(spark, sf):
    weight = F.coalesce(*[F.when(F.col("source") == s, F.lit(w)) for s, w in _WEIGHTS.items()])
    score = classify.quality_score(F.col("title"), F.col("text"), KEYWORDS, weight)
    return articles(spark, sf).select("id", F.round(score, 6).alias("score"))


@query(f"""with {ART}, t as (select id, case when contains(title, 'the') and contains(title, 'tion') then 'the+tion' end as topic from art)
select id, topic from t where topic is null union all
select id, topic from (select *, row_number() over (partition by topic order by id) as n from t where topic is not null) where n <= 3""")
def topic_throttle(spark, sf):
    topic = F.when(F.contains("title", F.lit("the")) & F.contains("title", F.lit("tion")), "the+tion")
    return filters.cap_per_key(articles(spark, sf).select("id", topic.alias("topic")), "topic", ["id"], 3)


@query(r"""select page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) as host, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as title,
  len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::int as n_links,
  trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?s)<p>(.*?)</p>', 1), '<[^>]*>', ' ', 'g'),
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'), '[\s\x{a0}]+', ' ', 'g')) as lede
from pages""")
def html_title_lede(spark, sf):
    p, h = table(spark, sf, "pages"), F.col("html")
    lede = T.strip_tags(F.regexp_extract(h, r"(?s)<p>(.*?)</p>", 1))
    return p.select("page_id", T.url_host(F.col("url")).alias("host"), F.regexp_extract(h, r"(?s)<title>(.*?)</title>", 1).alias("title"), F.size(F.regexp_extract_all(h, F.lit('<a href="([^"]*)"'), F.lit(1))).alias("n_links"), lede.alias("lede"))


@query(r"""with l as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href from pages)
select href, count(*) as n_links, count(distinct page_id) as n_pages, min(page_id) as first_page from l group by href""")
def page_links(spark, sf):
    links = table(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("href"))
    return links.groupBy("href").agg(F.count(F.lit(1)).alias("n_links"), F.countDistinct("page_id").alias("n_pages"), F.min("page_id").alias("first_page"))


@query("""select event_id, (props::json ->> 'k')::varchar as k, json_type(props::json) as kind from events""")
def event_properties(spark, sf):
    v = F.try_parse_json("props")
    shape = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)  # the variant's own type
    return table(spark, sf, "events").select("event_id", F.try_variant_get(v, "$.k", "string").alias("k"), shape.alias("kind"))


_RAW = "case id % 3 when 0 then strftime(published, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(published, '%a, %d %b %Y %H:%M:%S +0000') else 'soon' end"


@query(f"with {ART} select id, case when id % 3 < 2 then strftime(published, '%Y-%m-%d %H:%M:%S') end as parsed, strftime(published + interval 8 hours, '%G-W%V') as week_id, date_trunc('week', published + interval 8 hours)::date::varchar as week_start from art")
def published_timestamps(spark, sf):
    p = F.col("published")
    raw = F.when(F.col("id") % 3 == 0, F.date_format(p, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("id") % 3 == 1, F.date_format(p, "EEE, dd MMM yyyy HH:mm:ss '+0000'")).otherwise("soon")
    parsed = T.parse_published(raw).cast("timestamp_ntz")
    return articles(spark, sf).select("id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"), T.week_id(p).alias("week_id"), T.week_start(p).cast("string").alias("week_start"))


@query("""select event_id, (event_id % 3) * 3600 + (event_id % 60) * 60 + (event_id % 59) as seconds,
  case when event_id % 2 = 0 then make_date(2024, (event_id % 12 + 1)::int, (event_id % 28 + 1)::int)::varchar end as url_day from events""")
def iso_durations_and_url_days(spark, sf):
    i = F.col("event_id")
    iso = F.format_string("PT%dH%dM%dS", i % 3, i % 60, i % 59)
    url = F.when(i % 4 == 0, F.format_string("https://x.org/2024/%d/%d/a", i % 12 + 1, i % 28 + 1)).when(i % 4 == 2, F.format_string("https://x.org/a_2024%02d%02d.html", i % 12 + 1, i % 28 + 1)).otherwise("https://x.org/a/20249999-b")
    return table(spark, sf, "events").select("event_id", T.duration_seconds(iso).alias("seconds"), T.url_date(url).cast("string").alias("url_day"))
