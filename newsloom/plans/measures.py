"""Funnels, uptake, input quality, label ladders, drift and small statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import replay
from newsloom.operators.classify import category_of
from newsloom.operators.ranks import at_places
from newsloom.operators.store import stored
from newsloom.plans.catalog import query, table
from newsloom.plans.views import ART, KEYWORDS, NORM, TAXONOMY, TOK, articles, sql_category

_FIRST = f"(select min(doc_id) as first_id, md5({NORM.format('text')}) as key from documents group by key)"


@query(f"""with {TOK}, k as (select doc_id as id, source, text, md5({NORM.format('text')}) as key from documents), f as {_FIRST},
s as (select k.source, length(split_part(text, chr(10), 1)) > 0 as titled, regexp_matches(text, 'tion|und|ción') and not contains(text, '###') as relevant, id = first_id as first, {sql_category()} <> 'uncategorised' as known
  from k join f using (key) join tok using (id))
select source, count(*) as n, count(*) filter (titled) as titled, count(*) filter (titled and relevant) as relevant, count(*) filter (titled and relevant and first) as unique_, count(*) filter (titled and relevant and first and known) as categorised from s group by source""")
def source_funnel(spark, sf):
    """Documents of each source that survive every stage in turn.

    One scan writes the narrow rows (flags and key); the first id of each key is an
    aggregate of these, joined back to them.
    """
    d = table(spark, sf, "documents").select("source", F.col("doc_id").alias("id"), "text", T.normalised(F.col("text")).alias("norm"), T.tokens(F.col("text")).alias("tokens"))
    rows = stored(d.select(
        "source", "id", F.md5("norm").alias("key"), (F.length(T.title_of(F.col("text"))) > 0).alias("titled"),
        (F.col("text").rlike("tion|und|ción") & ~F.contains("text", F.lit("###"))).alias("relevant"), (category_of(F.col("tokens"), TAXONOMY) != "uncategorised").alias("known"),
    ), "funnel-rows")
    s = rows.join(rows.groupBy("key").agg(F.min("id").alias("first_id")), "key")
    stages = {"titled": F.col("titled")}
    stages["relevant"] = stages["titled"] & F.col("relevant")
    stages["unique_"] = stages["relevant"] & (F.col("id") == F.col("first_id"))
    stages["categorised"] = stages["unique_"] & F.col("known")
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in stages.items()])


_UP = "u as (select d.source, e.ts, l.quality = 1 as analysed from documents d join labels l using (doc_id) join events e on e.event_id = d.doc_id * 10)"


def _uptake(spark, sf):
    d, l, e = (table(spark, sf, t) for t in ("documents", "labels", "events"))
    u = d.select("doc_id", "source").join(l.select("doc_id", (F.col("quality") == 1).alias("analysed")), "doc_id")
    return u.withColumn("event_id", F.col("doc_id") * 10).join(e.select("event_id", "ts"), "event_id")


@query(f"with {_UP}, b as (select avg(analysed::int) as base from u) select source, count(*) as n, round(avg(analysed::int), 6) as uptake, round(avg(analysed::int) / any_value(base), 6) as multiple from u, b group by source")
def source_uptake(spark, sf):
    u = _uptake(spark, sf)
    s = u.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("analysed").cast("int")).alias("used"), F.count("analysed").alias("known"))
    base = s.agg((F.sum("used") / F.sum("known")).alias("base"))  # one row, of the sources' sums
    up = F.col("used") / F.col("known")
    return s.join(F.broadcast(base)).select("source", "n", F.round(up, 6).alias("uptake"), F.round(F.try_divide(up, F.col("base")), 6).alias("multiple"))


@query(f"with {_UP}, b as (select avg(analysed::int) as base from u), s as (select source, count(*) as n, avg(analysed::int) / any_value(base) as multiple from u, b group by source) select source, n, round(multiple, 4) as multiple, multiple < 0.95 as noise from s where n >= 15 and source not in ('src0')")
def uptake_config(spark, sf):
    s = source_uptake(spark, sf).where("n >= 15 and source <> 'src0'")
    return s.select("source", "n", F.round("multiple", 4).alias("multiple"), (F.col("multiple") < 0.95).alias("noise"))


@query(f"with {_UP}, w as (select strftime(ts + interval 8 hours, '%G-W%V') as week_id, count(*) as n, count(*) filter (analysed) as analysed from u group by 1) select week_id, n, analysed from w where analysed < n and week_id < (select max(week_id) from w)")
def uptake_window(spark, sf):
    """Complete weeks that were not analysed whole."""
    w = _uptake(spark, sf).groupBy(T.week_id(F.col("ts")).alias("week_id")).agg(F.count(F.lit(1)).alias("n"), F.count_if("analysed").alias("analysed"))
    last = w.agg(F.max("week_id").alias("last"))  # one row
    return w.join(F.broadcast(last)).where((F.col("analysed") < F.col("n")) & (F.col("week_id") < F.col("last"))).drop("last")


_ECHO = r"""regexp_replace(lower(coalesce({}, '')), '[^\p{{L}}\p{{N}}]+', '', 'g')"""
_QUALITY = f"""q as (select source, lang, case when length(text) = 0 then 'absent'
  when length({_ECHO.format('text')}) <= length({_ECHO.format('title')}) + 24 and contains({_ECHO.format('text')}, {_ECHO.format('title')}) then 'title_echo'
  when length(text) < 300 then 'thin' else 'substantive' end as class from art)"""


def _quality_class():
    text, title = F.col("text"), F.col("title")
    return F.when(F.length(text) == 0, "absent").when(T.is_echo(title, text), "title_echo").when(F.length(text) < 300, "thin").otherwise("substantive")


@query(f"with {ART}, {_QUALITY} select class, count(*) as n from q group by class")
def title_echo_classes(spark, sf):
    return articles(spark, sf).groupBy(_quality_class().alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with {ART}, {_QUALITY} select coalesce(source, '') as source, coalesce(lang, '') as lang, grouping(source)::int as all_sources, count(*) as n, count(*) filter (class <> 'substantive') as poor, round(count(*) filter (class <> 'substantive') / count(*), 6)::double as share from q group by grouping sets ((), (source), (lang))")
def input_quality_rollup(spark, sf):
    rows = articles(spark, sf).select("source", "lang", (_quality_class() != "substantive").alias("poor"))
    g = rows.groupingSets([[], [F.col("source")], [F.col("lang")]], "source", "lang")
    out = g.agg(F.grouping("source").cast("int").alias("all_sources"), F.count(F.lit(1)).alias("n"), F.count_if("poor").alias("poor"))
    return out.select(F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), "all_sources", "n", "poor", F.round(F.col("poor") / F.col("n"), 6).alias("share"))


@query(r"""with p as (select page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) as host, regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1) as footer from pages)
select host, footer, count(distinct page_id) as n from p where footer <> '' group by all having count(distinct page_id) >= 2""")
def boilerplate_keys(spark, sf):
    """Footers that several pages of a host share."""
    p = table(spark, sf, "pages").select("page_id", T.url_host(F.col("url")).alias("host"), F.regexp_extract("html", r"(?s)<footer>(.*?)</footer>", 1).alias("footer"))
    return p.where("footer <> ''").groupBy("host", "footer").agg(F.countDistinct("page_id").alias("n")).where("n >= 2")


@query(f"""with l as (select doc_id, case when toxic = 1 then 'off' when quality = 1 then 'on' else 'unclear' end as label from labels),
t as (select d.doc_id, d.lang, label, not (contains(text, 'idiot') or contains(text, 'vequ') or contains(text, 'lowei') or contains(text, 'chlla')) as kept from documents d left join l using (doc_id))
select lang, coalesce(label, 'untouched') as label, count(*) as n, count(*) filter (kept) as kept, round(count(*) filter (kept) / count(*), 6)::double as share from t group by all""")
def label_ladder(spark, sf):
    """How many labelled documents of each kind a rule keeps."""
    l = table(spark, sf, "labels").select("doc_id", F.when(F.col("toxic") == 1, "off").when(F.col("quality") == 1, "on").otherwise("unclear").alias("label"))
    d = table(spark, sf, "documents").select("doc_id", "lang", (~F.col("text").rlike("idiot|vequ|lowei|chlla")).alias("kept"))
    g = d.join(l, "doc_id", "left").groupBy("lang", F.coalesce("label", F.lit("untouched")).alias("label"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept"), F.round(F.count_if("kept") / F.count(F.lit(1)), 6).alias("share"))


_WORDS = ["idiot", "moron", "vequ", "lowei"]


@query("with t as (select text, toxic from documents join labels using (doc_id)), h as (select toxic, [" + ", ".join(f"contains(text, '{w}')" for w in _WORDS) + "] as hits from t), n as (select *, len(list_filter(hits, lambda x: x)) as k from h), w as (select unnest([1, 2, 3, 4]) as i), r as (select i, toxic, hits[i] as hit, k from n, w) select " + str(_WORDS) + "[i] as word, count(*) filter (hit) as hits, count(*) filter (hit and k = 1) as solo, count(*) filter (toxic = 1 and k - hit::int > 0) as caught_without, count(*) filter (toxic = 0 and k - hit::int > 0) as false_without from r group by i")
def ablation_leave_one_out(spark, sf):
    """Each word's hits alone and what the rule catches without it; one pass over the texts."""
    t = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    hits = [F.contains("text", F.lit(w)) for w in _WORDS]
    t = t.select("toxic", *[h.alias(f"h{i}") for i, h in enumerate(hits)])
    k = sum((F.col(f"h{i}").cast("int") for i in range(len(_WORDS))), F.lit(0))
    r = t.select("toxic", k.alias("k"), F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"h{i}").alias("hit")) for i, w in enumerate(_WORDS)])).alias("x")).select("toxic", "k", "x.*")
    rest = F.col("k") - F.col("hit").cast("int") > 0
    return r.groupBy("word").agg(F.count_if("hit").alias("hits"), F.count_if(F.col("hit") & (F.col("k") == 1)).alias("solo"), F.count_if((F.col("toxic") == 1) & rest).alias("caught_without"), F.count_if((F.col("toxic") == 0) & rest).alias("false_without"))


@query("""with c as (select event_type, round(value, 6) as v, count(*) as k from events group by all), r as (select *, sum(k) over (partition by event_type order by v) as upto, sum(k) over (partition by event_type) as n from c),
a as (select event_type, n, min(v) filter (upto >= greatest(1, floor(n * 0.95)::int)) as p95, min(v) filter (upto >= n // 2 + 1) as upper_median, max(v) as most from r group by all)
select event_type, n::bigint as n, p95, upper_median, most from a""")
def p95_index_stat(spark, sf):
    """The value at the 95 % place and the upper median; no group is sorted whole."""
    n = F.col("n")
    out = at_places(table(spark, sf, "events").select("event_type", F.round("value", 6).alias("v")), "event_type", "v", {"p95": F.greatest(F.lit(1), F.floor(n * F.lit(0.95))), "upper_median": F.floor(n / 2) + 1, "most": n})
    return out.select("event_type", "n", "p95", "upper_median", "most")


@query("""select event_type, round(median(round(value, 6)), 6) as median, max(round(value, 6)) as most, count(*) filter (value > 50) as slow from events group by event_type""")
def median_stat(spark, sf):
    """The median (of two middle values their mean), the largest and how many are over 50."""
    e = table(spark, sf, "events").select("event_type", F.round("value", 6).alias("v"), "value")
    n = F.col("n")
    mid = at_places(e, "event_type", "v", {"low": F.floor((n + 1) / 2), "high": F.floor(n / 2) + 1, "most": n})
    slow = e.groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("slow"))
    return mid.join(slow, "event_type").select("event_type", F.round((F.col("low") + F.col("high")) / 2, 6).alias("median"), "most", "slow")


@query("""with a as (select n_nationkey || '.' || k as path, v from (select n_nationkey, unnest(['name', 'region']) as k, unnest([n_name, n_regionkey::varchar]) as v from nation)),
b as (select n_nationkey || '.' || k as path, v from (select n_nationkey, unnest(['name', 'region', 'extra']) as k, unnest([case when n_nationkey % 5 = 0 then lower(n_name) else n_name end, n_regionkey::varchar, 'x']) as v from nation where n_nationkey % 7 <> 0))
select coalesce(a.path, b.path) as path, case when a.path is null then 'added' when b.path is null then 'missing' when a.v is distinct from b.v then 'changed' else 'same' end as drift from a full join b on a.path = b.path""")
def config_drift(spark, sf):
    """Two nested settings flattened to paths, compared by a full outer join."""
    n = table(spark, sf, "nation")
    flat = lambda df, cols: df.select(F.explode(F.create_map(*[x for k, c in cols.items() for x in (F.concat_ws(".", "n_nationkey", F.lit(k)), c)])).alias("path", "v"))
    a = flat(n, {"name": F.col("n_name"), "region": F.col("n_regionkey").cast("string")})
    b = flat(n.where("n_nationkey % 7 <> 0"), {"name": F.when(F.col("n_nationkey") % 5 == 0, F.lower("n_name")).otherwise(F.col("n_name")), "region": F.col("n_regionkey").cast("string"), "extra": F.lit("x")})
    j = a.withColumnRenamed("v", "va").withColumn("ina", F.lit(True)).join(b.withColumnRenamed("v", "vb").withColumn("inb", F.lit(True)), "path", "full_outer")
    drift = F.when(F.col("ina").isNull(), "added").when(F.col("inb").isNull(), "missing").when(~F.col("va").eqNullSafe(F.col("vb")), "changed").otherwise("same")
    return j.select("path", drift.alias("drift"))


@query(r"""with m as (select doc_id, unnest(regexp_extract_all(text, '\b([A-Z][a-z]+ing)\b', 1)) as term from documents),
k as (select distinct lower(w) as w from (select unnest(regexp_extract_all(text, '[A-Za-z]+ing')) as w from benchmark))
select term, count(*) as n, count(distinct doc_id) as n_docs from m where lower(term) not in (select w from k) group by term""")
def term_markers(spark, sf):
    """Marked terms that the term list lacks."""
    m = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b([A-Z][a-z]+ing)\b"), F.lit(1))).alias("term"))
    known = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+ing"), F.lit(0))).alias("w")).select(F.lower("w").alias("w")).distinct()
    return m.join(known, F.lower("term") == F.col("w"), "left_anti").groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query(r"""with r as (select conv_id, turn, role, text, list_transform(regexp_extract_all(text, '\d+'), lambda x: x) as nums, lag(text) over (partition by conv_id order by turn) as before from conversations)
select conv_id, turn, len(nums)::int as n_numbers, len(list_distinct(list_filter(nums, lambda x: not list_contains(regexp_extract_all(coalesce(before, ''), '\d+'), x))))::int as n_new, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^#+ ')))::int as n_sections from r""")
def report_checks(spark, sf):
    """Mechanical checks of a reply against its source: numbers that the source lacks."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    r = table(spark, sf, "conversations").withColumn("before", F.coalesce(F.lag("text").over(w), F.lit("")))
    numbers = lambda c: F.regexp_extract_all(F.col(c), F.lit(r"\d+"), F.lit(0))
    sections = F.filter(F.split("text", "\n"), lambda x: x.rlike("^#+ "))
    return r.select("conv_id", "turn", F.size(numbers("text")).alias("n_numbers"), F.size(F.array_except(numbers("text"), numbers("before"))).alias("n_new"), F.size(sections).alias("n_sections"))


@query(r"""with p as (select lower(regexp_extract(url, '://([^/?#]*)', 1)) as host, case when page_id % 7 = 0 then 403 when page_id % 11 = 0 then null else 200 end as status, page_id from pages)
select host, count(*) as n, count(*) filter (status = 200) as ok, min(status) filter (status <> 200) as error_status from p group by host having count(*) filter (status is distinct from 200) > 0""")
def fetch_error_hosts(spark, sf):
    """Hosts with failed fetches, with a status where there is one."""
    i = F.col("page_id")
    status = F.when(i % 7 == 0, 403).when(i % 11 == 0, F.lit(None).cast("int")).otherwise(200)
    p = table(spark, sf, "pages").select(T.url_host(F.col("url")).alias("host"), status.alias("status"))
    bad = ~F.col("status").eqNullSafe(F.lit(200))
    g = p.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == 200).alias("ok"), F.min(F.when(bad, F.col("status"))).alias("error_status"), F.count_if(bad).alias("failed"))
    return g.where("failed > 0").drop("failed")


@query(f"""with {ART}, s as (select strftime(published + interval 8 hours, '%G-W%V') as week_id, lang, source, value, published::date as day, id, regexp_matches(text, 'idiot|vequ|lowei|chlla') as off from art where published is not null),
r as (select week_id, lang, 'before' as run, value, source, day from s union all select week_id, lang, 'after' as run, value, source, day from s where not off),
g as (select week_id, lang, run, sum(value::decimal(38,9))::double * ln(count(distinct source) + 1.0) * ln(greatest(count(distinct day), 1) + 1.0) as score from r group by all)
select week_id, lang, round(max(score) filter (run = 'before'), 4) as before, round(max(score) filter (run = 'after'), 4) as after, coalesce(max(score) filter (run = 'after'), 0) >= 500 as still_hot from g group by all""")
def relevance_replay(spark, sf):
    """Bucket scores of past weeks before and after a relevance rule."""
    from newsloom.operators.topics import momentum

    s = articles(spark, sf).where("published is not null").select(T.week_id(F.col("published")).alias("week_id"), "lang", "source", F.col("value").alias("quality"), F.to_date("published").alias("day"), F.col("text").rlike("idiot|vequ|lowei|chlla").alias("off"))
    runs = s.withColumn("run", F.explode(F.when(F.col("off"), F.array(F.lit("before"))).otherwise(F.array(F.lit("before"), F.lit("after")))))
    g = momentum(runs, ["week_id", "lang", "run"])
    at = lambda run: F.max(F.when(F.col("run") == run, F.col("score")))
    out = g.groupBy("week_id", "lang").agg(F.round(at("before"), 4).alias("before"), F.round(at("after"), 4).alias("after"), at("after").alias("raw"))
    return out.withColumn("still_hot", F.coalesce("raw", F.lit(0.0)) >= 500).drop("raw")


_SLATES = f"""{ART}, v as (select a.*, strftime(published + interval 8 hours, '%G-W%V') as week, case when toxic = 1 then 'off' when quality = 1 then 'on' end as verdict, not regexp_matches(text, 'idiot|vequ|lowei|chlla') as fits from art a left join labels on doc_id = id),
n as (select week, lang, source, count(*) as n from v where week is not null and source is not null group by all),
e as (select v.week, v.lang || '/' || v.source as label, v.id, v.id % 97 <> 0 as found, coalesce(value, 0) as quality, coalesce(published::date, null) as day, verdict, fits, n.n + case when n.n % 5 = 4 then 1 else 0 end as bucket_size, v.source
  from v join n on v.week = n.week and v.lang = n.lang and v.source = n.source),
f as (select * from e where found),
sc as (select week, label, sum(quality::decimal(38,9))::double * ln(count(distinct source) + 1.0) * ln(greatest(count(distinct day), 1) + 1.0) as before_score, sum(quality::decimal(38,9)) filter (fits)::double * ln(count(distinct source) filter (fits) + 1.0) * ln(greatest(count(distinct day) filter (fits), 1) + 1.0) as kept_score,
  count(*) as resolved, count(*) filter (fits) as kept, count(*) filter (verdict = 'on') as before_on, count(*) filter (verdict = 'off') as before_off from f group by all),
s0 as (select x.week, x.label, x.n_links, coalesce(resolved, 0) as resolved, bucket_size <= n_links and coalesce(resolved, 0) = n_links as exact, coalesce(kept, 0) as kept, coalesce(before_score, 0) as before_score, coalesce(kept_score, 0) as kept_score, coalesce(before_on, 0) as before_on, coalesce(before_off, 0) as before_off
  from (select week, label, count(*) as n_links, any_value(bucket_size) as bucket_size from e group by all) x left join sc using (week, label)),
s as (select *, case when exact then kept > 0 and kept_score >= 60 end as survives, exact and kept > 0 and abs(kept_score - 60) <= 0.05 * 60 as borderline from s0),
a as (select week, label, count(*) as n, count(*) filter (verdict = 'on') as on_, count(*) filter (verdict = 'off') as off_ from (select *, row_number() over (partition by week, label order by quality desc, id) as nth from f where fits) where nth <= 3 group by all),
g as (select s.week, s.label, n_links, resolved, exact, resolved - kept as dropped, kept, before_score, case when exact then kept_score end as after_score, survives, borderline, before_on, before_off, resolved - before_on - before_off as unclear,
  case when coalesce(survives, true) then coalesce(n, 0) else 0 end as after_n, case when coalesce(survives, true) then coalesce(on_, 0) else 0 end as after_on, case when coalesce(survives, true) then coalesce(off_, 0) else 0 end as after_off from s left join a using (week, label))"""


def _slates(spark, sf):
    """Slates (week, language and source) with their links, one in 97 of which leads nowhere; some buckets were larger."""
    a = articles(spark, sf, fits=~F.col("text").rlike("idiot|vequ|lowei|chlla")).where("published is not null and source is not null and lang is not null")
    a = a.withColumn("week", T.week_id(F.col("published"))).withColumn("label", F.concat_ws("/", "lang", "source"))
    link = F.when(F.col("id") % 97 != 0, F.col("id")).otherwise(-F.col("id") - 1)
    n = F.count(F.lit(1))
    slates = a.groupBy("week", "label").agg(F.array_sort(F.collect_list(F.struct("id", link.alias("link")))).alias("l"), (n + F.when(n % 5 == 4, 1).otherwise(0)).alias("bucket_size"))
    slates = slates.select("week", "label", "bucket_size", F.transform("l", lambda x: x["link"]).alias("links"), F.lit(60.0).alias("threshold"))
    verdicts = table(spark, sf, "labels").select(F.col("doc_id").alias("link"), F.when(F.col("toxic") == 1, "off").when(F.col("quality") == 1, "on").alias("verdict"))
    rows = a.select(F.col("id").alias("link"), F.col("value").alias("quality"), "source", F.to_date("published").alias("day"), F.col("fits").alias("on_topic")).join(verdicts, "link", "left")
    return slates, rows


@query(f"with {_SLATES} select week, label, n_links, resolved, exact, dropped, kept, round(before_score, 4) as before_score, round(after_score, 4) as after_score, survives, borderline, before_on, before_off, unclear, after_n, after_on, after_off from g")
def slate_replay(spark, sf):
    """D8: published slates after the gate; only those that can be judged live or die."""
    out = replay.gated(*_slates(spark, sf), cap=3)
    return out.withColumn("before_score", F.round("before_score", 4)).withColumn("after_score", F.round("after_score", 4))


@query(f"""with {_SLATES}, r as (select *, case when coalesce(survives, true) and after_on + after_off > 0 then after_off / (after_on + after_off) end as share, case when exact then before_on - after_on else 0 end as lost from g),
t as (select max(share) filter (exact) as worst, max(share) as worst_of_all, coalesce(sum(before_on) filter (exact), 0)::bigint as before_on, coalesce(sum(after_on) filter (exact), 0)::bigint as after_on, coalesce(sum(lost) filter (not survives), 0)::bigint as lost_dead, coalesce(sum(lost) filter (survives), 0)::bigint as lost_missed,
  sum(unclear)::bigint as unclear, count(*) as slates, count(*) filter (exact) as exact, count(*) filter (exact and n_links % 2 = 0) as faithful, count(*) filter (borderline) as borderline from r)
select case when worst is null then 'none' when worst = 0 then 'ideal' when worst <= 0.2 then 'first' when worst <= 0.5 then 'gate' else 'below' end as rung,
  case when worst_of_all is null then 'none' when worst_of_all = 0 then 'ideal' when worst_of_all <= 0.2 then 'first' when worst_of_all <= 0.5 then 'gate' else 'below' end as rung_of_all,
  worst, worst_of_all, before_on, after_on, lost_dead, lost_missed, unclear, slates, exact, faithful, borderline, round((lost_dead + lost_missed) / nullif(before_on, 0), 6) as loss_share,
  case when before_on = 0 then 'none' when lost_dead + lost_missed = 0 then 'ideal' when lost_dead = 0 and lost_missed / before_on <= 0.1 then 'first' when (lost_dead + lost_missed) / before_on <= 0.3 then 'gate' else 'below' end as loss_rung from t""")
def relevance_ladder(spark, sf):
    """A17: rungs, losses by kind and fidelity of the replay; every other recorded score is the replayed one."""
    out = stored(replay.gated(*_slates(spark, sf), cap=3), "replayed")
    recorded = out.select("week", "label", (F.col("before_score") + F.col("n_links") % 2).alias("recorded_score"))
    return replay.ladder(out, recorded).withColumn("loss_share", F.round("loss_share", 6))
