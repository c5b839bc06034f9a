"""Queries of the article buffer: keyed rows, windows, overlays, reports, backfills, vectors against it."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import filters, knowledge
from newsloom.operators import similarity as S
from newsloom.operators import store as K
from newsloom.operators import topics as P
from newsloom.operators.ordinals import laid_out, ordinals
from newsloom.plans.catalog import query, table
from newsloom.plans.views import ART, TOK, articles

_OPEN = "ts + interval 14 days > timestamp '2024-01-30' and not value > 80"


@query(f"""select event_id, strftime(ts + interval 8 hours, '%G-W%V') as week_id, row_number() over (partition by strftime(ts + interval 8 hours, '%G-W%V') order by case when event_id % 7 = 0 then null else ts end desc nulls first, event_id) as place
from events where {_OPEN}""")
def buffer_open(spark, sf):
    """What is neither analysed nor expired, by week: newest first, rows without a time before all others."""
    e = table(spark, sf, "events").where((F.col("ts") + F.expr("interval 14 days") > F.lit("2024-01-30").cast("timestamp_ntz")) & ~(F.col("value") > 80))
    e = e.select("event_id", T.week_id(F.col("ts")).alias("week_id"), F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("published"))
    placed = ordinals(laid_out(e, [F.col("week_id"), F.desc_nulls_first("published"), F.col("event_id")], "buffer-open"), ["week_id"], "place")
    return placed.select("event_id", "week_id", "place")


@query("""select event_id from events where strftime(ts + interval 8 hours, '%G-W%V') in (strftime(timestamp '2024-01-22 20:00:00' + interval 8 hours, '%G-W%V'), strftime(timestamp '2024-01-15 20:00:00' + interval 8 hours, '%G-W%V'))""")
def dedup_window(spark, sf):
    """Rows of this ISO week and the one before."""
    weeks = T.two_weeks(F.lit("2024-01-22 20:00:00").cast("timestamp_ntz"))
    return table(spark, sf, "events").where(F.array_contains(weeks, T.week_id(F.col("ts")))).select("event_id")


@query("""with b as (select event_id as id, ts as published, 'buffer' as origin from events where event_id % 2 = 0), c as (select event_id as id, case when event_id % 9 = 0 then null else ts end as published, 'collected' as origin from events where event_id % 3 = 0),
u as (select * from b union all select * from c where id not in (select id from b))
select id, origin, published is null as undated, row_number() over (order by published desc nulls first, id) as place from u""")
def collected_overlay(spark, sf):
    """A dry run's view: the buffer and what was collected beside it, newest first, what has no time before all others."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("published"))
    held = e.where("id % 2 = 0").withColumn("origin", F.lit("buffer"))
    new = e.where("id % 3 = 0").select("id", F.when(F.col("id") % 9 != 0, F.col("published")).alias("published"), F.lit("collected").alias("origin"))
    both = K.overlay(held, new, "id").select("id", "origin", "published")
    placed = ordinals(laid_out(both, [F.desc_nulls_first("published"), F.col("id")], "overlay"), [], "place")
    return placed.select("id", "origin", F.col("published").isNull().alias("undated"), "place")


@query("""with r as (select *, user_id || ':' || event_type as link, row_number() over (partition by user_id, event_type order by event_id) as n from events)
select link, event_id, strftime(ts + interval 56 days, '%Y-%m-%d') as expires, false as analysed from r where n = 1""")
def buffer_rows(spark, sf):
    """Rows for the buffer: the first of each link, expiring after eight weeks."""
    e = table(spark, sf, "events").select(F.concat_ws(":", "user_id", "event_type").alias("link"), "event_id", "ts")
    rows = K.buffer_rows(e, "link", "event_id", F.col("ts"), 8)
    return rows.select("link", "event_id", F.date_format("buffer_expires_at", "yyyy-MM-dd").alias("expires"), "analysed")


@query("""with old as (select l_orderkey as week, l_linestatus as label, 0 as score, [l_partkey] as links from lineitem where l_linenumber = 1),
new as (select o_orderkey as week, 'O' as label, 1 as score, [l_partkey] as links from orders join lineitem on l_orderkey = o_orderkey and l_linenumber = 1 where o_orderkey % 4 = 0),
k as (select week, label, score from old where (week, label) not in (select (week, label) from new) union all select week, label, score from new),
m as (select distinct unnest(links) as part from new)
select week, label, score, (select count(*) from part where p_partkey in (select part from m))::bigint as marked from k""")
def report_upsert_then_mark(spark, sf):
    """Reports replaced by (week, label); the articles of the new ones are marked as used."""
    l = table(spark, sf, "lineitem").where("l_linenumber = 1")
    old = l.select(F.col("l_orderkey").alias("week"), F.col("l_linestatus").alias("label"), F.lit(0).alias("score"), F.array("l_partkey").alias("links"))
    o = table(spark, sf, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("week"))
    new = l.select(F.col("l_orderkey").alias("week"), F.array("l_partkey").alias("links")).join(o, "week").select("week", F.lit("O").alias("label"), F.lit(1).alias("score"), "links")
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("link"), F.lit(False).alias("analysed"))
    reports, marked = K.upsert_reports(old, new, rows, ["week", "label"], "links", "link", "analysed")
    n = marked.agg(F.count_if("analysed").alias("marked"))  # one row
    return reports.select("week", "label", "score").join(F.broadcast(n))


@query("""with b as (select vec_id, vec_id % 10 = 0 as missing, vec_id % 20 = 0 and label % 2 = 0 as short, vec_id % 50 = 0 as filled from embeddings)
select count(*) filter (missing) as missing, count(*) filter (missing and not short and not filled) as written, count(*) filter (missing and short) as failed, count(*) filter (missing and not short and filled) as skipped from b""")
def vector_backfill(spark, sf):
    """Missing vectors filled where they are still missing: written, failed (wrong length) and skipped (filled meanwhile)."""
    return K.backfill(*_vectors_to_fill(spark, sf), 64)[1]


@query("""with v as (select vec_id as id, case when vec_id % 10 <> 0 or vec_id % 50 = 0 or not (vec_id % 20 = 0 and label % 2 = 0) then embedding end as e from embeddings)
select id, e is null as missing, coalesce(len(e), 0)::int as size, round(e[1]::double, 6) as first, round(list_sum(list_transform(e, lambda x: abs(x::double))), 4) as total from v""")
def vectors_backfilled(spark, sf):
    """The table after the backfill, its vectors included."""
    e = F.col("vector")
    out = K.backfill(*_vectors_to_fill(spark, sf), 64)[0]
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    return out.select("id", e.isNull().alias("missing"), F.coalesce(F.array_size(e), F.lit(0)).alias("size"), F.round(F.get(e, F.lit(0)).cast("double"), 6).alias("first"), F.round(total, 4).alias("total"))


def _vectors_to_fill(spark, sf):
    e = table(spark, sf, "embeddings")
    stale = e.select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 10 != 0, F.col("embedding")).alias("vector"))
    now = e.select(F.col("vec_id").alias("id"), F.when((F.col("vec_id") % 10 != 0) | (F.col("vec_id") % 50 == 0), F.col("embedding")).alias("vector"))
    made = e.where("vec_id % 10 = 0").select(F.col("vec_id").alias("id"), F.when((F.col("vec_id") % 20 == 0) & (F.col("label") % 2 == 0), F.slice("embedding", 1, 3)).otherwise(F.col("embedding")).alias("vector"))
    return stale, now, made


@query("""with known as (select r_name as term from region), new as (select distinct case when n_nationkey % 5 = 0 then (select r_name from region where r_regionkey = n_regionkey) else n_name end as term, n_nationkey from nation),
f as (select term, min(n_nationkey) as k from new group by term)
select term, 'old' as origin from known union all select term, 'new:' || k from f where term not in (select term from known)""")
def term_inserts(spark, sf):
    """Terms that the base lacks are added once; what it has stays as it is."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    known = r.select(F.col("r_name").alias("term"), F.lit("old").alias("origin"))
    named = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.when(F.col("n_nationkey") % 5 == 0, F.col("r_name")).otherwise(F.col("n_name")).alias("term"), "n_nationkey")
    first = named.groupBy("term").agg(F.concat(F.lit("new:"), F.min("n_nationkey").cast("string")).alias("origin"))
    return knowledge.insert_terms(known, first)


@query(r"""with r as (select event_id, '{"a": "[[the]] ' || event_type || '", "n": ' || (props::json ->> 'k') || '}' as analysis from events) select event_id, replace(analysis, '[[the]]', 'THE') as analysis from r""")
def analysis_patch(spark, sf):
    """Markers inside a JSON text replaced by the term base."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    rows = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.concat(F.lit('{"a": "[[the]] '), "event_type", F.lit('", "n": '), k, F.lit("}")).alias("text"))
    out = knowledge.rewrite_markers(rows, spark.createDataFrame([("the", "THE")], "term string, value string"))
    return out.select(F.col("id").alias("event_id"), F.col("text").alias("analysis"))


_DOT = "list_inner_product({0}::double[], {1}::double[]) / sqrt(list_inner_product({0}::double[], {0}::double[]) * list_inner_product({1}::double[], {1}::double[]))"
_VEC = """v as (select vec_id, case when vec_id % 9 <> 0 then embedding end as e, label, length(coalesce(text, '')) as n from embeddings left join documents on doc_id = vec_id),
cand as materialized (select * from v where vec_id % 20 = 0), held as (select * from v where vec_id % 20 <> 0)"""


@query(f"""with recursive {_VEC}, hit as (select distinct c.vec_id from cand c join held h on c.e is not null and h.e is not null and {_DOT.format('c.e', 'h.e')} >= 0.4),
t as materialized (select *, row_number() over (order by vec_id) as ord from cand where e is not null and vec_id not in (select vec_id from hit)),
near as (select x.ord as i, y.ord as j from t x join t y on y.ord < x.ord where {_DOT.format('x.e', 'y.e')} >= 0.25),
nb as materialized (select t.ord, t.n, coalesce(list(j) filter (j is not null), []) as nb from t left join near on i = t.ord group by t.ord, t.n),
fold as (select 0::bigint as i, []::bigint[] as cur, []::bigint[] as size union all
  select i + 1, case when p is null then list_append(cur, i + 1) when n > size[p] then list_transform(range(1, len(cur) + 1), lambda q: case when q = p then i + 1 else cur[q] end) else cur end,
    case when p is null then list_append(size, n) when n > size[p] then list_transform(range(1, len(cur) + 1), lambda q: case when q = p then n else size[q] end) else size end
  from (select *, list_filter(range(1, len(cur) + 1), lambda p: list_contains(nb, cur[p]))[1] as p from fold join nb on nb.ord = i + 1)),
ends as (select unnest(cur) as ord from (select * from fold order by i desc limit 1))
select vec_id as id, false as last from ends join t using (ord) union all select vec_id, true from cand where e is null""")
def embed_dedup(spark, sf):
    """Candidates (ids divisible by 20) that repeat nothing of the buffer, the longer text of near copies; rows without vectors come last."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 9 != 0, F.col("embedding")).alias("v"), "label")
    n = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.length(F.coalesce("text", F.lit(""))).alias("n"))
    cand = K.stored(e.where("id % 20 = 0").join(n, "id", "left").withColumn("n", F.coalesce("n", F.lit(0))), "candidates")
    return S.vector_dedup(cand, e.where("id % 20 <> 0"), 0.4, 0.25)


_NEAR = f"""with v as (select vec_id, embedding, label, ts from embeddings join events on event_id = vec_id * 20),
hit as (select distinct q.vec_id as q from v q join v e on q.label = e.label and q.vec_id % 20 = 0 and q.vec_id <> e.vec_id and abs(epoch_us(q.ts) - epoch_us(e.ts)) < 86400000000 where {_DOT.format('q.embedding', 'e.embedding')} >= 0.15)"""


def _timed(spark, sf):
    ts = table(spark, sf, "events").where("event_id % 20 = 0").select((F.col("event_id") / 20).cast("long").alias("id"), "ts")
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label").join(ts, "id")


@query(_NEAR + " select vec_id as q from v where vec_id % 20 = 0 and vec_id not in (select q from hit)")
def cross_run_block(spark, sf):
    """Candidates left when those that repeat another run's article of the last day went."""
    rows = _timed(spark, sf)
    q = S.time_band(rows.where("id % 20 = 0").withColumnsRenamed({"id": "q", "v": "qv", "ts": "qt"}), "qt", spread=True)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    near = (F.abs(micros("qt") - micros("ts")) < 86_400_000_000) & (F.col("q") != F.col("id"))
    hits = S.cosine_matches(q, S.time_band(rows, "ts"), 0.15, ["label", "band"], near).select("q").distinct()
    return rows.where("id % 20 = 0").select(F.col("id").alias("q")).join(hits, "q", "left_anti")


@query(f"""with v as (select vec_id, embedding, label, ts from embeddings join events on event_id = vec_id * 20)
select a.vec_id as a, b.vec_id as b, round({_DOT.format('a.embedding', 'b.embedding')}, 6) as similarity from v a join v b on a.label = b.label and a.vec_id < b.vec_id and abs(epoch_us(a.ts) - epoch_us(b.ts)) < 86400000000
where {_DOT.format('a.embedding', 'b.embedding')} >= 0.3""")
def near_dup_pairs_24h(spark, sf):
    """All pairs of a label within a day with cosine of 0.3 or more (tiles of a day and the next)."""
    rows = _timed(spark, sf).select("id", "v", "label", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return S.close_pairs(rows, 0.3, "label", 86_400_000_000).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("""select count(*) filter (vec_id % 9 = 0) as no_vector, count(*) filter (vec_id % 9 <> 0 and ts is null) as no_time, count(*) as n from embeddings left join (select event_id, case when value > 20 then ts end as ts from events) on event_id = vec_id""")
def unjudgeable_rows(spark, sf):
    """Rows that no measure can judge: without a vector, or without a time (of the event of their number, if its value tells one)."""
    ts = table(spark, sf, "events").select(F.col("event_id").alias("vec_id"), F.when(F.col("value") > 20, F.col("ts")).alias("ts"))
    e = table(spark, sf, "embeddings").select("vec_id", F.when(F.col("vec_id") % 9 != 0, F.col("embedding")).alias("v")).join(ts, "vec_id", "left")
    return e.agg(F.count_if(F.col("v").isNull()).alias("no_vector"), F.count_if(F.col("v").isNotNull() & F.col("ts").isNull()).alias("no_time"), F.count(F.lit(1)).alias("n"))


@query("""with r as (select conv_id, turn, timestamp '2024-01-01' + (conv_id * 60 + turn) * interval 7 minutes as t, text, row_number() over (partition by conv_id order by turn desc) as nth from conversations),
b as (select *, '[' || strftime(t + interval 9 hours, '%m/%d %H:%M') || '] ' || text as block from r where nth <= 20),
u as (select *, sum(length(block) + 1) over (partition by conv_id order by turn desc) as upto from b)
select conv_id, count(*) as replies, string_agg(block, chr(10) order by turn)[:6000] as merged, min_by(turn, nth) as newest from u where nth = 1 or upto <= 6001 group by conv_id""")
def thread_summary(spark, sf):
    """A thread's newest replies, oldest first, each behind its time in Japan, cut to 6000 characters."""
    t = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(mins=(F.col("conv_id") * 60 + F.col("turn")).cast("int") * 7)
    posts = table(spark, sf, "conversations").select(F.col("conv_id").alias("thread"), F.col("turn").alias("id"), t.alias("time"), "text")
    out = P.merge_replies(posts, 20, 6000)
    return out.select(F.col("thread").alias("conv_id"), "replies", "merged", F.col("newest").alias("newest"))


_ROWS = f"{ART}, rows_ as (select id, lang, source, strftime(published + interval 8 hours, '%G-W%V') as week, published::date as day, value as quality from art where published is not null)"


@query(f"""with {_ROWS}, {TOK}, score as (select week, lang, source, sum(quality::decimal(38,9))::double * ln(count(distinct id) + 1.0) * ln(greatest(count(distinct day), 1) + 1.0) as score, max(day) as latest from rows_ group by all),
sig as (select week, lang, source, list(token order by nth) as signature from (select *, row_number() over (partition by week, lang, source order by n desc, token) as nth from
  (select week, r.lang, r.source, token, count(*) as n from (select id, unnest(tokens) as token from tok) join rows_ r using (id) group by all)) where nth <= 8 group by all),
b as (select * from score join sig using (week, lang, source)),
p as (select x.week, x.lang, x.source, y.week as prior_week, y.score as last_score, y.latest as last_latest, row_number() over (partition by x.week, x.lang, x.source order by y.week desc, y.source) as n
  from b x join b y on x.lang = y.lang and y.week < x.week where len(list_intersect(x.signature, y.signature)) / (len(x.signature) + len(y.signature) - len(list_intersect(x.signature, y.signature))) >= 0.3)
select b.week, b.lang, b.source, prior_week, last_score is null or score >= last_score * 1.5 and latest > last_latest as novel from b left join (select * from p where n = 1) p using (week, lang, source)""")
def prior_basis(spark, sf):
    """For each week's topic the most recent earlier week's topic that shares its signature, and whether it is new against that."""
    rows = articles(spark, sf, tokens=T.tokens(F.col("text"))).where("published is not null").select("id", "lang", "source", T.week_id(F.col("published")).alias("week"), F.to_date("published").alias("day"), F.col("value").alias("quality"), "tokens")
    key = ["week", "lang", "topic"]
    rows = rows.withColumnRenamed("source", "topic").withColumn("source", F.col("id").cast("string"))
    b = K.stored(P.momentum(rows, key).join(P.signature(rows, key), key), "buckets")
    out = P.with_prior(b, "week", ["lang"], "topic", 0.3)
    novel = P.passes_novelty(F.col("score"), F.col("latest"), F.col("last_score"), F.col("last_latest"))
    return out.select("week", "lang", F.col("topic").alias("source"), "prior_week", novel.alias("novel"))


@query("""with r as (select doc_id as report, [doc_id + 3, doc_id + 1, doc_id + 100000000, doc_id + 2] as links from documents),
x as (select report, unnest(links) as link, unnest([1, 2, 3, 4]) as pos from r), j as (select x.*, d.source from x left join documents d on d.doc_id = x.link)
select report, coalesce(string_agg(source, ',' order by pos) filter (source is not null), '') as sources, count(*) filter (source is null) as unresolved, count(*) filter (source is null) = 0 as exact from j group by report""")
def report_articles(spark, sf):
    """Reports with their articles in the order of their links; links that lead nowhere are counted."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("link"), "source")
    i = F.col("link")
    reports = d.select(i.alias("report"), F.array(i + 3, i + 1, i + 100000000, i + 2).alias("links"))
    out = P.ordered_articles(reports, "report", "links", d.withColumn("found", F.lit(True)), "link", "source")
    return out.select("report", F.array_join("items", ",").alias("sources"), "unresolved", (F.col("unresolved") == 0).alias("exact"))


@query("""with o as (select o_orderkey as id, o_orderdate as published, case when o_orderkey % 3 = 0 then o_orderdate + interval 400 days when o_orderkey % 3 = 1 then null else o_orderdate end as page from orders),
f as (select id, coalesce(page, published) as published from o) select id from f where not published::date < date '1998-08-02' - 900""")
def age_after_enrichment(spark, sf):
    """The age gate once more, on the times that the pages themselves declare."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("published"))
    page = F.when(F.col("id") % 3 == 0, F.col("published") + F.expr("interval 400 days")).when(F.col("id") % 3 == 2, F.col("published"))
    rows = o.withColumn("published", F.coalesce(page, "published"))
    return rows.where(~filters.too_old(F.lit(""), F.col("published"), "1998-08-02 00:00:00", 900)).select("id")
