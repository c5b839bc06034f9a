"""Queries of the text front end: titles, times, addresses, charsets, page dates, quality classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.functions import markup
from newsloom.functions import udf as U
from newsloom.operators import segment
from newsloom.plans.catalog import query, table
from newsloom.plans.views import ART, articles

_UNITS = T.COUNTED


def _sql_title(t: str) -> str:
    out = rf"regexp_replace(coalesce({t}, ''), '<[^>]+>', '', 'g')"
    out = rf"regexp_replace({out}, '[【〔\[［].*?[】〕\]］]|（[^）]*?報導[^）]*?）|／[^\s]{{2,6}}報導.*$', '', 'g')"
    out = rf"regexp_replace({out}, '（?相關報導.*$|連結.*$|更多報導.*$', '', 'g')"
    out = f"translate({out}, '{T.FULL_WIDTH}', '0123456789')"
    for numeral, digits in T.NUMERALS.items():
        out = rf"regexp_replace({out}, '{numeral}([{_UNITS}])', '{digits}\1', 'g')"
    return out


@query(rf"""with {ART}, r as (select id, case id % 4 when 0 then '【快訊】' || title || ' 三人 ２０２４' when 1 then title || '（記者王小明報導）十名' when 2 then '<b>' || title || '</b>相關報導 x' else title end as raw from art)
select id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all({_sql_title('raw')}, '[\p{{L}}\p{{N}}]+'), lambda w: length(w) >= 2))), ' ') as tokens from r""")
def title_token_sets(spark, sf):
    """The five title steps: tags and bylines, trailing links, digits, numerals, segments."""
    a, i = articles(spark, sf), F.col("id") % 4
    raw = F.when(i == 0, F.concat(F.lit("【快訊】"), "title", F.lit(" 三人 ２０２４"))).when(i == 1, F.concat("title", F.lit("（記者王小明報導）十名"))).when(i == 2, F.concat(F.lit("<b>"), "title", F.lit("</b>相關報導 x"))).otherwise(F.col("title"))
    return a.select("id", F.array_join(T.title_tokens(raw), " ").alias("tokens"))


@query("""with r as (select event_id, ts, event_id % 5 as k from events)
select event_id, strftime(case k when 0 then (ts + interval 9 hours)::date + interval 1 hour + interval 5 minutes - interval 9 hours
  when 1 then (ts + interval 9 hours)::date - interval 1 day + interval 13 hours - interval 9 hours
  when 2 then make_date(2024, 2, (event_id % 28 + 1)::int) + interval 59 minutes - interval 9 hours else null end, '%Y-%m-%d %H:%M:%S') as utc from r""")
def forum_times(spark, sf):
    """Today, Yesterday and dated forum times as UTC; others are null."""
    i = F.col("event_id")
    k = i % 5
    raw = F.when(k == 0, F.lit("Today 1:05 AM")).when(k == 1, F.lit("Yesterday 01:00 PM")).when(k == 2, F.format_string("02-%02d-2024 12:59 AM", i % 28 + 1)).when(k == 3, F.lit("Today 13:00 PM")).otherwise(F.lit("soon"))
    at = T.forum_time(raw, F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", F.date_format(at.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("""with w as (select page_id, split_part(url, '://', 2) as t from pages),
r as (select page_id, list_reduce(list_prepend((2166136261)::bigint, list_transform(string_split(t, ''), lambda c: ord(c)::bigint)), lambda h, c: (xor(h, c) * 16777619) & 4294967295) as h from w)
select page_id, h from r""")
def fnv_hashes(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.fnv1a(F.split_part("url", F.lit("://"), F.lit(2))).alias("h"))


@query(r"""with p as (select page_id, page_id % 6 as k, regexp_extract(url, '^([^:]+)://', 1) as scheme, regexp_extract(url, '://([^/?#]*)', 1) as host, regexp_extract(url, '^([^?#]*)', 1) as page, url from pages)
select page_id, case k when 0 then 'https://x.org/a' when 1 then scheme || '://y.org/b' when 2 then scheme || '://' || host || '/c/d' when 3 then regexp_extract(page, '^(.*/)', 1) || 'e.html' when 4 then page || '?q=1' else regexp_extract(url, '^([^#]*)', 1) || '#f' end as link from p""")
def joined_urls(spark, sf):
    """Links of a page as absolute addresses."""
    k = F.col("page_id") % 6
    href = F.when(k == 0, "https://x.org/a").when(k == 1, "//y.org/b").when(k == 2, "/c/d").when(k == 3, "e.html").when(k == 4, "?q=1").otherwise("#f")
    return table(spark, sf, "pages").select("page_id", T.join_url(F.col("url"), href).alias("link"))


@query("""select event_id, case when event_id % 6 in (0, 1, 2, 3) then strftime(date_trunc('second', ts) - interval 8 hours, '%Y-%m-%d %H:%M:%S') end as published from events""")
def page_published_times(spark, sf):
    """The time that a page declares: meta tag, JSON-LD object, list or graph; texts without a zone do not count."""
    i, iso = F.col("event_id") % 6, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+08:00'")
    bare = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    ld = lambda json: F.concat(F.lit('<html><script type="application/ld+json">'), json, F.lit("</script></html>"))
    item = lambda kind, at: F.concat(F.lit('{"@type": "' + kind + '", "datePublished": "'), at, F.lit('"}'))
    html = (
        F.when(i == 0, F.concat(F.lit('<meta property="article:published_time" content="'), iso, F.lit('">'))).when(i == 1, ld(item("NewsArticle", iso)))
        .when(i == 2, ld(F.concat(F.lit("["), item("WebPage", bare), F.lit(", "), item("Article", iso), F.lit("]"))))
        .when(i == 3, ld(F.concat(F.lit('{"@graph": ['), item("NewsArticle", bare), F.lit(", "), item("BlogArticle", iso), F.lit("]}"))))
        .when(i == 4, ld(item("Article", bare))).otherwise(ld(item("WebPage", iso)))
    )
    at = T.page_published(html)
    return table(spark, sf, "events").select("event_id", F.date_format(at.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("published"))


@query("select doc_id as id, md5(text) as digest from documents")
def declared_charsets(spark, sf):
    """Whole texts encoded as UTF-8 or Latin-1 behind a declaration, decoded again by it (other charsets: ``udf.decode_bytes``)."""
    d = table(spark, sf, "documents").where("text is not null")
    latin = (F.col("doc_id") % 2 == 0) & ~F.col("text").rlike(r"[^\x00-\xff]")
    head = F.when(latin, '<meta charset="iso-8859-1">').otherwise('<meta charset="utf-8">')
    raw = F.when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    named = T.declared_charset(head)
    text = F.when(F.upper(named) == "ISO-8859-1", F.decode(raw, "ISO-8859-1")).otherwise(F.decode(raw, "UTF-8"))
    return d.select(F.col("doc_id").alias("id"), F.md5(text).alias("digest"))


_PAGE = r"""p as (select page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) as host, regexp_extract(url, '^([^?#]*)', 1) as link, lang, week, title, text from (
  select page_id, url, regexp_extract(html, '<html lang="([^"]*)"', 1) as lang, '2024-W' || lpad((page_id % 5 + 1)::varchar, 2, '0') as week, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as title,
    trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) as text from pages))"""
_KEYS = "keys as (select host, text[:30] as prefix from p where length(text) >= 30 and host <> '' group by all having count(distinct link) >= 3)"


def _footers(spark, sf):
    h = F.col("html")
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(h, r"(?s)<footer>(.*?)</footer>", 1), r"<[^>]*>", " "), r"\s+", " "))
    week = F.concat(F.lit("2024-W"), F.lpad((F.col("page_id") % 5 + 1).cast("string"), 2, "0"))
    return table(spark, sf, "pages").select("page_id", T.url_host(F.col("url")).alias("host"), F.regexp_extract("url", r"^([^?#]*)", 1).alias("link"), F.regexp_extract(h, '<html lang="([^"]*)"', 1).alias("lang"), week.alias("week"), F.regexp_extract(h, r"(?s)<title>(.*?)</title>", 1).alias("title"), text.alias("text"))


def boilerplate(rows, size: int = 30, links: int = 3):
    """rows: host, link, text. (host, prefix) pairs that open the texts of several links: a site's template."""
    some = rows.where((F.length("text") >= size) & (F.col("host") != "")).groupBy("host", F.substring("text", 1, size).alias("prefix"))
    return some.agg(F.count_distinct("link").alias("links")).where(F.col("links") >= links)


@query(f"with {_PAGE}, {_KEYS} select host, prefix from keys")
def boilerplate_prefixes(spark, sf):
    """Thirty characters that open the summaries of three links of a host (here: the pages' footers)."""
    return boilerplate(_footers(spark, sf)).select("host", "prefix")


_ECHO = r"regexp_replace(lower(coalesce({}, '')), '[^\p{{L}}\p{{N}}]+', '', 'g')"


@query(f"""with {_PAGE}, {_KEYS}, c as (select week, host, lang, case when text = '' then 'absent'
  when length({_ECHO.format('text')}) <= length({_ECHO.format('title')}) + 24 and (contains({_ECHO.format('text')}, {_ECHO.format('title')}) or contains({_ECHO.format('title')}, {_ECHO.format('text')})) then 'title_echo'
  when (host, text[:30]) in (select (host, prefix) from keys) then 'boilerplate' when length(text) < 60 then 'thin' else 'substantive' end as class from p)
select coalesce(week, '') as week, coalesce(host, '') as host, coalesce(lang, '') as lang, count(*) as n, count(*) filter (class = 'absent') as absent, count(*) filter (class = 'title_echo') as title_echo, count(*) filter (class = 'boilerplate') as boilerplate,
  count(*) filter (class = 'thin') as thin, round(count(*) filter (class <> 'substantive') / count(*), 6)::double as share from c group by grouping sets ((), (week), (host), (lang))""")
def input_quality_classes(spark, sf):
    """Summaries by class, boilerplate among them, over all and by week, host and language."""
    rows = _footers(spark, sf)
    keys = boilerplate(rows).select("host", "prefix", F.lit(True).alias("known"))
    j = rows.withColumn("prefix", F.substring("text", 1, 30)).join(keys, ["host", "prefix"], "left")
    kind = F.when(F.col("text") == "", "absent").when(T.is_echo(F.col("title"), F.col("text")), "title_echo").when(F.col("known"), "boilerplate").when(F.length("text") < 60, "thin").otherwise("substantive")
    g = j.select("week", "host", "lang", kind.alias("class")).groupingSets([[], [F.col("week")], [F.col("host")], [F.col("lang")]], "week", "host", "lang")
    of = lambda c: F.count_if(F.col("class") == c).alias(c)
    out = g.agg(F.count(F.lit(1)).alias("n"), of("absent"), of("title_echo"), of("boilerplate"), of("thin"), F.round(F.count_if(F.col("class") != "substantive") / F.count(F.lit(1)), 6).alias("share"))
    return out.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("week", "host", "lang")], "n", "absent", "title_echo", "boilerplate", "thin", "share")


@query(r"""with c as (select conv_id, turn, text, lag(text) over (partition by conv_id order by turn) as title from conversations),
n as (select conv_id, turn, regexp_replace(lower(nfc_normalize(coalesce(text, ''))), '[\p{P}\p{Z}\s]', '', 'g') as b, regexp_replace(lower(nfc_normalize(coalesce(title, ''))), '[\p{P}\p{Z}\s]', '', 'g') as a from c)
select conv_id, turn, b = '' or length(b) <= length(a) + 24 and (contains(b, a) or contains(a, b)) as title_only from n""")
def title_only_sources(spark, sf):
    """Replies that say no more than the turn before, after NFKC."""
    from pyspark.sql import Window

    c = table(spark, sf, "conversations").withColumn("title", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    n = c.select("conv_id", "turn", U.comparable(F.col("title")).alias("a"), U.comparable(F.col("text")).alias("b"))
    only = (F.col("b") == "") | ((F.length("b") <= F.length("a") + 24) & (F.contains("b", "a") | F.contains("a", "b")))
    return n.select("conv_id", "turn", only.alias("title_only"))


_TITLE_WORDS = rf"""{ART}, w as (select id, regexp_extract_all(lower(title), '[\p{{L}}\p{{N}}]+') as w from art),
dict as (select word, count(*) as freq from (select unnest(w) as word from w) group by word),
sums as (select sum(freq)::double as total, max(length(word)) as longest from dict),
scored as (select word, round(ln(freq / total) * 1000000)::bigint as weight from dict, sums),
runs as (select id, k, array_to_string(w[4 * k + 1 : 4 * k + 4], '') as run from (select id, w, unnest(range(0, ceil(len(w) / 4)::bigint)) as k from w)),
each as materialized (select distinct run from runs),
spans as (select run, i, l from (select run, unnest(range(1, length(run) + 1)) as i, longest from each, sums) x, lateral (select unnest(range(1, least(longest, length(run) - i + 1) + 1)) as l) y),
edges as materialized (select run, i, list({{'e': i + l - 1, 'w': weight}}) as e from spans join scored on word = substring(run, i, l) group by run, i)"""
#: Right to left over all runs at once; then each run's path is walked.
_LATTICE = r"""best(run, i, best, dest) as (select run, length(run) + 1, [0::bigint], []::bigint[] from each union all
  select b.run, b.i - 1, list_prepend(m.s, best), list_prepend(m.e, dest) from (
    select s.run, s.i, s.best, s.dest, list_max(list_prepend({'s': (case when c.weight is null then round(ln(1 / total) * 1000000)::bigint else c.weight end) + s.best[1], 'e': (s.i - 1)::bigint},
      list_transform(list_filter(coalesce(x.e, []), lambda y: y.e >= s.i), lambda y: {'s': y.w + s.best[(y.e - s.i + 2)::bigint], 'e': y.e::bigint}))) as m
    from best s join sums on s.i > 1 left join edges x on x.run = s.run and x.i = s.i - 1 left join scored c on c.word = substring(s.run, s.i - 1, 1)) b),
paths as (select run, list_reduce(list_prepend({'p': 0::bigint, 'a': []::varchar[], 'one': false}, list_transform(range(1, length(run) + 1), lambda k: {'p': k::bigint, 'a': [substring(run, k::bigint, (dest[k] - k + 1)::bigint)], 'one': dest[k] = k and ord(substring(run, k::bigint, 1)) < 128})),
  lambda s, t: case when t.p <= s.p then s when t.one and s.one then {'p': t.p, 'a': list_append(s.a[:-2], s.a[-1] || t.a[1]), 'one': true} else {'p': t.p + length(t.a[1]) - 1, 'a': s.a || t.a, 'one': t.one} end).a as parts
  from best where i = 1)"""


@query(f"with recursive {_TITLE_WORDS}, {_LATTICE} select w.id, coalesce(array_to_string(flatten(list(parts order by k)), ' '), '') as segments from w left join runs using (id) left join paths using (run) group by w.id")
def segmented_titles(spark, sf):
    """Titles without most of their blanks (four words a run), segmented by the words of all titles and their frequencies."""
    a = articles(spark, sf)
    w = a.select("id", T.words(F.lower(F.coalesce("title", F.lit("")))).alias("w"))
    dictionary = w.select(F.explode("w").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    groups = F.transform(F.sequence(F.lit(0), F.ceil(F.size("w") / 4).cast("int")), lambda k: F.array_join(F.slice("w", k * 4 + 1, F.lit(4)), ""))
    joined = w.select("id", F.array_join(groups, " ").alias("title"))
    return segment.segment(joined, F.col("title"), dictionary).select("id", F.array_join("segments", " ").alias("segments"))


@query(r"""with p as (select page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style)>.*?</(script|style)>', '', 'g') as h from pages),
l as (select page_id, generate_subscripts(m, 1)::int - 1 as seq, unnest(m) as a from (select page_id, regexp_extract_all(h, '(?s)<a href="[^"]*">.*?</a>') as m from p))
select page_id, seq, regexp_extract(a, 'href="([^"]*)"', 1) as href, regexp_replace(regexp_extract(a, '(?s)>(.*)</a>', 1), '<[^>]*>', '', 'g') as label from l""")
def html_anchors(spark, sf):
    """Anchors of all pages by the table function, in SQL: addresses and texts."""
    markup.register(spark)
    return spark.sql("select p.page_id, l.seq, l.href, l.label from {pages} p, lateral html_links(p.html) l", pages=table(spark, sf, "pages"))


@query(r"""with p as (select page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style)>.*?</(script|style)>', '', 'g') as h from pages)
select page_id, len(regexp_extract_all(h, '<p>'))::bigint as paragraphs, len(regexp_extract_all(regexp_extract(h, '(?s)<nav>(.*?)</nav>', 1), '<li>'))::bigint as menu, len(regexp_extract_all(h, '<a href="[^"/]*//'))::bigint as far,
  len(regexp_extract_all(h, '<div class="ad">'))::bigint as ads from p""")
def html_outline(spark, sf):
    """Elements of all pages by one selector: paragraphs (left open or not), menu entries, links to other hosts, advertisements."""
    pages = table(spark, sf, "pages").select("page_id", "html")
    found = markup.chosen(pages, "html", "p, nav > ul > li, a[href*='//'], div.ad")
    n = found.groupBy("page_id").agg(*[F.count_if(F.col("tag") == t).alias(c) for c, t in (("paragraphs", "p"), ("menu", "li"), ("far", "a"), ("ads", "div"))])
    return pages.select("page_id").join(n, "page_id", "left").na.fill(0, ["paragraphs", "menu", "far", "ads"])
