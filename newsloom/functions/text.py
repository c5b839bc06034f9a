"""Text, key, date and similarity expressions, all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = r"[^\p{L}\p{N}]+"


def lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


# Fixed values of the title rules: media tags and bylines, trailing links, full-width digits,
# numerals and the characters before which a numeral becomes digits.
MEDIA_TAG = r"[【〔\[［].*?[】〕\]］]|（[^）]*?報導[^）]*?）|／[^\s]{2,6}報導.*$"
LINK_SUFFIX = r"（?相關報導.*$|連結.*$|更多報導.*$"
FULL_WIDTH = "０１２３４５６７８９"
NUMERALS = {"零": "0", "一": "1", "二": "2", "三": "3", "四": "4", "五": "5", "六": "6", "七": "7", "八": "8", "九": "9", "十": "10", "百": "100", "千": "1000"}
COUNTED = "人名死傷歲輛起件條"


def title_of(text: Column) -> Column:
    """The first line."""
    return F.split_part(text, F.lit("\n"), F.lit(1))


def strip_tags(html: Column) -> Column:
    """Tags become blanks, the five common entities are decoded, white space collapses."""
    t = F.regexp_replace(html, r"<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"[\s\x{a0}]+", " "))


def escape_xml(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def normalised(text: Column) -> Column:
    """Lower case, letters, digits and underscores only."""
    return F.regexp_replace(F.trim(F.lower(text)), r"[^\p{L}\p{N}_]", "")


def fingerprint(title: Column) -> Column:
    return F.sha2(normalised(title), 256)


def synthetic_link(title: Column, source: Column, published: Column) -> Column:
    """A stable link for rows without one."""
    part = lambda c: F.regexp_replace(F.trim(F.lower(F.coalesce(c.cast("string"), F.lit("")))), r"\s+", " ")
    return F.concat(F.lit("urn:article:"), F.sha2(F.concat_ws("\u0001", part(title), part(source), part(published)), 256))


def tokens(text: Column, least: int = 2) -> Column:
    """The distinct lower-case words of at least two letters, sorted: a token set."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(text), NOT_WORD), lambda t: F.length(t) >= least)))


def words(text: Column) -> Column:
    """The default segmenter: runs of letters and digits, as they are written."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def clean_title(title: Column) -> Column:
    """A title without tags, bylines and trailing links, with plain digits."""
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"<[^>]+>", "")
    t = F.regexp_replace(F.regexp_replace(t, MEDIA_TAG, ""), LINK_SUFFIX, "")
    t = F.translate(t, FULL_WIDTH, "0123456789")
    for numeral, digits in NUMERALS.items():
        t = F.regexp_replace(t, f"{numeral}(?=[{COUNTED}])", digits)
    return F.trim(t)


def title_tokens(title: Column, segment=words) -> Column:
    """The distinct segments of at least two characters of a cleaned title, sorted.

    ``segment`` maps text to an array of segments (a pandas UDF for languages without blanks).
    """
    return F.array_sort(F.array_distinct(F.filter(segment(clean_title(title)), lambda t: F.length(t) >= 2)))


def fnv1a(text: Column, salt: int = 0) -> Column:
    """32-bit FNV-1a over code points (those past 16 bits count once), as a long; the salt is mixed into the start."""
    step = lambda h, c: ((h.bitwiseXOR(F.ascii(c).cast("long"))) * F.lit(16777619)).bitwiseAND(F.lit(4294967295))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(2166136261 ^ salt).cast("long"), step)


def join_url(base: Column, href: Column) -> Column:
    """A link as it stands on the page ``base``: absolute, of the same scheme, of the host's root, or beside the page."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, r"^([^/?#]*//[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([^?#]*/)[^/?#]*", 1)
    folder = F.when(F.length(folder) <= F.length(root), F.concat(root, F.lit("/"))).otherwise(folder)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(root, href))
        .when(href == "", base).when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href)).when(href.startswith("?"), F.concat(page, href)).otherwise(F.concat(folder, href))
    )


def forum_time(raw: Column, now: Column) -> Column:
    """``Today``, ``Yesterday`` or ``MM-DD-YYYY`` with a 12-hour clock, in Japan's time, as UTC; else null. now: UTC."""
    pattern = r"^\s*(Today|Yesterday|\d{2}-\d{2}-\d{4})\s+(\d{1,2}):(\d{2})\s*([AP])M\s*$"
    part = lambda i: F.regexp_extract(raw, pattern, i)
    today = F.to_date(now + F.expr("interval 9 hours"))
    day = F.when(part(1) == "Today", today).when(part(1) == "Yesterday", F.date_sub(today, 1)).otherwise(F.try_to_date(part(1), "MM-dd-yyyy"))
    hour, minute = part(2).try_cast("int"), part(3).try_cast("int")
    hour24 = F.pmod(hour, F.lit(12)) + F.when(part(4) == "P", 12).otherwise(0)
    at = F.unix_date(day).cast("long") * 86400 + (hour24 * 3600 + minute * 60).cast("long") - 9 * 3600
    return F.when(hour.between(1, 12) & (minute < 60), F.timestamp_seconds(at))


def jsonld_dates(html: Column) -> Column:
    """datePublished of the articles at the top of JSON-LD scripts, lists and ``@graph`` included, in order."""
    scripts = F.regexp_extract_all(html, F.lit(r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    item = "struct<`@type`: string, datePublished: string>"

    def items(s: Column) -> Column:
        one = F.from_json(s, f"struct<`@type`: string, datePublished: string, `@graph`: array<{item}>>")
        own = F.when(one["@type"].isNotNull() | one["datePublished"].isNotNull(), F.array(F.struct(one["@type"].alias("@type"), one["datePublished"].alias("datePublished"))))
        some = F.from_json(s, f"array<{item}>")
        empty = F.array().cast(f"array<{item}>")
        return F.when(F.trim(s).startswith("["), F.coalesce(some, empty)).otherwise(F.concat(F.coalesce(own.cast(f"array<{item}>"), empty), F.coalesce(one["@graph"], empty)))

    found = F.filter(F.flatten(F.transform(scripts, items)), lambda x: x["@type"].rlike(r'Article"?\]?$|Article"') & x["datePublished"].isNotNull())
    return F.transform(found, lambda x: x["datePublished"])


def aware_time(raw: Column) -> Column:
    """The instant of an ISO text with a zone; texts without one are no instant."""
    return F.when(raw.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(raw))


def page_published(html: Column) -> Column:
    """A page's own time: its meta tag, else its JSON-LD; the first that has a zone."""
    meta = F.nullif(F.regexp_extract(html, r'<meta[^>]*(?:property|name)="article:published_time"[^>]*content="([^"]*)"', 1), F.lit(""))
    return F.coalesce(aware_time(meta), F.get(F.filter(F.transform(jsonld_dates(html), aware_time), lambda t: t.isNotNull()), F.lit(0)))


#: Labels that browsers read as a superset: fixed values.
SUPERSETS = {"big5": "cp950", "shift_jis": "cp932", "gb2312": "gb18030", "gbk": "gb18030"}


def declared_charset(head: Column, default: str = "utf-8") -> Column:
    """The charset that a page's first bytes (as Latin-1 text) declare, by its superset."""
    name = F.lower(F.regexp_extract(head, r"""charset=["']?([\w-]+)""", 1))
    out = F.when(name == "", default).otherwise(name)
    for label, superset in SUPERSETS.items():
        out = F.when(name == label, superset).otherwise(out)
    return out


def jaccard(a: Column, b: Column) -> Column:
    """0 where a set is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both, F.size(a) + F.size(b) - both), F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    """0 for a zero vector; the shorter length counts."""
    n = F.least(F.size(a), F.size(b))
    dot = lambda x, y: F.aggregate(F.zip_with(F.slice(x, 1, n), F.slice(y, 1, n), lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def word_count(*parts: Column) -> Column:
    """Characters without blanks."""
    return F.length(F.replace(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), F.lit(" "), F.lit("")))


def first_hit(text: Column, needles) -> Column:
    """The first needle, in the order given, that the lower-cased text contains; null without one."""
    low = F.lower(text)
    return F.coalesce(*[F.when(F.contains(low, F.lit(n.lower())), n) for n in needles]) if needles else F.lit(None).cast("string")


def is_echo(short: Column, long: Column, room: int = 24) -> Column:
    """The long text says little more than the short one."""
    a, b = (F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), NOT_WORD, "") for c in (short, long))
    return (F.length(b) <= F.length(a) + room) & (F.contains(b, a) | F.contains(a, b))


def week_id(ts: Column, shift_hours: int = 8) -> Column:
    """ISO week like 2024-W05 of the shifted clock; null without a time."""
    local = ts + F.make_interval(hours=F.lit(shift_hours))
    return F.when(ts.isNotNull(), F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), local), F.weekofyear(local)))


def two_weeks(now: Column, shift_hours: int = 8) -> Column:
    """The ISO week of an instant and the one before it."""
    return F.array(week_id(now, shift_hours), week_id(now - F.expr("interval 7 days"), shift_hours))


def is_week_id(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\d{4}-W\d{2}$"), F.lit(False))


def week_start(ts: Column, shift_hours: int = 8) -> Column:
    return F.date_trunc("week", ts + F.make_interval(hours=F.lit(shift_hours))).cast("date")


def duration_seconds(iso: Column) -> Column:
    """Seconds of an ISO-8601 duration such as P1DT2H3M4S; 0 for parts that are missing."""
    part = lambda unit: F.coalesce(F.regexp_extract(iso, rf"(\d+){unit}", 1).try_cast("bigint"), F.lit(0))
    return part("D") * 86400 + part("H") * 3600 + part("M") * 60 + part("S")


def parse_published(raw: Column) -> Column:
    """ISO 8601, else RFC 2822 without its weekday, else null."""
    bare = F.regexp_replace(raw, r"^\w+,\s+", "")
    return F.coalesce(F.try_to_timestamp(raw), F.try_to_timestamp(bare, F.lit("dd MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(bare, F.lit("dd MMM yyyy HH:mm:ss z")))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1))


def url_date(url: Column) -> Column:
    """A day written in the path, as /Y-M-D/ (or slashes) or as eight digits between separators."""
    spelled = F.regexp_extract(url, r"/(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?:/|$)", 0)
    day = F.try_to_date(F.concat_ws("-", *[F.lpad(F.regexp_extract(url, r"/(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?:/|$)", k), 4 if k == 1 else 2, "0") for k in (1, 2, 3)]), "yyyy-MM-dd")
    packed = F.try_to_date(F.regexp_extract(url, r"[/_-](\d{8})(?:[/_.-]|$)", 1), "yyyyMMdd")
    return F.coalesce(F.when(spelled != "", day), packed)
