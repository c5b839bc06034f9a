"""Feeds as a Spark data source: a partition a feed, read in batch or as a stream.

    spark.dataSource.register(FeedSource)
    spark.read.format("newsloom_feeds").option("sources", json.dumps([...])).option("fetch", "module:function").load()
    spark.readStream.format("newsloom_feeds")...    # goes on after the last item of each feed

``fetch(url) -> (status, body)`` is named, not passed, so that executors import it themselves; nothing else
reaches a network. Each feed is read by the parser of its type (``TYPES``, ``register_type``); feeds of
unknown types and disabled ones are left out. A feed that fails gives one row with ``error`` and the others
go on. Every item carries what its feed's entry says: type, weight, look-back days, exemption, content type.
"""

from __future__ import annotations

import importlib
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime
from html import unescape

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from newsloom.functions import markup

SCHEMA = (
    "source string, type string, title string, link string, summary string, published timestamp, image_url string, guid string, content_type string, source_weight double, lookback_days int, "
    "relevance_exempt boolean, error string"
)
Parser = Callable[[str, dict], Iterator[dict]]


def parse_time(text: str | None) -> datetime | None:
    """RFC 822 or ISO 8601 as UTC without a zone; null for others."""
    text = (text or "").strip()
    for read in (parsedate_to_datetime, lambda x: datetime.fromisoformat(x.replace("Z", "+00:00"))):
        try:
            t = read(text)
            return (t if t.tzinfo else t.replace(tzinfo=timezone.utc)).astimezone(timezone.utc)
        except (ValueError, TypeError, IndexError):
            continue
    return None


def _plain(html: str) -> str:
    return re.sub(r"[\s\xa0]+", " ", unescape(re.sub(r"<[^>]*>", " ", html))).strip()[:500]


def image_of(item: ET.Element, html: str) -> str:
    """Media fields first, then enclosed images, then the first image of the text; only web addresses."""
    name = lambda e: e.tag.rpartition("}")[2]
    found = [e.get("url", "") for kind in ("thumbnail", "content") for e in item.iter() if name(e) == kind and "}" in e.tag]
    found += [e.get("url") or e.get("href") or "" for e in item.iter() if (name(e) == "enclosure" or (name(e) == "link" and e.get("rel") == "enclosure")) and e.get("type", "").startswith("image")]
    found += [attrs.get("src", "") for _, _, attrs, _ in markup.select(html, "img[src]")][:1]
    return next((u.strip() for u in found if u.strip().startswith("http")), "")


def parse_feed(body: str, source: dict) -> Iterator[dict]:
    """Items of RSS (also RDF) and entries of Atom, in the feed's order."""
    root = ET.fromstring(body)
    for item in root.iter():
        kind = item.tag.rpartition("}")[2]
        if kind not in ("item", "entry"):
            continue
        own: dict[str, str] = {}
        link = ""
        for e in item:
            key = e.tag.rpartition("}")[2]
            if key == "link" and e.get("href"):
                if e.get("rel", "alternate") == "alternate":
                    link = link or e.get("href", "")
            elif "}" not in e.tag or kind == "entry" or key in ("date", "encoded"):
                own.setdefault(key, "".join(e.itertext()))
        html = own.get("description") or own.get("summary") or own.get("content") or own.get("encoded") or ""
        guid = (own.get("guid") or own.get("id") or "").strip()
        yield {
            "title": own.get("title", "").strip(), "link": (link or own.get("link", "")).strip() or guid, "summary": _plain(html), "guid": guid, "image_url": image_of(item, html),
            "published": parse_time(own.get("pubDate") or own.get("published") or own.get("updated") or own.get("date")),
        }


def parse_page(body: str, source: dict) -> Iterator[dict]:
    """Anchors of a page, chosen by the entry's ``selector``, that name one of its ``keywords``; each address once."""
    seen, words = set(), [w.lower() for w in source.get("keywords") or []]
    for _, _, attrs, text in markup.select(body, source.get("selector") or "a[href]"):
        link = attrs.get("href", "").strip()
        if link and link not in seen and len(text) >= 5 and (not words or any(w in text.lower() for w in words)):
            seen.add(link)
            yield {"title": text, "link": link, "summary": f"{source['name']} 官方公告", "guid": link, "image_url": "", "published": None}


TYPES: dict[str, Parser] = {"rss": parse_feed, "atom": parse_feed, "web": parse_page}


def register_type(name: str, parser: Parser) -> None:
    """A parser for feeds of a type; on a cluster call it where executors import it too (``parsers`` option: module)."""
    TYPES[name] = parser


@dataclass
class Feed(InputPartition):
    entry: dict
    after: str = ""
    upto: str = ""


def _fetcher(name: str) -> Callable[[str], tuple[int, str]]:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _entries(options) -> list[dict]:
    if options.get("parsers"):
        importlib.import_module(options["parsers"])
    named = json.loads(options["sources"])
    return [s for s in named if s.get("enabled", True) and s.get("type") in TYPES and s.get("url")]


def _items(entry: dict, fetch: Callable[[str], tuple[int, str]]) -> list[dict]:
    status, body = fetch(entry["url"])
    if status != 200:
        raise OSError(f"status {status}")
    return list(TYPES[entry["type"]](body, entry))


def _row(entry: dict, item: dict, error: str | None = None) -> tuple:
    get = item.get
    return (
        entry["name"], entry["type"], get("title"), get("link"), get("summary"), get("published"), get("image_url"), get("guid"), entry.get("content_type"),
        None if entry.get("weight") is None else float(entry["weight"]), entry.get("lookback_days"), bool(entry.get("relevance_exempt", False)), error,
    )


def _place(item: dict) -> str:
    """What orders a feed's items: the time, then the link; items without a time come first."""
    at = item.get("published")
    return f"{at.isoformat() if at else ''} {item.get('link') or ''}"


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.options = options

    def partitions(self) -> list[Feed]:
        return [Feed(s) for s in _entries(self.options)] or [Feed({})]

    def read(self, partition: Feed) -> Iterator[tuple]:
        if partition.entry:
            _entries(self.options)  # parsers of its own are imported here too
            try:
                items = _items(partition.entry, _fetcher(self.options["fetch"]))
            except Exception as e:  # the row says what went wrong
                yield _row(partition.entry, {}, f"{type(e).__name__}: {e}")
                return
            for item in items:
                yield _row(partition.entry, item)


class _StreamReader(DataSourceStreamReader):
    """Offsets: the place of each feed's last item. A feed that fails keeps its place and is tried again."""

    def __init__(self, options) -> None:
        self.options = options
        self.known: dict[str, str] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        for s in _entries(self.options):
            try:
                places = [_place(x) for x in _items(s, _fetcher(self.options["fetch"]))]
            except Exception:  # noqa: S112  no news from it in this batch
                continue
            self.known[s["name"]] = max([self.known.get(s["name"], ""), *places])
        return dict(self.known)

    def partitions(self, start: dict, end: dict) -> list[Feed]:
        # what a restarted query knows comes from its checkpoint
        self.known = {k: max(v, self.known.get(k, "")) for k, v in {**self.known, **end}.items()}
        return [Feed(s, start.get(s["name"], ""), end[s["name"]]) for s in _entries(self.options) if s["name"] in end and end[s["name"]] > start.get(s["name"], "")] or [Feed({})]

    def read(self, partition: Feed) -> Iterator[tuple]:
        if partition.entry:
            _entries(self.options)
            for item in _items(partition.entry, _fetcher(self.options["fetch"])):
                if partition.after < _place(item) <= partition.upto:
                    yield _row(partition.entry, item)

    def commit(self, end: dict) -> None:
        pass


class FeedSource(DataSource):
    """Options: sources (a JSON list of name, type, url and stamps), fetch (``module:function``), parsers (a module)."""

    @classmethod
    def name(cls) -> str:
        return "newsloom_feeds"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options)
