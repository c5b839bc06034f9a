"""Fetch and a parser for the feed source's tests: a file by the path in its address."""

import os

from newsloom.sources import feeds


def fetch(url):
    path = url.removeprefix("http://h")
    if not os.path.exists(path):
        return 404, ""
    with open(path, encoding="utf-8") as f:
        return 200, f.read()


def lines(body, source):
    for x in body.splitlines():
        yield {"title": x, "link": f"urn:{x}", "summary": "", "guid": x, "image_url": "", "published": None}


feeds.register_type("lines", lines)
