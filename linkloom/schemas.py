"""Row layouts: the WAT envelope, link and page lines, compacted links, results."""

from __future__ import annotations

#: Of the JSON metadata record, only what is read.
ENVELOPE = """Envelope struct<
  `WARC-Header-Metadata`: struct<`WARC-IP-Address`: string, `WARC-Date`: string>,
  `Payload-Metadata`: struct<`HTTP-Response-Metadata`: struct<`HTML-Metadata`: struct<
    Links: array<struct<path: string, url: string, text: string, rel: string>>,
    Head: struct<Title: string, Metas: array<struct<name: string, content: string, property: string>>,
                 Link: array<struct<path: string, url: string, rel: string, type: string>>>>>>>"""

LINK14 = ("linkdomain", "linksubdomain", "linkpath", "linkrawquery", "linkscheme", "pagehost", "pagepath", "pagerawquery", "pagescheme", "linktext", "nofollow", "noindex", "imported", "ip")
PAGE10 = ("host", "path", "raw_query", "scheme", "title", "ip", "imported", "internal_links", "external_links", "noindex")
COMPACT16 = (*LINK14[:12], "datefrom", "dateto", "ip", "qty")
INTEGERS = frozenset(("nofollow", "noindex", "qty", "internal_links", "external_links"))
