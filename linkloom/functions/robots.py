"""Robots directives and canonical links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .url import decoded_path


def robots_flag(metas: Column, word: str) -> Column:
    """1 if a meta element named exactly `robots` has the word in its content, else 0; null metas count as none."""
    hit = F.exists(metas, lambda m: (m["name"] == "robots") & m["content"].contains(word))
    return F.coalesce(hit, F.lit(False)).cast("int")


def link_nofollow(page_nofollow: Column, rel: Column) -> Column:
    """1 if the page says so or the relation begins with nofollow."""
    return F.greatest(page_nofollow, F.coalesce(rel.startswith("nofollow"), F.lit(False)).cast("int"))


def canonical_agrees(head_links: Column, host: Column, path: Column, query: Column) -> Column:
    """Whether all canonical links of a page point at the page itself.

    An absolute one must have the page's host (compared as it is written) and path; a relative one is compared as a
    whole; with any canonical link, the page must not have a query.
    """

    def agrees(x: Column) -> Column:
        url = x["url"]
        part = lambda i: F.regexp_extract(url, r"(?s)^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)", i)
        absolute = url.startswith("http") | url.startswith("//")
        target = F.when(absolute, decoded_path(part(2))).otherwise(url)
        target = F.when(target == "", "/").otherwise(target)
        same_host = ~absolute | (F.regexp_replace(part(1), "^.*@", "") == host)
        good = ~url.rlike(r"[\x00-\x1F\x7F]") & decoded_path(part(2)).isNotNull() & same_host & (target == path) & (query == "")
        canonical = F.coalesce((x["rel"] == "canonical") & (url != ""), F.lit(False))
        return ~canonical | F.coalesce(good, F.lit(False))

    return F.coalesce(F.forall(head_links, agrees), F.lit(True))
