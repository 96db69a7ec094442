"""Tests on hosts, domains, queries and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import IGNORED_DOMAINS, IGNORED_ENDINGS, IGNORED_EXTENSIONS, MAX_QUERY_BYTES
from ..functions.url import path_extension

# The marks that no host has, and the patterns of IPv4 addresses (no leading zeros) and domains.
_BAD_HOST = r"""[%\[\]=':*()<>!&+,}{$";`]"""
_DOTTED_QUAD = r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]\d|\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]\d|\d)\z"
_DOMAIN = r"(?i)^(?:[a-z0-9](?:[a-z0-9\-]{0,61}[a-z0-9])?\.)+[a-z]{2,}\z"

#: What becomes of a link, in the order of the tests, and the page counter that it raises.
COUNTED = {"not_anchor": None, "relative": "internal", "invalid": None, "same_host": "internal", "same_domain": "external", "low_quality": "external", "extension": None, "ignored_domain": "external", "keep": "external"}


def has_ignored_ending(domain: Column) -> Column:
    low = F.lower(domain)
    return low.endswith(IGNORED_ENDINGS[0]) | low.endswith(IGNORED_ENDINGS[1])


def is_host(host: Column) -> Column:
    """No odd characters, no IPv4 address, and a dot."""
    return ~host.rlike(_BAD_HOST) & ~host.rlike(_DOTTED_QUAD) & host.contains(".")


def is_domain(domain: Column) -> Column:
    """Labels of letters, digits and inner hyphens, and an alphabetic last label."""
    return domain.rlike(_DOMAIN)


def is_good_query(query: Column) -> Column:
    return (F.octet_length(query) <= MAX_QUERY_BYTES) & ~query.contains("|")


def is_good_record(domain: Column, host: Column, query: Column) -> Column:
    """The tests that pages and links share; null counts as a failure."""
    good = (domain != "") & ~has_ignored_ending(domain) & is_host(host) & is_domain(domain) & is_good_query(query)
    return F.coalesce(good, F.lit(False))


def has_ignored_extension(path: Column) -> Column:
    return path_extension(path).isin(*IGNORED_EXTENSIONS)


def is_ignored_domain(domain: Column) -> Column:
    return F.lower(domain).isin(*IGNORED_DOMAINS)


def link_outcome(tag: Column, raw_url: Column, record: Column, domain: Column, page_host: Column, page_domain: Column) -> Column:
    """The first test that a link fails, or keep; a key of COUNTED."""
    return (
        F.when(~tag.eqNullSafe("A@/href"), "not_anchor")
        .when(~F.coalesce(raw_url.startswith("http") | raw_url.startswith("//"), F.lit(False)), "relative")
        .when(record.isNull() | domain.isNull(), "invalid")
        .when(record["host"] == page_host, "same_host")
        .when(domain == page_domain, "same_domain")
        .when(~is_good_record(domain, record["host"], record["raw_query"]), "low_quality")
        .when(has_ignored_extension(record["path"]), "extension")
        .when(is_ignored_domain(domain), "ignored_domain")
        .otherwise("keep")
    )


def raises(outcome: Column, counter: str) -> Column:
    """Whether an outcome raises the page's counter `internal` or `external`."""
    return outcome.isin(*[k for k, v in COUNTED.items() if v == counter])
