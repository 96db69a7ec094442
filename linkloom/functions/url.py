"""URL splitting and URL tests as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import IGNORED_QUERIES

#: Scheme, authority, path, query and fragment (RFC 3986, appendix B).
_PARTS = r"(?s)^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*$"
#: What a host with an optional port may look like: letters, digits and marks, other alphabets, an address in brackets.
_AUTHORITY = r"^(?:[^\x00-\x20\x7F\"<>\[\]\\^`{|}#?/@]*|\[[0-9A-Fa-f:.%]*\])(?::\d*)?$"


def scheme_code(scheme: Column) -> Column:
    """'2' for https, '1' for http, '0' for anything else."""
    return F.when(scheme == "https", "2").when(scheme == "http", "1").otherwise("0")


def blank_query(query: Column) -> Column:
    """The query, or '' if its first parameter is one that doesn't change the page."""
    return F.when(query.rlike("^(?:" + "|".join(IGNORED_QUERIES) + ")"), "").otherwise(query)


def decoded_path(path: Column) -> Column:
    """A percent-decoded path; null if an escape is broken.  A plus sign stays."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def url_record(url: Column) -> Column:
    """url -> struct(url, scheme, host, path, raw_query, fragment), or null for a URL that can't be used.

    Unusable: line breaks or control characters, a bad scheme, host or port, a broken escape, or a line break or bar
    in the decoded path.  The host keeps its port and is lower-cased, the path is decoded and not empty.
    """
    part = lambda i: F.regexp_extract(url, _PARTS, i)
    scheme, authority = F.lower(part(1)), F.regexp_replace(part(2), r"^.*@", "")
    path = decoded_path(part(3))
    good = ~url.rlike(r"[\x00-\x1F\x7F]") & ((scheme == "") | scheme.rlike(_SCHEME)) & authority.rlike(_AUTHORITY) & path.isNotNull() & ~path.rlike(r"[\n|]")
    record = F.struct(
        url.alias("url"), scheme_code(scheme).alias("scheme"), F.lower(F.trim(authority)).alias("host"),
        F.when(path == "", "/").otherwise(path).alias("path"), blank_query(part(4)).alias("raw_query"), part(5).alias("fragment"),
    )
    return F.when(good, record)


def subdomain(host: Column, domain: Column) -> Column:
    """What stands before the registrable domain, '' if nothing does."""
    return F.when(host == domain, "").otherwise(F.substring(host, F.lit(1), F.length(host) - F.length(domain) - 1))


def path_extension(path: Column) -> Column:
    """The last '.' of the last path segment and what follows, in lower case; '' without one."""
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))


def clean_text(text: Column) -> Column:
    """Text without the field separator."""
    return F.translate(text, "|", " ")


def display_url(scheme: Column, host: Column, path: Column, query: Column) -> Column:
    """A URL put together again; anything but http counts as https."""
    return F.concat(F.when(scheme == "1", "http").otherwise("https"), F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def iso_date(stamp: Column) -> Column:
    """yyyy-MM-dd of a strict UTC time stamp, else null."""
    strict = stamp.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    return F.when(strict & F.try_to_timestamp(F.regexp_replace(stamp, "[TZ]", " "), F.lit("yyyy-MM-dd HH:mm:ss ")).isNotNull(), F.substring(stamp, 1, 10))
