"""Backlink lookup: a validated request becomes one plan over the store."""

from __future__ import annotations

import json
import re
import threading
import uuid
from dataclasses import dataclass, field
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.domain import SuffixRules, load_rules
from ..functions.url import display_url

LIMIT, OVERFETCH = 100, 3
#: Seconds that a lookup may take.
TIMEOUT = 60.0
DEFAULT_ORDER = ("linkdomain", "linkpath", "linkrawquery", "pagehost", "pagepath", "pagerawquery", "datefrom", "dateto")
SORTS = {"linkUrl": DEFAULT_ORDER[:3], "pageUrl": DEFAULT_ORDER[3:6], "linkText": ("linktext",), "dateFrom": ("datefrom",), "dateTo": ("dateto",)}
#: Order among rows that agree on the keys, so that pages are repeatable.
TIEBREAK = ("linkdomain", "linksubdomain", "linkpath", "linkrawquery", "linkscheme", "pagehost", "pagepath", "pagerawquery", "pagescheme", "linktext", "nofollow", "datefrom", "dateto", "ip", "qty")
TEXT_FILTERS = {"Link Path": "linkpath", "Source Host": "pagehost", "Source Path": "pagepath", "Anchor": "linktext", "IP": "ip"}
_META = re.compile(r"[\\^$.|?*+()\[\]{}]")


class BadLookup(Exception):
    """A request that can't be answered: an HTTP status, a code and a reason."""

    def __init__(self, status: int, code: str, reason: str):
        super().__init__(reason)
        self.status, self.code, self.reason = status, code, reason


@dataclass(frozen=True)
class Filter:
    name: str
    val: str
    kind: str = "any"


@dataclass(frozen=True)
class LinkQuery:
    domain: str
    limit: int | None = None
    sort: str | None = None
    order: str | None = None
    page: int | None = None
    filters: tuple[Filter, ...] = field(default_factory=tuple)

    @classmethod
    def parse(cls, body: str) -> LinkQuery:
        """A request as JSON; an unknown field is ignored."""
        try:
            data = json.loads(body)
            made = cls(data.get("domain") or "", data.get("limit"), data.get("sort"), data.get("order"), data.get("page"), tuple(Filter(x.get("name", ""), str(x.get("val", "")), x.get("kind", "")) for x in data.get("filters") or ()))
        except (ValueError, AttributeError, TypeError) as e:
            raise BadLookup(400, "ErrorParsing", f"the request can't be parsed: {e}") from e
        return made.checked()

    def checked(self) -> LinkQuery:
        """The query with its domain as it is stored: a host name in lower case."""
        if not self.domain:
            raise BadLookup(400, "ErrorNoDomain", "a domain is required")
        host = self.domain
        if host.startswith("http"):
            try:
                host = urlsplit(host).netloc.rpartition("@")[2]
            except ValueError as e:
                raise BadLookup(400, "ErrorParsing", "the domain can't be parsed") from e
        if not re.fullmatch(r"(?i)(?:[a-z0-9](?:[a-z0-9\-]{0,61}[a-z0-9])?\.)+[a-z]{2,}", host):
            raise BadLookup(400, "ErrorInvalidDomain", "not a domain name")
        return LinkQuery(host.lower(), self.limit, self.sort, self.order, self.page, self.filters)

    @property
    def rows(self) -> int:
        return self.limit if self.limit and 0 < self.limit <= LIMIT else LIMIT

    @property
    def skipped(self) -> int:
        return ((self.page if self.page and self.page > 0 else 1) - 1) * self.rows


def split_host(host: str, rules: SuffixRules | None = None) -> tuple[str, str]:
    """(registrable domain, subdomain) of a host."""
    rules = rules or load_rules()
    labels = host.split(".")
    tails = [(".".join(labels[i:]), len(labels) - i) for i in range(len(labels))]
    n = max([1, *(k for t, k in tails if t in rules.plain), *(k + 1 for t, k in tails if t in rules.wildcard and k < len(labels))])
    n = next((k - 1 for t, k in tails if t in rules.exception), n)
    if "" in labels or len(labels) <= n:
        raise BadLookup(500, "ErrorFailedLinks", "the domain is a public suffix")
    return ".".join(labels[-n - 1 :]), ".".join(labels[: -n - 1])


def _matches(column: str, f: Filter) -> Column | None:
    if f.kind not in ("exact", "any"):
        return None
    if f.kind == "exact" and not _META.search(f.val) and f.val.isascii():
        return F.lower(column) == f.val.lower()
    try:
        re.compile(f.val)
    except re.error as e:
        raise BadLookup(400, "ErrorParsing", f"bad pattern in {f.name}: {e}") from e
    return F.col(column).rlike(f"(?i)^{f.val}$" if f.kind == "exact" else f"(?i){f.val}")


def predicate(q: LinkQuery, rules: SuffixRules | None = None) -> Column:
    """Domain and filters; of filters with one name the last counts, unknown names and kinds are ignored."""
    domain, sub = split_host(q.domain, rules)
    out = F.col("linkdomain") == domain
    if sub:
        out = out & (F.col("linksubdomain") == sub)
    chosen: dict[str, Column] = {}
    for f in q.filters:
        if f.name == "No Follow" and re.fullmatch(r"[+-]?\d+", f.val):
            chosen["nofollow"] = F.col("nofollow") == int(f.val)
        elif f.name in TEXT_FILTERS and (test := _matches(TEXT_FILTERS[f.name], f)) is not None:
            chosen[TEXT_FILTERS[f.name]] = test
    for test in chosen.values():
        out = out & test
    return out


def ordering(q: LinkQuery) -> list[Column]:
    keys = SORTS.get(q.sort or "", DEFAULT_ORDER)
    down = q.sort in SORTS and q.order == "desc"
    return [*(F.col(k).desc() if down else F.col(k).asc() for k in keys), *(F.col(k) for k in TIEBREAK if k not in keys)]


def fetch(store: DataFrame, q: LinkQuery, rules: SuffixRules | None = None) -> DataFrame:
    """The rows of a page, before merging: three times the limit, as merging shortens them."""
    return store.where(predicate(q, rules)).orderBy(*ordering(q)).offset(q.skipped).limit(OVERFETCH * q.rows)


def result_urls(rows: DataFrame) -> DataFrame:
    """rows with link_url and page_url."""
    host = F.when(F.col("linksubdomain") == "", F.col("linkdomain")).otherwise(F.concat_ws(".", "linksubdomain", "linkdomain"))
    return rows.withColumns({"link_url": display_url(F.col("linkscheme"), host, F.col("linkpath"), F.col("linkrawquery")), "page_url": display_url(F.col("pagescheme"), F.col("pagehost"), F.col("pagepath"), F.col("pagerawquery"))})


def merge(rows: DataFrame, q: LinkQuery, as_coded: bool = False) -> DataFrame:
    """Adjacent rows with one link, page, text and nofollow flag become one result; at most `q.rows` results.

    Dates widen, addresses are joined in their order, quantities add up.  as_coded: dates narrow and the last result is
    lost.  The input is one page of rows, so the windows without partitions are small.
    """
    every = Window.orderBy(*ordering(q))
    same = [F.lag(c).over(every).eqNullSafe(F.col(c)) for c in ("link_url", "page_url", "linktext", "nofollow")]
    rows = result_urls(rows).withColumn("rn", F.row_number().over(every)).withColumn("starts", F.when((F.col("rn") > 1) & same[0] & same[1] & same[2] & same[3], 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("starts").over(every))
    if as_coded:
        rows = rows.withColumn("last", F.max("run").over(Window.partitionBy())).where("run < last")
    low, high = (F.max, F.min) if as_coded else (F.min, F.max)
    first = lambda c: F.min_by(c, "rn").alias(c)
    out = rows.groupBy("run").agg(
        first("link_url"), first("page_url"), F.min_by("linktext", "rn").alias("link_text"), F.min_by("nofollow", "rn").alias("no_follow"), F.min_by("noindex", "rn").alias("no_index"),
        low("datefrom").alias("date_from"), high("dateto").alias("date_to"), F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("rn", "ip"))), lambda x: x["ip"])).alias("ip"), F.sum("qty").cast("int").alias("qty"),
    )
    return out.orderBy("run").limit(q.rows)


def backlinks(store: DataFrame, q: LinkQuery, as_coded: bool = False, rules: SuffixRules | None = None) -> DataFrame:
    """The answer to a request, in order of `run`."""
    return merge(fetch(store, q.checked(), rules), q.checked(), as_coded)


def collected(rows: DataFrame, seconds: float = TIMEOUT) -> list:
    """The rows, or BadLookup if that takes longer: the jobs are cancelled then."""
    context, tag, late = rows.sparkSession.sparkContext, f"lookup-{uuid.uuid4().hex}", threading.Event()

    def cancel() -> None:
        late.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, cancel)
    context.addJobTag(tag)
    timer.start()
    try:
        return rows.collect()
    except Exception as e:
        if late.is_set():
            raise BadLookup(500, "ErrorFailedLinks", f"the lookup took more than {seconds} s") from e
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)


def answer(store: DataFrame, body: str, seconds: float = TIMEOUT) -> tuple[int, str]:
    """An HTTP status and a JSON body for a request's JSON; at most a page of results reaches the driver."""
    try:
        found = backlinks(store, LinkQuery.parse(body)).drop("run")
        rows = collected(found.select(F.to_json(F.struct(*found.columns)).alias("j")), seconds)
        return 200, "[" + ",".join(r["j"] for r in rows) + "]"
    except BadLookup as e:
        return e.status, json.dumps({"error_code": e.code, "function": "lookup", "error": e.reason})
