"""WAT records -> pages and external links.

All tests and counters of a page are taken in its own row with higher-order functions, so the only shuffles are those of
the two last-wins de-duplications and their join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.domain import SuffixRules, registrable_domain_sql
from ..functions.robots import canonical_agrees, link_nofollow, robots_flag
from ..functions.url import clean_text, iso_date, subdomain, url_record
from ..schemas import ENVELOPE, LINK14, PAGE10
from .predicates import is_good_record, link_outcome, raises

_HTML = "e.Envelope.`Payload-Metadata`.`HTTP-Response-Metadata`.`HTML-Metadata`"
_HEADER = "e.Envelope.`WARC-Header-Metadata`"


def with_address(rows: DataFrame, url: str, out: str, rules: SuffixRules | None = None) -> DataFrame:
    """rows with `out`: struct(u, domain, good) of a column of URLs.

    Each step reads the one before only once, inside a lambda, so that no optimizer rule that moves expressions about
    can multiply the work.
    """
    rows = rows.withColumn(out, url_record(F.col(url)))
    rows = rows.withColumn(out, F.expr(f"transform(array({out}), u -> named_struct('u', u, 'domain', {registrable_domain_sql('u.host', rules)}))"))
    good = lambda x: F.coalesce(x["u"].isNotNull(), F.lit(False)) & is_good_record(x["domain"], x["u"]["host"], x["u"]["raw_query"])
    return rows.withColumn(out, F.get(F.transform(out, lambda x: F.struct(x["u"].alias("u"), x["domain"].alias("domain"), good(x).alias("good"))), F.lit(0)))


def judged_pages(records: DataFrame, rules: SuffixRules | None = None) -> DataFrame:
    """records (wat_file, pos, uri, json) -> a row for each page that passes the page tests, with `links`, each with its outcome.

    The tests on the address come before the JSON is parsed.  A page without a valid date is dropped.
    """
    page = records.where(F.col("uri").startswith("http") & F.col("json").startswith("{") & F.col("json").contains("href"))
    page = with_address(page, "uri", "a", rules).where("a.good")
    page = page.withColumn("e", F.from_json("json", ENVELOPE)).select("wat_file", "pos", F.col("a.u").alias("u"), F.col("a.domain").alias("domain"), F.expr(_HTML).alias("html"), F.expr(f"{_HEADER}.`WARC-IP-Address`").alias("ip"), iso_date(F.expr(f"{_HEADER}.`WARC-Date`")).alias("imported"))
    page = page.where(F.col("imported").isNotNull() & (F.size("html.Links") > 0))
    page = page.withColumns({"noindex": robots_flag(F.col("html.Head.Metas"), "noindex"), "page_nofollow": robots_flag(F.col("html.Head.Metas"), "nofollow")}).where("noindex = 0")
    page = page.where(canonical_agrees(F.col("html.Head.Link"), F.col("u.host"), F.col("u.path"), F.col("u.raw_query")))
    # in steps, so that no step's work is repeated inside the next one's lambda
    page = page.withColumn("links", F.transform("html.Links", lambda x: F.struct(x.alias("x"), F.when(x["url"].startswith("http") | x["url"].startswith("//"), url_record(x["url"])).alias("u"))))
    page = page.withColumn("links", F.expr(f"transform(links, l -> struct(l.x AS x, l.u AS u, {registrable_domain_sql('l.u.host', rules)} AS domain))"))
    judge = lambda l: link_outcome(l["x"]["path"], l["x"]["url"], l["u"], l["domain"], F.col("u.host"), F.col("domain"))
    return page.withColumn("links", F.transform("links", lambda l: F.struct(l["x"].alias("x"), l["u"].alias("u"), l["domain"].alias("domain"), judge(l).alias("outcome"))))


def parse_pages(records: DataFrame, rules: SuffixRules | None = None) -> DataFrame:
    """The judged pages that keep a link, with their counters and `kept`, the links that stay."""
    page = judged_pages(records, rules)
    count = lambda what: F.size(F.filter("links", lambda l: raises(l["outcome"], what)))
    page = page.withColumns({"internal_links": count("internal"), "external_links": count("external")})
    page = page.withColumn("kept", F.expr("filter(transform(links, (l, i) -> struct(i AS idx, l.x AS x, l.u AS u, l.domain AS domain, l.outcome AS outcome)), l -> l.outcome = 'keep')")).where(F.size("kept") > 0)
    return page.withColumn("title", clean_text(F.coalesce("html.Head.Title", F.lit("")))).withColumn("page_key", F.concat("u.host", "u.path", "u.raw_query")).drop("links", "html")


def page_rows(parsed: DataFrame) -> DataFrame:
    """The last page of each page key in each file, with its key and position."""
    row = F.struct(F.col("u.host").alias("host"), F.col("u.path").alias("path"), F.col("u.raw_query").alias("raw_query"), F.col("u.scheme").alias("scheme"), "title", F.coalesce("ip", F.lit("")).alias("ip"), "imported", "internal_links", "external_links", "noindex")
    return parsed.groupBy("wat_file", "page_key").agg(F.max_by(row, F.col("pos")).alias("p")).select("wat_file", "page_key", "p.*")


def link_rows(parsed: DataFrame) -> DataFrame:
    """The last link of each link key in each file: link columns and the key of its page."""
    one = parsed.select("wat_file", "pos", "page_key", F.col("page_nofollow"), F.explode("kept").alias("l"))
    link = F.struct(
        F.col("l.domain").alias("linkdomain"), subdomain(F.col("l.u.host"), F.col("l.domain")).alias("linksubdomain"), F.col("l.u.path").alias("linkpath"), F.col("l.u.raw_query").alias("linkrawquery"),
        F.col("l.u.scheme").alias("linkscheme"), clean_text(F.coalesce("l.x.text", F.lit(""))).alias("linktext"), link_nofollow(F.col("page_nofollow"), F.col("l.x.rel")).alias("nofollow"), "page_key",
    )
    one = one.select("wat_file", F.concat("l.u.host", "l.u.path", "l.u.raw_query", "page_key").alias("link_key"), F.struct("pos", "l.idx").alias("at"), link.alias("row"))
    return one.groupBy("wat_file", "link_key").agg(F.max_by("row", "at").alias("r")).select("wat_file", "r.*")


def extract(records: DataFrame, rules: SuffixRules | None = None) -> tuple[DataFrame, DataFrame]:
    """records -> (pages with the PAGE10 columns, links with the LINK14 columns), both with wat_file.

    A link takes scheme, date, address and noindex from the last page that has its page key.
    """
    parsed = parse_pages(records, rules)
    pages = page_rows(parsed)
    side = pages.select("wat_file", "page_key", F.col("host").alias("pagehost"), F.col("path").alias("pagepath"), F.col("raw_query").alias("pagerawquery"), F.col("scheme").alias("pagescheme"), "noindex", "imported", "ip")
    links = link_rows(parsed).join(side, ["wat_file", "page_key"]).select("wat_file", *LINK14)
    return pages.select("wat_file", *PAGE10), links
