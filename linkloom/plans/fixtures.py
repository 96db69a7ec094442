"""Inputs that are derived from the given tables, as SQL that Spark and DuckDB both run, and literal tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LINK14

_own: dict[str, str] = {}
LINK14_SQL = """
SELECT 'd' || CAST(p % 40 AS STRING) || CASE p % 4 WHEN 0 THEN '.com' WHEN 1 THEN '.co.uk' WHEN 2 THEN '.net' ELSE '.org' END AS linkdomain,
       CASE n % 3 WHEN 0 THEN 'www' WHEN 1 THEN '' ELSE 'blog' END AS linksubdomain,
       CASE p % 3 WHEN 0 THEN '/' WHEN 1 THEN '/x' ELSE '/xy' END AS linkpath,
       CASE WHEN p % 5 = 0 THEN 'p=' || CAST(p % 2 AS STRING) ELSE '' END AS linkrawquery,
       CASE WHEN o % 4 = 0 THEN '1' ELSE '2' END AS linkscheme,
       'h' || CAST(s % 20 AS STRING) || '.example.net' AS pagehost,
       '/' || repeat('a', CAST(o % 5 AS INT)) AS pagepath,
       CASE WHEN o % 7 < 3 THEN 'q=' || repeat('1', CAST(o % 7 AS INT)) ELSE '' END AS pagerawquery,
       CASE WHEN o % 2 = 0 THEN '1' ELSE '2' END AS pagescheme,
       'text ' || CAST(n AS STRING) AS linktext,
       CASE WHEN rf = 'R' THEN 1 ELSE 0 END AS nofollow,
       0 AS noindex, d AS imported,
       '10.0.' || CAST(s % 4 AS STRING) || '.' || CAST(n AS STRING) AS ip
FROM (SELECT l_orderkey o, l_partkey p, l_suppkey s, l_linenumber n, l_returnflag rf, CAST(CAST(l_shipdate AS DATE) AS STRING) d FROM lineitem) b
"""
EDGES_SQL = """
SELECT p.page_id, p.url AS page_url, t.url AS link_url,
       'anchor ' || CAST((p.page_id + k.k) % 11 AS STRING) AS link_text,
       CASE (p.page_id + k.k) % 4 WHEN 0 THEN 'nofollow' WHEN 1 THEN 'noopener nofollow' ELSE '' END AS rel, k.k AS pos
FROM pages p
CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) k
JOIN pages t ON t.page_id = (p.page_id * 7 + k.k * 13 + 1) % (SELECT count(*) FROM pages)
"""

# Cases for the string tests.
HOSTS = ("example.com", "localhost", "192.168.0.1", "example.com%", "a.b.co.uk", "x:8080", "foo.bar:80", "1.2.3", "256.1.1.1", "sub.example.org", "with space.com", "quote'.com", "under_score.com", "", "01.02.03.004", "1.2.3.4", "0.0.0.0", "10.20.30.256", "1.2.3.4.5", "tick`.com", "199.99.9.249")
DOMAINS = ("example.com", "Example.COM", "localhost", "-bad.com", "bad-.com", "a.b.c.museum", "xn--bcher-kva.de", "a.xn--p1ai", "under_score.com", "1.2.3.4", "x.c", "")
ENDINGS = ("example.cn", "site.cn", "domain.com.cn", "website.com", "info.co.uk", "me.blogspot.com", "blogspot.com", "EXAMPLE.CN", "cn")
QUERIES = ("lang=en", "utm_source=google", "ref=123", "page=1", "category=books", "a|b", "x" * 200, "x" * 201, "é" * 101, "", "preflang=1")
PATHS = ("/image.jpg", "/document.pdf", "/photo.jpeg", "/picture.JPG", "/script.php", "/test", "/a.b/c", "/", "/x.tar.gz", "/.png", "/dir.zip/")
STAMPS = ("2021-01-15T13:41:01Z", "2021-02-30T00:00:00Z", "2021-01-15", "2021-01-15T13:41:01+00:00", "", "1999-12-31T23:59:59Z")
ARCHIVES = ("CC-MAIN-2023-01", "CC-MAIN-2023-12", "CC-MAIN-2023", "CC-MAIN-23-01", "CC-MAIN-202301", "XX-MAIN-2023-01", "CC-MAIN-2023-123")
METAS = ("[]", '[{"name":"robots","content":"noindex, nofollow"}]', '[{"name":"robots","content":"noindex"}]', '[{"name":"robots","content":"nofollow"}]', '[{"name":"robots","content":"index, follow"}]', '[{"name":"viewport","content":"noindex"}]', '[{"name":"viewport","content":"x"},{"name":"robots","content":"nofollow"}]')
CANONICAL = (
    ("example.com", "/page", "", "canonical", "http://example.com/page"), ("example.com", "/page", "", "canonical", "http://example.org/page"), ("example.com", "/page", "", "canonical", "//example.com/page"),
    ("example.com", "/page", "a=1", "canonical", "http://example.com/page"), ("example.com", "/page", "", "canonical", "/page"), ("example.com", "/page", "", "canonical", "/other"), ("example.com", "/", "", "canonical", "https://example.com"),
    ("example.com", "/page", "", "next", "http://example.org/other"), ("example.com", "/page", "", "canonical", ""), ("example.com", "/page", "", "canonical", "http://EXAMPLE.com/page"),
)
MANIFEST = tuple(f"crawl-data/CC-MAIN-2021-04/segments/{s}/wat/CC-MAIN-20210115134101-20210115164101-{n:05d}.warc.wat.gz" for s in ("1610703495901.0", "1610703495936.3", "1610703496947.2") for n in (10, 11, 12)) + ("short/line", "")
EVENTS = (("1610703495901.0", "start", 1), ("1610703495901.0", "end", 9), ("1610703495936.3", "start", 5), ("1610703495936.3", "start", 3))
DONE = (("1610703495901.0", "00010"), ("1610703495901.0", "00011"), ("1610703495901.0", "00012"), ("1610703495936.3", "00011"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def links14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINK14_SQL.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


def edges(spark: SparkSession, sf_dir: str, add: Callable[[DataFrame], DataFrame] = lambda pages: pages) -> DataFrame:
    """The rows of EDGES_SQL.  A column c that `add` adds to pages is taken once for each page and comes as page_c and link_c.

    The five rows of a page are exploded, so that the join has two sides only: of three, a filter over both pages' columns
    became the condition of the first join, which then went through all pairs of pages.
    """
    pages = add(table(spark, sf_dir, "pages").select("page_id", "url"))
    names = [c for c in pages.columns if c != "page_id"]
    rows = pages.select("page_id", F.explode(F.array(*map(F.lit, range(5)))).alias("pos"), *[F.col(c).alias(f"page_{c}") for c in names])
    rows = rows.withColumn("at", (F.col("page_id") * 7 + F.col("pos") * 13 + 1) % pages.agg(F.count(F.lit(1))).scalar())
    rows = rows.join(pages.select(F.col("page_id").alias("at"), *[F.col(c).alias(f"link_{c}") for c in names]), "at").drop("at")
    key = F.col("page_id") + F.col("pos")
    rel = F.when(key % 4 == 0, "nofollow").when(key % 4 == 1, "noopener nofollow").otherwise("")
    return rows.withColumns({"link_text": F.concat(F.lit("anchor "), (key % 11).cast("string")), "rel": rel})


def literal(spark: SparkSession, rows, columns: str) -> DataFrame:
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], columns)


def values(rows, *columns: str) -> str:
    """The rows as a SQL table expression."""
    quoted = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(quoted(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows) + f") AS t({', '.join(columns)})"


def as_line(columns=LINK14) -> str:
    return "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in columns) + ")"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    app = spark.sparkContext.applicationId
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="linkloom-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        where = _own[app]
    return f"{where.rstrip('/')}/{app}/{name}-{uuid.uuid4().hex[:12]}"
