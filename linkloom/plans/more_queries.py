"""Queries over generated WAT files, written stores, logs and requests, with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import url
from ..functions.domain import SuffixRules, registrable_domain
from ..operators import catalog, extract, lookup
from ..schemas import COMPACT16, LINK14, PAGE10
from ..sources.readers import parse_lines, read_compact, read_lines, read_links, read_pages, read_wat
from ..sources.writers import as_lines, write_lines, write_store
from ..streaming.ingest import start_ingest
from ..streaming.ratelimit import limited_stream
from .fixtures import DONE, LINK14_SQL, MANIFEST, as_line, links14, literal, scratch, table, values
from .queries import _C16, _COMPACT, _FILES, _LIMIT, _RATE, _SECONDS, _compact_of, _D, _numbered, _order, _page, _store
from .registry import query
from .segment import import_segment, write_by_file
from .wat_fixture import GOOD_DOMAIN, LINKS_SQL, PAGES_SQL, WAT_SQL, _fields, file_name, wat_text, write_wat

_SEGMENT = "1610703495901.0"


# --- WAT files -------------------------------------------------------------------------------------------------------
@query("wat_scan", f"WITH {WAT_SQL} SELECT uri, md5(json) AS json_md5 FROM scan")
def _(spark, sf_dir):
    return read_wat(spark, write_wat(spark, sf_dir)).select("uri", F.md5("json").alias("json_md5"))


@query("wat_pages", f"WITH {WAT_SQL} {PAGES_SQL}")
def _(spark, sf_dir):
    return extract.extract(read_wat(spark, write_wat(spark, sf_dir)))[0].drop("wat_file")


@query("wat_extract", f"WITH {WAT_SQL} {LINKS_SQL}")
def _(spark, sf_dir):
    return extract.extract(read_wat(spark, write_wat(spark, sf_dir)))[1].drop("wat_file")


@query("wat_outcomes", f"WITH {WAT_SQL} SELECT uri, idx, outcome FROM link JOIN (SELECT page_id, uri FROM page) USING (page_id)")
def _(spark, sf_dir):
    judged = extract.judged_pages(read_wat(spark, write_wat(spark, sf_dir)))
    return judged.select(F.col("u.url").alias("uri"), F.posexplode("links").alias("idx", "l")).select("uri", F.col("idx").cast("bigint").alias("idx"), "l.outcome")


@query("stream_ingest", f"WITH {WAT_SQL} {LINKS_SQL}")
def _(spark, sf_dir):
    source, links, state = write_wat(spark, sf_dir), scratch(spark, "links"), scratch(spark, "state")
    start_ingest(spark, source, links, state).awaitTermination()
    return spark.read.parquet(links).drop("batch", "wat_file")


@query("gz_lines", f"WITH {WAT_SQL} SELECT DISTINCT uri AS line FROM scan UNION ALL SELECT DISTINCT uri FROM scan")
def _(spark, sf_dir):
    path = scratch(spark, "lines")
    uris = read_wat(spark, write_wat(spark, sf_dir)).select(F.col("uri").alias("value")).distinct()
    for _ in range(2):
        uris.write.mode("append").option("compression", "gzip").text(path)
    return read_lines(spark, path).select(F.col("value").alias("line"))


# --- sinks -----------------------------------------------------------------------------------------------------------
@query("link_sink", f"WITH {WAT_SQL} {LINKS_SQL}")
def _(spark, sf_dir):
    path = scratch(spark, "links")
    links = extract.extract(read_wat(spark, write_wat(spark, sf_dir)))[1]
    for _ in range(2):  # a repeated run replaces what it wrote
        write_by_file(links, LINK14, path)
    return read_links(spark, path)


@query("page_sink", f"WITH {WAT_SQL} {PAGES_SQL}")
def _(spark, sf_dir):
    path = scratch(spark, "pages")
    write_by_file(extract.extract(read_wat(spark, write_wat(spark, sf_dir)))[0], PAGE10, path)
    return read_pages(spark, path)


@query("compact_sink", f"WITH {_COMPACT} SELECT {_C16} FROM compact")
def _(spark, sf_dir):
    path = scratch(spark, "compact")
    write_lines(_store(spark, sf_dir), COMPACT16, path)
    return read_compact(spark, path)


# What may stand in an integer field.
NUMBERS = ("1", "0", "+1", "-7", "x", "", "1.5", " 1", "1e3", "99999999999", "0012")


@query("line_integers", f"SELECT v, CASE WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN coalesce(try_cast(v AS INTEGER), 0) ELSE 0 END AS nofollow FROM {values(NUMBERS, 'v')}")
def _(spark, sf_dir):
    lines = literal(spark, NUMBERS, "v string").select(F.concat(F.lit("|".join("abcdefghij")), F.lit("|"), "v", F.lit("|0|d|"), "v").alias("value"))
    return parse_lines(lines, LINK14).select(F.col("ip").alias("v"), "nofollow")


def _stored(spark, sf_dir) -> str:
    """A store of two segments, the first of which was loaded twice."""
    path, rows = scratch(spark, "store"), _store(spark, sf_dir)
    half = F.length("pagehost") % 2
    for segment in (0, 1, 0):
        write_store(rows.where(half == segment), path, "CC-MAIN-2021-04", segment)
    return path


@query("store_sink", f"WITH {_COMPACT} SELECT {_C16}, 'CC-MAIN-2021-04' AS archive, CAST(length(pagehost) % 2 AS INTEGER) AS segment_id FROM compact WHERE regexp_matches(linkdomain, {GOOD_DOMAIN})")
def _(spark, sf_dir):
    return spark.read.parquet(_stored(spark, sf_dir))


@query("lookup_store", f"{_page(f"linkdomain = '{_D}'", _order())} SELECT * FROM page")
def _(spark, sf_dir):
    q = lookup.LinkQuery(_D)
    return _numbered(lookup.fetch(spark.read.parquet(_stored(spark, sf_dir)).select(*COMPACT16), q), q)


@query("lookup_json", f"{_page(f"linkdomain = '{_D}'", _order(), 1)} SELECT 200 AS status, linktext AS link_text, pagehost AS host, nofollow AS no_follow FROM page")
def _(spark, sf_dir):
    status, body = lookup.answer(_store(spark, sf_dir), json.dumps({"domain": _D, "limit": 1}))
    row = spark.createDataFrame([(status, body)], "status int, body string")
    one = row.withColumn("r", F.explode(F.from_json("body", "array<struct<link_text:string,page_url:string,no_follow:int>>"))).where("r.page_url IS NOT NULL")
    return one.select("status", "r.link_text", F.regexp_extract("r.page_url", "^https?://([^/]*)", 1).alias("host"), "r.no_follow")


# --- a segment's run -------------------------------------------------------------------------------------------------
def _manifest(spark):
    return catalog.manifest(literal(spark, [f"crawl-data/CC-MAIN-2021-04/segments/{_SEGMENT}/wat/{file_name(half)}" for half in (0, 1)], "value string"))


@query("segment_import", f"WITH {WAT_SQL}, {_compact_of('watlinks')} SELECT {_C16} FROM compact")
def _(spark, sf_dir):
    config, base = EngineConfig(max_wat_files=1, data_path=scratch(spark, "data")), write_wat(spark, sf_dir)
    assert import_segment(spark, config, _manifest(spark), _SEGMENT, base, save_pages=True) is None  # one file is left
    import_segment(spark, config, _manifest(spark), _SEGMENT, base, save_pages=True)
    return import_segment(spark, config, _manifest(spark), _SEGMENT, "/nowhere")  # finished: no file is read again


@query("pending_files", f"WITH {_FILES} SELECT segment, number FROM files WHERE (segment, number) NOT IN (SELECT (segment, number) FROM {values(DONE, 'segment', 'number')}) ORDER BY segment_id, number LIMIT 4")
def _(spark, sf_dir):
    return catalog.pending_files(catalog.manifest(literal(spark, MANIFEST, "value string")), literal(spark, DONE, "segment string, number string"), 4).select("segment", "number")


# Segment lists, and the suffix rules with hosts that try each kind of them.
SEGMENT_LISTS = ("1,5,7", "2-4", "9", "0-0", "")


@query("segment_list", f"SELECT s, CAST(unnest(CASE WHEN s = '' THEN [] WHEN contains(s, ',') THEN list_transform(string_split(s, ','), lambda x: CAST(x AS BIGINT)) WHEN contains(s, '-') THEN range(CAST(split_part(s, '-', 1) AS BIGINT), CAST(split_part(s, '-', 2) AS BIGINT) + 1) ELSE [CAST(s AS BIGINT)] END) AS INTEGER) AS id FROM {values(SEGMENT_LISTS, 's')}")
def _(spark, sf_dir):
    return literal(spark, [(s, i) for s in SEGMENT_LISTS for i in catalog.parse_segments(s)], "s string, id int")


RULES = ("com", "uk", "co.uk", "jp", "ac.jp", "*.kobe.jp", "!city.kobe.jp", "*.ck", "!www.ck", "blogspot.com")
RULE_HOSTS = ("example.com", "a.b.example.co.uk", "co.uk", "uk", "b.kobe.jp", "a.b.kobe.jp", "x.a.b.kobe.jp", "www.city.kobe.jp", "city.kobe.jp", "kobe.jp", "foo.blogspot.com", "blogspot.com", "x.unknown", "unknown", "www.ck", "a.www.ck", "b.ck", "a.b.ck", "a.ac.jp", "a..com", ".com", "a.com.", "")
_RULED = f"""WITH hosts AS (SELECT host, string_split(host, '.') AS l FROM {values(RULE_HOSTS, 'host')}), rules AS (SELECT r, ltrim(r, '*.!') AS t, len(string_split(ltrim(r, '*.!'), '.')) AS k FROM {values(RULES, 'r')}),
hit AS (SELECT host, CASE WHEN r LIKE '!%' THEN k - 1 WHEN r LIKE '*%' THEN k + 1 ELSE k END AS n, r LIKE '!%' AS x FROM hosts JOIN rules ON (host = t OR suffix(host, '.' || t)) AND NOT (r LIKE '*%' AND len(l) <= k)),
best AS (SELECT host, coalesce(max(n) FILTER (x), max(n), 1) AS n FROM hosts LEFT JOIN hit USING (host) GROUP BY 1)
SELECT host, CASE WHEN len(list_filter(l, lambda p: p = '')) = 0 AND len(l) > n THEN array_to_string(l[-(n + 1):], '.') END AS domain FROM hosts JOIN best USING (host)"""


@query("suffix_rules", _RULED)
def _(spark, sf_dir):
    return literal(spark, RULE_HOSTS, "host string").withColumn("domain", registrable_domain("host", SuffixRules.parse("\n".join(RULES))))


# --- addresses and requests --------------------------------------------------------------------------------------------
# Addresses that can and can't be used, and requests.
ADDRESSES = ("http://example.com/path?query=1#fragment", "https://u@Example.com:8080", "http://a.com/%zz", "http://a.com/%4", "http://a.com/a%7Cb", "http://a.com/a%20c?utm_source=1", "//a.com", "ftp://a.com/x", "http://a.com/a|b", "http://A.com/%C3%A9?x|y", "http://u:p@w@b.org/", "/only/path", "http://c.org?lang=en", "http://d.org/#a#b")
REQUESTS = ("{", "{}", '{"domain": ""}', '{"domain": "localhost"}', '{"domain": "httpbin.org"}', '{"domain": "http://Example.com/x"}', '{"domain": "https://u@example.org"}', '{"domain": "under_score.com"}', '{"domain": "Example.COM", "limit": 5}', '{"domain": "a.example.co.uk", "page": 2}')
_ASKED = f"""SELECT body, CASE WHEN NOT json_valid(body) THEN 'ErrorParsing' WHEN coalesce(d, '') = '' THEN 'ErrorNoDomain' WHEN NOT regexp_matches(h, {GOOD_DOMAIN}) THEN 'ErrorInvalidDomain' ELSE lower(h) END AS verdict
FROM (SELECT *, CASE WHEN starts_with(d, 'http') THEN regexp_replace(regexp_extract(d, '^[a-z]*://([^/?#]*)', 1), '^.*@', '') ELSE d END AS h FROM (SELECT body, CASE WHEN json_valid(body) THEN body->>'$.domain' END AS d FROM {values(REQUESTS, 'body')}))"""


@query("url_validity", f"SELECT url, uok AS ok, CASE WHEN uok THEN uh END AS host, CASE WHEN uok THEN up END AS path, CASE WHEN uok THEN uq END AS raw_query, CASE WHEN uok THEN us END AS scheme FROM (SELECT url, {_fields('url', 'u')} FROM {values(ADDRESSES, 'url')})")
def _(spark, sf_dir):
    rows = literal(spark, ADDRESSES, "url string").withColumn("u", url.url_record(F.col("url")))
    return rows.select("url", F.col("u").isNotNull().alias("ok"), "u.host", "u.path", "u.raw_query", "u.scheme")


@query("lookup_request", _ASKED)
def _(spark, sf_dir):
    def verdict(body: str) -> str:
        try:
            return lookup.LinkQuery.parse(body).domain
        except lookup.BadLookup as e:
            return e.code

    return literal(spark, [(b, verdict(b)) for b in REQUESTS], "body string, verdict string")


# --- streams ---------------------------------------------------------------------------------------------------------
@query("rate_limit_stream", _RATE)
def _(spark, sf_dir):
    """The request limit as a stream: each key's requests in order of time, its state kept between batches."""
    source, out, state = scratch(spark, "requests"), scratch(spark, "limited"), scratch(spark, "state")
    rows = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    rows.repartition(1).sortWithinPartitions("ts").write.parquet(source)
    stream = limited_stream(spark.readStream.schema(rows.schema).parquet(source), "user_id", "ts", _LIMIT, _SECONDS)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id bigint, ts timestamp, limited boolean").parquet(out).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_requests"), F.count_if("limited").alias("n_limited"))
