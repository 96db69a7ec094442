"""WAT records with good and bad pages and links, as SQL that Spark and DuckDB both run, and the extraction's rules as DuckDB SQL.

A page's number modulo 24 is its case, see `_URI` and `_JSON`.  Pages are dealt over two files by their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import IGNORED_DOMAINS, IGNORED_EXTENSIONS
from ..schemas import LINK14, PAGE10
from .fixtures import scratch, table

#: What stands for a page in each case; case 15 is overwritten by case 16, which has its address.
_URI = {
    1: "'ftp://' || h || '/x'", 2: "'http://' || h || '/%zz'", 3: "'http://10.0.0.1/x' || p", 4: "'http://' || h || '/p?a|b=' || p", 5: "'http://' || h || '/p?' || repeat('q', 201)",
    6: "'https://shop' || p || '.example.cn/'", 13: "'http://localhost/' || p", 15: "'http://www.twice' || g || '.example.net/same'", 16: "'http://www.twice' || g || '.example.net/same'",
    18: "'http://bad_name' || p || '.com/'", 19: "'http://me' || p || '.blogspot.com/'", 20: "'http://' || h || '/canon' || p", 21: "'http://user@' || h || ':8080/port' || p", 22: "'http://' || h || '/a%7Cb'", 23: "'https://' || h || '/sp%20ace/' || p",
}
_A = '{"path":"A@/href","url":"'
#: A page's links; the last but one repeats the first one's address with another text.
_LINKS = (
    f"""'[{_A}https://www.site' || (page_id % 7) || '.org/a/0?x=1","text":"t | ' || p || '","rel":"nofollow"}},'""",
    f"""'{_A}/local","text":"l"}},{{"path":"IMG@/src","url":"http://img.example.org/a.png"}},'""",
    f"""'{_A}http://a.example.org/%zz"}},{_A}' || url || '","text":"self"}},{_A}http://other-' || h || '/","text":"one domain"}},'""",
    f"""'{_A}http://site.cn/","text":"cn"}},{_A}http://files.site9.org/x.PDF"}},{_A}https://www.facebook.com/x"}},{_A}//site9.net/p","rel":"noopener nofollow"}},'""",
    f"""'{_A}https://www.site' || (page_id % 7) || '.org/a/0?x=1","text":"again ' || p || '"}},{_A}HTTP://upper.site1.org/"}},{_A}mailto:x@y.org"}},'""",
    f"""'{_A}http://192.168.0.1/"}},{_A}http://co.uk/"}},{_A}http://one.site2.co.uk?lang=en","text":"uk"}},{_A}http://site3.net/' || repeat('z', 3) || '?' || repeat('q', 201) || '"}}]'""",
)
_JSON = """'{"Envelope":{"WARC-Header-Metadata":{' || CASE c WHEN 17 THEN '' ELSE '"WARC-IP-Address":"10.0.0.' || (page_id % 9) || '",' END || '"WARC-Date":"' || CASE c WHEN 14 THEN '2021-02-30T00:00:00Z' ELSE '2021-01-1' || (page_id % 9) || 'T13:41:01Z' END
|| '"},"Payload-Metadata":{"HTTP-Response-Metadata":{"HTML-Metadata":{"Links":' || CASE c WHEN 8 THEN '[]' WHEN 12 THEN '[{"path":"A@/href","url":"/only/local","text":"x"},{"path":"A@/href","url":"' || url || '"}]' ELSE links END
|| ',"Head":{' || CASE c WHEN 17 THEN '' ELSE '"Title":"Page | ' || p || '",' END || CASE c WHEN 9 THEN '"Metas":[{"name":"robots","content":"noindex, follow"}],' WHEN 10 THEN '"Metas":[{"name":"viewport","content":"noindex"},{"name":"robots","content":"nofollow"}],' ELSE '' END
|| '"Link":[{"path":"LINK@/href","url":"/s.css","rel":"stylesheet"}' || CASE c WHEN 11 THEN ',{"url":"http://elsewhere.example.org/","rel":"canonical"}' WHEN 20 THEN ',{"url":"/canon' || p || '","rel":"canonical"}' ELSE '' END || ']}}}}}}'"""
_URL_CASE = "CASE c " + " ".join(f"WHEN {k} THEN {v}" for k, v in _URI.items()) + " ELSE url END"
#: page_id, half (the file), value (a WARC record).
RECORDS_SQL = f"""
SELECT page_id, g % 2 AS half, 'WARC/1.0' || nl || 'WARC-Type: metadata' || nl || 'WARC-Target-URI: ' || uri || nl || 'Content-Type: application/json' || nl || nl || CASE c WHEN 7 THEN replace(json, 'href', 'src') ELSE json END || nl AS value
FROM (SELECT *, {_JSON} AS json FROM (
  SELECT *, {_URL_CASE} AS uri, {" || ".join(_LINKS)} AS links FROM (
    SELECT page_id, CAST(page_id AS STRING) AS p, page_id % 24 AS c, CAST(floor(page_id / 24) AS BIGINT) AS g, url, regexp_extract(url, '^https?://([^/]*)', 1) AS h, chr(13) || chr(10) AS nl FROM pages) a) b) d
"""


def wat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = RECORDS_SQL.replace("{", "{{").replace("}", "}}").replace("FROM pages", "FROM {pages}")
    return spark.sql(sql, pages=table(spark, sf_dir, "pages"))


def file_name(half: int) -> str:
    return f"CC-MAIN-20210115134101-20210115164101-0001{half}.warc.wat.gz"


def write_wat(spark: SparkSession, sf_dir: str) -> str:
    """The records as two gzip files in a new folder, named as an archive names them."""
    folder, rows = scratch(spark, "wat"), wat_text(spark, sf_dir)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for half in (0, 1):
        one = rows.where(F.col("half") == half).repartition(1).sortWithinPartitions("page_id").select(F.rtrim(F.col("value"), F.lit("\r\n")).alias("value"))
        one.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(f"{folder}/half{half}")
        made = fs.globStatus(path(f"{folder}/half{half}/part-*"))[0].getPath()
        fs.rename(made, path(f"{folder}/{file_name(half)}"))
        fs.delete(path(f"{folder}/half{half}"), True)
    return folder


# --- the rules, in DuckDB ------------------------------------------------------------------------------------------
_RFC = r"'^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$'"


def _part(u: str, i: int) -> str:
    return f"regexp_extract({u}, {_RFC}, {i})"


def _fields(u: str, prefix: str) -> str:
    """Columns of a URL u: host, path, query, scheme code and whether the escapes and the path are good."""
    raw, host, query = _part(u, 3), f"lower(trim(regexp_replace({_part(u, 2)}, '^.*@', '')))", _part(u, 4)
    path = f"CASE WHEN {raw} = '' THEN '/' ELSE url_decode({raw}) END"
    return f"""{host} AS {prefix}h, {path} AS {prefix}p, CASE WHEN regexp_matches({query}, '^(lang|utm_|ref)') THEN '' ELSE {query} END AS {prefix}q,
      CASE lower({_part(u, 1)}) WHEN 'https' THEN '2' WHEN 'http' THEN '1' ELSE '0' END AS {prefix}s, NOT regexp_matches({raw}, '%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)') AND NOT contains({path}, '|') AS {prefix}ok"""


def _domain(h: str) -> str:
    """The registrable domain; of the suffixes with two labels only those of the fixture."""
    k = f"CASE WHEN array_to_string(string_split({h}, '.')[-2:], '.') IN ('co.uk', 'blogspot.com') THEN 2 ELSE 1 END"
    return f"CASE WHEN len(string_split({h}, '.')) > {k} THEN array_to_string(string_split({h}, '.')[-({k} + 1):], '.') END"


OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9])"
BAD_HOST = """[%\\[\\]='':*()<>!&+,}{$";`]"""
GOOD_DOMAIN = r"'(?i)^([a-z0-9]([a-z0-9\-]{0,61}[a-z0-9])?\.)+[a-z]{2,}$'"


def _good(d: str, h: str, q: str) -> str:
    return f"""({d} <> '' AND NOT suffix(lower({d}), '.cn') AND NOT suffix(lower({d}), '.blogspot.com') AND NOT regexp_matches({h}, '{BAD_HOST}') AND NOT regexp_matches({h}, '^{OCTET}\\.{OCTET}\\.{OCTET}\\.{OCTET}$')
      AND contains({h}, '.') AND regexp_matches({d}, {GOOD_DOMAIN}) AND strlen({q}) <= 200 AND NOT contains({q}, '|'))"""


_HTML = "'$.Envelope.\"Payload-Metadata\".\"HTTP-Response-Metadata\".\"HTML-Metadata\"'"
_EXT = ", ".join(repr(x) for x in IGNORED_EXTENSIONS)
_IGNORED = ", ".join(f"'{x}'" for x in IGNORED_DOMAINS)
#: CTEs recs, scan, page (that pass all page tests but the last), link (with outcome), pagelast and linklast.
WAT_SQL = f"""recs AS ({RECORDS_SQL}),
scan AS (SELECT * FROM (SELECT page_id, half, trim(regexp_extract(value, 'WARC-Target-URI: (http[^\\r\\n]*)', 1)) AS uri, regexp_extract(value, '(?m)^(\\{{[^\\r\\n]*href[^\\r\\n]*)', 1) AS json FROM recs) WHERE uri <> '' AND json <> ''),
addressed AS (SELECT *, {_domain("ph")} AS pd, json_extract(json, {_HTML}) AS html FROM (SELECT *, {_fields("uri", "p")} FROM scan)),
robots AS (SELECT *, coalesce(html->'$.Head.Metas', '[]') AS metas, from_json(coalesce(html->'$.Head.Link', '[]'), '[{{"url":"VARCHAR","rel":"VARCHAR"}}]') AS heads, json_extract_string(json, '$.Envelope."WARC-Header-Metadata"."WARC-Date"') AS stamp FROM addressed),
flagged AS (SELECT *, len(list_filter(from_json(metas, '[{{"name":"VARCHAR","content":"VARCHAR"}}]'), lambda x: x.name = 'robots' AND contains(x.content, 'noindex'))) AS ni, len(list_filter(from_json(metas, '[{{"name":"VARCHAR","content":"VARCHAR"}}]'), lambda x: x.name = 'robots' AND contains(x.content, 'nofollow'))) AS nf FROM robots),
page AS (SELECT *, ph || pp || pq AS page_key FROM flagged WHERE pok AND pd IS NOT NULL AND {_good("pd", "ph", "pq")} AND strlen(CAST(html->'$.Links' AS VARCHAR)) >= 10 AND ni = 0 AND try_cast(substr(stamp, 1, 10) AS DATE) IS NOT NULL
  AND len(list_filter(heads, lambda x: x.rel = 'canonical' AND x.url <> '' AND NOT (CASE WHEN starts_with(x.url, 'http') THEN {_part("x.url", 2)} = ph AND {_part("x.url", 3)} = pp ELSE x.url = pp END AND pq = ''))) = 0),
flat AS (SELECT page_id, half, page_key, ph, pd, nf, unnest(from_json(html->'$.Links', '[{{"path":"VARCHAR","url":"VARCHAR","text":"VARCHAR","rel":"VARCHAR"}}]')) AS x, unnest(range(len(from_json(html->'$.Links', '["JSON"]')))) AS idx FROM page),
parts AS (SELECT *, {_domain("lh")} AS ld FROM (SELECT *, {_fields("x.url", "l")} FROM flat)),
link AS (SELECT *, CASE WHEN x.path <> 'A@/href' THEN 'not_anchor' WHEN NOT starts_with(x.url, 'http') AND NOT starts_with(x.url, '//') THEN 'relative' WHEN NOT lok OR ld IS NULL THEN 'invalid' WHEN lh = ph THEN 'same_host' WHEN ld = pd THEN 'same_domain'
  WHEN NOT {_good("ld", "lh", "lq")} THEN 'low_quality' WHEN lower(regexp_extract(lp, '(\\.[^./]*)$', 1)) IN ({_EXT}) THEN 'extension' WHEN lower(ld) IN ({_IGNORED}) THEN 'ignored_domain' ELSE 'keep' END AS outcome FROM parts),
counts AS (SELECT page_id, CAST(count(*) FILTER (outcome IN ('relative', 'same_host')) AS INTEGER) AS internal_links, CAST(count(*) FILTER (outcome IN ('same_domain', 'low_quality', 'ignored_domain', 'keep')) AS INTEGER) AS external_links, count(*) FILTER (outcome = 'keep') AS kept FROM link GROUP BY 1),
pagelast AS (SELECT DISTINCT ON (half, page_key) half, page_key, ph AS host, pp AS path, pq AS raw_query, ps AS scheme, replace(coalesce(html->>'$.Head.Title', ''), '|', ' ') AS title, coalesce(json_extract_string(json, '$.Envelope."WARC-Header-Metadata"."WARC-IP-Address"'), '') AS ip,
  substr(stamp, 1, 10) AS imported, internal_links, external_links, 0 AS noindex FROM page JOIN counts USING (page_id) WHERE kept > 0 ORDER BY half, page_key, page_id DESC),
linklast AS (SELECT DISTINCT ON (half, lh || lp || lq || page_key) half, page_key, ld AS linkdomain, CASE WHEN lh = ld THEN '' ELSE substr(lh, 1, length(lh) - length(ld) - 1) END AS linksubdomain, lp AS linkpath, lq AS linkrawquery, ls AS linkscheme,
  replace(coalesce(x.text, ''), '|', ' ') AS linktext, CAST(greatest(least(nf, 1), CAST(coalesce(starts_with(x.rel, 'nofollow'), false) AS BIGINT)) AS INTEGER) AS nofollow FROM link WHERE outcome = 'keep' ORDER BY half, lh || lp || lq || page_key, page_id DESC, idx DESC),
watlinks AS (SELECT {", ".join(f"l.{c}" for c in LINK14 if c.startswith("link") or c == "nofollow")}, p.host AS pagehost, p.path AS pagepath, p.raw_query AS pagerawquery, p.scheme AS pagescheme, p.noindex, p.imported, p.ip FROM linklast l JOIN pagelast p ON l.half = p.half AND l.page_key = p.page_key)"""
PAGES_SQL = f"SELECT {', '.join(PAGE10)} FROM pagelast"
LINKS_SQL = f"SELECT {', '.join(LINK14)} FROM watlinks"
