"""Column functions, the fold against a sequential model, lookup, catalog, limiter, WAT round trip, oracles."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from linkloom.functions import url
from linkloom.functions.domain import SuffixRules, registrable_domain
from linkloom.operators import catalog, compact, extract, lookup
from linkloom.operators.ratelimit import Limiter
from linkloom.config import EngineConfig
from linkloom.functions import domain
from linkloom.operators.ratelimit import limited_requests
from linkloom.plans.segment import catalog_state, events, import_segment
from linkloom.plans.wat_fixture import file_name
from linkloom.service import Clients, serve
from linkloom.plans import queries as core
from linkloom.plans.wat_fixture import write_wat
from linkloom.schemas import LINK14
from linkloom.sources.download import download
from linkloom.sources.readers import parse_lines, read_wat

SF = "/root/testdata/sf0.001"


def _one(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_url_record(spark):
    got = _one(spark, ["http://example.com/path?query=1#fragment", "https://U@Example.com:8080", "http://a.com/%zz", "http://a.com/x\ny", "http://a.com/a%7Cb", "http://a.com/a+b%20c?utm_source=1", "http://a b.com/", None], url.url_record)
    assert got[0] == ("http://example.com/path?query=1#fragment", "1", "example.com", "/path", "query=1", "fragment")
    assert (got[1].host, got[1].path, got[1].scheme) == ("example.com:8080", "/", "2")
    assert got[2] is got[3] is got[4] is got[6] is got[7] is None
    assert (got[5].path, got[5].raw_query) == ("/a+b c", "")


def test_registrable_domain(spark):
    rules = SuffixRules.parse("com\nuk\nco.uk\njp\n*.kobe.jp\n!city.kobe.jp\nblogspot.com\n// comment\n")
    cases = {"example.com": "example.com", "a.b.example.co.uk": "example.co.uk", "co.uk": None, "b.kobe.jp": None, "a.b.kobe.jp": "a.b.kobe.jp", "www.city.kobe.jp": "city.kobe.jp", "kobe.jp": "kobe.jp", "foo.blogspot.com": "foo.blogspot.com", "x.unknown": "x.unknown", "unknown": None, "a..com": None, "": None}
    rows = spark.createDataFrame([(k,) for k in cases], "h string").withColumn("d", registrable_domain("h", rules))
    assert {r.h: r.d for r in rows.collect()} == cases
    for host, domain in cases.items():
        if domain:
            assert lookup.split_host(host, rules)[0] == domain


def _fold(lines):
    """The sequential reading of sorted lines."""
    out, cur = [], None
    for line in sorted(set(lines)):
        r = dict(zip(LINK14, line.split("|")))
        key = tuple(r[c] for c in ("linkdomain", "linksubdomain", "linkpath", "linkrawquery", "pagehost"))
        if cur is None or key != cur["key"]:
            cur = {"key": key, "nf": int(r["nofollow"]), "p": r["pagepath"], "q": r["pagerawquery"], "lo": r["imported"], "hi": r["imported"], "ip": r["ip"], "n": 1, "s": r["linkscheme"], "t": r["linktext"]}
            out.append(cur)
            continue
        if cur["nf"] == 0 and r["nofollow"] == "1":
            continue
        cur["lo"], cur["hi"], cur["ip"] = min(cur["lo"], r["imported"]), max(cur["hi"], r["imported"]), r["ip"]
        if (r["pagepath"], r["pagerawquery"]) != (cur["p"], cur["q"]):
            a, b = len(r["pagepath"].encode()) - len(cur["p"].encode()), len(r["pagerawquery"].encode()) - len(cur["q"].encode())
            if a < 0 and b <= 0:
                cur["p"], cur["q"] = r["pagepath"], r["pagerawquery"]
            elif a == 0 and b < 0:
                cur["q"] = r["pagerawquery"]
            cur["n"] += 1
    return out


def test_compaction_follows_the_sequential_fold(spark):
    rng = random.Random(5)
    pick = rng.choice
    lines = ["|".join((pick(("a.com", "ab.com")), pick(("", "www")), pick(("/", "/é")), "", pick("12"), pick(("h1.org", "h2.org", "h.org")), pick(("/", "/a", "/aa", "/é")), pick(("", "q=1", "q=11")), "2", pick(("t", "u")), pick("01"), "0", f"2021-01-0{rng.randint(1, 9)}", f"10.0.0.{rng.randint(1, 9)}")) for _ in range(3000)]
    rows = compact.distinct_links(parse_lines(spark.createDataFrame([(x,) for x in [*lines, "too|few"]], "value string"), LINK14))
    model = _fold(lines)
    got = sorted((r.linkdomain, r.linksubdomain, r.linkpath, r.pagehost, r.linkscheme, r.linktext, r.nofollow, r.pagepath, r.pagerawquery, r.datefrom, r.dateto, r.ip, r.qty) for r in compact.compact(rows).collect())
    want = sorted((*c["key"][:3], c["key"][4], c["s"], c["t"], c["nf"], c["p"], c["q"], c["lo"], c["hi"], c["ip"], c["n"]) for c in model)
    assert got == want
    assert compact.compact(rows, as_coded=True).count() == len(model) - 1


def test_lookup_requests(spark):
    q = lookup.LinkQuery.parse(json.dumps({"domain": "http://WWW.Example.com/x", "limit": 500, "page": 2, "filters": [{"name": "Anchor", "val": "a", "kind": "any"}]}))
    assert (q.domain, q.rows, q.skipped) == ("www.example.com", 100, 100)
    for body, status in (("{", 400), ("{}", 400), ('{"domain": "localhost"}', 400), ('{"domain": "httpbin.org"}', 400)):
        with pytest.raises(lookup.BadLookup) as e:
            lookup.LinkQuery.parse(body)
        assert e.value.status == status
    store = core.QUERY["compact_fold"](spark, SF)
    status, body = lookup.answer(store, json.dumps({"domain": "d0.com", "limit": 3}))
    assert status == 200 and len(json.loads(body)) == 3
    assert lookup.answer(store, json.dumps({"domain": "none.org"})) == (200, "[]")
    assert lookup.answer(store, json.dumps({"domain": "d0.com", "filters": [{"name": "IP", "val": "(", "kind": "any"}]}))[0] == 400


def test_catalog():
    assert catalog.parse_segments("1,5,7") == [1, 5, 7]
    assert catalog.parse_segments("2-4") == [2, 3, 4]
    assert catalog.parse_segments("9") == [9]
    for bad in ("4-2", "1-2-3", "x", "1,y"):
        with pytest.raises(ValueError):
            catalog.parse_segments(bad)


def test_limiter_window_is_anchored_at_its_first_request():
    state = Limiter(2, 100)
    assert [state.refuses(t) for t in (0, 50, 60, 100, 101, 150, 201)] == [False, False, True, True, False, False, True]


def test_download_retries(tmp_path):
    import io
    import urllib.error

    tries, waits = [], []

    def opener(u):
        tries.append(u)
        if len(tries) < 3:
            raise urllib.error.HTTPError(u, 503, "busy", None, None)
        return io.BytesIO(b"data")

    download("http://x/", str(tmp_path / "f"), sleep=waits.append, opener=opener)
    assert (tmp_path / "f").read_bytes() == b"data" and waits == [20.0, 40.0]


def test_limit_before_1970_and_null_times(spark):
    state = Limiter(2, 100)
    assert [state.refuses(t) for t in (-50, -49, -48, -47)] == [False, False, True, True]
    rows = [("a", 1, 1), ("a", None, 2), ("a", 2, 3), ("a", 3, 4), (None, 1, 5)]
    got = limited_requests(spark.createDataFrame(rows, "k string, s int, t int").withColumn("at", F.timestamp_seconds("s")), "k", "at", "t", 2, 900)
    assert {r.k: (r.n_requests, r.n_limited) for r in got.collect()} == {"a": (4, 1), None: (1, 0)}


def test_clients_are_bounded():
    clients = Clients(1, 900, most=3)
    assert not any(clients.refuses(f"a{i}", i) for i in range(10)) and len(clients.states) == 3
    assert clients.refuses("a9", 10) and not clients.refuses("a9", 10**10)


def test_service_answers(spark):
    import threading
    import urllib.error
    import urllib.request

    server = serve(core.QUERY["compact_fold"](spark, SF), port=0, limit=1)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}/api"
    assert json.load(urllib.request.urlopen(f"{base}/health")) == {"status": "ok"}
    assert len(json.load(urllib.request.urlopen(f"{base}/links", json.dumps({"domain": "d0.com", "limit": 2}).encode()))) == 2
    with pytest.raises(urllib.error.HTTPError) as e:
        urllib.request.urlopen(f"{base}/links", b"{}")
    assert e.value.code == 429
    server.shutdown()
    server.server_close()


def test_lookup_over_a_written_store_pushes_the_domain_and_keeps_its_time(spark, tmp_path):
    from linkloom.sources.writers import write_store

    write_store(core.QUERY["compact_fold"](spark, SF), str(tmp_path / "store"), "CC-MAIN-2021-04", 0)
    store = spark.read.parquet(str(tmp_path / "store"))
    plan = lookup.fetch(store, lookup.LinkQuery("d0.com"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(linkdomain,d0.com)" in plan
    slow = store.crossJoin(spark.range(10**7)).groupBy("linkdomain").agg(F.count_distinct("id", "linkpath"))  # only to be stopped
    with pytest.raises(lookup.BadLookup) as e:
        lookup.collected(slow, 1.5)
    assert e.value.status == 500 and lookup.answer(store, json.dumps({"domain": "d0.com"}))[0] == 200


def test_a_segment_goes_on_where_it_stopped(spark, tmp_path):
    config, base, segment = EngineConfig(max_wat_files=1, data_path=str(tmp_path / "data")), write_wat(spark, SF), "1610703495901.0"
    lines = [f"crawl-data/CC-MAIN-2021-04/segments/{segment}/wat/{file_name(half)}" for half in (0, 1)]
    files = catalog.manifest(spark.createDataFrame([(x,) for x in lines], "value string"))
    state = lambda: [(r.event, r.number) for r in events(spark, config).orderBy("at").collect()]
    assert state() == []
    assert import_segment(spark, config, files, segment, base) is None
    assert state() == [("start", ""), ("file", "00010")] and catalog_state(spark, config, files).first()["import_ended"] is None
    made = import_segment(spark, config, files, segment, base)
    assert [e for e, _ in state()] == ["start", "file", "file", "end"]
    rows = sorted(map(tuple, made.collect()))
    assert rows and sorted(map(tuple, import_segment(spark, config, files, segment, "/nowhere").collect())) == rows
    assert catalog.next_segment(catalog_state(spark, config, files)).count() == 0
    assert spark.read.parquet(config.folders()["store"]).count() == len(rows)
    with pytest.raises(ValueError, match="no segment"):
        import_segment(spark, config, files, "other", base)


def test_settings(monkeypatch, tmp_path):
    monkeypatch.setenv("LINKLOOM_WAT_FILES", "x")
    monkeypatch.setenv("LINKLOOM_THREADS", "99")
    assert EngineConfig.from_env().max_wat_files == 1 and EngineConfig.from_env().max_threads == 1
    with pytest.raises(FileNotFoundError):
        domain.load_rules(str(tmp_path / "absent"))


def test_suffix_rules_in_buckets_agree_with_the_list(spark, monkeypatch):
    rules, hosts = domain.load_rules(), ["a.b.co.uk", "x.github.io", "www.gov.uk", "b.city.kawasaki.jp", "a.kawasaki.jp", "x.y.z.ck", "www.ck", "foo.com.mx", "a.unknowntld", "com", "xn--p1ai", "a.xn--p1ai"]
    rows = spark.createDataFrame([(h,) for h in hosts], "h string")
    for r in rows.withColumn("d", registrable_domain("h")).collect():
        try:
            want = lookup.split_host(r.h, rules)[0]
        except lookup.BadLookup:
            want = None
        assert r.d == want


def test_compaction_across_schemes_and_hot_pairs(spark):
    rng = random.Random(8)
    pick = rng.choice
    for hosts in (("h1.org",), ("h1.org", "h2.org"), ("a.org", "a.org.uk", "b.org")):
        lines = ["|".join(("a.com", "", pick(("/", "/x")), "", pick("012"), pick(hosts), pick(("/", "/a", "/ab")), pick(("", "q", "qq")), pick("12"), pick(("t", "u")), pick("01"), "0", f"2021-01-0{rng.randint(1, 9)}", f"10.0.0.{rng.randint(1, 9)}")) for _ in range(rng.choice((40, 400)))]
        rows = compact.distinct_links(parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), LINK14))
        model = _fold(lines)
        got = sorted((r.linkpath, r.pagehost, r.linkscheme, r.linktext, r.nofollow, r.pagepath, r.pagerawquery, r.datefrom, r.dateto, r.ip, r.qty) for r in compact.compact(rows).collect())
        assert got == sorted((c["key"][2], c["key"][4], c["s"], c["t"], c["nf"], c["p"], c["q"], c["lo"], c["hi"], c["ip"], c["n"]) for c in model)
        assert compact.compact(rows, as_coded=True).count() == len(model) - 1


def test_wat_round_trip(spark):
    pages, links = extract.extract(read_wat(spark, write_wat(spark, SF)))
    assert {r.title[:7] for r in pages.select("title").collect()} <= {"Page   ", ""}
    rows = links.collect()
    assert rows and all(r.linkdomain and r.imported.startswith("2021-01-1") and r.noindex == 0 for r in rows)


@pytest.mark.parametrize("name", ["external_links", "link_join_page", "link_last_wins", "page_last_wins"])
def test_links_of_pages_are_not_sought_among_all_pairs_of_pages(spark, name):
    plan = core.QUERY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan


core.queries()


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "pages", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want, got = con.sql(core.SQL[name]), core.QUERY[name](spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    # as Python values, since pandas would turn integers beside nulls into floats
    rows = lambda names, d: sorted(tuple("" if v is None else str(v) for _, v in sorted(zip(names, r), key=lambda x: x[0])) for r in d)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
