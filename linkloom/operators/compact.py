"""De-duplication and compaction of link rows.

Compaction reads the lines of a segment in byte order and folds each run of lines with one target (domain, subdomain,
path, query) and one source host.  In a line the scheme and the source host follow the target, so the lines of one
target, scheme and host are contiguous: they are a run, except that a run goes on from one scheme to the next where the
last host of the one is the first host of the other.  So runs need no window over a target's lines: `_joined` finds these
borders from the smallest and largest host of each target and scheme, which are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import COMPACT16, LINK14

TARGET = ("linkdomain", "linksubdomain", "linkpath", "linkrawquery")


def link_line(sep: str = "|"):
    """The row as a line; null fields are empty."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LINK14])


def distinct_links(links: DataFrame) -> DataFrame:
    """Rows that differ in any field, without those whose text would break a line."""
    return links.select(*LINK14).where(~F.coalesce(F.col("linktext").contains("\n"), F.lit(False))).distinct()


def with_runs(links: DataFrame) -> DataFrame:
    """links with `line` and `run`, the number of the run inside its target."""
    order = Window.partitionBy(*TARGET).orderBy("line")
    starts = F.when(F.lag("pagehost").over(order).eqNullSafe(F.col("pagehost")), 0).otherwise(1)
    return links.withColumn("line", link_line()).withColumn("starts", starts).withColumn("run", F.sum("starts").over(order)).drop("starts")


def _joined(links: DataFrame) -> DataFrame:
    """(target, pagehost, roots): of hosts whose run spans schemes, the scheme with which the run of each begins."""
    host = F.concat("pagehost", F.lit("|"))  # as it compares in the line
    several = links.groupBy(*TARGET, "pagehost").agg(F.min("linkscheme").alias("a"), F.max("linkscheme").alias("b")).where("a <> b").select(*TARGET, "pagehost")
    ends = links.groupBy(*TARGET, "linkscheme").agg(F.min(host).alias("lo"), F.max(host).alias("hi"))
    ends = ends.groupBy(*TARGET).agg(F.array_sort(F.collect_list(F.struct(F.concat("linkscheme", F.lit("|")).alias("k"), F.col("linkscheme").alias("s"), "lo", "hi"))).alias("ends")).where("size(ends) > 1")
    # for each scheme: the scheme with which the run of its first host begins, and that of its last host
    chain = F.expr("""aggregate(ends, CAST(array() AS array<struct<s: string, lo: string, hi: string, first: string, last: string>>), (acc, e) ->
      concat(acc, transform(array(CASE WHEN size(acc) > 0 AND element_at(acc, -1).hi = e.lo THEN element_at(acc, -1).last ELSE e.s END),
        r -> named_struct('s', e.s, 'lo', e.lo, 'hi', e.hi, 'first', r, 'last', CASE WHEN e.lo = e.hi THEN r ELSE e.s END))))""")
    ends = ends.select(*TARGET, F.filter(chain, lambda x: x["s"] != x["first"]).alias("chain")).where("size(chain) > 0")
    own = F.filter("chain", lambda x: x["lo"] == host)
    return several.join(ends, list(TARGET)).select(*TARGET, "pagehost", F.map_from_entries(F.transform(own, lambda x: F.struct(x["s"], x["first"]))).alias("roots")).where("size(roots) > 0")


def compact(links: DataFrame, as_coded: bool = False) -> DataFrame:
    """links (LINK14, distinct) -> COMPACT16, a row for each run.

    The first row gives text, schemes and flags.  If it isn't nofollow, nofollow rows of the run are ignored.  The
    dates are the extremes, the address is the last one's; the shortest page path stays, and among equally long ones
    the shortest query; qty counts 1 and every row that differs from the best so far.  as_coded: without the last run
    of the whole input, which a streaming writer that never flushes would lose.

    Rows of one page (path and query) of a run follow each other and act alike, so they are summed up before the
    shuffle; what is folded in order is one entry for each page of a host that links to a target.
    """
    links = links.where(F.col("linkdomain") != "").fillna("", [c for c in LINK14 if c not in ("nofollow", "noindex")])
    rest = F.concat_ws("|", "pagepath", "pagerawquery", "pagescheme", "linktext", F.col("nofollow").cast("string"), F.col("noindex").cast("string"), "imported", "ip")
    pages = links.withColumn("rest", rest).groupBy(*TARGET, "pagehost", "linkscheme", "pagepath", "pagerawquery", "nofollow").agg(
        F.min(F.struct("rest", "pagescheme", "linktext", "noindex")).alias("lo"), F.max(F.struct("rest", "ip")).alias("hi"), F.min("imported").alias("datefrom"), F.max("imported").alias("dateto"), F.count(F.lit(1)).cast("int").alias("n"),
    )
    entry = F.struct(F.concat("linkscheme", F.lit("|")).alias("k"), F.col("lo.rest").alias("rest"), "linkscheme", "pagepath", "pagerawquery", "nofollow", "lo", "hi", "datefrom", "dateto", "n")
    hosts = pages.groupBy(*TARGET, "pagehost").agg(F.collect_list(entry).alias("r")).join(_joined(links), [*TARGET, "pagehost"], "left")
    hosts = hosts.withColumn("r", F.transform("r", lambda x: x.withField("root", F.coalesce(F.col("roots")[x["linkscheme"]], x["linkscheme"]))))
    run = hosts.withColumn("root", F.explode(F.array_distinct(F.transform("r", lambda x: x["root"]))))
    if as_coded:
        last = links.agg(F.max_by(F.struct(*TARGET, "pagehost", "linkscheme"), link_line()).alias("last"))
        whole = F.struct(*TARGET, "pagehost")
        run = run.join(F.broadcast(last)).where(~(whole.eqNullSafe(F.struct(*[F.col(f"last.{c}").alias(c) for c in (*TARGET, "pagehost")])) & (F.col("root") == F.coalesce(F.col("roots")[F.col("last.linkscheme")], F.col("last.linkscheme")))))
    run = run.select(*TARGET, "pagehost", F.array_sort(F.filter("r", lambda x: x["root"] == F.col("root"))).alias("r")).withColumn("first", F.get("r", F.lit(0)))
    run = run.withColumn("kept", F.filter("r", lambda x: (F.col("first.nofollow") == 1) | (x["nofollow"] == 0)))

    def step(acc, x):
        same = (acc["p"] == x["pagepath"]) & (acc["q"] == x["pagerawquery"])
        lp, lq, np, nq = F.octet_length(acc["p"]), F.octet_length(acc["q"]), F.octet_length(x["pagepath"]), F.octet_length(x["pagerawquery"])
        both, query = (np < lp) & (nq <= lq), (np == lp) & (nq < lq)
        # a page that becomes the best counts once, one that doesn't with each of its rows
        becomes = both | (query & (acc["p"] == x["pagepath"]))
        more = F.when(same, 0).when(becomes, 1).otherwise(x["n"])
        return F.struct(F.when(both, x["pagepath"]).otherwise(acc["p"]).alias("p"), F.when(both | query, x["pagerawquery"]).otherwise(acc["q"]).alias("q"), (acc["n"] + more).alias("n"))

    start = F.struct(F.col("first.pagepath").alias("p"), F.col("first.pagerawquery").alias("q"), F.lit(1).alias("n"))
    run = run.withColumn("best", F.aggregate("kept", start, step))
    return run.select(
        *TARGET, F.col("first.linkscheme").alias("linkscheme"), "pagehost", F.col("best.p").alias("pagepath"), F.col("best.q").alias("pagerawquery"), F.col("first.lo.pagescheme").alias("pagescheme"),
        F.col("first.lo.linktext").alias("linktext"), F.col("first.nofollow").alias("nofollow"), F.col("first.lo.noindex").alias("noindex"),
        F.array_min(F.transform("kept", lambda x: x["datefrom"])).alias("datefrom"), F.array_max(F.transform("kept", lambda x: x["dateto"])).alias("dateto"),
        F.element_at(F.array_sort(F.transform("kept", lambda x: F.struct(x["k"], x["hi"]))), -1)["hi"]["ip"].alias("ip"), F.col("best.n").alias("qty"),
    ).select(*COMPACT16)


def sorted_links(links: DataFrame) -> DataFrame:
    """Links in the order of a link file, inside each partition of domains; the line decides among equal ones."""
    return links.repartitionByRange("linkdomain").sortWithinPartitions("linkdomain", "linksubdomain", "linkpath", link_line())
