"""Approximate nearest neighbours by largest inner product: NN-descent builds a neighbour graph, queries search it greedily.

Equal vectors are one node.  Vectors whose lengths differ are dealt into bands, in each of which the longest is at most
twice as long as the shortest; a query searches every band, with its direction alone.  In a band, vectors are extended by
one component so that all have the same length and the order by inner product becomes the order by angle (no change if
they all have one length already), and coded as 8-bit integers on the band's own scale, whose products are exact.  Where
there are several bands, a query is compared with `SAMPLE` nodes of each: small bands are so searched in full, and in the
others the best of them are where it begins.  The first graph comes from blocks of random projection trees; then NN-descent joins, at each
node, its neighbours and those it is a neighbour of (neighbours of neighbours) and keeps for every node the `k` best.  A
query begins at its own node and expands, round by round, the nearest nodes that it hasn't expanded.  The nearest found
are scored again in double precision on the original vectors.

The number of neighbours that meet at a node is bounded by sampling, as the method has it; no node is dropped, and each
round is a handful of joins of rows of bounded size.  Rounds aren't counted: NN-descent ends when less than 1 % of the
neighbours are fresh, the search when no query keeps a node that it hasn't expanded.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor those whose
length isn't the most common one; a query's own row isn't returned, copies of it are; ties go to the smaller vec_id;
rows with a null vec_id take no part; a vec_id with several vectors is several candidates.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .kernels import stream
from .storage import Workspace

TOP, K = 20, 40
#: Trees and block size of the first graph; neighbours of each kind that meet at a node.
TREES, BLOCK, MEET = 16, 1000, 24
#: Nodes that a query keeps, and that it expands in a round.
BEAM, EXPAND = 128, 24
#: Nodes of each band that a query is compared with, where there are several bands.
SAMPLE = 4096
_LIST = "array<struct<sim:int,id:bigint>>"


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == common[0]["n"]) if common else rows


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _best(rows: DataFrame, column: str, k: int) -> DataFrame:
    """rows with the k best of each list in a column of type _LIST, best first, each once; all lists of a batch are sorted together."""
    at = rows.columns.index(column)

    def run(batches):
        for batch in batches:
            lists = batch.column(at)
            flat, lens = lists.flatten(), np.diff(lists.offsets.to_numpy())
            sims, ids = flat.field("sim").to_numpy().astype(np.int64), flat.field("id").to_numpy()
            owner = np.repeat(np.arange(len(lens)), lens)
            order = np.lexsort((-ids, -sims, owner))
            sims, ids, owner = sims[order], ids[order], owner[order]
            once = np.ones(len(ids), bool)
            once[1:] = (ids[1:] != ids[:-1]) | (owner[1:] != owner[:-1])  # one node has one similarity, so copies are neighbours
            sims, ids, owner = sims[once], ids[once], owner[once]
            first = np.searchsorted(owner, np.arange(len(lens)))
            good = np.arange(len(ids)) - first[owner] < k
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner[good], minlength=len(lens)))))
            kept = pa.StructArray.from_arrays([pa.array(sims[good].astype(np.int32)), pa.array(ids[good])], names=["sim", "id"])
            yield batch.set_column(at, column, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), kept))

    return rows.mapInArrow(run, rows.schema)


def _codes(nodes: DataFrame) -> DataFrame:
    """(id, band, code, q_code): the extended vectors as 8-bit integers, and as queries, whose added component is 0."""
    peak = F.array_max(F.transform("v", F.abs))
    nodes = nodes.select("id", "v", (peak * F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / peak) * (x / peak)))).alias("norm"))
    norms = nodes.agg(F.max("norm").alias("top"), F.min("norm").alias("low"), F.max(peak).alias("peak")).first()
    top = float(norms["top"] or 1.0)
    even = float(norms["low"] or 1.0) > top * (1 - 1e-6)
    peak = float(norms["peak"] or 1.0) / top

    def code(batches):
        for batch in batches:
            n = batch.num_rows
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
            norm = batch.column(2).to_numpy(zero_copy_only=False)
            band = np.zeros(n, np.int32) if even else np.floor(np.log2(top / norm)).astype(np.int32)
            if even:
                q = asks = np.rint(v / top * (127 / peak)).astype(np.int8)
            else:
                share = np.minimum(norm / np.ldexp(top, -band), 1)[:, None]
                q = np.rint(np.column_stack((v / norm[:, None] * share, np.sqrt(1 - share**2))) * 127).astype(np.int8)
                asks = np.column_stack((np.rint(v / np.abs(v).max(axis=1, keepdims=True) * 127), np.zeros(n))).astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(band, pa.int32()), *(pa.array([r.tobytes() for r in m], pa.binary()) for m in (q, asks))], names=["id", "band", "code", "q_code"])

    return nodes.mapInArrow(code, "id bigint, band int, code binary, q_code binary")


def _matrix(codes) -> np.ndarray:
    """Codes as a matrix whose products are exact integers."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    n = len(codes)
    flat = np.frombuffer(b"".join(codes.to_pylist()), np.int8)
    return flat.reshape(n, -1).astype(np.float32 if len(flat) // max(n, 1) <= 1000 else np.float64)


def _top_rows(ids: np.ndarray, x: np.ndarray, k: int):
    """For each row of a block its k most similar others."""
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    k = min(k, len(ids) - 1)
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(ids), 0), int)
    return at, np.take_along_axis(sims, at, axis=1)


def first_graph(codes: DataFrame, sizes: dict[int, int], k: int, space: Workspace) -> DataFrame:
    """(id, nbrs) from the blocks of random projection trees, each band by itself."""
    depth = {b: max(0, int(np.ceil(np.log2(max(n, 1) / (BLOCK / 2))))) for b, n in sizes.items()}
    bits = max(depth.values(), default=0)
    trees = TREES if bits else 1

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2))
            planes = (stream(99, trees * max(bits, 1) * x.shape[1]).astype(np.float64) / 2**63 - 1).reshape(trees * max(bits, 1), -1)
            signs = (x @ planes.T > 0).reshape(len(x), trees, -1)
            leaf = (signs * (1 << np.arange(signs.shape[2]))).sum(axis=2) if bits else np.zeros((len(x), trees), np.int64)
            leaf &= (1 << np.array([depth[b] for b in batch.column(1).to_pylist()], np.int64))[:, None] - 1
            for t in range(trees):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(x), t), pa.int32()), pa.array(leaf[:, t].astype(np.int64))], names=["id", "band", "code", "tree", "leaf"])

    placed = codes.select("id", "band", "code").mapInArrow(place, "id bigint, band int, code binary, tree int, leaf bigint")
    sizes = placed.groupBy("band", "tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    placed = placed.join(sizes, ["band", "tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.col("parts")))

    def block(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        out = []
        for lo in range(0, len(ids), 2 * BLOCK):  # a part is about BLOCK nodes; far larger ones are cut again
            own = ids[lo : lo + 2 * BLOCK]
            at, sims = _top_rows(own, _matrix(table.column("code").slice(lo, len(own))), k if not bits else 16)
            out += [[{"sim": int(s), "id": int(own[j])} for j, s in zip(a, b)] for a, b in zip(at, sims)]
        return pa.table({"id": pa.array(ids, pa.int64()), "nbrs": pa.array(out, pa.list_(pa.struct([("sim", pa.int32()), ("id", pa.int64())])))})

    found = placed.groupBy("band", "tree", "leaf", "part").applyInArrow(block, f"id bigint, nbrs {_LIST}")
    merged = found.groupBy("id").agg(F.flatten(F.collect_list("nbrs")).alias("nbrs"))
    return space.save(_best(merged, "nbrs", k).withColumn("old", F.array().cast("array<bigint>")), "graph0")


def _meet(codes: DataFrame, graph: DataFrame, step: int) -> DataFrame:
    """The local joins of one round: (id, nbrs) of better neighbours found.

    graph has, of each node's neighbours, `fresh` ones that meet for the first time and `known` ones, both bounded.
    """
    edge = graph.select("id", F.explode("fresh").alias("nbr"), F.lit(True).alias("fresh")).union(graph.select("id", F.explode("known").alias("nbr"), F.lit(False).alias("fresh")))
    few = Window.partitionBy("w", "fresh").orderBy(F.xxhash64(F.lit(step), "w", "m"))
    forward = edge.select(F.col("id").alias("w"), F.col("nbr").alias("m"), "fresh")
    backward = edge.select(F.col("nbr").alias("w"), F.col("id").alias("m"), "fresh")
    backward = backward.withColumn("r", F.row_number().over(few)).where(F.col("r") <= MEET).drop("r")
    member = forward.union(backward)
    least = graph.select(F.col("id").alias("m"), F.element_at("nbrs", -1)["sim"].alias("least")).join(codes.withColumnRenamed("id", "m"), "m", "right")
    lists = member.join(least, "m").groupBy("w").agg(F.collect_list(F.struct("m", "fresh", "least", "code")).alias("all"))

    def join(batches):
        kind = pa.list_(pa.struct([("sim", pa.int32()), ("id", pa.int64())]))
        for batch in batches:
            ids, nbrs = [], []
            column = batch.column(0)
            offs, flat = column.offsets.to_numpy(), column.flatten()
            offs = offs - offs[0]
            every = flat.field("m").to_numpy()
            fresh_all = flat.field("fresh").to_numpy(zero_copy_only=False).astype(bool)
            least_all = np.nan_to_num(flat.field("least").to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf)
            x_all = _matrix(flat.field("code")) if len(flat) else np.zeros((0, 1))
            for i in range(len(offs) - 1):
                lo, hi = offs[i], offs[i + 1]
                m, fresh, least = every[lo:hi], fresh_all[lo:hi], least_all[lo:hi]
                if not fresh.any():
                    continue
                sims = x_all[lo:hi] @ x_all[lo:hi].T
                good = (fresh[:, None] | fresh[None, :]) & (sims > least[:, None]) & (m[:, None] != m[None, :])
                for a in np.flatnonzero(good.any(axis=1)):
                    at = np.flatnonzero(good[a])
                    if len(at) > 8:
                        at = at[np.argpartition(-sims[a, at], 7)[:8]]
                    ids.append(int(m[a]))
                    nbrs.append([{"sim": int(sims[a, j]), "id": int(m[j])} for j in at])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nbrs, kind)], names=["id", "nbrs"])

    return lists.select("all").mapInArrow(join, f"id bigint, nbrs {_LIST}")


def neighbour_graph(codes: DataFrame, sizes: dict[int, int], space: Workspace, k: int = K) -> DataFrame:
    """(id, nbrs): for every node up to k near nodes of its band, best first.  sizes: the nodes of each band."""
    n = sum(sizes.values())
    graph = first_graph(codes, sizes, k, space)
    codes = codes.select("id", "code")
    if n <= BLOCK // 2:  # one block has seen every pair
        return graph.select("id", "nbrs")
    for step in count(1):
        ids = F.transform("nbrs", lambda x: x["id"])

        def sample(array: Column, step: int = step) -> Column:
            order = F.array_sort(F.transform(array, lambda x: F.struct(F.xxhash64(F.lit(step), "id", x).alias("h"), x.alias("x"))))
            return F.slice(F.transform(order, lambda y: y["x"]), 1, MEET)

        graph = graph.withColumn("fresh", sample(F.array_except(ids, "old"))).withColumn("known", sample(F.array_intersect(ids, "old")))
        graph = space.save(graph.withColumn("old", F.array_union("old", "fresh")), f"sample{step}")
        found = _meet(codes, graph, step).select("id", "nbrs", F.lit(None).cast("array<bigint>").alias("old"))
        merged = graph.select("id", "nbrs", "old").union(found).groupBy("id").agg(F.flatten(F.collect_list("nbrs")).alias("nbrs"), F.first("old", ignorenulls=True).alias("old"))
        merged = _best(merged, "nbrs", k)
        ids = F.transform("nbrs", lambda x: x["id"])
        graph = space.save(merged.select("id", "nbrs", F.array_intersect("old", ids).alias("old")), f"graph{step}")
        fresh = graph.agg(F.sum(F.size("nbrs") - F.size("old"))).first()[0] or 0
        space.drop(f"sample{step}", f"graph{step - 1}")
        space.release()
        if fresh < 0.01 * k * n:
            break
    return graph.select("id", "nbrs")


def compare(asking: DataFrame, codes: DataFrame, beam: int = BEAM) -> DataFrame:
    """asking (q, q_code) -> (q, band, near): in each band the nearest of up to SAMPLE nodes, all of a small band, best first."""
    order = Window.partitionBy("band").orderBy(F.xxhash64("id"), "id")
    rows = codes.select("id", "band", "code").withColumn("r", F.row_number().over(order)).where(F.col("r") <= SAMPLE).drop("r").toArrow().sort_by([("band", "ascending"), ("id", "ascending")])
    bands = rows.column("band").to_numpy()
    cuts = np.flatnonzero(np.diff(bands, prepend=-1, append=-1))
    table = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.int8).reshape(len(bands), -1)
    shared = codes.sparkSession.sparkContext.broadcast((bands, rows.column("id").to_numpy(), table, cuts))

    def run(batches):
        bands, ids, table, cuts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                asks = _matrix(part.column(1))
                for lo, hi in zip(cuts, cuts[1:]):
                    sims = asks @ table[lo:hi].astype(asks.dtype).T
                    k = min(beam, hi - lo)
                    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                    found = pa.StructArray.from_arrays([pa.array(np.take_along_axis(sims, best, axis=1).astype(np.int32).ravel()), pa.array(ids[lo:hi][best].ravel())], names=["sim", "id"])
                    near = pa.ListArray.from_arrays(pa.array(np.arange(0, best.size + 1, k), pa.int32()), found)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(asks), bands[lo]), pa.int32()), near], names=["q", "band", "near"])

    found = asking.select("q", "q_code").mapInArrow(run, f"q bigint, band int, near {_LIST}")
    return found.withColumn("near", F.sort_array(F.filter("near", lambda x: x["id"] != F.col("q")), asc=False))


def search(begin: DataFrame, codes: DataFrame, graph: DataFrame, space: Workspace, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """begin (q, band, near: where it begins) -> (q, near): the nodes found nearest to each in each band, best first."""
    links = graph.select(F.col("id").alias("node"), F.transform("nbrs", lambda x: x["id"]).alias("next"))
    own = codes.select(F.col("id").alias("q"), "q_code")
    codes = codes.select("id", "code")
    state = space.save(begin.select("q", "band", "near", F.array().cast("array<bigint>").alias("done")), "search0")

    def product(batches):
        for batch in batches:
            if batch.num_rows:
                sims = np.einsum("ij,ij->i", _matrix(batch.column(3)), _matrix(batch.column(4)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sims.astype(np.int32))], names=["q", "band", "id", "sim"])

    for step in count(1):
        chosen = F.slice(F.array_except(F.transform("near", lambda x: x["id"]), "done"), 1, expand)
        state = space.save(state.withColumn("go", chosen), f"chosen{step}")
        if not state.where(F.size("go") > 0).limit(1).count():
            break
        step_to = state.select("q", "band", F.explode("go").alias("node")).join(links, "node").select("q", "band", F.explode("next").alias("id"))
        seen = state.select("q", F.explode(F.concat("done", F.transform("near", lambda x: x["id"]))).alias("id"))
        new = step_to.distinct().join(seen, ["q", "id"], "left_anti")
        scored = new.join(own, "q").join(codes, "id").select("q", "band", "id", "q_code", "code").mapInArrow(product, "q bigint, band int, id bigint, sim int")
        worst = F.coalesce(F.when(F.size("near") >= beam, F.element_at("near", -1)["sim"]), F.lit(-(1 << 31)))
        better = scored.join(state.select("q", "band", worst.alias("worst")), ["q", "band"]).where("sim > worst").groupBy("q", "band").agg(F.collect_list(F.struct("sim", "id")).alias("more"))
        nxt = state.join(better, ["q", "band"], "left").select("q", "band", F.concat("near", F.coalesce("more", F.array().cast(_LIST))).alias("near"), F.concat("done", "go").alias("done"))
        state = space.save(_best(nxt, "near", beam), f"search{step}")
        space.drop(f"chosen{step}", f"search{step - 1}")
        space.release()
    return state.select("q", "near")


def nearest(embeddings: DataFrame, is_query: Column, top: int = TOP) -> DataFrame:
    """embeddings (vec_id, embedding) -> query_id, rank, vec_id, score: for each row with is_query its `top` nearest found."""
    space = Workspace(embeddings.sparkSession, "ann")
    rows = space.save(valid_vectors(embeddings), "vectors")
    # of equal vectors only the smallest vec_ids can be among the nearest; partial limits keep a hot vector off the shuffle
    first = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= top + 1)
    nodes = space.save(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members")).withColumn("id", F.element_at("members", 1)), "nodes")
    n = nodes.count()
    # a vec_id with several vectors: the nodes are told apart by a number of their own
    if nodes.select("id").distinct().count() < n:
        nodes = space.save(nodes.withColumn("id", F.xxhash64("v", "id")), "nodes_apart")
    codes = space.save(_codes(nodes), "codes")
    sizes = {r["band"]: r["count"] for r in codes.groupBy("band").count().collect()}
    large = sizes if len(sizes) <= 1 else {b: c for b, c in sizes.items() if c > SAMPLE}
    some = codes.where(F.col("band").isin(list(large)))
    asked = rows.where(is_query).join(nodes.select("v", "id"), "v").select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), F.col("id").alias("q"))
    asked = space.save(asked, "queries")
    # a query's own node comes first in its band, so that it is expanded first
    own = F.array(F.struct(F.lit((1 << 31) - 1).alias("sim"), F.col("q").alias("id")))
    asking = asked.select("q").distinct().join(codes.withColumnRenamed("id", "q"), "q")
    begin = asking.select("q", "band", own.alias("near"))
    if len(sizes) > 1:
        seen = space.save(compare(asking, codes), "compared")
        home = asking.select("q", F.col("band").alias("home"))
        begin = seen.join(home, "q").select("q", "band", F.when(F.col("band") == F.col("home"), F.concat(own, "near")).otherwise(F.col("near")).alias("near"))
    found = begin.select("q", "near")
    if large:
        walked = search(begin.where(F.col("band").isin(list(large))), codes, neighbour_graph(some, large, space), space)
        found = walked if len(large) == len(sizes) else walked.union(begin.where(~F.col("band").isin(list(large))).select("q", "near"))
    near = found.select("q", F.explode(F.concat(F.array(F.col("q")), F.transform("near", lambda x: x["id"]))).alias("id")).distinct()
    near = near.join(nodes.select("id", "v", "members"), "id")
    # scored once for each vector that asks, however many rows have it; a row drops itself from its vector's list
    own = asked.groupBy("q").agg(F.first("qv").alias("qv"))
    rated = near.join(own, "q").select("q", F.explode(F.transform("members", lambda m: F.struct((-_dot("qv", "v")).alias("below"), m.alias("vec_id")))).alias("x"))
    lists = space.save(rated.groupBy("q").agg(F.slice(F.array_sort(F.collect_list("x")), 1, top + 1).alias("best")), "lists")
    out = asked.select("query_id", "q").join(lists, "q").select("query_id", F.posexplode(F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, top)).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", (-F.col("x.below")).alias("score"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.pmod("vec_id", F.lit(20)) == 0)
