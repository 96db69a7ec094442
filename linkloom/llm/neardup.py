"""Near duplicates by min-max hashing.

Every permutation of the shingle hashes yields two values, the minimum and the maximum, so a signature of 2 * k values
costs k hash evaluations for each shingle.  The values are cut into bands; documents that agree on a band are candidates,
and every link is confirmed on the full shingle sets.

What keeps it whole and even at any size:

* Documents with the same shingle set are collapsed into one representative before anything is compared.
* In each bucket all members are compared with the most central one, the one that shares most buckets with others, but
  only while they aren't in one component; all pairs of a bucket are compared only if it is small.
* What larger buckets leave unlinked is compared exactly afterwards: the members outside the largest component of such a
  family of buckets, as a query set, against all its members, block by block (`_rest`).
* Components are found by joins; no link reaches the driver.

The chance that the bands miss a pair at similarity 0.8 is (1 - 0.8**5)**30 = 7e-6; above 0.8 it is smaller.

Defined results: a text that is null or has no word has an empty set and is linked with nothing; a null doc_id is linked
with nothing and kept; rows that share a doc_id count as one document; other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .kernels import SPACE_WORDS, Words, mix, shingle_sets, signed, slices, stream, string_parts
from .storage import Workspace, lean

BANDS, ROWS = 30, 5
#: Buckets up to this size are compared in all pairs, in the second round.
SMALL = 8
#: Documents in a block of the exact comparison of the rest.
BLOCK = 512


class MinMax:
    """Signatures of `bands * rows` values from half as many permutations x -> a * x + b modulo 2**64."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 1):
        self.bands, self.rows = bands, rows
        k = (bands * rows + 1) // 2
        values = stream(seed << 32, 2 * k + bands * rows)
        self.a, self.b, self.c = values[:k] | np.uint64(1), values[k : 2 * k], values[2 * k :] | np.uint64(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        low, high = np.full(len(self.a), ~np.uint64(0)), np.zeros(len(self.a), np.uint64)
        for lo in range(0, len(shingles), 2048):
            h = shingles[lo : lo + 2048, None] * self.a + self.b
            np.minimum(low, h.min(axis=0), out=low)
            np.maximum(high, h.max(axis=0), out=high)
        return np.concatenate((low, high))[: self.bands * self.rows]

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        return mix((self.signature(shingles) * self.c).reshape(self.bands, self.rows).sum(axis=1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64))


def _sets(batch, text: int, size: int):
    """(row, shingle hashes) of every row of the batch."""
    raw, offs = string_parts(batch.column(text))
    for lo, hi in slices(offs):
        part = offs[lo : hi + 1] - offs[lo]
        words = Words(raw[offs[lo] : offs[hi]], part, SPACE_WORDS)
        yield from zip(range(lo, hi), shingle_sets(words, hi - lo, size))


def signatures(docs: DataFrame, size: int, minmax: MinMax) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (a 128-bit digest of the set) and the band keys (null for empty sets)."""

    def sign(batches):
        for batch in batches:
            n, s1, s2, keys = [], [], [], []
            for _, x in _sets(batch, 1, size):
                n.append(len(x))
                s1.append(int(mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
                s2.append(int(np.bitwise_xor.reduce(mix(x + np.uint64(0x14057B7EF767814F)))) if len(x) else 0)
                keys.append(signed(minmax.keys(x)) if len(x) else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n": pa.array(n, pa.int64()), "s1": pa.array(signed(np.array(s1, np.uint64))),
                "s2": pa.array(signed(np.array(s2, np.uint64))), "keys": pa.array(keys, pa.list_(pa.int64())),
            })

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(sign), "doc_id bigint, n bigint, s1 bigint, s2 bigint, keys array<bigint>")


class Bloom:
    """A Bloom filter of the one column of a table, of 16 MB at most; at most 16 partial filters reach the driver."""

    def __init__(self, ids: DataFrame):
        self.n_bits = 1 << min(27, max(16, (12 * ids.count()).bit_length()))
        self.shared = ids.sparkSession.sparkContext.broadcast(self._filled(ids))

    def _filled(self, ids: DataFrame) -> np.ndarray:
        n_bits = self.n_bits

        def fill(batches):
            bits = np.zeros(n_bits, bool)
            for batch in batches:
                for at in _bloom_places(batch.column(0).to_numpy(zero_copy_only=False), n_bits):
                    bits[at] = True
            yield pa.RecordBatch.from_pydict({"bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

        total = np.zeros(n_bits // 8, np.uint8)
        # an exchange of ids, so that what makes them keeps its own number of tasks
        for row in ids.repartition(16).mapInArrow(lean(fill), "bits binary").toLocalIterator():
            total |= np.frombuffer(row["bits"], np.uint8)
        return total

    def may_hold(self, values: pa.Array) -> np.ndarray:
        """A mask: False where a value is surely not among the ids; null is never."""
        known = np.asarray(values.is_valid()).copy() if values.null_count else np.ones(len(values), bool)
        numbers, bits = values.fill_null(0).to_numpy(zero_copy_only=False), self.shared.value
        for at in _bloom_places(numbers, self.n_bits):
            known &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return known


def _bloom_places(ids: np.ndarray, n_bits: int):
    x = mix(ids.astype(np.int64).view(np.uint64))
    step = (x >> np.uint64(32)) | np.uint64(1)
    return [((x + np.uint64(k) * step) % np.uint64(n_bits)).astype(np.int64) for k in range(4)]


def _only(rows: DataFrame, bloom: Bloom) -> DataFrame:
    """The rows whose first column the filter may hold, so that the others need no shuffle before a join."""

    def take(batches):
        for batch in batches:
            chosen = batch.filter(pa.array(bloom.may_hold(batch.column(0))))
            if chosen.num_rows:
                yield chosen

    return rows.mapInArrow(lean(take), rows.schema)


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is among ids (one column, no nulls).

    Rows that a Bloom filter of ids surely doesn't hold pass at once; only the others are joined, so that few texts are
    shuffled.  Rows without doc_id stay.
    """
    bloom, at = Bloom(ids), docs.columns.index("doc_id")

    def part(held: bool) -> DataFrame:
        def take(batches):
            for batch in batches:
                chosen = batch.filter(pa.array(bloom.may_hold(batch.column(at)) == held))
                if chosen.num_rows:
                    yield chosen

        return docs.mapInArrow(lean(take), docs.schema)

    joined = part(True).join(ids.select(F.col(ids.columns[0]).alias("doc_id")), "doc_id", "left_anti")
    return part(False).union(joined.select(*docs.columns))


def _shared_bands(reps: DataFrame, bloom: Bloom) -> DataFrame:
    """(id, n, key) of the band keys that the filter may hold."""

    def pick(batches):
        for batch in batches:
            owner, key = batch.column(2).value_parent_indices(), batch.column(2).flatten()
            held = pa.array(bloom.may_hold(key))
            owner = owner.filter(held)
            if len(owner):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), batch.column(1).take(owner), key.filter(held)], names=["id", "n", "key"])

    return reps.select("id", "n", "keys").mapInArrow(lean(pick), "id bigint, n bigint, key bigint")


def candidate_sets(docs: DataFrame, ids: DataFrame, size: int, space: Workspace, name: str) -> DataFrame:
    """(id, shingles) of the documents named by ids (id), and perhaps some more.

    The texts are scanned again, behind a Bloom filter of fixed size, rather than stored or shuffled as sets for all.
    """
    bloom = Bloom(ids)

    def take(batches):
        for batch in batches:
            chosen = batch.filter(pa.array(bloom.may_hold(batch.column(0))))
            if chosen.num_rows:
                sets = [signed(x) for _, x in _sets(chosen, 1, size)]
                yield pa.RecordBatch.from_pydict({"id": chosen.column(0), "shingles": pa.array(sets, pa.list_(pa.int64()))})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return space.save(rows.mapInArrow(lean(take), "id bigint, shingles array<bigint>"), name)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    x = _only(sets, Bloom(pairs.select("a"))).select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    y = _only(sets, Bloom(pairs.select("b"))).select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(y, "b").join(x, "a")
    both = F.size(F.array_intersect("x", "y"))
    return joined.where(both * 100 >= (F.size("x") + F.size("y") - both) * percent).select("a", "b")


def _sizes_fit(percent: int):
    return (F.least("na", "nb") * 100) >= (F.greatest("na", "nb") * percent)


def _rest(unsolved: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, space: Workspace) -> DataFrame | None:
    """More links (a, b), exactly: in families of large buckets that still hold several components.

    unsolved: (key, id) of such buckets.  Buckets that share a document form a family.  In each family the documents
    outside its largest component are compared with all of the family, in blocks of documents; a task gives, for a
    document, one link to each other component at most.
    """
    hub = unsolved.groupBy("key").agg(F.min("id").alias("b"))
    family = connected_components(unsolved.join(hub, "key").select(F.col("id").alias("a"), "b").distinct(), space, "family")
    member = space.save(family.select("id", F.col("comp").alias("family")).join(labels, "id"), "members")
    sizes = member.groupBy("family", "comp").count()
    main = sizes.groupBy("family").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), F.sum("count").alias("n"), F.max("count").alias("top"))
    main = main.withColumns({"q_blocks": F.ceil((F.col("n") - F.col("top")) / BLOCK).cast("int"), "t_blocks": F.ceil(F.col("n") / BLOCK).cast("int")}).where("q_blocks > 0")
    placed = member.join(main, "family").join(sets, "id")
    place = F.xxhash64("id")
    asked = placed.where("comp <> main").select("family", F.pmod(place, F.col("q_blocks")).cast("int").alias("q"), F.explode(F.sequence(F.lit(0), F.col("t_blocks") - 1)).alias("t"), F.lit(True).alias("asks"), "id", "comp", "shingles")
    held = placed.select("family", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("q"), F.pmod(place, F.col("t_blocks")).cast("int").alias("t"), F.lit(False).alias("asks"), "id", "comp", "shingles")

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids, comps = table.column("id").to_numpy(), table.column("comp").to_numpy()
        lists = table.column("shingles").combine_chunks()
        offs, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        targets = np.flatnonzero(~asks)
        a, b = [], []
        if len(targets) and asks.any():
            sizes = offs[targets + 1] - offs[targets]
            elems = np.concatenate([flat[offs[t] : offs[t + 1]] for t in targets])
            owner = np.repeat(np.arange(len(targets)), sizes)
            order = np.argsort(elems, kind="stable")
            elems, owner = elems[order], owner[order]
            for q in np.flatnonzero(asks):
                own = flat[offs[q] : offs[q + 1]]
                lo, hi = np.searchsorted(elems, own, "left"), np.searchsorted(elems, own, "right")
                n = hi - lo
                got = owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                both = np.bincount(got, minlength=len(targets))
                linked = np.flatnonzero((both * 100 >= (sizes + len(own) - both) * percent) & (comps[targets] != comps[q]))
                for c in np.unique(comps[targets[linked]]):
                    a.append(ids[q])
                    b.append(ids[targets[linked[comps[targets[linked]] == c][0]]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return space.save(asked.unionByName(held).groupBy("family", "q", "t").applyInArrow(compare, "a bigint, b bigint"), "rest")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, small: int = SMALL, space: Workspace | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest linked doc_id), kept.

    docs: doc_id, text.  Two documents are linked if 100 * |A & B| >= percent * |A | B|, A and B being their sets of
    `size`-word shingles; a text of fewer words is one shingle.  space: where the tables go that the result reads.
    """
    space = space or Workspace(docs.sparkSession, "neardup")
    signed_docs = space.save(signatures(docs, size, MinMax(bands, rows)), "signatures")
    known = signed_docs.where("n > 0 AND doc_id IS NOT NULL")
    # one representative for each distinct set
    reps = space.save(known.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("id"), F.min_by("keys", "doc_id").alias("keys")), "representatives")
    shared = reps.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = space.save(shared, "shared")
    bucket = space.save(_shared_bands(reps, Bloom(shared.select("key"))).join(shared, "key"), "buckets")
    central = bucket.groupBy("id").agg(F.sum("c").alias("central"))
    hub = bucket.join(central, "id").groupBy("key").agg(F.max_by(F.struct("id", "n", "central"), F.struct("central", -F.col("id"))).alias("hub"))
    met = bucket.join(hub, "key").select(F.col("hub.id").alias("hub"), "id", F.col("hub.n").alias("na"), F.col("n").alias("nb"), "hub.central")
    met = space.save(met.where((F.col("hub") != F.col("id")) & _sizes_fit(percent)).groupBy("hub", "id").agg(F.max("central").alias("central")), "met")
    space.release(executors=True)
    sets = candidate_sets(docs, bucket.select("id").distinct(), size, space, "sets")
    same_id = known.groupBy("doc_id").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).where("lo <> hi").select(F.col("doc_id").alias("id"))

    # first the most central document that each one met, then the others of which it isn't yet a part
    once = met.groupBy("id").agg(F.max_by("hub", F.struct("central", -F.col("hub"))).alias("hub"))
    once = space.save(once.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct(), "pairs1")
    links = space.save(_confirmed(once, sets, percent), "links1")
    space.release(executors=True)
    part = connected_components(links, space, "cc1")
    others = met.join(part.select(F.col("id"), F.col("comp").alias("ci")), "id", "left").join(part.select(F.col("id").alias("hub"), F.col("comp").alias("ch")), "hub", "left")
    others = others.where(F.coalesce("ci", "id") != F.coalesce("ch", "hub")).select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()
    others = space.save(others.join(once, ["a", "b"], "left_anti"), "pairs2")
    links = links.union(space.save(_confirmed(others, sets, percent), "links2"))
    pairs = once.union(others)
    space.drop("met")
    space.release(executors=True)

    def labelled(step: str):
        found = connected_components(links, space, step)
        return bucket.join(found, "id", "left").select("key", "id", "n", "c", F.coalesce("comp", "id").alias("comp"))

    # the small buckets that hold more than one component, in all pairs that the first round left
    now = space.save(labelled("cc2"), "labels1")
    open_keys = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    left = space.save(now.join(open_keys, "key"), "open")
    few = left.where(F.col("c") <= small)
    few = few.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("id", "n", "comp"))).alias("m"))
    two = few.select(F.explode(F.expr("flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> struct(x.id AS a, y.id AS b, x.n AS na, y.n AS nb, x.comp AS ca, y.comp AS cb))))")).alias("p")).select("p.*")
    two = two.where((F.col("ca") != F.col("cb")) & (F.col("a") != F.col("b")) & _sizes_fit(percent)).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
    two = space.save(two, "pairs3")
    links = links.union(space.save(_confirmed(two, sets, percent), "links3"))

    space.release(executors=True)
    unsolved = left.where(F.col("c") > small)
    if unsolved.limit(1).count():
        now = space.save(labelled("cc3").where(F.col("c") > small), "labels2")
        open_keys = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        unsolved = space.save(now.join(open_keys, "key").select("key", "id", "comp"), "unsolved")
        if unsolved.limit(1).count():
            links = links.union(_rest(unsolved.select("key", "id"), unsolved.select("id", "comp").distinct(), sets, percent, space))

    # one id for all that share a set or a doc_id
    found = connected_components(links, space, "cc")
    space.drop("buckets", "sets", "open")
    space.release(executors=True)
    by_set = reps.select("s1", "s2", "n", "id").join(found, "id", "left").select("s1", "s2", "n", F.coalesce("comp", "id").alias("comp"))
    out = signed_docs.select("doc_id", "n", "s1", "s2").join(by_set, ["s1", "s2", "n"], "left")
    out = out.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("comp"))
    if same_id.limit(1).count():  # a doc_id with several texts joins their components
        ties = out.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        more = out.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("a"), F.col("comp").alias("b"))
        joined = connected_components(more.union(ties.select(F.col("lo").alias("a"), F.col("hi").alias("b"))), space, "ids")
        out = out.join(joined.select(F.col("id").alias("doc_id"), F.col("comp").alias("far")), "doc_id", "left").select("doc_id", "n", F.coalesce("far", "comp").alias("comp"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("comp")).alias("kept"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=2)


#: Word pairs as sets, all candidate pairs by shared word pairs, and the links' closure.
OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{20}\x{09}-\x{0D}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
sets AS (SELECT doc_id, list_sort(list(g)) AS x, count(*) AS n FROM s GROUP BY 1),
reps AS (SELECT x, n, min(doc_id) AS id FROM sets GROUP BY 1, 2),
rs AS (SELECT id, n, unnest(x) AS g FROM reps),
freq AS (SELECT g, count(*) AS f FROM rs GROUP BY 1),
ranked AS (SELECT id, n, g, row_number() OVER (PARTITION BY id ORDER BY f, g) AS r FROM rs JOIN freq USING (g)),
prefix AS (SELECT id, n, g FROM ranked WHERE r <= n - CAST(ceil(n * 0.8) AS BIGINT) + 1),
cand AS (SELECT DISTINCT p.id AS a, q.id AS b, p.n AS na, q.n AS nb FROM prefix p JOIN prefix q USING (g)
         WHERE p.id < q.id AND least(p.n, q.n) * 100 >= greatest(p.n, q.n) * 80),
overlap AS (SELECT a, b, na, nb, len(list_intersect(ra.x, rb.x)) AS k FROM cand JOIN reps ra ON ra.id = a JOIN reps rb ON rb.id = b),
link AS (SELECT a, b FROM overlap WHERE k * 100 >= (na + nb - k) * 80),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT id AS a, id AS b FROM reps UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
comp AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id, d.doc_id = coalesce(comp.c, d.doc_id) AS kept
FROM documents d LEFT JOIN sets USING (doc_id) LEFT JOIN reps ON reps.x = sets.x LEFT JOIN comp ON comp.id = reps.id
"""
