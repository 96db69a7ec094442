"""Benchmark decontamination: a broadcast hash set of test n-grams against every token window of the training texts.

A window is `size` consecutive words of a benchmark item; a shorter item, unless it has no words, is one window.  The
windows' 64-bit hashes go to every task, each candidate is verified on the words themselves, and the words inside any
occurrence are hit.  The hash set has a checked size: beyond `max_windows` it is cut into slices by hash, and the texts
are scanned once for each slice, carrying the hits along without a shuffle.

Defined results: a null text has no words; a null item or one without words adds no window; windows of an item whose
item_id is null still hit words, but the item isn't listed; repeated rows are treated row by row; columns of any name
beside ``doc_id`` and ``text`` are carried through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import ALNUM_WORDS, Words, signed, slices, string_parts
from .storage import Workspace

WINDOW = 10
#: Windows in one broadcast; with their words about 150 bytes each.
MAX_WINDOWS = 500_000
_SPANS = "array<struct<start:int,end:int>>"


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row for each distinct (window, item): hash, n_words, words, item."""

    def cut(batches):
        for batch in batches:
            items = batch.column(0).to_pylist()
            raw, offs = string_parts(batch.column(1))
            words = Words(raw, offs, ALNUM_WORDS)
            out = []
            for i, item in enumerate(items):
                lo, hi = int(words.first[i]), int(words.first[i + 1])
                n = min(size, hi - lo)
                for at in range(lo, hi - n + 1 if n else lo):
                    out.append((at, n, words.text(at, at + n), item))
            at_n: dict[int, dict[int, int]] = {}
            for n in {n for _, n, _, _ in out}:
                at, h = words.windows(n)
                at_n[n] = dict(zip(at.tolist(), signed(h).tolist()))
            yield pa.RecordBatch.from_pydict({
                "hash": pa.array([at_n[n][at] for at, n, _, _ in out], pa.int64()),
                "n_words": pa.array([n for _, n, _, _ in out], pa.int32()),
                "words": pa.array([w for _, _, w, _ in out], pa.binary()),
                "item": pa.array([x for _, _, _, x in out], pa.string()),
            })

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "hash bigint, n_words int, words binary, item string").distinct()


class _Windows:
    """The hash set of one slice: hashes by window length, and the words and items behind each hash."""

    def __init__(self, rows):
        self.behind: dict[int, dict[int, dict[bytes, list[str]]]] = {}
        for r in rows:
            items = self.behind.setdefault(r["n_words"], {}).setdefault(r["hash"], {}).setdefault(bytes(r["words"]), [])
            if r["item"] is not None:
                items.append(r["item"])
        self.hashes = {n: np.sort(np.array(list(x), dtype=np.int64).view(np.uint64)) for n, x in self.behind.items()}
        self.sieve = {}
        for n, h in self.hashes.items():
            self.sieve[n] = np.zeros(1 << 20, dtype=bool)
            self.sieve[n][(h >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, words: Words):
        """Verified occurrences: word position, length, items."""
        for n, known in self.hashes.items():
            at, h = words.windows(n)
            maybe = np.flatnonzero(self.sieve[n][(h >> np.uint64(44)).astype(np.int64)])
            at, h = at[maybe], h[maybe]
            i = np.minimum(np.searchsorted(known, h), len(known) - 1)
            same = known[i] == h
            for p, key in zip(at[same].tolist(), signed(h[same]).tolist()):
                items = self.behind[n][key].get(words.text(p, p + n))
                if items is not None:
                    yield p, n, items


def _scanner(shared, remove: bool):
    def scan(batches):
        windows = shared.value
        for batch in batches:
            row = batch.column(0)
            raw_all, offs_all = string_parts(row.field("text"))
            before = batch.column(1).to_pylist()
            n_words, n_hit, items_out, spans_out, text_out = [], [], [], [], []
            for lo, hi in slices(offs_all):
                base = offs_all[lo]
                raw, offs = raw_all[base : offs_all[hi]], offs_all[lo : hi + 1] - base
                words = Words(raw, offs, ALNUM_WORDS)
                delta = np.zeros(len(words.start) + 1, np.int64)
                found: dict[int, set[str]] = {}
                for i in range(lo, hi):
                    if before[i] is not None:
                        found[i - lo] = set(before[i]["items"])
                        for s in before[i]["spans"]:
                            a, b = np.searchsorted(words.start, [s["start"] + offs[i - lo], s["end"] + offs[i - lo]])
                            delta[a] += 1
                            delta[b] -= 1
                for p, n, items in windows.hits(words):
                    delta[p] += 1
                    delta[p + n] -= 1
                    found.setdefault(int(words.row[p]), set()).update(items)
                hit = np.cumsum(delta[:-1]) > 0
                total = np.concatenate(([0], np.cumsum(hit)))
                n_words += np.diff(words.first).tolist()
                counts = np.diff(total[words.first])
                n_hit += counts.tolist()
                for i in range(hi - lo):
                    spans = []
                    if counts[i]:
                        a, b = words.first[i], words.first[i + 1]
                        edge = np.flatnonzero(np.diff(np.concatenate(([False], hit[a:b], [False])).astype(np.int8)))
                        spans = [{"start": int(words.start[a + s] - offs[i]), "end": int(words.end[a + e - 1] - offs[i])} for s, e in zip(edge[::2], edge[1::2])]
                    spans_out.append(spans)
                    items_out.append(sorted(found.get(i, ())))
                    if remove:
                        own, kept, done = raw[offs[i] : offs[i + 1]].tobytes(), [], 0
                        for s in spans:
                            kept.append(own[done : s["start"]])
                            done = s["end"]
                        text_out.append(b"".join([*kept, own[done:]]).decode("utf-8", "replace") if spans else None)
            found_type = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))])
            out = {
                "row": row,
                "found": pa.array([{"spans": s, "items": x} for s, x in zip(spans_out, items_out)], found_type),
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "cut": pa.array(text_out if remove else [None] * len(n_words), pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return scan


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_windows: int = MAX_WINDOWS, remove: bool = False) -> DataFrame:
    """For each row of docs: ``row`` (the row), ``n_words``, ``n_hit``, ``found.items``, ``found.spans`` (byte ranges of hit words) and, if `remove`, ``cut`` (the text without them; null if nothing is hit)."""
    spark = docs.sparkSession
    space = Workspace(spark, "decontam")
    windows = space.save(benchmark_windows(benchmark, size), "windows")
    n_slices = max(1, -(-windows.count() // max_windows))
    state = docs.withColumn("text", F.col("text").cast("string")).select(F.struct("*").alias("row"), F.lit(None).cast(f"struct<spans:{_SPANS},items:array<string>>").alias("found"))
    kinds = state.schema
    for i in range(n_slices):
        part = windows if n_slices == 1 else windows.where(F.pmod("hash", F.lit(n_slices)) == i)
        shared = spark.sparkContext.broadcast(_Windows(part.toLocalIterator()))
        last = i == n_slices - 1
        scanned = state.select("row", "found").mapInArrow(
            _scanner(shared, remove and last), f"row {kinds['row'].dataType.simpleString()}, found {kinds['found'].dataType.simpleString()}, n_words bigint, n_hit bigint, cut string"
        )
        state = scanned if last else space.save(scanned, f"slice{i}")
    return state


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "document", **how) -> DataFrame:
    """docs without contaminated documents (mode "document") or with the hit words cut out of the texts (mode "span"); the columns stay as they are."""
    if mode not in ("document", "span"):
        raise ValueError("mode is document or span")
    found = find_contamination(docs, benchmark, remove=mode == "span", **how)
    if mode == "document":
        return found.where("n_hit = 0").select("row.*")
    return found.select(*[F.coalesce("cut", F.col("row")["text"]).alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def items_digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", F.array_sort(items)), 256)


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("found.items").cast("bigint").alias("n_items"),
        items_digest(F.col("found.items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Lower-cases A-Z alone, as lower() would also touch other letters.
ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + ASCII_LOWER + r", '[^\x{{00}}-\x{{2F}}\x{{3A}}-\x{{60}}\x{{7B}}-\x{{7F}}]+')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.n, dw.i, bw.item FROM dw JOIN bw USING (g, n)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
