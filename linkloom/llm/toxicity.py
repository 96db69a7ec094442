"""Toxicity by maximum-scoring segments.

Learning: every word and word beginning (3 to 8 letters, for inflected forms) that a bounded sample of labelled documents
holds gets a log-odds with an informative Dirichlet prior; those that stand out as toxic by `Z_MIN` standard errors or as
clean by `Z_CLEAN` keep it as their score.  A word scores what its longest known feature says, any other word a small negative drift, so
the expected score of a clean word is negative.

Scoring: a linear scan finds all maximal scoring segments of the whole text.  A segment's score s in n words has, by
extreme-value theory, the expected number K * n * exp(-lambda * s) of chance segments as good; lambda and K are the
maximum-likelihood fit to the best segments of the sample's clean documents (low scores count as censored, the `NOISE`
share with the highest scores as wrongly labelled).  Segments whose expectation is below `E_MAX` are the
toxic passages.  The best one's log expectation, with the number of passages, gives the document's score by a logistic
fit on the sample.

Near copies in the sample would make the random words of a copied document look toxic, so a cluster of documents with
one minimum shingle hash counts once.  The features that reach the driver are those that pass the tests, however many;
they are a part of the vocabulary of at most `SAMPLE` documents.

Defined results: a null or empty text scores as a text without any passage; without labelled rows, or with one label only,
every score is the share of toxic rows; a null doc_id is never held out nor used for training; repeated rows and extra columns don't matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernels import ALNUM_WORDS, SPACE_WORDS, WordCache, Words, mix, shingle_sets, slices, string_parts
from .sampling import fold, labelled_sample
from .storage import Workspace

#: Labelled documents that training uses at most.
SAMPLE = 16_000
Z_MIN, Z_CLEAN, E_MAX, DRIFT, THRESHOLD = 3.0, 2.0, 1e-3, 0.15, 0.7
#: Weight of the prior, as a share of the documents; clean documents taken as wrongly labelled; documents that a clean word needs.
PRIOR, NOISE, COMMON = 0.1, 0.01, 20
_PREFIX = range(3, 9)


def features(word: str) -> list[str]:
    """The word and its beginnings, longest first; beginnings end with a mark that no word holds."""
    return [word, *(word[:k] + "-" for k in reversed(_PREFIX) if k < len(word))]


class Model:
    """Scores of features, the extreme-value parameters and the logistic fit."""

    def __init__(self, weights: dict[str, float], share: float):
        self.weights, self.share = weights, share
        self.rate, self.constant = 1.0, 1.0
        self.slope: tuple[float, float, float] | None = None

    def word(self, word: bytes) -> float:
        """The score of a word: that of its longest known feature, else the drift."""
        for f in features(word.decode("utf-8", "replace")):
            got = self.weights.get(f)
            if got is not None:
                return got
        return -DRIFT

    def log_expectation(self, score: float, n: int) -> float:
        return math.log(self.constant * max(n, 1)) - self.rate * score

    def probability(self, best: float, n: int, passages: int) -> float:
        """best: the best segment's score, 0 for none."""
        if self.slope is None:
            return self.share
        a, b, c = self.slope
        evidence = max(0.0, -self.log_expectation(best, n)) if best > 0 else 0.0
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a * math.log1p(evidence) + b * math.log1p(passages) + c))))


def segments(at: Sequence[int], before: Sequence[float], after: Sequence[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: start, end, score.

    at: the places with a positive score; before, after: the sums of all scores up to each of them and with it.  Ruzzo
    and Tompa's scan.  Each segment keeps a link to the last one before it whose left sum is smaller, the only one that
    a search has to look at next, which makes the scan linear.
    """
    start: list[int] = []
    end: list[int] = []
    left: list[float] = []
    right: list[float] = []
    link: list[int] = []
    for p, lo, hi in zip(at, before, after):
        first, j = p, len(start) - 1
        while True:
            while j >= 0 and left[j] >= lo:
                j = link[j]
            if j < 0 or right[j] >= hi:
                break
            first, lo, back = start[j], left[j], link[j]
            for line in (start, end, left, right, link):
                del line[j:]
            j = back
        for line, value in ((start, first), (end, p + 1), (left, lo), (right, hi), (link, j)):
            line.append(value)
    return [(a, b, r - l) for a, b, l, r in zip(start, end, left, right)]


def weighted(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """counts (f, t, c: toxic and clean documents with the feature) -> f, w: the features that keep their log-odds as score."""
    t, c, both = F.col("t"), F.col("c"), F.col("t") + F.col("c")
    prior, whole = PRIOR * both, PRIOR * (toxic + clean)
    odds = F.log((t + prior) / (toxic - t + whole - prior + 1e-9)) - F.log((c + prior) / (clean - c + whole - prior + 1e-9))
    rows = counts.withColumn("w", odds).withColumn("z", F.col("w") / F.sqrt(1 / (t + prior) + 1 / (c + prior)))
    strong = rows.where((F.col("z") >= Z_MIN) & (F.col("w") > 1)).select("f", "w")
    clear = rows.where(F.col("z") <= -Z_CLEAN).select("f", "w")
    # a common clean word with a toxic beginning has to be known as clean
    starts = F.array(*[F.when(F.length("f") > k, F.concat(F.substring("f", 1, k), F.lit("-"))) for k in _PREFIX])
    mild = rows.where((F.col("z") < 0) & (F.col("z") > -Z_CLEAN) & (both >= COMMON) & ~F.col("f").endswith("-"))
    mild = mild.select("f", "w", F.explode(starts).alias("start")).join(strong.select(F.col("f").alias("start")), "start", "left_semi").select("f", "w").distinct()
    return strong.union(clear).union(mild)


def _scan(model: Model, cache: WordCache, values: list, raw: np.ndarray, offs: np.ndarray):
    """For each text: the number of words, its segments, and the words' start and end bytes."""
    words = Words(raw, offs, ALNUM_WORDS)
    lowered = words.mapped

    def fill(new):
        values.extend(model.word(x) for x in new)

    number = cache.lookup(words, lowered, fill, values.clear)
    score = np.array(values)[number] if len(number) else np.zeros(0)
    hits = np.flatnonzero(score > 0)
    sums = np.concatenate(([0.0], np.cumsum(score)))
    cuts = np.searchsorted(hits, words.first)
    for i in range(len(offs) - 1):
        own = hits[cuts[i] : cuts[i + 1]]
        n = int(words.first[i + 1] - words.first[i])
        found = segments((own - words.first[i]).tolist(), sums[own].tolist(), sums[own + 1].tolist()) if len(own) else []
        yield n, found, words, int(words.first[i])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1, sample: int = SAMPLE) -> Model:
    def sign(batches):
        for batch in batches:
            raw, offs = string_parts(batch.column(2))
            keys = []
            for lo, hi in slices(offs):
                words = Words(raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], SPACE_WORDS)
                keys += [int(mix(x).min()) if len(x) else 0 for x in shingle_sets(words, hi - lo, 3)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "y": batch.column(1), "text": batch.column(2), "sig": pa.array(np.array(keys, np.uint64).view(np.int64))})

    def count(batches):
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw, offs = string_parts(pa.array([text or ""]))
                words = Words(raw, offs, ALNUM_WORDS, hashes=False)
                held = {words.mapped[a:b].tobytes() for a, b in zip(words.start.tolist(), words.end.tolist())}
                (toxic if y else clean).update({f for w in held for f in features(w.decode("utf-8", "replace"))})
        names = list(toxic.keys() | clean.keys())
        for lo in range(0, len(names), 50_000):
            some = names[lo : lo + 50_000]
            yield pa.RecordBatch.from_pydict({"f": pa.array(some, pa.string()), "t": pa.array([toxic[x] for x in some], pa.int64()), "c": pa.array([clean[x] for x in some], pa.int64())})

    rows = labelled_sample(docs, labels, label, folds, held_out, sample).select("doc_id", F.when(F.col("y") != 0, 1).otherwise(0).alias("y"), "text").where("text IS NOT NULL")
    rows = rows.mapInArrow(sign, "doc_id bigint, y int, text string, sig bigint").groupBy("sig", "y").agg(F.min_by("text", F.struct("doc_id", "text")).alias("text"))
    space = Workspace(docs.sparkSession, "toxicity")
    rows = space.save(rows.select("y", "text"), "sample")
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Model({}, toxic / max(1, toxic + clean) if toxic + clean else 0.5)
    counted = space.save(rows.mapInArrow(count, "f string, t bigint, c bigint").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), "counts")
    model = Model({r["f"]: r["w"] for r in weighted(counted, toxic, clean).collect()}, toxic / (toxic + clean))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        model, cache, values = shared.value, WordCache(), []
        for batch in batches:
            ys = batch.column(0).to_pylist()
            raw, offs = string_parts(batch.column(1))
            out, k = {"y": [], "n": [], "best": [], "scores": []}, 0
            for lo, hi in slices(offs):
                for n, found, *_ in _scan(model, cache, values, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]):
                    scores = sorted((s for _, _, s in found), reverse=True)
                    for name, v in (("y", ys[k]), ("n", n), ("best", scores[0] if scores else 0.0), ("scores", scores)):
                        out[name].append(v)
                    k += 1
            yield pa.RecordBatch.from_pydict({"y": pa.array(out["y"], pa.int32()), "n": pa.array(out["n"], pa.int64()), "best": pa.array(out["best"], pa.float64()), "scores": pa.array(out["scores"], pa.list_(pa.float64()))})

    # numbers of at most `sample` documents
    measured = rows.mapInArrow(measure, "y int, n bigint, best double, scores array<double>").collect()
    _calibrate(model, [(r["y"], r["n"], r["best"], r["scores"]) for r in measured])
    return model


def extreme_values(n: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """The maximum-likelihood lambda and K of best scores in texts of n words, P(best <= s) = exp(-K * n * exp(-lambda * s)).

    The law is one of the upper tail, so scores up to the median of the positive ones count as censored there.  For a
    given lambda the best K is known in closed form.
    """
    n = np.maximum(n, 1).astype(float)
    if not (best > 0).any():
        return 1.0, 0.5 / max(n.sum(), 1.0)
    cut = float(np.median(best[best > 0])) if (best > np.median(best[best > 0])).any() else 0.0
    x, m, low_words = best[best > cut], n[best > cut], n[best <= cut].sum()

    def constant(rate: float) -> float:
        return len(x) / ((m * np.exp(-rate * x)).sum() + low_words * math.exp(-rate * cut))

    def likelihood(rate: float) -> float:
        k = constant(rate)
        return float((np.log(k * m * rate) - rate * x - k * m * np.exp(-rate * x)).sum() - k * low_words * math.exp(-rate * cut))

    low, high = math.log(1e-2 / x.mean()), math.log(1e2 / x.mean())
    for _ in range(4):  # a grid, ever finer
        grid = np.linspace(low, high, 41)
        at = int(np.argmax([likelihood(math.exp(g)) for g in grid]))
        low, high = grid[max(at - 1, 0)], grid[min(at + 1, 40)]
    rate = math.exp((low + high) / 2)
    return rate, constant(rate)


def _calibrate(model: Model, measured: list) -> None:
    measured = sorted(measured)
    clean = sorted((best, n) for y, n, best, _ in measured if not y)
    clean = np.array(clean[: max(1, len(clean) - int(NOISE * len(clean)))], float)
    model.rate, model.constant = extreme_values(clean[:, 1], clean[:, 0])
    x, y = [], []
    for label, n, best, scores in measured:
        passages = sum(model.log_expectation(s, n) < math.log(E_MAX) for s in scores)
        evidence = max(0.0, -model.log_expectation(best, n)) if best > 0 else 0.0
        x.append((math.log1p(evidence), math.log1p(passages), 1.0))
        y.append(label)
    x, y = np.array(x), np.array(y, float)
    w = np.array([1.0, 0.0, 0.0])
    ridge = np.diag([0.5, 0.5, 0.01])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, grad)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    model.slope = (max(float(w[0]), 0.0), max(float(w[1]), 0.0), float(w[2]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, text) -> doc_id, score and the toxic passages: start and end byte, segment score, expected number of chance segments."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, cache, values = shared.value, WordCache(), []
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        for batch in batches:
            raw, offs = string_parts(batch.column(1))
            scores, passages = [], []
            for lo, hi in slices(offs):
                part = offs[lo : hi + 1] - offs[lo]
                for i, (n, found, words, first) in enumerate(_scan(model, cache, values, raw[offs[lo] : offs[hi]], part)):
                    own = []
                    for a, b, s in found:
                        log_e = model.log_expectation(s, n)
                        if log_e < math.log(E_MAX):
                            own.append({"start": int(words.start[first + a] - part[i]), "end": int(words.end[first + b - 1] - part[i]), "score": s, "expected": math.exp(max(log_e, -700.0))})
                    scores.append(model.probability(max((s for _, _, s in found), default=0.0), n, len(own)))
                    passages.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, kind)], names=["doc_id", "score", "passages"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, passages array<struct<start:int,end:int,score:double,expected:double>>")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
