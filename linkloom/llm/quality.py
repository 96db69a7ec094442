"""Quality classifier: a sparse rule ensemble over document statistics.

Small gradient-boosted trees on the statistics of a bounded sample of labelled documents give paths; every path is a
conjunctive rule.  A logistic model with a lasso penalty, fitted by proximal gradient steps, keeps few of them.  The
kept rules are compiled into one Spark column expression over the statistics columns.

Defined results: a null or empty text has all statistics 0 and is scored like any other; without labelled rows, or with
one label only, the score is the share of label 1 (0.5 without rows); a null doc_id is never held out nor used for training.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernels import SPACE_WORDS, Words, slices, string_parts
from .sampling import fold, labelled_sample

#: Labelled documents that training uses at most.
SAMPLE = 20_000
THRESHOLD = 0.3
STATISTICS = (
    "n_bytes", "n_words", "word_bytes", "word_spread", "upper", "digits", "marks", "stops", "lines", "non_ascii",
    "distinct_words", "top_word", "twice_in_row", "long_run", "distinct_pairs", "short_words", "marked_words", "upper_words", "alpha_words",
)

_UPPER, _DIGIT, _ALPHA, _MARK, _STOP = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_ALPHA[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP[[ord(c) for c in ".,;:?"]] = True
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_MARK &= ~_STOP


def statistics(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The STATISTICS of each text, as a matrix."""
    n = len(offs) - 1
    size = np.diff(offs)
    words = Words(raw, offs, SPACE_WORDS)
    count = np.diff(words.first)
    one = np.maximum(count, 1)

    def bytes_in(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(mask)))[offs])

    def words_in(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(mask)))[words.first])

    def repeats(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values and the most frequent value's count, by row."""
        order = np.lexsort((h, row))
        r, x = row[order], h[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
        starts = np.flatnonzero(new)
        runs = np.diff(np.append(starts, len(r)))
        top = np.zeros(n, np.int64)
        np.maximum.at(top, r[starts], runs)
        return np.bincount(r[starts], minlength=n), top

    length = words.end - words.start
    spread = np.concatenate(([0.0], np.cumsum(length.astype(float) ** 2)))
    mean = np.diff(np.concatenate(([0], np.cumsum(length)))[words.first]) / one
    square = np.diff(spread[words.first]) / one
    distinct, top = repeats(words.row, words.hash)
    at, pairs = words.windows(2)
    distinct_pairs, _ = repeats(words.row[at], pairs)
    same = np.zeros(len(words.row), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    # the longest run of one word: distances between breaks of the mask
    edges = np.flatnonzero(~same)
    run = np.diff(np.append(edges, len(same)))
    longest = np.zeros(n, np.int64)
    if len(edges):
        np.maximum.at(longest, words.row[edges], run)
    last = raw[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
    first = raw[words.start] if len(words.start) else np.zeros(0, np.uint8)
    b1 = np.maximum(size, 1)
    upper, digits, marks, stops = (bytes_in(t[raw]) for t in (_UPPER, _DIGIT, _MARK, _STOP))
    second = raw[np.minimum(words.start + 1, max(len(raw) - 1, 0))] if len(words.start) else np.zeros(0, np.uint8)
    upper_words = words_in(_UPPER[first] & _UPPER[second] & (length > 1))
    return np.column_stack((
        size, count, mean, np.sqrt(np.maximum(square - mean**2, 0)), upper / b1, digits / b1, marks / b1, stops / b1, bytes_in(raw == 10) / one, bytes_in(raw >= 128) / b1,
        distinct / one, top / one, words_in(same) / one, longest, distinct_pairs / np.maximum(count - 1, 1), words_in(length <= 3) / one, words_in(_MARK[last]) / one, upper_words / one, words_in(_ALPHA[first]) / one,
    )).astype(np.float64)


def with_statistics(rows: DataFrame, *keep: str) -> DataFrame:
    """rows(text, and the columns in keep) -> the columns in keep and a column for each statistic."""

    def run(batches):
        for batch in batches:
            raw, offs = string_parts(batch.column(0))
            parts = [statistics(raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]) for lo, hi in slices(offs)]
            table = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(table[:, i]) for i in range(len(STATISTICS)))], names=[*batch.schema.names[1:], *STATISTICS])

    given = rows.select(F.col("text").cast("string").alias("text"), *keep)
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[1:]), *(f"{s} double" for s in STATISTICS)])
    return given.mapInArrow(run, kinds)


class Rule:
    """A conjunction of (statistic, above, cut)."""

    def __init__(self, terms: frozenset[tuple[int, bool, float]]):
        self.terms = terms

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for i, above, cut in self.terms:
            out &= (x[:, i] > cut) == above
        return out

    def column(self) -> Column:
        terms = sorted(self.terms)
        out = F.lit(True)
        for i, above, cut in terms:
            out = out & ((F.col(STATISTICS[i]) > cut) if above else (F.col(STATISTICS[i]) <= cut))
        return out


class RuleModel:
    def __init__(self, rules: list[Rule], weights: np.ndarray, intercept: float):
        self.rules, self.weights, self.intercept = rules, weights, intercept

    def margin(self, x: np.ndarray) -> np.ndarray:
        return sum((w * r.holds(x) for r, w in zip(self.rules, self.weights)), np.full(len(x), self.intercept))

    def column(self) -> Column:
        """The score as one expression over the statistics columns."""
        total = F.lit(float(self.intercept))
        for rule, w in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), float(w)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _tree(x: np.ndarray, codes: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray, depth: int, path: tuple, out: list) -> None:
    """Grows one tree by histogram splits; puts (path, rows, value) of every node but the root into out."""
    if path:
        out.append((path, rows, -gradient[rows].sum() / (hessian[rows].sum() + 1.0), depth == 0))
    if depth == 0 or len(rows) < 20:
        if path:
            out[-1] = (*out[-1][:3], True)
        return
    g, h = gradient[rows], hessian[rows]
    whole, best = g.sum() ** 2 / (h.sum() + 1), (1e-6, None, None)
    for i, own in enumerate(cuts):
        if not len(own):
            continue
        c = codes[rows, i]
        gs, hs = (np.cumsum(np.bincount(c, v, len(own) + 1))[:-1] for v in (g, h))
        n = np.cumsum(np.bincount(c, minlength=len(own) + 1))[:-1]
        gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
        gain[(n < 8) | (n > len(rows) - 8)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], i, k)
    _, i, k = best
    if i is None:
        if path:
            out[-1] = (*out[-1][:3], True)
        return
    left = codes[rows, i] <= k
    cut = float(cuts[i][k])
    _tree(x, codes, cuts, gradient, hessian, rows[left], depth - 1, (*path, (i, False, cut)), out)
    _tree(x, codes, cuts, gradient, hessian, rows[~left], depth - 1, (*path, (i, True, cut)), out)


def _simplified(path: tuple) -> frozenset:
    """The path with the tightest cut for each statistic and side."""
    tight: dict[tuple[int, bool], float] = {}
    for i, above, cut in path:
        old = tight.get((i, above))
        tight[i, above] = cut if old is None else (max if above else min)(old, cut)
    return frozenset((i, above, cut) for (i, above), cut in tight.items())


def train(x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 3, penalty: float = 0.002, steps: int = 600) -> RuleModel:
    """Rules from boosted trees, weights by a logistic lasso."""
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / np.clip(1 - share, 1e-3, 1)))
    if len(set(y.tolist())) < 2:
        return RuleModel([], np.zeros(0), base)
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0.01, 0.99, 64), method="nearest")) for i in range(x.shape[1])]
    cuts = [c[c < x[:, i].max()] for i, c in enumerate(cuts)]
    codes = np.column_stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)])
    margin, paths = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        nodes: list = []
        _tree(x, codes, cuts, p - y, p * (1 - p), np.arange(len(y)), depth, (), nodes)
        for path, rows, value, leaf in nodes:
            paths.append(_simplified(path))
            if leaf:
                margin[rows] += 0.3 * value
    rules = [Rule(t) for t in dict.fromkeys(paths)]
    z = np.column_stack([r.holds(x) for r in rules]).astype(np.float64)
    support = z.mean(axis=0)
    scale = np.sqrt(np.maximum(support * (1 - support), 1e-4))
    z /= scale
    # accelerated proximal gradient; the largest eigenvalue bounds the step
    v = np.ones(z.shape[1])
    for _ in range(20):
        v = z.T @ (z @ v) / len(y)
        v /= max(np.linalg.norm(v), 1e-12)
    rate = 1 / (0.25 * (float(v @ (z.T @ (z @ v))) / len(y) + 1) + 1e-9)
    w = look = np.zeros(z.shape[1])
    b = b_look = base
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(z @ look + b_look)))
        new = look - rate * (z.T @ (p - y)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        b_new = b_look - rate * float((p - y).mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, b_look = new + (t - 1) / t_new * (new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = new, b_new, t_new
    used = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel([rules[i] for i in used], w[used] / scale[used], float(b))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, sample: int = SAMPLE) -> RuleModel:
    rows = with_statistics(labelled_sample(docs, labels, label, folds, held_out, sample), "doc_id", "y").toPandas()
    rows = rows.sort_values(["doc_id", *STATISTICS])
    return train(rows[list(STATISTICS)].to_numpy(float), rows["y"].to_numpy(float))


def score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """docs (doc_id, text) -> doc_id, the statistics, score."""
    return with_statistics(docs.select("doc_id", "text"), "doc_id").withColumn("score", model.column())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
