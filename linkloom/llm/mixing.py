"""Mixing sources to target weights by iterative proportional fitting.

The tokens of the corpus form a table of cells, source x language x topic.  Raking multiplies the cells until each margin
has its target shares; a cell's factor is the weight of its documents.  A document is then kept with a probability that is
raked as well, under the bound that none exceeds 1, so the expected sample has the target shares.  Its expected tokens make
the wanted share of the corpus, or the largest share found at which the targets can be met, with a warning that states it;
the decision is a hash of doc_id, so it can be repeated.

A weight is a product of one factor for each margin, and a step of raking needs only sums of the cells by the values of
one margin.  So the driver holds the margins' values, at most `MAX_VALUES` of each (more is an error), never documents.
The cells themselves are held there too if they are at most `MAX_CELLS`; if they are more, each step is a Spark job over
the table of cells.  Both ways take the same steps, see `Held` and `Spread`, and give the same weights.

Topics: where docs has no column `topic`, a topic is the sign pattern of three random projections of the text's longer
words, so texts with the same vocabulary share it.

Defined results: tokens are words between white space; a null text has none; null and '' are one value of a margin;
targets for values that have no tokens are dropped and the others rescaled, values without target keep their share of
the rest; targets that contradict each other are met as far as raking gets, with a warning; documents of cells without
tokens get weight 1 and the wanted share as probability; a null doc_id is decided by its text; repeated rows are decided alike.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernels import SPACE_WORDS, Words, slices, string_parts
from .storage import Workspace

MARGINS = ("source", "lang", "topic")
#: Exponents on a value's share of the tokens that give its target share: 1 leaves it, 0 makes all values equal.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.5}
KEEP, MAX_CELLS, MAX_VALUES, ROUNDS, TOLERANCE = 0.7, 200_000, 5_000_000, 200, 1e-9
TOPIC_BITS, LONG_WORD = 3, 6
#: Error of a share up to which the bounded probabilities count as meeting it, rounds and tries for the kept share, and
#: the rounds in which the error has to fall by a tenth.
MET, BOUNDED_ROUNDS, TRIES, PATIENCE = 1e-6, 500, 8, 25


def measured(docs: DataFrame) -> DataFrame:
    """For each row of docs: ``row`` (the row), ``n_tokens``, ``topic``."""

    def run(batches):
        for batch in batches:
            row = batch.column(0)
            raw, offs = string_parts(row.field("text"))
            tokens, topics = [], []
            for lo, hi in slices(offs):
                words = Words(raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], SPACE_WORDS)
                tokens.append(np.diff(words.first))
                long = (words.end - words.start >= LONG_WORD).astype(np.int64)
                topic = np.zeros(hi - lo, np.int64)
                for bit in range(TOPIC_BITS):
                    sign = (((words.hash >> np.uint64(17 * bit + 5)) & np.uint64(1)).astype(np.int64) * 2 - 1) * long
                    topic |= (np.diff(np.concatenate(([0], np.cumsum(sign)))[words.first]) > 0).astype(np.int64) << bit
                topics += [f"t{t}" for t in topic]
            yield pa.RecordBatch.from_arrays([row, pa.array(np.concatenate(tokens) if tokens else [], pa.int64()), pa.array(topics, pa.string())], names=["row", "n_tokens", "topic"])

    state = docs.withColumn("text", F.col("text").cast("string")).select(F.struct("*").alias("row"))
    out = state.mapInArrow(run, f"row {state.schema['row'].dataType.simpleString()}, n_tokens bigint, topic string")
    return out.withColumn("topic", F.col("row.topic").cast("string")) if "topic" in docs.columns else out


def _cell_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"source": F.coalesce(F.col("row.source").cast("string"), F.lit("")), "lang": F.coalesce(F.col("row.lang").cast("string"), F.lit("")), "topic": F.coalesce("topic", F.lit(""))})


def target_shares(tokens: dict[str, float], wanted: dict[str, float] | None, temper: float) -> dict[str, float]:
    """Target shares of a margin's values: the wanted ones, the rest in proportion to tokens ** temper."""
    wanted = {k: v for k, v in (wanted or {}).items() if tokens.get(k, 0) > 0}
    rest = {k: v**temper for k, v in tokens.items() if k not in wanted and v > 0}
    left = max(0.0, 1 - sum(wanted.values())) if rest else 0.0
    shares = wanted | {k: left * v / sum(rest.values()) for k, v in rest.items()}
    total = sum(shares.values())
    return {k: v / total for k, v in shares.items()} if total else {}


class Held:
    """Cells on the driver: their tokens and the code of each one's value in each margin."""

    def __init__(self, mass: np.ndarray, codes: list[np.ndarray]):
        self.mass, self.codes = mass, codes

    def products(self, factors: list[np.ndarray]) -> np.ndarray:
        return np.prod([f[c] for f, c in zip(factors, self.codes)], axis=0)

    def sums(self, margin: int, factors: list[np.ndarray], base: float, bounded: bool) -> tuple[np.ndarray, np.ndarray]:
        """By the margin's values: the tokens of cells whose product with base is 1 or more, and the tokens times product of the others."""
        free, n = base * self.products(factors), len(factors[margin])
        full = (free >= 1) & bounded
        return np.bincount(self.codes[margin], self.mass * full, n), np.bincount(self.codes[margin], self.mass * np.where(full, 0, free), n)

    def largest(self, factors: list[np.ndarray]) -> float:
        return float(self.products(factors)[self.mass > 0].max(initial=0.0))


class Spread:
    """Cells as a table (the margins, tokens), of which each call makes one job; the same sums as `Held`."""

    def __init__(self, cells: DataFrame, values: list[list[str]], space: Workspace):
        numbers = cells.sparkSession.sparkContext.broadcast([{v: i for i, v in enumerate(own)} for own in values])

        def code(batches):
            for batch in batches:
                own = [pa.array([number[v] for v in column.to_pylist()], pa.int32()) for number, column in zip(numbers.value, batch.columns)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*MARGINS, "tokens", "c0", "c1", "c2"])

        kind = "source string, lang string, topic string, tokens bigint, c0 int, c1 int, c2 int"
        self.cells = space.save(cells.select(*MARGINS, "tokens").mapInArrow(code, kind), "coded")

    def _run(self, factors: list[np.ndarray], job, kind: str, columns: tuple[str, ...] = ("c0", "c1", "c2", "tokens")) -> DataFrame:
        """job(Held, batch) -> RecordBatch, for every batch of cells."""
        shared = self.cells.sparkSession.sparkContext.broadcast(factors)

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    held = Held(batch.column("tokens").to_numpy().astype(float), [batch.column(c).to_numpy() for c in ("c0", "c1", "c2")])
                    yield job(held, batch, shared.value)

        return self.cells.select(*columns).mapInArrow(run, kind)

    def sums(self, margin: int, factors: list[np.ndarray], base: float, bounded: bool) -> tuple[np.ndarray, np.ndarray]:
        def job(held, batch, factors):
            capped, room = held.sums(margin, factors, base, bounded)
            used = np.unique(held.codes[margin])
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(capped[used]), pa.array(room[used])], names=["c", "capped", "room"])

        rows = self._run(factors, job, "c int, capped double, room double").groupBy("c").agg(F.sum("capped").alias("capped"), F.sum("room").alias("room")).toArrow()
        out = np.zeros((2, len(factors[margin])))
        out[:, rows.column("c").to_numpy()] = rows.column("capped").to_numpy(), rows.column("room").to_numpy()
        return out[0], out[1]

    def largest(self, factors: list[np.ndarray]) -> float:
        job = lambda held, batch, factors: pa.RecordBatch.from_arrays([pa.array([held.largest(factors)])], names=["x"])
        return float(self._run(factors, job, "x double").agg(F.max("x")).first()[0] or 0.0)

    def table(self, weights: list[np.ndarray], chances: list[np.ndarray], base: float, keep: float) -> DataFrame:
        """The margins, tokens, weight and probability of each cell."""

        def job(held, batch, factors):
            none = held.mass == 0
            weight = np.where(none, 1.0, held.products(factors[0]))
            chance = np.where(none, keep, np.minimum(1, base * held.products(factors[1])))
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*MARGINS, "tokens")), pa.array(weight), pa.array(chance)], names=[*MARGINS, "tokens", "weight", "probability"])

        return self._run([weights, chances], job, "source string, lang string, topic string, tokens bigint, weight double, probability double", (*MARGINS, "tokens", "c0", "c1", "c2"))


def rake(cells: Held | Spread, targets: list[np.ndarray], total: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[list[np.ndarray], float]:
    """The margins' factors that bring the margins of tokens * product to total * `targets` (which sum to 1), and the error of the
    last round.  It ends early where the targets contradict each other: the error stays and the factors would run away."""
    factors, errors = [np.ones(len(t)) for t in targets], []
    for _ in range(rounds):
        worst = 0.0
        for m, target in enumerate(targets):
            have = cells.sums(m, factors, 1.0, False)[1]
            worst = max(worst, float(np.abs(have / total - target).max()))
            factors[m] = factors[m] * np.divide(target * total, have, out=np.ones_like(target), where=have > 0)
        errors.append(worst)
        if worst < tolerance or (worst > MET and len(errors) > PATIENCE and worst > 0.9 * errors[-1 - PATIENCE]):
            break
    return factors, worst


def rake_bounded(cells: Held | Spread, factors: list[np.ndarray], targets: list[np.ndarray], total: float, keep: float, rounds: int = BOUNDED_ROUNDS) -> tuple[list[np.ndarray], float]:
    """Factors with which min(1, keep * product) brings the margins of tokens * that to keep * `targets`, as far as it
    can, and the largest error of a share.

    Each visit of a margin takes one step of Newton's method for each value's factor; the sum is concave and linear in
    pieces.  It ends without success where the error hasn't fallen by a tenth in `PATIENCE` rounds.
    """
    factors, errors = [f.copy() for f in factors], []
    for _ in range(rounds):
        worst = 0.0
        for m, target in enumerate(targets):
            aim = target * keep * total
            capped, room = cells.sums(m, factors, keep, True)
            worst = max(worst, float(np.abs(capped + room - aim).max()) / (keep * total))
            both = capped + room
            step = np.divide(aim, both, out=np.ones_like(aim), where=both > 0)
            step = np.where((aim > capped) & (room > 0), np.divide(aim - capped, room, out=np.ones_like(aim), where=room > 0), np.minimum(step, 1))
            factors[m] = np.clip(factors[m] * step, 1e-100, 1e100)
        errors.append(worst)
        if worst < MET / 10 or (len(errors) > PATIENCE and worst > 0.9 * errors[-1 - PATIENCE]):
            break
    return factors, worst


def probabilities(cells: Held | Spread, weights: list[np.ndarray], missed: float, targets: list[np.ndarray], had: list[np.ndarray], total: float, keep: float, tries: int = TRIES) -> tuple[list[np.ndarray], float]:
    """Factors and base of probabilities min(1, base * product) that meet the targets at the kept share `keep`, or at
    the largest one found that can meet them.

    missed: the error of raking without bound, where the targets contradict each other; it is the measure then.
    """
    met, high = MET + missed, keep
    for target, have in zip(targets, had):  # no value can give more tokens than it has
        high = min(high, float((have[target > 0] / (target[target > 0] * total)).min()))
    low = min(high, 1 / max(cells.largest(weights), 1e-300))  # one common factor: no weight is bounded
    best = weights, low
    for attempt in range(tries):
        now = high if attempt == 0 else (low + high) / 2
        if now <= low:
            break
        factors, error = rake_bounded(cells, weights, targets, total, now)
        if error <= met:
            best, low = (factors, now), now
            if attempt == 0:
                break
        else:
            high = now
    return best


def _say_kept(kept: float, keep: float) -> None:
    if kept < keep - 1e-6:
        logging.getLogger(__name__).warning("mixing keeps %.4f of the tokens, not %.4f: more can't meet the targets with probabilities up to 1", kept, keep)


def cell_weights(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, max_cells: int = MAX_CELLS, tries: int = TRIES) -> DataFrame:
    """source, lang, topic -> tokens, weight, probability, one row for each cell."""
    spark, targets = docs.sparkSession, targets or {}
    space = Workspace(spark, "mixing")
    table = space.save(_cell_columns(measured(docs)).groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    small = table.limit(max_cells + 1).count() <= max_cells
    rows = table.orderBy(*MARGINS).collect() if small else []
    values, had, aims = [], [], []
    for m in MARGINS:
        sums = table.groupBy(m).agg(F.sum("tokens").alias("t"))
        if not small and sums.count() > MAX_VALUES:
            raise ValueError(f"{m} has more than {MAX_VALUES} values: mix a coarser column")
        held = {r[m]: float(r["t"]) for r in sorted(sums.collect())}
        share = target_shares(held, targets.get(m), TEMPER[m])
        values.append(list(held))
        had.append(np.array(list(held.values())))
        aims.append(np.array([share.get(v, 0.0) for v in held]))
    total = float(had[0].sum()) if had and len(had[0]) else 0.0
    numbers = [{v: i for i, v in enumerate(own)} for own in values]
    held = Held(np.array([r["tokens"] for r in rows], float), [np.array([n[r[m]] for r in rows], np.int64) for m, n in zip(MARGINS, numbers)])
    cells = held if small else Spread(table, values, space)
    ones = [np.ones(len(v)) for v in values]
    if total > 0:
        weights, missed = rake(cells, aims, total)
        if missed > MET:
            logging.getLogger(__name__).warning("mixing misses its targets by a share of %.6f: they contradict each other", missed)
        chances, base = probabilities(cells, weights, missed if missed > MET else 0.0, aims, had, total, keep, tries)
        capped, room = cells.sums(0, chances, base, True)
        _say_kept(float((capped + room).sum()) / total, keep)
    else:
        weights, chances, base = ones, ones, keep
    if not small:
        return space.save(cells.table(weights, chances, base, keep), "weights")
    none = held.mass == 0
    weight = np.where(none, 1.0, held.products(weights)) if len(rows) else []
    chance = np.where(none, keep, np.minimum(1, base * held.products(chances))) if len(rows) else []
    out = [(*(r[m] for m in MARGINS), int(r["tokens"]), float(w), float(p)) for r, w, p in zip(rows, weight, chance)]
    return F.broadcast(spark.createDataFrame(out, "source string, lang string, topic string, tokens bigint, weight double, probability double"))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, seed: int = 0, max_cells: int = MAX_CELLS) -> DataFrame:
    """For each row of docs: ``row``, ``n_tokens``, ``topic``, ``weight``, ``probability``, ``kept``."""
    weights = cell_weights(docs, targets, keep, max_cells).drop("tokens")
    out = _cell_columns(measured(docs)).join(weights, list(MARGINS), "left")
    chance = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col("row.doc_id").cast("string"), F.col("row.text"))), F.lit(1 << 40)) / float(1 << 40)
    return out.select("row", "n_tokens", "topic", "weight", "probability", (chance < F.col("probability")).alias("kept"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return mix(docs).select("row.doc_id", "n_tokens", "topic", "weight", "probability", "kept")
