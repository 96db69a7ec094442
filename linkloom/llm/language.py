"""Language identification: averaged hashed subword embeddings and a linear softmax.

Each text is the mean of the embeddings of its hashed character n-grams (2 to 5 bytes inside a word and its borders);
a linear layer and softmax give the languages, of which there may be any number.  Both are trained by stochastic gradient
descent in numpy on a sample of `PER_LANG` labelled documents of each language at most; of a text longer than `WHOLE` bytes
the driver gets only its bag of n-grams, which has a bounded size.  A tenth of the sample is kept back to fit the softmax
temperature, and to place the rejection threshold: the confidence that all but `reject` of those it tells rightly reach.
Texts are read in windows, so neither a long text nor many languages need more memory.

Defined results: a text that is null or has no letter is `und` with score 0 and is rejected; without any labelled row
every text is `und`; a null doc_id is never held out nor used for training; ties go to the language first in
alphabetical order; other columns are carried through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .kernels import slices, string_parts
from .sampling import fold
from .storage import small_batches

BUCKETS = 1 << 15
DIM = 16
#: Labelled documents of each language that training uses at most, and bytes of a text that reaches the driver.
PER_LANG, WHOLE = 1200, 1 << 15
#: Bytes of text in a window, and logits that are gathered at a time.
WINDOW, GATHER = 1 << 19, 1 << 22
#: Up to so many languages their table (a name and a share each) is broadcast.
BROADCAST_LANGS = 200_000
GRAMS = (2, 3, 4, 5)
REJECT = 0.001

_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


def grams(raw: np.ndarray) -> list[np.ndarray]:
    """For each n-gram size the bucket of the n-gram at every byte; -1 where there is none.

    Bytes that are no letters are word borders; an n-gram may begin or end with one but not hold one inside.
    """
    m = np.concatenate((_LETTER[raw], np.zeros(max(GRAMS), np.uint8)))
    border = m == 0
    wide = m.astype(np.uint32) + np.uint32(1)
    n, out = len(raw), []
    total = wide[:n] * _MULT[0]
    inside = np.zeros(n, bool)
    for size in range(2, max(GRAMS) + 1):
        if size > 2:
            inside = inside | border[size - 2 : n + size - 2]
        total = total + wide[size - 1 : n + size - 1] * _MULT[size - 1]
        if size in GRAMS:
            mixed = (total ^ (total >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            at = ((mixed ^ (mixed >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int32)
            at[inside | (border[:n] & border[size - 1 : n + size - 1])] = -1
            out.append(at)
    return out


def counts(raw: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in a text, read in windows."""
    total, reach = np.zeros(BUCKETS, np.int64), max(GRAMS)
    for lo in range(0, len(raw), WINDOW):
        n = min(WINDOW, len(raw) - lo)
        for at in grams(raw[lo : lo + n + reach]):
            total += np.bincount(at[:n][at[:n] >= 0], minlength=BUCKETS)
    return total


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and their shares."""
    number = counts(np.frombuffer(text, np.uint8))
    used = np.flatnonzero(number)
    return used, (number[used] / max(1, number.sum())).astype(np.float32)


class Model:
    """Languages, the product of embeddings and linear layer (one row of logits per bucket), bias, temperature and threshold."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, threshold: float):
        self.langs, self.table, self.bias, self.temperature, self.threshold = langs, table, bias, temperature, threshold

    def logits(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Logits of each text; the last row of the table, all zero, stands for no n-gram."""
        n, reach = len(offs) - 1, max(GRAMS)
        total, found = np.zeros((n, len(self.langs))), np.zeros(n)
        # a border after each text, so that no n-gram reaches into the next one
        raw, offs = np.insert(raw, offs[1:], 10), offs + np.arange(n + 1)
        step = max(1024, min(WINDOW, GATHER // len(self.langs)))
        for lo in range(0, len(raw), step):
            hi = min(lo + step, len(raw))
            first, last = int(np.searchsorted(offs, lo, "right")) - 1, int(np.searchsorted(offs, hi, "left"))
            starts = np.maximum(offs[first:last], lo) - lo  # of the texts in this window
            for at in grams(raw[lo : hi + reach]):
                at = at[: hi - lo]
                at[offs[first + 1 : last + 1][offs[first + 1 : last + 1] <= hi] - 1 - lo] = -1
                total[first:last] += np.add.reduceat(self.table[at], starts, axis=0)
                found[first:last] += np.add.reduceat((at >= 0).astype(np.int64), starts)
        return total / np.maximum(found, 1)[:, None] + self.bias

    def of_bag(self, used: np.ndarray, share: np.ndarray) -> np.ndarray:
        return share @ self.table[used] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(rows: list[tuple], reject: float = REJECT, epochs: int = 6, rate: float = 0.5, seed: int = 7) -> Model | None:
    """rows: (doc_id, text, lang), or (doc_id, a piece of a long text, lang, the whole text's bag)."""
    rows = sorted((r for r in rows if r[1] and (len(r) > 3 or any(c.isalpha() for c in r[1]))), key=lambda r: (r[0], r[1], r[2]))
    langs = sorted({r[2] for r in rows})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    number = {x: i for i, x in enumerate(langs)}
    held = len(rows) >= 50
    kept_back, pieces = [], []
    for i, (_, text, lang, *whole) in enumerate(rows):
        data = text.encode("utf-8", "replace")
        own = whole[0] if whole else bag(data)
        if i % 10 == 9 or not held:
            kept_back.append((own, number[lang]))
        if i % 10 == 9 and held:
            continue
        pieces.append((*own, number[lang]))
        if whole or len(data) > 200:  # a short piece too, since short texts come as well
            at = int(rng.integers(0, max(1, len(data) - 100)))
            pieces.append((*bag(data[at : at + 100]), number[lang]))
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    linear, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    linear += rng.normal(0, 0.1, linear.shape).astype(np.float32)
    steps, step = epochs * len(pieces), 0
    for _ in range(epochs):
        for k in rng.permutation(len(pieces)):
            used, share, y = pieces[k]
            if not len(used):
                continue
            now = rate * (1 - step / steps)
            step += 1
            mean = share @ embed[used]
            z = mean @ linear + bias
            z = np.exp(z - z.max())
            z /= z.sum()
            z[y] -= 1
            back = linear @ z
            linear -= now * np.outer(mean, z)
            bias -= now * z * 0.1
            embed[used] -= (now * 4 * len(used) ** 0.5) * share[:, None] * back
    table = np.concatenate((embed @ linear, np.zeros((1, len(langs)), np.float32)))
    model = Model(langs, table, bias, 1.0, 0.0)
    z, y = np.array([model.of_bag(*own) for own, _ in kept_back]), np.array([k for _, k in kept_back])
    best = min(np.geomspace(0.05, 20, 60), key=lambda t: -_log_likelihood(z / t, y))
    model.temperature = float(best)
    right = z.argmax(axis=1) == y
    sure = model.probabilities(z).max(axis=1)[right] if right.any() else np.zeros(1)
    model.threshold = float(min(0.5, np.quantile(sure, reject, method="lower")))
    return model


def _log_likelihood(z: np.ndarray, y: np.ndarray) -> float:
    top = z.max(axis=1, keepdims=True)
    return float((z[np.arange(len(y)), y] - top[:, 0] - np.log(np.exp(z - top).sum(axis=1))).mean())


def fit(docs: DataFrame, folds: int = 3, held_out: int = 1, per_lang: int = PER_LANG) -> Model | None:
    """Trains on documents with a language that aren't held out, on `per_lang` of each language at most."""
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    known = known.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(fold(F.col("doc_id"), folds) != held_out)
    each = known.groupBy("lang").count()
    n = each.count()
    if not n:
        return None
    # a fifth more than wanted by a hash, in the scan itself; the surplus goes once the texts are short
    share = each.select("lang", F.least(F.lit(1.0), F.lit(per_lang * 1.2) / F.col("count")).alias("share"))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    own = own.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(fold(F.col("doc_id"), folds) != held_out)
    drawn = F.xxhash64(F.lit("language"), "doc_id")
    picked = own.join(F.broadcast(share) if n <= BROADCAST_LANGS else share, "lang").where(F.pmod(drawn, F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("doc_id", "text", "lang")

    def shorten(batches):
        """Long texts as their bags, with a piece from the middle."""
        for batch in batches:
            texts, used, shares = [], [], []
            for t in batch.column(1).to_pylist():
                data = t.encode("utf-8", "replace")
                long = len(data) > WHOLE
                own = bag(data) if long else (None, None)
                texts.append(data[len(data) // 2 : len(data) // 2 + 100].decode("utf-8", "replace") if long else t)
                used.append(own[0].astype(np.uint16).tobytes() if long else None)
                shares.append(own[1].tobytes() if long else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), batch.column(2), pa.array(used, pa.binary()), pa.array(shares, pa.binary())], names=["doc_id", "text", "lang", "used", "share"])

    rows = picked.mapInArrow(shorten, "doc_id bigint, text string, lang string, used binary, share binary")
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(drawn, "doc_id", "text"))).where(F.col("r") <= per_lang)
    whole = lambda r: [] if r["used"] is None else [(np.frombuffer(r["used"], np.uint16).astype(np.int64), np.frombuffer(r["share"], np.float32))]
    return train([(r["doc_id"], r["text"], r["lang"], *whole(r)) for r in rows.toLocalIterator()])


def detect(docs: DataFrame, model: Model | None) -> DataFrame:
    """For each row of docs: ``row`` (the row), ``lang_pred``, ``score`` and ``rejected``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            row = batch.column(0)
            texts = row.field("text")
            langs, scores, rejected = [], [], []
            raw_all, offs_all = string_parts(texts)
            for lo, hi in slices(offs_all):
                raw, offs = raw_all[offs_all[lo] : offs_all[hi]], offs_all[lo : hi + 1] - offs_all[lo]
                ascii_letter = np.concatenate(([0], np.cumsum((_LETTER[raw] > 0) & (raw < 128))))[offs]
                p = model.probabilities(model.logits(raw, offs)) if model else None
                for i in range(hi - lo):
                    letters = ascii_letter[i + 1] > ascii_letter[i] or any(c.isalpha() for c in raw[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace"))
                    if p is None or not letters:
                        langs.append("und")
                        scores.append(0.0)
                        rejected.append(True)
                    else:
                        k = int(p[i].argmax())
                        langs.append(model.langs[k])
                        scores.append(float(p[i, k]))
                        rejected.append(scores[-1] < model.threshold)
            yield pa.RecordBatch.from_arrays([row, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=["row", "lang_pred", "score", "rejected"])

    state = docs.withColumn("text", F.col("text").cast("string")).select(F.struct("*").alias("row"))
    return state.mapInArrow(run, f"row {state.schema['row'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = detect(docs.select("doc_id", "text"), fit(docs))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.coalesce(fold(F.col("row.doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs without the documents that the model rejects."""
    return detect(docs, model or fit(docs)).where("NOT rejected").select("row.*")
