"""Token ids on disk: one concatenated id array with Elias-Fano coded document boundaries.

The store is a folder of Parquet rows, one per block, each with a self-contained binary payload; Parquet is only the
container, so that Spark's commit protocol writes and any store that Spark reads can hold it.  A block holds consecutive
documents in ascending doc_id order:

    magic b"TIDS", version u8, id width u8 (2 or 4), n_null u64 (documents at the front without doc_id), smallest doc_id i64
    Elias-Fano list of doc_id - smallest (documents with an id)
    Elias-Fano list of n_docs + 1 boundaries, from 0 to the number of ids
    ids, little-endian, of the given width

An Elias-Fano list is: n u64, universe u64, low bits per value u8, low bits packed, high bits as a unary bit vector, and
the position of every 128th set bit as u32, from which select(i) looks at a few bytes.

Defined results: null texts are empty, so their document is the end id alone; documents with a null doc_id come first;
rows with one doc_id are ordered by text; an empty table gives an empty store; other columns are not stored.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernels import WordCache, Words, byte_class, slices, string_parts
from .storage import Workspace

END_ID = 2
BLOCK_IDS = 1 << 20
#: before: the ids of the same part in earlier blocks.
BLOCK_SCHEMA = "part int, seq int, n_docs bigint, before bigint, n_ids bigint, payload binary"
_SAMPLE = 128
_SPACES = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: ASCII marks that no contraction can start with.
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


class EliasFano:
    """A non-decreasing list of unsigned integers in n * (2 + log2(universe / n)) bits, nearly."""

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low_bits, self.low, self.high, self.samples = n, universe, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n, universe = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        places = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> places) & np.uint64(1)).astype(np.uint8), axis=None, bitorder="little").tobytes()
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 1 if n else 0) + 7 & ~7, np.uint8)
        bits[ones] = 1
        return cls(n, universe, low_bits, low, np.packbits(bits, bitorder="little"), ones[::_SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        high = self.high.tobytes()
        return struct.pack("<QQBQQ", self.n, self.universe, self.low_bits, len(self.low), len(high)) + self.low + high + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        n, universe, low_bits, n_low, n_high = struct.unpack_from("<QQBQQ", data)
        at = struct.calcsize("<QQBQQ")
        low = bytes(data[at : at + n_low])
        high = np.frombuffer(data[at + n_low : at + n_low + n_high], np.uint8)
        at += n_low + n_high
        samples = np.frombuffer(data[at : at + 4 * -(-n // _SAMPLE)], "<u4")
        return cls(n, universe, low_bits, low, high, samples), at + 4 * len(samples)

    def _low(self, lo: int, hi: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(hi - lo, np.uint64)
        a, b = lo * self.low_bits, hi * self.low_bits
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8)[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a]
        return (bits.reshape(-1, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """Value i, read from the nearest sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // _SAMPLE]), i % _SAMPLE
        byte, skip = at // 8, at % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64], bitorder="little")[skip:])
            if left < len(ones):
                return (byte * 8 + skip + int(ones[left]) - i << self.low_bits) | int(self._low(i, i + 1)[0])
            left -= len(ones)
            byte, skip = byte + 64, 0

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.n)


def pack_block(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    known = np.array([x for x in doc_ids if x is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    bounds = np.concatenate(([0], np.cumsum(counts)))
    head = struct.pack("<4sBBQq", b"TIDS", 1, width, len(doc_ids) - len(known), least)
    shifted = known.astype(np.uint64) - np.array(least, np.int64).astype(np.uint64)
    return head + EliasFano.of(shifted).to_bytes() + EliasFano.of(bounds).to_bytes() + ids.astype(f"<u{width}").tobytes()


class Block:
    """A block as read: doc_ids, boundaries with select, ids."""

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        magic, version, self.width, self.n_null, self.least = struct.unpack_from("<4sBBQq", data)
        if magic != b"TIDS" or version != 1:
            raise ValueError("not a block of token ids")
        at = struct.calcsize("<4sBBQq")
        self.docs, used = EliasFano.from_bytes(data[at:])
        at += used
        self.bounds, used = EliasFano.from_bytes(data[at:])
        self.ids = np.frombuffer(data[at + used :], f"<u{self.width}")
        self.n_docs = self.bounds.n - 1

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + (self.docs.values() + np.array(self.least, np.int64).astype(np.uint64)).astype(np.int64).tolist()

    def document(self, i: int) -> np.ndarray:
        """The ids of document i of the block, found by two selects."""
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]


class Encoder:
    """The tokenizers library behind a cache of pieces.

    The tokenizer drops white space and its pattern never joins a letter or digit with a mark other than an apostrophe,
    so a text may be cut there, and each distinct piece is encoded once.  Texts with "<|", the start of the special
    tokens that the library looks for in raw text, are encoded whole.
    """

    def __init__(self, spec: str, pieces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.pieces, self.cache = Tokenizer.from_str(spec), pieces, WordCache(400_000)
        self._forget()

    def _forget(self) -> None:
        self.at, self.size, self.pool, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0
        self.filled = 0

    def _fill(self, new: list[bytes]) -> None:
        got = [x.ids for x in self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in new], add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((i for x in got for i in x), np.uint32, int(sizes.sum()))
        while self.filled + len(got) > len(self.at):
            self.at, self.size = np.resize(self.at, 2 * len(self.at)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.at[self.filled : self.filled + len(got)] = self.used + np.cumsum(sizes) - sizes
        self.size[self.filled : self.filled + len(got)] = sizes
        self.pool[self.used : self.used + len(flat)] = flat
        self.filled += len(got)
        self.used += len(flat)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, raw: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        """The ids of each text."""
        n = len(offs) - 1
        if not self.pieces:
            return [np.array(x, np.uint32) for x in self.whole([raw[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace") for i in range(n)])]
        cut = np.zeros(len(raw), bool)
        cut[1:] = _ALNUM[raw[:-1]] & _MARK[raw[1:]]
        words = Words(raw, offs, _SPACES, cut)
        number = self.cache.lookup(words, raw, self._fill, self._forget)
        sizes = self.size[number]
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.at[number] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate(([0], ends))[words.first]
        out = [ids[bounds[i] : bounds[i + 1]] for i in range(n)]
        special = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C)) if len(raw) > 1 else ()
        for i in {int(np.searchsorted(offs, p, "right")) - 1 for p in special}:
            out[i] = np.array(self.whole([raw[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace")])[0], np.uint32)
        return out


_encoders: dict[tuple[int, bool], Encoder] = {}


def _encoder(spec: str, pieces: bool) -> Encoder:
    """This worker's encoder; tasks find it by this function's module, so its cache outlives them."""
    key = (hash(spec), pieces)
    if key not in _encoders:
        _encoders[key] = Encoder(spec, pieces)
    return _encoders[key]


def _block_writer(shared, end_id: int, width: int, pieces: bool, block_ids: int):
    def write(batches):
        from pyspark import TaskContext

        encoder = _encoder(shared.value, pieces)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size, end = 0, np.array([end_id], np.uint32)

        def block():
            counts = np.array([len(held[i]) + 1 for i in range(len(held))], np.int64)
            flat = np.concatenate([x for h in held for x in (h, end)])
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": pa.array([len(docs)], pa.int64()),
                "before": pa.array([before], pa.int64()), "n_ids": pa.array([len(flat)], pa.int64()), "payload": pa.array([pack_block(docs, counts, flat, width)], pa.binary()),
            })

        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, offs = string_parts(batch.column(1))
            for lo, hi in slices(offs):
                for i, own in enumerate(encoder.encode(raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])):
                    docs.append(ids[lo + i])
                    held.append(own)
                    size += len(own) + 1
                    if size >= block_ids:
                        yield block()
                        docs, held, size, seq, before = [], [], 0, seq + 1, before + size
        if docs:
            yield block()

    return write


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, pieces: bool = True, block_ids: int = BLOCK_IDS) -> None:
    """Encodes docs (doc_id, text) in ascending doc_id order into a store at `path`, by the tokenizer file `tokenizer`.

    pieces: the tokenizer drops white space (see Encoder); with False every text is encoded whole.
    """
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    width = 2 if max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    rows.mapInArrow(_block_writer(shared, end_id, width, pieces, block_ids), BLOCK_SCHEMA).write.mode("overwrite").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids before it in the whole store), n_tokens, ids_crc32, in store order part, seq, pos."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # one row for each partition that wrote, so at most a few thousand
    totals = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    starts, total = [], 0
    for part, n in totals:
        starts.append((part, total))
        total += n
    at = F.broadcast(spark.createDataFrame(starts, "part int, earlier bigint"))

    def decode(batches):
        for batch in batches:
            part, seq, base = (batch.column(i).to_pylist() for i in range(3))
            for k in range(batch.num_rows):
                block = Block(batch.column(3)[k].as_py())
                bounds = block.bounds.values().astype(np.int64)
                wide = block.ids.astype("<u4")
                n = block.n_docs
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(block.doc_ids(), pa.int64()), "start": pa.array(bounds[:-1] + base[k], pa.int64()), "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(wide[bounds[i] : bounds[i + 1]].tobytes()) for i in range(n)], pa.int64()),
                    "part": pa.array([part[k]] * n, pa.int32()), "seq": pa.array([seq[k]] * n, pa.int32()), "pos": pa.array(range(n), pa.int32()),
                })

    rows = blocks.join(at, "part").select("part", "seq", (F.col("earlier") + F.col("before")).alias("base"), "payload")
    return rows.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, part int, seq int, pos int")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def store_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes docs to a store in the shared folder and returns what the files say of each document."""
    spark = docs.sparkSession
    path = f"{Workspace(spark, 'tokens').path}/store"
    write_store(docs, path, tokenizer or default_tokenizer())
    return read_store(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
