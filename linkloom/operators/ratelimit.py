"""The request limit: per key, a window that the first request opens and the first one after its end opens anew."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


@dataclass
class Limiter:
    """The state of one key."""

    limit: int
    window_us: int
    first: int | None = None
    count: int = 0

    def refuses(self, at: int) -> bool:
        if self.first is None or at - self.first > self.window_us:
            self.first, self.count = at, 0
        self.count += 1
        return self.count > self.limit


def limited_requests(events: DataFrame, key: str, at: str, tie: str, limit: int = 50, window_seconds: int = 900) -> DataFrame:
    """events -> key, n_requests, n_limited.

    A key's requests are a sequence, so they are read in order as a stream of rows, with one small state at a time; a
    key with very many requests takes no more memory than any other.
    """
    kind = to_arrow_type(events.schema[key].dataType)
    rows = events.select(F.col(key).alias("k"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(tie).alias("tie")).repartition("k").sortWithinPartitions("k", "at", "tie").select("k", "at")

    def run(batches):
        name, state, n, refused, seen = None, None, 0, 0, False

        def out():
            return pa.RecordBatch.from_arrays([pa.array([name], kind), pa.array([n], pa.int64()), pa.array([refused], pa.int64())], names=[key, "n_requests", "n_limited"])

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not seen or k != name:
                    if seen:
                        yield out()
                    name, state, n, refused, seen = k, Limiter(limit, window_seconds * 1_000_000), 0, 0, True
                n += 1
                refused += t is not None and state.refuses(t)
        if seen:
            yield out()

    return rows.mapInArrow(run, f"`{key}` {events.schema[key].dataType.simpleString()}, n_requests bigint, n_limited bigint")
