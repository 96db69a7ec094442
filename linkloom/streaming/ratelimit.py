"""The request limit on a stream, with the state of each key in Spark's state store."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

from ..operators.ratelimit import Limiter


def limited_stream(events: DataFrame, key: str, at: str, limit: int = 50, window_seconds: int = 900) -> DataFrame:
    """A stream of events -> the same requests with `limited`: key, at, limited."""

    def run(name, frames, state):
        limiter = Limiter(limit, window_seconds * 1_000_000, *(state.get if state.exists else (None, 0)))
        rows = pd.concat(list(frames)).sort_values(at)
        micros = pd.to_datetime(rows[at]).astype("datetime64[us]").astype("int64")
        limited = [limiter.refuses(int(t)) for t in micros]
        state.update((limiter.first, limiter.count))
        yield pd.DataFrame({key: [name[0]] * len(rows), at: rows[at].to_numpy(), "limited": limited})

    schema = events.schema
    return events.select(key, at).groupBy(key).applyInPandasWithState(run, f"`{key}` {schema[key].dataType.simpleString()}, `{at}` {schema[at].dataType.simpleString()}, limited boolean", "first bigint, count bigint", "append", "NoTimeout")
