"""Chat formatting: minimum-cost repair of the order of roles, then rendering.

A legal conversation is an optional system message, then user and assistant in turn, and ends with the assistant.  Every
turn is kept, relabelled or merged into the message before it, and empty messages may be inserted; dynamic programming
over the automaton's four states finds the cheapest way.  Ties prefer keeping, then merging, then relabelling, and
fewer insertions.

A step of the dynamic programme is a 4 x 4 matrix over (min, +), and such matrices multiply.  The turns are range
partitioned by conversation and order, down to single rows, and what a partition (or `chunk` rows of it) holds of a
conversation is a chunk: chunks are summed up on their own, the small summaries are chained, and each chunk is then
repaired knowing where it begins and ends.  So no conversation, however long, has to fit into one task, whatever its
turn numbers are.

Output: a row for each turn with its repair, `pos` (its place in the conversation, from 0) and its fragment of the rendered
text; the fragments of a conversation in the order of pos are the rendering.

Defined results: a null or unknown role is relabelled at a lower cost; a null text is empty; turns with one number are
ordered by role and the first `HEAD` characters of the text, and as they are read if these agree too (so repeated rows
are turns of their own); null turn numbers and roles come first; rows with a null conv_id form one conversation; template
markers inside a text are broken by a space; other columns don't matter.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .storage import Workspace

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last message.
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ACCEPT = (ASSISTANT,)
COST = {"keep": 0, "merge": 2, "relabel": 3, "relabel_unknown": 1, "insert": 4}
#: Rows of a chunk at most, and characters of a text by which equal turns are ordered.
CHUNK, HEAD = 4096, 64
_FAR = 10**9


def _insertions() -> list[list[tuple[int, tuple[int, ...]]]]:
    """For each pair of states the cheapest insertions that lead from one to the other: cost, roles."""
    best = [[(_FAR, ()) for _ in range(4)] for _ in range(4)]
    for s in range(4):
        best[s][s] = (0, ())
        for n in (1, 2, 3):
            for roles in itertools.product((USER, ASSISTANT), repeat=n):
                chain = (s, *roles)
                if all(b in LEGAL[a] for a, b in itertools.pairwise(chain)):
                    best[s][roles[-1]] = min(best[s][roles[-1]], (n * COST["insert"], roles))
    return best


_INSERT = _insertions()


def _steps(role: int) -> tuple[np.ndarray, dict]:
    """For a turn's role (1 to 3, or 0 if unknown): the costs from state to state, and how: inserted roles, action."""
    cost, how = np.full((4, 4), _FAR, np.int64), {}
    for s in range(4):
        for mid in range(4):
            inserted, roles = _INSERT[s][mid]
            if inserted >= _FAR:
                continue
            ways = []
            for t in LEGAL[mid]:
                ways.append((0 if t == role else COST["relabel" if role else "relabel_unknown"], 0 if t == role else 2, t, "keep" if t == role else "relabel"))
            if mid != START and not roles:
                more = 0 if mid == role else COST["relabel" if role else "relabel_unknown"]
                ways.append((COST["merge"] + more, 1 if mid == role else 3, mid, "merge" if mid == role else "relabel+merge"))
            for c, order, t, action in ways:
                key = (inserted + c, len(roles), order, roles, action)
                if (s, t) not in how or key < how[s, t][0]:
                    how[s, t] = (key, roles, action)
                    cost[s, t] = inserted + c
    return cost, how


_STEP = [_steps(r) for r in range(4)]


def role_code(role: str | None) -> int:
    role = (role or "").strip().lower()
    return ROLES.index(role) + 1 if role in ROLES else 0


def best_path(codes: list[int], enter: int, leave: int) -> list[tuple[tuple[int, ...], str, int]]:
    """The cheapest repair of turns that begin in state `enter` and end in `leave`: for each turn the inserted roles, the action and the state after it."""
    cost, back = [_FAR] * 4, []
    cost[enter] = 0
    for c in codes:
        step, _ = _STEP[c]
        now, way = [_FAR] * 4, [0] * 4
        for t in range(4):
            now[t], way[t] = min((cost[s] + int(step[s, t]), s) for s in range(4))
        cost = now
        back.append(way)
    out, t = [], leave
    for c, way in zip(reversed(codes), reversed(back)):
        s = way[t]
        _, roles, action = _STEP[c][1][s, t]
        out.append((roles, action, t))
        t = s
    return out[::-1]


def chunk_ends(matrices: list[np.ndarray], accept: tuple[int, ...] = ACCEPT) -> tuple[list[int], int, int]:
    """The state after each chunk on the cheapest way, its cost, and the state that the closing insertions reach."""
    cost, back = np.array([0, _FAR, _FAR, _FAR]), []
    for m in matrices:
        total = cost[:, None] + m
        back.append(total.argmin(axis=0))
        cost = np.minimum(total.min(axis=0), _FAR)
    whole, state, last = min((int(cost[s]) + _INSERT[s][a][0], s, a) for s in range(4) for a in accept)
    ends, t = [], state
    for way in reversed(back):
        ends.append(t)
        t = int(way[t])
    return ends[::-1], whole, last


def _escape(text: str) -> str:
    return text.replace("<|", "< |")


def _open(role: int) -> str:
    return f"<|im_start|>{ROLES[role - 1]}\n"


_CLOSE = "<|im_end|>\n"


def _groups(batches, keys: int):
    """Consecutive rows (as lists of columns) that agree on the first `keys` columns, over batches."""
    held, name = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:keys] != name:
                yield name, held
                held = []
            name = row[:keys]
            held.append(row)
    if held:
        yield name, held


def _emitted(out: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in kinds.items()], names=list(kinds))


def repair(turns: DataFrame, accept: tuple[int, ...] = ACCEPT, chunk: int = CHUNK) -> DataFrame:
    """turns (conv_id, turn, role, text) -> conv_id, pos, turn, role, out_role, action, inserted (roles of empty messages put before), fragment, conv_cost."""
    space = Workspace(turns.sparkSession, "chat")
    conv, kind = turns.schema["conv_id"].dataType.simpleString(), to_arrow_type(turns.schema["conv_id"].dataType)
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    known = F.lower(F.trim("role"))
    code = F.when(known == "system", 1).when(known == "user", 2).when(known == "assistant", 3).otherwise(0)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "head", "read")]
    rows = rows.withColumns({"head": F.substring("text", 1, HEAD), "read": F.monotonically_increasing_id(), "code": code})
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "code", "turn", "role", "text", F.spark_partition_id().alias("part"))
    cut = {"conv_id": kind, "part": pa.int32(), "seq": pa.int32(), "at": pa.int32(), "code": pa.int32(), "turn": pa.int64(), "role": pa.string(), "text": pa.string(), "costs": pa.list_(pa.int64())}

    def chunks(batches):
        """The rows with their chunk (part, seq) and place in it; and after each chunk a row (at: its size) with its summary."""
        name, costs, seq, n = None, None, 0, 0

        def summary(out):
            for c, v in (("conv_id", name[0]), ("part", name[1]), ("seq", seq), ("at", n), ("costs", np.minimum(costs, _FAR).ravel())):
                out[c].append(v)
            for c in ("code", "turn", "role", "text"):
                out[c].append(None)

        for batch in batches:
            out = {c: [] for c in cut}
            for conv_id, role, turn, own, text, part in zip(*(c.to_pylist() for c in batch.columns)):
                if costs is not None and ((conv_id, part) != name or n == chunk):
                    summary(out)
                    seq, n, costs = seq + 1, 0, None
                name, step = (conv_id, part), _STEP[role][0]
                costs = step if costs is None else np.minimum((costs[:, :, None] + step[None, :, :]).min(axis=1), _FAR)
                for c, v in (("conv_id", conv_id), ("part", part), ("seq", seq), ("at", n), ("code", role), ("turn", turn), ("role", own), ("text", text), ("costs", None)):
                    out[c].append(v)
                n += 1
            yield _emitted(out, cut)
        if costs is not None:
            out = {c: [] for c in cut}
            summary(out)
            yield _emitted(out, cut)

    ways = {"conv_id": kind, "part": pa.int32(), "seq": pa.int32(), "enter": pa.int32(), "leave": pa.int32(), "cost": pa.int64(), "closing": pa.list_(pa.int32()), "before": pa.int64()}

    def ends(batches):
        for batch in batches:
            out = {c: [] for c in ways}
            for conv_id, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                states, whole, last = chunk_ends([np.array(c["costs"]).reshape(4, 4) for c in held], accept)
                enter, before = START, 0
                for i, (c, leave) in enumerate(zip(held, states)):
                    closing = list(_INSERT[leave][last][1]) if i == len(held) - 1 else None
                    for name, v in (("conv_id", conv_id), ("part", c["part"]), ("seq", c["seq"]), ("enter", enter), ("leave", leave), ("cost", whole), ("closing", closing), ("before", before)):
                        out[name].append(v)
                    enter, before = leave, before + c["n"]
            yield _emitted(out, ways)

    shown = {"conv_id": kind, "pos": pa.int64(), "turn": pa.int64(), "role": pa.string(), "out_role": pa.string(), "action": pa.string(), "inserted": pa.list_(pa.string()), "fragment": pa.string(), "conv_cost": pa.int64()}

    def render(batches):
        out: dict[str, list] = {c: [] for c in shown}
        size = 0
        for _, held in _groups(batches, 2):
            conv_id, enter, leave, cost, closing, before = held[0][2:8]
            path, state_before = best_path([r[9] for r in held], enter, leave), enter
            for i, (r, (inserted, action, state)) in enumerate(zip(held, path)):
                text = _escape(r[12] or "")
                if action.endswith("merge"):
                    piece = "\n\n" + text
                else:  # a message is closed by what follows it, which may be in the next chunk
                    piece = (_CLOSE if state_before != START else "") + "".join(_open(x) + _CLOSE for x in inserted) + _open(state) + text
                if closing is not None and i == len(held) - 1:
                    piece += _CLOSE + "".join(_open(x) + _CLOSE for x in closing)
                state_before = state
                for name, v in zip(shown, (conv_id, before + r[8], r[10], r[11], ROLES[state - 1], action, [ROLES[x - 1] for x in inserted], piece, cost)):
                    out[name].append(v)
                size += len(piece)
            if size > 4 << 20:
                yield _emitted(out, shown)
                out, size = {c: [] for c in shown}, 0
        yield _emitted(out, shown)

    every = space.save(rows.mapInArrow(chunks, f"conv_id {conv}, part int, seq int, at int, code int, turn bigint, role string, text string, costs array<bigint>"), "chunks")
    summed = every.where("costs IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "seq", F.col("at").alias("n"), "costs"))).alias("chunks"))
    way = summed.mapInArrow(ends, f"conv_id {conv}, part int, seq int, enter int, leave int, cost bigint, closing array<int>, before bigint")
    full = every.where("costs IS NULL").drop("costs", "conv_id").join(way, ["part", "seq"])
    full = full.select("part", "seq", "conv_id", "enter", "leave", "cost", "closing", "before", "at", "code", "turn", "role", "text")
    full = full.repartition("part", "seq").sortWithinPartitions("part", "seq", "at")
    return full.mapInArrow(render, f"conv_id {conv}, pos bigint, turn bigint, role string, out_role string, action string, inserted array<string>, fragment string, conv_cost bigint")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(turns).withColumn("inserted", F.concat_ws(",", "inserted"))
