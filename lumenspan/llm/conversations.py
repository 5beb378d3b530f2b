"""Conversation structure repair: the cheapest edits that make turns alternate.

The repaired roles read ``(s?(ua)+)?``: an optional system turn, then pairs of user and assistant, or nothing. A turn is kept
(0), given the role of user or assistant (1) or deleted (2; blank and repeated ones must be), and an empty turn of either role
may be inserted anywhere (5); a truncated turn that stays costs 5 more. Four states (nothing yet, after system, after user, after
assistant) say which role may come next, so that an edit leads from a state to one state only.

Rows are sorted by conversation and turn over range partitions. Each partition cuts its rows into pieces: a conversation, or
at most ``PIECE`` rows or ``PIECE_BYTES`` of it. Pieces are bucketed by length, and the costs to the end are computed turn by turn,
backwards, for all conversations of a bucket at once (a tensor of turns, conversations and states), kept, and followed forwards,
again for all at once, taking the least letter among the edits that keep the cost. A conversation inside a partition is one piece and done there.

One that is cut, or that touches the edge of a partition, goes on in tables: first occurrences of its turns come from an
aggregate of digests, every piece gives the 4 x 4 least costs from the state before it to the state after it, these are multiplied
(least sums) from the end to give what each piece faces behind it (a piece is 16 numbers, so that 10**10 turns are some 20 MB
there), and the pieces are followed in order, as their digest of one conversation must be, holding one piece at a time.

Defined results: null texts and roles are one space, and so are null ids and turns in the key of ``damaged``; a null id is a
conversation; null turns come first and do not count for gaps; rows of the same turn go by role, then by MD5 of the text; a role of another initial
than s, u and a cannot be kept; repeated rows are duplicates; a conversation whose rows are all dropped has zeros, no edits and the
digest of the empty text; very long texts pass whole; other columns are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import written

PIECE, PIECE_BYTES = 16_384, 8 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = 1 << 40  # more than any cost

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 4 is none. Columns are s, u, a and other roles.
KEPT = np.array([[1, 2, 4, 4], [4, 2, 4, 4], [4, 4, 3, 4], [4, 2, 4, 4]])
#: The state after the one role of user and assistant that may come next, and that role.
NEXT = np.array([2, 2, 3, 2])
ROLE = np.array(["user", "user", "assistant", "user"])
LEGAL = ("su", "ua", "au")


def relaxed(costs: np.ndarray) -> np.ndarray:
    """Costs by state (last axis) if turns may be inserted first."""
    for _ in range(2):  # no more than two in a row can pay
        costs = np.minimum(costs, INSERT + costs[..., NEXT])
    return costs


def at_end() -> np.ndarray:
    return relaxed(np.array([0, FAR, FAR, 0], np.int64))


def backward(role: np.ndarray, must: np.ndarray, cut: np.ndarray, length: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs to the end before each turn: (turns + 1, conversations, ..., states).

    ``role``, ``must`` (delete) and ``cut`` (truncated) are (turns, conversations); ``end`` has the costs after the last turn.
    """
    turns, n = role.shape
    costs = np.empty((turns + 1, *end.shape), np.int64)
    costs[turns] = end
    wide = (slice(None), *[None] * (end.ndim - 1))
    for t in range(turns - 1, -1, -1):
        after = costs[t + 1]
        open_ = np.concatenate([after, np.full((*after.shape[:-1], 1), FAR)], axis=-1)
        kept = KEPT[:, role[t]].T.reshape(n, *[1] * (end.ndim - 2), 4)
        stay = np.where(must[t], FAR, TRUNCATED * cut[t])[wide]
        best = np.minimum(DELETE + after, stay + np.minimum(np.take_along_axis(open_, np.broadcast_to(kept, after.shape), -1), REROLE + after[..., NEXT]))
        costs[t] = np.where((t < length)[wide], relaxed(best), after)
    return np.minimum(costs, FAR)


def forward(role: np.ndarray, must: np.ndarray, cut: np.ndarray, length: np.ndarray, costs: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least letters (steps, conversations) of the cheapest edits, 0 behind the end; the turn that each took; the states in the end."""
    n = len(length)
    turn, state, own = np.zeros(n, np.int64), state.copy(), np.arange(n)
    letters, turns = [], []
    while True:
        here = costs[turn, own, state]
        inside = turn < length
        t = np.minimum(turn, len(role) - 1)
        free = inside & ~must[t, own]
        stay = TRUNCATED * cut[t, own]
        ahead = costs[np.minimum(turn + 1, len(costs) - 1), own]
        kept = KEPT[state, role[t, own]]
        options = [
            ("D", inside & (DELETE + ahead[own, state] == here)),
            ("I", (inside | (last & (here > 0))) & (INSERT + costs[turn, own, NEXT[state]] == here)),
            ("K", free & (kept < 4) & (stay + ahead[own, np.minimum(kept, 3)] == here)),
            ("R", free & (stay + REROLE + ahead[own, NEXT[state]] == here)),
        ]
        letter = np.zeros(n, np.uint8)
        for name, on in reversed(options):
            letter[on] = ord(name)
        if not letter.any():
            return np.array(letters, np.uint8).reshape(-1, n), np.array(turns, np.int64).reshape(-1, n), state
        letters.append(letter)
        turns.append(turn.copy())
        state = np.select([letter == ord("K"), (letter == ord("R")) | (letter == ord("I"))], [kept, NEXT[state]], state)
        turn += (letter > 0) & (letter != ord("I"))


def _padded(values: np.ndarray, first: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """(width, conversations) of runs of ``values``; what is behind a run's end is not used."""
    at = np.minimum(first + np.arange(width)[:, None], len(values) - 1)
    return values[at]


def _buckets(length: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the lengths that share a power of two."""
    kind = np.ceil(np.log2(np.maximum(length, 1))).astype(int)
    for k in np.unique(kind):
        yield np.flatnonzero(kind == k)


def repaired(rows: pd.DataFrame, letters: bytes, turns: np.ndarray, state: int) -> Iterator[str]:
    """``role:text`` of the turns of one piece after its edits, which start from ``state``."""
    for letter, t in zip(letters, turns):
        if letter == ord("D"):
            continue
        if letter == ord("K"):
            yield f"{rows['role'].iat[t]}:{rows['text'].iat[t]}"
            state = KEPT[state, rows["code"].iat[t]]
        else:
            yield f"{ROLE[state]}:{rows['text'].iat[t] if letter == ord('R') else ''}"
            state = NEXT[state]


def gaps(turns: pd.Series) -> int:
    known = turns.dropna()
    return int(known.max()) - int(known.min()) + 1 - known.nunique() if len(known) else 0


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_DONE = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NONE = hashlib.sha256(b"").hexdigest()


def _finished(rows: pd.DataFrame) -> list[tuple]:
    """The results of whole conversations: ``rows`` has conv, turn, role, text, code, blank and truncated, in order."""
    conv = rows["conv"].to_numpy()
    first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    length = np.diff(np.r_[first, len(rows)])
    blank = rows["blank"].to_numpy()
    again = rows.duplicated(["conv", "role", "text"]).to_numpy() & ~blank
    cut = rows["truncated"].to_numpy() & ~blank & ~again
    code = rows["code"].to_numpy()
    pair = rows["initial"].to_numpy()[:-1] + rows["initial"].to_numpy()[1:]
    bad = np.r_[False, ~np.isin(pair.astype(str), LEGAL)]
    bad[first] = False
    counts = [np.add.reduceat(x.astype(np.int64), first) for x in (blank, again, cut, bad)]
    out: list = [None] * len(first)
    for own in _buckets(length):
        width, at, n = int(length[own].max()), first[own], len(own)
        tensors = [_padded(x, at, length[own], width) for x in (code, blank | again, cut)]
        costs = backward(*tensors, length[own], np.tile(at_end(), (n, 1)))
        letters, turns, _ = forward(*tensors, length[own], costs, np.zeros(n, np.int64), np.ones(n, bool))
        for i, c in enumerate(own):
            edits = letters[:, i][letters[:, i] > 0].tobytes()
            part = rows.iloc[first[c] : first[c] + length[c]]
            text = "\n".join(repaired(part, edits, turns[:, i], 0))
            out[c] = (gaps(part["turn"]), *(int(x[c]) for x in counts), int(costs[0, i, 0]), edits.decode(), hashlib.sha256(text.encode()).hexdigest())
    return out


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage that crc32 of ``conv_id:turn`` calls for; ``dropped`` rows stay as marks."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    gone = hit == 0
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    rows = turns.select(
        "conv_id", "turn", F.when(gone, "").when(hit == 4, "user").otherwise(space("role")).alias("role"), F.when(gone, "").otherwise(text).alias("text"), gone.alias("dropped"), F.when(hit == 3, 2).otherwise(1).alias("times")
    )
    return rows.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "time")


def _read(batch: pa.RecordBatch) -> pd.DataFrame:
    return batch.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)


_PIECE_COLUMNS = ["turn", "role", "text", "code", "initial", "blank", "truncated"]


def _alike(ids: pd.Series, before: object) -> np.ndarray:
    """Whether each id is that of the row before it, null being an id; ``before`` is in front of the first."""
    earlier = ids.shift()
    found = ((ids == earlier) | (ids.isna() & earlier.isna())).fillna(False).to_numpy(bool)
    found[0] = before is not None and ((pd.isna(before[0]) and pd.isna(ids.iat[0])) or bool(not pd.isna(before[0]) and not pd.isna(ids.iat[0]) and before[0] == ids.iat[0]))
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition into finished conversations, and into pieces of those that are cut or touch an edge."""
    kind = None
    tail: pd.DataFrame | None = None  # the last conversation so far, as much of it as is in no piece
    before = None  # its id, as a list
    open_ = True  # whether rows of it may be elsewhere: in a partition before this one or in a piece
    piece = 0

    def record(conv: list, done: list[tuple], packed: list[bytes | None], number: int) -> pa.RecordBatch:
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, kind), *(pa.array(c, pa.int64()) for c in columns[:6]), *(pa.array(c, pa.string()) for c in columns[6:]), pa.array([number] * len(conv), pa.int64()), pa.array(packed, pa.binary())],
            ["conv_id", *COUNTS, "audit", "repaired_sha256", "piece", "rows"],
        )

    def plain(ids: pd.Series) -> list:
        return [None if pd.isna(x) else x for x in ids]

    def whole(part: pd.DataFrame) -> pa.RecordBatch:
        live = part[~part["dropped"]]
        ids = part.drop_duplicates("conv")[["conv", "conv_id"]]
        done = dict(zip(live["conv"].unique(), _finished(live))) if len(live) else {}
        none = (*[0] * 6, "", _NONE)
        return record(plain(ids["conv_id"]), [done.get(c, none) for c in ids["conv"]], [None] * len(ids), -1)

    def piece_of(part: pd.DataFrame) -> pa.RecordBatch:
        nonlocal piece
        piece += 1
        sink = pa.BufferOutputStream()
        table = pa.Table.from_pandas(part[~part["dropped"]][_PIECE_COLUMNS], preserve_index=False)
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(table)
        return record(plain(part["conv_id"].iloc[:1]), [(None,) * 8], [sink.getvalue().to_pybytes()], piece)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for start in range(0, len(batch), PIECE):
            part = _read(batch.slice(start, PIECE))
            if tail is None:
                open_ = open_ and (before is None or bool(_alike(part["conv_id"], before)[0]))
            else:
                part = pd.concat([tail, part], ignore_index=True)
            part["conv"] = np.cumsum(~_alike(part["conv_id"], None))
            if part["conv"].iat[-1] > 1:
                first = part["conv"] == 1
                if open_:
                    yield piece_of(part[first])
                inner = part[(part["conv"] < part["conv"].iat[-1]) & ~(first & open_)]
                if len(inner):
                    yield whole(inner)
                part, open_ = part[part["conv"] == part["conv"].iat[-1]], False
            tail, before = part, [part["conv_id"].iat[-1]]
            if len(tail) >= PIECE or tail["size"].sum() >= PIECE_BYTES:
                yield piece_of(tail)
                tail, open_ = None, True
    if tail is not None:
        yield piece_of(tail)


def _rows_of(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_all().to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)


def _tensors(rows: pd.DataFrame, again: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blank = rows["blank"].to_numpy(bool)
    again = again & ~blank
    cut = rows["truncated"].to_numpy(bool) & ~blank & ~again
    return rows["code"].to_numpy(np.int64)[:, None], (blank | again)[:, None], cut[:, None]


def _again(rows: pd.DataFrame, firsts: list[int] | None) -> np.ndarray:
    again = np.ones(len(rows), bool)
    again[np.array(firsts or [], np.int64)] = False
    return again


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of role and text for every turn of a piece."""
    for batch in batches:
        for i in range(len(batch)):
            rows = _rows_of(batch.column("rows")[i].as_py())
            keys = [hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest() for r, t in zip(rows["role"], rows["text"])]
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array([i] * n, pa.int64())) for c in ("conv_id", "part", "piece")), pa.array(np.arange(n)), pa.array(keys, pa.binary())], ["conv_id", "part", "piece", "at", "digest"]
            )


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, edges and the 4 x 4 least costs of every piece."""
    for batch in batches:
        out = []
        for packed, firsts in zip(batch.column("rows").to_pylist(), batch.column("firsts").to_pylist()):
            rows = _rows_of(packed)
            n = len(rows)
            tensors = _tensors(rows, _again(rows, firsts))
            end = np.full((1, 4, 4), FAR)  # by the state after the piece, then by that before a turn
            end[0, np.arange(4), np.arange(4)] = 0
            costs = backward(*tensors, np.array([n]), end)[0, 0].T if n else end[0]
            first, known = rows["initial"], rows["turn"].dropna()
            pair = (first[:-1].to_numpy() + first[1:].to_numpy()).astype(str) if n else np.array([], str)
            blank = rows["blank"].to_numpy(bool)
            counts = [int(blank.sum()), int((tensors[1][:, 0] & ~blank).sum()), int(tensors[2].sum()), int((~np.isin(pair, LEGAL)).sum())]
            ends = [int(known.iloc[0]), int(known.iloc[-1]), known.nunique()] if len(known) else [None, None, 0]
            out.append((counts, ends, [first.iloc[0], first.iloc[-1]] if n else None, costs.reshape(-1).tolist()))
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "part", "piece")), pa.array(columns[0], pa.list_(pa.int64())), pa.array(columns[1], pa.list_(pa.int64())), pa.array(columns[2], pa.list_(pa.string())), pa.array(columns[3], pa.list_(pa.int64()))],
            ["conv_id", "part", "piece", "counts", "ends", "initials", "costs"],
        )


def _chained(group: pa.Table) -> pa.Table:
    """What every piece of one conversation faces behind it, and the counts of the conversation."""
    group = group.sort_by([("part", "ascending"), ("piece", "ascending")])
    n = len(group)
    end, after = at_end(), [None] * n
    for i in range(n - 1, -1, -1):
        after[i] = end.tolist()
        end = np.minimum((np.array(group["costs"][i].as_py()).reshape(4, 4) + end).min(axis=1), FAR)
    ends = [e for e in group["ends"].to_pylist() if e[2]]
    shared = sum(x[1] == y[0] for x, y in zip(ends, ends[1:]))
    holes = ends[-1][1] - ends[0][0] + 1 - (sum(e[2] for e in ends) - shared) if ends else 0
    initials = [x for x in group["initials"].to_pylist() if x]
    counts = np.array(group["counts"].to_pylist()).sum(axis=0)
    counts[3] += sum(x[1] + y[0] not in LEGAL for x, y in zip(initials, initials[1:]))
    totals = [int(holes), *(int(c) for c in counts), int(end[0])]
    return pa.table({"part": group["part"], "piece": group["piece"], "after": pa.array(after, pa.list_(pa.int64())), "totals": pa.array([totals] * n, pa.list_(pa.int64())), "nth": pa.array(range(n), pa.int64()), "pieces": pa.array([n] * n, pa.int64())})


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each conversation, one after the other, into its edits and digest."""
    state, edits, digest, any_ = 0, [], hashlib.sha256(), False
    for batch in batches:
        for r in batch.to_pylist():
            if r["nth"] == 0:
                state, edits, digest, any_ = 0, [], hashlib.sha256(), False
            rows, last = _rows_of(r["rows"]), r["nth"] == r["pieces"] - 1
            n = len(rows)
            tensors = _tensors(rows, _again(rows, r["firsts"])) if n else (np.zeros((1, 1), np.int64), np.zeros((1, 1), bool), np.zeros((1, 1), bool))
            length = np.array([n])
            costs = backward(*tensors, length, np.array([r["after"]], np.int64))
            letters, turns, after = forward(*tensors, length, costs, np.array([state]), np.array([last]))
            for line in repaired(rows, letters[:, 0].tobytes(), turns[:, 0], state):
                digest.update(("\n" * any_ + line).encode())
                any_ = True
            edits.append(letters[:, 0].tobytes().decode())
            state = int(after[0])
            if last:
                columns = [pa.array([r["conv_id"]], batch.schema.field("conv_id").type), *(pa.array([x], pa.int64()) for x in r["totals"]), pa.array(["".join(edits)]), pa.array([digest.hexdigest()])]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", *COUNTS, "audit", "repaired_sha256"])


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation with its faults, the cheapest edits and the digest of what they leave.

    ``rows`` has conv_id, turn (a whole number), role, text and ``dropped``, which marks rows that only name their conversation.
    """
    code = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, "sua")), F.substring("role", 1, 1)), F.lit(0)), F.lit(4)) - 1
    marked = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        "dropped",
        code.cast("long").alias("code"),
        F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
        (F.octet_length("text") + F.octet_length("role")).cast("long").alias("size"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "tie"]
    sorted_ = marked.withColumn("tie", F.md5("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    conv = rows.schema["conv_id"].dataType.simpleString()
    pieces = written(sorted_.mapInArrow(_cut, f"conv_id {conv}, {_DONE}, piece long, rows binary").withColumn("part", F.spark_partition_id().cast("long")), "conversation-pieces")
    done = pieces.filter("piece < 0").select("conv_id", *COUNTS, "audit", "repaired_sha256")
    parts = pieces.filter("piece >= 0").select("conv_id", "part", "piece", "rows")

    seen = parts.mapInArrow(_digests, f"conv_id {conv}, part long, piece long, at long, digest binary")
    firsts = seen.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "piece", "at")).alias("first")).groupBy("first.part", "first.piece").agg(F.collect_list("first.at").alias("firsts"))
    told = written(parts.join(firsts, ["part", "piece"], "left").select("conv_id", "part", "piece", "rows", "firsts"), "conversation-parts")
    summaries = told.mapInArrow(_summaries, f"conv_id {conv}, part long, piece long, counts array<bigint>, ends array<bigint>, initials array<string>, costs array<bigint>")
    chained = summaries.groupBy("conv_id").applyInArrow(_chained, "part long, piece long, after array<bigint>, totals array<bigint>, nth long, pieces long")
    ahead = told.join(chained, ["part", "piece"]).repartition("conv_id").sortWithinPartitions("conv_id", "nth")
    return done.unionByName(ahead.mapInArrow(_followed, f"conv_id {conv}, {_DONE}"))
