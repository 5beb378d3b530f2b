"""Vector code compression: product quantisation whose searches only look at an annulus of norms.

A vector's components become whole numbers, ``floor(256 x)``, and the vector is cut into ``PARTS`` equal parts. Each part has a codebook of
at most ``ENTRIES`` entries, kept sorted by norm. The distance of a part to an entry is at least the difference of their norms, so
the entries worth looking at lie between the part's norm less and plus the best distance so far: two binary searches
give that annulus, both ends inclusive. A part starts with the entry of the nearest norm and takes in entries to both sides, twice as many
each time, while the annulus, which shrinks with every better entry, still has some. Distances are exact whole numbers, and of
equally near entries the one of lower index counts.

Every task sums its parts by entry, so that a round sends one row of sums for each task and entry; the codebooks, whose size is
fixed by the parameters and the vectors' length, are all that reaches the driver. Errors are summed by label before they are shuffled.

Defined results: vectors that are null or hold null or non-finite components are dropped, and so are those whose length is not
that of the kept vector of least id, or no positive multiple of ``PARTS``; components beyond ``2**19`` in size count as that; null ids
come last, and rows of the same id are ordered by their vectors, all being kept; fewer than ``ENTRIES`` vectors make smaller
codebooks; null labels are one label; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import discard, join_small, written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE, WIDEST = 256, 1 << 27


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance for every point, by annuli of norms."""
    norms = np.sqrt((entries.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(norms, kind="stable")
    norms, sorted_ = norms[order], entries[order]
    own = np.sqrt((points.astype(np.float64) ** 2).sum(axis=1))
    k = len(entries)
    place = np.searchsorted(norms, own)
    below = np.maximum(place - 1, 0)
    at = np.where((place == k) | (own - norms[below] <= norms[np.minimum(place, k - 1)] - own), below, np.minimum(place, k - 1))
    distance = ((points - sorted_[at]) ** 2).sum(axis=1)
    best = order[at]
    left, right = at - 1, at + 1  # what was not looked at lies outside
    reach, open_ = 1, np.arange(len(points))
    while len(open_):
        radius = np.sqrt(distance[open_].astype(np.float64))
        slack = 1e-9 * (own[open_] + radius) + 1e-9  # roots are rounded; more entries do no harm
        low = np.searchsorted(norms, own[open_] - radius - slack, side="left")
        high = np.searchsorted(norms, own[open_] + radius + slack, side="right") - 1
        more = (low <= left[open_]) | (right[open_] <= high)
        open_, low, high = open_[more], low[more], high[more]
        for side in (-1, 1):
            if side < 0:
                first, last = np.maximum(left[open_] - reach + 1, low), left[open_]
                left[open_] = first - 1
            else:
                first, last = right[open_], np.minimum(right[open_] + reach - 1, high)
                right[open_] = last + 1
            n = np.maximum(last - first + 1, 0)
            if side < 0:
                left[open_[n == 0]] = -1
            else:
                right[open_[n == 0]] = k
            who = np.repeat(open_, n)
            entry = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            d = ((points[who] - sorted_[entry]) ** 2).sum(axis=1)
            # the least distance of each point, then the least index
            rank = np.lexsort((order[entry], d, who))
            lead = rank[np.r_[True, who[rank][1:] != who[rank][:-1]]] if len(rank) else rank
            p, d, e = who[lead], d[lead], order[entry[lead]]
            better = (d < distance[p]) | ((d == distance[p]) & (e < best[p]))
            distance[p[better]], best[p[better]] = d[better], e[better]
        reach *= 2
    return best, distance


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _assigned(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code (rows x parts) and summed distance of every vector; ``books`` is parts x entries x part's length."""
    parts = len(books)
    cut = vectors.reshape(len(vectors), parts, -1)
    found = [nearest(cut[:, p], books[p]) for p in range(parts)]
    return np.stack([f[0] for f in found], axis=1), np.sum([f[1] for f in found], axis=0)


def _whole_numbers(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label and the whole numbers of every vector that can be coded, but for its length."""
    vector = F.transform(F.col("vector"), lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(float(WIDEST))), F.lit(float(-WIDEST))).cast("long"))
    sound = F.coalesce(F.forall("vector", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))), F.lit(False))
    named = rows.select(rows[id_col].alias("id"), rows[label_col].alias("label"), rows[vector_col].cast("array<double>").alias("vector"))
    return named.filter(sound).select("id", "label", vector.alias("v"))


def _update(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            vectors = _vectors(batch.column("v"), parts * width)
            at = _assigned(vectors, books)[0] + entries * np.arange(parts)
            count += np.bincount(at.reshape(-1), minlength=parts * entries)
            np.add.at(total, at.reshape(-1), vectors.reshape(-1, width))
        used = np.flatnonzero(count)
        flat = pa.array(total[used].reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(width * np.arange(len(used) + 1), pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(count[used], pa.int64()), lists], ["entry", "n", "total"])

    partial = kept.select("v").mapInArrow(sums, "entry long, n long, total array<bigint>")
    summed = partial.groupBy("entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(width)]).alias("total"))
    out = books.reshape(-1, width).copy()
    for r in summed.collect():  # at most parts x entries rows
        out[r["entry"]] = np.array(r["total"], np.int64) // r["n"]
    return out.reshape(books.shape)


def codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts x entries x part's length) from the vectors of least ids, moved ``rounds`` times; none without vectors."""
    least = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not least:
        return None
    books = np.array([r["v"] for r in least], np.int64).reshape(len(least), parts, -1).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _update(kept, books)
    return books


def fingerprint(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: id, code (two hex digits a part), error, label_error and codebooks_sha256."""
    sound = written(_whole_numbers(rows, id_col, vector_col, label_col), "codes-vectors")
    first = sound.filter(F.size("v") > 0).orderBy(F.col("id").asc_nulls_last(), "v").select(F.size("v").alias("n")).first()
    length = first["n"] if first and first["n"] % parts == 0 else -1
    kept = sound.filter(F.size("v") == length)
    books = codebooks(kept, parts, entries, rounds)
    kinds = f"id {rows.schema[id_col].dataType.simpleString()}, label {rows.schema[label_col].dataType.simpleString()}"

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, error = _assigned(_vectors(batch.column("v"), length), books)
            text = [bytes(r).hex() for r in at.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64())], ["id", "label", "code", "error"])

    out = written(kept.mapInArrow(coded, f"{kinds}, code string, error long"), "codes-coded")
    discard(sound)
    by_label = written(out.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels").withColumnRenamed("label", "of_label")
    told = join_small(out, by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return told.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(fingerprint(books) if books is not None else "").alias("codebooks_sha256"))
