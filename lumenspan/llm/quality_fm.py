"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: hashed lower-case words, hashed shapes of words (case and trailing marks), a few ratios of
its structure, and its stored length. The model scores ``w0 + w.x + sum over pairs <v_i, v_j> x_i x_j``; the pair term
takes linear time as half of ``(sum v x)^2 - sum (v x)^2``.

It is fitted on a sample of at most ``TRAIN_DOCS`` labelled rows (in expectation, by a hash of the id) that lie in
``SHARDS`` parts: every round each part takes gradient steps from the common parameters and the driver averages the
results, whose size depends on ``WIDTH`` and ``RANK`` alone. Every document, whole, is scored.

Defined results: null or empty text has the bias and its structure features only; labels other than 0 and 1 or null
are left out, as are documents labelled both ways or without an id; without training rows every score is 0.5; repeated rows and ties
score alike, and each repeated labelled row counts in training; very long texts are read whole; the columns to keep are
packed into ``row`` and may have any names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import discard, join_small, row_schema, whole, written
from lumenspan.llm.mixing import coin

TRAIN_DOCS = 12_000
SHARDS = 6
ROUNDS = 6
EPOCHS = 2
RANK = 4
WIDTH = 1 << 14  # hashed words, then as many places for shapes and structure as SHAPES says
SHAPES = 1 << 10
RATE = 0.05
DECAY = 1e-4

_MARKS = re.compile(r"[^\W\d_]+", re.UNICODE)
#: Structure features that follow the hashed places.
STRUCTURE = 8


def _word_places(word: str) -> tuple[int, int]:
    core = word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").lower()
    case = "A" if len(word) > 1 and word.isupper() else "t" if word[:1].isupper() else "a" if word.islower() else "."
    tail = _MARKS.sub("", word)[-3:]
    return zlib.crc32(core.encode()) % WIDTH, WIDTH + zlib.crc32(f"{case}{tail}".encode()) % SHAPES


def features(texts: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, value) triples of a batch, in order of documents."""
    n = len(texts)
    words = pc.ascii_split_whitespace(texts)
    flat, owner = pc.list_flatten(words), pc.list_parent_indices(words).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(flat, "")
    owner, coded = owner[real.to_numpy(zero_copy_only=False)], flat.filter(real).dictionary_encode()
    names = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    places = np.array([_word_places(w) for w in names], np.int64).reshape(-1, 2)
    lengths = np.array([len(w) for w in names], np.float64)
    size = np.bincount(owner, minlength=n).astype(np.float64)
    some = np.maximum(size, 1)
    width = WIDTH + SHAPES + STRUCTURE

    key, count = np.unique(owner * width + places[codes, 0], return_counts=True)
    doc, value = key // width, 1 + np.log(count)
    value /= np.sqrt(np.maximum(np.bincount(doc, value**2, n), 1))[doc]
    shape, often = np.unique(owner * width + places[codes, 1], return_counts=True)
    share = often / some[shape // width]

    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.float64)
    lines = pc.count_substring(texts, "\n").to_numpy(zero_copy_only=False) + 1.0
    distinct = np.bincount(np.unique(owner * max(len(names), 1) + codes) // max(len(names), 1), minlength=n)
    structure = np.stack(
        [
            np.log1p(size) / 10,
            np.bincount(owner, lengths[codes], n) / some / 10,
            distinct / some,
            np.log1p(size / lines) / 5,
            np.log1p(lines) / 5,
            np.log1p(chars) / 12,
            np.log1p(np.maximum(n_chars, 0)) / 12,
            (size < 50).astype(np.float64),
        ],
        axis=1,
    )
    key = np.concatenate([key, shape, (np.arange(n)[:, None] * width + WIDTH + SHAPES + np.arange(STRUCTURE)).ravel()])
    value = np.concatenate([value, share, structure.ravel()])
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    return key // width, key % width, value


class Machine:
    """Parameters ``w0``, ``w`` (one a place) and ``v`` (RANK a place)."""

    def __init__(self, w0: float = 0.0, w: np.ndarray | None = None, v: np.ndarray | None = None):
        width = WIDTH + SHAPES + STRUCTURE
        self.w0 = w0
        self.w = np.zeros(width, np.float32) if w is None else w
        self.v = np.random.default_rng(9).normal(0, 0.05, (width, RANK)).astype(np.float32) if v is None else v

    def raw(self, doc: np.ndarray, place: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Raw scores, ``v x`` of every triple and its sum by document."""
        vx = self.v[place] * value[:, None]
        sums = np.stack([np.bincount(doc, vx[:, f], n) for f in range(RANK)], axis=1)
        pairs = 0.5 * ((sums**2).sum(axis=1) - np.bincount(doc, (vx**2).sum(axis=1), n))
        return self.w0 + np.bincount(doc, self.w[place] * value, n) + pairs, vx, sums

    def scores(self, texts: pa.Array, n_chars: np.ndarray) -> np.ndarray:
        doc, place, value = features(texts, n_chars)
        return 1 / (1 + np.exp(-np.clip(self.raw(doc, place, value, len(texts))[0], -30, 30)))

    def fit(self, doc: np.ndarray, place: np.ndarray, value: np.ndarray, label: np.ndarray, epochs: int, seed: int) -> None:
        """Adaptive gradient steps on the logistic loss over small batches of documents."""
        rng = np.random.default_rng(seed)
        n, bounds = len(label), np.searchsorted(doc, np.arange(len(label) + 1))
        seen_w, seen_v, seen_0 = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(n), max(1, n // 64)):
                at = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in batch])
                own = np.repeat(np.arange(len(batch)), bounds[batch + 1] - bounds[batch])
                p, x = place[at], value[at]
                raw, vx, sums = self.raw(own, p, x, len(batch))
                loss = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[batch]) / len(batch)
                used, inverse = np.unique(p, return_inverse=True)
                gw = np.bincount(inverse, loss[own] * x, len(used)) + DECAY * self.w[used]
                step = (loss[own] * x)[:, None] * (sums[own] - vx)
                gv = np.stack([np.bincount(inverse, step[:, f], len(used)) for f in range(RANK)], axis=1) + DECAY * self.v[used]
                g0 = loss.sum()
                seen_w[used] += gw**2
                seen_v[used] += gv**2
                seen_0 += g0**2
                self.w[used] -= RATE * gw / np.sqrt(seen_w[used])
                self.v[used] -= RATE * gv / np.sqrt(seen_v[used])
                self.w0 -= RATE * g0 / math.sqrt(seen_0)


def _inputs(docs: DataFrame, text_col: str, chars_col: str) -> list[Column]:
    chars = docs[chars_col] if chars_col in docs.columns else F.lit(None)
    return [whole(docs[text_col]).alias("_text"), F.coalesce(chars.cast("double"), F.lit(0.0)).alias("_chars")]


def _shard_fit(start: Machine, turn: int) -> Callable[[pa.Table], pa.Table]:
    """Takes a shard's rows, and gives the parameters that its own steps reach from ``start``."""

    def fitted(part: pa.Table) -> pa.Table:
        part = part.sort_by("id")
        own = Machine(start.w0, start.w.copy(), start.v.copy())
        doc = np.repeat(np.arange(len(part)), pc.list_value_length(part["place"]).to_numpy())
        place, value = pc.list_flatten(part["place"]).to_numpy(), pc.list_flatten(part["value"]).to_numpy()
        own.fit(doc, place, value.astype(np.float64), part["label"].to_numpy().astype(np.float64), EPOCHS, turn)
        return pa.table({"shard": part["shard"].slice(0, 1), "n": [len(part)], "w0": [float(own.w0)], "w": [own.w.tobytes()], "v": [own.v.tobytes()]})

    return fitted


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", chars_col: str = "n_chars") -> Machine:
    """Fit on a bounded sample of the labelled rows of ``docs``."""
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.min(label_col).alias("_label"), F.max(label_col).alias("_other")).filter("_label = _other").drop("_other")
    total = known.count()
    if not total:
        return Machine()
    chosen = known.filter(coin(F.col("_id"), "fm") * total < TRAIN_DOCS)
    chosen = written(chosen.withColumnRenamed("_id", "_of"), "fm-chosen")
    rows = join_small(docs.select(docs[id_col].alias("_id"), *_inputs(docs, text_col, chars_col)), chosen, F.col("_id") == F.col("_of"), "inner").drop("_of")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, place, value = features(batch.column("_text"), batch.column("_chars").to_numpy())
            offsets = pa.array(np.searchsorted(doc, np.arange(len(batch) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (place.astype(np.int32), value.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), *lists], ["id", "label", "place", "value"])

    kind, of = rows.schema["_id"].dataType.simpleString(), rows.schema["_label"].dataType.simpleString()
    sample = rows.mapInArrow(featured, f"id {kind}, label {of}, place array<int>, value array<float>")
    sample = written(sample.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(SHARDS)).cast("int")), "fm-sample")
    machine = Machine()
    for turn in range(ROUNDS):
        fitted = _shard_fit(machine, turn)
        parts = sorted(sample.groupBy("shard").applyInArrow(fitted, "shard int, n long, w0 double, w binary, v binary").collect(), key=lambda r: r.shard)
        if not parts:
            break
        share = np.array([r.n for r in parts], np.float64) / sum(r.n for r in parts)
        mean = lambda name, like: sum(s * np.frombuffer(r[name], np.float32).reshape(like.shape) for s, r in zip(share, parts)).astype(np.float32)
        machine = Machine(float(sum(s * r.w0 for s, r in zip(share, parts))), mean("w", machine.w), mean("v", machine.v))
    discard(chosen, sample)
    return machine


def score(docs: DataFrame, machine: Machine, keep: list[Column], text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``row`` (the columns ``keep``) and the score of each document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 2000):
                part = batch.slice(start, 2000)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(machine.scores(part.column("_text"), part.column("_chars").to_numpy()))], ["row", "score"])

    rows = docs.select(F.struct(*keep).alias("row"), *_inputs(docs, text_col, chars_col))
    return rows.mapInArrow(scored, row_schema(rows, "row", more="score double"))
