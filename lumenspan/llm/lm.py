"""LM scoring by deleted interpolation of word bigrams.

``p(w | v) = l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1)``, where ``b`` buckets the context by its frequency. The
weights of each bucket come from expectation-maximisation on a part of the training texts that is left out of the counts;
then all training texts are counted. Counts cover the whole corpus and are exact 64-bit integers. For the
weights alone, held-out tokens whose two estimates lie in the same quarter octave are summed up and share their mean
estimates, so that the driver gets a table bounded by the number of such cells.

Every input partition packs its texts into blocks of about ``BLOCK_BYTES``, in order of the rows and those of base, tuning and
unseen texts apart, whatever their ids are; the blocks are written once. A block reduces its texts to sorted keys of its words and
bigrams with their counts and sends each range of keys to one place, where all blocks' runs of that range are merged. Only the
merged counts, in the order of the block's own keys, come back, so neither words nor a table of all n-grams move. A block
sends a record for each range that it has keys of, so that there are never more records than distinct keys of blocks. A key has 96 bits in two
independent hashes; equal first hashes with different second ones are told apart.

Tokens are maximal runs outside ASCII white space with A-Z in lower case, then one end.

Defined results: null counts as empty, which scores its end alone; contexts or words never seen fall to the lower
orders; without training texts the model is uniform; rows with the same id, or without one, are scored one by one; a very
long text is a block of its own; other columns are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lumenspan.llm._common import whole, written
from lumenspan.llm.mixing import coin

BLOCK_BYTES = 7_000_000
RANGE_BYTES = 12_000_000  # of text a range of keys, about two million keys
TUNING = 1 / 16
BUCKETS = 48
STEPS = 40
BASE, TUNE, UNSEEN = 0, 1, 2

START, END = "\t", "\n"  # no token holds either


def _hash(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of two hashes of every word."""
    names = np.array(words, dtype=object)
    return pd.util.hash_array(names, categorize=False), (pd.util.hash_array(names, hash_key="second-hash-key.", categorize=False) >> np.uint64(32)).astype(np.uint32)


def _pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (one * np.uint64(0x9E3779B97F4A7C15)) ^ (two + (two >> np.uint64(31)))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def distinct(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (key, check), in order of the keys, and the place of every given one among them."""
    found, at = np.unique(keys, return_inverse=True)
    own = np.zeros(len(found), np.uint32)
    own[at] = checks
    if (own[at] == checks).all():
        return found, own, at
    order = np.lexsort((checks, keys))
    new = np.r_[True, (np.diff(keys[order]) != 0) | (np.diff(checks[order]) != 0)]
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(new) - 1
    return keys[order][new], checks[order][new], at


class Block:
    """The tokens of some texts as keys: odd ones are words, even ones bigrams."""

    def __init__(self, texts: pa.Array):
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat, owner = pc.list_flatten(words), pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
        real = pc.not_equal(flat, "")
        owner, coded = owner[real.to_numpy(zero_copy_only=False)], flat.filter(real).dictionary_encode()
        n, (hashes, seconds) = len(texts), _hash(coded.dictionary.to_pylist() + [START, END])
        codes = coded.indices.to_numpy(zero_copy_only=False)
        size = np.bincount(owner, minlength=n)
        # start, words and end of each text, one text after the other
        line = np.full(len(codes) + 2 * n, len(hashes) - 1, np.int64)
        first = np.cumsum(size + 2) - size - 2
        line[first] = len(hashes) - 2
        line[np.arange(len(codes)) + 2 * owner + 1] = codes
        ends = np.ones(len(line), bool)
        ends[first] = False
        keys, checks = hashes[line], seconds[line]
        pairs = _pair(keys[:-1], keys[1:])[ends[1:]] & ~np.uint64(1)
        pair_checks = (_pair(checks[:-1].astype(np.uint64), checks[1:].astype(np.uint64))[ends[1:]] >> np.uint64(32)).astype(np.uint32)
        self.keys, self.checks, at = distinct(np.concatenate([keys | np.uint64(1), pairs]), np.concatenate([checks, pair_checks]))
        self.counts = np.bincount(at, minlength=len(self.keys))
        place = at[: len(line)]
        self.word, self.context, self.pair = place[ends], place[:-1][ends[1:]], at[len(line) :]
        self.size = size + 1
        self.owner = np.repeat(np.arange(n), self.size)

    @staticmethod
    def start_key() -> np.uint64:
        return _hash([START])[0][0] | np.uint64(1)

    def bounds(self, ranges: int) -> np.ndarray:
        """Where each range of keys begins."""
        return np.searchsorted(((self.keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32), np.arange(ranges + 1, dtype=np.uint64))


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which shuffles compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplanes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _pack(docs: DataFrame, id_col: str, text_col: str, kind: Column) -> DataFrame:
    """Blocks of texts: block (a number), kind, size (bytes of text) and rows (ids and texts, compressed)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[list[pa.RecordBatch]] = [[], [], []]
        held = [0, 0, 0]

        def block(kind: int) -> pa.RecordBatch:
            parts, size = pa.Table.from_batches(open_[kind]), held[kind]
            open_[kind], held[kind] = [], 0
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(parts.combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["kind", "size", "rows"])

        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            sizes = pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)
            for kind in range(3):
                own = np.flatnonzero(kinds == kind)
                begin = 0
                while begin < len(own):
                    filled = held[kind] + np.cumsum(sizes[own[begin:]])
                    n = min(int(np.searchsorted(filled, BLOCK_BYTES)) + 1, len(own) - begin)
                    # take copies, so that nothing keeps the whole batch
                    open_[kind].append(batch.select(["id", "text"]).take(pa.array(own[begin : begin + n])))
                    held[kind], begin = int(filled[n - 1]), begin + n
                    if held[kind] >= BLOCK_BYTES:
                        yield block(kind)
        yield from (block(kind) for kind in range(3) if open_[kind])

    rows = docs.select(docs[id_col].alias("id"), whole(docs[text_col]).alias("text"), kind.cast("int").alias("kind"))
    return rows.mapInArrow(packed, "kind int, size long, rows binary").withColumn("block", F.monotonically_increasing_id())


def _unpack(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _texts(rows: pa.Table) -> pa.Array:
    return rows["text"].combine_chunks() if rows["text"].num_chunks != 1 else rows["text"].chunk(0)


def _count(ranges: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, kind, rows in zip(*(batch.column(c) for c in ("block", "kind", "rows"))):
                block = Block(_texts(_unpack(rows.as_py())))
                bounds = block.bounds(ranges)
                some = np.flatnonzero(np.diff(bounds))
                runs = [slice(bounds[r], bounds[r + 1]) for r in some]
                planes = [
                    [_planes(np.diff(block.keys[r], prepend=np.uint64(0))) for r in runs],
                    [_planes(block.checks[r]) for r in runs],
                    [_planes(block.counts[r].astype(np.uint32)) for r in runs],  # no block has 2**32 tokens
                ]
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([number.as_py()] * n, pa.int64()), pa.array([kind.as_py()] * n, pa.int32()), *(pa.array(x, pa.binary()) for x in planes)],
                    ["range", "block", "kind", "keys", "checks", "counts"],
                )

    return counted


def _merge(part: pa.Table) -> pa.Table:
    """A range's runs from all blocks into counts of base texts and of all training texts, for each block in its own order."""
    blocks, kind = part["block"].to_pylist(), part["kind"].to_numpy()
    keys = [np.cumsum(_unplanes(x.as_py(), np.uint64), dtype=np.uint64) for x in part["keys"]]
    kinds = np.repeat(kind, [len(k) for k in keys])
    found, _, at = distinct(np.concatenate(keys), np.concatenate([_unplanes(x.as_py(), np.uint32) for x in part["checks"]]))
    flat = np.concatenate([_unplanes(x.as_py(), np.uint32) for x in part["counts"]]).astype(np.int64)
    # sums of whole numbers, exact up to 2**53
    base, seen = (np.bincount(at, flat * some, len(found)).astype(np.int64) for some in (kinds == BASE, kinds != UNSEEN))
    cut = np.cumsum([len(k) for k in keys])[:-1]
    words = ((found & np.uint64(1)) == 1) & (found != Block.start_key())
    totals = [int(x) for x in (base[words].sum(), (base[words] > 0).sum(), seen[words].sum(), (seen[words] > 0).sum())]
    n, own = len(blocks) + 1, np.split(at, cut)
    return pa.table(
        {
            "kind": pa.array([*kind, -1], pa.int32()),
            "block": pa.array([*blocks, -1], pa.int64()),
            "range": pa.array([part["range"][0].as_py()] * n, pa.int32()),
            "base": pa.array([*(_planes(base[x]) if k == TUNE else b"" for k, x in zip(kind, own)), b""], pa.binary()),
            "seen": pa.array([*(_planes(seen[x]) for x in own), b""], pa.binary()),
            "totals": pa.array([None] * (n - 1) + [totals], pa.list_(pa.int64())),
        }
    )


def _returned(part: pa.Table, name: str) -> np.ndarray:
    part = part.sort_by("range")
    return np.concatenate([_unplanes(x.as_py(), np.int64) for x in part[name]]).astype(np.float64)


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the whole part of its count's binary logarithm."""
    return np.minimum(np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0), BUCKETS - 1).astype(np.int64)


def _estimates(block: Block, count: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, bigram and unigram maximum-likelihood estimates of every token."""
    context = count[block.context]
    return bucket(context), count[block.pair] / np.maximum(context, 1), count[block.word] / max(total, 1)


def _tuning(total: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def cells(docs: pa.Table, back: pa.Table) -> pa.Table:
        block = Block(_texts(_unpack(docs["rows"][0].as_py())))
        b, two, one = _estimates(block, _returned(back, "base"), total)
        grid = [np.where(x > 0, np.round(4 * np.log2(np.where(x > 0, x, 1))), 1).astype(np.int64) for x in (two, one)]
        cell, at, n = np.unique(np.stack([b, *grid], axis=1), axis=0, return_inverse=True, return_counts=True)
        at = at.reshape(-1)
        return pa.table({"bucket": cell[:, 0], "q2": cell[:, 1], "q1": cell[:, 2], "n": n, "s2": np.bincount(at, two, len(n)), "s1": np.bincount(at, one, len(n))})

    return cells


def mixture(bucket: np.ndarray, n: np.ndarray, two: np.ndarray, one: np.ndarray, zero: float) -> np.ndarray:
    """Weights (BUCKETS x 3) of bigram, unigram and uniform estimates by expectation-maximisation on held-out counts.

    One pseudo-count a component keeps every weight above zero; a bucket without held-out tokens takes the weights of all.
    The bigram has no part in bucket 0, where its context was never seen.
    """
    f = np.stack([two, one, np.full(len(n), zero)], axis=1)

    def learned(n: np.ndarray, f: np.ndarray, open_: np.ndarray) -> np.ndarray:
        weights = open_ / open_.sum()
        for _ in range(STEPS):
            share = weights * f
            gained = (n[:, None] * share / np.maximum(share.sum(axis=1, keepdims=True), 1e-300)).sum(axis=0) + open_
            weights = gained / gained.sum()
        return weights

    every = learned(n, f, np.ones(3))
    out = np.tile(every, (BUCKETS, 1))
    for b in np.unique(bucket):
        own = bucket == b
        out[b] = learned(n[own], f[own], np.array([float(b > 0), 1.0, 1.0]))
    out[0] *= [0, 1, 1]
    out[0] /= out[0].sum()
    return out


def _score(kind: pa.DataType, weights: np.ndarray, total: int, vocabulary: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def scored(docs: pa.Table, back: pa.Table) -> pa.Table:
        rows = _unpack(docs["rows"][0].as_py())
        block, n = Block(_texts(rows)), len(rows)
        count = _returned(back, "seen")
        b, two, one = _estimates(block, count, total)
        own = weights[b]
        p = own[:, 0] * two + own[:, 1] * one + own[:, 2] / (vocabulary + 1)
        c = count[block.word]
        return pa.table(
            {
                "id": rows["id"].cast(kind),
                "held_out": pa.array([docs["kind"][0].as_py() == UNSEEN] * n, pa.bool_()),
                "n_tokens": pa.array(block.size, pa.int64()),
                "n_known": pa.array(np.bincount(block.owner, c > 0, n).astype(np.int64)),
                "train_tokens": pa.array([total] * n, pa.int64()),
                "base_score": np.bincount(block.owner, np.log10((c + 1) / (total + vocabulary + 1)), n),
                "score": np.bincount(block.owner, np.log10(p), n),
            }
        )

    return scored


class Model(NamedTuple):
    """Weights (BUCKETS x 3), tokens and distinct words of all training texts, and the tables that a scoring reads."""

    weights: np.ndarray
    tokens: int
    vocabulary: int
    packed: DataFrame
    counts: DataFrame


def learn(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Counts of the texts that are not held out, and weights from a sixteenth of them."""
    kind = F.when(held_out, UNSEEN).when(coin(docs[id_col], "lm") < TUNING, TUNE).otherwise(BASE)
    packed = written(_pack(docs, id_col, text_col, kind), "lm-packed", by="kind")
    ranges = max(64, math.ceil((packed.agg(F.sum("size")).first()[0] or 0) / RANGE_BYTES))

    runs = packed.select("block", "kind", "rows").mapInArrow(_count(ranges), "range int, block long, kind int, keys binary, checks binary, counts binary")
    merged = runs.groupBy("range").applyInArrow(_merge, "kind int, block long, range int, base binary, seen binary, totals array<bigint>")
    counts = written(merged, "lm-counts", by="kind")
    sums = counts.filter("kind = -1").select(*[F.sum(F.get("totals", F.lit(i))).alias(f"t{i}") for i in range(4)]).first()
    base_n, base_v, seen_n, seen_v = (x or 0 for x in sums)

    tuned = packed.filter(F.col("kind") == TUNE).groupBy("block").cogroup(counts.filter(F.col("kind") == TUNE).groupBy("block"))
    cells = (
        tuned.applyInArrow(_tuning(base_n), "bucket long, q2 long, q1 long, n long, s2 double, s1 double")
        .groupBy("bucket", "q2", "q1")
        .agg(F.sum("n").alias("n"), F.sum("s2").alias("s2"), F.sum("s1").alias("s1"))
        .orderBy("bucket", "q2", "q1")
        .toPandas()
    )
    n = cells["n"].to_numpy(np.float64)
    weights = mixture(cells["bucket"].to_numpy(np.int64), n, cells["s2"].to_numpy(np.float64) / n, cells["s1"].to_numpy(np.float64) / n, 1 / (base_v + 1))
    return Model(weights, seen_n, seen_v, packed, counts)


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    return scored(learn(docs, held_out, id_col, text_col), docs.schema[id_col].dataType, id_col)


def scored(model: Model, id_type: T.DataType, id_col: str = "doc_id") -> DataFrame:
    """The rows that a model has packed, with their scores."""
    both = model.packed.groupBy("block").cogroup(model.counts.filter("kind >= 0").select("block", "range", "seen").groupBy("block"))
    schema = f"id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return both.applyInArrow(_score(to_arrow_type(id_type), model.weights, model.tokens, model.vocabulary), schema).withColumnRenamed("id", id_col)
