"""Toxicity: votes of the nearest labelled examples by exact TF-IDF cosine.

Terms are letter words and word beginnings of five letters; all of them count. A term's weight in a text is
``(1 + ln tf) * idf * lean``. ``lean`` lies between 1 and 1 + ``LEAN`` however many examples there are: it grows with the
divergence of the label rate among the examples that have the term from the rate of all, where the log-likelihood ratio exceeds
``CHANCE``; else it is 1. So rare words that two texts share by chance do not outweigh the words that tell the labels apart.

The examples' vectors form an inverted index. For every term it stores the largest weight and, for frequent terms, that of
each block of examples. A search adds up the query's rarer terms from the highest bound down until what is left cannot lift an
example that was not met yet among the ``NEAREST`` best; then only examples whose sum and block bound still reach the
last of these are scored to the end. Its result equals a full scan.

Score: the neighbours' labels, weighted by cosine and shrunk to the examples' base rate, then calibrated: isotonic
regression on the votes that the examples get from one another. The examples are cut into ``FOLDS`` folds by their texts, and those of a
fold are voted on under term weights learned from the labels of the others, so that the curve is fitted on votes that have not
seen the example's label. The neighbours' ids are the evidence. An example is never evidence for a text equal to its own, so that no text is
scored by its own label.

Examples are a sample of at most ``EXAMPLES`` labelled rows (in expectation, by a hash of the id), each distinct text once;
idf and lean come from them, and the driver builds the index, whose size depends on ``EXAMPLES`` and on the length of their
texts alone. Every document, whole, is scored; a very long text takes time in proportion to its length.

Defined results: null counts as empty; a text without a term has no neighbours and gets the base rate, calibrated; ties of
cosine go to the smaller id (null last); repeated rows score alike; documents labelled both ways, labels on a null id and
labels other than 0 and 1 are left out; without examples every score is 0; an empty table gives an empty result; the
columns to keep are packed into ``row`` and may have any names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import discard, join_small, row_schema, whole, written
from lumenspan.llm.mixing import coin

EXAMPLES = 6_000
NEAREST = 15
BLOCK = 64
OFTEN = 64  # examples, and at least an eighth of them, from which a term has a bound for each block
LEAN = 10.0  # what a term that only one label has weighs more, at most
FOLDS = 2
CHANCE = 11.0  # a log-likelihood ratio that one term in a thousand reaches by chance
SHRINK = 0.5
STEM = 5
STEP = 20_000  # postings that a search adds up before it looks at its bounds for the first time
SEEK = 1_500  # postings that take as long to add up as to look up one term

_WORDS = re.compile(r"[^\W\d_]+")


def term_counts(text: str) -> Counter[str]:
    """Words, and beginnings of the longer ones marked by ``^``, with their counts."""
    words = Counter(_WORDS.findall(text.lower()))
    words.update("^" + word[:STEM] for word in list(words.elements()) if len(word) > STEM)
    return words


def hashed_terms(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The sorted 64-bit keys of each text's terms, and their counts."""
    counts = [term_counts(t) for t in texts]
    names = [t for c in counts for t in c]
    keys = pd.util.hash_array(np.array(names, dtype=object), categorize=False) if names else np.empty(0, np.uint64)
    tf = np.array([n for c in counts for n in c.values()], np.int64)
    out, start = [], 0
    for c in counts:
        own = slice(start, start := start + len(c))
        order = np.argsort(keys[own])
        out.append((keys[own][order], tf[own][order]))
    return out


def digest(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def fold_of(digest: bytes) -> int:
    return digest[0] % FOLDS


def lean(n: np.ndarray, hits: np.ndarray, total: int, positive: int) -> np.ndarray:
    """Between 1 and 1 + ``LEAN``, for terms in ``n`` examples of ``total``, ``hits`` of them positive.

    Above 1 it is ``LEAN`` times the divergence of the term's label rate (with one pseudo-count at the rate of all) from the rate of all,
    divided by the greatest that there can be.
    """
    share, ratio = positive / total, np.zeros(len(n))
    for seen, expected in ((hits, n * share), (n - hits, n * (1 - share)), (positive - hits, (total - n) * share), (total - n - positive + hits, (total - n) * (1 - share))):
        some = seen > 0
        ratio[some] += 2 * seen[some] * np.log(seen[some] / np.broadcast_to(expected, seen.shape)[some])
    own = (hits + share) / (n + 1)
    divergence = own * np.log(own / share) + (1 - own) * np.log((1 - own) / (1 - share))
    return 1 + np.where(ratio > CHANCE, LEAN * divergence / -math.log(min(share, 1 - share)), 0.0)


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


class BlockMaxIndex:
    """Postings by term over examples in blocks, with the largest weight of every term and, for frequent ones, of every block."""

    def __init__(self, labels: np.ndarray, group: np.ndarray, size: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int):
        """``size`` terms of each example follow one another in ``term`` and ``weight``; examples of a group, and those of like
        size, share blocks."""
        n = len(labels)
        self.ids = np.lexsort((size, group))
        self.labels = labels[self.ids].astype(np.float64)
        self.place = np.empty(n, np.int64)
        self.place[self.ids] = np.arange(n)
        example = self.place[np.repeat(np.arange(n), size)]
        order = np.lexsort((example, term))
        self.example, self.weight = example[order].astype(np.int32), weight[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.most = np.maximum.reduceat(self.weight, self.start[:-1]) if n_terms else np.zeros(0)
        often = np.flatnonzero(np.diff(self.start) >= max(OFTEN, n / 8))
        self.often, self.row = often, np.full(n_terms, -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.block_most = np.zeros((len(often), -(-n // BLOCK)))
        for i, t in enumerate(often):
            own = slice(self.start[t], self.start[t + 1])
            np.maximum.at(self.block_most[i], self.example[own] // BLOCK, self.weight[own])
        self.dense: np.ndarray | None = None

    def _frequent(self) -> np.ndarray:
        """The weights of frequent terms as a matrix, made once in a task."""
        if self.dense is None:
            self.dense = np.zeros((len(self.often), len(self.ids)))
            for i, t in enumerate(self.often):
                own = slice(self.start[t], self.start[t + 1])
                self.dense[i, self.example[own]] = self.weight[own]
        return self.dense

    def _add(self, terms: np.ndarray, q: np.ndarray) -> np.ndarray:
        size = self.start[terms + 1] - self.start[terms]
        post = _ranges(self.start[terms], size)
        return np.bincount(self.example[post], np.repeat(q, size) * self.weight[post], len(self.ids))

    def search(self, terms: np.ndarray, q: np.ndarray, k: int = NEAREST, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples with a term in common, other than the one at ``but``."""
        row = self.row[terms]
        often, q_often, bound_often = row[row >= 0], q[row >= 0], (q * self.most[terms])[row >= 0].sum()
        terms, q = terms[row < 0], q[row < 0]
        bound = q * self.most[terms]
        order = np.argsort(-bound, kind="stable")
        terms, q, bound = terms[order], q[order], bound[order]
        rest = np.append(np.cumsum(bound[::-1])[::-1], 0.0) + bound_often
        postings = np.append(0, np.cumsum(self.start[terms + 1] - self.start[terms]))
        found, at, least, step = np.zeros(len(self.ids)), 0, 0.0, STEP
        while at < len(terms):
            to = max(at + 1, int(np.searchsorted(postings, postings[at] + step)) - 1)
            found += self._add(terms[at:to], q[at:to])
            at, step = min(to, len(terms)), step * 2
            if but >= 0:
                found[but] = 0.0
            if len(found) >= k and (least := np.partition(found, len(found) - k)[len(found) - k]) > rest[at] + 1e-9:
                break
        # an example that no term has met yet stays below the k best, unless the frequent terms alone can lift it there
        more = q_often @ self.block_most[often] + bound[at:].sum()
        some = found + np.repeat(more, BLOCK)[: len(found)] >= max(least - 1e-9, 1e-300)
        if but >= 0:
            some[but] = False
        near = np.flatnonzero(some)
        frequent = self._frequent()
        # whole rows are read faster than a tenth of their places
        cosine = found[near] + (q_often @ frequent[np.ix_(often, near)] if 16 * len(near) < len(found) else (q_often @ frequent[often])[near])
        if SEEK * (len(terms) - at) > postings[-1] - postings[at]:
            cosine += self._add(terms[at:], q[at:])[near]
        elif len(near):
            for t, x in zip(terms[at:], q[at:]):
                own = self.example[self.start[t] : self.start[t + 1]]
                here = np.minimum(np.searchsorted(own, near), len(own) - 1)
                cosine += np.where(own[here] == near, x * self.weight[self.start[t] + here], 0.0)
        least = max(np.partition(cosine, len(near) - k)[len(near) - k] - 1e-9, 0.0) if len(near) > k else 0.0
        near, cosine = near[cosine > least], cosine[cosine > least]
        best = np.lexsort((self.ids[near], -np.round(cosine, 12)))[:k]
        return near[best], cosine[best]


class Voters:
    """The vocabulary with its weights, the index, and the calibration of votes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, digests: list[bytes], size: np.ndarray, keys: np.ndarray, tf: np.ndarray, but: int = -1):
        """Examples in order of their ids, null last; ``size`` terms of each follow one another in ``keys`` and ``tf``. Term weights
        do not see the labels of fold ``but``."""
        n = len(ids)
        self.keys, term, often = np.unique(keys, return_inverse=True, return_counts=True)
        self.rate = labels.sum() / n if n else 0.0
        owner = np.repeat(np.arange(n), size)
        seen = np.array([fold_of(d) != but for d in digests], bool)
        total, positive, of = int(seen.sum()), int(labels[seen].sum()), seen[owner]
        some = np.bincount(term[of], minlength=len(self.keys))
        gain = lean(some, np.bincount(term[of], labels[owner[of]], len(self.keys)), total, positive) if 0 < positive < total else np.ones(len(self.keys))
        self.gain = np.log((n + 1) / (often + 0.5)) * gain
        self.other = math.log((n + 1) / 0.5)  # the weight of a term that no example has
        weight = (1 + np.log(tf)) * self.gain[term]
        weight /= np.sqrt(np.bincount(owner, weight**2, n))[owner]
        self.ids = ids
        # the term that weighs most in an example, if it leans to a label
        order = np.lexsort((weight, owner))[np.cumsum(size)[size > 0] - 1]
        group = np.full(n, -1)
        group[size > 0] = np.where(gain[term[order]] > 1, term[order], -1)
        self.index = BlockMaxIndex(labels, group, size, term, weight, len(self.keys))
        self.known = {d: int(self.index.place[i]) for i, d in enumerate(digests)}
        self.curve: tuple[np.ndarray, np.ndarray] | None = None

    def vote(self, text: str, keys: np.ndarray, tf: np.ndarray) -> tuple[float, list]:
        """The uncalibrated score and the ids of the neighbours."""
        if not len(self.keys) or not len(keys):
            return self.rate, []
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        held = self.keys[at] == keys
        weight = (1 + np.log(tf)) * np.where(held, self.gain[at], self.other)
        weight /= math.sqrt((weight**2).sum())
        found, cosine = self.index.search(at[held], weight[held], but=self.known.get(digest(text), -1))
        score = ((cosine * self.index.labels[found]).sum() + SHRINK * self.rate) / (cosine.sum() + SHRINK)
        return float(score), [self.ids[i] for i in self.index.ids[found]]

    def scores(self, texts: list[str]) -> tuple[list[float], list[list]]:
        """Scores, calibrated once a curve is known, and evidence."""
        votes = [self.vote(text, *terms) for text, terms in zip(texts, hashed_terms(texts))]
        raw = [s for s, _ in votes]
        return (raw if self.curve is None else np.interp(raw, *self.curve).tolist()), [e for _, e in votes]


def isotonic(score: np.ndarray, label: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Scores and the rates of positives there, rising: neighbouring groups out of order are pooled. Every rate has one
    pseudo-count at ``rate``."""
    at, inverse = np.unique(np.round(score, 6), return_inverse=True)
    groups: list[list[float]] = []
    for x, n, hits in zip(at, np.bincount(inverse), np.bincount(inverse, label)):
        groups.append([x * n, n, hits])
        while len(groups) > 1 and groups[-2][2] * groups[-1][1] >= groups[-1][2] * groups[-2][1]:
            one = groups.pop()
            groups[-1] = [a + b for a, b in zip(groups[-1], one)]
    sums = np.array(groups).T
    return sums[0] / sums[1], np.maximum.accumulate((sums[2] + rate) / (sums[1] + 1))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Voters:
    """Index and calibration from a bounded sample of the labelled rows of ``docs``."""
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col("doc_id").alias("_of")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("_other")).filter("label = _other AND _of IS NOT NULL").drop("_other")
    total = known.count()
    chosen = written(known.filter(coin(F.col("_of"), "toxicity") * total < EXAMPLES), "toxic-chosen")
    rows = join_small(docs.select(docs[id_col].alias("id"), whole(docs[text_col]).alias("text")), chosen, F.col("id") == F.col("_of"), "inner")
    once = rows.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("id").alias("id"), F.min("label").alias("label"), F.max("label").alias("_other"), F.first("text").alias("text"))
    sample = written(once.filter("label = _other").select("id", F.col("label").cast("int").alias("label"), "text", (F.conv(F.substring("digest", 1, 2), 16, 10).cast("int") % FOLDS).alias("fold")), "toxic-examples")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            terms = hashed_terms(texts)
            offsets = pa.array(np.cumsum([0, *(len(k) for k, _ in terms)]).astype(np.int32))
            flat = [np.concatenate([x[i] for x in terms]) if terms else np.empty(0) for i in range(2)]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(flat[0].astype(np.uint64).view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(flat[1].astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([digest(t) for t in texts], pa.binary()), *lists], ["id", "label", "digest", "keys", "tf"])

    kind = sample.schema["id"].dataType.simpleString()
    got = sample.mapInArrow(read, f"id {kind}, label int, digest binary, keys array<bigint>, tf array<int>").toArrow().sort_by([("id", "ascending"), ("digest", "ascending")])
    ids = np.array(got["id"].to_pylist(), dtype=object)
    size = pc.list_value_length(got["keys"]).to_numpy().astype(np.int64)
    keys, tf = (pc.list_flatten(got[c]).to_numpy() for c in ("keys", "tf"))
    given = (ids, got["label"].to_numpy().astype(np.float64), got["digest"].to_pylist(), size, keys.astype(np.int64).view(np.uint64), tf.astype(np.float64))

    def votes(part: int) -> pa.Table:
        voters = Voters(*given, but=part)

        def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(voters.scores(batch.column("text").to_pylist())[0], pa.float64()), batch.column("label")], ["score", "label"])

        return sample.filter(F.col("fold") == part).select("text", "label").mapInArrow(voted, "score double, label int").toArrow()

    found = pa.concat_tables([votes(part) for part in range(FOLDS)])
    discard(chosen, sample)
    voters = Voters(*given)
    if len(found):
        voters.curve = isotonic(found["score"].to_numpy(), found["label"].to_numpy(), voters.rate)
    return voters


def score(docs: DataFrame, voters: Voters, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``row`` (the columns ``keep``), the score and the ids of the examples behind it."""
    kind = pa.int64() if not len(voters.ids) else pa.array(voters.ids.tolist()).type

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                scores, evidence = voters.scores(part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(kind))], ["row", "score", "evidence"])

    rows = docs.select(F.struct(*keep).alias("row"), whole(docs[text_col]).alias("_text"))
    return rows.mapInArrow(voted, row_schema(rows, "row", more=f"score double, evidence array<{'string' if pa.types.is_string(kind) else 'bigint'}>"))
