"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams of a language in order. A document gets the language whose profile
is nearest to its own list by out-of-place distance: each n-gram adds the difference of its two ranks, or the length of
the profile where the language lacks it.

Letters are what Unicode calls letters and the marks that combine with them, so that words of any script stay whole.

Training counts run over a sample of ``TRAIN_DOCS`` documents a language at most (in expectation, by a hash of the id);
every document, whole, is predicted. n-grams have up to three characters and are packed into 64 bits without loss.

Defined results: text that is null or has no letter is ``und`` with score 0, as is every text if no language could be
learned; n-grams of equal count are ordered by their packed value, languages of equal distance by name; very long texts
are read whole; repeated rows are predicted alike, and each counts in training; an empty table gives an empty result; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenspan.llm._common import discard, join_small, written
from lumenspan.llm.mixing import coin

PROFILE = 400
TRAIN_DOCS = 2000
BITS = 21  # of a code point
UNKNOWN = "und"

_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of the padded words, most frequent first, with their counts."""
    line = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, line)):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(f" {line} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = codes != 32
    two = (codes[:-1] << BITS) | codes[1:]
    three = (two[:-1] << BITS) | codes[2:]
    grams, counts = np.unique(np.concatenate([codes[letter], two, three[letter[1:-1]]]), return_counts=True)
    order = np.argsort(-counts, kind="stable")
    return grams[order], counts[order]


class Profiles:
    """Ranks of n-grams in every language."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), self.langs.index(lang)] = rank

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language and a score: how much nearer it is than the next one, 0.5 when both are alike."""
        grams = gram_counts(text)[0][:PROFILE]
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        at = np.where(self.grams[at] == grams, at, len(self.grams))
        theirs = self.ranks[at]
        apart = np.where(theirs < 0, PROFILE, np.abs(theirs - np.arange(len(grams))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        others = np.delete(apart, best)
        rival = float(others.min()) if len(others) else float(PROFILE * len(grams))
        total = rival + float(apart[best])
        return self.langs[best], rival / total if total else 0.5


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles from rows with a language; the driver gets ``PROFILE`` rows a language."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "lang-sizes")
    sample = join_small(rows, sizes.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"), "inner").filter(coin(F.col("id"), "langid") * F.col("n") < TRAIN_DOCS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                parts = [gram_counts(texts[i]) for i in np.flatnonzero(langs == lang)]
                grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                sums = np.bincount(at, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()), "gram": grams, "n": sums})

    counts = sample.select("lang", "text").mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")) - 1
    top = counts.withColumn("rank", rank).filter(F.col("rank") < PROFILE)
    found = Profiles([(r.lang, r.gram, r["rank"]) for r in top.collect()])
    discard(sizes)
    return found


def predict(docs: DataFrame, profiles: Profiles, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred and score."""
    kind = docs.schema[id_col].dataType.simpleString()

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.nearest(text) for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["_id", "held_out", "lang_pred", "score"]
            )

    rows = docs.select(docs[id_col].alias("_id"), held_out.alias("held_out"), docs[text_col].alias("_text"))
    return rows.mapInArrow(predicted, f"_id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("_id", id_col)
