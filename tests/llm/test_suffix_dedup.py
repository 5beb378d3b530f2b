"""Suffix-array dedup against sorted suffixes and brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from lumenspan.llm import suffix_dedup
from lumenspan.llm._common import table
from lumenspan.llm.queries import QUERIES
from tests.llm.helpers import docs, odd_rows, prose


@pytest.mark.parametrize("alphabet", [1, 2, 3, 26])
def test_grouping_sorts_all_suffixes(alphabet):
    rng = np.random.default_rng(alphabet)
    texts = [[*rng.integers(1, 1 + alphabet, rng.integers(0, 60)).tolist(), 0] for _ in range(200)]
    first = np.r_[0, np.cumsum([len(t) for t in texts])]
    order = suffix_dedup.suffix_order(np.concatenate(texts).astype(np.int64), first)
    for k, t in enumerate(texts):
        assert (order[first[k] : first[k + 1]] - first[k]).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_a_group_is_a_longest_lyndon_prefix():
    rng = np.random.default_rng(9)
    text = [*rng.integers(1, 4, 300).tolist(), 0]
    group, before = suffix_dedup.lyndon_groups(np.array(text), np.array([0, len(text)]))

    def prefix(i):  # up to the next smaller suffix
        return tuple(text[i : next((j for j in range(i + 1, len(text)) if text[j:] < text[i:]), len(text))])

    found = {}
    for i, g in enumerate(group.tolist()):
        found.setdefault(g, set()).add(prefix(i))
    assert all(len(p) == 1 for p in found.values()) and len(found) == len({prefix(i) for i in range(len(text))})
    assert [p for _, (p,) in sorted(found.items())] == sorted({prefix(i) for i in range(len(text))})
    assert before.tolist() == [next((j for j in range(i - 1, -1, -1) if group[j] < group[i]), -1) for i in range(len(text))]


def brute(rows, length=50):
    """(id, n_bytes, n_removed, n_spans, digest) from the least id of every string."""
    last, low, texts = (1 << 63), {}, [(r[1] or "").encode() for r in rows]
    key = lambda r: last if r[0] is None else r[0]
    for r, t in zip(rows, texts):
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            low[s] = min(low.get(s, last), key(r))
    out = []
    for r, t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if low[t[i : i + length]] < key(r):
                gone[i : i + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((r[0], len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def _key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def _check(spark, rows, parts=3):
    got = suffix_dedup.removed(docs(spark, rows).repartition(parts))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(brute(rows), key=_key)


def _rows(rng, n):
    passages = [prose(rng, 12, [f"w{i}é" for i in range(90)]) for _ in range(6)] + ["ab" * 40, "z" * 180]
    rows = []
    for i in range(n):
        parts = [prose(rng, rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 30)
            parts += [p[a : a + rng.randint(20, 200)], prose(rng, rng.randint(0, 12))]
        rows.append((rng.randint(0, n), rng.choice(["", " ", "\n"]).join(parts)))
    return rows + [(n + 1, rows[0][1]), (n + 2, rows[0][1][3:]), (n + 3, rows[0][1] + " end")]


def test_removed_equals_brute_force(spark):
    _check(spark, _rows(random.Random(1), 150) + odd_rows())


@pytest.mark.parametrize("hot", [1, 4])
def test_windows_of_hot_families_meet_by_themselves(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    monkeypatch.setattr(suffix_dedup, "BATCH", 900)
    _check(spark, _rows(random.Random(2), 120))


def test_a_passage_of_every_document_is_kept_once(spark):
    rng = random.Random(3)
    passage = prose(rng, 20)
    rows = [(i, f"{prose(rng, 6)} {passage} {prose(rng, 6)}") for i in range(400)]
    _check(spark, rows, 8)
    route = suffix_dedup.HOT
    assert route < 400  # so that its families are hot


def test_runs_of_one_byte_and_edges(spark):
    rows = [(3, "a" * 49), (4, "a" * 50), (5, "a" * 51), (6, "a" * 5000), (7, "b" * 50), (8, "b" * 50 + "c" + "b" * 50), (9, "x" + "b" * 49), (1, "c" * 300), (2, "c" * 300), (2, "d" * 60), (2, "d" * 60), (None, "d" * 60), (None, "e" * 70), (None, "e" * 70)]
    _check(spark, rows)
    assert suffix_dedup.removed(docs(spark, [])).isEmpty()


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_suffix_dedup"](spark, sf).collect())) == sorted(brute(rows))


def test_ranges_get_like_shares_of_the_families():
    rng = random.Random(4)
    text = np.frombuffer(prose(rng, 60_000, [f"w{i}" for i in range(20_000)]).encode(), np.uint8)
    family = np.unique(suffix_dedup.segments(text, np.array([len(text)]))[2])
    share = np.diff(suffix_dedup._bounds(family, 32))
    assert share.sum() == len(family) > 5000
    assert share.max() < 2 * share.mean()


def test_bytes_are_gathered_a_part_at_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 1 << 16)
    x, rng = np.arange(1 << 22, dtype=np.uint32).astype(np.uint8), np.random.default_rng(6)
    n = np.r_[rng.integers(0, 90, 40_000), 70_000, 0]
    first = rng.integers(0, len(x) - 70_000, len(n))
    expected = x[suffix_dedup.places(first, n)]
    tracemalloc.start()
    got = suffix_dedup.gathered(x, first, n)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == expected).all() and peak < 4 * len(expected)
    assert len(suffix_dedup.gathered(x, n[:0], n[:0])) == 0
