"""Conversation repair and vector codes against brute force."""

import hashlib
import math
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from lumenspan.llm import conversations, vector_codes
from lumenspan.llm._common import table
from lumenspan.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, audit string, part int, `odd.name` string"
WS = "\x20\x09\x0a\x0b\x0c\x0d"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def brute_repair(rows):
    """(conv_id: result) for all conversations of the damaged rows."""
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    return {c: brute_one(sorted(v, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))) for c, v in convs.items()}


def brute_one(rows):
    faults, seen = [], set()
    for _, _, role, text in rows:
        core = text.rstrip(WS)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]

    def may(before, role):  # before: initials so far, as far as they matter
        return role in {"": "su", "s": "u", "u": "a", "a": "u"}[before]

    @lru_cache(None)
    def best(i, before, inserted):
        found = [(0, "", ())] if i == len(rows) and before in ("", "a") else []
        if inserted < 3:
            for role in "ua":
                if may(before, role):
                    c, s, e = best(i, role, inserted + 1)
                    found.append((c + 5, "I" + s, (({"u": "user", "a": "assistant"}[role], ""), *e)))
        if i < len(rows):
            c, s, e = best(i + 1, before, 0)
            found.append((c + 2, "D" + s, e))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                own = initials[i]
                if own and may(before, own):
                    c, s, e = best(i + 1, own, 0)
                    found.append((c + more, "K" + s, ((rows[i][2], rows[i][3]), *e)))
                for role in "ua":
                    if may(before, role):
                        c, s, e = best(i + 1, role, 0)
                        found.append((c + more + 1, "R" + s, (({"u": "user", "a": "assistant"}[role], rows[i][3]), *e)))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "", ())

    for i in range(len(rows), 0, -1):  # from the end, so that no call goes deep
        for before in ("", "s", "u", "a"):
            best(i, before, 0)
    cost, audit, left = best(0, "", 0)
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in left)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


NONE = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "o") for r in rows], TURNS)


def _check(spark, rows, frame=None):
    got = conversations.repair(conversations.damaged(frame if frame is not None else _frame(spark, rows)))
    assert got.columns == ["conv_id", *COLUMNS]
    got = {r.conv_id: tuple(r)[1:] for r in got.collect()}
    want = brute_repair(brute_damage(rows))
    assert got == {c: want.get(c, NONE) for c in {r[0] for r in rows}}
    return got


def _random(rng, n, convs):
    texts = ["One.", "Two!", "Three?", "cut", "", " \n", None, "Four. ", "a.b", "é!\t"]
    return [(rng.choice([*range(convs), None]), rng.choice([*range(9), None]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), rng.choice(texts)) for _ in range(n)]


def test_repair_equals_brute_force(spark):
    rng = random.Random(1)
    rows = _random(rng, 900, 150)
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(40)] + [(1001, 0, "user", "Long. " * 50_000)]
    _check(spark, rows)


@pytest.mark.parametrize("piece", [1, 3, 16])
def test_repair_of_cut_conversations_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rng = random.Random(piece)
    rows = _random(rng, 120, 8) + [(50, t, rng.choice(["user", "assistant"]), rng.choice(["A.", "B?", "c", f"T{t}."])) for t in range(60)]
    _check(spark, rows)


def test_a_conversation_of_a_third_of_all_rows_is_cut(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 50)
    rng = random.Random(4)
    rows = [(0, t, rng.choice(["user", "assistant"]), f"T{t % 300}.") for t in range(600)] + [(1 + i // 4, i % 4, "user" if i % 2 == 0 else "assistant", "Yes.") for i in range(1200)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _check(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_repair_of_the_table_and_of_none(spark, sf):
    frame = table(spark, sf, "conversations")
    got = _check(spark, [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()], frame)
    assert {tuple(r)[0]: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, sf).collect()} == got
    assert any("R" in r[6] for r in got.values()) and all(re.fullmatch("[DIKR]*", r[6]) for r in got.values())
    assert conversations.repair(conversations.damaged(_frame(spark, []))).isEmpty()


def brute_codes(rows):
    """(id: results in order) by the plain loop over all entries."""
    sound = [(i, l, [math.floor(256 * np.float64(x)) for x in v]) for i, l, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    sound.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not sound:
        return []
    width = len(sound[0][2]) // 16
    sound = [r for r in sound if len(r[2]) == 16 * width]
    books = [[r[2][p * width : (p + 1) * width] for r in sound[:64]] for p in range(16)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(r[2][p * width : (p + 1) * width], e)), k) for k, e in enumerate(books[p])) for p in range(16)] for r in sound]

    for _ in range(2):
        at = assign()
        for p in range(16):
            for k in range(len(books[p])):
                own = [r[2][p * width : (p + 1) * width] for r, a in zip(sound, at) if a[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    at = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in a) for a in at]
    labels = {}
    for r, e in zip(sound, errors):
        labels[r[1]] = labels.get(r[1], 0) + e
    return [(r[0], "".join(f"{k:02x}" for _, k in a), e, labels[r[1]], digest) for r, a, e in zip(sound, at, errors)]


def _key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


VECTORS = "vec_id long, label int, embedding array<float>, id string, v int, code string"


def _codes(spark, rows):
    got = vector_codes.codes(spark.createDataFrame([(*r, "x", 1, "c") for r in rows], VECTORS))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(brute_codes(rows), key=_key)


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), int(i) % 5 if i % 7 else None, (rng.normal(size=32) * 0.2).astype(np.float32).tolist()) for i in rng.permutation(300)]
    rows += [(400, 1, None), (401, 1, [0.5] * 31 + [None]), (402, 1, [0.5] * 31 + [float("nan")]), (403, 1, [0.5] * 31 + [float("inf")]), (404, 1, []), (405, 1, [1.0] * 16), (7, 2, [0.25] * 32), (None, 2, [0.25] * 32), (None, 2, [-0.001] * 32)]
    rows += [(500 + i, 9, [0.1] * 32) for i in range(100)]
    _codes(spark, rows)


def test_codes_of_few_vectors_ties_and_none(spark):
    _codes(spark, [(3, 1, [0.0] * 16), (1, 1, [1.0] * 16), (2, None, [1.0] * 16), (4, None, [0.5] * 16)])
    assert vector_codes.codes(spark.createDataFrame([], VECTORS)).isEmpty()
    assert vector_codes.codes(spark.createDataFrame([(1, 1, [1.0, 2.0], "x", 1, "c")], VECTORS)).isEmpty()


def test_codes_of_the_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "embeddings").select("vec_id", "label", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op13_vector_codes"](spark, sf).collect())) == sorted(brute_codes(rows))


@pytest.mark.parametrize("k", [1, 2, 64])
def test_annuli_find_the_nearest_entry_of_least_index(k):
    rng = np.random.default_rng(k)
    entries, points = rng.integers(-6, 6, (k, 4)), rng.integers(-8, 8, (3000, 4))
    at, d = vector_codes.nearest(points, entries)
    every = ((points[:, None] - entries) ** 2).sum(axis=2)
    assert (d == every.min(axis=1)).all() and (at == every.argmin(axis=1)).all()
