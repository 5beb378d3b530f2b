"""Language, tokens, language model, toxicity and quality: brute force, round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumenspan.llm import langid, lm, piece_codec, quality_fm, toxicity
from lumenspan.llm._common import fold, table
from lumenspan.llm.queries import QUERIES, tokenizer
from tests.llm.helpers import docs, odd_rows, prose

SF01 = "/root/testdata/sf0.01"


def test_marks_belong_to_words():
    grams = set(langid.gram_counts("नमस्ते")[0].tolist())
    assert sum(ord(c) << langid.BITS * (2 - i) for i, c in enumerate("स्त")) in grams


def test_language_held_out_accuracy(spark):
    got = QUERIES["op2_language_id"](spark, SF01).join(table(spark, SF01, "documents").select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    right, score = got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score")).first()
    assert right > 0.98 and 0 <= score <= 1


def test_language_distance_equals_brute_force():
    rng = random.Random(2)
    texts = {"x": prose(rng, 300, ["abba", "bab", "aab"]), "y": prose(rng, 300, ["cdc", "dcd", "ccd"])}

    def ranked(text):
        words = re.sub(r"[\W\d_]+", " ", text.lower()).split()
        grams = Counter(f" {w} "[i : i + n] for w in words for n in (1, 2, 3) for i in range(len(w) + 3 - n))
        pack = lambda g: sum(ord(c) << langid.BITS * (len(g) - 1 - i) for i, c in enumerate(g))
        found = {pack(g): n for g, n in grams.items() if g != " "}
        return sorted(found, key=lambda g: (-found[g], g))[: langid.PROFILE]

    profiles = langid.Profiles([(lang, g, i) for lang, t in texts.items() for i, g in enumerate(ranked(t))])
    for text in [*texts.values(), "abba cdc bab", "zz"]:
        own = ranked(text)
        apart = {lang: sum(abs(i - ranked(t).index(g)) if g in ranked(t) else langid.PROFILE for i, g in enumerate(own)) for lang, t in texts.items()}
        best = min(apart, key=lambda k: (apart[k], k))
        lang, score = profiles.nearest(text)
        rival = apart["y" if best == "x" else "x"]
        assert lang == best and math.isclose(score, rival / (rival + apart[best]))


def test_language_on_odd_rows(spark):
    rng = random.Random(1)
    train = docs(spark, [(i, prose(rng, 50, ["der", "und", "ist"] if i % 2 else ["the", "and", "is"]), "de" if i % 2 else "en") for i in range(40)])
    profiles = langid.learn(train)
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs(spark, [*odd_rows(), (30, "12 !! 3"), (31, "und ist der")]), profiles, F.lit(False)).collect()}
    assert got[1] == got[2] == got[3] == got[30] == "und" and got[31] == "de"
    twice = langid.predict(docs(spark, [(40, "und ist"), (40, "und ist"), (41, "qq")]), profiles, F.lit(False)).collect()
    # repeated rows alike; a text that is as far from both languages gets the first by name
    assert [r.lang_pred for r in twice] == ["de", "de", "de"] and twice[0] == twice[1] and twice[2].score == 0.5
    assert langid.predict(docs(spark, []), profiles, F.lit(True)).isEmpty()
    nothing = langid.learn(docs(spark, []))
    assert langid.predict(train, nothing, F.lit(False)).filter("lang_pred <> 'und' or score <> 0").isEmpty()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=tokenizer("piece_bpe_32k.model"))


STRANGE = ["", " ", "  ", "a ", " a", "a  b   c ", "▁", "▁▁a ▁", "\n\n a\tb", "a\x00b", "漢字 かな", "\U0001f600\U0001f601 x", "é é", "</s> <s> <unk>", "<0x41>", "12345 6", "x" * 5000, " " * 3000, "ﬁ ﬂ ½"]


def test_ids_are_those_of_the_library(library):
    codec = piece_codec.Codec(tokenizer("piece_bpe_32k.model"))
    rng = random.Random(4)
    texts = STRANGE + ["".join(rng.choice("ab é▁ \n漢1") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    assert [x.tolist() for (x,) in codec.encode(texts, spans=False)] == [library.encode(t, add_eos=True) for t in texts]
    for text, (ids, begins, ends) in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text, add_eos=True)
        raw = text.encode()
        # the spans follow each other without gap and cover all bytes
        assert begins[0] == 0 and ends[-1] == len(raw) and (begins[1:] <= ends[:-1]).all() and (np.diff(begins) >= 0).all()
        for i, b, e in zip(ids[:-1].tolist(), begins.tolist(), ends.tolist()):
            piece = library.id_to_piece(i)
            mark = bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.encode()
            plain = mark.replace("▁".encode(), b" ")
            assert raw[b:e] in (mark, plain, plain[1:], mark[3:]) or "▁" in text


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_normalisation_by_the_compiled_map_equals_the_library(rule):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    normalizer = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = sentencepiece_model_pb2.ModelProto.FromString(tokenizer("piece_bpe_32k.model"))
    proto.normalizer_spec.CopyFrom(sentencepiece_model_pb2.ModelProto.FromString(normalizer.serialized_model_proto()).normalizer_spec)
    codec = piece_codec.Codec(proto.SerializeToString())
    for text in ["ｆｕｌｌ ＷＩＤＴＨ", "ﬁne ½ ①", "ȩ́ å  b ", "한글 각", "  Straße ǅ", "a\u200bb\tc", "㍿㌔", "plain", "", " "]:
        got, origin = codec.normalise(text)
        want, offsets = normalizer.normalize(text, with_offsets=True)
        assert got == want and len(origin) == len(got.encode()) + 1
        starts = np.cumsum([0, *(len(c.encode()) for c in got)])
        if got:
            assert [len(text.encode()[: origin[s]].decode()) for s in starts] == list(offsets)
        assert codec.encode([text])[0][0].tolist() == codec.sp.encode(text, add_eos=True)


def test_tidy_normalisation_of_spaces():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(tokenizer("piece_bpe_32k.model"))
    proto.normalizer_spec.remove_extra_whitespaces = True
    model = proto.SerializeToString()
    codec = piece_codec.Codec(model)
    for text in ["  a   b ", "", "   ", "x"]:
        assert codec.encode([text])[0][0].tolist() == codec.sp.encode(text, add_eos=True)
    norm, origin = codec.normalise("  a   b ")
    assert norm == "▁a▁b" and origin.tolist() == [2, 2, 2, 2, 3, 3, 3, 6, 7]


def test_tokens_of_odd_rows_round_trip(spark, library):
    import hashlib

    rows = odd_rows()
    model = tokenizer("piece_bpe_32k.model")
    frame = docs(spark, rows).withColumn("ids", F.lit("clash"))
    got = piece_codec.decode(piece_codec.encode(frame, model), model)
    same = piece_codec.encode(frame, model, decoded="decoded")
    assert sorted(r.decoded for r in got.collect()) == sorted(r.decoded for r in same.collect()) and same.columns == got.columns
    assert set(got.columns) == {*frame.columns, "begins", "ends", "decoded"}
    text = sorted((t or "") for _, t, *_ in rows)
    assert sorted(r.decoded for r in got.collect()) == sorted(library.decode(library.encode(t)) for t in text)
    digests = sorted(r.ids_sha256 for r in piece_codec.digests(frame, model).collect())
    assert digests == sorted(hashlib.sha256(" ".join(map(str, library.encode(t, add_eos=True))).encode()).hexdigest() for t in text)
    assert piece_codec.digests(docs(spark, []), model).isEmpty()


def test_cache_holds_few_ids_whatever_the_texts(library, monkeypatch):
    codec = piece_codec.Codec(tokenizer("piece_bpe_32k.model"))
    rng = random.Random(9)
    texts = ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(20_000)) for _ in range(12)]
    assert [x.tolist() for x, _, _ in codec.encode(texts)] == [library.encode(t, add_eos=True) for t in texts]
    assert codec.held == 0 and sum(map(len, codec.cache.values())) <= 1
    monkeypatch.setattr(piece_codec, "CACHE", 500)
    for i in range(20):
        codec.encode([" ".join(f"word{rng.random()}" for _ in range(50))])
        assert sum(map(len, codec.cache.values())) <= codec.held <= 500 + 50 * 40


def test_query_with_a_compiled_map_equals_the_library(spark):
    import hashlib

    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(tokenizer("piece_bpe_32k.model"))
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto.normalizer_spec.CopyFrom(sentencepiece_model_pb2.ModelProto.FromString(normalizer.serialized_model_proto()).normalizer_spec)
    model = proto.SerializeToString()
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    frame = docs(spark, [(1, "ｆｕｌｌ  ＷＩＤＴＨ ﬁne"), (2, None), (3, " 한글 ㍿ "), (3, " 한글 ㍿ ")])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t, *_ in [(r.doc_id, r.text) for r in frame.collect()]:
        ids = own.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(own.decode(ids))))
    got = piece_codec.digests(frame, model)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == sorted(want)
    spans = piece_codec.encode(frame, model).select("doc_id", F.xxhash64("begins", "ends").alias("spans_hash"))
    assert got.select("doc_id", "spans_hash").exceptAll(spans).isEmpty()


LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _lm_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + ["\n"]


def test_lm_counts_and_base_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [*odd_rows(), *[(100 + i, prose(rng, rng.randint(0, 40), ["Aa", "b", "c,", "É", "d"])) for i in range(200)], (100, "b b b")]
    held = lambda i: zlib.crc32(str("null" if i is None else i).encode()) % 7 == 2
    got = lm.score(docs(spark, rows), fold("doc_id", 7) == 2).collect()
    counts = Counter(t for i, x, *_ in rows if not held(i) for t in _lm_tokens(x))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, x, *_ in rows:
        tokens = _lm_tokens(x)
        expected.append((i is None, i or 0, held(i), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), 6)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(expected)
    unseen = [r for r in got if r.held_out and (r.doc_id or 0) >= 100]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) and all(r.score < 0 for r in got)


def test_lm_scores_equal_brute_force_interpolation(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 900)
    rng = random.Random(18)
    vocabulary = [f"w{int(40 * rng.random() ** 2)}" for _ in range(400)]
    rows = [*odd_rows(), *[(100 + i, prose(rng, rng.randint(0, 60), vocabulary)) for i in range(400)], *[(None, prose(rng, 30, vocabulary)) for _ in range(60)]]
    frame = docs(spark, rows)
    held_out = fold("doc_id", 7) == 2
    model = lm.learn(frame, held_out)
    assert model.packed.count() > 20
    held = lambda i: zlib.crc32(str("null" if i is None else i).encode()) % 7 == 2
    tokens = [(i, held(i), _lm_tokens(x)) for i, x, *_ in rows]
    one, two, context = (Counter(x for _, unseen, t in tokens if not unseen for x in of(t)) for of in (lambda t: t, lambda t: zip(["\t", *t], t), lambda t: ["\t", *t[:-1]]))
    n, v = sum(one.values()), len(one)
    assert (model.tokens, model.vocabulary) == (n, v)
    want = []
    for i, unseen, t in tokens:
        total = 0.0
        for c, w in zip(["\t", *t], t):
            l2, l1, l0 = model.weights[0 if not context[c] else min(int(math.log2(context[c])) + 1, lm.BUCKETS - 1)]
            total += math.log10(l2 * two[c, w] / max(context[c], 1) + l1 * one[w] / n + l0 / (v + 1))
        want.append((i is None, i or 0, unseen, round(total, 6)))
    got = lm.scored(model, frame.schema["doc_id"].dataType).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, round(r.score, 6)) for r in got) == sorted(want)


def test_lm_blocks_are_bounded_when_no_row_has_an_id(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2_000)
    rng = random.Random(19)
    rows = [(None, prose(rng, 20)) for _ in range(2000)] + [(None, prose(rng, 4000))]
    model = lm.learn(docs(spark, rows), F.lit(False))
    sizes = [r["size"] for r in model.packed.collect()]
    assert sum(s > 2_200 for s in sizes) == 1 and sum(sizes) == sum(len(x) for _, x in rows)
    got = lm.scored(model, docs(spark, rows).schema["doc_id"].dataType)
    assert got.count() == 2001 and got.filter("doc_id is not null").isEmpty()


def test_lm_counts_pass_32_bits_and_keys_that_share_a_hash():
    big = np.array([5_000_000_000, 1], np.int64)
    assert lm._returned(pa.table({"range": [0], "seen": pa.array([lm._planes(big)], pa.binary())}), "seen").tolist() == [5e9, 1]
    keys, checks = np.array([9, 3, 9, 9, 3], np.uint64), np.array([1, 5, 2, 1, 5], np.uint32)
    found, own, at = lm.distinct(keys, checks)
    assert found.tolist() == [3, 9, 9] and own.tolist() == [5, 1, 2] and at.tolist() == [1, 0, 2, 1, 0]
    run = lambda block, kind, n: {"range": 0, "block": block, "kind": kind, "keys": lm._planes(np.array([8, 1], np.uint64)), "checks": lm._planes(np.array([1, 2], np.uint32)), "counts": lm._planes(np.array([n, n], np.uint32))}
    part = pa.Table.from_pylist([run(0, lm.BASE, 4_000_000_000), run(1, lm.TUNE, 4_000_000_000), run(2, lm.UNSEEN, 7)])
    merged = lm._merge(part).to_pylist()
    assert [lm._unplanes(r["seen"], np.int64).tolist() for r in merged[:3]] == [[8_000_000_000] * 2] * 3 and merged[3]["totals"] == [4_000_000_000, 1, 8_000_000_000, 1]


def test_lm_probabilities_sum_to_one():
    rng = random.Random(1)
    texts = [prose(rng, 30, ["a", "b", "c", "d"]) for _ in range(40)]
    tokens = [_lm_tokens(t) for t in texts]
    one = Counter(t for x in tokens for t in x)
    two = Counter(p for x in tokens for p in zip(["\t", *x], x))
    context = Counter(c for x in tokens for c in ["\t", *x[:-1]])
    total, vocabulary = sum(one.values()), sorted(one)
    weights = lm.mixture(np.array([3, 3, 5]), np.array([5.0, 4, 9]), np.array([0.2, 0, 0.4]), np.array([0.1, 0.2, 0.1]), 1 / (len(one) + 1))
    assert np.allclose(weights.sum(axis=1), 1) and (weights[1:] > 0).all() and weights[0, 0] == 0
    for c in context:
        w = weights[lm.bucket(np.array([context[c]]))[0]]
        mass = sum(w[0] * two[c, t] / context[c] + w[1] * one[t] / total + w[2] / (len(one) + 1) for t in vocabulary) + w[2] / (len(one) + 1)
        assert math.isclose(mass, 1, rel_tol=1e-9)


def test_lm_block_keys_and_runs():
    block = lm.Block(pa.array(["a b A", "", "b"]))
    assert block.size.tolist() == [4, 1, 2] and len(block.word) == len(block.pair) == len(block.context) == 7
    assert block.counts[block.word].tolist() == [2, 2, 2, 3, 3, 2, 3]
    values = np.array([3, 1 << 40, 7], np.uint64)
    assert (lm._unplanes(lm._planes(values), np.uint64) == values).all()


def test_lm_without_documents_or_training(spark):
    assert lm.score(docs(spark, []), F.lit(False)).isEmpty()
    got = lm.score(docs(spark, [(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert {r.train_tokens for r in got} == {0} and all(r.n_known == 0 for r in got)


def test_mixture_finds_the_better_estimate():
    rng = np.random.default_rng(0)
    good = lm.mixture(np.full(200, 4), np.ones(200), rng.uniform(0.3, 0.6, 200), np.full(200, 0.01), 1e-6)
    assert good[4, 0] > 0.9


def _auc(rows, labels):
    pairs = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    ones, zeros = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


def test_quality_held_out(spark):
    got = QUERIES["op9_quality_classifier"](spark, SF01).collect()
    labels = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect()}
    assert len(got) == 1000 and _auc(got, labels) > 0.95
    assert not [r for r in got if r.predicted == 0 and labels.get(r.doc_id) == 1][3:]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_machine_pairs_equal_brute_force():
    rng = np.random.default_rng(3)
    machine = quality_fm.Machine()
    machine.w = rng.normal(size=machine.w.shape).astype(np.float32)
    doc, place, value = np.array([0, 0, 0, 1, 1]), np.array([3, 9, 20, 9, 77]), rng.normal(size=5)
    got = machine.raw(doc, place, value, 3)[0]
    for d in range(3):
        at = np.flatnonzero(doc == d)
        pairs = sum(machine.v[place[i]] @ machine.v[place[j]] * value[i] * value[j] for i in at for j in at if i < j)
        assert math.isclose(got[d], machine.w0 + (machine.w[place[at]] * value[at]).sum() + pairs, rel_tol=1e-5, abs_tol=1e-6)


def test_machine_learns_a_pair():
    rng = np.random.default_rng(5)
    label = rng.integers(0, 2, 600)
    a = rng.integers(0, 2, 600)
    place = np.stack([10 + a, 20 + (a ^ label)], axis=1).ravel()  # only both together tell the label
    machine = quality_fm.Machine()
    doc = np.repeat(np.arange(600), 2)
    machine.fit(doc, place, np.ones(1200), label, 40, 1)
    assert ((machine.raw(doc, place, np.ones(1200), 600)[0] > 0) == label).mean() > 0.95


def test_quality_on_odd_rows(spark):
    labels = spark.createDataFrame([(2, 0), (4, 1), (5, 1), (5, 0), (6, None), (7, 2)], "doc_id long, quality int")
    frame = docs(spark, odd_rows()).withColumn("score", F.lit("clash")).withColumn("n_chars", F.lit(None).cast("long"))
    machine = quality_fm.learn(frame, labels)
    got = quality_fm.score(frame, machine, [frame["doc_id"]]).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert quality_fm.score(frame.limit(0), quality_fm.learn(frame.limit(0), labels.limit(0)), [frame["doc_id"]]).isEmpty()
    assert quality_fm.score(frame, quality_fm.Machine(), [frame["doc_id"]]).filter("score is null").isEmpty()


@pytest.mark.parametrize("step", [50, 20_000])
def test_block_max_search_equals_a_full_scan(monkeypatch, step):
    monkeypatch.setattr(toxicity, "STEP", step)
    rng = random.Random(6)
    vectors = []
    for _ in range(700):  # terms from 0 on are frequent, those up to 400 rare
        v = {int(400 * rng.random() ** 3): rng.random() for _ in range(rng.randint(1, 40))}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / norm for t, x in sorted(v.items())})
    used = {t: i for i, t in enumerate(sorted({t for v in vectors for t in v}))}
    vectors = [{used[t]: x for t, x in v.items()} for v in vectors]
    flat = np.array([(t, x) for v in vectors for t, x in v.items()])
    index = toxicity.BlockMaxIndex(np.arange(700) % 2, np.arange(700) % 5, np.array([len(v) for v in vectors]), flat[:, 0].astype(np.int64), flat[:, 1], len(used))
    assert 0 < len(index.often) < len(used)
    for number, q in enumerate([*vectors[:60], {0: 1.0}, {len(used) - 1: 0.6, 3: 0.8}]):
        for but in (-1, int(index.place[number])):
            got, cosine = index.search(np.array(list(q)), np.array(list(q.values())), but=but)
            full = sorted(((-round(sum(w * v.get(t, 0) for t, w in q.items()), 12), i) for i, v in enumerate(vectors) if index.place[i] != but))
            full = [(s, i) for s, i in full if s < 0][: toxicity.NEAREST]
            assert index.ids[got].tolist() == [i for _, i in full] and np.allclose(cosine, [-s for s, _ in full])


def _toxic_rows(spark, sf):
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    return [(r.doc_id, r.text or "", labels.get(r.doc_id)) for r in table(spark, sf, "documents").collect()]


def test_toxicity_query_equals_brute_force(spark, sf):
    rows = _toxic_rows(spark, sf)
    unseen = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    by_text = {}
    for i, text, y in rows:
        if y is not None and not unseen(i):
            by_text.setdefault(text, []).append((i, y))
    examples = sorted((min(v)[0], v[0][1], toxicity.term_counts(t), t) for t, v in by_text.items() if len({y for _, y in v}) == 1)
    n, positive = len(examples), sum(y for _, y, *_ in examples)
    df = Counter(t for *_, c, _ in examples for t in c)

    def part(text):
        return hashlib.sha256(text.encode()).digest()[0] % toxicity.FOLDS

    def vote_by(seen):
        """Votes under term weights that learn from the labels of ``seen``."""
        total, bad = len(seen), sum(y for _, y, *_ in seen)
        among = Counter(t for *_, c, _ in seen for t in c)
        hits = Counter(t for _, y, c, _ in seen if y for t in c)

        def gain(t):
            k, h = among[t], hits[t]
            cells = [(h, k * bad / total), (k - h, k * (total - bad) / total), (bad - h, (total - k) * bad / total), (total - bad - k + h, (total - k) * (total - bad) / total)]
            more = 0
            if sum(2 * o * math.log(o / e) for o, e in cells if o) > toxicity.CHANCE:
                p = bad / total
                q = (h + p) / (k + 1)
                more = toxicity.LEAN * (q * math.log(q / p) + (1 - q) * math.log((1 - q) / (1 - p))) / max(-math.log(p), -math.log(1 - p))
            return math.log((n + 1) / (df[t] + 0.5)) * (1 + more)

        def vector(c):
            v = {t: (1 + math.log(k)) * gain(t) for t, k in c.items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            return {t: x / norm for t, x in v.items()}

        known = [(i, y, vector(c), t) for i, y, c, t in examples]

        def vote(text):
            q = vector(toxicity.term_counts(text))
            near = sorted((-round(sum(x * v.get(t, 0) for t, x in q.items()), 12), i, y) for i, y, v, t in known if t != text)
            near = [x for x in near if x[0] < 0][: toxicity.NEAREST]
            top, below = sum(-s * y for s, _, y in near) + toxicity.SHRINK * positive / n, sum(-s for s, *_ in near) + toxicity.SHRINK
            return top / below, [i for _, i, _ in near]

        return vote

    others = [vote_by([x for x in examples if part(x[3]) != k]) for k in range(toxicity.FOLDS)]
    curve = toxicity.isotonic(np.array([others[part(t)](t)[0] for *_, t in examples]), np.array([y for _, y, *_ in examples]), positive / n)
    vote = vote_by(examples)
    got = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, sf).collect()}
    for i, text, _ in rows:
        score, ids = vote(text)
        assert got[i].evidence == ids and math.isclose(got[i].score, np.interp(score, *curve), abs_tol=1e-9)
        assert got[i].held_out == unseen(i) and got[i].predicted == int(got[i].score >= 0.5)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    frame = table(spark, sf, "documents").join(labels.select("doc_id", "toxic"), "doc_id")
    voters = toxicity.learn(frame.filter(fold("doc_id", 5) != 0), labels)
    unseen = frame.filter(fold("doc_id", 5) == 0)
    got = toxicity.score(unseen, voters, [F.col("doc_id"), F.col("toxic")]).select("row.*", "score", F.lit(True).alias("held_out")).collect()
    assert _auc(got, {r.doc_id: r.toxic for r in got}) > 0.95
    parts = [[r for r in got if int(min(r.score, 0.999) * 10) == k] for k in range(10)]
    error = sum(abs(sum(r.score - r.toxic for r in part)) for part in parts) / len(got)
    assert error < 0.03


def test_weights_of_terms_are_bounded_whatever_the_sample():
    for times in (1, 10, 1000):
        n, hits = np.array([1, 50, 50, 50, 20]) * times, np.array([1, 50, 5, 0, 10]) * times
        got = toxicity.lean(n, hits, 500 * times, 50 * times)
        assert (got >= 1).all() and (got <= 1 + toxicity.LEAN).all()
        assert got[1] > 9 and got[2] == 1 and got[1] > got[4] > 1 and got[3] < 2
    assert (toxicity.lean(np.array([3]), np.array([0]), 9, 3) == 1).all()


def test_isotonic_curve_rises_and_keeps_the_mean():
    rng = np.random.default_rng(1)
    score = rng.random(4000)
    label = (rng.random(4000) < score**2).astype(float)
    x, y = toxicity.isotonic(score, label, label.mean())
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all() and abs(np.interp(score, x, y).mean() - label.mean()) < 0.01
    assert abs(np.interp(0.7, x, y) - 0.49) < 0.06


def test_toxicity_learns_words_and_beginnings(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        bad = i % 9 == 0
        text = prose(rng, rng.randint(20, 80)) + (f" vileword {'scumbag' + rng.choice('abcdefgh') * 2} nasty" if bad else "")
        rows.append((i, text))
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(900)], "doc_id long, toxic int")
    frame = docs(spark, rows)
    voters = toxicity.learn(frame.filter(fold("doc_id", 5) != 0), labels)
    got = toxicity.score(frame, voters, [frame["doc_id"]]).select("row.*", "score", "evidence").collect()
    assert all((r.score >= 0.5) == (r.doc_id % 9 == 0) for r in got)
    assert all(r.evidence for r in got if r.doc_id % 9 == 0)
    new = docs(spark, [*odd_rows(), (70, "a scumbagzz"), (71, "fine weather")])
    found = {r.row.doc_id: r.score for r in toxicity.score(new, voters, [new["doc_id"]]).collect()}
    assert found[70] >= 0.5 > found[71] and found[1] == found[2] < 0.5
    assert toxicity.score(docs(spark, []), voters, [F.col("doc_id")]).isEmpty()
    nobody = toxicity.learn(docs(spark, []), labels)
    assert toxicity.score(new, nobody, [new["doc_id"]]).filter("score <> 0").isEmpty()
