"""Near-dedup and the pipeline against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from lumenspan.llm import components, exact_dedup, minhash, mixing, piece_codec, quality_fm
from lumenspan.llm._common import shared_dir, table
from lumenspan.llm.queries import KEEP_AT, QUERIES, tokenizer
from tests.llm.helpers import docs, odd_rows, prose


def _find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute_classes(rows):
    """Class id by (position), from all pairs of shingle bags: the nth occurrence of a shingle is an element of its own."""
    sets = []
    for r in rows:
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", (r[1] or "").lower()) if x]
        seen = Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()
        sets.append(frozenset((g, k) for g, n in seen.items() for k in range(n)))
    parent = list(range(len(rows)))
    by = {}
    for i, s in enumerate(sets):
        for j in {j for g in s for j in by.get(g, ())} | ({j for j in range(i) if not sets[j]} if not s else set()):
            both = len(s & sets[j])
            if both >= minhash.SIMILARITY * (len(s) + len(sets[j]) - both):
                parent[_find(parent, i)] = _find(parent, j)
        for g in s:
            by.setdefault(g, []).append(i)
    out = {}
    for i in range(len(rows)):
        out.setdefault(_find(parent, i), []).append(i)
    first = {k: min((rows[i][0] is None, rows[i][0] or 0) for i in v) for k, v in out.items()}
    return [(first[_find(parent, i)], len(out[_find(parent, i)])) for i in range(len(rows))]


def edited(rng, text, share):
    words = text.split()
    for i in rng.sample(range(len(words)), max(1, int(len(words) * share))):
        words[i] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("j", [0.2, 0.5, 0.8, 0.95])
def test_coordinates_agree_as_often_as_sets_are_similar(j):
    rng = np.random.default_rng(int(j * 100))
    common, rest = int(1000 * j), 1000 - int(1000 * j)
    pool = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    one, two = pool[: common + rest // 2], np.r_[pool[:common], pool[common + rest // 2 :]]
    agree = np.mean(minhash.dart_signature(one, k=6000) == minhash.dart_signature(two, k=6000))
    assert abs(agree - j) < 0.03


def test_weighted_coordinates_agree_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 40, dtype=np.uint64)
    a, b = rng.uniform(0.1, 5, 40), rng.uniform(0.1, 5, 40)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    got = np.mean(minhash.dart_signature(pool, a, 20_000) == minhash.dart_signature(pool, b, 20_000))
    assert abs(got - want) < 0.02


def test_signature_does_not_depend_on_order_and_fills_every_coordinate():
    pool = np.random.default_rng(2).integers(0, 2**63, 300, dtype=np.uint64)
    assert (minhash.dart_signature(pool) == minhash.dart_signature(pool[::-1].copy())).all()
    for n in (1, 2, 50_000):
        assert (minhash.dart_signature(np.arange(1, n + 1, dtype=np.uint64)) != 0).all()


def test_shingle_sets_equal_brute_force():
    texts = ["a b c d e f", "A  b\tC d E", "a b", "", None, "x x x x x x x"]
    sizes = [len(s) for s in minhash.shingle_sets(pa.array(texts, pa.string()))]
    assert sizes == [2, 1, 1, 0, 0, 3]


def test_whole_weights_are_occurrences():
    pool = np.random.default_rng(3).integers(0, 2**63, 50, dtype=np.uint64)
    weights = np.random.default_rng(4).integers(1, 9, 50)
    each = minhash.occurrences(pool, weights)
    assert len(np.unique(each)) == weights.sum() and (minhash.dart_signature(pool, weights) == minhash.dart_signature(each)).all()


def test_repeated_lines_weigh_as_often_as_they_occur(spark):
    rng = random.Random(14)
    line, own = prose(rng, 40), prose(rng, 60)
    rows = [(1, own + " " + line), (2, own + f" {line}" * 9), (3, own + f" {line}" * 10)]
    got = {r.doc_id: r.class_id for r in minhash.near_classes(docs(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 2} == {r[0]: f[1] for r, (f, _) in zip(rows, brute_classes(rows))}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 140)]
    got = components.components(spark.createDataFrame(chain + star + [(500, 400)], "a long, b long"))
    assert {(r.node, r.label) for r in got.collect()} == {(i, 0) for i in range(61)} | {(i, 100) for i in range(100, 140)} | {(400, 400), (500, 400)}


def test_classes_equal_brute_force(spark):
    rng = random.Random(11)
    rows, base = [], [prose(rng, rng.randint(60, 200)) for _ in range(12)]
    for i in range(160):
        rows.append((1000 + i, edited(rng, rng.choice(base), rng.choice([0.005, 0.02, 0.05])) if i % 3 else prose(rng, rng.randint(5, 100))))
    rows += [(2000 + i, base[0]) for i in range(30)] + odd_rows()
    got = minhash.near_classes(docs(spark, rows)).collect()
    want = brute_classes(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.class_id is None, r.class_id or 0, r.class_size) for r in got) == sorted((r[0] is None, r[0] or 0, *f, n) for r, (f, n) in zip(rows, want))
    assert sum(r.kept for r in got) == len({(r.class_id, r.class_size) for r in got})


def test_a_large_class_of_mutual_near_copies_is_whole(spark):
    rng = random.Random(12)
    base = prose(rng, 300)
    rows = [(i, edited(rng, base, 0.01)) for i in range(300)] + [(1000 + i, prose(rng, 80)) for i in range(20)]
    got = minhash.near_classes(docs(spark, rows)).collect()
    want = brute_classes(rows)
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == sorted((r[0], f[1], n) for r, (f, n) in zip(rows, want))


def test_links_among_strays_of_large_buckets_are_found(spark):
    rng = random.Random(13)
    base = prose(rng, 300).split()
    rows = []
    for at in range(0, 272, 4):  # two texts each lack the same words of the boilerplate: 0.81; others at most 0.79
        rows += [(2 * at + i, " ".join([*base[:at], *(f"new{rng.randint(0, 10**6)}" for _ in range(27)), *base[at + 27 :]])) for i in range(2)]
    want = [(r[0], f[1], n) for r, (f, n) in zip(rows, brute_classes(rows))]
    assert sum(n == 2 for *_, n in want) > 120
    got = minhash.near_classes(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == want


def test_texts_of_a_template_do_not_meet_by_it(spark):
    rng = random.Random(16)
    template = prose(rng, 300)
    rows = [(i, f"{template} {prose(rng, 60, [f'own{i}x{k}' for k in range(90)])}") for i in range(400)]
    rows += [(1000 + i, edited(rng, rows[i][1], 0.005)) for i in range(40)]
    packed = [(i.to_bytes(16, "big"), i.to_bytes(16, "big"), zstandard.compress(t.encode())) for i, t in rows]
    pairs = {tuple(int.from_bytes(x, "big") for x in r) for r in minhash.prefix_pairs(spark.createDataFrame(packed, "node binary, label binary, packed binary")).collect()}
    assert pairs == {(i, 1000 + i) for i in range(40)}
    got = minhash.near_classes(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == [(r[0], f[1], n) for r, (f, n) in zip(rows, brute_classes(rows))]


@pytest.mark.parametrize("words", [12, 60])
def test_prefixes_lose_no_link(spark, words):
    rng = random.Random(words)
    base = [prose(rng, words, [f"w{i}" for i in range(30)]) for _ in range(6)]
    texts = sorted({edited(rng, rng.choice(base), rng.choice([0.01, 0.03, 0.06])) + " z" * rng.randint(0, 6) for _ in range(150)})
    sets = [frozenset(s.tolist()) for s in minhash.shingle_sets(pa.array(texts))]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    packed = [(i.to_bytes(16, "big"), i.to_bytes(16, "big"), zstandard.compress(t.encode())) for i, t in enumerate(texts)]
    got = {tuple(int.from_bytes(x, "big") for x in r) for r in minhash.prefix_pairs(spark.createDataFrame(packed, "node binary, label binary, packed binary")).collect()}
    assert want and want <= got


def test_near_copies_of_one_template_become_few_pairs_beside_the_links(spark):
    rng = random.Random(16)
    template, texts = prose(rng, 150, [f"w{i}" for i in range(5000)]).split(), []
    for i in range(200):  # most of them are about 0.7 alike
        copy = list(template)
        for k in rng.sample(range(5, 145), rng.choice([1, 3, 3, 3])):
            copy[k] = f"own{i}x{k}"
        texts.append(" ".join(copy))
    sets = [frozenset(s.tolist()) for s in minhash.shingle_sets(pa.array(texts))]
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    packed = [(i.to_bytes(16, "big"), i.to_bytes(16, "big"), zstandard.compress(t.encode())) for i, t in enumerate(texts)]
    got = {tuple(int.from_bytes(x, "big") for x in r) for r in minhash.prefix_pairs(spark.createDataFrame(packed, "node binary, label binary, packed binary")).collect()}
    assert want and want <= got and len(got) < 2 * len(want) < 200 * 199 // 4


def copies(rng, n):
    """Near copies of one template, 1 to 14 words of 150 changed: about half are as similar as 0.8 to the template, few of the others to any."""
    template, out = prose(rng, 150, [f"w{i}" for i in range(5000)]).split(), []
    for i in range(n):
        copy = list(template)
        for k in rng.sample(range(150), rng.choice([1, 2, 3, 4, 6, 8, 11, 14])):
            copy[k] = f"v{rng.randint(0, 500)}"
        out.append(" ".join(copy))
    return [" ".join(template), *out]


def test_a_group_of_near_copies_makes_fewer_pairs_than_members(spark, monkeypatch):
    rows, met, pairs = list(enumerate(copies(random.Random(17), 800))), [], minhash.prefix_pairs

    def counted(nodes):
        found = pairs(nodes)
        met.append((nodes.select("node").distinct().count(), found.count()))
        return found

    monkeypatch.setattr(minhash, "prefix_pairs", counted)
    got = minhash.near_classes(docs(spark, rows)).collect()
    want = [(r[0], f[1], n) for r, (f, n) in zip(rows, brute_classes(rows))]
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == want and max(n for *_, n in want) > 200
    [(members, made)] = met
    assert members > 600 and made < members / 4


@pytest.mark.parametrize("base", [0, 40, 199])
def test_pairs_seen_from_a_base_lose_no_link(spark, base):
    rng = random.Random(base)
    texts = sorted({*copies(rng, 120), *(edited(rng, prose(rng, 9, ["a", "b", "c"]), 0.2) for _ in range(40)), *(edited(rng, t, 0.01) for t in copies(rng, 40))})
    sets = [frozenset(s.tolist()) for s in minhash.shingle_sets(pa.array(texts))]
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    key, packed = (lambda i: i.to_bytes(16, "big")), [zstandard.compress(t.encode()) for t in texts]
    rows = [(key(i), key(i), packed[i], key(r), packed[r]) for i in range(len(texts)) for r in (base, base // 2)]
    got = {tuple(int.from_bytes(x, "big") for x in r) for r in minhash.prefix_pairs(spark.createDataFrame(rows, "node binary, label binary, packed binary, ref binary, base binary")).collect()}
    links = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if sets[i] != sets[j] and alike(i, j)}
    left = links - got
    assert links & got and all(alike(i, r) and alike(j, r) for i, j in left for r in (base, base // 2))


def test_pairs_that_share_most_of_a_page_are_all_found(spark):
    rng = random.Random(15)
    page, rows = prose(rng, 400), []
    for i in range(150):  # every pair differs from the page in 5 words, and its two texts in 3 more each
        one = edited(rng, page, 5 / 400)
        rows += [(2 * i, edited(rng, one, 3 / 400)), (2 * i + 1, edited(rng, one, 3 / 400))]
    got = minhash.near_classes(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == [(r[0], f[1], n) for r, (f, n) in zip(rows, brute_classes(rows))]


def test_near_dedup_keeps_columns(spark):
    frame = docs(spark, odd_rows())
    got = minhash.near_dedup(frame)
    assert got.columns == frame.columns and got.select("doc_id", "text", "`odd.name`").exceptAll(frame.select("doc_id", "text", "`odd.name`")).isEmpty()
    assert got.count() == len({f for f, _ in brute_classes(odd_rows())})
    assert minhash.near_dedup(frame.limit(0)).isEmpty() and minhash.near_classes(frame.limit(0)).isEmpty()


def test_pipeline_equals_brute_force(spark, sf):
    import sentencepiece

    got = sorted((r.doc_id, r.n_tokens, tuple(r.ids)) for r in corpus_pipeline.run(spark, sf).collect())
    start = table(spark, sf, "documents")
    machine = quality_fm.learn(start, table(spark, sf, "labels"))
    scores = {r.row.doc_id: r.score for r in quality_fm.score(start, machine, [start["doc_id"]]).collect()}
    rows = {r.doc_id: r for r in start.collect() if scores[r.doc_id] >= KEEP_AT}
    groups = {}
    for r in rows.values():
        groups.setdefault("".join(r.text.split()), []).append(r)
    rows = {r.doc_id: r for r in (min(g, key=lambda r: (-len(r.text), r.doc_id)) for g in groups.values())}
    order = sorted(rows.values(), key=lambda r: r.doc_id)
    firsts = {f[1] for f, _ in brute_classes([(r.doc_id, r.text) for r in order])}
    rows = [r for r in order if r.doc_id in firsts]
    report = mixing.mix_report(spark.createDataFrame(rows, start.schema))
    taken = {r.doc_id: r.taken // r.size if r.size else 0 for r in report.collect()}
    library = sentencepiece.SentencePieceProcessor(model_proto=tokenizer("piece_bpe_32k.model"))
    want = []
    for r in rows:
        ids = tuple(library.encode(r.text, add_eos=True))
        want += [(r.doc_id, len(ids), ids)] * taken[r.doc_id]
    assert got == sorted(want)


def test_tokens_are_decoded(spark, sf):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=tokenizer("piece_bpe_32k.model"))
    got = corpus_pipeline.tokens(spark, docs(spark, [(1, "Some  plain words"), (2, None), (3, "déjà vu 漢字")]), sf).collect()
    assert len(got) == 3
    for r in got:
        assert r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(library.decode(r.ids).encode()).hexdigest()


def test_pipeline_stages_keep_clean_documents(spark, sf):
    start = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    kept = corpus_pipeline.quality(spark, start, sf)
    assert kept.columns == start.columns
    lost = start.join(kept.select("doc_id"), "doc_id", "left_anti").join(labels, "doc_id")
    assert lost.filter("quality = 1").count() <= 1
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, kept.limit(0), sf).isEmpty() and stage(spark, kept, sf).columns == start.columns


def test_pipeline_leaves_what_its_result_reads_and_no_more(spark, sf):
    import os

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, sf)
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {"pipeline-mixed"}
    assert got.count() > 0


def test_pipeline_on_odd_rows_and_none(spark, tmp_path):
    labels = spark.createDataFrame([(4, 1, 0), (6, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for name, rows in (("odd", odd_rows()), ("none", [])):
        folder = str(tmp_path / name)
        docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        classes = {f for f, _ in brute_classes(rows)} if rows else set()
        assert {r.doc_id for r in got} <= {r[0] for r in rows} and (not rows or 0 < len({r.doc_id for r in got}) <= len(classes))
        assert all(r.n_tokens == len(r.ids) for r in got)


def test_query_is_one_row_per_document(spark, sf):
    got = QUERIES["op1_minhash"](spark, sf)
    assert got.count() == table(spark, sf, "documents").count() == got.select("doc_id").distinct().count()
    assert got.filter("kept").select(F.countDistinct("class_id")).first()[0] == got.filter("kept").count()


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mixed", "tokens"]
    assert exact_dedup.CLASSES_SQL and piece_codec.CHUNK
