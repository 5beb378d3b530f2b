"""Quality rules with risk-controlled thresholds.

Each rule compares one figure of a text with a cutoff. A cutoff is allowed for a stratum only if the exact binomial
bound on labelled holdouts says that it rejects at most ``ALPHA / rules`` of good texts, at a confidence that
Bonferroni's correction shares among all rules and strata. Along one rule's grid stricter cutoffs reject more, so their
p-values only grow: testing stops at the first failure and needs no further correction. Of the allowed cutoffs the
strictest counts that also rejects bad texts at ``LIFT`` times the rate of good ones, or none. A union over the rules
then rejects at most ``ALPHA`` of a stratum's good texts, with confidence ``1 - DELTA``.

A stratum is a language with enough good labels to allow a cutoff that rejects none of them; all other labelled languages
are pooled into one more stratum, which the correction counts, and share its cutoffs. Which languages are pooled depends on their
number of good labels alone, not on what the rules say of them.

All of it is DataFrame work: the figures come from higher-order functions within a row, the binomial tail from an
aggregate over at most ``alpha * n`` terms, and only sums by language are joined back.

Defined results: null or empty text has no words and fails the base rule; very long texts are read whole; a null language is a
language of its own, apart from an empty one; a language without labels gets no cutoff, so the base rule alone decides;
documents labelled more than once count as good only if all their labels say so; labels on a null id are left out; repeated rows
are judged alike, and each counts where its id is labelled; other columns are not read, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import SPACE, WORD, join_small, whole, written

ALPHA = 0.02
DELTA = 0.05
LIFT = 5
#: name, figure, sign (1: more is worse), cutoffs from lenient to strict.
RULES = [
    ("symbols", "100D * n_symbols / n_words", 1, [300.0, 200.0, 150.0, 100.0, 75.0, 50.0, 30.0, 20.0, 10.0]),
    ("repeats", "100D * n_repeat_words / n_words", 1, [45.0, 40.0, 35.0, 30.0, 25.0, 20.0, 15.0, 10.0]),
    ("lines", "100D * n_dup_lines / n_lines", 1, [80.0, 60.0, 50.0, 40.0, 30.0, 20.0, 10.0]),
    ("long_words", "1D * word_chars / n_words", 1, [20.0, 15.0, 12.0, 10.0, 9.0, 8.0]),
    ("short_words", "1D * word_chars / n_words", -1, [1.0, 1.5, 2.0, 2.5, 3.0]),
]
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the text has twice or more.

    The windows are sorted with their places; equal neighbours mark repeats; the places they cover are counted once.
    Lambda variables hold each array, so that none is computed again for every element.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.struct(F.concat_ws(" ", F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("w"), i.alias("i")),
    )

    def covered(s: Column) -> Column:
        again = F.filter(s, lambda x, k: (x["w"] == F.get(s, k - 1)["w"]) | (x["w"] == F.get(s, k + 1)["w"]))
        return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return F.when(F.size(words) < 3, 0).otherwise(F.get(F.transform(F.array(F.array_sort(windows)), covered), 0))


def figures(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` and the figures of each text."""
    text = whole(docs[text_col])
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    rows = docs.select(*keep, text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    return rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_text", r"[^#*$%&|<>]", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rejects(figure: Column, sign: int, cutoff: Column | float) -> Column:
    return figure > cutoff if sign > 0 else figure < cutoff


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, rate), summed exactly in logarithms; 1 if k is not under the mean."""
    first = F.log1p(F.lit(-rate)) * n
    odds = F.log(F.lit(rate / (1 - rate)))

    def step(acc: Column, i: Column) -> Column:
        lp = acc["lp"] + odds + F.log((n - i + 1) / i)
        top, low = F.greatest(acc["lc"], lp), F.least(acc["lc"], lp)
        return F.struct(lp.alias("lp"), (top + F.log1p(F.exp(low - top))).alias("lc"))

    start = F.struct(first.alias("lp"), first.alias("lc"))
    total = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), start, step, lambda acc: F.exp(acc["lc"]))
    return F.when(k >= n * F.lit(rate), F.lit(1.0)).otherwise(total)


def _grid() -> list[tuple[str, int, float, str, int]]:
    """(rule, strictness, cutoff, figure, sign) of every test."""
    return [(name, j, c, figure, sign) for name, figure, sign, grid in RULES for j, c in enumerate(grid)]


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA, lift: float = LIFT) -> DataFrame:
    """One row per labelled language with the cutoff of each rule, null where none is allowed.

    ``labelled``: language, good (boolean) and the figures of labelled holdouts that pass the base rule.
    """
    good, rate = F.col("good"), alpha / len(RULES)
    tallies = {"n_good": F.count_if(good), "n_bad": F.count_if(~good)}
    for name, j, c, figure, sign in _grid():
        for side, what in ((good, "good"), (~good, "bad")):
            tallies[f"{name}_{j}_{what}"] = F.count_if(side & rejects(F.expr(figure), sign, c))
    counts = written(labelled.groupBy("language").agg(*[c.alias(name) for name, c in tallies.items()]), "rule-counts")
    level = delta / len(RULES) / (counts.count() + 1)
    pooled = F.col("n_good") * F.log1p(F.lit(-rate)) > F.lit(math.log(level))
    strata = counts.withColumn("pooled", pooled).withColumn("stratum", F.when(~F.col("pooled"), F.col("language")))
    tests = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(j).alias("strictness"), F.lit(c).alias("cutoff"), F.col(f"{name}_{j}_good").alias("k"), F.col(f"{name}_{j}_bad").alias("hits")) for name, j, c, *_ in _grid()]))
    allowed = (
        strata.groupBy("pooled", "stratum")
        .agg(*[F.sum(name).alias(name) for name in tallies])
        .select("pooled", "stratum", "n_good", "n_bad", tests.alias("t"))
        .select("pooled", "stratum", "n_good", "n_bad", "t.*")
        .filter(F.col("hits") * F.col("n_good") > lift * F.col("k") * F.col("n_bad"))
        .filter(binomial_tail(F.col("n_good"), F.col("k"), rate) <= F.lit(level))
    )
    cuts = allowed.groupBy("pooled", "stratum").agg(*[F.max_by("cutoff", F.when(F.col("rule") == name, F.col("strictness"))).alias(f"cut_{name}") for name, *_ in RULES])
    own = strata.select("language", F.col("pooled").alias("_pooled"), F.col("stratum").alias("_stratum"))
    return own.join(cuts, own["_pooled"].eqNullSafe(cuts["pooled"]) & own["_stratum"].eqNullSafe(cuts["stratum"])).select("language", *[f"cut_{name}" for name, *_ in RULES])


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: id, the figures, base_failed, kept and the names of the rules that reject it."""
    named = docs.select(docs[id_col].alias("_id"), docs[language_col].alias("_language"), docs[text_col].alias("text"))
    rows = written(figures(named, "text", ["_id", "_language"]), "rule-figures")
    good = labels.groupBy(F.col("doc_id").alias("_id")).agg((F.min("quality") > 0).alias("good"))
    labelled = rows.filter(~base_failed()).join(good, "_id").filter("good is not null").withColumnRenamed("_language", "language")
    cuts = written(cutoffs(labelled, alpha, delta), "rule-cutoffs")
    hits = F.array_compact(F.array(*[F.when(~base_failed() & rejects(F.expr(figure), sign, F.col(f"cut_{name}")), F.lit(name)) for name, figure, sign, _ in RULES]))
    judged = join_small(rows, cuts, rows["_language"].eqNullSafe(cuts["language"]))
    return judged.select(
        F.col("_id").alias(id_col),
        *[c for c in FIGURES if c != "n_lines"],
        base_failed().alias("base_failed"),
        (~base_failed() & (F.size(hits) == 0)).alias("kept"),
        "n_lines",
        F.array_join(hits, ",").alias("rejected_by"),
    )


def rules_sql(alpha: float = ALPHA, delta: float = DELTA) -> str:
    """``apply_rules`` over documents and labels in DuckDB's SQL."""
    figure = {name: text.replace("100D", "100::DOUBLE").replace("1D", "1::DOUBLE") for name, text, *_ in RULES}
    tests = " UNION ALL ".join(
        f"SELECT lang, '{name}' AS rule, {j} AS strictness, {c}::DOUBLE AS cutoff, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS m,"
        f" count(*) FILTER (good AND {figure[name]} {'>' if sign > 0 else '<'} {c}) AS k, count(*) FILTER (NOT good AND {figure[name]} {'>' if sign > 0 else '<'} {c}) AS hits FROM l GROUP BY lang"
        for name, _, sign, grid in RULES
        for j, c in enumerate(grid)
    )
    rate, level = alpha / len(RULES), f"{delta / len(RULES)!r} / ((SELECT count(*) FROM s) + 1)"
    names = [name for name, *_ in RULES]
    cuts = ", ".join(f"max_by(cutoff, strictness) FILTER (rule = '{n}') AS cut_{n}" for n in names)
    bad = {name: f"coalesce(NOT base_failed AND {figure[name]} {'>' if sign > 0 else '<'} cut_{name}, false)" for name, _, sign, _ in RULES}
    return rf"""
WITH t AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM t)),
a AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM g) WHERE n > 1),
p AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM a, (VALUES (0), (1), (2)) o(j) GROUP BY doc_id),
f AS (
  SELECT t.doc_id, lang, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(p.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN p USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
l AS (
  SELECT b.*, good FROM b JOIN (SELECT doc_id, min(quality) > 0 AS good FROM labels GROUP BY doc_id) USING (doc_id)
  WHERE NOT base_failed AND good IS NOT NULL),
s AS (SELECT lang, count(*) FILTER (good) AS n FROM l GROUP BY lang),
z AS (SELECT lang, n * ln(1 - {rate!r}) > ln({level}) AS pooled FROM s),
e AS ({tests}),
o AS (
  SELECT pooled, CASE WHEN NOT pooled THEN e.lang END AS stratum, rule, strictness, cutoff, sum(n)::BIGINT AS n, sum(m)::BIGINT AS m, sum(k)::BIGINT AS k, sum(hits)::BIGINT AS hits
  FROM e JOIN z ON e.lang IS NOT DISTINCT FROM z.lang GROUP BY ALL),
q AS (
  SELECT *, CASE WHEN k >= n * {rate!r} THEN 1.0 ELSE
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate!r}) + (n - i) * ln(1 - {rate!r})))) END AS p
  FROM o),
d AS (SELECT pooled, stratum, {cuts} FROM q WHERE hits * n > {LIFT} * k * m AND p <= {level} GROUP BY pooled, stratum),
c AS (SELECT z.lang AS of, d.* FROM z JOIN d ON z.pooled = d.pooled AND CASE WHEN NOT z.pooled THEN z.lang END IS NOT DISTINCT FROM d.stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(bad.values())}) AS kept, n_lines,
       array_to_string(list_filter([{", ".join(f"CASE WHEN {v} THEN '{k}' END" for k, v in bad.items())}], lambda x: x IS NOT NULL), ',') AS rejected_by
FROM b LEFT JOIN c ON b.lang IS NOT DISTINCT FROM c.of
"""


RULES_SQL = rules_sql()
