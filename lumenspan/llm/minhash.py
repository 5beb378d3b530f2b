"""MinHash near-dedup with DartMinHash signatures.

A text is the bag of its 5-word shingles (of lower-case words; a shorter text is one shingle), each weighing as much as it
occurs. Darts are thrown by hash into the region of each element, whose width is its weight and whose other axis is time; each dart
carries a coordinate, and the earliest dart of a coordinate is its value. Two bags agree in a coordinate with the probability
of their weighted Jaccard similarity, the sum of least weights over that of greatest ones. All coordinates fill after about
``K ln K + 2 K`` darts, whatever the size of the bag.

Texts with equal bags, by a digest of 128 bits, are one node. Bands of ``ROWS`` coordinates deal nodes into buckets; links are
only taken from pairs whose exact similarity is at least ``SIMILARITY``. A node is first compared with one leader, of its buckets' members the
one that meets most others: the middle of a group of near copies. Components of the links found so far tell which buckets still hold several; there
members outside the largest component are compared with the middle of it, and components are formed again. In small buckets that hold several even
then all members of different components are compared. The members of large ones are compared with the bucket's middle and meet by
the elements in which they differ from it, rarest first: what two near copies have in common with it makes no pairs, and two that are as similar
as asked for either share a difference or are both linked to it. So no link within a bucket is lost and no bucket is cut.

Defined results: null and empty texts are equal and form one class; very long texts are read whole; ids may repeat, and so may
rows; the row with the least id (null last, of equal ids the first read) stands for its class; an empty table gives an empty
result; extra columns pass through ``near_dedup`` untouched, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import discard, packed_row, row_schema, written
from lumenspan.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 6
SMALL = 16  # members of a bucket up to which all of different components are compared

_FIRST = -2  # the first cell of time is [0, 2**_FIRST), each next one ends at twice the time


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _add(x: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return x + np.asarray(n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


_CUMULATIVE: dict[float, np.ndarray] = {}


def _poisson(mean: float) -> np.ndarray:
    """Cumulative probabilities of a Poisson count."""
    if mean in _CUMULATIVE:
        return _CUMULATIVE[mean]
    n = np.arange(int(mean + 12 * math.sqrt(mean) + 12))
    return _CUMULATIVE.setdefault(mean, np.cumsum(np.exp(n * math.log(mean) - mean - np.array([math.lgamma(k + 1) for k in n]))))


def _nth(units: np.ndarray) -> np.ndarray:
    """0, 1, 2 and so on for the units of every element."""
    return np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)


def occurrences(elements: np.ndarray, units: np.ndarray) -> np.ndarray:
    """An element for each unit of weight: the first is the element itself. Their sets are as similar as the weighted bags."""
    if (units == 1).all():
        return elements
    nth = _nth(units)
    each = np.repeat(elements, units)
    return np.where(nth == 0, each, _mix(_add(each, nth)))


def dart_signature(elements: np.ndarray, weights: np.ndarray | None = None, k: int = BANDS * ROWS) -> np.ndarray:
    """The identity of the earliest dart in each of ``k`` coordinates; elements are distinct 64-bit hashes.

    A weight is the width of an element's region: whole units throw their own darts, and of the last unit's darts
    those count that land inside.
    """
    if not len(elements):
        return np.zeros(k, np.uint64)
    unit, room = elements, None
    if weights is not None:
        units = np.maximum(np.ceil(weights), 1).astype(np.int64)
        unit = occurrences(elements, units)
        if (units != weights).any():
            room = np.repeat(weights, units) - _nth(units)
    best, value = np.full(k, np.inf), np.zeros(k, np.uint64)
    cell = 0
    while np.isinf(best).any():
        begin, end = (0.0, 2.0**_FIRST) if cell == 0 else (2.0 ** (_FIRST + cell - 1), 2.0 ** (_FIRST + cell))
        seed = _mix(_add(unit, cell + 7))
        counts = np.searchsorted(_poisson(end - begin), _unit(seed))
        owner = np.repeat(np.arange(len(unit)), counts)
        if len(owner):
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            dart = _mix(_add(seed[owner], nth + 1))
            time = begin + (end - begin) * _unit(_mix(_add(dart, 1)))
            coordinate = (_mix(_add(dart, 2)) % np.uint64(k)).astype(np.int64)
            inside = slice(None) if room is None else _unit(_mix(_add(dart, 3))) < room[owner]
            dart, time, coordinate = dart[inside], time[inside], coordinate[inside]
            order = np.lexsort((dart, time))[::-1]
            fresh = np.full(k, -1)
            fresh[coordinate[order]] = order  # the earliest is written last
            hit = np.flatnonzero((fresh >= 0) & np.isinf(best))
            best[hit], value[hit] = time[fresh[hit]], dart[fresh[hit]]
        cell += 1
    return value


def shingle_bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct shingle hashes of each text, sorted, and how often each occurs; none for a text without words."""
    words = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    flat, owner = pc.list_flatten(words), pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
    real = pc.not_equal(flat, "")
    owner, coded = owner[real.to_numpy(zero_copy_only=False)], flat.filter(real).dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = (pd.util.hash_array(np.array(names, dtype=object), categorize=False) if names else np.empty(0, np.uint64))[coded.indices.to_numpy(zero_copy_only=False)]
    size = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(size)
    grams = np.zeros(max(len(hashes) - SHINGLE + 1, 0), np.uint64)
    for i in range(SHINGLE):
        grams = _mix(_add(grams, 1) ^ hashes[i : i + len(grams)])
    out = []
    for end, n in zip(ends, size):
        if n >= SHINGLE:
            out.append(np.unique(grams[end - n : end - SHINGLE + 1], return_counts=True))
        else:
            short = np.uint64(0)
            for h in hashes[end - n : end]:
                short = _mix(_add(np.array([short], np.uint64), 2) ^ h)[0]
            out.append((np.array([short] * int(n > 0), np.uint64), np.ones(int(n > 0), np.int64)))
    return out


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The occurrences of shingles of each text, sorted and distinct."""
    return [np.sort(occurrences(*bag)) for bag in shingle_bags(texts)]


def _signed(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """row (the columns ``keep``), packed text, node (digest of the bag) and bands of every document, with a row number."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                bags = shingle_bags(part.column("text"))
                nodes = pa.array([xxhash.xxh3_128_digest(e.tobytes() + n.tobytes()) for e, n in bags], pa.binary())
                bands = np.concatenate([_bands(*bag) for bag in bags]) if bags else np.empty(0, np.int64)
                counts = np.where([len(e) > 0 for e, _ in bags], BANDS, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(bands))
                packed = [None if t is None else packer.compress(t.encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(packed, pa.binary()), nodes, lists], ["row", "packed", "node", "bands"])

    rows = docs.select(packed_row(docs, keep), docs[text_col].alias("text"))
    out = rows.mapInArrow(signed, row_schema(rows, "row", more="packed binary, node binary, bands array<bigint>"))
    return out.withColumn("uid", F.monotonically_increasing_id())


def _bands(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    if not len(elements):
        return np.empty(0, np.int64)
    rows = dart_signature(elements, weights).reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1).astype(np.uint64)
    for i in range(ROWS):
        keys = _mix(_add(keys, 1) ^ rows[:, i])
    return keys.astype(np.int64)


def unpack(packed: DataFrame, text_col: str) -> DataFrame:
    """(row, text) from (row, packed)."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = [None if t is None else reader.decompress(t).decode() for t in batch.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", text_col])

    return packed.select("row", "packed").mapInArrow(unpacked, row_schema(packed, "row", more=f"{text_col} string"))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Of the pairs (a, b) of nodes those whose shingle bags are at least as similar; ``texts``: node, packed."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                known: dict[bytes, np.ndarray] = {}
                both = [part.column(c).to_pylist() for c in ("ta", "tb")]
                new = list(dict.fromkeys(both[0] + both[1]))
                known = dict(zip(new, shingle_sets(pa.array([reader.decompress(t).decode() for t in new], pa.string()))))
                common = np.array([len(np.intersect1d(known[x], known[y], assume_unique=True)) for x, y in zip(*both)])
                total = np.array([len(known[x]) + len(known[y]) for x, y in zip(*both)]) - common
                keep = pa.array(common >= similarity * total)
                yield part.select(["a", "b"]).filter(keep)

    left = texts.select(F.col("node").alias("a"), F.col("packed").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("packed").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(compared, "a binary, b binary")


#: Fixed size of the sketch of how often elements occur.
SLOTS = 1 << 20


def _ranks(nodes: DataFrame) -> np.ndarray:
    """A sketch of in how many differences elements occur, in eighths of octaves by slot; ``nodes`` as for ``_differences``.

    Its size is fixed, and any ranks give the same links: they only say which elements are looked at first.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, differences, _ in _differences(batch):
                total += np.bincount((differences % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["slot", "n"])

    found = nodes.select("packed", "ref", "base").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    ranks = np.zeros(SLOTS, np.uint8)
    ranks[found["slot"].to_numpy()] = np.minimum(8 * np.log2(found["n"].to_numpy()), 255)
    return ranks


def _differences(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each row (packed, ref, base) the set of the text, what only one of it and the set of the base has, and the size of the latter.

    Differences from one ref are told apart from those from another; without a base they are the set itself.
    """
    reader = zstandard.ZstdDecompressor()
    for start in range(0, len(batch), 200):
        packed, refs, bases = (batch.column(c).slice(start, 200).to_pylist() for c in ("packed", "ref", "base"))
        new = list(dict.fromkeys(t for t in packed + bases if t is not None))
        known = dict(zip(new, shingle_sets(pa.array([reader.decompress(t).decode() for t in new], pa.string()))))
        for text, ref, base in zip(packed, refs, bases):
            if base is None:
                yield known[text], known[text], 0
            else:
                apart = np.setxor1d(known[text], known[base], assume_unique=True)
                yield known[text], _mix(_add(apart ^ np.uint64(xxhash.xxh3_64_intdigest(ref)), 4)), len(known[base])


#: 64-bit numbers of the parities of a set.
PARITIES = 8


def parities(elements: np.ndarray) -> np.ndarray:
    """For each of ``64 * PARITIES`` classes of elements whether the set has an odd number of them; two sets differ in at least as many elements as in classes."""
    odd = np.bincount((_mix(_add(elements, 3)) % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different labels that may be similar enough; ``nodes``: node, label, packed, and where rows are to be seen from a
    node near them, ref and base (that node and its packed text). Rows of one ref meet, and a node may have several.

    Two bags of sizes n and m are as similar as ``SIMILARITY`` if they differ in at most (n + m) / 9 occurrences. If they differ from the base in c
    and d, they then share at least half of (c - n / 9) + (d - m / 9) of these differences: the mean of what each has in *excess*. So in any order of all
    differences one of the first of either is common, where as many as have to be shared are still to come. Rare ones are first; what a group of near
    copies has in common is no difference, and one without a base differs in all it has. Where the mean is not above 0, no difference need be
    shared and the pair is not returned: then both are as similar as asked for to the base, for n is at most the base's size and c.

    So is a pair left out whose parities differ in more classes than elements may.
    """
    if "ref" not in nodes.columns:
        nodes = nodes.withColumns({c: F.lit(None).cast("binary") for c in ("ref", "base")})
    may = (1 - SIMILARITY) / (1 + SIMILARITY)
    ranks = _ranks(nodes)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], [], []]
            classes = []
            for i, (elements, differences, base) in enumerate(_differences(batch)):
                n, d = len(elements), len(differences)
                excess = d - may * n
                order = np.lexsort((differences, ranks[(differences % np.uint64(SLOTS)).astype(np.int64)]))
                # the least to be shared with one of no less excess, and with any
                with_more = max(math.ceil(excess - 1e-6), 1)
                with_any = max(math.ceil(excess - may / SIMILARITY * n - 1e-6), math.ceil(SIMILARITY * n - base - 1e-6), 1)
                at = np.arange(max(d - with_any + 1, 0))
                classes.append(parities(elements))
                for c, v in zip(columns, (differences[order[: len(at)]].view(np.int64), np.full(len(at), i), np.full(len(at), n), np.full(len(at), excess), d - at, at <= d - with_more)):
                    c.append(v)
            element, own, size, excess, rest, lead = (np.concatenate(c) if c else np.empty(0, np.int64) for c in columns)
            own = pa.array(own, pa.int64())
            odd = pa.ListArray.from_arrays(pa.array(np.arange(len(classes) + 1) * PARITIES, pa.int32()), pa.array(np.concatenate(classes) if classes else np.empty(0, np.int64), pa.int64())).take(own)
            yield pa.RecordBatch.from_arrays([pa.array(element, pa.int64()), batch.column("node").take(own), batch.column("label").take(own), pa.array(size, pa.int64()), pa.array(excess, pa.float64()), pa.array(rest, pa.int64()), pa.array(lead, pa.bool_()), odd], ["element", "node", "label", "size", "excess", "rest", "lead", "odd"])

    rows = written(nodes.select("node", "label", "packed", "ref", "base").mapInArrow(first, "element long, node binary, label binary, size long, excess double, rest long, lead boolean, odd array<bigint>"), "minhash-prefixes")
    # elements of one node alone meet nothing
    shared = rows.groupBy("element").agg(F.min("label").alias("one"), F.max("label").alias("two")).filter("one <> two").select("element")
    met = written(rows.join(shared, "element"), "minhash-meeting")
    less, more = met.filter("lead").alias("x"), met.alias("y")
    apart = " + ".join(f"bit_count(x.odd[{i}] ^ y.odd[{i}])" for i in range(PARITIES))
    condition = f"x.element = y.element AND x.label <> y.label AND (x.excess < y.excess OR x.excess = y.excess AND x.node < y.node) AND least(x.size, y.size) >= {SIMILARITY!r}D * greatest(x.size, y.size) - 1e-6D AND 2 * least(x.rest, y.rest) >= x.excess + y.excess - 1e-6D AND {apart} <= {may!r}D * (x.size + y.size) + 1e-6D"
    pairs = written(less.join(more, F.expr(condition)).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "minhash-pairs")
    discard(rows, met)
    return pairs


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several components: key, n, node, meets, label and main: meets, node and label of the member that
    meets most in the component of most members."""
    known = members.join(labels, "node", "left").select("key", "n", "node", "meets", F.coalesce("label", "node").alias("label"))
    sizes = known.groupBy("key", "label").agg(F.count("*").alias("of"), F.max(F.struct("meets", "node")).alias("middle"))
    parts = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("of", "middle", "label")).alias("most"))
    several = parts.filter("parts > 1").select("key", F.struct("most.middle.meets", "most.middle.node", "most.label").alias("main"))
    return written(known.join(several, "key"), "minhash-open")


def _labels(signed: DataFrame) -> DataFrame:
    """(node, label) of all nodes that have a link to another."""
    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"))
    dealt = written(nodes.select("node", F.explode("bands").alias("key")), "minhash-bands")
    shared = dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    meeting = written(dealt.join(shared, "key"), "minhash-buckets")
    members = written(meeting.join(meeting.groupBy("node").agg(F.sum("n").alias("meets")), "node"), "minhash-members")
    involved = members.select("node").distinct()
    texts = written(signed.select("node", "packed").join(involved, "node").groupBy("node").agg(F.first("packed").alias("packed")), "minhash-texts")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct()

    # what meets most is the middle of its class, so that one pair a node links most of what will be linked
    leaders = members.groupBy("key").agg(F.max(F.struct("meets", "node")).alias("leader"))
    led = members.select("key", "node").join(leaders, "key").groupBy("node").agg(F.max("leader").alias("leader"))
    led_pairs = written(ordered(led.select(F.col("leader.node").alias("x"), F.col("node").alias("y"))), "minhash-pairs")
    led_links = written(verified(led_pairs, texts), "minhash-links")
    first = components(led_links)
    rest = _open(members, first)
    strays = ordered(rest.filter("label <> main.label").select(F.col("main.node").alias("x"), F.col("node").alias("y")))
    stray_pairs = written(strays.join(led_pairs, ["a", "b"], "left_anti"), "minhash-pairs")
    stray_links = written(verified(stray_pairs, texts), "minhash-links")
    links = led_links.union(stray_links)
    second = components(links)
    last = _open(members, second)

    one, two = last.filter(f"n <= {SMALL}").alias("one"), last.filter(f"n <= {SMALL}").alias("two")
    small = one.join(two, F.expr("one.key = two.key and one.node < two.node and one.label <> two.label")).select(F.col("one.node").alias("x"), F.col("two.node").alias("y"))
    pairs = written(ordered(small).join(led_pairs.union(stray_pairs), ["a", "b"], "left_anti"), "minhash-pairs")
    # a middle's own best middle serves all that its bucket holds, so that a group is seen from few
    seen = last.filter(f"n > {SMALL}").select("node", "label", "main").distinct()
    best = seen.groupBy(F.col("node").alias("from")).agg(F.max("main").alias("to"))
    seen = seen.join(best, F.col("main.node") == F.col("from")).select("node", "label", F.col("to.node").alias("ref"), F.col("to.label").alias("ref_label")).distinct()
    bases = texts.select(F.col("node").alias("ref"), F.col("packed").alias("base"))
    large = written(seen.join(texts, "node").join(bases, "ref"), "minhash-crossed")
    met = prefix_pairs(large)
    middle = ordered(large.filter("label <> ref_label").select(F.col("ref").alias("x"), F.col("node").alias("y")))
    found = written(verified(pairs.union(met.union(middle).distinct().join(led_pairs.union(stray_pairs).union(pairs), ["a", "b"], "left_anti")), texts), "minhash-links")
    labels = second if found.isEmpty() else components(links.union(found))
    discard(dealt, meeting, members, texts, led_pairs, led_links, first, rest, stray_pairs, stray_links, last, pairs, large, met, found)
    if labels is not second:
        discard(second)
    return labels


def _classed(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """The signed rows with their class, and the classes of several rows: label, first (the row that stands for it), size."""
    signed = written(_signed(docs, text_col, keep), "minhash-rows")
    labels = _labels(signed)
    rows = signed.select("uid", F.col("row")[id_col].alias("id"), "node").join(labels, "node", "left").select("uid", "id", F.coalesce("label", "node").alias("label"))
    rows = written(rows, "minhash-labels")
    classes = rows.groupBy("label").agg(F.min(F.struct(F.col("id").isNull(), "id", "uid")).alias("first"), F.count("*").alias("size")).filter("size > 1")
    # a table of its own, so that the join is free to split the rows of a large class
    return signed, rows.join(written(classes, "minhash-classes"), "label", "left")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, class_id (the least id of its class), class_size and kept."""
    _, rows = _classed(docs, id_col, text_col, [id_col])
    return rows.select(
        F.col("id").alias(id_col),
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("class_size"),
        F.coalesce(F.col("first.uid") == F.col("uid"), F.lit(True)).alias("kept"),
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stand for their class, with the columns of ``docs``."""
    others = [c for c in docs.columns if c != text_col]
    signed, rows = _classed(docs, id_col, text_col, others)
    gone = rows.filter(F.col("first.uid") != F.col("uid")).select("uid")
    kept = unpack(signed.join(gone, "uid", "left_anti"), "_text")
    return kept.select(*[F.col("_text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
