"""Suffix-array dedup: bytes in strings of ``LENGTH`` bytes that also start in an earlier document are removed.

Suffixes are sorted by linear grouping: all suffixes of a text first form groups by their first symbol, and groups are processed
in descending order. Each member points to the nearest place before it whose group is smaller (found over the pointers of the
places between); places that are pointed to leave their group for a new one right behind it, those pointed to more often further behind.
In the end a group holds the suffixes of one longest Lyndon prefix. Then, in ascending order, each suffix emits the places of which its
start is the end of the Lyndon prefix, along the same pointers, to the front of what is free in their groups. Nothing is
renamed and no smaller text is sorted. NumPy does a step for all texts of a batch at once: the next group of each.

Equal strings must meet. A window of ``LENGTH`` bytes belongs to the family of the least hash of its ``GRAM``-byte pieces; neighbouring windows of
one family are a segment. Texts are packed into blocks that are written once, bucketed by block. Every block sends the families
it has to ranges of keys; a range says which of them several documents have. Of those the block sends its distinct segments,
with their bytes and least document, and a range sorts the suffixes of every family that has several distinct segments: windows next to each other in
suffix order that agree in all bytes are one string, whose least document goes back to the blocks. A family of more than
``HOT`` segments, as around a passage that a third of all documents have, is dealt into families of a single window each, whose members
are all equal, so that no text to sort has more than ``HOT`` segments. Segments are taken as equal by a key of 48 and a hash of 64 bits and their
length, those of one window by two such values of all their bytes; within families bytes are compared.

Ids are whole numbers. Defined results: null text counts as empty; texts under ``LENGTH`` bytes lose nothing; matches never cross
documents; a string that occurs only within its document, or in documents of the same id, stays; a null id comes after all others; of
repeated rows all have the same result; very long texts are read whole, each a block of its own; other columns are not read, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lumenspan.llm._common import shared_dir, written
from lumenspan.llm.lm import _pack, _planes, _texts, _unpack, _unplanes

LENGTH, GRAM = 50, 20
MOST = 32  # windows of a segment
HOT = 128  # segments of a family, summed over blocks
RANGE_BYTES = 12_000_000  # of text a range of keys
BATCH = 1 << 20  # symbols that are sorted at once
PART = 1 << 20  # bytes of text that are cut at once
LAST = (1 << 63) - 1  # stands for a null id

_ODD = 0x9E3779B97F4A7C15


def places(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1 and so on, ``n`` of each."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def gathered(x: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``x`` at first, first + 1 and so on, ``n`` of each; places are only made for about ``PART`` of them at once."""
    upto = np.cumsum(n)
    out, begin = np.empty(int(n.sum()), x.dtype), 0
    while begin < len(n):
        base = upto[begin] - n[begin]
        stop = max(int(np.searchsorted(upto, base + PART, side="right")), begin + 1)
        out[base : upto[stop - 1]] = x[places(first[begin:stop], n[begin:stop])]
        begin = stop
    return out


def lyndon_groups(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of the group of every place in suffix order, and its pointer to the nearest place before it of a smaller group.

    ``x`` are the symbols of texts that begin at ``first`` (with the end of all) and end with a 0 that is nowhere else in them.
    A pointer to the place before a text is none.
    """
    n, low = len(x), first[:-1]
    owner = np.repeat(np.arange(len(low)), np.diff(first))
    key = owner * 512 + x
    order = np.argsort(key, kind="stable").astype(np.int32)
    sorted_ = key[order]
    new = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    length = np.diff(np.r_[new, n])
    group, place, before, size = (np.zeros(n, np.int32) for _ in range(4))
    group[order], place[order], size[new] = np.repeat(new, length), np.arange(n, dtype=np.int32), length
    base, end, active, told = low.astype(np.int32)[owner], first[1:].copy(), np.arange(len(low)), np.zeros(n, bool)
    while len(active):
        top = group[order[end[active] - 1]].astype(np.int64)
        count = end[active] - top
        own, g = order[places(top, count)], np.repeat(top, count)
        least, at = base[own], own - 1
        before[own] = at
        todo = np.flatnonzero(at >= least)
        todo = todo[group[at[todo]] >= g[todo]]
        while len(todo):
            before[own[todo]] = at[todo] = further = before[at[todo]]
            todo = todo[further >= least[todo]]
            todo = todo[group[at[todo]] >= g[todo]]
        target = np.sort(at[at >= least])
        if len(target):
            head = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
            often, target = np.diff(np.r_[head, len(target)]), target[head]
            sort = np.argsort(group[target].astype(np.int64) << 31 | often, kind="stable")
            target, often = target[sort], often[sort]
            old = group[target]
            fresh = np.r_[True, old[1:] != old[:-1]]
            begin = np.flatnonzero(fresh)
            many = np.diff(np.r_[begin, len(target)])
            tail = np.repeat((old + size[old])[begin] - many, many)
            slot = tail + np.arange(len(target)) - np.repeat(begin, many)
            # they move to the end of their old group; who was there takes the places that they leave
            now, there = place[target], order[slot]
            told[target] = True
            out, free = there[~told[there]], now[now < tail]
            told[target] = False
            order[slot], place[target], order[free], place[out] = target, slot, out, free
            head = np.flatnonzero(fresh | np.r_[True, often[1:] != often[:-1]])
            width = np.diff(np.r_[head, len(target)])
            group[target] = np.repeat(slot[head], width)
            size[old[begin]] -= many.astype(np.int32)
            size[slot[head]] = width
        end[active] = top
        active = active[top > low[active]]
    return group, before


def emitted(group: np.ndarray, before: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The suffix order of every text from its groups and pointers: places from ``first[k]`` on are those of text ``k``."""
    n = len(group)
    low, stop = first[:-1].copy(), first[1:].copy()
    out, done, free = np.zeros(n, np.int32), np.zeros(n, bool), np.arange(n, dtype=np.int32)
    out[low], done[stop - 1] = stop - 1, True
    free[low] += 1
    rank, at = low.copy(), stop - 2
    while len(rank):
        go = at >= low
        go[go] = ~done[at[go]]
        p = at[go]
        slot = free[group[p]]
        out[slot], free[group[p]], done[p], at[go] = p, slot + 1, True, before[p]
        rank[~go] += 1
        live, over = rank < stop, ~go
        if not live.all():
            rank, at, low, stop, over = rank[live], at[live], low[live], stop[live], over[live]
        at[over] = out[rank[over]] - 1
    return out


def suffix_order(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return emitted(*lyndon_groups(x, first), first)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def grams(x: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` bytes from every place on, in a number of passes that is the logarithm of ``k``."""
    part, size, found, done = x.astype(np.uint64) + np.uint64(1), 1, None, 0
    shift = lambda n: np.uint64(pow(_ODD, n, 1 << 64))
    with np.errstate(over="ignore"):
        while True:
            if k & 1:
                found = part if found is None else found[: len(part) - done] * shift(size) + part[done:]
                done += size
            k >>= 1
            if not k:
                return _mixed(found)
            part, size = part[:-size] * shift(size) + part[size:], 2 * size


def _sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        power = np.cumprod(np.r_[np.uint64(1), np.full(len(x), _ODD, np.uint64)])
        return np.r_[np.uint64(0), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * power[:-1])], np.cumprod(np.r_[np.uint64(1), np.full(len(x), pow(_ODD, -1, 1 << 64), np.uint64)])


def segments(x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, number of windows, family, hash of the bytes and text of every segment; texts end at ``ends``."""
    n = len(x)
    if n < LENGTH:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64))
    least, width, step = grams(x, GRAM), LENGTH - GRAM + 1, 1
    while 2 * step <= width:
        least, step = np.minimum(least[:-step], least[step:]), 2 * step
    if step < width:
        least = np.minimum(least[: step - width], least[width - step :])
    size = np.diff(ends, prepend=0)
    fit = size >= LENGTH
    new = np.zeros(len(least) + 1, bool)
    new[0], new[1:-1] = True, least[1:] != least[:-1]
    new[(ends - size)[fit]] = new[np.minimum(ends - LENGTH + 1, len(least))[fit]] = True
    at = np.flatnonzero(new[:-1])
    count, own = np.diff(np.r_[at, len(least)]), np.searchsorted(ends, at, side="right")
    inside = at + LENGTH <= ends[own]  # else the window would cross the end of its text
    at, count, own = at[inside], count[inside], own[inside]
    parts = -(-count // MOST)
    nth = places(np.zeros(len(at), np.int64), parts)
    start, windows = np.repeat(at, parts) + MOST * nth, np.minimum(np.repeat(count, parts) - MOST * nth, MOST)
    summed, back = _sums(x)
    with np.errstate(over="ignore"):
        digest = _mixed((summed[start + windows + LENGTH - 1] - summed[start]) * back[start] + windows.astype(np.uint64))
    # least hashes crowd at small values, so they are mixed again, or a few ranges would get most families
    return start, windows, _family(_mixed(least[start])), digest, np.repeat(own, parts)


def _family(h: np.ndarray) -> np.ndarray:
    """48 bits of a hash, doubled; windows that are families of their own are odd."""
    return (h >> np.uint64(16)) << np.uint64(1)


class Block:
    """The segments of some texts: start, windows, family, digest and text (``own``), and the bytes ``x`` of all texts."""

    def __init__(self, texts: pa.Array):
        self.x = np.frombuffer(b"".join(pc.cast(texts, pa.binary()).to_pylist()), np.uint8)
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(size)
        found, begin, part = [], 0, self.ends // PART
        for stop in [*(np.flatnonzero(np.diff(part)) + 1), len(size)] if len(size) else []:
            base = self.ends[begin] - size[begin]
            cut = segments(self.x[base : self.ends[stop - 1]], self.ends[begin:stop] - base)
            found.append((cut[0] + base, *cut[1:4], cut[4] + begin))
            begin = stop
        self.start, self.windows, self.family, self.digest, self.own = (np.concatenate(c) for c in zip(*found)) if found else segments(self.x, self.ends)

    def families(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct families in order, the place of every segment's among them, the number of their distinct segments, and whether several texts have them."""
        order = np.lexsort((self.digest, self.family))
        family, digest, own = self.family[order], self.digest[order], self.own[order]
        new = np.r_[True, family[1:] != family[:-1]] if len(order) else np.empty(0, bool)
        other = new | np.r_[True, digest[1:] != digest[:-1]] if len(order) else new
        head = np.flatnonzero(new)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        if not len(head):
            return family, at, at, new
        return family[head], at, np.add.reduceat(other.astype(np.int64), head), np.minimum.reduceat(own, head) < np.maximum.reduceat(own, head)

    def members(self, route: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, windows, family, digest and text of the segments of route 1 and of every window of those of route 2."""
        meet, hot = route == 1, route == 2
        start, n = places(self.start[hot], self.windows[hot]), self.windows[hot]
        one, other = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(LENGTH):
                byte = self.x[start + i].astype(np.uint64) + np.uint64(1)
                one, other = one * np.uint64(_ODD) + byte, (other ^ byte) * np.uint64(0xD6E8FEB86659FD93)
        columns = [(self.start[meet], start), (self.windows[meet], np.ones(len(start), np.int64)), (self.family[meet], _family(_mixed(one)) | np.uint64(1)), (self.digest[meet], _mixed(other)), (self.own[meet], np.repeat(self.own[hot], n))]
        return tuple(np.concatenate(c) for c in columns)


def _bounds(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of sorted keys begins."""
    return np.searchsorted(((keys >> np.uint64(17)) * np.uint64(ranges)) >> np.uint64(32), np.arange(ranges + 1, dtype=np.uint64))


def _blocks(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    """For every block and range: the block's families there, how many segments each has and whether several texts do."""
    for batch in batches:
        for number, rows in zip(batch.column("block").to_pylist(), batch.column("rows").to_pylist()):
            family, _, count, several = Block(_texts(_unpack(rows))).families()
            bounds = _bounds(family, ranges)
            some = np.flatnonzero(np.diff(bounds))
            runs = [slice(bounds[r], bounds[r + 1]) for r in some]
            told = np.minimum(count, 127).astype(np.uint8) << 1 | several
            columns = [[_planes(np.diff(family[r], prepend=np.uint64(0))) for r in runs], [told[r].tobytes() for r in runs]]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([number] * len(some), pa.int64()), *(pa.array(c, pa.binary()) for c in columns)], ["range", "block", "families", "told"])


def _routed(part: pa.Table) -> pa.Table:
    """For every block the routes of its families: 0 none, 1 segments meet, 2 windows meet."""
    families = [np.cumsum(_unplanes(x.as_py(), np.uint64), dtype=np.uint64) for x in part["families"]]
    told = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in part["told"]])
    found, at, blocks = np.unique(np.concatenate(families), return_inverse=True, return_counts=True)
    several = (blocks > 1) | (np.bincount(at, told & 1, len(found)) > 0)
    route = np.where(several, 1 + (np.bincount(at, told >> 1, len(found)) > HOT), 0).astype(np.uint8)[at]
    routes = [r.tobytes() for r in np.split(route, np.cumsum([len(f) for f in families])[:-1])]
    return pa.table({"block": part["block"], "range": part["range"], "routes": pa.array(routes, pa.binary())})


def _in_order(part: pa.Table, name: str, kind: type) -> np.ndarray:
    part = part.sort_by("range")
    data = [x.as_py() for x in part[name] if x.is_valid]
    return np.concatenate([np.frombuffer(d, np.uint8) if kind is np.uint8 else _unplanes(d, kind) for d in data]) if data else np.empty(0, kind)


class Told:
    """The members of a block that meet others: distinct ones in order of family and digest, the first of each and the place of all among them."""

    def __init__(self, block: Block, back: pa.Table):
        _, at, _, _ = block.families()
        self.start, self.windows, family, digest, self.own = block.members(_in_order(back, "routes", np.uint8)[at])
        order = np.lexsort((digest, family))
        f, d = family[order], digest[order]
        new = np.r_[True, (f[1:] != f[:-1]) | (d[1:] != d[:-1])] if len(order) else np.empty(0, bool)
        self.head, self.order = np.flatnonzero(new), order
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        self.first = order[self.head]
        self.family, self.digest = family[self.first], digest[self.first]


def _ids(rows: pa.Table) -> np.ndarray:
    return pc.fill_null(pc.cast(rows["id"], pa.int64()), LAST).to_numpy()


def _sent(ranges: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def sent(docs: pa.Table, back: pa.Table) -> pa.Table:
        """The distinct members of a block by range: family, digest, least id, windows and bytes."""
        packer = zstandard.ZstdCompressor(level=3)
        columns: dict[str, list] = {c: [] for c in ("range", "block", "families", "digests", "lows", "windows", "texts")}
        if len(docs) and len(back):
            rows = _unpack(docs["rows"][0].as_py())
            block = Block(_texts(rows))
            told = Told(block, back)
            low = np.minimum.reduceat(_ids(rows)[told.own[told.order]], told.head) if len(told.head) else np.empty(0, np.int64)
            alone = (told.family & np.uint64(1)) == 1
            size = np.where(alone, 0, told.windows[told.first] + LENGTH - 1)
            text, upto = gathered(block.x, told.start[told.first], size), np.r_[0, np.cumsum(size)]
            bounds = _bounds(told.family, ranges)
            for r in np.flatnonzero(np.diff(bounds)):
                a, b = bounds[r], bounds[r + 1]
                of = {"range": int(r), "block": docs["block"][0].as_py(), "families": _planes(np.diff(told.family[a:b], prepend=np.uint64(0))), "digests": told.digest[a:b].tobytes(), "lows": _planes(low[a:b])}
                of |= {"windows": told.windows[told.first[a:b]].astype(np.uint8).tobytes(), "texts": packer.compress(text[upto[a] : upto[b]].tobytes())}
                for c, v in of.items():
                    columns[c].append(v)
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(columns.items(), kinds)})

    return sent


def batches(size: np.ndarray, family: np.ndarray) -> Iterator[slice]:
    """Whole families of segments of about ``BATCH`` bytes in all; segments of one family stand together."""
    ends, begin = np.cumsum(size), 0
    stops = np.flatnonzero(np.r_[family[1:] != family[:-1], True]) + 1
    while begin < len(size):
        base = ends[begin] - size[begin]
        stop = int(stops[min(np.searchsorted(ends[stops - 1], base + BATCH), len(stops) - 1)])
        yield slice(begin, stop)
        begin = stop


def string_lows(text: np.ndarray, size: np.ndarray, low: np.ndarray, family: np.ndarray) -> np.ndarray:
    """The least ``low`` of every window's string, one window after the other; segments of one family stand together in ``text``."""
    closing = np.r_[family[1:] != family[:-1], True]
    first = np.cumsum(size + 1 + closing) - (size + 1 + closing)
    x = np.ones(len(text) + len(size) + int(closing.sum()), np.int64)
    x[places(first, size)] = text.astype(np.int64) + 2
    x[(first + size + 1)[closing]] = 0
    order = suffix_order(x, np.r_[0, (first + size + 2)[closing]])
    windows = size - LENGTH + 1
    starts = places(first, windows)
    lows = np.full(len(x), -1, np.int64)
    lows[starts] = np.repeat(low, windows)
    opens = np.zeros(len(x), bool)
    opens[starts] = True
    order = order[opens[order]]
    slide = np.lib.stride_tricks.sliding_window_view(x.astype(np.uint16), LENGTH)
    new = np.ones(len(order), bool)
    for i in range(1, len(order), 100_000):
        j = min(i + 100_000, len(order))
        new[i:j] = (slide[order[i:j]] != slide[order[i - 1 : j - 1]]).any(axis=1)
    head = np.flatnonzero(new)
    lows[order] = np.repeat(np.minimum.reduceat(lows[order], head), np.diff(np.r_[head, len(order)]))
    return lows[starts]


def _met(part: pa.Table) -> pa.Table:
    """A range's members from all blocks: for each block the least ids of its members' windows, as runs."""
    families = [np.cumsum(_unplanes(x.as_py(), np.uint64), dtype=np.uint64) for x in part["families"]]
    counts = [len(f) for f in families]
    family, digest = np.concatenate(families), np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in part["digests"]])
    low, windows = np.concatenate([_unplanes(x.as_py(), np.int64) for x in part["lows"]]), np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in part["windows"]]).astype(np.int64)
    reader = zstandard.ZstdDecompressor()
    text = np.concatenate([np.frombuffer(reader.decompress(x.as_py()), np.uint8) for x in part["texts"]])
    size = np.where((family & np.uint64(1)) == 1, 0, windows + LENGTH - 1)
    from_ = np.cumsum(size) - size

    order = np.lexsort((digest, family))
    f, d = family[order], digest[order]
    head = np.flatnonzero(np.r_[True, (f[1:] != f[:-1]) | (d[1:] != d[:-1])])
    at = np.empty(len(order), np.int64)
    at[order] = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(order)]))
    least, one = np.minimum.reduceat(low[order], head), order[head]
    f, n = family[one], windows[one]
    several = np.r_[False, f[1:] == f[:-1]] | np.r_[f[1:] == f[:-1], False]
    several &= size[one] > 0  # members without bytes are equal if their family is
    lows = np.repeat(least, n)
    if several.any():
        # families of like length in one batch, as a batch takes as many steps as its longest needs
        own = np.flatnonzero(several)
        _, of = np.unique(f[own], return_inverse=True)
        own = own[np.lexsort((of, np.bincount(of, size[one[own]])[of]))]
        begin = np.cumsum(n) - n
        for batch in batches(size[one[own]], f[own]):
            some = own[batch]
            at_text, long = from_[one[some]], size[one[some]]
            lows[places(begin[some], n[some])] = string_lows(text[places(at_text, long)], long, least[some], f[some])

    upto = np.cumsum(n)
    new = np.r_[True, lows[1:] != lows[:-1]]
    new[upto[:-1]] = True
    run = np.flatnonzero(new)
    long, value = np.diff(np.r_[run, len(lows)]).astype(np.uint8), lows[run]
    runs = np.diff(np.r_[0, np.searchsorted(run, upto)])
    begin = np.cumsum(runs) - runs
    told: dict[str, list] = {c: [] for c in ("runs", "long", "lows")}
    for own in np.split(at, np.cumsum(counts)[:-1]):
        which = places(begin[own], runs[own])
        told["runs"].append(runs[own].astype(np.uint8).tobytes())
        told["long"].append(long[which].tobytes())
        told["lows"].append(_planes(value[which]))
    return pa.table({"block": part["block"], "range": part["range"], **{c: pa.array(v, pa.binary()) for c, v in told.items()}})


def _cleaned(kind: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def cleaned(docs: pa.Table, back: pa.Table) -> pa.Table:
        rows = _unpack(docs["rows"][0].as_py())
        block, ids = Block(_texts(rows)), _ids(rows)
        cover = np.zeros(len(block.x) + 1, np.int32)
        met = back.filter(pc.is_valid(back["runs"]))
        if len(met):
            told = Told(block, back.filter(pc.is_valid(back["routes"])))
            runs, long, low = _in_order(met, "runs", np.uint8).astype(np.int64), _in_order(met, "long", np.uint8).astype(np.int64), _in_order(met, "lows", np.int64)
            begin, many = np.cumsum(runs) - runs, runs[told.at]
            which = places(begin[told.at], many)  # the runs of every member, one member after the other
            hit, long = low[which] < np.repeat(ids[told.own], many), long[which]
            start = np.cumsum(long) - long + np.repeat(told.start - np.cumsum(told.windows) + told.windows, many)
            start, long = start[hit], long[hit]
            cover[start] += 1  # no two runs begin at one place, and none end at one
            cover[start + long + LENGTH - 1] -= 1
        gone = np.cumsum(cover, dtype=np.int32)[:-1] > 0
        size = np.diff(block.ends, prepend=0)
        first = block.ends - size
        opening = gone.copy()
        opening[1:] &= ~gone[:-1]
        opening[first[size > 0]] = gone[first[size > 0]]  # runs do not cross documents
        upto, spans = (np.r_[np.int32(0), np.cumsum(c, dtype=np.int32)] for c in (gone, opening))
        kept = [hashlib.sha256(block.x[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(first, block.ends)]
        return pa.table(
            {
                "id": rows["id"].cast(kind),
                "n_bytes": pa.array(size, pa.int64()),
                "n_removed": pa.array(upto[block.ends] - upto[first], pa.int64()),
                "n_spans": pa.array(spans[block.ends] - spans[first], pa.int64()),
                "kept_sha256": pa.array(kept, pa.string()),
            }
        )

    return cleaned


def _bucketed(packed: DataFrame, buckets: int) -> DataFrame:
    """The blocks as a table bucketed by block, so that what comes back meets them where they are."""
    spark, name = packed.sparkSession, f"suffix_blocks_{uuid.uuid4().hex}"
    packed.write.option("compression", "zstd").option("path", f"{shared_dir(spark)}/{name}").bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans and kept_sha256."""
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    packed = _bucketed(_pack(docs, id_col, text_col, F.lit(0)), buckets)
    ranges = max(64, math.ceil((packed.agg(F.sum("size")).first()[0] or 0) / RANGE_BYTES))

    families = packed.select("block", "rows").mapInArrow(lambda batches: _blocks(batches, ranges), "range int, block long, families binary, told binary")
    routes = written(families.groupBy("range").applyInArrow(_routed, "block long, range int, routes binary"), "suffix-routes")
    blocks = packed.select("block", "rows").groupBy("block")
    sent = blocks.cogroup(routes.groupBy("block")).applyInArrow(_sent(ranges), "range int, block long, families binary, digests binary, lows binary, windows binary, texts binary")
    met = written(sent.groupBy("range").applyInArrow(_met, "block long, range int, runs binary, long binary, lows binary"), "suffix-met")
    back = routes.unionByName(met, allowMissingColumns=True)
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = blocks.cogroup(back.groupBy("block")).applyInArrow(_cleaned(to_arrow_type(docs.schema[id_col].dataType)), schema)
    return out.withColumnRenamed("id", id_col)
