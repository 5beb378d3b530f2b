"""SentencePiece encoding and decoding that keeps byte offsets.

Text is normalised the way the model says: at each place the longest prefix that the compiled character map knows is
replaced, white space becomes the model's space mark, and every normalised byte remembers the original byte that it came
from. Pieces then project to spans of original bytes. Ids are those of the sentencepiece library, byte for byte.

The library segments each distinct run "space marks + word" once and a cache keeps the result: no piece of such a model
crosses from a word into the next space mark, so the ids of a text are those of its runs in order. The cache holds
``CACHE`` ids at most between two calls, and no run of more than ``LONGEST`` characters, as texts without spaces have. Where a
model's vocabulary says otherwise, the whole text is encoded at once.

Defined results: null counts as empty; an empty text has the end id alone and an empty span for it; very long texts are
encoded whole, texts of about ``CHUNK`` characters at a time leave a task; repeated rows and ids are encoded each; an empty
table gives an empty result; extra columns pass through, but for those named like an output, which the output replaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import packed_row, row_schema, whole

MARK = "▁"
CACHE = 1_500_000
LONGEST = 64
ENTRY = 8  # ids that an entry counts for besides its own
#: Characters of text whose ids and spans leave a task at once.
CHUNK = 1_000_000


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 and the replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], np.uint32).tolist()
        self.out = blob[4 + size :]

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of ``text[at:]``, and what replaces it."""
        units, found = self.units, None
        if not units:
            return None
        node = self._step(units[0])
        for k in range(at, len(text)):
            node ^= text[k]
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.out[start : self.out.index(b"\0", start)]
        return found


class Codec:
    """Encoder and decoder of one model; lives in a task."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.spec = proto.normalizer_spec
        self.map = CharMap(self.spec.precompiled_charsmap)
        self.end = self.sp.eos_id()
        self.byte_fallback = proto.trainer_spec.byte_fallback
        kinds = proto.SentencePiece
        self.sizes = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        inner = any(p.type in (kinds.NORMAL, kinds.USER_DEFINED) and MARK in p.piece.lstrip(MARK) for p in proto.pieces)
        plain = not self.map.units and self.spec.add_dummy_prefix and not self.spec.remove_extra_whitespaces and self.spec.escape_whitespaces
        self.by_runs = plain and not inner and self.byte_fallback and proto.trainer_spec.model_type == proto.trainer_spec.BPE
        self.cache: dict[str, list[int]] = {}
        self.held = 0

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the original byte."""
        if self.map.units or self.spec.remove_extra_whitespaces:
            return self._normalise_by_map(text)
        raw = np.frombuffer(text.encode(), np.uint8)
        if not len(raw):
            return "", np.zeros(1, np.int64)
        space = MARK if self.spec.escape_whitespaces else " "
        width = len(space.encode())
        origin = np.repeat(np.arange(len(raw)), np.where(raw == 32, width, 1))
        lead = [0] * (width if self.spec.add_dummy_prefix else 0)
        return space * self.spec.add_dummy_prefix + text.replace(" ", space), np.concatenate([np.array(lead, np.int64), origin, [len(raw)]])

    def _normalise_by_map(self, text: str) -> tuple[str, np.ndarray]:
        raw, at = text.encode(), 0
        parts: list[tuple[bytes, int, int]] = []
        while at < len(raw):
            found = self.map.longest(raw, at)
            if not found:
                first = raw[at]
                found = (width := 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4), raw[at : at + width]
            parts.append((found[1], at, at + found[0]))
            at += found[0]
        if tidy := self.spec.remove_extra_whitespaces:
            while parts and not parts[0][0].strip(b" "):
                parts.pop(0)
        if not parts:
            return "", np.zeros(1, np.int64)
        space = MARK.encode() if self.spec.escape_whitespaces else b" "
        out, origin = bytearray(), []
        if self.spec.add_dummy_prefix:
            out += space
            origin += [parts[0][1]] * len(space)
        before, end = tidy, parts[-1][2]
        for piece, start, _ in parts:
            if tidy and before:
                piece = piece.lstrip(b" ")
            for b in piece:
                new = space if b == 32 else bytes([b])
                out += new
                origin += [start] * len(new)
            if piece:
                before = piece.endswith(b" ")
        while tidy and out.endswith(space):
            end = origin[-1]
            del out[-len(space) :], origin[-len(space) :]
        return out.decode(), np.array([*origin, end], np.int64)

    def ids(self, texts: list[str], normal: list[str]) -> list[list[int]]:
        """Ids of each text without the end id."""
        if not self.by_runs:
            return self.sp.encode(texts, num_threads=1)
        runs = [re.findall(f"{MARK}+[^{MARK}]*", x) for x in normal]
        cache = self.cache
        if self.held > CACHE:
            cache.clear()
            self.held = 0
        new = list({r for x in runs for r in x if r not in cache})
        cache.update(zip(new, self.sp.encode([r[1:] for r in new], num_threads=1) if new else []))
        # a lone mark is an empty text to the library, which gives it no dummy prefix
        cache[MARK] = [self.sp.piece_to_id(MARK)]
        out = []
        for x in runs:
            got: list[int] = []
            for r in x:
                got += cache[r]
            out.append(got)
        for r in new:
            if len(r) > LONGEST:
                del cache[r]
            else:
                self.held += ENTRY + len(cache[r])
        return out

    def spans(self, text: str, ids: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Original byte spans of the pieces."""
        if not self.byte_fallback and (ids == self.sp.unk_id()).any():
            proto = self.sp.encode(text, out_type="immutable_proto")
            sizes = np.array([len(p.piece.encode()) for p in proto.pieces], np.int64)
        else:
            sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return origin[ends - sizes], origin[ends]

    def encode(self, texts: list[str], spans: bool = True) -> list[tuple[np.ndarray, ...]]:
        """(ids, begins, ends) of each text, with the end id last; (ids,) without spans."""
        if not spans and self.by_runs:
            plain = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
            return [(np.array([*got, self.end], np.int64),) for got in self.ids(texts, plain)]
        normal = [self.normalise(t) for t in texts]
        out = []
        for text, (_, origin), got in zip(texts, normal, self.ids(texts, [n for n, _ in normal])):
            ids = np.array(got, np.int64)
            begins, ends = self.spans(text, ids, origin)
            last = origin[-1:]
            out.append((np.append(ids, self.end), np.append(begins, last), np.append(ends, last)))
        return out


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _chunks(sizes: list[int]) -> Iterator[slice]:
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= CHUNK:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).astype(np.int32)))


def encode(docs: DataFrame, model: bytes, text_col: str = "text", keep: list[str] | None = None, spans: bool = True, decoded: str | None = None) -> DataFrame:
    """``keep`` (all columns unless given) with ids, and begins and ends: original byte spans of the pieces.

    ``decoded`` names a column for the text that the ids decode to, if that is wanted from the same pass.
    """
    fields = [("ids", "array<int>")] + [("begins", "array<int>"), ("ends", "array<int>")] * spans
    outputs = dict(fields) | ({decoded: "string"} if decoded else {})
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            for part in _chunks(pc.utf8_length(batch.column(1)).to_pylist()):
                some = batch.slice(part.start, part.stop - part.start)
                got = codec.encode(some.column(1).to_pylist(), spans)
                columns = [some.column(0), *(_lists([x[k] for x in got]) for k in range(len(fields)))]
                if decoded:
                    columns.append(pa.array([codec.sp.decode(x[0].tolist()) for x in got], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["row", *outputs])

    rows = docs.select(packed_row(docs, keep), whole(docs[text_col]).alias("text"))
    return rows.mapInArrow(encoded, row_schema(rows, "row", more=", ".join(f"`{name}` {kind}" for name, kind in outputs.items()))).select("row.*", *(f"`{name}`" for name in outputs))


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", into: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) with the text that the library's decode gives for the ids; null ids give null."""
    keep = [c for c in (encoded.columns if keep is None else keep) if c != into]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            ids = batch.column(1)
            for part in _chunks([4 * n for n in ids.value_lengths().fill_null(0).to_pylist()]):
                some = ids.slice(part.start, part.stop - part.start).to_pylist()
                texts = [None if x is None else sp.decode(x) for x in some]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(some)), pa.array(texts, pa.string())], ["row", into])

    rows = encoded.select(packed_row(encoded, keep), ids_col)
    return rows.mapInArrow(decoded, row_schema(rows, "row", more=f"{into} string")).select("row.*", into)


def digests(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, n_bytes (where the last piece's span ends) and
    spans_hash, the xxhash64 of the begins and ends of all pieces."""
    rows = encode(docs, model, text_col, [id_col], decoded="decoded")
    return rows.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("long").alias("n_bytes"),
        F.xxhash64("begins", "ends").alias("spans_hash"),
    )
