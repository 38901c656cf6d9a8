"""Sentence pieces with the bytes of the original text that each of them stands for.

A text is normalised first: at every place the longest prefix that the model's compiled character map
knows is replaced, anything else stays, and each byte written remembers the place it was read from.
White space is then marked, the result is cut into segments, and every piece goes back to its bytes
in the original through the remembered places.

The character map is a double-array trie followed by the replacements.  All places of a text walk it
together, a byte a step, in numpy.  No piece of the vocabulary holds a mark behind another character
(`Pieces` checks it), so no merge crosses such a place and equal segments are merged once: the library
merges those that a task has not seen, the frequent ones stay known over two generations.

Empty texts have the end id only, nulls count as empty, repeated rows get equal results, an empty
table gives none; carried columns are in one struct, so their names cannot clash.  A text is one row's
work, whatever its length, and its arrays are a small multiple of it.
"""

from __future__ import annotations

import hashlib
import re
import struct
import sys
import zlib
from types import ModuleType

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import map_texts

#: Segments of a generation; two generations are known at most.
GENERATION = 150_000
#: Characters of unseen segments that the library merges in one call.
CALL_CHARS = 20_000

MARK = "▁"
_MARK, _SPACE = MARK.encode(), 0x20
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class CharacterMap:
    """Longest-prefix search in a compiled character map: sizes, trie units, replacements ended by a zero byte."""

    def __init__(self, compiled: bytes):
        (size,) = struct.unpack_from("<I", compiled) if compiled else (0,)
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4 if compiled else 0).astype(np.int64)
        self.blob = np.frombuffer(compiled[4 + size :], np.uint8)
        self.zeros = np.flatnonzero(self.blob == 0)

    @staticmethod
    def _children(units: np.ndarray) -> np.ndarray:
        return (units >> 10) << ((units & 512) >> 6)

    def longest(self, text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the longest known prefix at each start (0: none) and where its replacement begins."""
        length, value = np.zeros((2, len(starts)), np.int64)
        if not len(self.units):
            return length, value
        who = np.arange(len(starts))
        node = np.full(len(starts), self._children(self.units[:1])[0])
        step = 0
        while len(who):
            there = starts[who] + step < len(text)
            who, node = who[there], node[there]
            byte = text[starts[who] + step].astype(np.int64)
            node = node ^ byte
            unit = self.units[node]
            fits = (unit & 0x800000FF) == byte
            who, unit = who[fits], unit[fits]
            node = node[fits] ^ self._children(unit)
            ends = (unit >> 8) & 1 == 1
            length[who[ends]] = step + 1
            value[who[ends]] = self.units[node[ends]] & 0x7FFFFFFF
            step += 1
        return length, value

    def sizes(self, values: np.ndarray) -> np.ndarray:
        return self.zeros[np.searchsorted(self.zeros, values)] - values


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, …, size[0] of them, then those of the next."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Normaliser:
    def __init__(self, spec, suffix_marks: bool = False):
        if suffix_marks:
            raise ValueError("models with marks behind words are not supported")
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and the place in `text` that each of its bytes was read from, with one for its end.

        A place is where the replaced prefix begins.  Bytes that are no UTF-8 are replaced singly.
        """
        if not text:
            return b"", np.zeros(1, np.int64)
        origin, source, length, pool = self._units(text, np.frombuffer(text, np.uint8))
        out = pool[_ragged(source, length)]
        unit = np.repeat(np.arange(len(source)), length)
        end = len(text)
        if self.squeeze:
            keep, first = self._squeezed(out, unit, source, length, pool)
            out, unit = out[keep], unit[keep]
            if first == len(source):
                return b"", np.zeros(1, np.int64) + end
        else:
            first = 0
        place = origin[unit]
        space = out == _SPACE
        mark = np.frombuffer(_MARK if self.escape else b" ", np.uint8)
        if self.escape and space.any():
            wide = np.where(space, 3, 1)
            spread = np.concatenate([out, mark])
            out = spread[_ragged(np.where(space, len(out), np.arange(len(out))), wide)]
            place = np.repeat(place, wide)
        if self.prefix:
            out = np.concatenate([mark, out])
            place = np.concatenate([np.full(len(mark), origin[first]), place])
        made = out.tobytes()
        if self.squeeze:
            bare = made
            while bare.endswith(mark.tobytes()):
                bare = bare[: -len(mark)]
                end = int(place[len(bare)])
            made, place = bare, place[: len(bare)]
        return made, np.append(place, end)

    def _units(self, text: bytes, raw: np.ndarray):
        """Place, where in the pool and bytes there of what is read in one step; the pool: the text and all replacements."""
        try:
            text.decode()
            starts = np.flatnonzero((raw & 0xC0) != 0x80)
            broken = np.zeros(len(starts), bool)
        except UnicodeDecodeError:
            points = np.frombuffer(text.decode(errors="surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")
            broken = (points >= 0xDC80) & (points <= 0xDCFF)
            sizes = np.where(broken, 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
            starts = np.cumsum(sizes) - sizes
        known, value = self.map.longest(raw, starts)
        step = np.diff(np.append(starts, len(raw)))
        keep = np.ones(len(starts), bool)
        upto = 0
        for i in np.flatnonzero(known > step):  # prefixes of several characters hide those inside them
            if starts[i] >= upto:
                upto = starts[i] + known[i]
                keep[i + 1 : np.searchsorted(starts, upto)] = False
        odd = b"\xef\xbf\xbd"
        pool = np.concatenate([raw, self.map.blob, np.frombuffer(odd, np.uint8)])
        source = np.where(known > 0, len(raw) + value, starts)
        length = step.copy()
        hit = known > 0
        if hit.any():
            length[hit] = self.map.sizes(value[hit])
        source[broken], length[broken] = len(pool) - len(odd), len(odd)
        return starts[keep], source[keep], length[keep], pool

    @staticmethod
    def _squeezed(out, unit, source, length, pool):
        """Bytes that stay when spaces at the start and after a space go, and the first unit that is no space alone."""
        space = out == _SPACE
        begin = np.cumsum(length) - length
        lone = (length == 1) & (pool[np.minimum(source, len(pool) - 1)] == _SPACE)
        first = int(np.argmin(lone)) if not lone.all() else len(lone)
        before = np.concatenate([[True], space[:-1]])[np.minimum(begin, max(len(out) - 1, 0))] if len(out) else np.zeros(0, bool)
        # spaces that head a unit: no other byte of the unit stands before them
        others = np.cumsum(~space)
        heads = space & (others == np.concatenate([[0], others])[begin][unit])
        return ~(heads & before[unit]) & (unit >= first), first


class Pieces:
    """Encoder of one worker: normaliser, library for unseen segments, known segments."""

    def __init__(self, path: str | None = None, generation: int = GENERATION, proto: bytes | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        if proto is None:
            with open(path or default_model(), "rb") as file:
                proto = file.read()
        model = pb.ModelProto()
        model.ParseFromString(proto)
        kinds = pb.ModelProto.SentencePiece
        words = [p.piece for p in model.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)]
        if not model.trainer_spec.byte_fallback or any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError("models need a piece for every byte and no symbols of a user")
        if any(MARK in w.lstrip(MARK) for w in words) or MARK not in words:
            raise ValueError("a piece of this model crosses the start of a word")
        self.normalise = Normaliser(model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.end = self.library.eos_id()
        plain = pb.NormalizerSpec(name="identity", add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=False)
        model.normalizer_spec.CopyFrom(plain)
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.width = np.array([len(p.piece.encode()) for p in model.pieces])
        self.byte = np.array([int(p.piece[1:-1], 16) if p.type == kinds.BYTE else -1 for p in model.pieces])
        self.generation = generation
        self.known, self.older = {}, {}

    def _widths(self, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes of each piece; of a character's byte pieces the last has all its bytes."""
        byte = self.byte[ids]
        width = np.where(byte >= 0, 0, self.width[ids])
        single = np.flatnonzero(byte >= 0)
        if len(single):
            values = byte[single]
            heads = np.flatnonzero((values & 0xC0) != 0x80)
            size = np.diff(np.append(heads, len(values)))
            width[single[heads + size - 1]] = size
        return width

    def _merged(self, segments: list[str]) -> None:
        ids = np.array(self.merger.encode("".join(segments)), np.int64)
        width = self._widths(ids)
        ends = np.searchsorted(np.cumsum(width), np.cumsum([len(s.encode()) for s in segments])) + 1
        for segment, a, b in zip(segments, [0, *ends[:-1].tolist()], ends.tolist()):
            own = ids[a:b]
            self.known[segment] = (own.astype("<u4").tobytes(), width[a:b].astype("<u4").tobytes(), " ".join(map(str, own.tolist())))

    def _learn(self, lists: list[list[str]]) -> None:
        if len(self.known) > self.generation:
            self.known, self.older = {}, self.known
        call, chars = [], 0
        for segment in set().union(*lists).difference(self.known):
            if segment in self.older:
                self.known[segment] = self.older[segment]
            elif segment[0] != MARK or segment[-1] == MARK:  # not cut off by itself among others
                self._merged([segment])
            else:
                call.append(segment)
                chars += len(segment)
                if chars > CALL_CHARS:
                    self._merged(call)
                    call, chars = [], 0
        if call:
            self._merged(call)

    def encode(self, texts: list[bytes]):
        """For each text: ids, first and past-the-last original byte of each piece, and the ids as decimal text.

        The end id comes last and stands for no bytes.  Of a character spelled in byte pieces the last
        piece has its bytes.
        """
        normal = [self.normalise(t) for t in texts]
        lists = [_SEGMENT.findall(made.decode()) for made, _ in normal]
        self._learn(lists)
        for (_, place), segments in zip(normal, lists):
            found = [self.known[s] for s in segments]
            ids = np.frombuffer(b"".join([f[0] for f in found]), "<u4")
            past = np.cumsum(np.frombuffer(b"".join([f[1] for f in found]), "<u4"), dtype=np.int64)
            first = np.concatenate([[0], past])[:-1]
            yield (
                np.append(ids, np.uint32(self.end)).astype("<u4"),
                np.append(place[first], place[-1]),
                np.append(place[past], place[-1]),
                " ".join([*[f[2] for f in found], str(self.end)]),
            )

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def pieces_of_worker(path: str | None = None) -> Pieces:
    """A worker serves many tasks; what it has seen stays known."""
    kept = sys.modules.setdefault("cohortloom_kept", ModuleType("cohortloom_kept")).__dict__
    key = ("pieces", path or default_model())
    if key not in kept:
        kept[key] = Pieces(key[1])
    return kept[key]


def encode_documents(docs: DataFrame, model: str | None = None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`row` with the carried columns, and `ids`, `begins`, `ends`: pieces and their bytes in the original text."""

    def start():
        encoder = pieces_of_worker(model)

        def work(texts):
            made = list(encoder.encode([t or b"" for t in texts]))
            return [[m[k] for m in made] for k in range(3)]

        return work

    numbers = T.ArrayType(T.LongType())
    return map_texts(docs, [("ids", T.ArrayType(T.IntegerType())), ("begins", numbers), ("ends", numbers)], start, text, carry)


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """`row` and `text` again from `ids`."""
    slim = encoded.select("row", "ids")
    schema = T.StructType([slim.schema["row"], T.StructField("text", T.StringType())])

    def run(batches):
        import pyarrow as pa

        encoder = pieces_of_worker(model)
        for batch in batches:
            texts = [encoder.library.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return slim.mapInArrow(run, schema)


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Digests of every document's ids, of the text decoded from them and of the bytes that the pieces stand for.

    doc_id, n_tokens, ids_sha256 (decimal ids with a space between), decoded_sha256, spans_crc32 (all
    first bytes, then all ends, as little-endian unsigned 32-bit numbers).  A text is encoded and decoded
    whole in one task.
    """

    def start():
        encoder = pieces_of_worker(model)

        def work(texts):
            out = []
            for ids, first, past, decimal in encoder.encode([t or b"" for t in texts]):
                decoded = encoder.decode(ids).encode()
                spans = zlib.crc32(past.astype("<u4").tobytes(), zlib.crc32(first.astype("<u4").tobytes()))
                out.append((len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(), spans))
            return [list(x) for x in zip(*out)] if out else [[], [], [], []]

        return work

    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()), ("spans_crc32", T.LongType())]
    found = map_texts(docs, fields, start, carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), *[n for n, _ in fields])
