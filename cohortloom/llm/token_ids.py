"""Ids of whole texts by a public tokenizer.

A byte-level pre-tokenizer never joins a character with white space that follows it, so a text can be cut
there, and equal pieces need the tokenizer once.  Nor does it join a line end between two words with
either, or a letter with a mark after it: such pieces are put together from known ones.  Everything else is
the tokenizer's own work.

Texts are cut and their distinct pieces found by Arrow, a lot of some megabytes at a time; only the lot's
distinct words and odd pieces are looked up in what a worker remembers.
"""

from __future__ import annotations

import os
import re
import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct pieces that a worker remembers; beyond, it goes on with the half that it met most often.
REMEMBERED = 500_000

_CUT = re.compile(r"(?<=\S)(?=[ \n\t\r])")
#: A piece of a letter and one of these is two; an apostrophe may begin a contraction.
_MARKS = frozenset(".,;:!?&$%*#)]}>/-+=_@|~^\"")
#: Letters below are letters in every version of the tables, so words of them are not cut by a pre-tokenizer.
_PLAIN = "\u0530"
_LETTER = np.array([chr(k).isalpha() and chr(k) < _PLAIN for k in range(1 << 11)])
#: Pieces that the tokenizer sees in one text.
_BLOCK = 500
#: Texts of so many bytes are encoded at once; an Arrow batch that has more is a lot alone.
LOT_BYTES = 2 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Pieces(dict):
    """Piece to its number; an unseen piece is numbered and queued, -1 is one that cannot stand alone.

    A piece with the prefix of a space stands for both, or, if it begins with a line end, for itself.
    """

    def __init__(self, prefix: str, owner: Encoder, known=()):
        super().__init__(known)
        self.prefix, self.owner = prefix, owner

    def __missing__(self, piece: str) -> int:
        owner = self.owner
        if piece.isprintable() and piece:
            if piece[-1] in _MARKS and piece[-2:-1].isalpha():
                number = owner.numbered(owner.pairs, (self[piece[:-1]], owner.first[piece[-1]]))
            elif self.prefix and piece.isalpha() and max(piece) < _PLAIN:
                number = owner.numbered(owner.words, self.prefix + piece)
            else:
                number = owner.numbered(owner.lines, self.prefix + piece)
        elif piece[:1] == "\n" and self.prefix and not piece[1:2].isspace():
            word = owner.first[piece[1:]]
            number = owner.numbered(owner.breaks, (0, word)) if word >= 0 else -1
        elif not piece or piece[0].isspace() or piece[-1].isspace():
            number = -1
        else:  # other odd characters
            number = owner.numbered(owner.odd, self.prefix + piece)
        self[piece] = number
        return number


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy with room for `size` entries and as many again."""
    if len(array) >= size:
        return array
    return np.concatenate([array, np.zeros(2 * size - len(array), array.dtype)])


class Encoder:
    """`encode` gives the ids of several texts, one after the other, and the number for each.

    Unseen pieces go to the tokenizer in lines: a line end is a piece of its own with an id of its own.
    """

    def __init__(self, path: str | None = None, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        self.tokenizer = Tokenizer.from_file(path or default_tokenizer())
        if self.tokenizer.normalizer is not None or not isinstance(self.tokenizer.pre_tokenizer, ByteLevel):
            raise ValueError("not a byte-level tokenizer of the text as it is")
        # words after a space need no pre-tokenizer: this one only parts them, and their first ids are known by the space
        self.model = Tokenizer.from_file(path or default_tokenizer())
        self.model.pre_tokenizer = Sequence([Split(" ", "merged_with_next"), ByteLevel(add_prefix_space=False, use_regex=False)])
        names = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(names.values()) + 1, bool)
        self.spaced[[number for name, number in names.items() if name[0] == "\u0120"]] = True
        self.remembered = remembered
        (self.line_end,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.first, self.later = _Pieces("", self), _Pieces(" ", self)
        self._queues()
        # number 0 is the line end
        self.flat, self.begin, self.length, self.met = np.array([self.line_end], np.uint32), *(np.array([x], np.int32) for x in (0, 1, 0))
        self.size = self.learned = self.filled = 1

    def _forget(self) -> None:
        """Keep the pieces that were met most often, half of what is remembered at most, under new numbers."""
        met, most = self.met[: self.size], max(1, self.remembered // 2)
        keep = met > np.partition(met, -most)[-most]
        keep[0] = True
        numbers = np.flatnonzero(keep)
        self.flat = _expanded(numbers, self.flat, self.begin, self.length)
        self.length = self.length[numbers]
        self.begin = np.cumsum(self.length, dtype=np.int32) - self.length
        self.met = met[numbers] >> 1  # what was frequent long ago gives way
        self.size = self.learned = len(numbers)
        self.filled = len(self.flat)
        renamed = np.where(keep, np.cumsum(keep) - 1, -1).tolist()
        for name in ("first", "later"):
            known = getattr(self, name)
            setattr(self, name, _Pieces(known.prefix, self, ((p, renamed[n]) for p, n in known.items() if n >= 0 and renamed[n] >= 0)))

    def _queues(self) -> None:
        self.words, self.lines, self.odd, self.pairs, self.breaks = (([], []) for _ in range(5))

    def numbered(self, queue: tuple[list, list], what) -> int:
        queue[0].append(self.size)
        queue[1].append(what)
        self.size += 1
        return self.size - 1

    def _learn(self) -> None:
        if self.learned == self.size:
            return
        self.begin, self.length, self.met = (_room(x, self.size) for x in (self.begin, self.length, self.met))
        self.learned = self.size
        numbers, texts = self.words
        if texts:
            blocks = ["".join(texts[k : k + _BLOCK]) for k in range(0, len(texts), _BLOCK)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(blocks, add_special_tokens=False)])
            begin = np.flatnonzero(self.spaced[ids])
            self._add(numbers, ids, np.diff(begin, append=len(ids)))
        numbers, texts = self.lines
        if texts:
            blocks = ["\n".join(texts[k : k + _BLOCK]) + "\n" for k in range(0, len(texts), _BLOCK)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(blocks, add_special_tokens=False)])
            word = ids != self.line_end
            self._add(numbers, ids[word], np.diff(np.flatnonzero(~word), prepend=-1) - 1)
        numbers, texts = self.odd
        if texts:
            ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self._add(numbers, np.concatenate(ids), np.array([len(x) for x in ids]))
        for numbers, parts in (self.pairs, self.breaks):  # a line may begin with a pair
            if parts:
                parts = np.array(parts)
                self._add(numbers, _expanded(parts.ravel(), self.flat, self.begin, self.length), self.length[parts].sum(axis=1))
        self._queues()

    def _add(self, numbers: list[int], ids: np.ndarray, length: np.ndarray) -> None:
        self.flat = _room(self.flat, self.filled + len(ids))
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.begin[numbers] = self.filled + np.cumsum(length) - length
        self.length[numbers] = length
        self.filled += len(ids)

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number of ids of each text; an empty text, or a null, has none."""
        if self.size > self.remembered:
            self._forget()
        texts = strings(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        sizes = pc.list_value_length(cut).to_numpy().astype(np.int64)
        pieces = cut.flatten().dictionary_encode()
        entries, distinct = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary
        begin = np.cumsum(sizes) - sizes
        inner = np.bincount(entries, minlength=len(distinct))
        inner -= np.bincount(entries[begin], minlength=len(distinct))
        # an entry is a number and that of a mark after it, or 0: first those of distinct pieces, then of the texts' first pieces, then of odd texts
        number, mark = self._entries(distinct, np.flatnonzero(inner))
        own = np.fromiter(map(self.first.__getitem__, distinct.take(pa.array(entries[begin])).to_numpy(zero_copy_only=False)), np.int64, len(texts))
        entries[begin] = len(number) + np.arange(len(texts))
        number = np.concatenate([number, own])
        odd = np.flatnonzero(np.logical_or.reduceat(number[entries] < 0, begin))
        if len(odd):
            split, more = np.split(entries, begin[1:]), []
            for k, text in zip(odd.tolist(), texts.take(pa.array(odd)).to_numpy(zero_copy_only=False)):
                at = len(number) + len(more)
                more.extend([self._number(piece) for piece in _CUT.split(text)] if text else [])
                split[k] = np.arange(at, len(number) + len(more))
            number = np.concatenate([number, np.array(more, np.int64)])
            entries, sizes = np.concatenate(split), np.array([len(x) for x in split])
        mark = np.concatenate([mark, np.zeros(len(number) - len(mark), np.int64)])
        self._learn()
        used = np.bincount(entries, minlength=len(number))
        number, mark = np.where(used, number, 0), np.where(used, mark, 0)
        for which, times in ((number, used), (mark, np.where(mark, used, 0))):
            self.met[: self.size] += np.bincount(which, times, self.size).astype(np.int32)
        both = np.stack([number, mark], axis=1)
        flat = _expanded(both[(both > 0) | [True, False]], self.flat, self.begin, self.length)
        length = self.length[number] + np.where(mark, self.length[mark], 0)
        upto = np.concatenate([[0], np.cumsum(length[entries], dtype=np.int64)])
        counts = np.diff(upto[np.concatenate([[0], np.cumsum(sizes)])])
        return _expanded(entries, flat, np.cumsum(length, dtype=np.int64) - length, length), counts

    def _entries(self, distinct: pa.Array, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the used ones of distinct pieces that follow a space, and of the mark that ends them; 0 is no mark."""
        number, mark = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        words, last = _words(distinct)
        plain = words[used]
        marked = used[plain & (last[used] > 0)]
        mark_number = np.zeros(128, np.int64)
        for code in np.unique(last[marked]).tolist():
            mark_number[code] = self.first[chr(code)]
        mark[marked] = mark_number[last[marked]]
        found = pc.ascii_rtrim(distinct.take(pa.array(used[plain])), "".join(_MARKS)).dictionary_encode()
        names = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.array([self.later.get(name, -2) for name in names], np.int64)
        new = np.flatnonzero(numbers < 0)
        numbers[new] = self.size + np.arange(len(new))
        self.size += len(new)
        new_names = [names[k] for k in new.tolist()]
        self.later.update(zip(new_names, numbers[new].tolist()))
        self.words[0].extend(numbers[new].tolist())
        self.words[1].extend([" " + name for name in new_names])
        number[used[plain]] = numbers[found.indices.to_numpy()]
        others = used[~plain]
        number[others] = [self.later[piece] for piece in distinct.take(pa.array(others)).to_numpy(zero_copy_only=False)]
        return number, mark

    def _number(self, piece: str) -> int:
        """Number of a piece with the white space before it; odd ones have a key that no piece of a split has."""
        if piece[0] in " \n" and len(piece) > 1:
            number = self.later[piece[1:] if piece[0] == " " else piece]
            if number >= 0 and piece[1] != "\n":
                return number
        key = " " + piece
        known = self.first
        if key not in known:
            known[key] = self.numbered(self.odd, piece)
        return known[key]


def _expanded(numbers: np.ndarray, flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The ids of numbered pieces, one after the other."""
    size = length[numbers]
    ends = np.cumsum(size, dtype=np.int64)
    places = np.repeat(begin[numbers] - (ends - size), size)
    places += np.arange(len(places))
    return flat[places]


def encoder(path: str | None = None) -> Encoder:
    """The worker's own encoder: a Python worker serves many tasks, and what it has seen stays known."""
    kept = sys.modules.setdefault("cohortloom_kept", ModuleType("cohortloom_kept")).__dict__
    path = path or default_tokenizer()
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _words(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which strings are plain letters, or those and one mark; and the code of that mark, 0 for none."""
    wide = np.int64 if pa.types.is_large_string(pieces.type) else np.int32
    _, places, data = pieces.buffers()
    if not len(pieces) or data is None:
        return np.zeros(len(pieces), bool), np.zeros(len(pieces), np.int64)
    at = np.frombuffer(places, wide)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
    data, at = np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]
    # a byte within a character counts as a letter; what begins three or four of them is none
    letter = np.concatenate([_LETTER[:128], np.ones(64, bool), np.zeros(64, bool)])[data]
    lead = np.flatnonzero((data >= 0xC0) & (data < 0xE0))
    letter[lead] = _LETTER[(data[lead] & np.uint16(0x1F)) << np.uint16(6) | data[lead + 1] & np.uint16(0x3F)]
    others = np.diff(np.concatenate([[0], np.cumsum(~letter)])[at])
    size = np.diff(at)
    last = np.where(size > 0, data[np.maximum(at[1:], 1) - 1] if len(data) else 0, 0).astype(np.int64)
    marks = np.zeros(256, bool)
    marks[[ord(x) for x in _MARKS]] = True
    marked = (others == 1) & (size > 1) & marks[last]
    return (others == 0) & (size > 0) | marked, np.where(marked, last, 0)


def strings(column: pa.Array) -> pa.Array:
    """Whole texts; null counts as empty."""
    column = column.cast(pa.string() if column.nbytes < 1 << 29 else pa.large_string())
    return column.fill_null("") if column.null_count else column
