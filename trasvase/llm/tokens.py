"""Token ids of whole texts, with the pieces of a text remembered by each Python worker.

A tokenizer never merges across the places where its own pattern splits, so a text's ids are those of its pieces, one after
the other. Pieces are cut only at places that every pattern here splits: before white space, and between an ASCII letter or
digit and an ASCII sign. They are found in the bytes of many texts at once, and each distinct one is looked up once. Texts with
unusual spaces or combining marks, and texts that hold the string of a special token where those count, are encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata
from array import array
from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of memory a worker's remembered pieces may take for a tokenizer, about; longest piece that is remembered.
REMEMBERED_BYTES, LONGEST = 96 << 20, 64
#: Of it, what one piece takes beside its characters and ids.
_EACH = 150
#: Text handled at once, in bytes.
SLICE_BYTES = 4 << 20

#: Not plain: apostrophes and underscores (they join words in some patterns), odd spaces, a letter whose small form is two
#: characters, and all beyond Latin.
_NOT_PLAIN = re.compile("['_\x1c-\x1f\x85\xa0\u0130\u0250-\U0010ffff]")
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BEYOND_LATIN = "[\u0250-\U0010ffff]"
_SPACED = re.compile(r"\s*\S+|\s+")
_WHITE = " \t\n\x0b\x0c\r"
#: Kinds of bytes: white space, letters and digits, signs, and those that may belong to what stands beside them. Only
#: the kinds of a letter and a sign differ by ``_CUT``.
_KINDS, _CUT = np.full(256, 4, np.uint8), 3
_KINDS[list(_WHITE.encode())] = 0
_KINDS[[c for c in range(128) if chr(c).isalnum()]] = 1
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'_"]] = 2
#: One space and then something: the piece stays apart from what stands before it.
_APART = re.compile(r" \S")
_SPACE_SIGN = "\u2581"


class Remembered:
    """Ids of pieces, encoded once while they are remembered. When they take too much, those not met
    again since they took half of it are forgotten."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.known, self.again, self.size = encode, {}, set(), 0

    def __call__(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Ids of each text, given as its pieces; what is not remembered is encoded for all texts at once."""
        distinct = set().union(*texts)
        new = self.meet(distinct)
        found = [np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), np.uint16) for pieces in texts]
        self.bound(distinct, new)
        return found

    def distinct(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of distinct pieces."""
        found = list(map(self.known.get, pieces))
        places = [k for k, ids in enumerate(found) if ids is None]
        new = self.meet([pieces[k] for k in places])
        for k, piece in zip(places, new):
            found[k] = self.known[piece]
        self.bound(pieces, new)
        return found

    def meet(self, pieces: Collection[str]) -> list[str]:
        """Encode those of distinct pieces that are not remembered; returns them."""
        new = [piece for piece in pieces if piece not in self.known]
        if new:
            self.known.update(zip(new, self.encode(new)))
            self.size += self._size(new)
        return new

    def bound(self, pieces: Collection[str], new: list[str]) -> None:
        """Forget what takes too much, after ``pieces`` were met, of which ``new`` for the first time."""
        self.forget([piece for piece in new if len(piece) > LONGEST])
        if 2 * self.size > REMEMBERED_BYTES:
            self.again.update(pieces)
            self.again.difference_update(new)
        if self.size > REMEMBERED_BYTES:
            self.known = {piece: self.known[piece] for piece in self.again}
            self.size = self._size(self.again)
            self.again = set()
            if 2 * self.size > REMEMBERED_BYTES:
                self.known, self.size = {}, 0

    def forget(self, pieces: Collection[str]) -> None:
        self.size -= self._size(pieces)
        for piece in pieces:
            del self.known[piece]

    def _size(self, pieces: Collection[str]) -> int:
        return _EACH * len(pieces) + sum(map(len, pieces)) + sum(map(len, map(self.known.__getitem__, pieces)))


def _as_bytes(ids: list[int]) -> bytes:
    return array("H", ids).tobytes()


def told_apart(ids: np.ndarray, lengths: np.ndarray, pieces: list[str]) -> list[bytes] | None:
    """The ids of each piece, of those of all as one text; None if their bytes do not end where the pieces do."""
    ends = np.cumsum([len(piece) if piece.isascii() else len(piece.encode()) for piece in pieces])
    token_ends = np.cumsum(lengths[ids])
    at = np.searchsorted(token_ends, ends)
    if not len(ids) or at[-1] != len(ids) - 1 or (token_ends[at] != ends).any():
        return None
    data, stops = ids.tobytes(), (2 * (at + 1)).tolist()
    return [data[a:b] for a, b in zip([0, *stops], stops)]


def by_kind(pieces: list[str], kinds: list[bool], ids: Callable[[list[str], bool], list[bytes]]) -> list[bytes]:
    """Ids of pieces, those of each kind by themselves."""
    held = {kind: iter(ids([piece for piece, k in zip(pieces, kinds) if k is kind], kind)) for kind in set(kinds)}
    return [next(held[kind]) for kind in kinds]


def cut(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """All pieces of texts without nulls, one after the other, and where those of each text end."""
    limits = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[limits[0] : limits[-1]] if held else np.zeros(0, np.uint8)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    limits = limits - limits[0]
    kinds = _KINDS[data]
    begins = np.empty(len(data) + 1, bool)
    np.equal(kinds[1:] ^ kinds[:-1], _CUT, out=begins[1:-1])
    begins[1:-1] |= (kinds[1:] == 0) & (kinds[:-1] != 0)
    begins[limits] = True  # the last is the end
    places = np.flatnonzero(begins).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
    return pieces, np.searchsorted(places, limits[1:])


def gathered(held: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the entries of ``held`` that ``at`` names, one after the other, and where those of each end."""
    sizes = np.fromiter(map(len, held), np.int64, len(held)) // 2
    first = np.cumsum(sizes) - sizes
    each = sizes[at]
    ends = np.cumsum(each)
    places = np.repeat(first[at] - ends + each, each)
    places += np.arange(len(places))
    return np.frombuffer(b"".join(held), np.uint16)[places], ends


class Encoder:
    """Ids of texts by one file of the tokenizers library; ids must be below 65,536.

    Strings of special tokens inside a text give their ids, as the library does, or are ordinary text if ``plain``.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.spaced = self.tokenizer.normalizer is None  # else white space is dropped and case folded
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(names.values(), default=-1) + 1, np.int64)  # bytes: a letter of a byte-level token each
        for name, i in names.items():
            self.lengths[i] = len(name.removesuffix("</w>"))
        self.pieces_of = Remembered(self.ids)

    def __call__(self, text: str | None) -> np.ndarray:
        return self.many([text])[0]

    def many(self, texts: list[str | None] | pa.StringArray) -> list[np.ndarray]:
        texts = pc.fill_null(pa.array(texts, pa.string()), "")
        whole = self.not_cut(texts)
        pieces, stops = cut(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts)
        coded = pieces.dictionary_encode()
        ids, ends = gathered(self.pieces_of.distinct(coded.dictionary.to_pylist()), coded.indices.to_numpy())
        stops = np.concatenate([[0], ends])[stops].tolist()
        return [self.whole(texts[k].as_py()) if odd else ids[a:b] for k, (a, b, odd) in enumerate(zip([0, *stops], stops, whole.tolist()))]

    def not_cut(self, texts: pa.StringArray) -> np.ndarray:
        """Which texts must be encoded whole."""
        odd = pc.match_substring_regex(texts, _ODD_SPACE.pattern).to_numpy(zero_copy_only=False)
        if self.special:
            odd = odd | pc.match_substring_regex(texts, self.special.pattern).to_numpy(zero_copy_only=False)
        if not self.spaced:
            far = pc.match_substring_regex(texts, _BEYOND_LATIN).to_numpy(zero_copy_only=False)
            odd = odd | np.array([f and not unicodedata.is_normalized("NFC", texts[k].as_py()) for k, f in enumerate(far.tolist())], bool)
        return odd

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. Pieces that stay apart in one text are encoded as one, which costs less, and told apart by their bytes."""
        if self.spaced:
            kinds = [bool(_APART.match(piece)) for piece in pieces]
        else:
            pieces = [piece.strip(_WHITE) for piece in pieces]
            kinds = [bool(piece) and not _NOT_PLAIN.search(piece) for piece in pieces]
            pieces = [piece.lower() if plain else piece for piece, plain in zip(pieces, kinds)]
        return by_kind(pieces, kinds, self._ids)

    def _ids(self, pieces: list[str], apart: bool) -> list[bytes]:
        if apart:
            (found,) = self.tokenizer.encode_batch_fast([("" if self.spaced else " ").join(pieces)], add_special_tokens=False)
            held = told_apart(np.array(found.ids, np.uint16), self.lengths, pieces)
            if held:
                return held
        return [_as_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


class PieceEncoder:
    """Ids of texts by one file of the sentencepiece library, which puts a space before a text.

    If no piece of its vocabulary goes on with a space, texts are cut before white space; those with white space that
    pieces hold are encoded whole.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.cut = not any(_SPACE_SIGN in name.lstrip(_SPACE_SIGN) for name in names)
        self.joins = re.compile("[" + _SPACE_SIGN + "".join(set("\t\n\x0b\x0c\r") & set("".join(names))) + "]")
        self.before_line = len(self.model.encode("\n"))  # ids of the space put first and of a line end
        self.pieces_of = Remembered(self.ids)

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as it stands inside a text."""
        held = {" ": [self.model.piece_to_id(_SPACE_SIGN)]}
        after = [piece for piece in pieces if piece[0] == " " and len(piece) > 1]
        held.update(zip(after, self.model.encode([piece[1:] for piece in after], num_threads=1)))
        for piece in pieces:
            if piece not in held:
                held[piece] = self.model.encode("\n" + piece)[self.before_line :]
        return [_as_bytes(held[piece]) for piece in pieces]

    def __call__(self, text: str | None) -> np.ndarray:
        pieces = self.pieces(text) if text else []
        return self.whole(text) if pieces is None else self.pieces_of([pieces])[0]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.uint16)

    def pieces(self, text: str) -> list[str] | None:
        """The pieces of a text with the space put before it, or None if it must be encoded whole."""
        if not self.cut or self.joins.search(text) or _NOT_PLAIN.search(text) and _ODD_SPACE.search(text):
            return None
        return _SPACED.findall(" " + text)


def held_by_worker(kind: type, *args):
    """The worker's one object of a kind for these arguments; it lives as long as the worker."""
    held = sys.modules.setdefault("_worker_objects", types.ModuleType("_worker_objects")).__dict__
    key = f"{kind.__name__} {args}"
    if key not in held:
        held[key] = kind(*args)
    return held[key]


def encoder(path: str, plain: bool = False) -> Encoder:
    return held_by_worker(Encoder, path, plain)


def line_of(texts: pa.ChunkedArray, encode: Encoder, end: int, most: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, each followed by ``end``, and how many each has with it; ``most`` bytes of text at a time."""
    ids, lengths = array("H"), []
    for some in slices(pa.record_batch({"text": texts.combine_chunks()}), most=most):
        for found in encode.many(some["text"]):
            ids.frombytes(found.tobytes())
            ids.append(end)
            lengths.append(len(found) + 1)
    return np.frombuffer(ids, np.uint16), np.array(lengths, np.int64)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about ``most`` bytes of a column; a longer value is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
