"""Token ids of whole texts with the public tokenizer files, one encoding per distinct word.

A text is cut only where its pre-tokenizer cuts in any case, so that the pieces' ids in a row
are the whole text's ids. The ids of each distinct piece are encoded once by the tokenizers
library and remembered by the worker (bounded), so the cost follows the vocabulary of the
rows that a worker sees, not their length. For a byte-level vocabulary Arrow cuts the texts of a
batch, finds its distinct pieces and lays out their ids; only texts with longer runs of white
space are cut one by one.

A text that holds the string of an added token is encoded whole by the library, which gives that
token's id.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ragged, worker_memory

LONG = 200  # characters of a piece that is remembered, at most

# A blank between two other white-space characters joins them into one run for the byte-level
# pattern, so that such a text is not cut at its blanks alone.
_ODD_ASCII = tuple(c + " " for c in " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f")
_ODD_OTHER = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] ")
_SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Stands for a line end at which a text was cut.
_LINE = "\x00"
# Stands before signs that were cut from the letter before them.
_SIGNS = "\x01"


def byte_level_pieces(text: str) -> list[str]:
    """A text cut at blanks and line ends, for a byte-level pre-tokenizer: each piece but the
    first belongs with the blank before it, or with a line end if it starts with ``_LINE``."""
    odd = any(c in text for c in _ODD_ASCII) or (not text.isascii() and _ODD_OTHER.search(text) is not None)
    if _LINE in text or _SIGNS in text:  # taken whole, as the first piece
        return [text]
    if odd or text.endswith(" "):
        return _SAFE_BLANK.split(text)
    if "\n" in text and "\n\n" not in text and " \n" not in text and text[0] != "\n" and text[-1] != "\n":
        text = text.replace("\n", " " + _LINE)
    return text.split(" ")


# Signs behind a letter, up to the end of a piece: a pre-token of their own.
_LETTER_SIGNS = r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2af}])([!-&(-/:-@\[-^{-~]+)( |\z)"
# Texts that Arrow does not cut: with three blanks or line ends in a row (of two, the pattern takes
# the first one alone and the second one with what follows; the start of a text counts as a line
# end), with two at the end, with other white space beside them or at the start, or with a mark.
_OTHER_WHITE = r"[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD_TEXT = rf"[ \n][ \n][ \n]|^[ \n][ \n]|[ \n][ \n]\z|{_OTHER_WHITE}[ \n]|[ \n]{_OTHER_WHITE}|^{_OTHER_WHITE}|[{_LINE}{_SIGNS}]"


def cut_alone(texts: pa.Array) -> list[bool]:
    """Which texts ``distinct_pieces`` does not take."""
    return pc.match_substring_regex(texts, _ODD_TEXT).to_pylist()


def distinct_pieces(texts: pa.Array) -> tuple[list[str], pa.Array, np.ndarray]:
    """The distinct pieces of texts, the place of each piece of the texts among them, and each text's
    first piece (n + 1). A text is cut at every blank and line end, and its start counts as a line
    end: its first piece has ``_LINE`` as well, so its ids begin with a line end's. Signs behind a
    word are a piece that starts with ``_SIGNS``."""
    lines = pc.binary_join_element_wise(_LINE, pc.replace_substring(texts, "\n", " " + _LINE), "")
    cut = pc.split_pattern(pc.replace_substring_regex(lines, _LETTER_SIGNS, rf"\1 {_SIGNS}\2\3"), " ")
    found = cut.flatten().dictionary_encode()
    # Pieces hold no blank: a joined string is cut into Python strings faster than they are made one by one.
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(found.dictionary)], pa.int32()), found.dictionary), " ")
    return joined[0].as_py().split(" "), found.indices, ragged(pc.list_value_length(cut).to_numpy())


def laid_out(ids: list[bytes], places: pa.Array, firsts: np.ndarray, line: int) -> list[bytes]:
    """Each text's ids from those of its distinct pieces, without the ``line`` bytes that stand for
    the line end before it."""
    _, offsets, data = pa.array(ids, pa.large_binary()).take(places).buffers()
    bounds, data = np.frombuffer(offsets, np.int64)[firsts].tolist(), memoryview(data)
    return [bytes(data[a + line : b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def word_end_pieces(text: str) -> list[bytes]:
    """Pieces of a vocabulary with word ends, where white space is dropped and letters are
    lower-cased: the words, A-Z lower-cased."""
    return text.encode().lower().split()


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for
    itself, the other bytes, in order, for the letters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(256 + i) for i, b in enumerate(other)}


_BYTE_LETTERS = _byte_letters()
# Letters (to be checked) and then ASCII signs: two pre-tokens for either cut, as long as no
# apostrophe makes more.
_LETTERS_SIGNS = re.compile(r"(\w+)([!-&(-/:-@\[-^{-~]*)")


class _Pieces(dict):
    """Piece -> ids as little-endian unsigned 32-bit integers, encoded when first met. Two
    generations bound the memory: when the newer one is full it becomes the older one, from
    which pieces still in use are taken over. Pieces beyond ``LONG`` characters are not kept."""

    def __init__(self, path: str, blank: bool, most: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.encode_special_tokens = True
        self.tokenize = self.tokenizer.model.tokenize
        self.blank, self.most, self.older = blank, most, {}
        self.signs: dict[str, bytes] = {}
        self.lead = _BYTE_LETTERS[0x20] if blank else ""
        self.line = self.alone("\n") if blank else b""

    def __missing__(self, piece) -> bytes:
        if piece[:1] == _SIGNS:
            return self._signs(piece[1:])
        if len(piece) > LONG:
            return self._encode(piece if isinstance(piece, str) else piece.decode())
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = self._encode(piece if isinstance(piece, str) else piece.decode())
        self[piece] = ids
        return ids

    def _encode(self, text: str) -> bytes:
        if text.isalpha():  # one pre-token for certain
            if self.blank:
                return self._tokens(self.lead, text)
            return self._tokens("", text) if self._settled(text) else self.alone(text)
        if self.blank and text[:1] == _LINE:
            plain = text[1:]
            if plain.isalpha():
                return self.line + self._tokens("", plain)
            found = _LETTERS_SIGNS.fullmatch(plain)
            if found and found[1].isalpha():
                return self.line + self._tokens("", found[1]) + self._signs(found[2])
            return self.alone("\n" + plain)
        # Letters and then signs: two pre-tokens for certain, and the word is often known.
        found = _LETTERS_SIGNS.fullmatch(text)
        if found and found[1].isalpha() and (self.blank or self._settled(found[1])):
            letters, signs = found.groups()
            return self[letters if self.blank else letters.encode()] + self._signs(signs)
        return self.alone(" " + text if self.blank else text)

    def _signs(self, signs: str) -> bytes:
        """Ids of one pre-token of signs."""
        ids = self.signs.get(signs)
        if ids is None:
            ids = self._tokens("", signs)
            if len(self.signs) < 10_000 and len(signs) <= LONG:
                self.signs[signs] = ids
        return ids

    @staticmethod
    def _settled(word: str) -> bool:
        """Whether the tokenizer's normal form of a word is its plain lower-case form."""
        return word.isascii() or (unicodedata.is_normalized("NFC", word) and "\u03a3" not in word and word.lower().isalpha())

    def _tokens(self, lead: str, word: str) -> bytes:
        """Ids of one pre-token."""
        if not self.blank:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array("I", [t.id for t in self.tokenize(lead + word)]).tobytes()

    def alone(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def whole(self, text: str) -> bytes:
        """Ids of a text with added tokens, as the library takes it."""
        self.tokenizer.encode_special_tokens = False
        ids = self.alone(text)
        self.tokenizer.encode_special_tokens = True
        return ids


class PieceEncoder:
    """Token ids of texts through a memory of encoded pieces. ``kind`` names the cut:
    'byte_level' or 'word_end'."""

    def __init__(self, path: str, kind: str, most: int = 350_000):
        self.blank = {"byte_level": True, "word_end": False}[kind]
        self.cut = byte_level_pieces if self.blank else word_end_pieces
        self.pieces = _Pieces(path, self.blank, most)

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Each text's ids and then ``end_id``, as little-endian unsigned 32-bit integers."""
        get, alone, special, out = self.pieces.__getitem__, self.pieces.alone, self.pieces.special, []
        end = array("I", [end_id]).tobytes()
        single, together = [True] * len(texts), []
        if self.blank and texts:
            column = pa.array([text or "" for text in texts], pa.string())
            single = cut_alone(column)
        for i, text in enumerate(texts):
            if not text:
                out.append(end)
            elif any(s in text for s in special):
                out.append(self.pieces.whole(text) + end)
            elif single[i]:
                pieces = self.cut(text)
                # Nothing stands before the first piece of a byte-level text.
                first = alone(pieces[0]) if self.blank else b""
                out.append(b"".join([first, *map(get, pieces[1:] if self.blank else pieces), end]))
            else:
                together.append(i)
                out.append(b"")
        if together:
            for i, ids in zip(together, self._together(column.take(together)), strict=True):
                out[i] = ids + end
        return out

    def _together(self, texts: pa.Array) -> list[bytes]:
        """Ids of byte-level texts that Arrow cuts: one look-up for each distinct piece."""
        pieces, places, firsts = distinct_pieces(texts)
        return laid_out(list(map(self.pieces.__getitem__, pieces)), places, firsts, len(self.pieces.line))


def encoder(path: str, kind: str) -> PieceEncoder:
    """This worker's encoder for a tokenizer file."""
    memory = worker_memory(("tokenize", path, kind))
    if "encoder" not in memory:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        memory["encoder"] = PieceEncoder(path, kind)
    return memory["encoder"]
