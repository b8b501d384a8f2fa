"""Byte-level BPE by prefix-sharing trie traversal, and its decoding.

A text is cut into words as the tokenizer's pre-tokenizer cuts it. The distinct words that a
worker has not met form a trie over their bytes, which is walked depth-first. A node stands for
a prefix and carries one state: the last token of that prefix's encoding. It follows from the
states above it: the last token is the one token t that the prefix ends with and that fits behind
the last token of the prefix without t. The tokens that a prefix ends with are those of its longest
end that some token starts with, so they are found byte by byte and remembered. So a prefix that
many words share is encoded once, and a word's ids are read off the chain of last tokens from its
node to the root. The trie is held as its sorted words and the path of the walk, so that it needs
no memory beside the words.

Two tokens fit if merging their joined bytes leaves the boundary between them alone. Merges come
in the order of their ranks, from the left among equals, so only the pieces that lie at the
boundary in the course of merging count: the right-hand parts of the first token and the left-hand
parts of the second one. Both are walked back from the whole tokens to single bytes; a merge of two
such neighbours that comes before either is used up breaks the boundary. This needs vocabularies
where each token has one merge and parts are made before what is made of them (checked).

Decoding maps ids to bytes and the bytes to text, invalid UTF-8 to U+FFFD.

Defined cases: a null or empty text has no ids; the strings of added tokens have these tokens' ids;
repeated rows are rows of the result; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Collection, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_batches, worker_memory
from .tokenize import _BYTE_LETTERS, _LETTERS_SIGNS, _LINE, _SIGNS, byte_level_pieces, cut_alone, distinct_pieces, laid_out

# Byte-level letter -> byte: most bytes stand for the Latin-1 letter of their own number.
BYTE_OF = {_BYTE_LETTERS.get(b, chr(b)): b for b in range(256)}
MOST_BYTES = 96 << 20  # of remembered pieces
MOST_PAIRS = 1 << 19  # remembered answers of ``fits``, and of ``go``
NEVER = 1 << 62
ID_BYTES = 4


class Vocabulary:
    """Tokens by their bytes, the split of each token and the rank of the merge that makes it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        flags = any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        if model["type"] != "BPE" or not plain or flags or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        letters = BYTE_OF
        ids = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.table = pa.array(self.bytes_of, pa.large_binary())
        self.sizes = [len(b) for b in self.bytes_of]
        self.left, self.right, self.made = [-1] * size, [-1] * size, [-1] * size
        self.rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            i, pair = ids[a + b], (ids[a], ids[b])
            if self.made[i] >= 0 or max(self.made[pair[0]], self.made[pair[1]]) >= rank:
                raise ValueError("a token with two merges, or made of a later one")
            self.rank[pair] = self.made[i] = rank
            self.left[i], self.right[i] = pair
        known = {i for i in ids.values() if i not in self.added.values()}
        self.token_of = {self.bytes_of[i]: i for i in known if self.made[i] >= 0 or len(self.bytes_of[i]) == 1}
        if any(bytes([b]) not in self.token_of for b in range(256)):
            raise ValueError("a byte without a token")
        self._sound: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        # Numbered starts of tokens, as far as met: the start, and the tokens that it ends with and
        # their sizes, longest first.
        self.starts = {t[:n] for t in self.token_of for n in range(1, len(t) + 1)}
        self.number: dict[bytes, int] = {b"": 0}
        self.start_of: list[bytes] = [b""]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.steps: dict[int, int] = {}

    def _apart(self, a: int, b: int, whole: bool) -> bool:
        """Whether no merge crosses the boundary of a and b; with ``whole`` the merge of a and b
        themselves counts as well."""
        rank, made, used_a, used_b = self.rank, self.made, NEVER, NEVER
        while True:
            if whole:
                r = rank.get((a, b))
                # Among equal merges the left one comes first.
                if r is not None and r < used_a and r <= used_b:
                    return False
            whole = True
            if made[a] > made[b]:
                used_a, a = made[a], self.right[a]
            elif made[b] >= 0:
                used_b, b = made[b], self.left[b]
            else:
                return True

    def sound(self, t: int) -> bool:
        """Whether a token's own bytes are encoded as that token."""
        if self.made[t] < 0:
            return True
        if t not in self._sound:
            a, b = self.left[t], self.right[t]
            self._sound[t] = self.sound(a) and self.sound(b) and self._apart(a, b, False)
        return self._sound[t]

    def fits(self, a: int, b: int) -> bool:
        """Whether the encoding of a's and b's bytes is a, b; remembered in ``pairs``."""
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        known = self.pairs[a << 32 | b] = self.sound(b) and self._apart(a, b, True)
        return known

    def go(self, start: int, byte: int) -> int:
        """The longest start of a token that a text ends with, by number, after one more byte;
        remembered in ``steps``."""
        if len(self.steps) >= MOST_PAIRS:
            self.steps.clear()
        end = self.start_of[start] + bytes([byte])
        while end not in self.starts:
            end = end[1:]
        if end not in self.number:
            self.number[end] = len(self.start_of)
            self.start_of.append(end)
            tokens = ((self.token_of.get(end[i:]), len(end) - i) for i in range(len(end)))
            self.ends.append([(t, n) for t, n in tokens if t is not None])
        to = self.steps[start << 8 | byte] = self.number[end]
        return to

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids (little-endian 32-bit) of distinct words, by one depth-first walk of their trie.
        Sorted words are the trie's paths in that order: each leaves the path of the one before it
        at the node of their common prefix, and the states down to there are kept. Of the path,
        ``last[i]`` is the last token of the first i bytes, ``starts[i]`` the number of the longest
        start of a token that they end with."""
        out: dict[bytes, bytes] = {}
        size, number, ends = self.sizes, int.from_bytes, self.ends
        step, known = self.steps.get, self.pairs.get
        before, last, starts = b"", [-1], [0]
        for word in sorted(words):
            n = min(len(before), len(word))
            end = n - ((number(before[:n]) ^ number(word[:n])).bit_length() + 7 >> 3)
            del last[end + 1 :], starts[end + 1 :]
            start = starts[end]
            for byte in word[end:]:
                end += 1
                to = step(start << 8 | byte)
                start = self.go(start, byte) if to is None else to
                for t, n in ends[start]:
                    if n == end:
                        if self.sound(t):
                            break
                    else:
                        fit = known(last[end - n] << 32 | t)
                        if fit or (fit is None and self.fits(last[end - n], t)):
                            break
                last.append(t)
                starts.append(start)
            # The chain of last tokens from the word's node to the root.
            ids = []
            while end:
                t = last[end]
                ids.append(t)
                end -= size[t]
            ids.reverse()
            out[word] = array("i", ids).tobytes()
            before = word
        return out

    def decode_bytes(self, ids) -> bytes:
        """Bytes of ids; ids that are no token's are skipped."""
        size, table = len(self.bytes_of), self.bytes_of
        return b"".join([table[i] for i in ids if 0 <= i < size])

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decode_runs(self, ids: pa.Array, offsets: np.ndarray) -> list[str]:
        """Texts of runs of tokens' ids, from each offset to the next one."""
        _, ends, data = self.table.take(ids).buffers()
        bounds, data = np.frombuffer(ends, np.int64)[offsets].tolist(), memoryview(data)
        return [str(data[a:b], "utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class TrieEncoder:
    """Ids of whole texts. Pieces are what lies between blanks and line ends where the
    pre-tokenizer cuts in any case; each distinct piece is cut into words and encoded once, and
    remembered within ``MOST_BYTES``."""

    def __init__(self, path: str, most_bytes: int = MOST_BYTES):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        self.cut_words = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.most, self.held = most_bytes, 0
        # Two generations: when the newer one has its share it becomes the older one, from which
        # pieces still in use are taken over.
        self.heads: dict[str, bytes] = {}  # first pieces of texts
        self.rest: dict[str, bytes] = {}  # pieces behind a blank or, marked, a line end
        self.old_heads: dict[str, bytes] = {}
        self.old_rest: dict[str, bytes] = {}

    def words(self, piece: str, lead: str) -> list[bytes]:
        """The pre-tokenizer's words of a piece."""
        line = []
        if lead and piece[:1] == _SIGNS:
            return [piece[1:].encode()]
        if lead and piece[:1] == _LINE:
            lead, piece, line = "", piece[1:], [b"\n"]
        if piece.isalpha():
            return [*line, (lead + piece).encode()]
        if (found := _LETTERS_SIGNS.fullmatch(piece)) and found[1].isalpha():
            return [*line, (lead + found[1]).encode(), *([found[2].encode()] if found[2] else [])]
        return [bytes([BYTE_OF[c] for c in w]) for w, _ in self.cut_words(("\n" if line else lead) + piece)]

    def learn(self, heads: Collection[str], rest: Collection[str]) -> None:
        """Encode distinct pieces that are not remembered, all their words in one trie."""
        if self.held > self.most // 2:
            self.old_heads, self.old_rest = self.heads, self.rest
            self.heads, self.rest, self.held = {}, {}, 0
        new = []
        for known, older, found, lead in ((self.heads, self.old_heads, heads, ""), (self.rest, self.old_rest, rest, " ")):
            for piece in found:
                if piece in known:
                    continue
                v = older.get(piece)
                if v is None:
                    new.append((known, piece, self.words(piece, lead)))
                else:
                    known[piece] = v
                    self.held += 2 * len(piece) + len(v) + 200
        ids = self.vocabulary.encode_words({w for _, _, words in new for w in words})
        for known, piece, words in new:
            known[piece] = v = ids[words[0]] if len(words) == 1 else b"".join([ids[w] for w in words])
            self.held += 2 * len(piece) + len(v) + 200

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers. Texts without added tokens and longer
        runs of white space are cut together."""
        if not texts:
            return []
        column = pa.array([text or "" for text in texts], pa.string())
        parts: list[list] = []  # of a text: added-token ids, and cut texts between them
        together: list[int] = []
        heads: set[str] = set()
        rest: set[str] = set()
        for i, (text, single) in enumerate(zip(texts, cut_alone(column), strict=True)):
            mine: list = []
            between = [text or ""] if self.special is None else self.special.split(text or "")
            if not single and len(between) == 1:
                together.append(i)
                between = []
            for j, piece in enumerate(between):
                if j % 2:
                    mine.append(array("i", [self.vocabulary.added[piece]]).tobytes())
                elif piece:
                    cut = byte_level_pieces(piece)
                    heads.add(cut[0])
                    rest.update(cut[1:])
                    mine.append(cut)
            parts.append(mine)
        pieces, places, firsts = distinct_pieces(column.take(together)) if together else ([], None, None)
        self.learn(heads, rest.union(pieces) if rest else pieces)
        out, head, tail = [], self.heads, self.rest.__getitem__
        for mine in parts:
            found = []
            for cut in mine:
                if isinstance(cut, bytes):
                    found.append(cut)
                else:
                    found.append(head[cut[0]])
                    found.extend(map(tail, cut[1:]))
            out.append(b"".join(found))
        if together:
            for i, ids in zip(together, laid_out(list(map(tail, pieces)), places, firsts, ID_BYTES), strict=True):
                out[i] = ids
        return out


def _encoder(path: str) -> TrieEncoder:
    memory = worker_memory(("bpe_trie", path))
    if "encoder" not in memory:
        memory["encoder"] = TrieEncoder(path)
    return memory["encoder"]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of whole texts."""
    return recode_documents(docs, path).select("doc_id", "ids")


def recode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string): the ids of whole texts, and the text that these
    ids decode to."""

    def recode(batches):
        enc = _encoder(path)
        for batch in small_batches(batches, most_bytes=8 << 20):
            data = enc.encode(batch.column("text").to_pylist())
            offsets = np.zeros(len(data) + 1, dtype=np.int32)
            np.cumsum([len(x) >> 2 for x in data], out=offsets[1:])
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(data))])
            decoded = enc.vocabulary.decode_runs(values, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return map_batches(_rows(docs), recode, "doc_id bigint, ids array<int>, decoded string")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, decoded) of (doc_id, ids array<int>); null ids are none."""

    def decode(batches):
        enc = _encoder(path)
        for batch in batches:
            texts = [enc.vocabulary.decode(i for i in ids or () if i is not None) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return map_batches(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")), decode,
                       "doc_id bigint, decoded string")


def recoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return recode_documents(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
