"""Language identification by cross-parsing with suffix automata.

Per language, labelled text becomes a suffix automaton. A text is parsed against it greedily:
each phrase is the longest stretch, from where the last one ended, that occurs in the
language's text. Few phrases mean that the text is made of that language's material. The rate
(phrases * log2(n) / symbols, n the symbols learned from: Ziv and Merhav's cross-parsing
entropy) is lowest for the predicted language.

Texts are parsed whole, in blocks of ``BLOCK`` symbols, many blocks at a time: the automaton is
a table, and one step moves every block by one symbol.

Symbols are the UTF-8 bytes of the lower-cased text; what is not a letter in ASCII is one
blank, runs of blanks are one. Learning uses a bounded sample: up to ``SAMPLE_ROWS`` labelled
rows a language, those with the smallest hash of doc_id, ``SAMPLE_SYMBOLS`` symbols in all.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text
where nothing was learned; ties go to the first language by code point; a null doc_id is not
held out and not learned from; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, small_batches

UNDETERMINED = "und"
SAMPLE_ROWS = 64  # labelled rows a language, at most
SAMPLE_SYMBOLS = 24_000  # symbols a language, at most
BLOCK = 512
SHARPNESS = 8.0

_LETTER = re.compile(r"[^\W\d_]")
_BLANK = ord(" ")
# ASCII letters stay, other ASCII is a blank, bytes of other characters stay.
_FOLD = np.array([b if b >= 128 or chr(b).isalpha() else _BLANK for b in range(256)], dtype=np.uint8)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def symbols_of(text: str) -> np.ndarray:
    """The text's symbols as bytes."""
    folded = _FOLD[np.frombuffer(text.lower().encode(), dtype=np.uint8)]
    blank = folded == _BLANK
    return folded[~(blank & np.r_[False, blank[:-1]])]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    nexts: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for s in symbols:
        new = len(nexts)
        nexts.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and s not in nexts[p]:
            nexts[p][s] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][s]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                link[q] = link[new] = clone
                while p >= 0 and nexts[p].get(s) == q:
                    nexts[p][s] = clone
                    p = link[p]
        last = new
    return nexts


class CrossParser:
    """Cross-parsing of many texts against the samples of several languages."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        known = sorted({b for s in samples.values() for b in s})
        width = len(known) + 1  # 0: a byte that no sample has
        self.symbol = np.zeros(256, dtype=np.int32)
        self.symbol[known] = np.arange(1, width)
        self.flag = np.int32(1 << 30)
        self.tables, self.cost = [], []
        for language in self.languages:
            sample = samples[language]
            nexts = suffix_automaton(self.symbol[np.frombuffer(sample, dtype=np.uint8)].tolist())
            # A symbol that the sample lacks is a phrase of its own: from the state after it (the
            # last one) every symbol starts a phrase.
            root = np.full(width, len(nexts) * width, dtype=np.int32)
            for s, to in nexts[0].items():
                root[s] = to * width
            # No transition: a phrase ends (flag) and the symbol starts the next one.
            table = np.tile(root | self.flag, (len(nexts) + 1, 1))
            table[0] = root
            for state, edges in enumerate(nexts):
                for s, to in edges.items():
                    table[state, s] = to * width
            self.tables.append(table.reshape(-1))
            self.cost.append(np.log2(len(sample) + 1))

    def rates(self, texts: list[np.ndarray]) -> np.ndarray:
        """Rate per text (rows) and language (columns) of non-empty symbol arrays."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        first = np.cumsum(np.r_[0, sizes[:-1]])
        turn = np.arange(len(owner)) - np.repeat(np.cumsum(np.r_[0, blocks[:-1]]), blocks)
        start = first[owner] + turn * BLOCK
        length = np.minimum(BLOCK, sizes[owner] - turn * BLOCK)
        order = np.argsort(-length, kind="stable")
        data = self.symbol[np.concatenate(texts)]
        start, length, owner = start[order], length[order], owner[order]
        alive = np.searchsorted(-length, -np.arange(BLOCK), side="left")  # blocks longer than t
        phrases = np.ones((len(self.tables), len(owner)), dtype=np.int32)
        states = np.zeros((len(self.tables), len(owner)), dtype=np.int32)
        mask = self.flag - np.int32(1)
        for t in range(int(length.max(initial=0))):
            n = int(alive[t])
            column = data[start[:n] + t]
            for k, table in enumerate(self.tables):
                to = table[states[k, :n] + column]
                phrases[k, :n] += to >> 30
                states[k, :n] = to & mask
        out = np.zeros((len(texts), len(self.tables)))
        for k in range(len(self.tables)):
            out[:, k] = np.bincount(owner, weights=phrases[k], minlength=len(texts)) * self.cost[k] / sizes
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (its share of rate ** -SHARPNESS) of each text."""
        found, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.languages else []
        if at:
            rates = self.rates([symbols_of(texts[i]) for i in at])
            best = rates.argmin(axis=1)
            share = (rates.min(axis=1, keepdims=True) / rates) ** SHARPNESS
            score[at] = 1.0 / share.sum(axis=1)
            for i, k in zip(at, best.tolist(), strict=True):
                found[i] = self.languages[k]
        return found, score


def equal_parts(sizes: list[int], most: int) -> list[int]:
    """Parts of ``most`` for rows of these sizes: equal ones, with what short rows leave handed on."""
    parts = [0] * len(sizes)
    for done, i in enumerate(sorted(range(len(sizes)), key=sizes.__getitem__)):
        parts[i] = min(sizes[i], most // (len(sizes) - done))
        most -= parts[i]
    return parts


def language_samples(docs: DataFrame, held_out: Column, rows: int = SAMPLE_ROWS,
                     symbols: int = SAMPLE_SYMBOLS) -> dict[str, bytes]:
    """Bounded samples of labelled text by language, from rows that are not held out; every picked
    row with a letter has its part."""
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out)
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    picked = (
        usable.select("lang", "doc_id", F.xxhash64("doc_id").alias("_h"))
        .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= rows).select("doc_id").distinct()
    )
    ids = sorted(r["doc_id"] for r in picked.collect())
    texts = usable.where(F.col("doc_id").isin(ids)).select("lang", "doc_id", F.substring("text", 1, symbols).alias("t"))
    found: dict[str, list[bytes]] = {}
    for r in sorted(texts.collect(), key=lambda r: (r["lang"], r["doc_id"], r["t"])):
        if _LETTER.search(r["t"]):
            found.setdefault(r["lang"], []).append(b" " + symbols_of(r["t"]).tobytes())
    return {
        lang: b"".join(t[:n] for t, n in zip(own, equal_parts([len(t) for t in own], symbols), strict=True))
        for lang, own in found.items()
    }


_PARSERS: dict[int, CrossParser] = {}


def _parser(samples: dict[str, bytes]) -> CrossParser:
    """This worker's parser, built once from the broadcast samples."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = CrossParser(samples)
    return _PARSERS[key]


def identify(docs: DataFrame, samples: dict[str, bytes], held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text. ``samples`` is bounded by
    languages * SAMPLE_SYMBOLS and is broadcast; each worker builds the automata once."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def predict(batches):
        parser = _parser(shared.value)
        for batch in small_batches(batches):
            found, score = parser.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return map_batches(rows, predict, "doc_id bigint, held_out boolean, lang_pred string, score double")
