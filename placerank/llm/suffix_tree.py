"""Language-model scoring with a probabilistic suffix tree over words.

Symbols are the words of the training documents, one end per text, and the words that were not
met. A state is a context of up to ``DEPTH`` symbols before the next one; the end of the text
before opens a text. A context is kept as a state if

* it has at least a share of 1 / (``STATES`` x cube root of the training symbols) of them (Ron,
  Singer and Tishby's lower bound of a state's probability), and
* its next-symbol distribution diverges from that of the next shorter state: the log likelihood
  it gains on its own counts beats half its number of parameters times log(count).

In a state, next symbols that make a sequence of that share have a count of their own, smoothed
with ``PRIOR`` pseudo-counts of the shorter state; all others share what is left in proportion to
the shorter state, so that every distribution sums to one. The root has every word of the
training documents, by its count, and leaves the unmet the share of words met once (Good and
Turing). That mass is spread over spellings: a chain of bytes up to the word's end, counted over
the distinct training words, so that a text's score is the log10 of a probability (spellings of
met words keep theirs unused: all texts together have at most one). A symbol is scored in the
state of its longest kept suffix.

All counts cover all training documents: words first, then pairs of frequent words, then longer
sequences whose parts are frequent, read from a table of word numbers that is written once. The
tree grows with the cube root of the corpus, STATES x that root being the most sequences of each
length that can have the share: a bound of 20 million at 10^13 symbols, where the tree is still a
broadcast. The root's counts grow with the vocabulary: those of frequent words are broadcast,
those of all other words are joined with each document's words. The unigram base comes from the
same counts.

Defined cases: a null or empty text is the end alone; repeated rows are documents of their own;
a null doc_id is neither held out nor learned from; without training documents nothing is known,
half of the root is the end's and every word is an unmet one of evenly likely bytes; an empty
table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_words_of, map_batches, mix64, raw_texts, small_batches, written

DEPTH = 4
STATES = 800.0  # times the cube root of the training symbols: most sequences of a length
PRIOR = 2.0
SHIFT = 31  # bits of a word number
MOST_REMEMBERED = 300_000
MOST_ROWS = 1 << 16  # of a batch of counts
MOST_SCORED = 1 << 20  # bytes of texts that are scored at a time
EDGE = 256  # before and after a word's bytes
PAIRS = (EDGE + 1) ** 2


def spelling_pairs(words: list[bytes]):
    """Places in the table of byte pairs, and the word of each, for all steps from a word's start
    to its end; a megabyte at a time."""
    data = np.frombuffer(b"\n".join([b"", *words, b""]), dtype=np.uint8)  # no word has a line end
    word = -1
    for at in range(0, len(data) - 1, 1 << 20):
        symbols = data[at : at + (1 << 20) + 1].astype(np.int64)
        edge = symbols == 10
        symbols[edge] = EDGE
        owner = word + np.cumsum(edge[:-1])
        word = int(owner[-1])
        yield symbols[:-1] * (EDGE + 1) + symbols[1:], owner


def spelling_log10(counts: np.ndarray) -> np.ndarray:
    """log10 probabilities of byte pairs from their counts, half a count added to every byte that a
    lower-cased word can hold; a word has at least one byte."""
    can = np.ones(EDGE + 1, dtype=bool)
    can[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, *range(ord("A"), ord("Z") + 1)]] = False
    table = counts.reshape(EDGE + 1, EDGE + 1) + 0.5 * can
    table[EDGE, EDGE] = 0.0
    with np.errstate(divide="ignore"):
        return np.log10(table / table.sum(axis=1, keepdims=True)).ravel()


class LongTable:
    """Positions of 64-bit keys: open addressing, looked up for many keys at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.int64)
        self.at = np.full(1 << self.bits, -1, dtype=np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.at[slot] < 0
            where, first = np.unique(slot[free], return_index=True)
            took = np.flatnonzero(free)[first]
            self.at[where], self.keys[where] = left[took], keys[left[took]]
            stay = np.ones(len(left), dtype=bool)
            stay[took] = False
            left, slot = left[stay], (slot[stay] + 1) & (len(self.at) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among those given at first, -1 where there is none."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys) if len(keys) else None
        while len(left):
            at = self.at[slot]
            hit = (at >= 0) & (self.keys[slot] == keys[left])
            out[left[hit]] = at[hit]
            go = (at >= 0) & ~hit
            left, slot = left[go], (slot[go] + 1) & (len(self.at) - 1)
        return out


class SuffixTree:
    """Frequent words are numbered from 1 (0: any other), the end is the last number. Sequences
    of k + 1 words that are frequent are numbered from 1 by level k: ``tables[k - 1]`` finds them
    by (number of their first k words, last word). ``logp[k - 1]`` is the log10 probability of
    the last word in the state of the first k (by number, 0: not a state), ``rest[k - 1]`` the
    factor of the shorter state's distribution in a state of k words (nan: not a state)."""

    def __init__(self, words: list[bytes], counts: list[int], n_docs: int, n_tokens: int, n_distinct: int, n_once: int,
                 spelling: np.ndarray | None = None):
        self.number = {w: i + 1 for i, w in enumerate(words)}
        self.end = len(words) + 1
        self.met = n_distinct > 0
        self.unmet = min(0.5, max(n_once, 1) / (n_tokens + n_distinct + 1)) if self.met else 0.5
        self.space = n_tokens + n_distinct
        self.spelling = spelling_log10(np.zeros(PAIRS) if spelling is None else spelling)
        self.counts = np.array([0, *counts, n_docs], dtype=np.int64)
        self.root = np.zeros(len(words) + 2)  # of a rare word: the join adds it
        self.root[1:] = np.log10((1 - self.unmet) * (self.counts[1:] + 1) / self.space) if self.met else 0.0
        if not n_docs:
            self.root[self.end] = math.log10(self.unmet)
        self.tables: list[LongTable] = []
        self.sequences: list[np.ndarray] = []  # words of the sequences, by level
        self.totals: list[np.ndarray] = [self.counts]  # occurrences by number, by length - 1
        self.shorter: list[np.ndarray] = [np.zeros(len(words) + 2, dtype=np.int64)]  # number without the first word
        self.logp: list[np.ndarray] = []
        self.rest: list[np.ndarray] = []

    def spelled(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of words' spellings."""
        out = np.zeros(len(words))
        for pair, owner in spelling_pairs(words) if words else ():
            first = int(owner[0])
            sums = np.bincount(owner - first, weights=self.spelling[pair])
            out[first : first + len(sums)] += sums
        return out

    def numbered(self, bags: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of texts in a row, an end before the first and after each, and the place
        of each text's end."""
        get = self.number.get
        ids = [self.end]
        ends = []
        for words in bags:
            ids += [get(w, 0) for w in words]
            ends.append(len(ids))
            ids.append(self.end)
        return np.array(ids, dtype=np.int64), np.array(ends, dtype=np.int64)

    def walk(self, ids: np.ndarray):
        """Per level k from 1: for each place but the first, the number of the context of k
        words before it, and the number of the sequence that it ends (0: not frequent)."""
        context = ids[:-1].copy()
        for table in self.tables:
            entry = np.zeros(len(ids) - 1, dtype=np.int64)
            at = np.flatnonzero((context > 0) & (ids[1:] > 0))
            entry[at] = table.find((context[at] << SHIFT) | ids[1:][at]) + 1
            yield context, entry
            # The sequence before a place is the context of the next; an end closes all.
            context = np.r_[0, np.where(ids[1:-1] == self.end, 0, entry[:-1])]

    def candidates(self, ids: np.ndarray) -> np.ndarray:
        """Sequences one word longer than the longest numbered ones, as (context, word), whose
        parts are frequent."""
        context, ending = ids[:-1], ids[1:]
        for _, entry in self.walk(ids):
            context = np.r_[0, np.where(ids[1:-1] == self.end, 0, entry[:-1])]
            ending = entry
        at = np.flatnonzero((context > 0) & (ids[1:] > 0) & (ending > 0))
        return (context[at] << SHIFT) | ids[1:][at]

    def add_level(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Number the frequent sequences (codes ascending) of the next length, and decide which
        of the contexts they continue are states."""
        k = len(self.tables) + 1
        before, last = codes >> SHIFT, codes & ((1 << SHIFT) - 1)
        # Without its first word: the shorter context's number, then the same last word.
        if k == 1:
            shorter = last.copy()
        else:
            up = self.shorter[k - 1][before]
            shorter = self.tables[k - 2].find((up << SHIFT) | last) + 1
        total = self.totals[k - 1]
        parent = 10.0 ** self.log10_next(k - 1, self.shorter[k - 1][before], last)
        n = total[before].astype(np.float64)
        size = len(total)
        given = np.bincount(before, weights=counts, minlength=size)
        mass = np.bincount(before, weights=parent, minlength=size)
        own = np.bincount(before, minlength=size)
        left, left_parent = np.maximum(total - given, 0.5), np.maximum(1 - mass, 1e-12)
        gain = np.bincount(before, weights=counts * np.log(counts / n / parent), minlength=size)
        gain += left * np.log(left / np.maximum(total, 1) / left_parent)
        state = (own > 0) & (gain > 0.5 * own * np.log(np.maximum(total, 2)))
        p = (counts + PRIOR * parent) / (n + PRIOR)
        used = np.bincount(before, weights=p, minlength=size)
        rest = np.where(state, np.log10(np.maximum(1 - used, 1e-12) / left_parent), np.nan)
        self.tables.append(LongTable(codes))
        self.totals.append(np.r_[0, counts])
        self.shorter.append(np.r_[0, shorter])
        self.logp.append(np.r_[0.0, np.log10(p)])
        self.rest.append(rest)

    def log10_next(self, k: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 probability of words after contexts of k words (numbers)."""
        out = np.zeros(len(word))
        left = np.arange(len(word))
        for level in range(k, 0, -1):
            here = left[context[left] > 0]
            factor = self.rest[level - 1][context[here]]
            here, factor = here[~np.isnan(factor)], factor[~np.isnan(factor)]
            entry = self.tables[level - 1].find((context[here] << SHIFT) | word[here]) + 1
            out[here] += np.where(entry > 0, self.logp[level - 1][entry], factor)
            done = np.zeros(len(word), dtype=bool)
            done[here[entry > 0]] = True
            left = left[~done[left]]
            context = np.where(context > 0, self.shorter[level - 1][context], 0) if level > 1 else context
        out[left] += self.root[word[left]]
        return out

    def score(self, ids: np.ndarray) -> np.ndarray:
        """log10 probability of every symbol but the first; a rare word's root is left out."""
        out = np.zeros(len(ids) - 1)
        open_ = np.ones(len(ids) - 1, dtype=bool)
        for level, (context, entry) in reversed(list(enumerate(self.walk(ids)))):
            factor = self.rest[level][context]
            at = open_ & (context > 0) & ~np.isnan(factor)
            hit = at & (entry > 0)
            out[hit] += self.logp[level][entry[hit]]
            miss = at & (entry == 0)
            out[miss] += factor[miss]
            open_ &= ~hit
        out[open_] += self.root[ids[1:][open_]]
        return out

    def root_log10(self, n):
        """Column: log10 probability at the root of a word that occurs n times in training
        (null: unmet, its spelling left out)."""
        unmet = F.lit(math.log10(self.unmet))
        if not self.met:
            return unmet
        return F.when(n.isNull(), unmet).otherwise(F.log10(F.lit(1 - self.unmet) * (n + F.lit(1.0)) / F.lit(float(self.space))))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all rows of ``docs`` (text); words as bytes, A-Z lower-cased."""

    def count(batches):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
            )

        for batch in small_batches(batches):
            for text in raw_texts(batch.column("text")):
                seen.update(lower_words_of(text))
            if len(seen) > MOST_REMEMBERED:
                yield out()
                seen.clear()
        yield out()

    return map_batches(docs.select("text"), count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def pair_counts(vocabulary: DataFrame) -> np.ndarray:
    """Counts of byte pairs over the distinct words; at most ``PAIRS`` rows reach the driver."""

    def count(batches):
        total = np.zeros(PAIRS, dtype=np.int64)
        for batch in small_batches(batches, "word"):
            for pair, _ in spelling_pairs(raw_texts(batch.column("word"))):
                total += np.bincount(pair, minlength=PAIRS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["pair", "n"])

    out = np.zeros(PAIRS)
    for r in map_batches(vocabulary.select("word"), count, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out


def numbered_texts(docs: DataFrame, tree: SuffixTree) -> DataFrame:
    """(ids): word numbers of some megabytes of texts in a row, as 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(tree)

    def number(batches):
        model = shared.value
        for batch in small_batches(batches, most_bytes=1 << 20):
            ids, _ = model.numbered([lower_words_of(t) for t in raw_texts(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([pa.array([ids.astype("<i4").tobytes()], pa.binary())], names=["ids"])

    return map_batches(docs.select("text"), number, "ids binary")


def sequence_counts(numbered: DataFrame, tree: SuffixTree, least: int) -> DataFrame:
    """(code, n): sequences one word longer than the tree's, counted over all numbered texts."""
    shared = numbered.sparkSession.sparkContext.broadcast(tree)

    def count(batches):
        model = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            codes = np.concatenate([c for c, _ in held])
            order = np.argsort(codes, kind="stable")  # runs that are sorted already are merged
            codes, n = codes[order], np.concatenate([n for _, n in held])[order]
            first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
            return codes[first], np.add.reduceat(n, first)

        def out(codes, n):  # some rows at a time: the JVM holds a batch outside its heap
            for i in range(0, len(codes), MOST_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(codes[i : i + MOST_ROWS]), pa.array(n[i : i + MOST_ROWS])], names=["code", "n"])

        for batch in small_batches(batches, "ids", most_bytes=1 << 20):
            # Every row opens and closes with an end: where two meet, one is left.
            rows = [np.frombuffer(x, "<i4") for x in batch.column("ids").to_pylist()]
            ids = np.concatenate([rows[0], *(r[1:] for r in rows[1:])]).astype(np.int64)
            codes, n = np.unique(model.candidates(ids), return_counts=True)
            held.append((codes, n))
            if sum(len(c) for c, _ in held) > 2_000_000:
                held = [merged()]
                if len(held[0][0]) > 1_000_000:
                    yield from out(*held[0])
                    held = []
        if held:
            yield from out(*merged())

    rows = map_batches(numbered, count, "code bigint, n bigint")
    return rows.groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def least_count(tokens: int, share: float | None = None) -> int:
    """Occurrences that a word or sequence needs to be numbered: a share of the symbols, by
    default 1 / (``STATES`` x their cube root)."""
    return max(2, math.ceil(tokens * share if share else tokens ** (2 / 3) / STATES))


def learn(training: DataFrame, vocabulary: DataFrame, n_docs: int, depth: int = DEPTH,
          share: float | None = None) -> tuple[SuffixTree, int, int]:
    """The tree of training documents (text) and of their words (word, n); the numbers of their
    tokens and of distinct ones. What reaches the driver is bounded: 1 / share words and as many
    sequences of each length."""
    found = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                           F.count(F.when(F.col("n") == 1, 1)).alias("once")).first()
    tokens, distinct = (found["n"] or 0) + n_docs, found["v"] + (n_docs > 0)
    least = least_count(tokens, share)
    frequent = vocabulary.where(F.col("n") >= least).toPandas().sort_values("word")
    tree = SuffixTree([bytes(w) for w in frequent["word"]], frequent["n"].tolist(), n_docs, tokens, distinct,
                      found["once"], pair_counts(vocabulary))
    if not n_docs:
        return tree, tokens, distinct
    numbered = written(numbered_texts(training, tree), "numbered")
    for _ in range(depth):
        rows = sequence_counts(numbered, tree, least).toPandas().sort_values("code")
        if not len(rows):
            break
        tree.add_level(rows["code"].to_numpy(dtype=np.int64), rows["n"].to_numpy(dtype=np.int64))
    return tree, tokens, distinct


PARTS = ("uid bigint, doc_id bigint, held_out boolean, word binary, times bigint, n_tokens bigint, n_known bigint, "
         "base double, score double, spelt double")


def scored(batches, model: SuffixTree, n_docs: int, space: int, uid: int):
    """Rows as in ``PARTS``: one for each distinct rare word of a text, with its spelling's score,
    and one for the text, with the scores of all else. Texts are numbered from ``uid``. A batch's
    words take many times its bytes, so that batches are small."""
    base = np.log10((model.counts + 1) / space)
    base[0] = 0.0
    for batch in small_batches(batches, most_bytes=MOST_SCORED):
        bags = [lower_words_of(t) for t in raw_texts(batch.column("text"))]
        uids = np.arange(uid, uid + len(bags))
        uid += len(bags)
        ids, ends = model.numbered(bags)
        begins = np.r_[0, ends[:-1]]  # place 0 is the end before the first text
        known = np.add.reduceat(((ids[1:] > 0) & ((ids[1:] < model.end) | (n_docs > 0))).astype(np.int64), begins)
        low = np.add.reduceat(base[ids[1:]], begins)
        total = np.add.reduceat(model.score(ids), begins)
        rare = [Counter(w for w in bag if w not in model.number) for bag in bags]
        sizes = np.array([len(bag) + 1 for bag in bags])
        del bags
        words = [w for bag in rare for w in bag]
        yield _parts(
            uid=pa.array(np.repeat(uids, [len(bag) for bag in rare])), word=pa.array(words, pa.binary()),
            times=pa.array([n for bag in rare for n in bag.values()], pa.int64()), spelt=pa.array(model.spelled(words)),
        )
        # No word has a line end: a key of its own that meets no word.
        yield _parts(
            uid=pa.array(uids), doc_id=batch.column("doc_id"), held_out=batch.column("held_out"),
            word=pa.array([b"\n%d" % u for u in uids.tolist()], pa.binary()), n_tokens=pa.array(sizes),
            n_known=pa.array(known), base=pa.array(low), score=pa.array(total),
        )


def _parts(**columns: pa.Array) -> pa.RecordBatch:
    """Rows as in ``PARTS``: ids that are not given are null, numbers 0."""
    n = len(columns["uid"])
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
    out = {}
    for name, kind in (x.split() for x in PARTS.split(", ")):
        empty = None if name in ("doc_id", "held_out") else 0
        out[name] = columns[name] if name in columns else pa.repeat(pa.scalar(empty, kinds[kind]), n)
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def score_documents(docs: DataFrame, held_out: Column, depth: int = DEPTH, share: float | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document;
    the model learns from rows with a doc_id that are not held out."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = rows.where(F.col("doc_id").isNotNull() & ~F.col("held_out"))
    n_docs = training.count()
    vocabulary = written(word_counts(training), "vocabulary")
    tree, tokens, distinct = learn(training, vocabulary, n_docs, depth, share)
    space = tokens + distinct + 1
    shared = spark.sparkContext.broadcast(tree)

    def score(batches):
        return scored(batches, shared.value, n_docs, space, TaskContext.get().partitionId() << 33)

    parts = map_batches(rows, score, PARTS)
    counts = vocabulary.select(F.col("word").alias("_word"), "n")
    joined = parts.join(counts, F.col("word") == F.col("_word"), "left")
    known = F.when(F.col("n").isNotNull(), F.col("times")).otherwise(F.lit(0))
    base = F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + F.lit(1.0)) / F.lit(float(space)))
    spelt = F.when(F.col("n").isNull(), F.col("spelt")).otherwise(F.lit(0.0))
    root = F.col("times") * (tree.root_log10(F.col("n")) + spelt)
    sums = joined.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + known).alias("n_known"), F.sum(F.col("base") + base).alias("base_score"),
        F.sum(F.col("score") + root).alias("score"),
    )
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"),
                       "base_score", "score")
