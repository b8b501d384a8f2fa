"""The probabilistic suffix tree: counts, distributions that sum to one, odd rows."""

import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from placerank.llm import suffix_tree
from placerank.llm.language import remainder
from placerank.llm.suffix_tree import LongTable, PRIOR, SuffixTree, learn, least_count, score_documents, word_counts

from .conftest import SF, words


def _texts(n):
    r = random.Random(8)
    out = []
    for i in range(n):
        w = words(i, r.randrange(0, 40), 60)
        for _ in range(r.randrange(4)):
            w += ["the", "very", "same", "phrase"] + words(i + 999, 2, 60)
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(_texts(400))] + [(1000, None), (1001, ""), (1002, "never seen words"), (None, "the very same")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_long_table():
    rnd = np.random.default_rng(1)
    keys = np.unique(rnd.integers(-(2**62), 2**62, 5000))
    table = LongTable(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + 1)[~np.isin(keys + 1, keys)] == -1).all() and len(table.find(keys[:0])) == 0


def test_counts_and_base(spark, docs):
    held = remainder(F.col("doc_id"), 7) == 2
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in rows.items()}
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    count = Counter(w for i, ws in tokens.items() if i is not None and not out[i] for w in ws)
    n, v = sum(count.values()), len(count)
    got = {r["doc_id"]: r for r in score_documents(docs, held, share=2.0**-8).collect()}
    assert got.keys() == rows.keys()
    for i, r in got.items():
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (out[i], len(tokens[i]), n)
        assert r["n_known"] == sum(count[w] > 0 for w in tokens[i])
        assert abs(r["base_score"] - sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens[i])) < 1e-6
    away = [i for i in rows if out[i]]
    assert sum(got[i]["score"] for i in away) > sum(got[i]["base_score"] for i in away)


def test_states_are_frequent_contexts_whose_distributions_sum_to_one(spark, docs):
    training = docs.where("doc_id IS NOT NULL")
    vocabulary = word_counts(training)
    n_docs = training.count()
    tree, tokens, distinct = learn(training, vocabulary, n_docs, share=2.0**-8)
    least = max(2, math.ceil(tokens * 2.0**-8))
    numbers = {w: i for w, i in tree.number.items()}
    lines = [[None, *(t or "").encode().lower().split(), None] for t in (r["text"] for r in training.collect())]
    assert len(tree.tables) >= 3
    for k in range(1, len(tree.tables) + 1):
        grams = Counter(tuple(w[i : i + k + 1]) for w in lines for i in range(len(w) - k))
        # Every frequent sequence is numbered with its count.
        assert sorted(tree.totals[k][1:].tolist()) == sorted(n for n in grams.values() if n >= least)
    # The root leaves the unmet their share; words below the bound are in the vocabulary.
    all_counts = {bytes(r["word"]): r["n"] for r in vocabulary.collect()}
    root = sum((1 - tree.unmet) * (n + 1) / tree.space for n in [*all_counts.values(), n_docs])
    assert abs(root + tree.unmet - 1) < 1e-9
    states = 0
    rare = {w: math.log10((1 - tree.unmet) * (n + 1) / tree.space) for w, n in all_counts.items() if w not in numbers}
    for k in range(1, len(tree.tables) + 1):
        for context in np.flatnonzero(~np.isnan(tree.rest[k - 1])):
            states += 1
            frequent = np.arange(1, tree.end + 1)
            p = 10 ** tree.log10_next(k, np.full(len(frequent), context), frequent)
            # A word that is not frequent: every state's factor on the way to the root.
            low = tree.log10_next(k, np.array([context]), np.array([0]))[0]
            total = p.sum() + sum(10 ** (low + x) for x in rare.values()) + 10 ** (low + math.log10(tree.unmet))
            assert abs(total - 1) < 1e-6, (k, context, total)
    assert states >= 2


class Brute:
    """The model from the module's description, with dictionaries and recursion."""

    def __init__(self, lines, least, depth):
        self.count = Counter(tuple(w[i : i + k]) for w in lines for k in range(1, depth + 2) for i in range(len(w) - k + 1))
        words_ = Counter(w for line in lines for w in line[1:])
        self.words, self.least, self.depth = words_, least, depth
        self.n, self.v = sum(words_.values()), len(words_)
        self.count[(None,)] = words_[None]
        self.unmet = min(0.5, max(1, sum(c == 1 for w, c in words_.items() if w is not None)) / (self.n + self.v + 1))
        self.pairs = Counter(p for w in words_ if w is not None for p in zip([256, *w], [*w, 256], strict=True))
        self.after = Counter(a for w in words_ if w is not None for a in [256, *w])
        self.next = {}
        for gram, c in self.count.items():
            if len(gram) > 1 and c >= least and None not in gram[1:-1]:
                self.next.setdefault(gram[:-1], []).append(gram[-1])
        self.known = {}

    def root(self, w):
        if w in self.words:
            return math.log10((1 - self.unmet) * (self.words[w] + 1) / (self.n + self.v))
        can = 257 - 32  # bytes but six blanks and A-Z, and the end; no end at a word's start
        return math.log10(self.unmet) + sum(
            math.log10((self.pairs[a, b] + 0.5) / (self.after[a] + 0.5 * (can - (a == 256)))) for a, b in zip([256, *w], [*w, 256], strict=True)
        )

    def state(self, context):
        """Counts' probabilities and the factor of all others; None: not a state."""
        if context not in self.known:
            n, follow = self.count[context], self.next.get(context, [])
            found = None
            if follow:
                c = [self.count[(*context, w)] for w in follow]
                q = [10 ** self.log10(context[1:], w) for w in follow]
                left, left_q = max(n - sum(c), 0.5), max(1 - sum(q), 1e-12)
                gain = sum(a * math.log(a / n / b) for a, b in zip(c, q, strict=True)) + left * math.log(left / n / left_q)
                if gain > 0.5 * len(c) * math.log(max(n, 2)):
                    p = [(a + PRIOR * b) / (n + PRIOR) for a, b in zip(c, q, strict=True)]
                    found = dict(zip(follow, p, strict=True)), max(1 - sum(p), 1e-12) / left_q
            self.known[context] = found
        return self.known[context]

    def log10(self, context, w):
        if not context:
            return self.root(w)
        found = self.state(context)
        if found is None:
            return self.log10(context[1:], w)
        return math.log10(found[0][w]) if w in found[0] else math.log10(found[1]) + self.log10(context[1:], w)

    def score(self, line):
        return sum(self.log10(tuple(line[max(0, i - self.depth) : i]), line[i]) for i in range(1, len(line)))


def test_scores_equal_brute_force(spark, docs):
    rows = [(r["doc_id"], [None, *(r["text"] or "").encode().lower().split(), None]) for r in docs.collect()]
    held = {i: i is not None and (i >= 1000 or zlib.crc32(str(i).encode()) % 7 == 2) for i, _ in rows}
    training = [w for i, w in rows if i is not None and not held[i]]
    for share, depth in ((2.0**-8, 4), (2.0**-10, 3)):
        model = Brute(training, least_count(sum(len(w) - 1 for w in training), share), depth)
        got = score_documents(docs, (remainder(F.col("doc_id"), 7) == 2) | (F.col("doc_id") >= 1000), depth, share).collect()
        want = sorted(model.score(w) for _, w in rows)
        assert np.allclose(sorted(r["score"] for r in got), want, atol=1e-6)
        by_id = {r["doc_id"]: r["score"] for r in got}
        assert all(abs(by_id[i] - model.score(w)) < 1e-6 for i, w in rows)
        assert sum(x is not None for x in model.known.values()) >= 3


def test_spellings_are_a_distribution():
    # All words of one and two bytes out of three, and what is left for longer ones.
    counts = np.zeros(257 * 257)
    counts[[256 * 257 + 97, 97 * 257 + 98, 98 * 257 + 256]] = (5, 3, 9)
    tree = SuffixTree([], [], 1, 1, 1, 0, counts)
    table = 10.0 ** tree.spelling.reshape(257, 257)
    assert np.allclose(table.sum(axis=1), 1) and table[256, 256] == 0 and table[97, ord(" ")] == 0 and table[97, ord("Q")] == 0
    long = bytes([97, 98] * 700_000)  # over a megabyte: summed in parts
    got = tree.spelled([b"a", b"ab", long, b"b"])
    steps = lambda w: sum(math.log10(table[a, b]) for a, b in zip([256, *w], [*w, 256], strict=True))
    assert np.allclose(got, [steps(b"a"), steps(b"ab"), steps(long), steps(b"b")]) and len(tree.spelled([])) == 0


def test_invented_words_score_below_real_text(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    r = random.Random(3)
    fake = [(-1 - i, " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(200))) for i in range(5)]
    everything = real.unionByName(spark.createDataFrame(fake, "doc_id bigint, text string"))
    got = score_documents(everything, (remainder(F.col("doc_id"), 7) == 2) | (F.col("doc_id") < 0)).collect()
    rate = {r["doc_id"]: r["score"] / r["n_tokens"] for r in got}
    assert max(rate[i] for i, _ in fake) < min(rate[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] >= 0)


def test_the_tree_grows_with_the_corpus(spark):
    assert 10**9 / least_count(10**9) > 1.9 * 10**8 / least_count(10**8) > 0
    found = []
    for folder in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        training = spark.read.parquet(f"{folder}/documents.parquet").select("text")
        tree, _, _ = learn(training, word_counts(training), training.count())
        found.append((sum(len(t) - 1 for t in tree.totals), sum(int((~np.isnan(x)).sum()) for x in tree.rest)))
    assert all(b > 2 * a for a, b in zip(*found, strict=True)), found


def test_nothing_to_learn_from_and_odd_rows(spark, odd, nothing):
    assert score_documents(nothing, F.lit(False)).count() == 0
    none = score_documents(odd, F.lit(True)).collect()
    assert len(none) == odd.count() and {(r["n_known"], r["train_tokens"], r["base_score"]) for r in none} == {(0, 0, 0.0)}
    assert max(r["score"] for r in none) == math.log10(0.5)  # the end alone; spelt words have less
    got = score_documents(odd, remainder(F.col("doc_id"), 7) == 2).collect()
    assert len(got) == odd.count() and all(math.isfinite(r["score"]) and r["n_tokens"] >= 1 for r in got)


def test_scoring_holds_little_of_a_large_batch(spark, docs, monkeypatch):
    """Megabytes of rare words in one batch: what a worker holds of them is bounded."""
    taken, plain = [], suffix_tree.map_batches
    monkeypatch.setattr(suffix_tree, "map_batches", lambda df, fn, schema: (taken.append((fn, schema)), plain(df, fn, schema))[1])
    score_documents(docs, F.lit(False), depth=1)
    score = next(fn for fn, schema in taken if "spelt" in schema)
    monkeypatch.setattr(suffix_tree, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    r = random.Random(4)
    texts = [" ".join("%010x" % r.getrandbits(40) for _ in range(300)) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(range(1000), pa.int64()), "text": texts, "held_out": pa.array([False] * 1000)}
    )
    tracemalloc.start()
    uids = set()
    rows = 0
    for out in score(iter([batch])):
        rows += out.num_rows
        uids.update(out.column("uid").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1000 + sum(len(set(t.split())) for t in texts) and uids == set(range(3 << 33, (3 << 33) + 1000))
    assert peak < 80 << 20, peak
