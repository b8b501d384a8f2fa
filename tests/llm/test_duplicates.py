"""Near-duplicate join, connected components, and removal of repeated passages."""

import hashlib
import random

import numpy as np
import pytest

from placerank.llm import near_duplicates as nd
from placerank.llm import substring_dedup as sd
from placerank.llm.components import connected_components
from placerank.llm.fm_index import FMIndex, WaveletMatrix

from .conftest import words


def _components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components_equal_union_find(spark, kind):
    r = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(200)] + [(7, 7), (None, 3), (3, None), (500, 1)],
        "random": [(r.randrange(300), r.randrange(300)) for _ in range(200)],
        "none": [],
    }[kind]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == _components({x for e in real for x in e}, real)


def _shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _linked(x, y):
    return bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y)


def _edited(r, base, share):
    w = list(base)
    for _ in range(max(1, int(len(w) * share))):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return w


def _families(seed, n_families=25):
    """Bases of many sizes with near copies around the threshold, chains of edits, exact copies,
    and a passage and a first line that many documents share."""
    r = random.Random(seed)
    passage, texts = words(99, 60, 3000), []
    for f in range(n_families):
        n = r.choice([5, 6, 7, 9, 12, 20, 40, 41, 80, 120, 200, 333])
        base = [f"{f}b{r.randrange(10**6)}" for _ in range(n)]
        if f % 3 == 0:
            base = passage + base
        family = [base, base]
        for share in (0.01, 0.02, 0.03, 0.05):
            family.append(_edited(r, base, share))
        for _ in range(6):  # a chain: each a little further from the base
            family.append(_edited(r, family[-1], 0.02))
        family.append(base[: int(len(base) * 0.85)])
        family.append(base + [f"t{r.randrange(99)}" for _ in range(len(base) // 5)])
        texts += [" ".join(w) for w in family]
    texts += ["the same first line of all " + " ".join(words(i, 15, 10**6)) for i in range(40)]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_near_duplicates_equal_brute_force(spark, seed):
    texts = _families(seed)
    ids = random.Random(seed).sample(range(10_000), len(texts))
    rows = list(zip(ids, texts, strict=True)) + [(20_000, None), (20_001, ""), (20_002, "one"), (20_003, "One"), (20_004, "one two")]
    sets = {i: _shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and _linked(sets[a], sets[b])]
    want = _components(sets, links)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_linked_sets_always_meet_in_a_key():
    """No pair at the threshold is lost, whatever its size, nor where classes run short."""
    rnd = np.random.default_rng(5)
    for n in [1, 2, 3, 4, 5, 6, 8, 9, 10, 15, 16, 17, 31, 32, 33, 63, 64, 65, 100, 127, 128, 129, 300, 511, 512, 700, 1500]:
        for _ in range(30 if n < 200 else 8):
            a = np.unique(rnd.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64))
            shared = -(-8 * (len(a)) // 10) if rnd.random() < 0.5 else len(a)
            own = a[rnd.permutation(len(a))[:shared]]
            more = int(5 * shared // 4 - len(a))  # as many others as the threshold allows
            b = np.unique(np.r_[own, rnd.integers(0, 2**63, max(0, more), dtype=np.int64).astype(np.uint64)])
            both = len(np.intersect1d(a, b))
            assert 100 * both >= 80 * (len(a) + len(b) - both)
            assert set(nd.join_keys(a).tolist()) & set(nd.join_keys(b).tolist()), (n, len(a), len(b))


def test_sketches_bound_the_difference():
    rnd = np.random.default_rng(6)
    for n in (1, 5, 70, 800):
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64))
        b = np.unique(np.r_[a[: n // 2], rnd.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)])
        x, y = nd.sketch(a), nd.sketch(b)
        size = min(len(x), len(y))
        distance = int(np.bitwise_count(nd.folded(x, size) ^ nd.folded(y, size)).sum())
        assert distance <= len(np.setxor1d(a, b))


def test_blocks_of_a_large_key_lose_no_pair(spark, monkeypatch):
    """Links that only the second round finds, with blocks of three sets."""
    monkeypatch.setattr(nd, "BLOCK", 3)
    texts = _families(7, 8)
    rows = list(enumerate(texts))
    sets = {i: _shingles(t) for i, t in rows}
    want = _components(sets, [(a, b) for a in sets for b in sets if a < b and _linked(sets[a], sets[b])])
    got = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == want


def test_odd_rows_of_near_duplicates(spark, odd, nothing):
    got = nd.near_duplicates(odd).collect()
    assert len(got) == odd.count() and nd.near_duplicates(nothing).count() == 0
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by[0] == by[1].__class__([(0, 0)]) and by[1] == {(0, 1)} and {c for _, c in by[6]} == {5}
    assert {c for _, c in by[None]} == {None}


# ---------------------------------------------------------------- repeated passages


def test_wavelet_matrix_and_backward_search():
    rnd = np.random.default_rng(1)
    values = rnd.integers(0, 13, 500)
    matrix = WaveletMatrix(values, 12)
    symbol, before = rnd.integers(0, 13, 300), rnd.integers(0, 501, 300)
    assert matrix.rank(symbol, before).tolist() == [int((values[:b] == s).sum()) for s, b in zip(symbol, before, strict=True)]
    text = np.r_[rnd.integers(1, 4, 200), 0, rnd.integers(1, 4, 150), 0].astype(np.int32)
    index = FMIndex(text, 8)
    at = np.array([i for i in range(len(text) - 6) if (text[i : i + 6] > 0).all()])
    patterns = text[at[:, None] + np.arange(6)]
    alive, low, high = index.repeated(patterns)
    places = {tuple(p): [int(a) for a in at if tuple(text[a : a + 6]) == tuple(p)] for p in patterns}
    assert set(alive.tolist()) == {i for i, p in enumerate(patterns) if len(places[tuple(p)]) > 1}
    for i, a, b in zip(alive, low, high, strict=True):
        assert sorted(index.suffixes[a:b].tolist()) == places[tuple(patterns[i])]


def _kept(rows):
    """Brute force over documents in ascending doc_id."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = (t or "").encode().split()
        stay = np.ones(len(w), dtype=bool)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                stay[s : s + 20] = False
            seen.add(key)
        kept = [w[j] for j in np.flatnonzero(stay)]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def _passages(seed):
    r = random.Random(seed)
    shared = [words(100 + k, r.choice([19, 20, 21, 25, 60, 150]), 10**6) for k in range(12)]
    rows = []
    for i in range(150):
        w = words(1000 + i, r.randrange(5, 120), 10**6)
        for _ in range(r.randrange(4)):
            p = r.choice(shared)
            cut = p[r.randrange(3) : len(p) - r.randrange(3)]
            at = r.randrange(len(w) + 1)
            w = w[:at] + cut + w[at:]
        rows.append((i * 7 % 1009, " ".join(w)))
    rows += [(2000, "na " * 60), (2001, "na " * 25), (2002, "a b " * 40), (2003, None), (2004, ""), (2005, rows[3][1]), (2006, rows[3][1])]
    return rows


@pytest.mark.parametrize("crowded,shard", [(4096, 60_000), (2, 60_000), (4096, 40), (5, 100)])
def test_kept_words_equal_brute_force(spark, monkeypatch, crowded, shard):
    monkeypatch.setattr(sd, "CROWDED", crowded)
    rows = _passages(4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    if shard != sd.SHARD_WORDS:  # small shards: the same answer, run here
        found = []
        monkeypatch.setattr(sd, "SHARD_WORDS", shard)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in sd.digests(docs).collect()}
    assert got == _kept(rows)


def test_odd_rows_of_repeated_passages(spark, odd, nothing):
    got = sd.digests(odd).collect()
    assert len(got) == odd.count() and sd.digests(nothing).count() == 0 and sd.clean(nothing).count() == 0
    removed = {}
    for r in got:
        removed.setdefault(r["doc_id"], []).append(r["n_removed"])
    # Null ids come first: theirs is the first passage; 8 and 9 repeat it, and so does 12, twice.
    assert removed[8] == [30] and removed[9] == [30] and removed[12] == [60] and sorted(removed[None]) == [0, 0]
    assert removed[6] == [60] and sorted(removed[5]) == [0, 0, 0]
    cleaned = sd.clean(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == odd.count()
    by = {r["doc_id"]: r for r in cleaned.collect()}
    assert by[8]["text"] == "start of it and an end" and by[8]["n_chars"] == len(by[8]["text"])
    assert by[4]["text"] == "one two  three\nfour" and by[0]["text"] is None and by[8]["spans"] == "c" and by[8]["id"] == "a"


def test_spans_stay_in_the_row_they_were_found_in(spark):
    """Null and repeated ids: a row loses only its own repeats, and copies without an id go."""
    passage, lead = words(31, 20, 10**6), [words(40 + i, 100, 10**6) for i in range(4)]
    clean = [words(50 + i, 140, 10**6) for i in range(3)]
    copy = words(60, 50, 10**6)
    rows = [
        (None, lead[0] + passage), (None, clean[0]), (None, clean[1]),  # windows at 100 of one, other words there in others
        (None, copy), (None, copy), (None, copy),
        (7, lead[1] + passage), (7, clean[2]), (7, lead[2] + passage),
        (8, lead[3]), (8, lead[3]),
    ]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string").repartition(4)
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in sd.clean(docs).collect())
    want = [(0, lead[0] + passage), (0, clean[0]), (0, clean[1]), (0, copy), (0, []), (0, []),
            (7, lead[1]), (7, clean[2]), (7, lead[2]), (8, lead[3]), (8, lead[3])]
    assert kept == sorted((i, " ".join(w)) for i, w in want)
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in sd.digests(docs).collect())
    gone = [0, 0, 0, 0, 50, 50, 20, 0, 20, 0, 0]
    assert got == sorted((i or 0, len(w), g) for (i, w), g in zip(rows, gone, strict=True))
