"""Fingerprints from closed syncmers, and exact top-k search."""

import hashlib
import math

import numpy as np
import pytest

from placerank.llm.common import mix64
from placerank.llm.fingerprint import K, S, anchors, as_text, edited_fingerprints, fingerprints, from_text, likeness
from placerank.llm.topk import query_blocks, top_k

from .conftest import words


def _syncmers(text):
    """Brute force: places of the k-mers whose smallest s-mer is first or last."""
    def h(i):
        return int(mix64(np.uint64(int.from_bytes(text[i : i + S], "little")))[0])

    out = []
    for i in range(len(text) - K + 1):
        inner = [h(i + j) for j in range(K - S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def test_anchors_are_the_closed_syncmers():
    texts = [" ".join(words(s, n)).encode() for s, n in ((1, 40), (2, 3), (3, 100))] + [b"", b"short", "é中".encode() * 9]
    owner, place, value = anchors(texts)
    for i, t in enumerate(texts):
        want = _syncmers(t)
        assert place[owner == i].tolist() == (want or ([0] if t else []))
    # The same k-mer gives the same anchor anywhere.
    shifted = anchors([b"zz" + texts[0]])
    assert set(value[owner == 0]) <= set(shifted[2])


def test_likeness_of_copies_edits_and_strangers():
    a = " ".join(words(1, 400)).encode()
    b = " ".join(words(9, 400, 10_000)).encode()
    moved = b"some new words in front " + a
    p = fingerprints([a, a, moved, b, b"", b"x"])
    assert (from_text(as_text(p)) == p).all()
    like = likeness(p[[0, 0, 0, 4, 4]], p[[1, 2, 3, 4, 5]])
    assert like[0] == 1 and like[1] > 0.8 and like[2] < 0.1 and like[3] == 1 and like[4] == 0


def test_every_document_meets_its_next(spark, odd, nothing):
    rows = odd.collect()
    # Rows of equal id follow one another by text; null ids come first.
    order = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    texts = [r["text"] or "" for r in order]
    want = []
    for i, r in enumerate(order):
        t, after = texts[i], texts[(i + 1) % len(texts)]
        k = len(t) // 4
        e = t[: len(t) - k] + after[:k]
        p = fingerprints([t.encode(), e.encode(), after.encode()])
        want.append((r["doc_id"], len(t), hashlib.sha256(e.encode()).hexdigest(), *as_text(p[:2]),
                     float(likeness(p[:1], p[1:2])[0]), float(likeness(p[:1], p[2:])[0])))
    for parts in (1, 5):
        assert sorted(map(str, map(tuple, edited_fingerprints(odd, parts).collect()))) == sorted(map(str, want))
    assert edited_fingerprints(nothing).count() == 0
    one = spark.createDataFrame([(7, "abcdefgh")], "doc_id bigint, text string")
    assert edited_fingerprints(one).first()["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def _brute(vectors, queries, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, qv in usable:
        if qi % queries == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != qi)[:k]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("n,d,step", [(1200, 40, 9), (3, 5, 1), (60, 1, 7)])
def test_top_k_equals_brute_force(spark, n, d, step):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=d).round(3).tolist()) for i in range(n)]
    rows += [(n + 1, None), (n + 2, [1.0, None]), (n + 3, [float("nan")] * d), (None, [1.0] * d), (n + 4, []), (n + 5, [0.5])]
    rows += [(2 * step, rows[step % n][1]), (n + 6, rows[0][1]), (n + 7, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, vec array<double>").repartition(5)
    got = sorted(map(tuple, top_k(df, df.where(f"vec_id % {step} = 0"), slots=3).collect()))
    assert got == _brute(rows, step, 5)


def test_top_k_of_numbers_beyond_exact_doubles_and_of_nothing(spark):
    rows = [(0, [1e14, 3.0]), (1, [1e14, 1.0]), (2, [1e14, 2.0]), (3, [-1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, vec array<double>")
    got = [tuple(r) for r in top_k(df, df.where("vec_id = 0"), k=3).orderBy("rank").collect()]
    big = (256 * 10**14) ** 2
    assert got == [(0, 1, 1, min(2**63 - 1, big + 768 * 256)), (0, 2, 2, 2**63 - 1), (0, 3, 3, -(2**63))]
    assert top_k(df.limit(0), df.limit(0)).count() == 0


def test_query_blocks_do_not_depend_on_the_order_of_arrival(spark):
    rnd = np.random.default_rng(4)
    rows = [(int(i), rnd.normal(size=3).tolist()) for i in rnd.integers(0, 900, 2500)] + [(7, [1.0, 2.0, 3.0])] * 3
    blocks = []
    for seed in (1, 2):
        order = np.random.default_rng(seed).permutation(len(rows))
        df = spark.createDataFrame([rows[i] for i in order], "vec_id bigint, vec array<double>").repartition(3 + seed)
        blocks.append(sorted((r["block"], r["n"], bytes(r["ids"]), bytes(r["data"])) for r in query_blocks(df, 256.0).collect()))
    assert len(blocks[0]) > 1 and blocks[0] == blocks[1]
