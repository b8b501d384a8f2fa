"""Mixing sources to target weights."""

import math
import re

import pytest

from pyspark.sql import functions as F

from placerank.llm.mixing import apply_mix, mix, source_targets, uniform

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Brute force: fill, fix what is above its cap, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in fixed)
        open_ = [s for s in names if s not in fixed]
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in fixed else level * weight[s] for s in names}
        fixed |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, "d": 300, None: 40}, {"a": 7}, {"a": 0, "b": 0}, {"b": 1, "a": 10**6, "ä": 50, "Z": 3},
])
def test_targets_equal_repeated_resharing(spark, sizes):
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size bigint, n_docs bigint")
    got = {r["source"]: r["target"] for r in source_targets(rows, (3.0, 1.0, 2.0), 1.5, 2.0).collect()}
    want = _targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_sizes_targets_and_takes(spark, odd):
    got = mix(odd).collect()
    texts = sorted(len(WORD.findall(r["text"] or "")) for r in odd.collect())
    assert sorted(r["size"] for r in got) == texts
    sums = {}
    for r in got:
        s = sums.setdefault(r["source"], [0, 0, r["source_size"], r["target"]])
        s[0] += r["size"]
        s[1] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = _targets({k: s[0] for k, s in sums.items()})
    for source, (size, taken, source_size, target) in sums.items():
        assert size == source_size and abs(target - want[source]) < 1e-6 and abs(taken - target) < 1 + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, mix(odd).collect()))


def test_whole_epochs_come_before_parts_and_weights_count(spark):
    rows = [(i, "w " * 10, "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    quality = spark.createDataFrame([(i, 8.0 if i % 2 else 0.5) for i in range(3000)], "doc_id bigint, weight double")
    got = mix(docs, quality=quality).collect()
    hot = [r for r in got if r["source"] == "hot"]
    epochs = int(hot[0]["target"] // hot[0]["source_size"])
    assert all(epochs * r["size"] <= r["taken"] <= (epochs + 1) * r["size"] for r in hot)
    assert sum(0 < r["taken"] - epochs * r["size"] < r["size"] for r in hot) <= 1
    good = [r["taken"] for r in hot if r["doc_id"] % 2]
    poor = [r["taken"] for r in hot if not r["doc_id"] % 2]
    assert sum(good) / len(good) > 1.1 * sum(poor) / len(poor)


def test_mixed_rows_have_the_taken_words(spark, odd):
    out = apply_mix(odd, mix(odd))
    assert out.columns == odd.columns
    assert sum(len(WORD.findall(r["text"] or "")) for r in out.collect()) == sum(r["taken"] for r in mix(odd).collect())


def test_empty_table(spark, nothing):
    assert mix(nothing).count() == 0 and apply_mix(nothing, mix(nothing)).count() == 0


def test_documents_are_chosen_by_their_keys(spark):
    """Brute force of the whole choice: keys sorted within a source, whole epochs, then prefix sums."""
    rows = [(i, "w " * (1 + i * 7 % 23), ("hot", "a", "b", None)[min(i % 8, 3)]) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weight = {i: (2.0, 0.5, 1.0)[i % 3] for i in range(800) if i % 5}
    quality = spark.createDataFrame(list(weight.items()), "doc_id bigint, weight double")
    keys = docs.select("doc_id", uniform(20, F.col("doc_id"), F.xxhash64("text")).alias("u")).collect()
    key = {r["doc_id"]: -math.log(r["u"]) / weight.get(r["doc_id"], 1.0) for r in keys}
    sizes = {}
    for i, t, s in rows:
        sizes.setdefault(s, {})[i] = len(t.split())
    want = {}
    for s, target in _targets({s: sum(x.values()) for s, x in sizes.items()}).items():
        total = sum(sizes[s].values())
        epochs = int(target // total)
        rest = math.floor(target) - epochs * total
        for i in sorted(sizes[s], key=key.get):
            part = min(sizes[s][i], rest)
            want[i] = epochs * sizes[s][i] + part
            rest -= part
    assert {r["doc_id"]: r["taken"] for r in mix(docs, quality=quality).collect()} == want
