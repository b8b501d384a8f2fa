"""The corpus pipeline's stages against brute force, and their queries."""

import math

import pytest

import corpus_pipeline as cp
from __spark_entry__ import queries
from placerank.llm.catalog import QUERIES
from placerank.llm.common import documents
from placerank.llm.mixing import apply_mix, mix, word_count
from placerank.llm.near_duplicates import keep_first
from placerank.llm.substring_dedup import clean

from .conftest import SF


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage, on the small tables."""
    docs, out = documents(spark, SF), []
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "mixing", "packing"]


def test_all_but_the_last_return_the_columns_of_documents(spark, stages):
    columns = documents(spark, SF).columns
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "packing")


def test_toxicity_drops_what_its_query_rejects(spark, stages):
    before, after = stages["toxicity"]
    rejected = {r["doc_id"] for r in queries()["op10_toxicity"](spark, SF).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - rejected


def _shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    sets = {r["doc_id"]: _shingles(r["text"]) for r in before.collect()}
    gone, todo = set(), sorted(sets)
    group = {i: i for i in todo}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(todo):
        for b in todo[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                u, v = find(a), find(b)
                group[max(u, v)] = min(u, v)
    gone = {i for i in todo if find(i) != i}
    assert sorted(r["doc_id"] for r in after.collect()) == [i for i in todo if i not in gone]


def test_repeated_passages_go(stages):
    before, after = stages["substring_dedup"]
    seen, want = set(), {}
    for r in sorted(before.collect(), key=lambda r: r["doc_id"]):
        w = (r["text"] or "").split()
        w = (r["text"] or "").encode().split()
        stay = [True] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                stay[s : s + 20] = [False] * 20
            seen.add(key)
        want[r["doc_id"]] = r["text"] if all(stay) else b" ".join(x for x, k in zip(w, stay) if k).decode()
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want


def test_sources_meet_their_targets(spark, stages):
    before, after = stages["mixing"]
    sizes = {r["source"]: r["n"] for r in after.groupBy("source").agg({"n": "sum"}).collect()} if "n" in after.columns else None
    assert sizes is None
    counted = after.withColumn("n", word_count(after["text"])).groupBy("source").agg({"n": "sum"}).collect()
    got = {r[0]: r[1] for r in counted}
    want = {r["source"]: r["target"] for r in mix(before).select("source", "target").distinct().collect()}
    assert all(abs(got.get(s, 0) - math.floor(t)) < 1 for s, t in want.items())


def test_packing_holds_all_pieces(stages):
    before, after = stages["packing"]
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before.collect()}
    used = {}
    for r in rows:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 4096 and len(used) <= math.ceil(1.02 * sum(used.values()) / 4096) + 1


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, nothing, name):
    stage = dict(cp.STAGES)[name]
    for docs in (odd, nothing):
        out = stage(spark, docs, SF)
        assert name == "packing" or out.columns == docs.columns
        n = out.count()
        assert n == 0 if docs is nothing else n > 0


def test_run_is_all_stages(spark, stages):
    """Places in sequences aside, which any numbering may fill."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(tuple(r) for r in cp.run(spark, SF).select(columns).collect())
    assert got == sorted(tuple(r) for r in stages["packing"][1].select(columns).collect())


BASE = " ".join(f"w{i}" for i in range(60))
NEAR = BASE.replace("w30", "changed")
OTHER = " ".join(f"v{i}" for i in range(60))


@pytest.mark.parametrize("rows, want", [
    ([(None, BASE), (None, BASE), (None, NEAR), (None, OTHER)], [(None, 1), (None, OTHER)]),  # 1: BASE or NEAR
    ([(None, BASE), (7, NEAR), (9, BASE)], [(7, NEAR)]),
    ([(5, OTHER), (5, BASE), (2, NEAR)], [(2, NEAR), (5, OTHER)]),
    ([(5, BASE), (5, BASE), (5, BASE)], [(5, BASE)]),
    ([(1, None), (1, None), (2, ""), (None, " ")], [(1, None), (1, None), (2, ""), (None, " ")]),
])
def test_groups_of_rows_without_or_with_repeated_ids(spark, rows, want):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r["doc_id"], r["text"]) for r in keep_first(docs).collect()]
    want = [(i, min(BASE, NEAR, key=lambda t: t not in {x for _, x in got}) if t == 1 else t) for i, t in want]
    assert sorted(map(str, got)) == sorted(map(str, want))


CLASHING = ["__id", "__part", "__spans", "__copy", "__words", "__take", "__hash", "row", "group", "other0", "kept", "_sum", "size"]


@pytest.mark.parametrize("apply", [keep_first, clean, lambda d: apply_mix(d, mix(d)), lambda d: cp.near_duplicate_join(None, d, SF)])
def test_columns_of_any_name_come_through(spark, apply):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"{i} {t}", "s", *[f"{c}-{i}" for c in CLASHING]) for i, t in enumerate([BASE, OTHER, passage, "x " + passage])]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id bigint", "text string", "source string", *(f"`{c}` string" for c in CLASHING)]))
    out = apply(docs)
    assert out.columns == docs.columns
    found = out.collect()
    assert found and all(r[c] == f"{c}-{r['doc_id']}" for r in found for c in CLASHING)
