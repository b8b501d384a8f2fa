"""Language identification and toxicity."""

import os
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from placerank.llm import catalog, toxicity
from placerank.llm.language import BLOCK, CrossParser, identify, language_samples, remainder, suffix_automaton, symbols_of
from placerank.llm.toxicity import Model, classify, keep_clean, labelled_sample, scores, train, units_of

SYLLABLES = {"xx": ["ba", "do", "ki", "lu"], "yy": ["sch", "ung", "ein", "ter"], "zz": ["eau", "oir", "qui", "ment"]}


def _text(lang, seed, n=80):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def _phrases(text, sample):
    """Brute force: greedy longest stretches of the text that occur in the sample, by blocks."""
    n = 0
    for at in range(0, len(text), BLOCK):
        block, i = text[at : at + BLOCK], 0
        while i < len(block):
            k = 1
            while i + k < len(block) and block[i : i + k + 1] in sample:
                k += 1
            n, i = n + 1, i + k
    return n


def test_the_automaton_has_exactly_the_substrings():
    text = [1, 2, 1, 1, 2, 3, 1, 2]
    nexts = suffix_automaton(text)

    def holds(word):
        state = 0
        for s in word:
            if s not in nexts[state]:
                return False
            state = nexts[state][s]
        return True

    subs = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
    assert all(holds(w) for w in subs) and not any(holds(w) for w in ([3, 3], [2, 2], [1, 1, 1], [4]) if tuple(w) not in subs)


def test_rates_are_those_of_cross_parsing():
    samples = {k: symbols_of(_text(k, 0, 200)).tobytes() for k in SYLLABLES}
    parser = CrossParser(samples)
    texts = [_text("xx", 5), "kidolu", _text("zz", 6, 400), "Öl ûber ünd", "a", _text("yy", 7, 3) + " 12 $$ " + _text("xx", 8, 3)]
    rates = parser.rates([symbols_of(t) for t in texts])
    for row, text in zip(rates, texts, strict=True):
        s = symbols_of(text).tobytes()
        for k, language in enumerate(parser.languages):
            sample = samples[language]
            assert abs(row[k] - _phrases(s, sample) * np.log2(len(sample) + 1) / len(s)) < 1e-9


def test_held_out_languages_and_odd_rows(spark, odd, nothing):
    rows = [(i, _text(k, i), k) for i, k in enumerate(["xx", "yy", "zz"] * 40)]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "12 !?", "zz"), (903, "kidolu " * 30_000, "xx"), (None, _text("yy", 1), "yy")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    held = remainder(F.col("doc_id"), 4) == 2
    got = {r["doc_id"]: r for r in identify(docs, language_samples(docs, held), held).collect()}
    for i, text, lang in rows:
        assert got[i]["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["lang_pred"] == ("und" if i in (900, 901, 902) else lang) and 0 <= got[i]["score"] <= 1
    assert identify(nothing, {}, held).count() == 0
    assert {r["lang_pred"] for r in identify(odd, language_samples(odd, F.lit(True)), held).collect()} == {"und"}
    assert identify(odd, language_samples(odd, held), held).count() == odd.count()


INSULTS = ["grumblor", "snarvik", "trelbon", "plonkard"]


def _documents(n=600):
    r = random.Random(4)
    rows = []
    for i in range(n):
        words = _text(r.choice(["xx", "zz"]), i, 60).split()
        toxic = int(i % 3 == 0)
        if toxic:
            for _ in range(2):
                words.insert(r.randrange(len(words)), r.choice(INSULTS))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_kernel_values_are_those_of_the_definition():
    from itertools import combinations

    from placerank.llm.toxicity import DECAY, feature_vector

    def features(word):
        s, out = "^" + word + "$", {}
        for size, span in ((3, 5), (4, 6)):
            for at in combinations(range(len(s)), size):
                if at[-1] - at[0] < span:
                    u = "".join(s[i] for i in at)
                    out.setdefault(u, []).append(DECAY ** (at[-1] - at[0] + 1))
        return out

    def value(a, b):
        fa, fb = features(a), features(b)
        norm = np.sqrt(sum(w * w for v in fa.values() for w in v) * sum(w * w for v in fb.values() for w in v))
        return sum(sum(fa[u]) * sum(fb[u]) for u in fa.keys() & fb.keys()) / norm

    words = [b"grumblor", b"grumbblor", b"idiot", b"moron", b"banana"]
    vectors = np.column_stack([feature_vector([w], np.ones(1)) for w in words])
    got = scores(words, vectors)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(got[i, j] - value(a.decode(), b.decode())) < 0.03, (a, b)  # hashed features may meet


def test_insults_with_insertions_are_found_and_clean_texts_stay(spark):
    rows = _documents()
    model = train([t.encode() for _, t, y in rows if _ % 5], [y for _, _t, y in rows if _ % 5])
    variants = ["grum*blor", "g.rumblor", "snar-vik", "Trelbon!", "(plonkard)", "plonk.ard", "s n a r v i k"]
    clean = [_text("xx", 1000 + i) for i in range(40)] + [_text("zz", 2000 + i) for i in range(40)] + ["", None]
    toxic = [_text("xx", 3000 + i, 20) + " " + v + " " + _text("xx", i, 20) for i, v in enumerate(variants)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(clean + toxic)] + [(None, "x")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in classify(docs.repartition(3), model, F.col("doc_id") % 5 == 0).collect()}
    assert len(got) == len(clean) + len(toxic) + 1
    assert sum(got[i]["predicted"] for i in range(len(clean))) == 0
    assert sum(got[len(clean) + i]["predicted"] for i in range(len(toxic))) >= len(toxic) - 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(t, y) for i, t, y in rows if i % 5 == 0]
    p = model.score(np.array([max(model.margins(sorted(units_of(t.encode())))) for t, _ in held])) >= 0.5
    assert (p == np.array([y for _, y in held], dtype=bool)).mean() > 0.97


def test_no_labels_one_class_and_odd_rows(spark, odd, nothing):
    for texts, labels in (([], []), ([b"a b"], [0]), ([b"a b", b""], [1, 1])):
        model = train(texts, labels)
        got = classify(odd, model, F.col("doc_id") == 1).collect()
        assert len(got) == odd.count() and len({r["score"] for r in got}) == 1
    labels = spark.createDataFrame([(4, 1, 0), (10, 0, 1), (None, 1, 1), (6, 1, None)], "doc_id bigint, quality int, toxic int")
    sample = labelled_sample(odd, labels, F.lit(False))
    assert sorted(y for _, y in sample) == [0, 1]
    model = train([t for t, _ in sample], [y for _, y in sample])
    kept = keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert classify(nothing, model, F.lit(False)).count() == 0 and keep_clean(nothing, model).count() == 0
    assert isinstance(model, Model)


def test_the_machine_is_trained_by_a_task(spark, odd, nothing, tmp_path, monkeypatch):
    """Not in the driver, and as there."""
    docs = spark.createDataFrame([(i, t) for i, t, _ in _documents()], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in _documents()], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    sample = labelled_sample(docs, labels, remainder(F.col("doc_id"), 5) == 0)
    want = train([t for t, _ in sample], [y for _, y in sample])

    driver = os.getpid()

    def elsewhere(texts, toxic):
        assert not texts or os.getpid() != driver, "trained in the driver"
        return train(texts, toxic)

    monkeypatch.setattr(toxicity, "train", elsewhere)
    monkeypatch.setattr(catalog, "train", elsewhere, raising=False)
    got = catalog.toxicity_model(docs, spark, str(tmp_path))
    assert np.allclose(got.vector, want.vector, atol=1e-5) and len(sample) > 100
    assert np.allclose([got.bias, got.slope, got.offset, got.least], [want.bias, want.slope, want.offset, want.least])
    none = catalog.toxicity_model(nothing, spark, str(tmp_path))
    assert none.slope == 0 and not none.vector.any()


def test_a_long_row_leaves_room_for_the_others(spark):
    rows = [(0, "x" * 5000, "en"), *((i, f"word{'abcdef'[i]} " * 4, "en") for i in range(1, 6))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    sample = language_samples(docs, F.lit(False), symbols=600)["en"]
    assert len(sample) == 600 and all(f"word{c}".encode() in sample for c in "bcdef")
