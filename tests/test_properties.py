"""Property tests: operators against pure-Python brute force on generated inputs."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from placerank import operators as op
from placerank.schema import LISTINGS_RAW, POSTS

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

words = st.sampled_from(["beach", "Beach", "temple", "und", "pour", "a.c", "", "party", "art", "sun"])
texts = st.one_of(st.none(), st.lists(words, max_size=8).map(" ".join))
posts_rows = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C", None]), st.sampled_from(["X", "Y"]), texts), min_size=1, max_size=25
)


def _posts(spark, rows):
    return spark.createDataFrame([(i, it, g, "p", t) for i, (it, g, t) in enumerate(rows)], schema=POSTS)


def _spark_round(x, s):
    # Spark rounds HALF_UP on the shortest decimal form of the double.
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-s), rounding=ROUND_HALF_UP))


@SETTINGS
@given(rows=posts_rows)
def test_popularity_matches_brute_force(spark, rows):
    counts = {}
    for it, g, _ in rows:
        counts[(it, g)] = counts.get((it, g), 0) + 1
    lo, hi = min(counts.values()), max(counts.values())
    score = {k: (_spark_round((n - lo) / (hi - lo) * 100.0, 2) if hi > lo else None) for k, n in counts.items()}
    rank = {}
    for (it, g), s in score.items():
        better = sum(1 for (i2, g2), s2 in score.items() if g2 == g and s is not None and s2 is not None and s2 > s)
        if s is None:
            better = sum(1 for (i2, g2), s2 in score.items() if g2 == g and s2 is not None)
        rank[(it, g)] = 1 + better
    got = {(r.item, r.grp): (r.review_count, r.popularity_score, r.group_rank)
           for r in op.popularity_score(_posts(spark, rows)).collect()}
    assert got == {k: (counts[k], score[k], rank[k]) for k in counts}


@SETTINGS
@given(rows=posts_rows, kws=st.lists(st.sampled_from(["beach", "und", "a.c", "art", " Sun "]), max_size=3))
def test_keyword_ranking_matches_brute_force(spark, rows, kws):
    clean = [k.strip().lower() for k in kws if k.strip()]
    got = op.keyword_ranking(_posts(spark, rows), kws, n=100).collect()
    if not clean:
        assert got == []
        return
    pairs = {}
    for it, g, t in rows:
        n, h = pairs.get((it, g), (0, 0))
        hits = sum(t.lower().count(k) for k in clean) if t is not None else 0
        pairs[(it, g)] = (n + 1, h + hits)
    lo = min(n for n, _ in pairs.values())
    hi = max(n for n, _ in pairs.values())
    thr = 0.05 * len(clean)
    kept = {k: (n, h, h / n) for k, (n, h) in pairs.items() if h / n >= thr}
    if not kept:
        assert got == []
        return
    maxd = max(d for _, _, d in kept.values())
    want = {}
    for (it, g), (n, h, dens) in kept.items():
        pop = _spark_round((n - lo) / (hi - lo) * 100.0, 2) if hi > lo else None
        rel = _spark_round(dens / max(maxd, 0.001) * 100.0, 2)
        fin = _spark_round(rel * 0.8 + (pop if pop is not None else 0.0) * 0.2, 2)
        want[(it, g)] = (n, float(h), rel, fin)
    assert {(r.item, r.grp): (r.review_count, r.keyword_freq, r.relevance_score, r.final_score) for r in got} == want


guests_raw = st.one_of(st.none(), st.sampled_from(["", "n/a", " 3 guests ", "16+ guests", "0", "2.5", "-3",
                                                   "99999999999", "4"]))
stars_raw = st.one_of(st.none(), st.sampled_from(["", "New", "4.8", " 3.9 ", "4.", "-4.0", "5", "10.25", ".5"]))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["Entire villa", "Private room", " Hotel room "]), guests_raw,
                               stars_raw), max_size=20))
def test_clean_listings_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(i, f"n{i}", t, g, s) for i, (t, g, s) in enumerate(rows)], schema=LISTINGS_RAW)
    want = {}
    for i, (t, g, s) in enumerate(rows):
        s2 = s.strip(" ") if s is not None else None
        g2 = g.strip(" ") if g is not None else None
        stars = float(s2) if s2 is not None and re.fullmatch(r"\d+(\.\d+)?", s2) else None
        m = re.search(r"\d+", g2) if g2 is not None else None
        guests = int(m.group(0)) if m and int(m.group(0)) < 2**31 else None
        if stars is not None and guests is not None and guests > 0:
            want[i] = (t.strip(" "), guests, stars)
    got = {r.listing_id: (r.room_type, r.guests, r.stars) for r in op.clean_listings(df).collect()}
    assert set(got) == set(want)
    for i, (t, g, s) in got.items():
        assert (t, g) == want[i][:2] and math.isclose(s, want[i][2], rel_tol=1e-6)


tokens_st = st.sampled_from(["Sun", "sun", "the", "and", "Beach", "x", "tea-time", "don't", "i'll", "café"])
seps = st.sampled_from([" ", "  ", "\t", "\n", "\x0b", "\f", "\r\n", " \t "])


@st.composite
def messy_text(draw):
    if draw(st.booleans()) and draw(st.booleans()):
        return None
    parts = draw(st.lists(st.tuples(tokens_st, seps), max_size=8))
    lead = draw(st.sampled_from(["", " ", "\n"]))
    return lead + "".join(t + s for t, s in parts)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), messy_text()), min_size=1, max_size=12))
def test_tfidf_terms_matches_brute_force(spark, rows):
    from decimal import ROUND_HALF_UP, Decimal

    from placerank.functions import english_stop_words

    stop = set(english_stop_words())
    df = spark.createDataFrame([(i, it, "g", "p", t) for i, (it, t) in enumerate(rows)], schema=POSTS)
    tf = {}
    for it, t in rows:
        for tok in re.split(r"[ \t\n\x0b\f\r]", t.lower()) if t is not None else []:
            if tok and tok not in stop:
                tf[(it, tok)] = tf.get((it, tok), 0) + 1
    m = len({it for it, _ in rows})
    dfreq = {}
    for (it, tok) in tf:
        dfreq[tok] = dfreq.get(tok, 0) + 1

    def r6(x):
        return float(Decimal(repr(x)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP))

    want = {k: (n, dfreq[k[1]], r6(n * math.log((m + 1.0) / (dfreq[k[1]] + 1.0)))) for k, n in tf.items()}
    got = {(r.item, r.term): (r.tf, r.doc_freq, r.tfidf) for r in op.tfidf_terms(df).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:2] == want[k][:2] and abs(got[k][2] - want[k][2]) <= 1e-6, (k, got[k], want[k])


@SETTINGS
@given(texts=st.lists(messy_text(), min_size=1, max_size=12))
def test_top_words_matches_brute_force(spark, texts):
    from placerank.functions import FREQUENCY_STOP_WORDS

    df = spark.createDataFrame([(i, "A", "g", "p", t) for i, t in enumerate(texts)], schema=POSTS)
    counts = {}
    for t in texts:
        for w in t.lower().split(" ") if t is not None else []:
            if len(w) > 3 and w not in FREQUENCY_STOP_WORDS:
                counts[w] = counts.get(w, 0) + 1
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0].encode("utf-8")))[:20]
    got = [(r.word, r.frequency) for r in op.top_words(df, 20).collect()]
    assert got == want


listing_rows = st.lists(
    st.tuples(
        st.sampled_from(["Entire villa", "Private room", "Hotel room"]),
        st.integers(min_value=1, max_value=8),
        st.sampled_from([0.0, 3.5, 3.9, 4.0, 4.2, 4.5, 4.8, 4.9, 5.0]),
    ),
    max_size=25,
)


@SETTINGS
@given(rows=listing_rows, room=st.sampled_from(["Any", "room", "villa", "castle"]),
       guests=st.integers(min_value=1, max_value=5), min_stars=st.sampled_from([0.0, 4.0, 4.5]))
def test_hybrid_and_evaluation_match_brute_force(spark, rows, room, guests, min_stars):
    import numpy as np

    from placerank.schema import LISTINGS

    df = spark.createDataFrame([(i, f"n{i}", t, g, float(s)) for i, (t, g, s) in enumerate(rows)], schema=LISTINGS)
    stars32 = {i: float(np.float32(s)) for i, (_, _, s) in enumerate(rows)}
    cand = [i for i, (t, g, s) in enumerate(rows)
            if (room == "Any" or room in t.lower()) and stars32[i] >= min_stars and g >= guests]
    lo = min((stars32[i] for i in cand), default=None)
    hi = max((stars32[i] for i in cand), default=None)
    lo = 0.0 if not lo else lo
    hi = 5.0 if not hi else hi
    scored = []
    for i in cand:
        g = rows[i][1]
        match = 1.0 if g == guests else (0.8 if g <= guests + 2 else 0.5)
        norm = (stars32[i] - lo) / (hi - lo + 0.001)
        scored.append((i, _spark_round(norm * 0.7 + match * 0.3, 4)))
    want = sorted(scored, key=lambda r: (-r[1], r[0]))[:10]
    recs = op.hybrid_recommendations(df, room, guests, min_stars, 10)
    assert [(r.listing_id, r.hybrid_score) for r in recs.collect()] == want

    ev = op.evaluate_recommendations(recs, df, guests).collect()[0]
    relevant = sum(1 for i, _ in want if stars32[i] >= 4.0 and rows[i][1] >= guests)
    assert (ev.total_recommended, ev.relevant_count) == (len(want), relevant)
    if want:
        assert ev.precision_at_k == _spark_round(relevant / len(want), 2)
        assert ev.coverage == _spark_round(len(want) / len(rows) * 100.0, 2)
    else:
        assert (ev.precision_at_k, ev.coverage) == (0.0, 0.0)


@SETTINGS
@given(types=st.lists(st.one_of(st.none(), st.sampled_from(["b", "a", "c", "d", "Aa", "é"])), min_size=1, max_size=30))
def test_room_type_index_equals_string_indexer(spark, types):
    from pyspark.ml.feature import StringIndexer

    from placerank.schema import LISTINGS

    df = spark.createDataFrame([(i, "n", t, 2, 4.0) for i, t in enumerate(types)], schema=LISTINGS)
    ours = {r.listing_id: r.room_type_index for r in op.listing_feature_columns(df).collect()}
    model = StringIndexer(inputCol="room_type", outputCol="idx", handleInvalid="keep").fit(df)
    theirs = {r.listing_id: int(r.idx) for r in model.transform(df).collect()}
    assert ours == theirs


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.sampled_from([0.0, 12.5, 50.0, 87.25, 100.0]),
                               st.integers(1, 9)), min_size=1, max_size=20))
def test_cluster_labels_summary_samples_match_brute_force(spark, rows):
    data = [(f"i{n}", "g", c, s, p) for n, (p, s, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "item string, grp string, review_count long, popularity_score double, "
                                     "prediction int")
    means = {}
    for _, _, _, s, p in data:
        means.setdefault(p, []).append(s)
    avg = {p: sum(v) / len(v) for p, v in means.items()}
    hot = min(avg, key=lambda p: (-avg[p], p))
    gem = min(avg, key=lambda p: (avg[p], p))
    label = {p: ("Hidden Gem" if p == gem else "Popular Hotspot" if p == hot else "Regular Destination") for p in avg}
    labelled = op.label_clusters(df)
    got = {r.item: r.cluster_label for r in labelled.collect()}
    assert all(got[it].endswith(label[p]) for it, _, _, _, p in data)

    summary = {r.cluster_label: (r.item_count, r.avg_popularity) for r in op.cluster_summary(labelled).collect()}
    by_label = {}
    for it, _, c, s, p in data:
        by_label.setdefault(got[it], []).append((s, c, it))
    assert set(summary) == set(by_label)
    for lab, members in by_label.items():
        assert summary[lab][0] == len(members)
        assert summary[lab][1] == _spark_round(sum(s for s, _, _ in members) / len(members), 2)

    samples = op.cluster_samples(labelled, 2).collect()
    for lab, members in by_label.items():
        want = [it for _, _, it in sorted(members, key=lambda m: (-m[0], m[2]))[:2]]
        assert [r.item for r in sorted((r for r in samples if r.cluster_label == lab), key=lambda r: r.sample_rank)] == want
