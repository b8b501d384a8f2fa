"""DuckDB SQL for every query of ``plans.catalog`` that SQL can express.

Written independently of the Spark operators, from the operator definitions. Two DuckDB
conventions are pinned so the engines compute the same values:

* numeric literals are cast to DOUBLE (a bare ``1.0`` is a DECIMAL in DuckDB);
* ``round`` follows Spark's definition -- HALF_UP on the shortest decimal form of the
  double -- by casting double -> VARCHAR -> DECIMAL(38, s) -> DOUBLE (``sround``), since
  DuckDB's own ``round(double)`` rounds some decimal ties the other way (1.005 -> 1.0).

Not expressible here (rows-only check): ``cluster_items`` (K-Means), ``tfidf_vectors``
(hashed MLlib vectors), ``listing_features`` (MLlib vectors).
"""

from __future__ import annotations

from ..functions.text import FREQUENCY_MIN_LENGTH, FREQUENCY_STOP_WORDS, WHITESPACE_CLASS, english_stop_words
from ..operators.cluster import HIDDEN_GEM_LABEL, HOTSPOT_LABEL, REGULAR_LABEL
from ..operators.profile import PROFILE_METRICS
from ..operators.search import DISPLAY_NAMES
from ..operators.text import TFIDF_DECIMALS
from ..sources.bindings import duckdb_ctes
from . import catalog as q


def d(x: float) -> str:
    """A DOUBLE literal."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def sround(expr: str, s: int) -> str:
    """Spark's ``round(double, s)``."""
    return f"CAST(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, {s})) AS DOUBLE)"


def fround(expr: str, s: int) -> str:
    """Spark's ``round(float, s)``."""
    return f"CAST(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, {s})) AS FLOAT)"


def lit_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def values_with_null(c: str) -> str:
    return f"(count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0))"


W = duckdb_ctes()

# ---------------------------------------------------------------- shared CTE fragments
POP = (
    "pc AS (SELECT item, grp, count(*) AS review_count FROM {src} GROUP BY item, grp), "
    "ps AS (SELECT min(review_count) AS mn, max(review_count) AS mx FROM pc), "
    "pop AS (SELECT item, grp, review_count, "
    + sround(
        f"(CAST(review_count AS DOUBLE) - CAST(mn AS DOUBLE)) / "
        f"NULLIF(CAST(mx AS DOUBLE) - CAST(mn AS DOUBLE), {d(0)}) * {d(100)}",
        2,
    )
    + " AS popularity_score FROM pc, ps), "
    "popr AS (SELECT item, grp, review_count, popularity_score, "
    "CAST(rank() OVER (PARTITION BY grp ORDER BY popularity_score DESC NULLS LAST) AS INTEGER) AS group_rank "
    "FROM pop)"
)

ORDER_POP = "popularity_score DESC NULLS LAST, item ASC NULLS FIRST, grp ASC NULLS FIRST"


def _hits(kw: str) -> str:
    k = kw.replace("'", "''")
    return f"CAST((length(lower(text)) - length(replace(lower(text), '{k}', ''))) / {max(len(kw), 1)} AS BIGINT)"


def _pattern_hits(pattern: str) -> str:
    p = pattern.replace("'", "''")
    removed = f"(length(lower(text)) - length(regexp_replace(lower(text), '{p}', '', 'g')))"
    return f"CAST({removed} AS DOUBLE) / {d(max(len(pattern), 1))}"


_KW_THRESHOLD = 0.05 * len(q.KEYWORDS)
KW_BASE = (
    "kp AS (SELECT item, grp, " + " + ".join(_hits(k) for k in q.KEYWORDS) + " AS hits FROM posts), "
    "kg AS (SELECT item, grp, count(*) AS review_count, CAST(coalesce(sum(hits), 0) AS DOUBLE) AS keyword_freq "
    "FROM kp GROUP BY item, grp), "
    "kd AS (SELECT *, keyword_freq / CAST(review_count AS DOUBLE) AS density FROM kg), "
    f"ks AS (SELECT min(review_count) AS mn, max(review_count) AS mx, "
    f"max(CASE WHEN density >= {d(_KW_THRESHOLD)} THEN density END) AS maxd FROM kd), "
    "kk AS (SELECT kd.*, "
    + sround(
        f"(CAST(review_count AS DOUBLE) - CAST(mn AS DOUBLE)) / "
        f"NULLIF(CAST(mx AS DOUBLE) - CAST(mn AS DOUBLE), {d(0)}) * {d(100)}",
        2,
    )
    + " AS pop, "
    + sround(f"density / greatest(maxd, {d(0.001)}) * {d(100)}", 2)
    + f" AS relevance_score, density >= {d(_KW_THRESHOLD)} AS kept FROM kd, ks)"
)


def _kw_final(source: str) -> str:
    return (
        "kf AS (SELECT item, grp, review_count, keyword_freq, relevance_score, "
        + sround(f"relevance_score * {d(0.8)} + coalesce(pop, {d(0)}) * {d(0.2)}", 2)
        + f" AS final_score FROM {source}), "
    )


_KR_ORDER = "ORDER BY final_score DESC NULLS LAST, item ASC NULLS FIRST, grp ASC NULLS FIRST"

# Default: popularity of the same (item, grp) pair.
KW = (
    KW_BASE + ", kj AS (SELECT * FROM kk WHERE kept), " + _kw_final("kj")
    + f"kr AS (SELECT * FROM kf {_KR_ORDER} LIMIT {q.RANKING_N})"
)
# Keywords as patterns.
KW_REGEX = KW.replace(" + ".join(_hits(k) for k in q.KEYWORDS), " + ".join(_pattern_hits(p) for p in q.PATTERNS))
# The reference's join: kept pairs joined to every pair's popularity on the item only.
KW_ITEM_JOIN = (
    KW_BASE + ", kj AS (SELECT k.item, k.grp, k.review_count, k.keyword_freq, k.relevance_score, p.pop "
    "FROM (SELECT * FROM kk WHERE kept) k LEFT JOIN kk p ON k.item = p.item), "
    + _kw_final("kj")
    + f"kr AS (SELECT * FROM kf {_KR_ORDER} LIMIT {q.RANKING_N})"
)
# Group filter after the top-n (the page's order) and before it.
KW_IN_GROUP = (
    KW_BASE + ", kj AS (SELECT * FROM kk WHERE kept), " + _kw_final("kj")
    + f"kt AS (SELECT * FROM kf {_KR_ORDER} LIMIT {q.RANKING_N}), "
    f"kr AS (SELECT * FROM kt WHERE grp = '{q.GROUP_FILTER}')"
)
KW_GROUP_FIRST = (
    KW_BASE + f", kj AS (SELECT * FROM kk WHERE kept AND grp = '{q.GROUP_FIRST_FILTER}'), " + _kw_final("kj")
    + f"kr AS (SELECT * FROM kf {_KR_ORDER} LIMIT {q.RANKING_N})"
)

LISTINGS = (
    "lt AS (SELECT listing_id, trim(name) AS name, trim(room_type) AS room_type, "
    "regexp_extract(trim(guests_raw), '(\\d+)', 1) AS gd, trim(stars_raw) AS st FROM listings_raw), "
    "listings AS (SELECT listing_id, name, room_type, "
    "CASE WHEN gd <> '' THEN TRY_CAST(gd AS INTEGER) END AS guests, "
    "CASE WHEN regexp_matches(st, '^\\d+(\\.\\d+)?$') THEN TRY_CAST(st AS FLOAT) END AS stars FROM lt "
    "WHERE (CASE WHEN regexp_matches(st, '^\\d+(\\.\\d+)?$') THEN TRY_CAST(st AS FLOAT) END) IS NOT NULL "
    "AND (CASE WHEN gd <> '' THEN TRY_CAST(gd AS INTEGER) END) > 0)"
)

# The reason of each row, over the trimmed cells ``lt`` of LISTINGS.
REASON_COUNTS = (
    "reasons AS (SELECT CASE WHEN NOT coalesce(regexp_matches(st, '^\\d+(\\.\\d+)?$'), FALSE) OR TRY_CAST(st AS FLOAT) IS NULL "
    "THEN 'bad_stars' WHEN coalesce(gd, '') = '' OR TRY_CAST(gd AS INTEGER) IS NULL THEN 'bad_guests' "
    "WHEN TRY_CAST(gd AS INTEGER) <= 0 THEN 'no_guests' ELSE 'kept' END AS reason FROM lt)"
)


def _room_ranking_cte(n: int) -> str:
    return (
        "rr AS (SELECT room_type, "
        + sround("avg(CAST(stars AS DOUBLE))", 2)
        + " AS avg_stars, count(*) AS listing_count, "
        + fround("max(stars)", 2)
        + " AS max_stars FROM listings GROUP BY room_type "
        f"ORDER BY avg_stars DESC NULLS LAST, room_type ASC NULLS FIRST LIMIT {n})"
    )


def _hybrid_ctes(room: str, guests: int, min_stars: float, n: int) -> str:
    type_filter = "" if room == "Any" else f" AND contains(lower(room_type), '{room.lower()}')"
    return (
        f"hc AS (SELECT * FROM listings WHERE CAST(stars AS DOUBLE) >= {d(min_stars)} "
        f"AND guests >= {guests}{type_filter}), "
        "hs AS (SELECT CAST(min(stars) AS DOUBLE) AS mn, CAST(max(stars) AS DOUBLE) AS mx FROM hc), "
        f"hb AS (SELECT CASE WHEN mn IS NULL OR mn = {d(0)} THEN {d(0)} ELSE mn END AS lo, "
        f"CASE WHEN mx IS NULL OR mx = {d(0)} THEN {d(5)} ELSE mx END AS hi FROM hs), "
        "hn AS (SELECT hc.*, "
        f"(CAST(stars AS DOUBLE) - lo) / (hi - lo + {d(0.001)}) AS stars_norm, "
        f"CASE WHEN guests = {guests} THEN {d(1.0)} WHEN guests <= {guests + 2} THEN {d(0.8)} "
        f"ELSE {d(0.5)} END AS guest_match_score FROM hc, hb), "
        "hh AS (SELECT *, "
        + sround(f"stars_norm * {d(0.7)} + guest_match_score * {d(0.3)}", 4)
        + " AS hybrid_score FROM hn), "
        f"hr AS (SELECT * FROM hh ORDER BY hybrid_score DESC NULLS LAST, listing_id ASC LIMIT {n})"
    )


def _content_ctes(room: str, guests: int, n: int) -> str:
    type_filter = "" if room == "Any" else f" AND contains(lower(room_type), '{room.lower()}')"
    return (
        f"cr AS (SELECT listing_id, name, room_type, guests, stars FROM listings WHERE guests >= {guests}"
        f"{type_filter} ORDER BY stars DESC NULLS LAST, guests DESC NULLS LAST, listing_id ASC LIMIT {n})"
    )


def _evaluate(recs: str, guests: int, min_stars: float = 4.0, room: str | None = None) -> str:
    matches = f" AND contains(lower(room_type), '{room.lower()}')" if room else ""
    return (
        f"ev AS (SELECT count(*) AS total_recommended, "
        f"CAST(count_if(CAST(stars AS DOUBLE) >= {d(min_stars)} AND guests >= {guests}{matches}) AS BIGINT) "
        f"AS relevant_count FROM {recs}), "
        "al AS (SELECT count(*) AS n_all FROM listings), "
        "em AS (SELECT coalesce("
        + sround("CAST(relevant_count AS DOUBLE) / NULLIF(CAST(total_recommended AS DOUBLE), " + d(0) + ")", 2)
        + f", {d(0)}) AS precision_at_k, total_recommended, relevant_count, "
        f"CASE WHEN total_recommended > 0 THEN coalesce("
        + sround(f"CAST(total_recommended AS DOUBLE) / NULLIF(CAST(n_all AS DOUBLE), {d(0)}) * {d(100)}", 2)
        + f", {d(0)}) ELSE {d(0)} END AS coverage FROM ev, al) "
        f"SELECT precision_at_k, total_recommended, relevant_count, coverage, "
        f"precision_at_k * {d(100)} AS precision_pct, "
        f"CASE WHEN precision_at_k * {d(100)} < {d(40)} THEN '0-40' "
        f"WHEN precision_at_k * {d(100)} < {d(70)} THEN '40-70' ELSE '70-100' END AS precision_band, "
        f"{d(70)} AS precision_target_pct FROM em"
    )


def _fixed_cluster_ctes(src: str = "sales") -> str:
    return (
        POP.format(src=src) + ", "
        f"fc AS (SELECT item, grp, review_count, popularity_score, "
        f"CAST(least(floor(popularity_score / {d(q.SCORE_BAND_WIDTH)}), {q.SCORE_BANDS - 1}) AS INTEGER) "
        "AS prediction FROM popr), "
        "fm AS (SELECT prediction, avg(popularity_score) AS m FROM fc GROUP BY prediction "
        "HAVING avg(popularity_score) IS NOT NULL), "
        "fhot AS (SELECT prediction AS hot FROM fm ORDER BY m DESC, prediction ASC LIMIT 1), "
        "fgem AS (SELECT prediction AS gem FROM fm ORDER BY m ASC, prediction ASC LIMIT 1), "
        "fl AS (SELECT fc.*, CASE "
        f"WHEN prediction = (SELECT gem FROM fgem) THEN '{HIDDEN_GEM_LABEL}' "
        f"WHEN prediction = (SELECT hot FROM fhot) THEN '{HOTSPOT_LABEL}' "
        f"ELSE '{REGULAR_LABEL}' END AS cluster_label FROM fc)"
    )


def _tfidf_ctes() -> str:
    stop = lit_list(english_stop_words())
    return (
        f"tk AS (SELECT item, unnest(regexp_split_to_array(lower(text), '{WHITESPACE_CLASS}')) AS term FROM posts), "
        f"tf AS (SELECT item, term, count(*) AS tf FROM tk WHERE term <> '' AND term NOT IN ({stop}) "
        "GROUP BY item, term), "
        "tdf AS (SELECT term, count(*) AS doc_freq FROM tf GROUP BY term), "
        f"tm AS (SELECT {values_with_null('item')} AS m FROM posts), "
        "tt AS (SELECT tf.item, tf.term, tf.tf, tdf.doc_freq, "
        + sround(
            f"CAST(tf.tf AS DOUBLE) * ln((CAST(m AS DOUBLE) + {d(1)}) / (CAST(tdf.doc_freq AS DOUBLE) + {d(1)}))",
            TFIDF_DECIMALS,
        )
        + " AS tfidf FROM tf JOIN tdf ON tf.term = tdf.term, tm)"
    )


def _buckets_select() -> str:
    stop = lit_list(english_stop_words())
    return (
        f"tk AS (SELECT item, unnest(regexp_split_to_array(lower(text), '{WHITESPACE_CLASS}')) AS term FROM posts), "
        f"bt AS (SELECT item, CAST(CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % {q.HASHED_FEATURES} AS INTEGER) AS bucket, "
        f"count(*) AS tf FROM tk WHERE term <> '' AND term NOT IN ({stop}) GROUP BY 1, 2), "
        "bd AS (SELECT bucket, count(*) AS doc_freq FROM bt GROUP BY bucket), "
        f"tm AS (SELECT {values_with_null('item')} AS m FROM posts) "
        "SELECT item, bt.bucket, tf, doc_freq, "
        + sround(f"CAST(tf AS DOUBLE) * ln((CAST(m AS DOUBLE) + {d(1)}) / (CAST(doc_freq AS DOUBLE) + {d(1)}))", TFIDF_DECIMALS)
        + " AS tfidf FROM bt JOIN bd ON bt.bucket = bd.bucket, tm"
    )


def _optimal_ctes() -> str:
    """The best four intervals of the count, by trying every three cuts of its histogram."""
    return (
        f"{POP.format(src='sales')}, "
        "hi AS (SELECT review_count AS x, count(*) AS w, row_number() OVER (ORDER BY review_count) AS i FROM popr GROUP BY review_count), "
        "hc AS (SELECT i, x, sum(w) OVER o AS cw, sum(w * x) OVER o AS cx, sum(w * x * x) OVER o AS cxx FROM hi WINDOW o AS (ORDER BY i) "
        "UNION ALL SELECT 0, NULL, 0, 0, 0), "
        "sg AS (SELECT a.i AS a, b.i AS b, CAST((b.cw - a.cw) * (b.cxx - a.cxx) - (b.cx - a.cx) * (b.cx - a.cx) AS DOUBLE) "
        "/ CAST(b.cw - a.cw AS DOUBLE) AS c FROM hc a JOIN hc b ON a.i < b.i), "
        "ct AS (SELECT p.b AS p, q.b AS q, r.b AS r FROM sg p JOIN sg q ON q.a = p.b JOIN sg r ON r.a = q.b JOIN sg t ON t.a = r.b "
        "WHERE p.a = 0 AND t.b = (SELECT max(i) FROM hi) ORDER BY p.c + q.c + r.c + t.c, p.b, q.b, r.b LIMIT 1), "
        "oc AS (SELECT item, grp, review_count, popularity_score, CAST(CASE WHEN i <= p THEN 0 WHEN i <= q THEN 1 WHEN i <= r THEN 2 "
        "ELSE 3 END AS INTEGER) AS prediction FROM popr JOIN hi ON review_count = x, ct)"
    )


def _top_words_cte(n: int) -> str:
    return (
        "tw AS (SELECT word, count(*) AS frequency FROM "
        "(SELECT unnest(string_split(lower(text), ' ')) AS word FROM posts) "
        f"WHERE length(word) > {FREQUENCY_MIN_LENGTH} AND word NOT IN ({lit_list(FREQUENCY_STOP_WORDS)}) "
        f"GROUP BY word ORDER BY frequency DESC, word ASC LIMIT {n})"
    )


def _profile(src: str, prefix: str) -> str:
    cols = ["post_id", "item", "grp", "period", "text"]
    nulls = " + ".join(f"count_if({c} IS NULL OR CAST({c} AS VARCHAR) = '')" for c in cols)
    return (
        f"{prefix} AS (SELECT count(*) AS total_rows, CAST({nulls} AS BIGINT) AS null_values, "
        f"{values_with_null('item')} AS unique_items, {values_with_null('grp')} AS unique_groups FROM {src})"
    )


def _display_select(kind: str = "keyword") -> str:
    return ", ".join(f'{c} AS "{label}"' for c, label in DISPLAY_NAMES[kind].items())


_room, _guests, _min_stars, _n = q.HYBRID_ARGS
_croom, _cguests, _cn = q.CONTENT_ARGS
_m = PROFILE_METRICS

def _feature_vectors(columns: str) -> str:
    """The vectors of the scalar features' query and their unit form."""
    v = ["CAST(room_type_index AS DOUBLE)", "CAST(guest_bucket AS DOUBLE)", f"coalesce(stars_normalised, {d(0)})"]
    size = f"sqrt({' + '.join(f'{x} * {x}' for x in v)})"
    plain = ", ".join(f"{x} AS feature_{i}" for i, x in enumerate(v, 1))
    unit = ", ".join(sround(f"CASE WHEN {size} > 0 THEN {x} / {size} ELSE {x} END", 9) + f" AS normalised_{i}" for i, x in enumerate(v, 1))
    return f"SELECT listing_id, room_type_index, {plain}, {unit} FROM ({columns})"


def oracle_queries() -> dict[str, str]:
    """DuckDB SQL by query name; built when asked for, nothing is done at import."""
    features = (
        f"{W}, {LISTINGS}, "
        "lb AS (SELECT room_type, count(*) AS f FROM listings WHERE room_type IS NOT NULL GROUP BY room_type), "
        "li AS (SELECT room_type, CAST(row_number() OVER (ORDER BY f DESC, room_type ASC) - 1 AS INTEGER) AS idx FROM lb), "
        "nl AS (SELECT CAST(count(*) AS INTEGER) AS n_labels FROM lb), "
        "lm AS (SELECT CAST(min(stars) AS DOUBLE) AS mn, CAST(max(stars) AS DOUBLE) AS mx FROM listings) "
        "SELECT l.listing_id, CASE WHEN l.guests = 1 THEN 1 WHEN l.guests = 2 THEN 2 "
        "WHEN l.guests BETWEEN 3 AND 4 THEN 3 WHEN l.guests >= 5 THEN 4 ELSE 1 END AS guest_bucket, "
        f"(CAST(l.stars AS DOUBLE) - mn) / NULLIF(mx - mn, {d(0)}) AS stars_normalised, "
        "coalesce(li.idx, n_labels) AS room_type_index "
        "FROM listings l LEFT JOIN li ON l.room_type = li.room_type, nl, lm"
    )
    return {
        "top_items": f"{W} SELECT item, count(*) AS review_count FROM posts GROUP BY item "
        f"ORDER BY review_count DESC, item ASC NULLS FIRST LIMIT {q.TOP_ITEMS_N}",
        "group_counts": f"{W} SELECT grp, count(*) AS review_count FROM posts GROUP BY grp "
        "ORDER BY review_count DESC, grp ASC NULLS FIRST",
        "group_shares": f"{W}, gc AS (SELECT grp, count(*) AS review_count FROM posts GROUP BY grp), "
        "gt AS (SELECT sum(review_count) AS total FROM gc) "
        f"SELECT grp, review_count, CAST(review_count AS DOUBLE) * {d(100)} / CAST(total AS DOUBLE) AS share_pct "
        "FROM gc, gt ORDER BY review_count DESC, grp ASC NULLS FIRST",
        "period_trend": f"{W} SELECT period, count(*) AS review_count FROM posts GROUP BY period "
        "ORDER BY period ASC NULLS FIRST",
        "distinct_items_per_group": f"{W} SELECT grp, count(DISTINCT item) AS unique_items FROM posts GROUP BY grp "
        "ORDER BY unique_items DESC, grp ASC NULLS FIRST",
        "posts_overview": f"{W} SELECT count(*) AS total_posts, {values_with_null('item')} AS total_items, "
        f"{values_with_null('grp')} AS total_groups, {values_with_null('period')} AS total_periods FROM posts",
        "posts_overview_sketches": f"{W} SELECT count(*) AS total_posts, {values_with_null('item')} AS total_items, "
        f"{values_with_null('grp')} AS total_groups, {values_with_null('period')} AS total_periods FROM posts_raw",
        "group_options": f"{W} SELECT grp FROM (SELECT 'All Districts' AS grp, 0 AS o "
        "UNION ALL SELECT DISTINCT grp, 1 AS o FROM posts) ORDER BY o, grp ASC NULLS FIRST",
        "cleaning_comparison": f"{W}, {_profile('posts_raw', 'pr')}, {_profile('posts', 'pcl')} "
        f"SELECT metric, raw_value, clean_value FROM ("
        f"SELECT 0 AS o, '{_m[0]}' AS metric, pr.total_rows AS raw_value, pcl.total_rows AS clean_value FROM pr, pcl "
        f"UNION ALL SELECT 1, '{_m[1]}', pr.null_values, pcl.null_values FROM pr, pcl "
        f"UNION ALL SELECT 2, '{_m[2]}', pr.unique_items, pcl.unique_items FROM pr, pcl "
        f"UNION ALL SELECT 3, '{_m[3]}', pr.unique_groups, pcl.unique_groups FROM pr, pcl) ORDER BY o",
        "popularity_score": f"{W}, {POP.format(src='posts')} SELECT * FROM popr ORDER BY {ORDER_POP}",
        "popularity_score_stored": f"{W}, {POP.format(src='posts_raw')} SELECT * FROM popr ORDER BY {ORDER_POP}",
        "popularity_score_sales": f"{W}, {POP.format(src='sales')} SELECT * FROM popr ORDER BY {ORDER_POP}",
        "top_popular": f"{W}, {POP.format(src='posts')} SELECT * FROM popr ORDER BY {ORDER_POP} LIMIT {q.TOP_POPULAR_N}",
        "top_popular_50": f"{W}, {POP.format(src='posts')} SELECT * FROM popr ORDER BY {ORDER_POP} "
        f"LIMIT {q.TOP_POPULAR_WIDE_N}",
        "browse_popular": f"{W}, {POP.format(src='posts')} SELECT * FROM popr "
        f"WHERE popularity_score >= {d(q.BROWSE_MIN_SCORE)} ORDER BY {ORDER_POP} LIMIT {q.BROWSE_N}",
        "browse_popular_in_group": f"{W}, {POP.format(src='posts')} SELECT * FROM popr "
        f"WHERE grp = '{q.GROUP_FILTER}' AND popularity_score >= {d(q.BROWSE_MIN_SCORE)} "
        f"ORDER BY {ORDER_POP} LIMIT {q.BROWSE_N}",
        "browse_summary": f"{W}, {POP.format(src='posts')}, br AS (SELECT * FROM popr "
        f"WHERE popularity_score >= {d(q.BROWSE_MIN_SCORE)} ORDER BY {ORDER_POP} LIMIT {q.BROWSE_N}) "
        "SELECT count(*) AS result_count, "
        + sround("avg(popularity_score)", 4)
        + " AS avg_score, count(DISTINCT grp) AS groups_covered FROM br",
        "browse_score_by_group": f"{W}, {POP.format(src='posts')}, br AS (SELECT * FROM popr "
        f"WHERE popularity_score >= {d(q.BROWSE_MIN_SCORE)} ORDER BY {ORDER_POP} LIMIT {q.BROWSE_N}) "
        "SELECT grp, "
        + sround("sum(popularity_score)", 2)
        + " AS total_score FROM br GROUP BY grp",
        "avg_popularity_by_group": f"{W}, {POP.format(src='posts')} SELECT grp, "
        + sround("avg(popularity_score)", 4)
        + " AS avg_popularity FROM popr GROUP BY grp ORDER BY avg_popularity DESC NULLS LAST, grp ASC NULLS FIRST",
        "top_words_heavy": f"{W}, {_top_words_cte(q.TOP_WORDS_N)} SELECT * FROM tw ORDER BY frequency DESC, word",
        "top_words": f"{W}, {_top_words_cte(q.TOP_WORDS_N)} SELECT * FROM tw ORDER BY frequency DESC, word",
        "word_frequency_map": f"{W}, {_top_words_cte(q.WORD_MAP_N)} "
        "SELECT CAST(to_json(map_from_entries(list({'k': word, 'v': frequency} ORDER BY word))) AS VARCHAR) "
        "AS word_freq_json FROM tw",
        "tfidf_terms": f"{W}, {_tfidf_ctes()} SELECT * FROM tt",
        "tfidf_buckets": f"{W}, {_buckets_select()}",
        "cluster_items_optimal": f"{W}, {_optimal_ctes()} SELECT * FROM oc",
        "cluster_cost": f"{W}, {_optimal_ctes()} SELECT prediction, count(*) AS item_count, "
        + sround("CAST(sum(review_count) AS DOUBLE) / count(*)", 4)
        + " AS mean_count, "
        + sround("CAST(sum(review_count * review_count) AS DOUBLE) - CAST(sum(review_count) AS DOUBLE) * CAST(sum(review_count) AS DOUBLE) "
                 "/ count(*)", 4)
        + " AS cost FROM oc GROUP BY prediction",
        "posts_from_csv": f"{W} SELECT * FROM posts",
        "listings_from_csv": f"{W}, {LISTINGS} SELECT * FROM listings",
        "top_tfidf_terms": f"{W}, {_tfidf_ctes()} SELECT * FROM (SELECT *, CAST(row_number() OVER "
        f"(PARTITION BY item ORDER BY tfidf DESC, term ASC) AS INTEGER) AS term_rank FROM tt) "
        f"WHERE term_rank <= {q.TOP_TERMS_N}",
        "keyword_ranking": f"{W}, {KW} SELECT * FROM kr ORDER BY final_score DESC, item, grp",
        "keyword_ranking_item_join": f"{W}, {KW_ITEM_JOIN} SELECT * FROM kr",
        "keyword_ranking_in_group": f"{W}, {KW_IN_GROUP} SELECT * FROM kr",
        "keyword_ranking_group_first": f"{W}, {KW_GROUP_FIRST} SELECT * FROM kr",
        "ranking_summary": f"{W}, {KW} SELECT count(*) AS result_count, "
        + sround("avg(relevance_score)", 4)
        + " AS avg_score, count(DISTINCT grp) AS groups_covered FROM kr",
        "score_by_group": f"{W}, {KW} SELECT grp, "
        + sround("sum(final_score)", 2)
        + " AS total_score FROM kr GROUP BY grp ORDER BY total_score DESC, grp",
        "top_recommendation": f"{W}, {KW} SELECT item, grp, final_score AS score, review_count FROM kr "
        "ORDER BY final_score DESC NULLS LAST, item ASC NULLS FIRST, grp ASC NULLS FIRST LIMIT 1",
        "display_columns": f"{W}, {KW} SELECT {_display_select()} FROM kr",
        "display_columns_popularity": f"{W}, {POP.format(src='posts')}, br AS (SELECT * FROM popr "
        f"WHERE popularity_score >= {d(q.BROWSE_MIN_SCORE)} ORDER BY {ORDER_POP} LIMIT {q.BROWSE_N}) "
        f"SELECT {_display_select('popularity')} FROM br",
        "label_clusters": f"{W}, {_fixed_cluster_ctes()} SELECT * FROM fl",
        "cluster_summary": f"{W}, {_fixed_cluster_ctes()} SELECT cluster_label, count(*) AS item_count, "
        + sround("avg(popularity_score)", 2)
        + " AS avg_popularity, "
        + sround("avg(CAST(review_count AS DOUBLE))", 2)
        + " AS avg_reviews FROM fl GROUP BY cluster_label ORDER BY cluster_label",
        "cluster_samples": f"{W}, {_fixed_cluster_ctes()} SELECT cluster_label, item, grp, review_count, "
        "popularity_score, sample_rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY cluster_label "
        f"ORDER BY {ORDER_POP}) AS INTEGER) AS sample_rank FROM fl) WHERE sample_rank <= {q.SAMPLES_N}",
        "clean_listings": f"{W}, {LISTINGS} SELECT * FROM listings",
        "listings_rejected": f"{W}, {LISTINGS}, {REASON_COUNTS} "
        "SELECT r.reason, count(t.reason) AS listings FROM (VALUES ('kept'), ('bad_stars'), ('bad_guests'), ('no_guests')) r(reason) "
        "LEFT JOIN reasons t ON t.reason = r.reason GROUP BY r.reason",
        "catalogue_bounds": f"{W}, {LISTINGS} SELECT count(*) AS total_listings, min(stars) AS min_stars, max(stars) AS max_stars, "
        "min(guests) AS min_guests, max(guests) AS max_guests FROM listings",
        "listings_overview": f"{W}, {LISTINGS} SELECT count(*) AS total_listings, "
        f"{values_with_null('room_type')} AS unique_room_types, "
        + sround("avg(CAST(stars AS DOUBLE))", 2)
        + " AS avg_stars, max(guests) AS max_guests FROM listings",
        "room_types": f"{W}, {LISTINGS} SELECT room_type FROM (SELECT 'Any' AS room_type, 0 AS o "
        "UNION ALL SELECT DISTINCT room_type, 1 AS o FROM listings) ORDER BY o, room_type ASC NULLS FIRST",
        "listing_feature_columns": features,
        "listing_feature_vectors": _feature_vectors(features),
        "content_recommendations": f"{W}, {LISTINGS}, {_content_ctes(_croom, _cguests, _cn)} SELECT * FROM cr",
        "room_type_ranking": f"{W}, {LISTINGS} SELECT room_type, "
        + sround("avg(CAST(stars AS DOUBLE))", 2)
        + " AS avg_stars, count(*) AS listing_count, "
        + fround("max(stars)", 2)
        + f" AS max_stars FROM listings GROUP BY room_type "
        f"ORDER BY avg_stars DESC NULLS LAST, room_type ASC NULLS FIRST LIMIT {q.ROOM_RANKING_N}",
        "hybrid_recommendations": f"{W}, {LISTINGS}, {_hybrid_ctes(*q.HYBRID_ARGS)} "
        "SELECT listing_id, name, room_type, guests, stars, guest_match_score, hybrid_score FROM hr",
        "hybrid_recommendations_typed": f"{W}, {LISTINGS}, {_hybrid_ctes(*q.HYBRID_TYPED_ARGS)} "
        "SELECT listing_id, name, room_type, guests, stars, guest_match_score, hybrid_score FROM hr",
        "score_breakdown": f"{W}, {LISTINGS}, {_hybrid_ctes(*q.HYBRID_ARGS)} "
        f"SELECT listing_id, name, stars_norm * {d(0.7)} AS stars_part, guest_match_score * {d(0.3)} AS match_part, "
        "hybrid_score FROM hr",
        "top_listing": f"{W}, {LISTINGS}, {_hybrid_ctes(*q.HYBRID_ARGS)} "
        "SELECT listing_id, name, room_type, guests, stars, hybrid_score AS score FROM hr "
        "ORDER BY hybrid_score DESC NULLS LAST, listing_id ASC LIMIT 1",
        "recommendation_summary": f"{W}, {LISTINGS}, {_hybrid_ctes(*q.HYBRID_ARGS)} "
        "SELECT count(*) AS total_recommendations, "
        + sround("avg(CAST(stars AS DOUBLE))", 2)
        + " AS avg_stars, max(stars) AS top_stars, "
        + sround("avg(hybrid_score)", 3)
        + " AS avg_hybrid_score FROM hr",
        "room_type_distribution": f"{W}, {LISTINGS}, {_hybrid_ctes(*q.HYBRID_ARGS)} "
        "SELECT room_type, count(*) AS listing_count FROM hr GROUP BY room_type "
        "ORDER BY listing_count DESC, room_type ASC NULLS FIRST",
        "content_summary": f"{W}, {LISTINGS}, {_content_ctes(_croom, _cguests, _cn)} "
        "SELECT count(*) AS total_recommendations, "
        + sround("avg(CAST(stars AS DOUBLE))", 2)
        + " AS avg_stars, max(stars) AS top_stars, CAST(NULL AS DOUBLE) AS avg_hybrid_score FROM cr",
        "content_room_type_distribution": f"{W}, {LISTINGS}, {_content_ctes(_croom, _cguests, _cn)} "
        "SELECT room_type, count(*) AS listing_count FROM cr GROUP BY room_type",
        "evaluate_hybrid": f"{W}, {LISTINGS}, {_hybrid_ctes(*q.HYBRID_ARGS)}, {_evaluate('hr', _guests)}",
        "evaluate_hybrid_room_type": f"{W}, {LISTINGS}, {_hybrid_ctes(*q.HYBRID_ARGS)}, "
        + _evaluate("hr", _guests, room=q.EVALUATED_ROOM_TYPE),
        "content_top_listing": f"{W}, {LISTINGS}, {_content_ctes(_croom, _cguests, _cn)} "
        "SELECT listing_id, name, room_type, guests, stars, CAST(stars AS DOUBLE) AS score FROM cr "
        "ORDER BY stars DESC NULLS LAST, guests DESC NULLS LAST, listing_id ASC LIMIT 1",
        "room_type_summary": f"{W}, {LISTINGS}, {_room_ranking_cte(q.ROOM_RANKING_N)} "
        "SELECT count(*) AS total_recommendations, CAST(NULL AS DOUBLE) AS avg_stars, CAST(NULL AS FLOAT) AS top_stars, "
        "CAST(NULL AS DOUBLE) AS avg_hybrid_score FROM rr",
        "room_type_top": f"{W}, {LISTINGS}, {_room_ranking_cte(q.ROOM_RANKING_N)} "
        "SELECT *, avg_stars AS score FROM rr ORDER BY avg_stars DESC NULLS LAST, room_type ASC NULLS FIRST LIMIT 1",
        "keyword_ranking_min_score": f"{W}, {KW} SELECT item, grp, review_count, keyword_freq, relevance_score, "
        f"final_score FROM kr WHERE final_score >= {d(q.MIN_FINAL_SCORE)}",
        "keyword_ranking_regex": f"{W}, {KW_REGEX} SELECT item, grp, review_count, keyword_freq, relevance_score, "
        "final_score FROM kr",
        "avg_popularity_by_group_raw": f"{W}, {POP.format(src='posts_raw')} SELECT grp, "
        + sround("avg(popularity_score)", 4)
        + " AS avg_popularity FROM popr WHERE grp IS NOT NULL GROUP BY grp",
        "cluster_summary_raw": f"{W}, {_fixed_cluster_ctes('posts_raw')} SELECT cluster_label, count(item) AS item_count, "
        + sround("avg(popularity_score)", 2)
        + " AS avg_popularity, "
        + sround("avg(CAST(review_count AS DOUBLE))", 2)
        + " AS avg_reviews FROM fl GROUP BY cluster_label ORDER BY cluster_label",
        "evaluate_content": f"{W}, {LISTINGS}, {_content_ctes(_croom, _cguests, _cn)}, {_evaluate('cr', _cguests)}",
    }
