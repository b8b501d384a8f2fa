"""Text analytics over ``posts``: word frequencies, exact TF-IDF by term, MLlib TF-IDF
vectors.

No operator concatenates the texts of an item into one value: every text is tokenised on
its own and counts are summed per item (partial aggregation before each shuffle), so a hot
item costs one partial row per (term, task), not one giant string in one task. Stop words
and empty tokens are removed before the first aggregation shuffle. A table is read by as
many tasks as its files and row groups allow: lay it out when it is written.

Document model of TF-IDF (as in the reference): one document per item (a NULL item is one
document), made of all its posts. Tokens follow MLlib ``Tokenizer`` (lowercase, split on
each whitespace character) and default English ``StopWordsRemover``; empty tokens are not
terms. ``idf = ln((m + 1) / (df + 1))`` with ``m`` documents, as in MLlib ``IDF``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, IDF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    FREQUENCY_MIN_LENGTH,
    FREQUENCY_STOP_WORDS,
    attach_stats,
    blank_split_words,
    count_values_with_null,
    english_stop_words,
    not_in_words,
    tokens,
)
from ..schema import require_columns
from ..session import materialize

TFIDF_DECIMALS = 6  # reported precision of tf-idf scores


def top_words(posts: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent words: (word, frequency). Words are the lowercased text split on
    single blanks, longer than three characters, not in the fixed stop list."""
    require_columns(posts, "text")
    words = posts.select(F.explode(blank_split_words("text")).alias("word"))
    kept = words.where(
        (F.length("word") > F.lit(FREQUENCY_MIN_LENGTH)) & not_in_words("word", FREQUENCY_STOP_WORDS)
    )
    counts = kept.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))
    return counts.orderBy(F.col("frequency").desc(), F.col("word")).limit(n)


# Fixed values of Spark's frequency sketch: it keeps three quarters of its map's slots filled, and
# a count is off by at most this factor times all words over the slots.
_SKETCH_FILL, _SKETCH_ERROR = 0.75, 3.5
SKETCH_SLOTS = 1 << 14
MOST_SKETCHED = 256  # characters of a word that enters the sketch, so that its size is bounded


def heavy_top_words(posts: DataFrame, n: int = 20, slots: int = SKETCH_SLOTS) -> DataFrame:
    """The rows of ``top_words``, exact, without shuffling every distinct word.

    A mergeable frequency sketch of ``slots`` slots (a power of two) a task names candidates in a
    first pass; a second pass counts the candidates alone, so that a task shuffles at most that many
    rows. A word that is no candidate occurs at most ``bound`` times: twice the sketch's error, or
    the least candidate's estimate where all places for candidates are taken. If the n-th count is
    above the bound, the result is complete. If it is not, the third branch counts every word, which
    is the exact way for flat distributions; otherwise adaptive execution finds its gate empty and
    drops the branch before it reads the texts. Words of more than ``MOST_SKETCHED`` characters are
    counted plainly beside the candidates, in the same pass.

    Defined cases: null and empty texts have no words; ties go to the smaller word; an empty table
    gives no rows; other columns are not read. ``n`` is at most a quarter of the slots."""
    require_columns(posts, "text")
    if slots & (slots - 1) or not 0 < n <= slots // 4:
        raise ValueError("slots must be a power of two, and n at most a quarter of it")
    tracked, most = int(slots * _SKETCH_FILL), slots // 2

    def words(rows: DataFrame) -> DataFrame:
        out = rows.select(F.explode(blank_split_words("text")).alias("word"))
        return out.where((F.length("word") > F.lit(FREQUENCY_MIN_LENGTH)) & not_in_words("word", FREQUENCY_STOP_WORDS))

    short = words(posts).where(F.length("word") <= F.lit(MOST_SKETCHED))
    sketched = short.agg(
        F.expr(f"approx_top_k(word, {most}, {tracked})").alias("_found"), F.count(F.lit(1)).alias("_total")
    )
    error = F.floor(F.lit(2 * _SKETCH_ERROR / slots) * F.col("_total"))
    least = F.when(F.size("_found") >= F.lit(most), F.array_min(F.transform("_found", lambda x: x["count"])))
    # One row, at most ``most`` short words: read by both branches, so it is written once.
    first = materialize(sketched.select(F.transform("_found", lambda x: x["item"]).alias("_words"),
                                        F.greatest(error, F.coalesce(least, F.lit(0))).alias("_bound")))
    candidates = first.select(F.explode("_words").alias("_word"))
    met = words(posts).join(F.broadcast(candidates), F.col("word") == F.col("_word"), "left")
    met = met.where(F.col("_word").isNotNull() | (F.length("word") > F.lit(MOST_SKETCHED)))
    counted = met.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))
    # At most n rows, read for the proof and for the result.
    top = materialize(counted.orderBy(F.col("frequency").desc(), F.col("word")).limit(n))

    proof = top.agg(F.count(F.lit(1)).alias("_rows"), F.min("frequency").alias("_least")).crossJoin(
        F.broadcast(first.select("_bound"))
    )
    proven = (F.col("_bound") < F.lit(1)) | ((F.col("_rows") == F.lit(n)) & (F.col("_least") > F.col("_bound")))
    proof = proof.select(proven.alias("_proven"))
    every = posts.select("text").crossJoin(F.broadcast(proof.where(~F.col("_proven")).select(F.lit(1).alias("_all"))))
    every = words(every).groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))
    every = every.orderBy(F.col("frequency").desc(), F.col("word")).limit(n)
    best = top.crossJoin(F.broadcast(proof.where("_proven"))).drop("_proven")
    return best.unionByName(every).orderBy(F.col("frequency").desc(), F.col("word"))


def word_frequency_map(words: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` most frequent entries of a (word, frequency) table, e.g. ``top_words``, as
    one row holding a ``map<string, bigint>`` sorted by word: (word_freq). The top-n is
    taken first, so the single row -- and the one task that builds it -- holds at most
    ``n`` entries whatever the input size."""
    top = words.orderBy(F.col("frequency").desc(), F.col("word")).limit(n)
    entries = F.array_sort(F.collect_list(F.struct(F.col("word"), F.col("frequency"))))
    return top.agg(F.map_from_entries(entries).alias("word_freq"))


def _terms(posts: DataFrame, stop_words: tuple[str, ...]) -> DataFrame:
    exploded = posts.select("item", F.explode(tokens("text")).alias("term"))
    return exploded.where((F.col("term") != F.lit("")) & not_in_words("term", stop_words))


def tfidf_terms(posts: DataFrame, stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """Exact TF-IDF per (item, term): (item, term, tf, doc_freq, tfidf).

    ``tf`` -- occurrences of the term in the item's posts; ``doc_freq`` -- items whose
    posts contain it; ``tfidf = tf * ln((m + 1) / (doc_freq + 1))`` rounded to 6 decimals.
    Plan: partial+final aggregate on (item, term); a second aggregate on term, which gets
    the idf (``m`` is a one-row aggregate attached per term); sort-merge join on term. A term
    present in most items is split at run time: both sides of the join come from a shuffle
    made for it, which AQE's skew handling needs.
    """
    require_columns(posts, "item", "text")
    stop = english_stop_words() if stop_words is None else tuple(stop_words)
    tf = _terms(posts, stop).groupBy("item", "term").agg(F.count(F.lit(1)).alias("tf"))
    # Counted as sum(least(tf, 1)) (= the number of items, tf >= 1) rather than count(*):
    # the (item, term) aggregate then keeps its count in both branches, stays identical,
    # and its exchange is reused instead of tokenising the text a second time (Catalyst
    # prunes an unused count, and rewrites count(tf) of a non-null column to count(*)).
    # Grouped by the term and its hash: an aggregate on the term alone would already be
    # partitioned for the join, and a join side that is no shuffle of its own keeps AQE from
    # splitting a hot term on the other side. The extra shuffle moves one row a term.
    doc_freq = (
        tf.groupBy(F.xxhash64("term").alias("_hash"), "term")
        .agg(F.sum(F.least(F.col("tf"), F.lit(1))).alias("doc_freq"))
        .drop("_hash")
    )
    # The document count is attached to the per-term table, so the idf is computed once
    # per term and the (item, term) rows only multiply.
    idf = F.log((F.col("_m").cast("double") + 1.0) / (F.col("doc_freq").cast("double") + 1.0))
    n_docs = count_values_with_null("item").alias("_m")
    per_term = attach_stats(doc_freq, posts, n_docs).select("term", "doc_freq", idf.alias("_idf"))
    # The per-term table grows with the vocabulary, which has no size bound: join it with a
    # sort-merge join (it spills; AQE splits a skewed term) rather than let it be broadcast.
    # Even at sf0.1 the broadcast (collected and hashed on the driver) was the slower plan.
    return tf.join(per_term.hint("merge"), "term").select(
        "item",
        "term",
        "tf",
        "doc_freq",
        F.round(F.col("tf").cast("double") * F.col("_idf"), TFIDF_DECIMALS).alias("tfidf"),
    )


def top_tfidf_terms(terms: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest-scoring terms of every item (ties by term):
    (item, term, tf, doc_freq, tfidf, term_rank). ``row_number() <= n`` is planned as a
    WindowGroupLimit, which keeps at most ``n`` rows per item in each task before the
    shuffle, so a large item never reaches one task whole."""
    w = Window.partitionBy("item").orderBy(F.col("tfidf").desc(), F.col("term"))
    ranked = terms.withColumn("term_rank", F.row_number().over(w))
    return ranked.where(F.col("term_rank") <= F.lit(n))


def tfidf_vectors(posts: DataFrame, num_features: int = 1000,
                  stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """MLlib TF-IDF vectors, one per item: (item, n_terms, tfidf).

    Each post goes through a ``Pipeline`` of ``Tokenizer`` -> ``StopWordsRemover`` (empty
    tokens removed too) -> ``HashingTF(num_features)``; the per-post vectors are summed per
    item with ``Summarizer.sum`` (a partial aggregate: no text concatenation); ``IDF`` is
    fitted on the per-item vectors, which are checkpointed first because the fit and the
    transform both scan them. The vector is returned as ``array<double>``.
    """
    require_columns(posts, "item", "text")
    stop = list(english_stop_words() if stop_words is None else stop_words) + [""]
    docs = posts.select("item", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    per_post = Pipeline(
        stages=[
            Tokenizer(inputCol="text", outputCol="_words"),
            StopWordsRemover(inputCol="_words", outputCol="_terms", stopWords=stop),
            HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=num_features),
        ]
    ).fit(docs)  # stateless stages: fitting runs no job
    hashed = per_post.transform(docs)
    per_item = hashed.groupBy("item").agg(Summarizer.sum(F.col("_tf")).alias("tf"))
    per_item = materialize(per_item)
    model = IDF(inputCol="tf", outputCol="_tfidf", minDocFreq=0).fit(per_item)
    out = model.transform(per_item)
    return out.select(
        "item",
        F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda acc, x: acc + x).cast("long").alias("n_terms"),
        vector_to_array("_tfidf").alias("tfidf"),
    )


BUCKETINGS = ("mllib", "md5")


def _bucket(term: str, num_features: int, how: str) -> Column:
    """Hash bucket of a term without Python: 'md5' takes the digest's first 32 bits; 'mllib' is
    HashingTF's bucket, read off the hashed vector of the column ``_one`` (the term alone)."""
    if how == "md5":
        return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % F.lit(num_features)).cast("int")
    return (F.array_position(vector_to_array("_hashed"), F.lit(1.0)) - 1).cast("int")


def tfidf_buckets(posts: DataFrame, num_features: int = 1000, stop_words: tuple[str, ...] | None = None,
                  buckets: str = "mllib") -> DataFrame:
    """Hashed TF-IDF as rows: (item, bucket, tf, doc_freq, tfidf), one row per bucket that an item's
    posts fill. ``tf`` counts the terms of the bucket, ``doc_freq`` the items that fill it, and
    ``tfidf = tf * ln((m + 1) / (doc_freq + 1))`` rounded to 6 decimals.

    The values are those of ``tfidf_vectors`` (``buckets="mllib"``), but no vector of
    ``num_features`` numbers is made per item: counts per (item, term) are combined before the
    shuffle, a term is hashed once per item, and only filled buckets are kept. The per-bucket table
    has at most ``num_features`` rows, which bounds its broadcast."""
    require_columns(posts, "item", "text")
    if buckets not in BUCKETINGS:
        raise ValueError(f"buckets must be one of {BUCKETINGS}")
    stop = english_stop_words() if stop_words is None else tuple(stop_words)
    counts = _terms(posts, stop).groupBy("item", "term").agg(F.count(F.lit(1)).alias("_n"))
    if buckets == "mllib":
        hashing = HashingTF(inputCol="_one", outputCol="_hashed", numFeatures=num_features)
        counts = hashing.transform(counts.withColumn("_one", F.array("term")))
    hashed = counts.select("item", _bucket("term", num_features, buckets).alias("bucket"), "_n")
    filled = hashed.groupBy("item", "bucket").agg(F.sum("_n").alias("tf"))
    # Summed from the counts, so that both readers keep one (item, bucket) exchange.
    doc_freq = filled.groupBy("bucket").agg(F.sum(F.least(F.col("tf"), F.lit(1))).alias("doc_freq"))
    idf = F.log((F.col("_m").cast("double") + 1.0) / (F.col("doc_freq").cast("double") + 1.0))
    per_bucket = attach_stats(doc_freq, posts, count_values_with_null("item").alias("_m"))
    per_bucket = per_bucket.select(F.col("bucket").alias("_bucket"), "doc_freq", idf.alias("_idf"))
    joined = filled.join(F.broadcast(per_bucket), F.col("bucket") == F.col("_bucket"))
    return joined.select("item", "bucket", "tf", "doc_freq",
                         F.round(F.col("tf").cast("double") * F.col("_idf"), TFIDF_DECIMALS).alias("tfidf"))


def tfidf_sparse_vectors(posts: DataFrame, num_features: int = 1000, stop_words: tuple[str, ...] | None = None,
                         buckets: str = "mllib") -> DataFrame:
    """``tfidf_buckets`` as one sparse vector per item: (item, n_terms, indices array<int>, values
    array<double>), indices rising. An item without terms has empty arrays. A vector holds the
    item's filled buckets, ``num_features`` at most."""
    filled = tfidf_buckets(posts, num_features, stop_words, buckets).select("item", "bucket", "tf", "tfidf")
    none = posts.select("item", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("long").alias("tf"), F.lit(None).cast("double").alias("tfidf"))
    entry = F.when(F.col("bucket").isNotNull(), F.struct("bucket", "tfidf"))
    packed = filled.unionByName(none.distinct()).groupBy("item").agg(
        F.coalesce(F.sum("tf"), F.lit(0)).alias("n_terms"), F.sort_array(F.collect_list(entry)).alias("_entries")
    )
    return packed.select("item", "n_terms", F.col("_entries.bucket").alias("indices"), F.col("_entries.tfidf").alias("values"))
