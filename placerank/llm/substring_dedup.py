"""Removal of repeated passages by FM-indexes over shards of candidate passages.

A window is WINDOW consecutive words. A window whose words also start earlier (at a smaller
doc_id, or in the same document before) is repeated, and its words go. Windows that are equal
have the same anchor, the ANCHOR-word sequence of smallest hash in them (the first of equals);
consecutive windows with the same anchor make a segment. Three steps:

1. Anchors are counted over all documents. Only segments whose anchor occurs at least twice can
   hold a repeated window.
2. Those segments are dealt to shards by their anchor, each equal segment of a task once (its
   later copies are repeated throughout). A shard's segments are indexed (fm_index: suffixes in a
   wavelet matrix); all windows of the shard are searched backwards, matches shorter than a
   window end the search; the range of a match gives its first occurrence.
   An anchor may occur in a large share of all documents. Segments of an anchor with more than
   ``CROWDED`` occurrences are cut into single windows, dealt by the window's own hash: equal
   windows still meet, and a task sends each of them once.
3. Spans of repeated windows go back to their documents, and their words are dropped.

A document is (__id, __part): its doc_id and the hash of its text, so that rows of one doc_id
with different texts are documents of their own, in the order of that hash. Rows without a doc_id
come first, each a document of its own: its part is a row number, written once, in the order of
the text's hash.

Words are taken unchanged. Defined cases: a null or empty text has no word; documents shorter
than a window keep all words; rows that agree in doc_id and text are one document (they do not
remove one another), rows without a doc_id do; an empty table gives no rows; ``clean`` keeps all
columns of documents that lose words, with the words that stay joined by one blank, and other
texts as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashedWords, map_batches, mix64, ragged, raw_texts, set_aside, small_batches, words_of, written
from .fm_index import FMIndex

WINDOW, ANCHOR = 20, 8
CROWDED = 16_384
SHARD_WORDS = 60_000  # words indexed at a time, more only for the segments of one anchor
LEAST_ID = -(1 << 63)
# Columns put beside a caller's.
ID, PART, ANCHORS, CROWDED_ONES, SPANS = "__id", "__part", "__anchors", "__crowded", "__spans"
_PLACES = WINDOW - ANCHOR + 1  # anchors of a window
_LOW = np.uint64(0xFFFFFF)
_ODD = mix64(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = len(hashes) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        total += hashes[j : j + n] * _ODD[j]
    return mix64(total)


def segments(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of documents given as word hashes one after the other: document number, first
    window (a place among all words), number of windows, anchor key."""
    none = np.zeros(0, np.int64)
    if len(hashes) < WINDOW:
        return none, none, none, np.zeros(0, np.uint64)
    key = _rolled(hashes, ANCHOR)
    # Forty bits of the hash, then the place: the smallest is the first of equals.
    packed = (key & ~_LOW) | (np.arange(len(key), dtype=np.uint64) & _LOW)
    two = np.minimum(packed[:-1], packed[1:])
    four = np.minimum(two[:-2], two[2:])
    eight = np.minimum(four[:-4], four[4:])
    least = np.minimum(eight[: len(eight) - (_PLACES - 8)], eight[_PLACES - 8 :])
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(least))
    start = start[start + WINDOW <= ends[doc[: len(least)]]]
    if not len(start):
        return none, none, none, np.zeros(0, np.uint64)
    at = start + ((least[start] - start.astype(np.uint64)) & _LOW).astype(np.int64)
    new = np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1) | (doc[start[1:]] != doc[start[:-1]])]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(start)])
    return doc[start[first]], start[first], count, key[at[first]]


def _read(batch: pa.RecordBatch) -> HashedWords:
    return HashedWords(raw_texts(batch.column("text")))


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(anchor, id, part) of every segment."""

    def rows(batches):
        for batch in small_batches(batches, most_bytes=1 << 20):
            found = _read(batch)
            doc, _, _, key = segments(found.hashes, found.sizes)
            rows_of = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), batch.column("id").take(rows_of), batch.column("part").take(rows_of)],
                names=["anchor", "id", "part"],
            )

    return map_batches(docs, rows, "anchor bigint, id bigint, part bigint")


_ROWS = "route bigint, id bigint, part bigint, first bigint, windows bigint, words binary"


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Of (route, (id, part), first, windows, words)."""
    columns = list(zip(*((r[0], *r[1], *r[2:]) for r in rows), strict=True)) if rows else [()] * 6
    kinds = [*[pa.int64()] * 5, pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["route", "id", "part", "first", "windows", "words"],
    )


def _spread(doc: tuple[int, int], first: int) -> int:
    return doc[0] ^ doc[1] ^ first


def candidates(docs: DataFrame, most_held: int = 32 << 20) -> DataFrame:
    """Rows for the shards. ``docs`` has (__id, __part, text, __anchors, __crowded): the repeated anchors of
    each document and which of them are crowded. Rows with words are passages, each equal one
    of a task once, at its first occurrence; rows without are repeated windows already."""

    def rows(batches):
        held: dict[bytes, tuple] = {}  # digest -> (route, (id, part), first, windows, words)
        size = 0
        for batch in small_batches(batches, most_bytes=1 << 20):
            found = _read(batch)
            doc, start, count, key = segments(found.hashes, found.sizes)
            begins = ragged(found.sizes)
            ids = list(zip(batch.column(ID).to_pylist(), batch.column(PART).to_pylist(), strict=True))
            anchors = [set(x or ()) for x in batch.column(ANCHORS).to_pylist()]
            crowded = [set(x or ()) for x in batch.column(CROWDED_ONES).to_pylist()]
            single = _rolled(found.hashes, WINDOW).view(np.int64) if len(found.hashes) >= WINDOW else None
            out: list[tuple] = []
            gone: dict[int, list[tuple[int, int]]] = {}  # of a row: windows (first, number) that are repeated
            for d, s, n, k in zip(doc.tolist(), start.tolist(), count.tolist(), key.view(np.int64).tolist(), strict=True):
                if k not in anchors[d]:
                    continue
                cut = [(int(single[t]), t, 1) for t in range(s, s + n)] if k in crowded[d] else [(k, s, n)]
                for route, t, m in cut:
                    passage = found.words(t, t + m + WINDOW - 1)
                    tag = hashlib.blake2b(passage, digest_size=16, person=m.to_bytes(4, "little")).digest()
                    mine = (route, ids[d], t - int(begins[d]), m, passage)
                    old = held.get(tag)
                    if old is None:
                        held[tag] = mine
                        size += len(passage) + 200
                    elif (mine[1], mine[2]) < (old[1], old[2]):
                        held[tag] = mine
                        out.append((_spread(old[1], old[2]), *old[1:4], None))
                    elif (mine[1], mine[2]) > (old[1], old[2]):
                        gone.setdefault(d, []).append((mine[2], m))
            for d, windows in gone.items():
                out += [(_spread(ids[d], first), ids[d], first, n, None) for first, n in merged(windows)]
            if size > most_held:
                out += held.values()
                held, size = {}, 0
            if out:
                yield _row_batch(out)
        if held:
            yield _row_batch(list(held.values()))

    return map_batches(docs, rows, _ROWS)


def merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (first, number) that cover the same windows, joined where they touch."""
    out: list[tuple[int, int]] = []
    for first, n in sorted(windows):
        if out and first <= sum(out[-1]):
            out[-1] = (out[-1][0], max(out[-1][1], first + n - out[-1][0]))
        else:
            out.append((first, n))
    return out


def repeated_windows(rows: list[tuple]) -> list[tuple[tuple[int, int], int, int]]:
    """Runs (document, first, windows) of windows that also start earlier among the passages
    (document, first, windows, words) of a shard; a document is (id, part)."""
    number: dict[bytes, int] = {}
    symbols: list[int] = []
    for _, _, _, words in rows:
        symbols += [number.setdefault(w, len(number) + 1) for w in words.split()]
        symbols.append(0)
    sequence = np.array(symbols, dtype=np.int32)
    windows = np.array([r[2] for r in rows], dtype=np.int64)
    begins = ragged(windows + WINDOW)[:-1]  # a passage's words and a separator
    which = np.repeat(np.arange(len(rows)), windows)
    inside = np.arange(len(which)) - np.repeat(ragged(windows)[:-1], windows)
    at = begins[which] + inside
    documents = sorted({r[0] for r in rows})
    rank = {d: i for i, d in enumerate(documents)}
    ids = np.array([rank[r[0]] for r in rows], dtype=np.int64)[which]
    starts = np.array([r[1] for r in rows], dtype=np.int64)[which] + inside
    # Order of occurrences by (id, start), equal for equal ones.
    order = np.lexsort((starts, ids))
    step = np.r_[False, (ids[order][1:] != ids[order][:-1]) | (starts[order][1:] != starts[order][:-1])]
    place = np.zeros(len(order), dtype=np.int64)
    place[order] = np.cumsum(step)
    by_suffix = np.full(len(sequence), np.iinfo(np.int64).max)
    by_suffix[at] = place
    # Equal windows are searched once; a window whose hash is alone has no equal.
    _, first, same, times = np.unique(
        _rolled(mix64(sequence), WINDOW)[at], return_index=True, return_inverse=True, return_counts=True
    )
    asked = np.flatnonzero(times > 1)
    if not len(asked):
        return []
    index = FMIndex(sequence)
    alive, low, high = index.repeated(sequence[at[first[asked]][:, None] + np.arange(WINDOW)])
    if not len(alive):
        return []
    order = np.argsort(low)
    ordered = np.r_[by_suffix[index.suffixes], np.iinfo(np.int64).max]
    found = np.minimum.reduceat(ordered, np.column_stack([low[order], high[order]]).ravel())[::2]
    earliest = np.full(len(times), np.iinfo(np.int64).max)
    earliest[asked[alive[order]]] = found
    late = np.flatnonzero(place > earliest[same])
    if not len(late):
        return []
    first = np.flatnonzero(np.r_[True, (np.diff(late) != 1) | (which[late[1:]] != which[late[:-1]])])
    runs = np.diff(np.r_[first, len(late)])
    at = late[first]
    return [(documents[i], s, n) for i, s, n in zip(ids[at].tolist(), starts[at].tolist(), runs.tolist(), strict=True)]


def searched(rows: DataFrame) -> DataFrame:
    """(id, part, first, windows): runs of repeated windows, from candidate rows."""

    def search(batches):
        held: list[tuple] = []
        size, route = 0, None

        def found(runs):
            columns = list(zip(*((*doc, first, n) for doc, first, n in runs), strict=True)) if runs else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "part", "first", "windows"])

        for batch in batches:
            passed = []
            for key, doc_id, part, first, windows, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc = (doc_id, part)
                if words is None:
                    passed.append((doc, first, windows))
                    continue
                if size >= SHARD_WORDS and key != route:
                    passed += repeated_windows(held)
                    held, size = [], 0
                held.append((doc, first, windows, words))
                size += windows + WINDOW
                route = key
            yield found(passed)
        if held:
            yield found(repeated_windows(held))

    # Rows that are repeated already come first (no words), then passages by route.
    dealt = rows.repartition("route").sortWithinPartitions(F.col("words").isNotNull(), "route")
    return map_batches(dealt, search, "id bigint, part bigint, first bigint, windows bigint")


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with __id and __part, which name a document. Rows without a doc_id are numbered and
    written, so that a row keeps its number however often it is read."""
    number, text = F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))
    # Never null for Spark either: an inner join then adds no filter, and its shuffle is used again.
    known = docs.where(number.isNotNull()).withColumn(ID, F.coalesce(number, F.lit(LEAST_ID))).withColumn(PART, text)
    # The second order key parts equal texts, so that no range must hold all of them.
    nameless = docs.where(number.isNull()).withColumn(PART, F.monotonically_increasing_id()).orderBy(text, PART)
    nameless = written(nameless.withColumn(PART, F.monotonically_increasing_id()), "nameless")
    nameless = nameless.withColumn(ID, F.lit(LEAST_ID)).withColumn(PART, F.coalesce(PART, F.lit(0).cast("long")))
    return known.unionByName(nameless)


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(id, part, spans): per document with repeated windows, their runs (first, windows).
    ``keyed`` has __id, __part and text. Its other columns are carried into the first join, so that
    its shuffle is the one that the caller's join on the document needs, and is made once."""
    docs = keyed.select(F.col(ID).alias("id"), F.col(PART).alias("part"), F.col("text").cast("string").alias("text"))
    counts = anchor_rows(docs).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = written(counts.select(F.col("anchor").alias("_anchor"), (F.col("n") > CROWDED).alias("_crowded")), "anchors")
    flagged = anchor_rows(docs).join(counts, F.col("anchor") == F.col("_anchor"))
    per_doc = flagged.groupBy(F.col("id").alias("__doc"), F.col("part").alias("__of_part")).agg(
        F.collect_set("anchor").alias(ANCHORS), F.collect_set(F.when(F.col("_crowded"), F.col("anchor"))).alias(CROWDED_ONES)
    )
    same = (F.col(ID) == F.col("__doc")) & (F.col(PART) == F.col("__of_part"))
    known = keyed.join(per_doc, same).drop("__doc", "__of_part")
    runs = searched(candidates(known))
    # A set: rows that agree in doc_id and text find the same runs.
    return runs.groupBy("id", "part").agg(F.collect_set(F.struct("first", "windows")).alias("spans"))


def kept_words(words: list[bytes], spans) -> list[bytes]:
    """The words that no window of the runs covers."""
    if not spans:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for run in spans:
        a, b = run["first"], run["first"] + run["windows"] + WINDOW - 1
        if a < len(words):
            gone[a] += 1
            gone[min(b, len(words))] -= 1
    stay = np.cumsum(gone[:-1]) == 0
    return [words[i] for i in np.flatnonzero(stay).tolist()]


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of repeated windows of each document (null: none)."""
    keyed = identified(docs)
    spans = repeated_spans(keyed).select(F.col("id").alias("__of"), F.col("part").alias("__of_part"), F.col("spans").alias(SPANS))
    same = (F.col(ID) == F.col("__of")) & (F.col(PART) == F.col("__of_part"))
    return keyed.join(spans, same, "left").drop(ID, PART, "__of", "__of_part")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""

    def digest(batches):
        for batch in small_batches(batches):
            n, removed, sha = [], [], []
            for text, spans in zip(raw_texts(batch.column("text")), batch.column(SPANS).to_pylist(), strict=True):
                words = words_of(text)
                kept = kept_words(words, spans)
                n.append(len(words))
                removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return map_batches(rows.select("doc_id", "text", SPANS), digest,
                       "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated passages; texts that lose nothing stay as they are, n_chars
    follows a changed text. Other columns may have any names."""
    named, docs = docs.columns, set_aside(docs, ("doc_id", "text", "n_chars"))
    columns = docs.columns
    rows = with_spans(docs)

    def cut(batches):
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column(SPANS).to_pylist()):
                if spans:
                    texts[i] = b" ".join(kept_words(words_of((texts[i] or "").encode()), spans)).decode()
            made = {"text": pa.array(texts, pa.string())}
            if "n_chars" in columns:
                changed = [bool(s) for s in batch.column(SPANS).to_pylist()]
                made["n_chars"] = pa.array(
                    [len(t or "") if c else n for t, c, n in zip(texts, changed, batch.column("n_chars").to_pylist(), strict=True)],
                    batch.schema.field("n_chars").type,
                )
            yield pa.RecordBatch.from_arrays([made.get(c, batch.column(c)) for c in columns], names=columns)

    return rows.mapInArrow(cut, docs.schema).toDF(*named)
