"""Near-duplicate join on word shingles by parity sketches.

A document's set is its distinct shingles of five words as 64-bit hashes. Two sets of sizes
a <= b have Jaccard similarity of at least 0.8 if their symmetric difference has at most
(a + b) / 9 elements. Sizes fall into bands, each twice as wide as the last. In a band whose
largest size is t, no linked pair differs in more than D = 2t / 9 elements, so the shingles are
dealt by hash into slightly more than D classes, and each class is sketched by the XOR of its
elements: D differences touch at most D classes, so that a linked pair agrees in an untouched
one. The join is on (band, class, XOR). A set whose partner may be in the next band is sketched
for that band too.

The argument needs more non-empty classes than differences. A set that falls short in a band
(a few in a thousand) is also joined through the prefix of its floor(n / 5) + 1 smallest hashes,
which meets any linked set's. So no link is lost.

Sets that meet are paired with one set under their key, that which shares most keys; verified
pairs (exact, on whole sets) are links, and links make components. In keys that still hold
several components, all pairs across components follow, if sizes and Hamming distances of parity
sketches (the distance never exceeds the symmetric difference) allow a link. Pairs inside a
component cannot change the result. Large keys are handled in pairs of bounded blocks.

Equal sets are one class, identified by a 64-bit hash: they enter the join once. What a class
stands for is in the membership (doc_id, n_shingles, sig).

Defined cases: a null or empty text has no shingle and is linked with nothing; fewer than five
words are one shingle; repeated rows have equal sets and are linked; a null doc_id has no
component of its own (null); an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HashedWords, map_batches, mix64, raw_texts, set_aside, small_batches, written
from .components import connected_components

WORDS = 5
BLOCK = 2048  # sets of one key that are compared with one another at a time
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                dtype=np.uint64)


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, given as hashes."""
    n = max(0, len(words) - size + 1)
    total = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        total += words[j : j + n] * _ODD[j]
    return mix64(total)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    found = HashedWords([t.lower() for t in texts])
    every = _rolled(found.hashes, WORDS)
    out, at = [], 0
    for n in found.sizes.tolist():
        if n >= WORDS:
            out.append(np.unique(every[at : at + n - WORDS + 1]))
        else:
            out.append(_rolled(found.hashes[at : at + n], n) if n else np.zeros(0, dtype=np.uint64))
        at += n
    return out


def set_hash(shingles: np.ndarray) -> int:
    """A set's class: a signed 64-bit hash."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def band_of(n: int) -> int:
    """Band b holds sizes 2**b to 2**(b + 1) - 1."""
    return n.bit_length() - 1


def differences(a: int, b: int) -> int:
    """Most elements by which linked sets of these sizes differ."""
    return (a + b) // 9


def bands_of(n: int) -> list[int]:
    """The bands in which a set of n elements meets its partners, those of the larger size."""
    return sorted({band_of(n), band_of(n * 100 // 80)})


def classes_in(band: int) -> int:
    most = differences((2 << band) - 1, (2 << band) - 1)
    return most + 1 if most == 0 else most + most // 28 + 3


def join_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of a set: one per band and non-empty class, and prefixes where these fall short."""
    n, out = len(shingles), []
    for band in bands_of(n):
        m = classes_in(band)
        tag = np.array([band * 0x1000001], dtype=np.uint64)
        spread = mix64(shingles + mix64(tag))
        of = ((spread >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        order = np.argsort(of, kind="stable")
        sorted_of = of[order]
        first = np.flatnonzero(np.r_[True, sorted_of[1:] != sorted_of[:-1]])
        parity = np.bitwise_xor.reduceat(spread[order], first)
        out.append(mix64(parity ^ mix64(sorted_of[first] + (tag << np.uint64(32)))))
        top = (2 << band) - 1
        if len(first) <= min(differences(n, n * 100 // 80), differences(top, top)):
            out.append(mix64(shingles[: n // 5 + 1] ^ mix64(tag + np.uint64(1 << 63))))
    return np.concatenate(out)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity sketch as 64-bit words: 2**(band + 3) bits (four to eight a shingle), 64 at least."""
    bits = max(64, 8 << band_of(len(shingles)))
    at = mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(bits - 1)
    odd = (np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """A sketch folded to fewer words: a bit's place is the hash modulo the size."""
    while len(words) > size:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def _sets(batches):
    """(doc_id, set) of each row."""
    for batch in small_batches(batches, most_bytes=1 << 20):
        yield from zip(batch.column("doc_id").to_pylist(), shingle_sets(raw_texts(batch.column("text"))), strict=True)


def membership(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, sig, parity) of every document; sig and parity are null without
    shingles."""

    def members(batches):
        for batch in small_batches(batches, most_bytes=1 << 20):
            doc, n, sig, parity = [], [], [], []
            for d, s in _sets([batch]):
                doc.append(d)
                n.append(len(s))
                sig.append(set_hash(s) if len(s) else None)
                parity.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(parity, pa.binary())],
                names=["doc_id", "n_shingles", "sig", "parity"],
            )

    return map_batches(docs, members, "doc_id bigint, n_shingles bigint, sig bigint, parity binary")


def keyed(docs: DataFrame) -> DataFrame:
    """(key, sig) of every class; a task gives each of its classes once."""

    def keys(batches):
        seen: set[int] = set()
        for batch in small_batches(batches, most_bytes=1 << 20):
            key, sig, count = [np.zeros(0, np.uint64)], [], []
            for _, s in _sets([batch]):
                if len(s) and (h := set_hash(s)) not in seen:
                    seen.add(h)
                    key.append(join_keys(s))
                    sig.append(h)
                    count.append(len(key[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(key).view(np.int64)), pa.array(np.repeat(np.array(sig, dtype=np.int64), count))],
                names=["key", "sig"],
            )

    return map_batches(docs, keys, "key bigint, sig bigint")


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, shingles) of classes; ``wanted`` has (doc_id, sig), one document for each. A repeated
    row gives its class again."""
    ids = wanted.select(F.col("doc_id").alias("_id"), "sig")
    rows = docs.join(ids, F.col("doc_id") == F.col("_id")).select("text", "sig")

    def sets(batches):
        for batch in small_batches(batches, most_bytes=1 << 20):
            found = shingle_sets(raw_texts(batch.column("text")))
            # A repeated doc_id may bring another text: only the wanted class is kept.
            keep = [i for i, (s, h) in enumerate(zip(found, batch.column("sig").to_pylist(), strict=True)) if set_hash(s) == h]
            offsets = np.cumsum([0, *(len(found[i]) for i in keep)], dtype=np.int32)
            values = np.concatenate([found[i] for i in keep]) if keep else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("sig").take(pa.array(keep, pa.int64())),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))],
                names=["sig", "shingles"],
            )

    return map_batches(rows, sets, "sig bigint, shingles array<bigint>")


def within(a: bytes, b: bytes, sizes: int) -> bool:
    """Whether the sketches of two sets of ``sizes`` elements together allow a link."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= sizes // 9


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked. ``classes``: (sig, doc_id, n_shingles,
    parity). Sizes and sketches rule most others out before any set is fetched."""
    size = classes.select("sig", "n_shingles", "parity")
    sized = (
        pairs.join(size.select(F.col("sig").alias("a"), F.col("n_shingles").alias("_na"), F.col("parity").alias("_pa")), "a")
        .join(size.select(F.col("sig").alias("b"), F.col("n_shingles").alias("_nb"), F.col("parity").alias("_pb")), "b")
        .where("least(_na, _nb) * 100 >= greatest(_na, _nb) * 80")
    )

    def near(batches):
        for batch in batches:
            x, y, n = batch.column("_pa").to_pylist(), batch.column("_pb").to_pylist(), batch.column("n").to_pylist()
            yield batch.select(["a", "b"]).filter(pa.array([within(*r) for r in zip(x, y, n, strict=True)], pa.bool_()))

    sized = sized.select("a", "b", "_pa", "_pb", (F.col("_na") + F.col("_nb")).alias("n"))
    sized = written(map_batches(sized, near, "a bigint, b bigint"), "pairs")
    ends = sized.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    wanted = classes.join(ends, "sig").select("doc_id", "sig")
    sets = written(class_sets(docs, wanted), "sets")
    joined = (
        sized.join(sets.select(F.col("sig").alias("b"), F.col("shingles").alias("_sb")), "b")
        .join(sets.select(F.col("sig").alias("a"), F.col("shingles").alias("_sa")), "a")
    )
    shared = F.size(F.array_intersect("_sa", "_sb"))
    together = F.size("_sa") + F.size("_sb") - shared
    return joined.where(100 * shared >= 80 * together).select("a", "b")


def _across(rows: list[dict], same: bool) -> list[tuple[int, int]]:
    """Pairs of sets in one pair of blocks (or in one block) that are in different components
    and that sizes and sketches allow to be linked."""
    left = [r for r in rows if r["side"] == 0]
    right = left if same else [r for r in rows if r["side"] == 1]
    out = []
    by_band: dict[int, tuple[np.ndarray, ...]] = {}
    for band in {band_of(r["n"]) for r in right}:
        own = [r for r in right if band_of(r["n"]) == band]
        by_band[band] = (
            np.array([r["sig"] for r in own]), np.array([r["n"] for r in own]), np.array([r["component"] for r in own]),
            np.stack([np.frombuffer(r["parity"], np.uint64) for r in own]),
        )
    for r in left:
        n, mine = r["n"], np.frombuffer(r["parity"], np.uint64)
        for band in {band_of(n) - 1, band_of(n), band_of(n) + 1} & by_band.keys():
            sig, sizes, component, parity = by_band[band]
            maybe = (np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * 80) & (component != r["component"])
            if same:
                maybe &= sig > r["sig"]
            at = np.flatnonzero(maybe)
            if not len(at):
                continue
            words = min(len(mine), parity.shape[1])
            theirs, own = parity[at], folded(mine, words)
            while theirs.shape[1] > words:
                half = theirs.shape[1] // 2
                theirs = theirs[:, :half] ^ theirs[:, half:]
            distance = np.bitwise_count(theirs ^ own).sum(axis=1, dtype=np.int64)
            near = at[distance <= (sizes[at] + n) // 9]
            out += [(min(r["sig"], int(s)), max(r["sig"], int(s))) for s in sig[near]]
    return out


def star_pairs(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of every set and the centre of each key that it shares: of the sets under a
    key the one that shares most keys, which is what others were copied from, if any is. So the
    first round joins most of what there is to join."""
    degree = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("degree"))
    degree = written(degree, "degrees")
    ranked = shared.join(degree, "sig").groupBy("key").agg(F.max(F.struct("degree", "sig"))["sig"].alias("centre"))
    centres = written(ranked.select(F.col("key").alias("_key"), "centre"), "centres")
    met = shared.join(centres, F.col("key") == F.col("_key")).where("sig <> centre")
    return met.select(F.least("sig", "centre").alias("a"), F.greatest("sig", "centre").alias("b")).distinct()


def pairs_across(shared: DataFrame, component: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets that share a key and are in different components after the first
    round. ``shared``: (key, sig) of keys with several sets."""
    own = component.select(F.col("node").alias("sig"), "component")
    rows = shared.select("key", "sig").distinct().join(own, "sig", "left").withColumn(
        "component", F.coalesce("component", "sig")
    )
    rows = written(rows, "shared-keys")
    # Keys with two sets have been verified. Keys with the same sets are looked at once.
    groups = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("_low"), F.max("component").alias("_high"),
        F.sum(F.xxhash64("sig").cast("decimal(38,0)")).alias("_who"),
    ).where("size > 2 AND _low <> _high")
    groups = groups.groupBy("_who", "size").agg(F.min("key").alias("_key"))
    groups = written(groups.select("_key", F.ceil(F.col("size") / BLOCK).alias("_blocks")), "groups")
    picked = rows.join(groups, F.col("key") == F.col("_key")).withColumn("_own", F.pmod(F.xxhash64("sig"), F.col("_blocks")))
    size = classes.select("sig", F.col("n_shingles").alias("n"), "parity")
    dealt = picked.select("key", "sig", "component", "_own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other"))
    dealt = dealt.select("key", "sig", "component", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
                         F.when(F.col("_own") <= F.col("_other"), 0).otherwise(1).alias("side"))
    dealt = dealt.join(size, "sig").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(batches):
        held: list[dict] = []

        def done():
            pairs = sorted(set(_across(held, held[0]["i"] == held[0]["j"])))
            a, b = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for r in batch.to_pylist():
                if held and (held[0]["key"], held[0]["i"], held[0]["j"]) != (r["key"], r["i"], r["j"]):
                    yield done()
                    held = []
                held.append(r)
        if held:
            yield done()

    return map_batches(dealt, compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = written(membership(docs), "members")
    classes = members.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("parity").alias("parity")
    )
    classes = written(classes, "classes")
    by_key = Window.partitionBy("key")
    usable = docs.where(F.col("doc_id").isNotNull())
    met = keyed(usable).withColumn("_least", F.min("sig").over(by_key)).withColumn("_most", F.max("sig").over(by_key))
    shared = written(met.where("_least <> _most").select("key", "sig"), "keys")
    links = written(verified(star_pairs(shared), usable, classes), "first-links")
    component = written(connected_components(links), "first-components")
    more = pairs_across(shared, component, classes)
    more = written(verified(more, usable, classes), "more-links")
    # Links of the first round are already in its components, as stars.
    all_links = component.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    component = connected_components(all_links).select(F.col("node").alias("_node"), "component")
    of_class = classes.select(F.col("sig").alias("_sig"), F.col("doc_id").alias("_first")).join(
        component, F.col("_sig") == F.col("_node"), "left"
    ).select("_sig", "_first", F.coalesce("component", "_sig").alias("_component"))
    of_class = written(of_class, "class-components")
    least = of_class.groupBy("_component").agg(F.min("_first").alias("_id"))
    ids = written(of_class.join(least, "_component").select("_sig", "_id"), "class-ids")
    return members.join(ids, F.col("sig") == F.col("_sig"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_id", "doc_id")).alias("component_id")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with all its columns, whatever their names: the
    one with the smallest doc_id (nulls last), then the smallest text hash. Rows are told apart by a
    number of their own, written with them, so that rows without a doc_id, repeated rows and several
    texts under one doc_id are compared like any others. A row without words is in no group and
    stays."""
    named = docs.columns
    aside = set_aside(docs, ("doc_id", "text"))
    numbered = written(aside.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered.select(F.col("row").alias("doc_id"), "text"))
    groups = written(found.select(F.col("doc_id").alias("of_row"), F.col("component_id").alias("group")), "groups-of-rows")
    # Groups of one row need no look at their ids.
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("rows"), F.first("of_row").alias("of_row"))
    sizes = written(sizes, "group-sizes")
    several = groups.join(sizes.where("rows > 1").select("group"), "group")
    ids = numbered.select("row", F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    order = F.struct(F.col("id").isNull().alias("nameless"), "id", "hash", "row")
    first = several.join(ids, F.col("of_row") == F.col("row")).groupBy("group").agg(F.min(order)["row"].alias("kept"))
    kept = sizes.where("rows = 1").select(F.col("of_row").alias("kept")).unionByName(first.select("kept"))
    return numbered.join(kept, F.col("row") == F.col("kept"), "left_semi").drop("row").toDF(*named)
