"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel of two words sums, over subsequences of three and four letters, the products of
their decayed weights: each occurrence counts DECAY ** span, so that letters with others put
between them still match. What is not a letter (punctuation, symbols) only widens the span;
digits and signs that stand for letters count as these. Words are normalised by the length of
their occurrence weights, and marked at both ends. Letters spelled out one by one form a word.

The machine is trained on labelled sentences through landmarks (Nystroem): kernel values to
landmark words, whitened by the landmarks' own kernel matrix, enter a linear machine with
squared hinge loss. Labels belong to whole documents, so that training alternates: the words
that the machine finds worst in each toxic document are its positive cases, all words of clean
documents the negative ones. Since the kernel is linear in the subsequence weights, the fitted
machine is one weight per (hashed) subsequence, and scoring a word needs no landmark. A
sentence is as toxic as its worst word, a document as its worst sentence; a logistic curve
fitted on the training documents turns that margin into the score.

Training, in one task, uses a bounded sample: up to ``SAMPLE_ROWS`` labelled documents of each class, those
with the smallest hash of doc_id, ``SAMPLE_CHARS`` characters of each; the model is a vector
of ``FEATURES`` numbers. Scoring reads every text whole.

Defined cases: a null or empty text has the score of a document without words; repeated rows
score alike; where a label is missing or only one class is there, every score is the share of
toxic labels (0 without labels); a null doc_id is not held out and not learned from; an empty
table gives no rows; other columns are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, return_freed, small_batches, worker_memory

SAMPLE_ROWS = 1500  # labelled documents a class, at most
SAMPLE_CHARS = 20_000
FEATURES = 1 << 18
DECAY = 0.7
LANDMARKS = 192
NEGATIVES = 8_000  # clean words that enter a fit, at most
ROUNDS = 3
COST = 10.0  # of a margin fallen short of, against the norm of the machine
MOST_BYTES = 64 << 20  # of words whose margins a worker remembers

# Offsets of the letters of a subsequence from its first one: three letters within five
# places, four letters within six.
SHAPES = [(a, b) for b in range(2, 5) for a in range(1, b)]
SHAPES += [(a, b, c) for c in range(3, 6) for b in range(2, c) for a in range(1, b)]

# Signs that stand for letters inside a word.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_SPELLED = re.compile(rb"(?<![^\x20\x09-\x0D])(?:[A-Za-z][^A-Za-z0-9\x80-\xFF\x20\x09-\x0D]{0,2}[\x20\x09-\x0D]+){2,}"
                      rb"[A-Za-z](?![A-Za-z0-9\x80-\xFF])")
_OUTER = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$")
_START, _END = 62, 63


def _letter(code_point: int) -> int:
    """Symbol of a character: 1-26 for a-z, 27-61 for other letters, 0 for anything else."""
    c = STAND_INS.get(chr(code_point), chr(code_point))
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 35 if c.isalpha() else 0


# Symbols of the first code points; those beyond count as letters. Between words stand "\n" and
# "\r", which no word has: the end of one word and the start of the next.
_BEYOND = 0x3000
_SYMBOL = np.array([_letter(c) for c in range(_BEYOND)], dtype=np.int32)
_SYMBOL[ord("\n")], _SYMBOL[ord("\r")] = _END, _START


def units_of(text: bytes) -> set[bytes]:
    """The distinct words of a text, A-Z lower-cased and without punctuation at their ends, and
    words spelled out letter by letter."""
    text = text.lower()
    units = {w.strip(_OUTER) for w in set(text.split())}
    for run in _SPELLED.finditer(text):
        units.add(b"".join(bytes([b]) for b in run.group() if 97 <= b <= 122))
    return units


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words one after the other, each with its start and end mark, and each
    word's first place and size."""
    points = np.frombuffer(("\r" + b"\n\r".join(words).decode().lower() + "\n").encode("utf-32-le"), dtype=np.uint32)
    symbols = np.where(points < _BEYOND, _SYMBOL[np.minimum(points, _BEYOND - 1)], 27 + (points % 35).astype(np.int32))
    first = np.flatnonzero(symbols == _START)
    return symbols, first, np.diff(np.r_[first, len(symbols)])


def by_size(first: np.ndarray, size: np.ndarray, most: int = 1 << 20):
    """Words of equal size together: (their numbers, their places), at most ``most`` places."""
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for group in np.split(order, cuts):
        n = int(size[group[0]])
        rows = max(1, most // n)
        for i in range(0, len(group), rows):
            part = group[i : i + rows]
            yield part, first[part][:, None] + np.arange(n)


def occurrences(matrix: np.ndarray):
    """For words of equal size (rows of symbols): per shape the features, the weight of an
    occurrence, and which occurrences have letters only (None: all)."""
    plain = bool((matrix > 0).all())
    for shape in SHAPES:
        n = matrix.shape[1] - shape[-1]
        if n <= 0:
            continue
        code = matrix[:, :n]
        valid = None if plain else code > 0
        for d in shape:
            at = matrix[:, d : d + n]
            code = code * 64 + at
            if valid is not None:
                valid = valid & (at > 0)
        if len(shape) == 3:  # four letters are hashed into the same table
            code = ((code.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(14)).astype(np.int32)
        yield code, DECAY ** (shape[-1] + 1), valid


def scores(words: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Products of each word's normalised occurrence weights with weights per feature: words by
    columns of ``vectors``."""
    out = np.zeros((len(words), vectors.shape[1]))
    if not words:
        return out
    symbols, first, size = spelled(words)
    for part, places in by_size(first, size, (1 << 20) // vectors.shape[1]):
        total, square = np.zeros((len(part), vectors.shape[1])), np.zeros(len(part))
        for code, weight, valid in occurrences(symbols[places]):
            hit = vectors[code]
            if valid is None:
                square += weight * weight * code.shape[1]
            else:
                hit = hit * valid[:, :, None]
                square += weight * weight * valid.sum(axis=1)
            total += weight * hit.sum(axis=1)
        out[part] = total / np.sqrt(np.maximum(square, 1e-12))[:, None]
    return out


def feature_vector(words: list[bytes], coefficients: np.ndarray) -> np.ndarray:
    """Sum of the words' normalised feature vectors times coefficients."""
    out = np.zeros(FEATURES)
    symbols, first, size = spelled(words)
    for part, places in by_size(first, size):
        found = list(occurrences(symbols[places]))
        square = np.zeros(len(part))
        for code, weight, valid in found:
            square += weight * weight * (code.shape[1] if valid is None else valid.sum(axis=1))
        scale = coefficients[part] / np.sqrt(np.maximum(square, 1e-12))
        for code, weight, valid in found:
            amount = np.broadcast_to((scale * weight)[:, None], code.shape)
            amount = amount if valid is None else amount * valid
            out += np.bincount(code.ravel(), weights=amount.ravel(), minlength=FEATURES)
    return out


def kernel(words: list[bytes], landmarks: list[bytes], at_once: int = 16) -> np.ndarray:
    """Kernel values of words (rows) to landmark words (columns)."""
    parts = []
    for i in range(0, len(landmarks), at_once):
        vectors = np.column_stack([feature_vector([z], np.ones(1)) for z in landmarks[i : i + at_once]])
        parts.append(scores(words, vectors.astype(np.float32)))
    return np.hstack(parts)


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of the linear machine with squared hinge loss, by Newton steps; x has a last
    column of ones, which is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    active = np.ones(len(y), dtype=bool)
    for _ in range(steps):
        xa = x[active]
        h = (xa * cost[active][:, None]).T @ xa + np.diag(penalty)
        w = np.linalg.solve(h, xa.T @ (cost[active] * y[active]))
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve with smoothed targets (Platt)."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    design, beta = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        h = (design * (p * (1 - p) + 1e-6)[:, None]).T @ design + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, design.T @ (target - p) - 1e-4 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def with_insertions(words: list[bytes]) -> list[bytes]:
    """The words, and each with one or two characters put in."""
    out = list(words)
    for w in (w.decode() for w in words):
        if len(w) >= 4:
            k = len(w) // 2
            out += [x.encode() for x in (w[:k] + "*" + w[k:], f"{w[:2]}.{w[2 : k + 1]}-{w[k + 1 :]}", w[:1] + w)]
    return out


class Model:
    """``vector`` and ``bias`` score words; ``slope`` and ``offset`` make a document's score of
    its largest margin; ``least`` is the margin of a document without words."""

    def __init__(self, vector: np.ndarray, bias: float, slope: float, offset: float, least: float = -1.5):
        self.vector, self.bias = vector.astype(np.float32), bias
        self.slope, self.offset, self.least = slope, offset, least

    def margins(self, words: list[bytes]) -> np.ndarray:
        return scores(words, self.vector[:, None])[:, 0] + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def train(texts: list[bytes], toxic: list[int]) -> Model:
    """Fit the machine on labelled documents."""
    y = np.array(toxic, dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.0, 1e-9, 1 - 1e-9)
        return Model(np.zeros(FEATURES), 0.0, 0.0, float(np.log(p / (1 - p))))
    bags = [sorted(units_of(t)) for t in texts]
    positive = [b for b, t in zip(bags, toxic, strict=True) if t]
    clean = [b for b, t in zip(bags, toxic, strict=True) if not t]
    in_clean: dict[bytes, int] = {}
    for bag in clean:
        for w in bag:
            in_clean[w] = in_clean.get(w, 0) + 1
    in_toxic: dict[bytes, int] = {}
    for bag in positive:
        for w in bag:
            in_toxic[w] = in_toxic.get(w, 0) + 1
    # Words of toxic documents only, too many of them for chance (a bound over all words):
    # these are positive cases from the start.
    chance = -np.log(len(positive) / len(bags))
    certain = (np.log(len(in_toxic) + len(in_clean) + 1) + 3) / chance
    every = sorted(in_toxic.keys() - in_clean.keys())
    sure = {w for w in every if in_toxic[w] >= certain}
    witness = sorted(sure) or sorted({max(bag, key=lambda w: (in_toxic[w], w)) for bag in positive if bag})
    frequent = sorted(in_clean, key=lambda w: (-in_clean[w], w))
    step = max(1, len(frequent) // NEGATIVES)
    negatives = frequent[: NEGATIVES // 2] + frequent[NEGATIVES // 2 :: step][: NEGATIVES // 2]
    model = Model(np.zeros(FEATURES), 0.0, 1.0, 0.0)
    margin: dict[bytes, float] = {}
    hard: list[bytes] = []
    for turn in range(ROUNDS):
        witness = sorted(witness, key=lambda w: (-in_toxic[w], w))[: 4 * LANDMARKS]
        pos = with_insertions(witness)
        # Landmarks: positive words, clean words near them, and clean words of all kinds.
        marks = witness[: LANDMARKS // 2] + hard[: LANDMARKS // 4]
        rest = [w for w in negatives if w not in set(marks)]
        marks += rest[:: max(1, len(rest) // (LANDMARKS // 4))][: LANDMARKS // 4]
        own = kernel(marks, marks)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        keep = values > 1e-6 * values.max()
        whiten = vectors[:, keep] / np.sqrt(values[keep])
        x = kernel(pos + negatives, marks) @ whiten
        sign = np.r_[np.ones(len(pos)), -np.ones(len(negatives))]
        cost = np.r_[np.full(len(pos), COST * max(1.0, len(negatives) / (10 * len(pos)))), np.full(len(negatives), COST)]
        w = squared_hinge(np.column_stack([x, np.ones(len(x))]), sign, cost)
        model = Model(feature_vector(marks, whiten @ w[:-1]), float(w[-1]), 1.0, 0.0)
        margin = dict(zip(every, model.margins(every).tolist(), strict=True))
        if turn + 1 < ROUNDS:
            # The worst words of each toxic document, if they look toxic and are no accident.
            found = {max((u for u in bag if u in margin), key=lambda u: (margin[u], u), default=b"") for bag in positive}
            witness = sorted(sure | {u for u in found if u and margin[u] > 0.5 and in_toxic[u] * chance > 3}) or witness
            # Clean words that come too near are cases of the next round.
            others = model.margins(frequent)
            hard = [frequent[i] for i in np.argsort(-others, kind="stable")[: NEGATIVES // 4]]
            negatives = list(dict.fromkeys(negatives + hard))
    known = dict(zip(frequent, model.margins(frequent).tolist(), strict=True)) | margin
    top = np.array([max((known[u] for u in bag), default=model.least) for bag in bags])
    model.slope, model.offset = logistic(top, y)
    return model


def sampled(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = SAMPLE_ROWS,
            chars: int = SAMPLE_CHARS) -> DataFrame:
    """(doc_id, t, toxic): up to ``rows`` labelled texts of each class that are not held out, by hash
    of doc_id. Only their numbers reach the driver."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    per_doc = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    label: dict[int, int] = {}
    for value in (0, 1):
        picked = per_doc.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        label |= {r["doc_id"]: value for r in picked.collect()}
    toxic = F.col("doc_id").isin(sorted(i for i, value in label.items() if value))
    return docs.where(F.col("doc_id").isin(sorted(label))).select(
        "doc_id", F.coalesce(F.substring("text", 1, chars), F.lit("")).alias("t"), toxic.cast("int").alias("toxic")
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = SAMPLE_ROWS,
                    chars: int = SAMPLE_CHARS) -> list[tuple[bytes, int]]:
    """The texts and labels of ``sampled``."""
    found = sorted(tuple(r) for r in sampled(docs, labels, held_out, rows, chars).collect())
    return [(t.encode(), toxic) for _, t, toxic in found]


def trained(sample: DataFrame) -> Model:
    """The machine of ``train`` on the rows of ``sampled``, fitted by a task, so that neither the
    texts nor what the fit holds are in the driver's memory; it gets the model."""

    def fit(batches):
        found = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        model = train([t.encode() for _, t, _ in found], [toxic for _, _, toxic in found])
        numbers = [model.bias, model.slope, model.offset, model.least]
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.vector.tobytes()], pa.binary()), pa.array([[float(x) for x in numbers]], pa.list_(pa.float64()))],
            names=["vector", "numbers"],
        )
        del found, model
        return_freed()

    rows = map_batches(sample.repartition(1), fit, "vector binary, numbers array<double>").collect()
    if not rows:  # no partition, where Spark sees that the sample is empty
        return train([], [])
    return Model(np.frombuffer(rows[0]["vector"], dtype=np.float32), *rows[0]["numbers"])


def document_scores(machine: Model, tag: int, texts: list[str | None]) -> np.ndarray:
    """Scores of whole texts; the margins of words that a worker has met are remembered."""
    memory = worker_memory(("toxicity", tag))
    known = memory.setdefault("margins", {})
    bags = [units_of((t or "").encode()) for t in texts]
    if memory.get("held", 0) > MOST_BYTES:
        known.clear()
        memory["held"] = 0
    new = sorted(set().union(*bags).difference(known))
    known.update(zip(new, machine.margins(new).tolist(), strict=True))
    memory["held"] = memory.get("held", 0) + sum(map(len, new)) + 150 * len(new)
    return machine.score(np.array([max(map(known.__getitem__, bag), default=machine.least) for bag in bags]))


def classify(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text; the model is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tag = hash(model.vector.tobytes())

    def score(batches):
        for batch in small_batches(batches, most_bytes=2 << 20):
            p = document_scores(shared.value, tag, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return map_batches(rows, score, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tag = hash(model.vector.tobytes())

    def keep(batches):
        for batch in small_batches(batches, most_bytes=2 << 20):
            p = document_scores(shared.value, tag, batch.column("text").to_pylist())
            yield batch.filter(pa.array(p < 0.5))

    return docs.mapInArrow(keep, docs.schema)
