"""Factorisation-machine quality classifier (operator 9).

Features of a text: hashed words (presence, scaled by their number), structure
statistics, each in bands (shares of capitals, signs, digits, repeated words and
lines, word and line lengths), and the text's length as metadata. The score of a
row ``x`` is the logistic function of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

the sum-of-squares form of all weighted pairs, linear in the features a text has.

The machine is fitted on a bounded sample of labelled documents; scoring runs
over arrays of many texts. Only the text enters a score.

Cases: null and empty texts have the structure features of an empty text and no
words; with no labelled rows every score is ``PRIOR``; repeated rows score alike;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quillstream.llm.labelled import fold, labelled_sample
from quillstream.llm.textarrays import (
    LETTER,
    NUMBER,
    SPACE,
    Block,
    blocks,
    char_classes,
    span_hashes,
    word_spans,
)

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
PRIOR = 0.5
MAX_SAMPLE = 12_000   # labelled documents the machine is fitted on, about
BUCKETS = 1 << 16     # of hashed words
BANDS = 16            # of each structure statistic
RANK = 8

# shares are banded by their square root (fine near 0), sizes by their logarithm
SHARES = ("capitals", "signs", "digits", "spaces", "repeated words", "repeated neighbours", "doubled signs", "bars")
SIZES = ("characters", "words", "lines", "characters a word", "words a line")
N_FEATURES = BUCKETS + BANDS * (len(SHARES) + len(SIZES))


@dataclass
class Rows:
    """Sparse rows: (text, feature, value), sorted by text."""

    owner: np.ndarray
    feature: np.ndarray
    value: np.ndarray


def structure(block: Block, word_owner: np.ndarray, word_hash: np.ndarray) -> np.ndarray:
    """Band of each structure statistic, one row a text."""
    n = block.count
    codes, kind = block.codes, char_classes()[block.codes]
    chars = np.diff(block.offsets).astype(float)

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[block.offsets[1:]] - total[block.offsets[:-1]]).astype(float)

    letters = per_text(kind == LETTER)
    sign = (kind != LETTER) & (kind != NUMBER) & (kind != SPACE)
    doubled = sign.copy()
    doubled[1:] &= codes[1:] == codes[:-1]
    doubled[:1] = False
    words = np.bincount(word_owner, minlength=n).astype(float)
    order = np.lexsort((word_hash, word_owner))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (word_hash[order][1:] == word_hash[order][:-1]) & (word_owner[order][1:] == word_owner[order][:-1])
    repeated = np.bincount(word_owner[order][same], minlength=n).astype(float)
    beside = np.zeros(len(word_hash), dtype=bool)
    beside[1:] = (word_hash[1:] == word_hash[:-1]) & (word_owner[1:] == word_owner[:-1])
    beside = np.bincount(word_owner[beside], minlength=n).astype(float)
    lines = per_text(codes == 10) + 1
    upper = per_text(((codes >= 65) & (codes <= 90)) | ((codes >= 0xC0) & (codes <= 0xDE)))
    over = lambda a, b: a / np.maximum(b, 1)
    shares = [
        over(upper, letters), over(per_text(sign), chars), over(per_text(kind == NUMBER), chars), over(per_text(kind == SPACE), chars),
        over(repeated, words), over(beside, words), over(per_text(doubled), chars), over(per_text(codes == 124), words),
    ]
    sizes = [chars, words, lines, over(letters, words), over(words, lines)]
    bands = [np.sqrt(np.clip(s, 0, 1)) * (BANDS - 1) for s in shares] + [np.log2(1 + s) for s in sizes]
    return np.minimum(np.array(bands).T.round(), BANDS - 1).astype(np.int64)


def feature_rows(block: Block) -> Rows:
    start, end, owner = word_spans(block)
    # words as they stand: capitals tell shouting from prose
    hashes = span_hashes(block.codes, start, end)
    bands = structure(block, owner, hashes)
    pair = np.unique(owner * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64))
    word_owner, word = pair // BUCKETS, pair % BUCKETS
    scale = 1 / np.sqrt(np.maximum(np.bincount(word_owner, minlength=block.count), 1))
    places = BUCKETS + BANDS * np.arange(bands.shape[1]) + bands
    all_owner = np.concatenate([word_owner, np.repeat(np.arange(block.count), bands.shape[1])])
    order = np.argsort(all_owner, kind="stable")
    return Rows(
        all_owner[order],
        np.concatenate([word, places.ravel()])[order],
        np.concatenate([scale[word_owner], np.ones(places.size)])[order],
    )


@dataclass
class Machine:
    bias: float
    linear: np.ndarray   # one weight a feature
    factors: np.ndarray  # (feature, RANK)

    def margins(self, rows: Rows, n: int) -> np.ndarray:
        """The factorisation machine in linear time, for ``n`` texts."""
        z = self.bias + np.bincount(rows.owner, weights=rows.value * self.linear[rows.feature], minlength=n)
        for f in range(self.factors.shape[1]):
            terms = rows.value * self.factors[rows.feature, f]
            z += 0.5 * (np.bincount(rows.owner, weights=terms, minlength=n) ** 2 - np.bincount(rows.owner, weights=terms * terms, minlength=n))
        return z


def log_loss(z: np.ndarray, label: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(label > 0, -z, z)))) if len(z) else 0.0


def train(rows: Rows, label: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.1, ridge: float = 1e-3, seed: int = 7) -> Machine:
    """Mini-batch training (Adagrad) on the logistic loss.

    Every seventh row is kept aside: the epoch whose machine predicts those rows
    best is returned, so words are not learnt by heart, and its margins are
    scaled to those rows (a slope and an offset), so scores are probabilities.
    """
    rng = np.random.default_rng(seed)
    aside = np.arange(len(label)) % 7 == 6
    apart = aside[rows.owner]
    check = Rows((np.cumsum(aside) - 1)[rows.owner[apart]], rows.feature[apart], rows.value[apart])
    best, least = None, np.inf
    machine = Machine(0.0, np.zeros(N_FEATURES), rng.normal(0, 0.01, (N_FEATURES, RANK)))
    g_bias, g_linear, g_factors = 1e-8, np.full(N_FEATURES, 1e-8), np.full((N_FEATURES, RANK), 1e-8)
    starts = np.searchsorted(rows.owner, np.arange(len(label) + 1))
    for _ in range(epochs):
        mine = rng.permutation(np.flatnonzero(~aside))
        for some in np.array_split(mine, max(1, len(mine) // batch)):
            at = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in some])
            owner = np.repeat(np.arange(len(some)), starts[some + 1] - starts[some])
            feature, value = rows.feature[at], rows.value[at]
            error = 1 / (1 + np.exp(-machine.margins(Rows(owner, feature, value), len(some)))) - label[some]
            keys, inverse = np.unique(feature, return_inverse=True)
            push = error[owner] * value
            step = error.mean()
            g_bias += step**2
            machine.bias -= rate * step / np.sqrt(g_bias)
            step = np.bincount(inverse, weights=push) / len(some) + ridge * machine.linear[keys]
            g_linear[keys] += step**2
            machine.linear[keys] -= rate * step / np.sqrt(g_linear[keys])
            for f in range(RANK):
                v = machine.factors[keys, f]
                terms = value * v[inverse]
                sums = np.bincount(owner, weights=terms, minlength=len(some))
                step = np.bincount(inverse, weights=push * (sums[owner] - terms)) / len(some) + ridge * v
                g_factors[keys, f] += step**2
                machine.factors[keys, f] = v - rate * step / np.sqrt(g_factors[keys, f])
        loss = log_loss(machine.margins(check, int(aside.sum())), label[aside])
        if loss < least or best is None:
            best, least = Machine(machine.bias, machine.linear.copy(), machine.factors.copy()), loss
    slope, offset = calibrated(best.margins(check, int(aside.sum())), label[aside])
    return Machine(slope * best.bias + offset, slope * best.linear, np.sqrt(slope) * best.factors)


def calibrated(z: np.ndarray, label: np.ndarray, rounds: int = 2000, rate: float = 0.02, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope (positive) and offset that make ``slope * z + offset`` predict the labels best."""
    a, b = 0.0, 0.0  # logarithm of the slope, offset
    if not len(z):
        return 1.0, 0.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(np.exp(a) * z + b))) - label
        a -= rate * float(np.clip(np.mean(error * z) * np.exp(a) + ridge * a, -1, 1))
        b -= rate * float(np.clip(np.mean(error) + ridge * b, -1, 1)) * 5
    return float(np.exp(a)), b


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_SAMPLE) -> Machine:
    """A machine fitted on about ``max_rows`` labelled documents at most; their sparse rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1)
            for block in blocks(batch.column(0)):
                rows = feature_rows(block)
                sizes = np.searchsorted(rows.owner, np.arange(block.count + 1))
                packed = lambda x, kind: pa.array([x[a:b].astype(kind).tobytes() for a, b in zip(sizes[:-1], sizes[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([label.slice(block.first, block.count), packed(rows.feature, "<i4"), packed(rows.value, "<f4")], ["label", "f", "v"])

    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, max_rows)
    found = sample.select("text", "label", F.xxhash64("doc_id", "text").alias("o")).orderBy("o").select("text", "label")
    table = found.mapInArrow(run, "label int, f binary, v binary").toArrow()  # bounded by max_rows
    label = table.column("label").to_numpy().astype(float)
    if not len(label):
        return Machine(float(np.log(PRIOR / (1 - PRIOR))), np.zeros(N_FEATURES), np.zeros((N_FEATURES, RANK)))
    feature = [np.frombuffer(x.as_buffer(), "<i4") for x in table.column("f")]
    value = np.concatenate([np.frombuffer(x.as_buffer(), "<f4") for x in table.column("v")]).astype(float)
    owner = np.repeat(np.arange(len(label)), [len(x) for x in feature])
    return train(Rows(owner, np.concatenate(feature).astype(np.int64), value), label)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``score`` (0 to 1); an input column of that name is replaced."""
    docs = docs.drop("score")
    # single precision is enough for a weight, and the tasks carry half as much
    bias, linear, factors = machine.bias, machine.linear.astype(np.float32), machine.factors.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Machine(bias, linear, factors)
        for batch in batches:
            margins = [fitted.margins(feature_rows(block), block.count) for block in blocks(batch.column("text"))]
            z = np.concatenate(margins) if margins else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-z)))], [*batch.schema.names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``."""
    machine = fit(docs, labels)
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return score(docs.select("doc_id", F.col("text").cast("string").alias("text")), machine).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
