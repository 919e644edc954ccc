"""Language identification by hyperdimensional profiles (operator 12).

Every letter has a random vector of ``DIM`` signs, drawn from a hash of its code
point; the word edge has one, too. A letter with its two neighbours (letters or
word edges, lower case) is a gram, whose vector binds the three, permuted by place:
``rotate(left, 2) * rotate(middle, 1) * right``. A text's profile bundles (adds) the
vectors of all its grams. A language's prototype bundles the profiles, scaled to
one length each, of all learning documents of that language. The prediction is the
language whose prototype has the largest cosine with the text's profile.

Learning reads every document outside the held-out fold: a task adds up one vector
a language and the sums are added by Spark, so the model is languages x ``DIM``
numbers whatever the input. Contributions are whole numbers, so the sums do not
depend on the order of rows.

Cases: null texts and texts without a letter are ``und`` with score 0; so is every
text when nothing can be learnt. Null ids and null languages are not learnt from.
Equal cosines give the smaller language. Repeated rows count each time and score
alike; an empty table gives no rows. Texts are read whole: a long one only makes
its own block longer. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quillstream.llm.labelled import fold
from quillstream.llm.textarrays import LETTER, Block, blocks, char_classes, mix

FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
DIM = 1024            # signs of a vector
EDGE = 32             # code of the word edge
GRAMS_AT_ONCE = 4096  # gram vectors held at a time
CELLS = 1 << 23       # of the counts (texts x grams) held at a time
SCALE = 1 << 20       # length of a learning document's profile


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """(letter, DIM) signs of the code points."""
    words = np.arange(DIM // 64, dtype=np.uint64)
    state = codes.astype(np.uint64)[:, None] * np.uint64(DIM) + words[None, :]
    bits = mix(state * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x5851F42D4C957F2D))
    # bytes in a fixed order, so that all machines draw the same signs
    return np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1, bitorder="little").astype(np.int8) * 2 - 1


def grams(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, symbols, gram): one gram a letter, as a number in base ``len(symbols)``."""
    size = np.diff(block.offsets)
    owner = np.repeat(np.arange(block.count), size)
    # an edge before every text and after the last: no gram reaches over it
    letter = char_classes()[block.codes] == LETTER
    line = np.full(len(owner) + block.count + 1, EDGE, dtype=np.uint32)
    line[np.arange(len(owner)) + owner + 1] = np.where(letter, block.codes, EDGE)
    middle = np.flatnonzero(line != EDGE)
    present = np.zeros(0x110000, dtype=bool)
    present[line] = True
    symbols = np.flatnonzero(present)
    number = np.zeros(0x110000, dtype=np.int64)
    number[symbols] = np.arange(len(symbols))
    line = number[line]
    base = len(symbols)
    return owner[letter], symbols, (line[middle - 1] * base + line[middle]) * base + line[middle + 1]


def profiles(block: Block) -> np.ndarray:
    """(text, DIM) profiles of the texts."""
    owner, symbols, gram = grams(block)
    out = np.zeros((block.count, DIM), dtype=np.float32)
    if not len(gram):
        return out
    base = len(symbols)
    if base**3 <= CELLS:
        seen = np.flatnonzero(np.bincount(gram, minlength=base**3))
        number = np.zeros(base**3, dtype=np.int64)
        number[seen] = np.arange(len(seen))
        gram = number[gram]
    else:
        seen, gram = np.unique(gram, return_inverse=True)
    right = letter_vectors(symbols)
    middle, left = np.roll(right, 1, axis=1), np.roll(right, 2, axis=1)
    first = np.searchsorted(owner, np.arange(block.count + 1))
    some = max(1, CELLS // len(seen))
    for lo in range(0, block.count, some):
        hi = min(lo + some, block.count)
        mine = slice(first[lo], first[hi])
        counts = np.bincount((owner[mine] - lo) * len(seen) + gram[mine], minlength=(hi - lo) * len(seen)).reshape(hi - lo, len(seen))
        for at in range(0, len(seen), GRAMS_AT_ONCE):
            part = seen[at:at + GRAMS_AT_ONCE]
            bound = left[part // (base * base)] * middle[part // base % base] * right[part % base]
            out[lo:hi] += counts[:, at:at + GRAMS_AT_ONCE].astype(np.float32) @ bound.astype(np.float32)
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (null vectors stay)."""
    wide = vectors.astype(np.float64)
    return wide / np.maximum(np.sqrt((wide * wide).sum(axis=1, keepdims=True)), 1e-9)


HELD_LANGS = 4096  # sums a task holds before it hands them on


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages in order, their prototypes of length one) of ``docs(doc_id, text, lang)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([list(v) for v in sums.values()], pa.list_(pa.int64()))], ["lang", "sums"])

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for block in blocks(batch.column(0), lower=True):
                parts = np.rint(unit(profiles(block)) * SCALE).astype(np.int64)
                mine = np.array(langs[block.first:block.first + block.count], dtype=object)
                for lang in sorted(set(mine)):
                    sums[lang] = sums.get(lang, 0) + parts[mine == lang].sum(axis=0)
                if len(sums) >= HELD_LANGS:
                    yield rows()
                    sums = {}
        yield rows()

    learnt = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    known = docs.where(learnt & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    sums = known.mapInArrow(run, "lang string, sums array<long>")
    total = sums.select("lang", F.posexplode("sums").alias("at", "part")).groupBy("lang", "at").agg(F.sum("part").alias("total"))
    table = total.where("total != 0").toArrow()  # at most languages x DIM rows
    langs = sorted(set(table.column("lang").to_pylist()))
    place = {lang: i for i, lang in enumerate(langs)}
    sums = np.zeros((len(langs), DIM))
    sums[[place[x] for x in table.column("lang").to_pylist()], table.column("at").to_numpy()] = table.column("total").to_numpy()
    return langs, unit(sums)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) of their ``text``; input columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    langs, prototypes = model
    names = np.array([*langs, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for block in blocks(batch.column("text"), lower=True):
                vectors = profiles(block)
                best, near = np.full(block.count, len(langs)), np.zeros(block.count)
                if langs:
                    likeness = unit(vectors) @ prototypes.T
                    some = np.bincount(grams(block)[0], minlength=block.count) > 0
                    best = np.where(some, likeness.argmax(axis=1), best)
                    near = np.where(some, np.clip(likeness.max(axis=1), 0, 1), 0)
                found.append(names[best])
                scores.append(near)
            pred = np.concatenate(found) if found else np.zeros(0, dtype=object)
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score)], [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs(doc_id, text, lang)``."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return predict(docs.select("doc_id", "text"), fit(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
