"""Noisy-channel toxicity scoring (operator 3).

1. A character trigram model is counted over the words of all documents.
2. A word that is not plain letters (leetspeak, signs between letters, letters
   spaced out or repeated) becomes a lattice: at each place the letters the sign
   may stand for, with the cost of that substitution. A Viterbi search takes the
   path that the character model and the channel costs together like best.
3. The restored words and their beginnings (``PREFIXES`` letters) are the
   features. Those that separate the labels best are selected by counts over a
   bounded sample of labelled documents, and a logistic regression on them gives
   the score of the restored text.

Only the text enters a score. Plain words need no search (their lattice has one
path) and are handled as arrays; the searched forms are remembered per task.

Cases: null and empty texts score what a text without any feature scores; with
no labelled rows every score is the prior ``PRIOR``; repeated rows score alike;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quillstream.llm.labelled import MAX_SAMPLE, fold, labelled_sample
from quillstream.llm.textarrays import (
    LETTER,
    NUMBER,
    SPACE,
    Block,
    blocks,
    char_classes,
    doc_starts,
    span_hashes,
)

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PRIOR = 0.1
MAX_FEATURES = 4096      # size of the model
MIN_TOXIC_DOCS = 3       # labelled toxic documents a feature must stand in
PREFIXES = (4, 5, 6, 7)
PUT_ASIDE = 40           # places of a lattice after which the letters found so far are linked, not copied
REMEMBERED = 200_000     # searched forms remembered per task

# --- fixed values: what a sign may stand for, with its cost (natural logarithm)
STANDS_FOR = {
    "0": [("o", 0.5)],
    "1": [("i", 0.5), ("l", 1.0)],
    "3": [("e", 0.5)],
    "4": [("a", 0.5)],
    "5": [("s", 0.5)],
    "7": [("t", 0.5)],
    "8": [("b", 1.0)],
    "9": [("g", 1.0)],
    "@": [("a", 0.5)],
    "$": [("s", 0.5)],
    "!": [("i", 1.0), ("", 1.5)],
    "|": [("l", 1.0), ("i", 1.0), ("", 1.5)],
    "+": [("t", 1.0), ("", 1.5)],
    "*": [("a", 1.5), ("e", 1.5), ("i", 1.5), ("o", 1.5), ("u", 1.5), ("", 2.0)],
}
DIGIT_ALONE = 6.0        # cost of reading a digit as a digit
JOINED, PARTED = 0.7, 0.7  # a sign between letters is noise, or parts two words
REPEATED = 0.5           # three or more of a letter stand for one; for two: twice that

# --- the character model --------------------------------------------------------

EDGE, ELSE = 26, 27      # word edge; any letter outside a-z
SYMBOLS = 28


@functools.lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """Symbol of every code point: 0-25 for a letter that is a-z without its marks, ``ELSE`` for other letters, 255 else."""
    lut = np.full(0x110000, 255, dtype=np.uint8)
    lut[char_classes() == LETTER] = ELSE
    for c in range(0x250):
        base = unicodedata.normalize("NFD", chr(c).lower())[:1]
        if lut[c] == ELSE and "a" <= base <= "z":
            lut[c] = ord(base) - 97
    return lut


def trigram_counts(block: Block) -> np.ndarray:
    """Counts of (symbol, symbol, symbol) over the words of a block, edges included."""
    symbols = letter_codes()[block.codes]
    letter = symbols != 255
    new = doc_starts(block)
    # one edge in place of every run of other signs and between texts
    stream = np.where(letter, symbols, EDGE).astype(np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    cut = np.flatnonzero(new[:-1] & letter)
    stream, keep = np.insert(stream, cut, EDGE), np.insert(keep, cut, True)
    stream = np.concatenate([[EDGE], stream[keep], [EDGE, EDGE]])
    key = (stream[:-2] * SYMBOLS + stream[1:-1]) * SYMBOLS + stream[2:]
    return np.bincount(key, minlength=SYMBOLS**3)


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of each symbol after two others, from all words of all documents.

    Each task sends one row of ``SYMBOLS ** 3`` counts at most; the sums are as many rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for block in blocks(batch.column(0), lower=True):
                counts += trigram_counts(block)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["k", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SYMBOLS**3)
    for r in rows:
        counts[r["k"]] = r["n"]
    return log_model(counts)


def log_model(counts: np.ndarray) -> np.ndarray:
    """Interpolated trigram, bigram and unigram estimates."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.0
    two, one = three.sum(0), three.sum((0, 1))
    three[EDGE, EDGE] = two[EDGE]  # the search starts every word after two edges
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * p2) / (three.sum(2, keepdims=True) + 5))


# --- the lattice ----------------------------------------------------------------

def lattice(form: str) -> list[list[tuple[str, float]]]:
    """Alternatives (letters, cost) at each place of a lower-case form; a blank ends a word."""
    places, i = [], 0
    while i < len(form):
        c = form[i]
        run = 1
        while i + run < len(form) and form[i + run] == c:
            run += 1
        if c.isalpha():
            if run >= 3:
                places.append([(c, REPEATED), (c + c, 2 * REPEATED)])
            else:
                places += [[(c, 0.0)]] * run
        elif c in STANDS_FOR:
            for _ in range(min(run, 2)):
                places.append(STANDS_FOR[c] + ([(" ", DIGIT_ALONE)] if c.isdigit() else [(" ", PARTED)]))
        else:
            places.append([("", JOINED), (" ", PARTED)])
        i += run
    return places


class Restorer:
    """Best reading of a form under the channel and the character model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.known: dict[str, list[str]] = {}

    def __call__(self, form: str) -> list[str]:
        """Words of the best reading."""
        found = self.known.get(form)
        if found is None:
            found = self.search(form)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[form] = found
        return found

    def symbol(self, c: str) -> int:
        code = int(letter_codes()[ord(c)])
        return ELSE if code == 255 else code

    def search(self, form: str) -> list[str]:
        model = self.model
        best = {(EDGE, EDGE): (0.0, "", None)}  # last two symbols -> (cost, text, what is before it)
        for at, place in enumerate([*lattice(form), [(" ", 0.0)]]):
            if at and at % PUT_ASIDE == 0:
                best = {k: (cost, "", (text, before)) for k, (cost, text, before) in best.items()}
            after: dict[tuple[int, int], tuple[float, str, tuple | None]] = {}
            for (a, b), (cost, text, before) in best.items():
                for letters, extra in place:
                    x, y, total, now = a, b, cost + extra, text
                    for c in letters:
                        if c == " ":
                            if y == EDGE:  # no empty words
                                continue
                            total -= model[x][y][EDGE]
                            x, y = EDGE, EDGE
                        else:
                            s = self.symbol(c)
                            total -= model[x][y][s]
                            x, y = y, s
                        now += c
                    old = after.get((x, y))
                    if old is None or (total, now) < old[:2]:
                        after[x, y] = (total, now, before)
            best = after
        _, text, before = min(best.values(), key=lambda x: x[:2])
        parts = [text]
        while before is not None:
            text, before = before
            parts.append(text)
        return "".join(reversed(parts)).split()


# --- features -------------------------------------------------------------------

@dataclass
class Features:
    """Feature hashes of a block with their text index; a text's words come in any order."""

    hashes: np.ndarray
    owner: np.ndarray


def _hash_words(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> Features:
    sizes = ends - starts
    hashes, owners = [span_hashes(codes, starts, ends)], [owner]
    for k in PREFIXES:
        some = sizes > k
        # a beginning is another feature than the word of the same letters
        hashes.append(span_hashes(codes, starts[some], starts[some] + k) ^ np.uint64(k))
        owners.append(owner[some])
    return Features(np.concatenate(hashes), np.concatenate(owners))


def restored_features(block: Block, restore: Restorer) -> Features:
    """Features of the restored texts of a (lower-cased) block."""
    codes, n = block.codes, len(block.codes)
    if not n:
        return Features(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    kind = char_classes()[codes]
    solid = kind != SPACE
    new = doc_starts(block)
    # forms: what stands between white space, without signs at its edges (a lone sign that stands for a letter is one)
    letter = kind == LETTER
    sign = np.isin(codes, np.array([ord("@"), ord("$")], dtype=np.uint32))
    body = letter | (kind == NUMBER) | sign
    start = solid & new[:-1]
    start[1:] |= solid[1:] & ~solid[:-1]
    form_start = np.flatnonzero(start)
    stop = solid & new[1:]
    stop[:-1] |= solid[:-1] & ~solid[1:]
    form_end = np.flatnonzero(stop) + 1
    body |= start & stop & np.isin(codes, np.array([ord(c) for c in STANDS_FOR], dtype=np.uint32))
    at = np.arange(n)
    next_body = np.minimum.accumulate(np.where(body, at, n)[::-1])[::-1]
    last_body = np.maximum.accumulate(np.where(body, at, -1))
    form_start = next_body[form_start]
    form_end = last_body[form_end - 1] + 1
    some = form_end > form_start
    form_start, form_end = form_start[some], form_end[some]
    total = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    letters, digits = total(letter), total(kind == NUMBER)
    thrice = letter.copy()
    thrice[2:] &= (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2])
    thrice[:2] = False
    repeats = total(thrice)
    size = form_end - form_start
    has = letters[form_end] - letters[form_start]
    plain = (has == size) & (repeats[form_end] - repeats[np.minimum(form_start + 2, form_end)] == 0)
    owner = np.searchsorted(block.offsets, form_start, side="right") - 1
    # letters spaced out: three or more forms of one sign in a row, in one text, at least two of them letters
    single = size == 1
    joined = np.zeros(len(size), dtype=bool)
    if len(size) > 2:
        turn = np.ones(len(size), dtype=bool)
        turn[1:] = (owner[1:] != owner[:-1]) | (single[1:] != single[:-1])
        run = np.cumsum(turn) - 1
        joined = single & (np.bincount(run)[run] > 2) & (np.bincount(run, weights=plain)[run] > 1)
    odd = ~plain & (has > 0)
    found = _hash_words(codes, form_start[plain & ~joined], form_end[plain & ~joined], owner[plain & ~joined])
    searched: list[tuple[str, int]] = []
    if odd.any() or joined.any():
        text = block.slice(0, n)
        for s, e, o in zip(form_start[odd].tolist(), form_end[odd].tolist(), owner[odd].tolist()):
            searched += [(w, o) for w in restore(text[s:e])]
        rows = np.flatnonzero(joined)
        if len(rows):
            breaks = np.flatnonzero((np.diff(rows) > 1) | (np.diff(owner[rows]) > 0)) + 1
            for run in np.split(rows, breaks):
                spaced = " ".join(text[s] for s in form_start[run].tolist())
                searched += [(w, int(owner[run[0]])) for w in restore(_squeezed(spaced))]
    if searched:
        words = [w for w, _ in searched]
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(w) for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        more = _hash_words(flat, starts, ends, np.array([o for _, o in searched], dtype=np.int64))
        found = Features(np.concatenate([found.hashes, more.hashes]), np.concatenate([found.owner, more.owner]))
    return found


def _squeezed(spaced: str) -> str:
    """Spaced letters with runs of one letter shortened to three, which the lattice reads as one or two."""
    letters, out = spaced.split(" "), []
    for c in letters:
        if out[-3:] != [c, c, c]:
            out.append(c)
    return " ".join(out) if len(set(out)) > 1 else "".join(out)


# --- the classifier ---------------------------------------------------------------

@dataclass
class ToxicModel:
    """What a score needs: the character model and the weights of the selected features."""

    characters: np.ndarray
    keys: np.ndarray      # sorted feature hashes
    weights: np.ndarray
    bias: float

    def values(self, block: Block, restore: Restorer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, value) of the selected features in a block."""
        features = restored_features(block, restore)
        if not len(self.keys):
            none = np.zeros(0, dtype=np.int64)
            return none, none, np.zeros(0)
        table = np.zeros(1 << 20, dtype=bool)
        table[(self.keys & np.uint64(0xFFFFF)).astype(np.int64)] = True
        near = np.flatnonzero(table[(features.hashes & np.uint64(0xFFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, features.hashes[near]), len(self.keys) - 1)
        hit = self.keys[at] == features.hashes[near]
        pair = features.owner[near][hit] * len(self.keys) + at[hit]
        pair, counts = np.unique(pair, return_counts=True)
        return pair // len(self.keys), pair % len(self.keys), np.log1p(counts)

    def score(self, block: Block, restore: Restorer) -> np.ndarray:
        owner, feature, value = self.values(block, restore)
        z = self.bias + np.bincount(owner, weights=value * self.weights[feature], minlength=block.count)
        return 1 / (1 + np.exp(-z))


def select_features(sample: DataFrame, characters: np.ndarray, limit: int = MAX_FEATURES) -> np.ndarray:
    """Hashes of the features whose share among toxic documents exceeds that among clean ones most surely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(characters)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(0), lower=True):
                found = restored_features(block, restore)
                order = np.lexsort((found.hashes, found.owner))
                h, o = found.hashes[order], found.owner[order]
                first = np.ones(len(h), dtype=bool)
                first[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                h, y = h[first], label[block.first + o[first]]
                # what each block has is summed before it is sent
                keys, inverse = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.bincount(inverse, weights=y, minlength=len(keys)).astype(np.int64)), pa.array(np.bincount(inverse, minlength=len(keys)))],
                    ["h", "toxic", "docs"],
                )

    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t")).first()
    n, t = total["n"], total["t"] or 0
    if not t or t == n:
        return np.zeros(0, dtype=np.uint64)
    share, rest = F.col("toxic") / F.lit(t), (F.col("docs") - F.col("toxic")) / F.lit(n - t)
    spread = F.sqrt(share * (1 - share) / F.lit(t) + rest * (1 - rest) / F.lit(n - t) + F.lit(1.0 / t / t))
    rows = (
        sample.select("text", "label").mapInArrow(run, "h long, toxic long, docs long")
        .groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))
        .where((F.col("toxic") >= MIN_TOXIC_DOCS) & (share > 2 * rest))
        .select("h", ((share - rest) / spread).alias("z")).orderBy(F.desc("z"), "h").limit(limit).collect()
    )
    return np.sort(np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64))


def logistic(owner: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray, n_features: int, ridge: float = 0.02, rounds: int = 400, rate: float = 0.05):
    """Weights and bias of a ridge logistic regression on sparse rows (Adam, full batch)."""
    w, b = np.zeros(n_features), float(np.log((label.mean() + 1e-3) / (1 - label.mean() + 1e-3)))
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = b + np.bincount(owner, weights=value * w[feature], minlength=len(label))
        error = 1 / (1 + np.exp(-z)) - label
        g = np.bincount(feature, weights=value * error[owner], minlength=n_features) / len(label) + ridge * w / len(label)
        gb = error.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c, d = 1 - 0.9**t, 1 - 0.999**t
        w -= rate * (m / c) / (np.sqrt(v / d) + 1e-8)
        b -= rate * (mb / c) / (np.sqrt(vb / d) + 1e-8)
    return w, b


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_SAMPLE) -> ToxicModel:
    """Character model of all documents, and a classifier of about ``max_rows`` labelled ones."""
    characters = character_model(docs)
    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, max_rows).checkpoint()
    empty = ToxicModel(characters, select_features(sample, characters), np.zeros(0), float(np.log(PRIOR / (1 - PRIOR))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(characters)
        for batch in batches:
            label = batch.column(1)
            for block in blocks(batch.column(0), lower=True):
                owner, feature, value = empty.values(block, restore)
                ends = np.searchsorted(owner, np.arange(block.count + 1))
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind))
                yield pa.RecordBatch.from_arrays(
                    [label.slice(block.first, block.count), lists(feature, pa.int32()), lists(value, pa.float32())], ["label", "f", "v"]
                )

    # at most max_rows rows of the few selected features they hold
    rows = sample.select("text", "label").mapInArrow(run, "label int, f array<int>, v array<float>").collect() if len(empty.keys) else []
    if not rows:
        return empty
    owner = np.repeat(np.arange(len(rows)), [len(r["f"]) for r in rows])
    feature = np.array([x for r in rows for x in r["f"]], dtype=np.int64)
    value = np.array([x for r in rows for x in r["v"]])
    weights, bias = logistic(owner, feature, value, np.array([r["label"] for r in rows], dtype=float), len(empty.keys))
    return ToxicModel(characters, empty.keys, weights, bias)


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1); an input column of that name is replaced."""
    docs = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.characters)
        for batch in batches:
            scores = [model.score(block, restore) for block in blocks(batch.column("text"), lower=True)]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``."""
    model = fit(docs, labels)
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
