"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of the lower-cased letters of a text, with every run of other
characters as one blank, hashed into a fixed number of slots; weights are (1 + log tf) * idf,
scaled to length 1. The document frequencies come from all learning rows; the weights are fitted
to a bounded sample of them by follow-the-regularised-leader with elastic-net penalties (the L1
part leaves most weights at exactly 0); a temperature fitted to a held-back part of the sample
calibrates the probabilities.

A null text, or one without a letter, is `und` with score 0. Without any learning row every text
is `und`. Rows with a null label are never learnt from. Ties go to the least label.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import add_columns, ship, slices, texts_of

UNDETERMINED = "und"
SLOTS = 1 << 15
# Rows of each language that the weights are fitted to; one in five of them sets the temperature.
SAMPLE_PER_LANGUAGE = 1000
EPOCHS = 4
_BLANK = 32


def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank, for the basic plane."""
    table = np.full(1 << 16, _BLANK, np.uint32)
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c.lower()[0])
    return table


def letters_of(text: str, table: np.ndarray) -> np.ndarray:
    """The lower-cased letters with single blanks between and around runs; empty without a letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = table[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        found, back = np.unique(codes[high], return_inverse=True)
        low[high] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else _BLANK for c in found], np.uint32)[back]
    padded = np.concatenate([[_BLANK], low, [_BLANK]]).astype(np.uint64)
    blank = padded == _BLANK
    if blank.all():
        return padded[:0]
    repeated = np.zeros(len(padded), bool)
    repeated[1:] = blank[1:] & blank[:-1]
    return padded[~repeated]


def ngram_counts(letters: np.ndarray) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams."""
    shift = np.uint64(64 - SLOTS.bit_length() + 1)
    odd = [np.uint64(value) for value in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    one = letters * odd[0]
    two = (one[:-1] ^ (letters[1:] + np.uint64(1)) * odd[1]) * odd[2]
    three = (two[:-1] ^ (letters[2:] + np.uint64(2)) * odd[1]) * odd[0]
    grams = np.concatenate([one * odd[1], two * odd[1], three * odd[1]]) >> shift
    return np.bincount(grams.astype(np.int64), minlength=SLOTS)


def features_of(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The filled slots of a text and their TF-IDF weights, scaled to length 1."""
    slots = np.flatnonzero(counts)
    weights = (1 + np.log(counts[slots])) * idf[slots]
    return slots, weights / max(np.sqrt((weights * weights).sum()), 1e-12)


@dataclass
class Model:
    """A fitted classifier: labels in ascending order, idf by slot, weights, bias, temperature."""

    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # slots x labels
    bias: np.ndarray
    temperature: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        slots, values = features_of(counts, self.idf)
        return (values @ self.weights[slots] + self.bias) / self.temperature

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(counts))


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], n_labels: int, alpha: float = 0.5, beta: float = 1.0,
    l1: float = 0.02, l2: float = 0.5,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader, proximal, one row at a time.

    z collects the adjusted gradients and n their squares, per slot and label. A weight is 0 while
    |z| <= l1; beyond that it is the closed-form minimum with the L2 penalty. The bias is a slot of
    its own that is not penalised by l1.
    """
    z, n = np.zeros((SLOTS + 1, n_labels)), np.zeros((SLOTS + 1, n_labels))
    lasso = np.full((SLOTS + 1, 1), l1)
    lasso[SLOTS] = 0

    def solve(zs: np.ndarray, ns: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        active = np.abs(zs) > penalty
        return np.where(active, -(zs - np.sign(zs) * penalty) / ((beta + np.sqrt(ns)) / alpha + l2), 0.0)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for index in order.permutation(len(rows)):
            slots, values, label = rows[index]
            slots, values = np.append(slots, SLOTS), np.append(values, 1.0)
            zs, ns = z[slots], n[slots]
            weights = solve(zs, ns, lasso[slots])
            error = _softmax(values @ weights)
            error[label] -= 1
            gradient = values[:, None] * error
            squares = gradient * gradient
            sigma = (np.sqrt(ns + squares) - np.sqrt(ns)) / alpha
            z[slots] = zs + gradient - sigma * weights
            n[slots] = ns + squares
    weights = solve(z, n, lasso)
    return weights[:SLOTS], weights[SLOTS]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""
    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _sample(rows: DataFrame, label: str, key: Column, per_label: int) -> DataFrame:
    """About `per_label` rows of each label, the same on every run: those whose key's hash falls into
    the share that the label's count asks for. One aggregation, no sort, no hot label. Twice the
    wanted number is a firm bound, which only a key that repeats without end could reach."""
    sizes = {row[0]: row[1] for row in rows.groupBy(label).count().collect()}  # one row per language
    share = F.lit(None).cast("double")
    for name, size in sizes.items():
        share = F.when(F.col(label) == name, F.lit(min(1.0, per_label / size))).otherwise(share)
    place = F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(place < share).limit(2 * per_label * max(1, len(sizes)))


def train(
    rows: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model | None:
    """Fit a model to rows with a label; None if there are none (or no text with a letter). `key`
    only decides which rows are in the sample; it is no input of the model.

    Driver: the document frequency of each slot, and the counts of the sampled rows, about
    `per_language` of each label: both bounded, whatever the input.
    """
    rows = rows.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label"), F.col(f"`{key}`").alias("key")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total, n = letter_table(), np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                for one in texts_of(part.column("text")):
                    letters = letters_of(one, table)
                    if len(letters):
                        total += ngram_counts(letters) > 0
            n += batch.num_rows
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*filled.tolist(), -1], pa.int32()), pa.array([*total[filled].tolist(), n], pa.int64())],
            ["slot", "n"],
        )

    # Each task sends one row per slot, added up before and after the shuffle.
    ship()
    partial = rows.select("text").mapInArrow(frequencies, "slot int, n bigint")
    found = partial.groupBy("slot").agg(F.sum("n").alias("n")).collect()  # SLOTS + 1 rows at most
    df = np.zeros(SLOTS + 1)
    for row in found:
        df[row.slot] = row.n  # slot -1 is the number of rows
    if not df[SLOTS]:
        return None
    idf = np.log((1 + df[SLOTS]) / (1 + df[:SLOTS])) + 1

    def count_make() -> Callable[[pa.Array], list[pa.Array]]:
        table = letter_table()

        def compute(column: pa.Array) -> list[pa.Array]:
            slots, counts = [], []
            for text_ in texts_of(column):
                letters = letters_of(text_, table)
                found = ngram_counts(letters) if len(letters) else np.zeros(SLOTS, np.int64)
                at = np.flatnonzero(found)
                slots.append(at.astype("<u2").tobytes())
                counts.append(found[at].astype("<u4").tobytes())
            return [pa.array(slots, pa.binary()), pa.array(counts, pa.binary())]

        return compute

    drawn = _sample(rows, "label", F.col("key"), per_language)
    counted = add_columns(drawn, "text", "slots binary, counts binary", count_make, keep=["label"])
    sample = sorted(
        (row.label, bytes(row.slots), bytes(row.counts)) for row in counted.collect() if row.slots
    )
    labels = sorted({name for name, _, _ in sample})
    if not labels:
        return None
    data = []
    for name, slots, counts in sample:
        at = np.frombuffer(slots, "<u2")
        dense = np.zeros(SLOTS, np.int64)
        dense[at] = np.frombuffer(counts, "<u4")
        filled, values = features_of(dense, idf)
        data.append((filled.astype(np.int32), values.astype(np.float32), labels.index(name)))
    del sample
    back = [row for index, row in enumerate(data) if index % 5 == 4]
    weights, bias = fit_ftrl([row for index, row in enumerate(data) if index % 5 != 4], len(labels))
    temperature = 1.0
    if back:
        logits = np.array([values @ weights[slots] + bias for slots, values, _ in back])
        temperature = fit_temperature(logits, np.array([label_ for _, _, label_ in back]))
    return Model(labels, idf, weights, bias, temperature)


def predict(
    df: DataFrame, model: Model | None, text: str = "text", lang: str = "lang_pred", score: str = "score",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add the predicted label of each whole text and its probability. No shuffle."""
    # The model is of a fixed size (slots x labels): it travels with the tasks as a broadcast.
    shared = df.sparkSession.sparkContext.broadcast(
        None if model is None else (
            model.labels, model.idf.astype(np.float32), model.weights.astype(np.float32),
            model.bias, model.temperature,
        )
    )

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        table = letter_table()
        fitted = None if shared.value is None else Model(*shared.value)

        def compute(column: pa.Array) -> list[pa.Array]:
            names, scores = [], []
            for one in texts_of(column):
                letters = letters_of(one, table)
                if fitted is None or not len(letters):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                p = fitted.probabilities(ngram_counts(letters))
                best = int(p.argmax())
                names.append(fitted.labels[best])
                scores.append(float(p[best]))
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return compute

    return add_columns(df, text, f"`{lang}` string, `{score}` double", make, keep)


def held_out(doc_id: str = "doc_id", remainder: int = 2) -> Column:
    """True for the documents that are never learnt from: crc32(doc_id as text) mod 4."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4 == remainder, F.lit(False))
