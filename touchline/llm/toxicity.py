"""Toxicity by a counterfactual-regularised classifier.

A text is the set of its words (lower-cased runs of letters); a word stands for itself and for its
beginnings of 4, 5 and 6 letters, hashed into slots, so that an unseen ending of a known stem counts.
The logit is the bias plus the weights of the slots that a text has. Weights are at least 0: a long
harmless passage cannot talk an insult down, and a length alone adds nothing.

They are fitted to a bounded sample of labelled rows by accelerated proximal steps on

    mean log loss + L1 + L2 + FAIRNESS * mean (logit(text) - logit(swapped text)) ** 2 / 2

where the swapped text has, in each of its sentences, every identity term replaced by another one of
its group. A group also holds a neutral word, so the weight of a term that merely goes along with
toxic labels is drawn to that of `people`: a neutral mention scores as if no group had been named. A
held-back part of the sample sets scale and offset of the logit (Platt), and the offset is moved to
the share of toxic rows among all labelled ones.

Null and empty texts, and those without a letter, score the offset alone. Without a toxic and a
harmless example to learn from, every score is 0. Rows with a null label or key are never learnt from; a key
with several labels is toxic if any says so. Rows that repeat an id are each scored. Texts of any
length are read whole; a worker's memory holds one slice of them. An empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import add_columns, texts_of, unused
from touchline.sources.scratch import materialize

SLOTS = 1 << 20
STEMS = (4, 5, 6)
# About this many rows of each label are drawn, and at most about so many filled slots in all.
SAMPLE_PER_LABEL = 3000
SAMPLE_SLOTS = 1 << 24
# Slots that are fitted: those most dependent on the label, by chi-squared, that so many rows have.
FITTED, LEAST_ROWS, LEAST_CHI = 4096, 5, 10.0
L1, L2, FAIRNESS, STEPS = 3e-4, 1e-4, 4.0, 400
# Words a worker remembers with their slots; longer ones are looked up each time.
CACHE_WORDS, CACHE_LETTERS = 200_000, 40

# Words that can stand for each other; the first of each group names no group of people.
GROUPS = (
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("person", "muslim", "christian", "jew", "hindu", "buddhist", "catholic", "atheist"),
    ("local", "black", "white", "asian", "african", "arab", "jewish", "mexican", "chinese", "indian", "european"),
    ("residents", "immigrants", "refugees", "foreigners", "africans", "asians", "arabs", "mexicans", "americans"),
    ("adults", "women", "men", "girls", "boys"),
    ("adult", "woman", "man", "girl", "boy"),
    ("some", "gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    ("other", "deaf", "blind", "disabled", "autistic", "old", "young", "elderly"),
    ("leute", "muslime", "christen", "juden", "ausländer", "flüchtlinge", "frauen", "männer"),
    ("gens", "musulmans", "chrétiens", "juifs", "étrangers", "réfugiés", "femmes", "hommes"),
    ("gente", "musulmanes", "cristianos", "judíos", "extranjeros", "refugiados", "mujeres", "hombres"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def slots_of_word(word: str) -> list[int]:
    """The slots of a word and of its beginnings."""
    found = [zlib.crc32(b"=" + word.encode("utf-8", "replace")) % SLOTS]
    return found + [
        zlib.crc32(b"^" + word[:n].encode("utf-8", "replace")) % SLOTS for n in STEMS if len(word) > n
    ]


def slots_of(words: set[str]) -> np.ndarray:
    """The distinct slots of a set of words, ascending."""
    found: set[int] = set()
    for word in words:
        found.update(slots_of_word(word))
    return np.array(sorted(found), np.int32)


def swapped_words(text: str, groups: tuple[tuple[str, ...], ...] = GROUPS) -> set[str] | None:
    """The words of the text with the identity terms of each sentence replaced by others of their
    groups; None if it holds no term. Which one is taken depends on the sentence, not on chance."""
    place = {term: (group, at) for group in groups for at, term in enumerate(group)}
    found, any_term = set(), False
    for sentence in _SENTENCE.split(text.lower()):
        words = _WORD.findall(sentence)
        terms = {word for word in words if word in place}
        if terms:
            any_term = True
            step = zlib.crc32(sentence.encode("utf-8", "replace"))
            other = {}
            for term in terms:
                group, at = place[term]
                other[term] = group[(at + 1 + step % (len(group) - 1)) % len(group)]
            words = [other.get(word, word) for word in words]
        found.update(words)
    return found if any_term else None


@dataclass
class Model:
    """Weights by slot, all above 0; the logit's bias, scale and offset."""

    weights: dict[int, float]
    bias: float
    scale: float = 1.0
    offset: float = 0.0

    def score(self, slots) -> float:
        logit = self.bias + sum(self.weights.get(int(slot), 0.0) for slot in slots)
        return self.of_logit(logit)

    def of_logit(self, logit: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * logit + self.offset, -700, 700))))


class _Matrix:
    """Sparse rows of slots, as columns of the fitted ones; the transpose too."""

    def __init__(self, rows: list[np.ndarray], column: np.ndarray, width: int) -> None:
        self.height, self.width = len(rows), width
        lengths = [len(row) for row in rows]
        at = column[np.concatenate(rows)] if rows else np.empty(0, np.int64)
        inside = at >= 0
        self.row, self.at = np.repeat(np.arange(len(rows)), lengths)[inside], at[inside]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.at], minlength=self.height)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=r[self.row], minlength=self.width)


def chosen_slots(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The slots that go along with the toxic label most clearly, at most FITTED of them."""
    lengths = [len(row) for row in rows]
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    n, positives = len(rows), toxic.sum()
    seen = np.bincount(flat, minlength=SLOTS).astype(float)
    with_label = np.bincount(flat, weights=np.repeat(toxic, lengths), minlength=SLOTS)
    expected = seen * positives / n
    spread = expected * (1 - seen / n) * (1 - positives / n)
    chi = np.where(spread > 0, (with_label - expected) ** 2 / np.maximum(spread, 1e-12), 0.0)
    # A slot that all rows have tells nothing; a small sample asks for no more rows than it can give.
    good = np.flatnonzero((seen >= min(LEAST_ROWS, max(2, positives / 10))) & (chi >= LEAST_CHI) & (with_label > expected))
    return np.sort(good[np.lexsort((good, -chi[good]))][:FITTED])


def fit(
    rows: list[np.ndarray], toxic: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]],
    fairness: float = FAIRNESS, l1: float = L1, l2: float = L2, steps: int = STEPS,
) -> tuple[dict[int, float], float]:
    """Weights and bias from the slots of rows, their labels, and the slots of swapped texts in pairs."""
    slots = chosen_slots(rows, toxic)
    n, width = len(rows), len(slots)
    rate = np.clip(toxic.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(rate / (1 - rate)))
    if not width:
        return {}, bias
    column = np.full(SLOTS, -1)
    column[slots] = np.arange(width)
    x = _Matrix(rows, column, width)
    own, other = (_Matrix([pair[side] for pair in pairs], column, width) for side in (0, 1))
    share = fairness / max(1, len(pairs))

    def swap_change(w: np.ndarray) -> np.ndarray:
        change = own.times(w) - other.times(w)
        return share * (own.back(change) - other.back(change))

    # The largest curvature, by power iteration, bounds the step.
    v = np.ones(width) / np.sqrt(width)
    for _ in range(30):
        v = x.back(x.times(v)) / (4 * n) + swap_change(v)
        size = np.linalg.norm(v)
        v = v / max(size, 1e-12)
    step = 1 / (1.2 * (size + 0.25) + l2)
    w, ahead, momentum = np.zeros(width), np.zeros(width), 1.0
    bias_ahead = bias
    for _ in range(steps):
        error = (1 / (1 + np.exp(-(x.times(ahead) + bias_ahead))) - toxic) / n
        gradient = x.back(error) + l2 * ahead + swap_change(ahead)
        new = np.maximum(ahead - step * (gradient + l1), 0.0)
        new_bias = bias_ahead - step * error.sum()
        faster = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = new + (momentum - 1) / faster * (new - w)
        bias_ahead = new_bias + (momentum - 1) / faster * (new_bias - bias)
        w, bias, momentum = new, new_bias, faster
    return {int(slot): float(value) for slot, value in zip(slots, w) if value > 0}, float(bias)


def fit_scale(logits: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Scale and offset of the logits with the least log loss on smoothed labels, by Newton steps."""
    positives, negatives = toxic.sum(), (1 - toxic).sum()
    if not positives or not negatives:
        return 1.0, 0.0
    target = np.where(toxic > 0, (positives + 1) / (positives + 2), 1 / (negatives + 2))
    both = np.stack([logits, np.ones(len(logits))], axis=1)
    found = np.array([1.0, 0.0])

    def loss(at: np.ndarray) -> float:
        z = both @ at
        return float((np.logaddexp(0, z) - target * z).sum() + 0.5 * ((at - [1.0, 0.0]) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-(both @ found)))
        gradient = both.T @ (p - target) + (found - [1.0, 0.0])
        curve = (both * (p * (1 - p))[:, None]).T @ both + np.eye(2)
        move, before = np.linalg.solve(curve, gradient), loss(found)
        while loss(found - move) > before and np.abs(move).max() > 1e-9:
            move = move / 2
        found = found - move
    return float(max(found[0], 0.1)), float(found[1])


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id",
    per_label: int = SAMPLE_PER_LABEL, slots: int = SAMPLE_SLOTS, fairness: float = FAIRNESS,
    groups: tuple[tuple[str, ...], ...] = GROUPS,
) -> Model | None:
    """Fit a model to the documents that `labels` (key, label) name; None without both labels.

    The key only decides which rows are drawn; it is no input of the model. Driver: the slots of the
    drawn rows, about `slots` numbers at most, whatever the input. Documents do not move: the drawn
    keys, about twice `per_label`, are sent to them.
    """
    known = labels.select(F.col(f"`{key}`").alias("key"), (F.col(f"`{label}`") > 0).cast("int").alias("toxic"))
    known = known.dropna().groupBy("key").agg(F.max("toxic").alias("toxic"))
    sizes = {row.toxic: row["count"] for row in known.groupBy("toxic").count().collect()}  # two rows
    if len(sizes) < 2:
        return None
    place = F.pmod(F.xxhash64("key", F.lit(13)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, per_label / sizes[1]).otherwise(per_label / sizes[0])
    drawn = materialize(known.where(place < share).limit(4 * per_label), "toxicity-sample")
    named = unused(docs, "_key")
    rows = docs.select(F.col(f"`{key}`").alias(named), F.col(f"`{text}`").alias("text"))
    rows = rows.join(F.broadcast(drawn), rows[named] == drawn["key"]).select("toxic", "text")

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        def compute(column: pa.Array) -> list[pa.Array]:
            own, other = [], []
            for one in texts_of(column):
                own.append(slots_of(set(_WORD.findall(one.lower()))).tobytes())
                swapped = swapped_words(one, groups)
                other.append(None if swapped is None else slots_of(swapped).tobytes())
            return [pa.array(own, pa.binary()), pa.array(other, pa.binary())]

        return compute

    counted = materialize(add_columns(
        rows.withColumn("part", F.xxhash64("text", F.lit(17))), "text", "slots binary, swapped binary", make,
        keep=["toxic", "part"],
    ), "toxicity-slots")
    filled = F.octet_length("slots") + F.coalesce(F.octet_length("swapped"), F.lit(0))
    total = counted.agg(F.sum(filled / 4).alias("n"), F.count("*").alias("rows")).first()
    if not total.rows:
        return None
    # A key that many rows repeat, or very long texts, could outgrow the bound: then a share is taken.
    fits = min(1.0, slots / max(1, total.n or 0), 8 * per_label / total.rows)
    kept = counted.where(F.pmod("part", F.lit(1 << 30)) <= fits * (1 << 30))
    sample = sorted(
        (row.part, row.toxic, bytes(row.slots), None if row.swapped is None else bytes(row.swapped))
        for row in kept.collect()
    )
    own = [np.frombuffer(row[2], np.int32) for row in sample]
    toxic = np.array([row[1] for row in sample], float)
    pairs = [(at, np.frombuffer(row[3], np.int32)) for at, row in zip(own, sample) if row[3] is not None]
    learn = np.arange(len(own)) % 5 != 4
    if not 0 < toxic[learn].sum() < learn.sum():
        return None
    weights, bias = fit([row for row, in_ in zip(own, learn) if in_], toxic[learn], pairs, fairness)
    model = Model(weights, bias)
    back = np.flatnonzero(~learn)
    logits = np.array([bias + sum(weights.get(slot, 0.0) for slot in own[at].tolist()) for at in back])
    model.scale, model.offset = fit_scale(logits, toxic[back]) if len(back) else (1.0, 0.0)
    drawn_odds = toxic.sum() / max(1.0, len(toxic) - toxic.sum())
    model.offset += float(np.log(sizes[1] / sizes[0]) - np.log(drawn_odds))
    return model


def predict(
    df: DataFrame, model: Model | None, text: str = "text", score: str = "score", keep: list[str] | None = None
) -> DataFrame:
    """Add the score of each whole text, 0 to 1. No shuffle."""
    # At most FITTED weights: the model travels with the tasks as a broadcast.
    shared = df.sparkSession.sparkContext.broadcast(
        None if model is None else (model.weights, model.bias, model.scale, model.offset)
    )

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        fitted = None if shared.value is None else Model(*shared.value)
        weights = fitted.weights if fitted else {}
        known: dict[str, tuple[int, ...]] = {}

        def of(word: str) -> tuple[int, ...]:
            found = tuple(slot for slot in slots_of_word(word) if slot in weights)
            if len(word) <= CACHE_LETTERS:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                known[word] = found
            return found

        def compute(column: pa.Array) -> list[pa.Array]:
            scores = []
            for one in texts_of(column):
                if fitted is None:
                    scores.append(0.0)
                    continue
                hits: set[int] = set()
                for word in set(_WORD.findall(one.lower())):
                    found = known.get(word)
                    hits.update(of(word) if found is None else found)
                scores.append(fitted.score(sorted(hits)))
            return [pa.array(scores, pa.float64())]

        return compute

    return add_columns(df, text, f"`{score}` double", make, keep)
