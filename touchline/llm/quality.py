"""Quality by weak supervision: rules vote or abstain, and a model of their accuracies decides.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation estimates, without any
label, how often a rule that votes calls a good text good and a bad text bad, and the share of good
texts; the posterior probability of being good replaces the demand that all rules pass. The model
sees vote patterns and their counts over all documents: at most 3 ** rules rows, whatever the input.

Null text has no words and no lines: all measures 0, base_failed true. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import add_columns, bytes_of
from touchline.sources.scratch import materialize

_BLANKS = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_top_word", "n_caps", "n_bangs", "n_letter_words",
)
# A text is kept from this posterior probability on.
KEEP_FROM = 0.5
# Bounds of what the model may believe of a rule: it calls at least this share of the good texts it
# votes on good, and between these shares of the bad ones bad.
LEAST_SPECIFICITY, LEAST_SENSITIVITY, MOST_SENSITIVITY = 0.99, 0.2, 0.999


def repeated_words(ids: np.ndarray, distinct: int, window: int = 3) -> int:
    """The words that lie in a window which occurs twice or more, its first place included."""
    n = len(ids)
    if n <= window:
        return 0
    key = ids[: n - window + 1]
    for step in range(1, window):
        if len(key) and int(key.max()) > 2**62 // max(distinct, 1):  # make the codes dense again
            key = np.unique(key, return_inverse=True)[1]
        key = key * distinct + ids[step: n - window + 1 + step]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for step in range(window):
        covered[step: n - window + 1 + step] |= twice
    return int(covered.sum())


def measures_of(text: bytes) -> list[int]:
    """MEASURES of one text but for word_chars, which holds its bytes that are no blanks."""
    words = text.split()
    if not words:
        return [0, 0, len(text) - len(text.translate(None, _SYMBOLS)), *[0] * 7]
    index = {word: number for number, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    counts = np.bincount(ids)
    caps, bangs, letters = [], [], []
    for word in index:
        caps.append(len(word) > 1 and word.isupper())
        bangs.append(b"!!" in word)
        letters.append(word.lower() != word.upper() or word[0] > 127)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        len(words), len(text.translate(None, _BLANKS)), len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(ids, len(index)), len(lines), int(counts.max()),
        int(counts[np.array(caps)].sum()), int(counts[np.array(bangs)].sum()), int(counts[np.array(letters)].sum()),
    ]


def measure(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the MEASURES of each whole text. No shuffle."""
    def make() -> Callable[[pa.Array], list[pa.Array]]:
        def compute(column: pa.Array) -> list[pa.Array]:
            rows = np.array([measures_of(one) for one in bytes_of(column)], np.int64).reshape(-1, len(MEASURES))
            columns = [pa.array(rows[:, at], pa.int64()) for at in range(len(MEASURES))]
            # Code points: all of the text less its blanks, which have one byte each.
            blanks = pc.subtract(pc.fill_null(pc.binary_length(column), 0), columns[1])
            chars = pc.cast(pc.fill_null(pc.utf8_length(column), 0), pa.int64())
            columns[1] = pc.subtract(chars, pc.cast(blanks, pa.int64()))
            return columns

        return compute

    return add_columns(df, text, ", ".join(f"{name} bigint" for name in MEASURES), make, keep)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes, from the measures."""
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    length = F.col("word_chars") / words

    def most(measure_: str, of: Column, good: float, bad: float) -> Column:
        share = F.col(measure_) / of
        return _vote(share <= good, share > bad)

    return {
        "enough_words": _vote(F.col("n_words") >= 50, F.col("n_words") < 20),
        "word_length": _vote(length.between(3, 10), (length < 2) | (length > 15)),
        "symbols_per_word": most("n_symbols", words, 0.02, 0.1),
        "symbols_per_char": most("n_symbols", F.greatest(F.col("word_chars"), F.lit(1)), 0.01, 0.08),
        "line_copies": most("n_dup_lines", lines, 0.1, 0.3),
        "phrase_copies": most("n_repeat_words", words, 0.2, 0.5),
        "top_word": most("n_top_word", words, 0.12, 0.3),
        "capitals": most("n_caps", words, 0.1, 0.5),
        "shouting": most("n_bangs", words, 0.02, 0.2),
        "letters": _vote(F.col("n_letter_words") / words >= 0.9, F.col("n_letter_words") / words < 0.7),
    }


def fit_accuracies(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good texts, specificity, sensitivity) of vote patterns (patterns x rules in -1, 0, 1).

    A rule that abstains says nothing. The estimates start at 0.995 and 0.6 and have a weak prior
    there, so that a rule which hardly ever votes keeps sensible ones.
    """
    prior, spec, sens = 0.9, np.full(votes.shape[1], 0.995), np.full(votes.shape[1], 0.6)
    good, bad = votes > 0, votes < 0
    for _ in range(rounds):
        odds = log_odds(votes, prior, spec, sens)
        belief = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        on_good, on_bad = counts * belief, counts * (1 - belief)
        last = spec, sens
        spec = (19.9 + on_good @ good) / (20 + on_good @ (good | bad))
        sens = (12 + on_bad @ bad) / (20 + on_bad @ (good | bad))
        spec = np.clip(spec, LEAST_SPECIFICITY, 1 - 1e-6)
        sens = np.clip(sens, LEAST_SENSITIVITY, MOST_SENSITIVITY)
        prior = float(np.clip((9 + on_good.sum()) / (10 + counts.sum()), 0.01, 0.99))
        if max(np.abs(spec - last[0]).max(), np.abs(sens - last[1]).max()) < 1e-9:
            break
    return prior, spec, sens


def log_odds(votes: np.ndarray, prior: float, spec: np.ndarray, sens: np.ndarray) -> np.ndarray:
    """Log odds of good against bad for each vote pattern."""
    for_good, for_bad = np.log(spec / (1 - sens)), np.log((1 - spec) / sens)
    return np.log(prior / (1 - prior)) + (votes > 0) @ for_good + (votes < 0) @ for_bad


def judge(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the measures, base_failed, the posterior `quality` and `kept` to each row.

    Texts are read once; the measures are written, their vote patterns counted, and both the model
    and the result read from there.
    """
    kept = [name for name in (df.columns if keep is None else keep) if name != text or keep is None]
    measured = materialize(measure(df, text, kept), "quality")
    votes = rules()
    names = list(votes)
    patterns = measured.select(*[vote.cast("tinyint").alias(name) for name, vote in votes.items()])
    found = patterns.groupBy(*names).count().collect()  # 3 ** rules rows at most
    grid = np.array([[row[name] for name in names] for row in found], np.int64).reshape(-1, len(names))
    prior, spec, sens = fit_accuracies(grid, np.array([row["count"] for row in found], float))

    for_good, for_bad = np.log(spec / (1 - sens)), np.log((1 - spec) / sens)
    terms = [
        F.when(vote > 0, float(for_good[at])).when(vote < 0, float(for_bad[at])).otherwise(0.0)
        for at, vote in enumerate(votes.values())
    ]
    odds = reduce(add, terms, F.lit(float(np.log(prior / (1 - prior)))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measured.withColumn("quality", 1 / (1 + F.exp(-odds)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= KEEP_FROM))
    )
