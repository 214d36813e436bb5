"""Language identification and quality."""

import binascii
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.llm import langid, quality


def test_language_model_on_held_out_documents(documents):
    model = langid.train(documents.where(~langid.held_out()))
    assert model.labels == ["de", "en", "es", "fr"]
    assert 0.5 < (model.weights == 0).mean() < 1  # the L1 penalty leaves most weights at 0
    rows = langid.predict(documents, model).withColumn("out", langid.held_out()).where("out and lang is not null").collect()
    assert np.mean([row.lang == row.lang_pred for row in rows]) >= 0.95
    assert all(0 <= row.score <= 1 for row in rows)


def test_language_of_awkward_rows(documents, awkward, none):
    model = langid.train(documents)
    rows = langid.predict(awkward, model).collect()
    assert len(rows) == awkward.count()
    for row in rows:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred in model.labels) if letters else (row.lang_pred, row.score) == ("und", 0.0)
    assert langid.predict(none, model).collect() == []
    assert langid.train(none) is None
    assert {row.lang_pred for row in langid.predict(awkward, None).collect()} == {"und"}
    assert langid.train(awkward.where("lang is null")) is None


def test_learning_uses_only_the_rows_it_is_given(documents):
    renamed = documents.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in langid.train(renamed.where(~langid.held_out())).labels
    held = {row.doc_id for row in documents.where(langid.held_out()).collect()}
    every = {row.doc_id for row in documents.collect()}
    assert held == {doc for doc in every if binascii.crc32(str(doc).encode()) % 4 == 2}


def test_learning_is_repeatable(documents):
    one, two = (langid.train(df.where(~langid.held_out())) for df in (documents, documents.repartition(5)))
    assert np.array_equal(one.weights, two.weights) and one.temperature == two.temperature


def test_sample_is_bounded_however_often_a_key_repeats(spark):
    rows = spark.range(1000).select(F.lit(1).alias("doc_id"), F.lit("la la").alias("text"), F.lit("aa").alias("lang"))
    drawn = langid._sample(rows.withColumnRenamed("lang", "label"), "label", F.col("doc_id"), 20)
    assert drawn.count() <= 40


def test_letters_and_counts():
    table = langid.letter_table()
    assert "".join(map(chr, langid.letters_of("Ab, 12\nÇ\U00010400!", table))) == " ab ç\U00010428 "
    assert len(langid.letters_of("12 &&", table)) == 0
    assert langid.ngram_counts(langid.letters_of("abc", table)).sum() == 5 + 4 + 3


def test_temperature_flattens_overconfidence():
    rnd = np.random.default_rng(1)
    labels = rnd.integers(0, 2, 2000)
    right = rnd.random(2000) < 0.75
    logits = np.where((labels == 1) == right, 10.0, -10.0)[:, None] * np.array([-0.5, 0.5])
    temperature = langid.fit_temperature(logits, labels)
    assert abs(1 / (1 + np.exp(-10 / temperature)) - 0.75) < 0.03


# --- quality ------------------------------------------------------------------------------


def brute_measures(text):
    """The contract's base measures, word by word."""
    words = [word for word in __import__("re").split(r"[\x20\x09-\x0D]+", text) if word]
    windows = Counter(tuple(words[at:at + 3]) for at in range(len(words) - 2))
    covered = {
        place for at in range(len(words) - 2) if windows[tuple(words[at:at + 3])] >= 2 for place in range(at, at + 3)
    }
    seen, copies = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            copies += line in seen
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": copies, "n_repeat_words": len(covered),
    }


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab #\n\té\x85\r"), max_size=60))
def test_measures_equal_brute_force(text):
    got = dict(zip(quality.MEASURES, quality.measures_of(text.encode())))
    wanted = brute_measures(text)
    for name in ("n_words", "n_symbols", "n_dup_lines", "n_repeat_words"):
        assert got[name] == wanted[name]


def test_repeated_windows_with_very_many_words():
    ids = np.concatenate([np.arange(3_000_000), [5, 6, 7]])
    assert quality.repeated_words(ids, 3_000_000) == 6


def test_judge_measures_and_base_failures(documents, awkward, none):
    for df in (documents, awkward):
        rows = quality.judge(df.select("doc_id", "text")).collect()
        assert len(rows) == df.count()
        for row in rows:
            wanted = brute_measures(row.text or "")
            assert {name: row[name] for name in wanted} == wanted
            failed = wanted["n_words"] < 50 or 100 * wanted["n_repeat_words"] > 50 * wanted["n_words"]
            assert row.base_failed == failed and (not failed or not row.kept) and 0 <= row.quality <= 1
    assert quality.judge(none).collect() == []


def test_verdicts_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"), keep=["doc_id"]).drop("quality")
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert all(row.kept for row in rows if row.quality == 1)
    assert np.mean([not row.kept for row in rows if row.quality == 0]) >= 0.9


def test_accuracies_are_found_without_labels():
    rnd = np.random.default_rng(5)
    spec, sens = np.array([0.999, 0.995, 0.998, 0.993]), np.array([0.9, 0.7, 0.8, 0.6])
    good = rnd.random(40000) < 0.8
    bad_vote = np.where(good[:, None], rnd.random((40000, 4)) > spec, rnd.random((40000, 4)) < sens)
    votes = np.where(rnd.random((40000, 4)) < 0.1, 0, np.where(bad_vote, -1, 1))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, found_spec, found_sens = quality.fit_accuracies(patterns, counts.astype(float))
    assert abs(prior - 0.8) < 0.02
    assert np.abs(found_spec - spec).max() < 0.01 and np.abs(found_sens - sens).max() < 0.03


def test_abstaining_rules_say_nothing():
    odds = quality.log_odds(np.array([[0, 0]]), 0.9, np.array([0.99, 0.99]), np.array([0.5, 0.5]))
    assert odds[0] == pytest.approx(np.log(9))
