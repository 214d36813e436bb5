"""Line deduplication by winnowing, with column functions only.

Lines are hashed. A gram is the least number of lines from a line on that hold `gram` words (a line
without words counts as one). Of all grams that start within `guarantee - gram` words from a line the
one with the least hash is selected, so every run of lines with `guarantee` words has a selected gram
inside it, and the same one in every document. Around each selected gram that occurs twice, the runs are
taken that hold `guarantee` words with the least number of lines: from each line before the gram on, and
up to each line after it. They are joined to the first position (by document id, then place) of the same
run, key and neighbouring lines alike, and the lines of its later copies are deleted. A line within any
longer repeated run lies in such a run inside it, so all lines of all later copies go. First copies stay,
but for lines that belong to a later copy of another run: where a later copy overlaps the first one, as
in a text that repeats a line over and over, the lines of the first stay.

Null text stays null. Ids may be of any type. Rows that repeat an id and text are one document and all
get its result; a null id comes after all others, and documents of one id are ordered by a hash of their
text. Texts that lose all lines become empty. Lines are compared by 64-bit hashes. Texts are taken
whole, however long; a task sorts the lines of a document and holds as many as a run has words. An empty
table gives an empty one. Other columns stay, and one with the name of the new column is replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import filled, unused
from touchline.sources.scratch import materialize

GRAM_WORDS = 25
RUN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"
_DOC = ["no_id", "id", "mark"]


def _keys(df: DataFrame, doc_id: str, text: str) -> list[Column]:
    """A document's key: its id (with a flag if null) and a hash of its text. Ids keep their type."""
    return [
        F.col(f"`{doc_id}`").isNull().alias("no_id"), filled(df, doc_id).alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("mark"),
    ]


def _lines(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(document, place, hash, words, words before) of every line; a document's lines lie together."""
    body = F.col(f"`{text}`")
    rows = df.where(body.isNotNull()).select(*_keys(df, doc_id, text), F.posexplode(F.split(body, "\n", -1)).alias("place", "line"))
    rows = rows.select(
        *_DOC, "place", F.xxhash64("line").alias("hash"),
        F.greatest(F.lit(1), F.regexp_count("line", F.lit(_WORD))).cast("bigint").alias("words"),
    )
    # One shuffle serves the removal of repeated rows and all windows over a document.
    rows = rows.repartition(*_DOC).groupBy(*_DOC, "place").agg(F.max("hash").alias("hash"), F.max("words").alias("words"))
    before = W.partitionBy(*_DOC).orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("at", F.coalesce(F.sum("words").over(before), F.lit(0).cast("bigint")))


def _selected(lines: DataFrame, gram: int, run: int) -> DataFrame:
    """The selected grams with their lines and the lines around them."""
    by_words = W.partitionBy(*_DOC).orderBy("at")
    # As every line counts a word at least, so many rows hold all that is looked at.
    around = W.partitionBy(*_DOC).orderBy("at").rowsBetween(-run, gram + run)
    line = F.struct("at", "words", "hash")
    rows = lines.withColumn("around", F.collect_list(line).over(around))

    def part(low: Column, high: Column) -> Column:
        """The lines that begin in [low, high)."""
        return F.filter("around", lambda one: (one["at"] >= low) & (one["at"] < high))

    at = F.col("at")
    rows = rows.withColumn("gram", part(at, at + gram))
    rows = rows.withColumn("size", F.aggregate("gram", F.lit(0).cast("bigint"), lambda sum_, one: sum_ + one["words"]))
    hashes = F.transform("gram", lambda one: one["hash"])
    rows = rows.withColumn("key", F.when(F.col("size") >= gram, F.xxhash64(hashes)))
    left = F.filter("around", lambda one: (one["at"] < at) & (one["at"] + one["words"] > at - run))
    right = part(at + F.col("size"), at + F.col("size") + run)
    rows = rows.select(
        *_DOC, "place", "at", "key", "size", F.size("gram").alias("n"),
        *[F.transform(side, lambda one: F.struct(one["hash"].alias("hash"), one["words"].alias("words"))).alias(name)
          for name, side in (("left", F.reverse(left)), ("right", right))],
    )
    rows = rows.withColumn("least", F.min("key").over(by_words.rangeBetween(0, run - gram)))
    rows = rows.withColumn("most", F.max("least").over(by_words.rangeBetween(gram - run, 0)))
    # Selected: the least of some window, that is of the one with the greatest minimum around it.
    return rows.where("key is not null and most = key").drop("least", "most", "at")


def _reach(side: str) -> Column:
    """The words of the first 0, 1, 2, ... lines outwards."""
    return F.transform(
        F.sequence(F.lit(0), F.size(side)),
        lambda n: F.aggregate(F.slice(F.col(side), F.lit(1), n), F.lit(0).cast("bigint"), lambda sum_, one: sum_ + one["words"]),
    )


def _contexts(run: int) -> Column:
    """(lines to the left, lines to the right) of the runs around a gram: from each line that begins
    less than `run` words before it, and up to each that ends less than `run` words after it, the least
    number of lines that make `run` words together with the gram."""
    left, right = F.col("reach_left"), F.col("reach_right")

    def ended(own: Column, other: Column) -> Column:
        """For each number of lines on one side, the least number on the other; the size where all are too few."""
        near = F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda n: F.get(own, n) < run)
        return F.transform(near, lambda n: F.struct(
            n.alias("own"), F.size(F.filter(other, lambda words: words < run - F.col("size") - F.get(own, n))).alias("other")
        ))

    ahead = F.transform(ended(left, right), lambda one: F.struct(one["own"].alias("l"), one["other"].alias("r")))
    back = F.transform(ended(right, left), lambda one: F.struct(one["other"].alias("l"), one["own"].alias("r")))
    return F.array_distinct(F.filter(F.concat(ahead, back), lambda one: (one["l"] < F.size(left)) & (one["r"] < F.size(right))))


def _runs(grams: DataFrame, run: int) -> DataFrame:
    """(document, from, to, key, context) of the runs of `run` words around the grams."""
    rows = grams.withColumns({"reach_left": _reach("left"), "reach_right": _reach("right")})
    rows = rows.select(*_DOC, "place", "n", "key", "left", "right", F.explode(_contexts(run)).alias("one")).select("*", "one.*")

    def hashes(side: str, n: str) -> Column:
        return F.transform(F.slice(F.col(side), F.lit(1), F.col(n)), lambda line: line["hash"])

    return rows.select(
        *_DOC, (F.col("place") - F.col("l")).alias("from"), (F.col("place") + F.col("n") - 1 + F.col("r")).alias("to"),
        "key", F.xxhash64("l", "r", hashes("left", "l"), hashes("right", "r")).alias("context"),
    )


def repeated_lines(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM_WORDS, run: int = RUN_WORDS
) -> DataFrame:
    """(no_id, id, mark, gone): for each document that holds later copies, the places of their lines."""
    chosen = materialize(_selected(_lines(df, doc_id, text), gram, run), "grams")
    # Most grams occur once: only their hashes move.
    twice = chosen.groupBy("key").count().where("count > 1").select("key")
    runs = materialize(_runs(chosen.join(twice, "key", "left_semi"), run), "runs")
    place = F.struct(*_DOC, "from", "to")
    first = runs.groupBy("key", "context").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    later = runs.join(first.where("copies > 1"), ["key", "context"]).where(place != F.col("first"))
    # A copy that begins within the first one, in the same document, leaves that one's lines.
    inside = reduce(and_, [F.col(name) == F.col(f"first.{name}") for name in _DOC])
    start = F.when(inside, F.greatest(F.col("from"), F.col("first.to") + 1)).otherwise(F.col("from"))
    gone = later.withColumn("from", start).where(F.col("from") <= F.col("to"))
    gone = gone.select(*_DOC, F.explode(F.sequence("from", "to")).alias("place")).distinct()
    return gone.groupBy(*_DOC).agg(F.collect_list("place").alias("gone"))


def dedup_lines(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM_WORDS, run: int = RUN_WORDS,
    removed: str | None = None,
) -> DataFrame:
    """df with later copies of repeated runs of lines taken out of `text`; all rows and columns stay.

    `removed` names a column for the number of lines taken out. Texts move once, to be joined to
    their deletions: documents are merged by key at every size, as the deletions grow with the input.
    """
    gone = materialize(repeated_lines(df, doc_id, text, gram, run), "repeated-lines")
    names = [unused(df, f"_{name}") for name in (*_DOC, "gone")]
    if removed:
        df = df.select(*[f"`{name}`" for name in df.columns if name.lower() != removed.lower()])
    gone = gone.toDF(*names)
    match = F.lit(True)
    for key, name in zip(_keys(df, doc_id, text), names):
        match = match & (key == F.col(name))
    out = df.join(gone.hint("merge"), match, "left")
    places, body = F.col(names[-1]), F.col(f"`{text}`")
    # The lines are bound once, in an array of one, and then taken by place.
    kept = F.transform(
        F.array(F.split(body, "\n", -1)),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda place: F.get(lines, place)
            ), "\n",
        ),
    )
    out = out.withColumn(text, F.when(places.isNotNull(), F.get(kept, F.lit(0))).otherwise(body))
    if removed:
        out = out.withColumn(removed, F.coalesce(F.size(places), F.lit(0)).cast("bigint"))
    return out.drop(*names)
