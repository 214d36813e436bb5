"""I-Match document fingerprints, with column functions only.

The lexicon holds the terms whose inverse document frequency lies in a band: not in too many
documents, and in enough of them that there are at most LEXICON of them. Of a text, the distinct
lexicon terms are kept and sorted, and each of several random subsets of the lexicon gives one hash,
that of the kept terms in the subset. The subsets keep a quarter to a 256th of the lexicon, so that
some of them survive a small edit of a long text and some a large edit of a short one. Two
fingerprints are alike by the share of equal hashes among those that are filled in either.

Terms are the lower-cased runs of letters and digits. A text with fewer than FEW lexicon terms is too
poor in them (those of a large group of copies are too common, those of a small table too rare): its
places are empty, and it is compared by a second part of the fingerprint, the hashes of all terms of a
text in each subset. Two texts that both have their lexicon terms are compared by these alone. Places
without any term are empty, all of them in texts that have no term, as null and empty ones.
Documents follow each other by id, null last, then by a hash of their text; rows that repeat an id and
text are one document, and each gets its result. A single document follows itself. Ids may be of any
type that has an order; texts are taken whole, however long, and an empty table gives an empty result.
The result has the columns named there alone, so that no other can clash with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import filled
from touchline.operators.keys import dense_key
from touchline.sources.scratch import materialize

# The lexicon's size is bounded, whatever the input: one integer a term, sent to every task.
LEXICON = 1 << 18
# A term that more than this share of the documents has is too common.
MOST_SHARE = 0.05
# Lexicon terms that a text must have to be compared by them.
FEW = 4
_TERM_GAP = r"[^\p{L}\p{N}]+"
# Random subsets: how many of each, and the bits of a term's hash that must be 0 for it to be in one.
SUBSETS = ((4, 2), (6, 4), (8, 6), (4, 8))
_KEY = ["no_id", "id", "mark"]


def terms_of(text: Column) -> Column:
    """The hashes of the distinct terms of a text."""
    hashes = F.transform(F.split(F.lower(text), _TERM_GAP), lambda word: F.xxhash64(word))
    return F.array_remove(F.array_distinct(hashes), F.xxhash64(F.lit("")))  # what a leading gap leaves


def lexicon(df: DataFrame, text: str = "text", size: int = LEXICON, most_share: float = MOST_SHARE) -> DataFrame:
    """The terms of the band (term), at most `size` of them.

    Document frequencies are counted over all rows, combined before they move. The lower end of the
    band follows from the size: terms of frequency f or more number at most (sum of frequencies) / f.
    """
    seen = df.select(F.explode(terms_of(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("term"))
    counted = materialize(seen.groupBy("term").agg(F.count("*").alias("df")).where("df > 1"), "frequencies")
    total, n = counted.agg(F.sum("df")).first()[0] or 0, df.count()
    least = max(2, -(-total // size))
    return counted.where((F.col("df") >= least) & (F.col("df") <= most_share * n)).select("term")


def fingerprint(terms: Column) -> Column:
    """The hashes of the subsets over the sorted terms of a text, as an array; null where a subset has
    none of them."""
    words = F.struct(*[
        F.transform(terms, lambda term: F.struct(term.alias("term"), F.xxhash64(term, F.lit(word)).alias("bits"))).alias(f"w{word}")
        for word in sorted({word for word, _, _ in _fields()})  # the hashes whose bits say which subsets a term is in
    ])
    hashes = F.transform(F.array(words), lambda bound: F.array(*[_subset(bound[f"w{w}"], at, mask) for w, at, mask in _fields()]))
    return F.get(hashes, F.lit(0))


def _fields() -> list[tuple[int, int, int]]:
    """(hash word, shift, mask) of each subset; a word has 64 bits."""
    fields, word, at = [], 1, 0
    for count, bits in SUBSETS:
        for _ in range(count):
            if at + bits > 64:
                word, at = word + 1, 0
            fields.append((word, at, (1 << bits) - 1))
            at += bits
    return fields


def _subset(places: Column, shift: int, mask: int) -> Column:
    """The hash of the terms whose field of bits is 0."""
    inside = F.filter(places, lambda one: F.shiftrightunsigned(one["bits"], shift).bitwiseAND(F.lit(mask).cast("bigint")) == 0)
    terms = F.transform(inside, lambda one: one["term"])
    return F.get(F.transform(F.array(terms), lambda own: F.when(F.size(own) > 0, F.xxhash64(own))), F.lit(0))


def places(hashes: Column) -> Column:
    """The upper 32 bits of each hash, as it is kept and compared; null where a subset is empty."""
    return F.transform(hashes, lambda one: F.shiftright(one, 32).cast("int"))


def as_text(banded: Column, every: Column) -> Column:
    """Both parts of a fingerprint: eight hex digits a subset, '-' where it is empty, joined by dots."""
    def part(own: Column) -> Column:
        low = F.lit(0xFFFFFFFF).cast("bigint")
        return F.array_join(F.transform(own, lambda one: F.coalesce(
            F.lower(F.lpad(F.hex(one.cast("bigint").bitwiseAND(low)), 8, "0")), F.lit("-")
        )), ".")

    return F.concat(part(banded), F.lit("/"), part(every))


def _share(one: Column, other: Column) -> Column:
    """The share of equal places among those filled in either of two parts, 0 to 1."""
    pairs = F.filter(F.arrays_zip(one.alias("a"), other.alias("b")), lambda pair: pair["a"].isNotNull() | pair["b"].isNotNull())
    same = F.size(F.filter(pairs, lambda pair: pair["a"] == pair["b"]))
    return F.when(F.size(pairs) == 0, F.lit(0.0)).otherwise(same / F.size(pairs))


def likeness(one: tuple[Column, Column], other: tuple[Column, Column]) -> Column:
    """How much alike two fingerprints (lexicon terms, all terms) are, 0 to 1: by their lexicon terms, or
    by all terms if one of them has too few of those."""
    poor = (F.size(F.array_compact(one[0])) == 0) | (F.size(F.array_compact(other[0])) == 0)
    equal = (one[0] == other[0]) & (one[1] == other[1])
    return F.when(equal, F.lit(1.0)).when(poor, _share(one[1], other[1])).otherwise(_share(one[0], other[0]))


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    id_, body = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(
        id_.isNull().alias("no_id"), filled(df, doc_id).alias("id"), F.xxhash64(body).alias("mark"), body.alias("body")
    )


def edit_likeness(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = LEXICON) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how they and the next one's compare.

    The edited text has its second half replaced by as much of the next document's beginning.
    Texts move once, to their key; from there only the borrowed beginnings move on.
    """
    known = lexicon(df, text, size)
    docs = _keyed(df, doc_id, text)
    # Only keys and lengths are put in order; the documents get their neighbours by join.
    short = docs.select(*_KEY, F.length("body").alias("n")).distinct()
    numbered = dense_key(short, _KEY, "no")  # read from a written table
    count = numbered.count()
    here = numbered.select(*_KEY, "no", "n")
    before = numbered.select(  # each document as the one before its next
        F.when(F.col("no") == count, 1).otherwise(F.col("no") + 1).alias("no"),
        *[F.col(name).alias(f"to_{name}") for name in _KEY], F.floor(F.col("n") / 2).cast("int").alias("borrowed"),
    )
    placed = docs.join(here.join(before, "no"), _KEY)
    lent = placed.select(
        *[F.col(f"to_{name}").alias(name) for name in _KEY], F.expr("substring(body, 1, borrowed)").alias("lent")
    )
    own = placed.select(*_KEY, "no", "n", "body")
    keep = F.expr("substring(body, 1, n - cast(floor(n / 2) as int))")
    both = own.join(lent, _KEY).withColumn("edited", F.concat(keep, "lent"))
    terms = both.select(
        *_KEY, "no", "n", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("sha"),
        terms_of(F.col("body")).alias("t0"), terms_of(F.col("edited")).alias("t1"),
    )

    def tagged(which: int) -> Column:
        # The one without a term keeps a text without terms in the table, and carries the hashes of all.
        none = F.lit(None).cast("array<bigint>")
        found = F.transform(
            F.col(f"t{which}"), lambda term: F.struct(F.lit(which).alias("which"), term.alias("term"), none.alias("all"))
        )
        every = F.struct(
            F.lit(which).alias("which"), F.lit(None).cast("bigint").alias("term"),
            fingerprint(F.sort_array(F.col(f"t{which}"))).alias("all"),
        )
        return F.concat(found, F.array(every))

    # The rows of a document are together since the join of the texts: its terms need no shuffle,
    # neither to meet the lexicon (at most `size` integers, sent to all) nor to be put together again.
    # The hashes of all terms come before the explode, or they would be taken anew for every term.
    pairs = terms.select(*_KEY, "no", "n", "sha", F.explode(F.concat(tagged(0), tagged(1))).alias("one"))
    pairs = pairs.select(*_KEY, "no", "n", "sha", "one.*")
    banded = pairs.join(F.broadcast(known.withColumn("known", F.lit(True))), "term", "left").where("known or term is null")

    def kept(which: int) -> Column:
        return F.sort_array(F.collect_set(F.when((F.col("which") == which) & F.col("known"), F.col("term")))).alias(f"k{which}")

    def whole(which: int) -> Column:
        return F.first(F.when(F.col("which") == which, F.col("all")), ignorenulls=True).alias(f"all{which}")

    def printed(which: int) -> list[Column]:
        own = F.when(F.size(f"k{which}") >= FEW, F.col(f"k{which}")).otherwise(F.array().cast("array<bigint>"))
        return [places(fingerprint(own)).alias(f"banded{which}"), places(F.col(f"all{which}")).alias(f"every{which}")]

    # Rows that repeat an id and text become one here.
    marked = banded.groupBy(*_KEY).agg(
        *[F.first(name).alias(name) for name in ("no", "n", "sha")], whole(0), whole(1), kept(0), kept(1)
    )
    marked = materialize(marked.select(
        *_KEY, "no", "n", "sha", *printed(0), *printed(1),
    ), "fingerprints")
    following = marked.select(
        F.when(F.col("no") == 1, count).otherwise(F.col("no") - 1).alias("no"), F.col("banded0").alias("banded2"),
        F.col("every0").alias("every2"),
    )
    own, new, after = [(F.col(f"banded{which}"), F.col(f"every{which}")) for which in range(3)]
    result = marked.join(following, "no").select(
        *_KEY, F.col("n").cast("bigint").alias("n_chars"), "sha", *own, *new,
        likeness(own, new).alias("near_edited"), likeness(own, after).alias("near_next"),
    )
    rows = docs.select(*_KEY)
    out = rows.join(result, _KEY)
    id_ = F.when(~F.col("no_id"), F.col("id")).alias(doc_id)
    return out.select(
        id_, "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), as_text(*own).alias("fingerprint"),
        as_text(*new).alias("edited_fingerprint"), "near_edited", "near_next",
    )
