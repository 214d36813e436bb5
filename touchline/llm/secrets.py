"""Secret scans with column functions only: fixed patterns, and sliding-window entropy.

Base kinds are found by pattern. Beyond them, every candidate string (a run of characters of keys
and encodings) is read through a sliding window: the counts of its characters change by the one that
comes in and the one that goes out, and so does the sum that gives the window's Shannon entropy. A
window is hot from a threshold on that depends on the candidate's character class. Each part between
joints is read in the same way by its own class, so that a name or path before a key does not hide it:
those in hex always, others where no window of the whole is hot.
The span from the first hot window to the last is a finding unless the candidate is on the allow-list or the span lies
inside a base finding. A word of the allow-list in one part does not hide a key in another.

Null and empty texts have no findings, an empty table none at all. Rows neither move nor change in
number; repeated rows have equal results, and a column that has the name of the result is replaced. The
cost is in proportion to the text and its matches, however long it is. Offsets count code points, the
end is exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import unused


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that must have `least` characters, and which group that is."""

    name: str
    pattern: str
    group: int
    least: int


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# Fixed patterns of the base kinds.
BASE = (
    Kind(
        "assign",
        "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
        + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Kind("access", "AKIA[A-Z0-9]+", 0, 20),
    # Only whole runs are matched, so that one of 24 or more is found at its first character.
    Kind("hex", "(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
ENTROPY = "entropy"
WINDOW = 20
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
JOINT, PART = "[+/_=-]", "[A-Za-z0-9]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
HEX = "^([0-9a-f]+|[0-9A-F]+)$"
# Character classes, narrowest first, with the entropy (bits a character) from which a window is hot.
CLASSES = (
    ("^[0-9]+$", None),  # plain numbers are no secrets
    (HEX, 3.0),
    ("^[A-Za-z]+$", 4.1),
    ("^[A-Za-z0-9]+$", 3.5),
    ("^.*$", 3.8),
)
# Candidates that look random but are not: as a whole identifiers and words with joints; alphabets and
# placeholders wherever they stand, in a whole candidate or in a part between joints, which they allow.
ALLOW_WHOLE = (
    "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    "^[-+/_=]*([A-Za-z]+[-+/_=]+)+[A-Za-z]*$",
)
ALLOW_WORDS = (
    "(?i)abcdefghij|0123456789|qwertyuiop",
    "(?i)example|placeholder|changeme|dummy|redacted",
)
# Values that are folded together at a time.
PART_OF = 256
MASK = "[secret]"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value taken once however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of integers, the fold (from 0) of all before it.

    An array that grows by one at each step is copied each time; so the values are folded in parts of
    PART_OF, then the parts: the cost stays in proportion to the values.
    """
    zero = F.lit(0)

    def running(own: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(own, begin, lambda state, value: F.struct(
            fold(state["at"], value).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out")
        ))["out"]

    def cut(all_: Column) -> Column:
        places = F.sequence(zero, F.floor((F.size(all_) - 1) / PART_OF).cast("int"))
        return F.transform(places, lambda place: F.slice(all_, place * PART_OF + 1, F.lit(PART_OF)))

    def joined(parts: Column) -> Column:
        starts = running(F.transform(parts, lambda part: F.aggregate(part, zero, fold)), zero)
        return F.flatten(F.zip_with(parts, starts, running))

    return _bound(values, lambda all_: F.when(F.size(all_) > 0, _bound(cut(all_), joined)).otherwise(
        F.array().cast("array<int>")
    ))


def _located(text: Column, pattern: str) -> Column:
    """All leftmost matches as an array of (start, stop, hit). Texts without a match cost one search."""
    hits, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    sizes = F.zip_with(
        F.slice(parts, 1, F.size(hits)), hits,
        lambda part, hit: F.struct(F.length(part).alias("gap"), F.length(hit).alias("size"), hit.alias("hit")),
    )
    none = F.array().cast("array<struct<start:int,stop:int,hit:string>>")

    def placed(all_: Column) -> Column:
        starts = _before(F.transform(all_, lambda one: one["gap"] + one["size"]), lambda at, step: at + step)
        return F.zip_with(all_, starts, lambda one, at: F.struct(
            (at + one["gap"]).alias("start"), (at + one["gap"] + one["size"]).alias("stop"), one["hit"].alias("hit")
        ))

    return F.when(text.rlike(pattern), _bound(sizes, placed)).otherwise(none)


def _is_finding(kind: Kind, hit: Column) -> Column:
    part = F.regexp_extract(hit, kind.pattern, kind.group) if kind.group else hit
    return F.length(part) >= kind.least


def _threshold(candidate: Column) -> Column:
    found = F.lit(None).cast("double")
    for pattern, least in reversed(CLASSES):
        found = F.when(candidate.rlike(pattern), F.lit(least).cast("double")).otherwise(found)
    return found


def hot_range(candidate: Column, threshold: Column) -> Column:
    """(start, stop) from the first hot window to the last within a candidate; nulls if none is hot.

    One pass: the state is the count of each character in the window and the sum of c * log2(c)
    over them, both changed by one character in and one out.
    """
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    slots = F.transform(
        F.filter(F.split(candidate, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1
    )
    begin = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"),
        F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("stop"),
        slots.alias("slots"),
    )

    def step(state: Column, at: Column) -> Column:
        counts, slots_ = state["counts"], state["slots"]
        came = F.get(slots_, at)
        went = F.when(at >= WINDOW, F.get(slots_, at - WINDOW)).otherwise(F.lit(-1))
        more = F.get(counts, came)
        held = F.get(counts, went) + F.when(went == came, 1).otherwise(0)  # with the one that came
        grown = state["sum"] + F.get(terms, more + 1) - F.get(terms, more)
        sum_ = grown + F.when(went >= 0, F.get(terms, held - 1) - F.get(terms, held)).otherwise(0.0)
        new = F.transform(
            counts,
            lambda c, slot: (c + F.when(slot == came, 1).otherwise(0) - F.when(slot == went, 1).otherwise(0)).cast("int"),
        )
        entropy = F.lit(math.log2(WINDOW)) - sum_ / WINDOW
        hot = (at >= WINDOW - 1) & (entropy >= threshold - 1e-9)
        return F.struct(
            new.alias("counts"), sum_.alias("sum"),
            F.when(hot, F.coalesce(state["start"], (at - (WINDOW - 1)).cast("int"))).otherwise(state["start"]).alias("start"),
            F.when(hot, (at + 1).cast("int")).otherwise(state["stop"]).alias("stop"),
            slots_.alias("slots"),
        )

    places = F.sequence(F.lit(0), F.length(candidate) - 1)
    return F.aggregate(
        places, begin, step, lambda state: F.struct(state["start"].alias("start"), state["stop"].alias("stop"))
    )


def _allowed(string: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | string.rlike(pattern)
    return found


def _suspicious(candidate: Column) -> Column:
    """The hot range of a candidate that is not allowed; nulls otherwise."""
    none = F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("stop"))

    def hot(string: Column) -> Column:
        threshold = _threshold(string)
        judged = threshold.isNotNull() & ~_allowed(string, ALLOW_WORDS)
        return F.when(judged, hot_range(string, threshold)).otherwise(none)

    def moved(part: Column) -> Column:
        return F.transform(F.array(hot(part["hit"])), lambda own: F.struct(
            (part["start"] + own["start"]).alias("start"), (part["start"] + own["stop"]).alias("stop"),
            part["hit"].rlike(HEX).alias("hex"),
        ))

    parts = F.flatten(F.transform(_located(candidate, PART), moved))
    parts = F.when(candidate.rlike(JOINT), parts).otherwise(F.array().cast("array<struct<start:int,stop:int,hex:boolean>>"))

    def joined(whole: Column) -> Column:
        counted = F.filter(parts, lambda part: part["hex"] | whole["start"].isNull())
        return F.concat(F.array(whole), F.transform(counted, lambda part: F.struct(part["start"], part["stop"])))

    ranges = _bound(hot(candidate), joined)
    spanned = _bound(ranges, lambda all_: F.struct(
        F.array_min(F.transform(all_, lambda one: one["start"])).alias("start"),
        F.array_max(F.transform(all_, lambda one: one["stop"])).alias("stop"),
    ))
    return F.when(~_allowed(candidate, ALLOW_WHOLE), spanned).otherwise(none)


def _found(whole: Column) -> Column:
    """All findings as an array of (start, rank, stop, kind, first, last), by start, then kind; first to
    last is what is to be masked: the span, or the candidate that a hot range lies in.

    What lies inside a base finding is known by the greatest end of those that start no later.
    """
    def of_kind(rank: int, kind: Kind) -> Column:
        found = F.filter(_located(whole, kind.pattern), lambda span: _is_finding(kind, span["hit"]))
        return F.transform(found, lambda span: F.struct(
            span["start"].alias("start"), F.lit(rank).alias("rank"), span["stop"].alias("stop"),
            F.lit(kind.name).alias("kind"), span["start"].alias("first"), span["stop"].alias("last"),
        ))

    def moved(span: Column) -> Column:
        return _bound(_suspicious(span["hit"]), lambda hot: F.struct(
            (span["start"] + hot["start"]).alias("start"), F.lit(len(BASE)).alias("rank"),
            (span["start"] + hot["stop"]).alias("stop"), F.lit(ENTROPY).alias("kind"),
            span["start"].alias("first"), span["stop"].alias("last"),
        ))

    random = F.filter(F.transform(_located(whole, CANDIDATE), moved), lambda span: span["start"].isNotNull())
    by_kind = [of_kind(rank, kind) for rank, kind in enumerate(BASE)]

    def new(all_: Column) -> Column:
        ends = _before(
            F.transform(all_, lambda one: F.when(one["rank"] < len(BASE), one["stop"]).otherwise(0)),
            lambda most, stop: F.greatest(most, stop),
        )
        kept = F.filter(
            F.zip_with(all_, ends, lambda one, end: F.struct(one.alias("one"), ((one["rank"] < len(BASE)) | (end < one["stop"])).alias("new"))),
            lambda pair: pair["new"],
        )
        return F.transform(kept, lambda pair: pair["one"])

    return _bound(F.sort_array(F.concat(*by_kind, random)), new)


def scan(df: DataFrame, text: str = "text", findings: str = "findings") -> DataFrame:
    """Add `findings`, an array of (start, rank, stop, kind) by start, then kind in the order given.

    `rank` is the place of the kind: the base kinds in their order, then entropy.
    """
    df = df.select(*[f"`{name}`" for name in df.columns if name.lower() != findings.lower()])
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return df.withColumn(findings, F.transform(_found(whole), lambda one: F.struct(*[
        one[name].alias(name) for name in ("start", "rank", "stop", "kind")
    ])))


def as_text(findings: Column) -> Column:
    """kind:start:stop of each finding, joined by commas."""
    return F.array_join(
        F.transform(findings, lambda one: F.concat_ws(":", one["kind"], one["start"].cast("string"), one["stop"].cast("string"))),
        ",",
    )


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with its spans (first, last), by first, replaced: those that overlap by one mask.

    Characters have four bytes each while they are cut out, so that a place is found without reading all
    before it. Each cut-out is read behind a byte order mark, which goes, so that its own would stay.
    """
    mark = b"\x00\x00\xfe\xff"

    def cut(raw: Column) -> Column:
        def part(start: Column, stop: Column) -> Column:
            size = F.greatest(stop - start, F.lit(0))
            return F.decode(F.concat(F.lit(mark), F.substring(raw, start * 4 + 1, size * 4)), "UTF-32")

        def pieces(all_: Column) -> Column:
            ends = _before(F.transform(all_, lambda one: one["last"]), lambda most, last: F.greatest(most, last))

            def piece(one: Column, end: Column) -> Column:
                # A span that begins inside those before it goes on with their mask.
                return F.when(one["first"] < end, F.lit("")).otherwise(F.concat(part(end, one["first"]), F.lit(mask)))

            rest = part(F.array_max(F.transform(all_, lambda one: one["last"])), (F.octet_length(raw) / 4).cast("int"))
            return F.concat(F.array_join(F.zip_with(all_, ends, piece), ""), rest)

        return _bound(spans, pieces)

    return _bound(F.encode(text, "UTF-32"), cut)


def redact(df: DataFrame, text: str = "text", mask: str = MASK) -> DataFrame:
    """Replace all findings of scan() in the texts by `mask`, overlapping ones by one; all other text stays.

    Where a candidate holds a hot range, the whole candidate goes. What is left is searched once more
    for candidates, as a finding can have kept one on the allow-list. Bytes that are no UTF-8 become
    U+FFFD in a text that holds a secret; null stays null.
    """
    found = unused(df, "_found")
    column = F.col(f"`{text}`")
    df = df.withColumn(found, _found(F.make_valid_utf8(F.coalesce(column.cast("string"), F.lit("")))))
    masked = _masked(F.make_valid_utf8(column), F.sort_array(F.transform(
        F.col(found), lambda one: F.struct(one["first"].alias("first"), one["last"].alias("last"))
    )), mask)
    df = df.withColumn(text, F.when(F.size(found) > 0, masked).otherwise(column)).drop(found)

    hits, parts = F.regexp_extract_all(column, F.lit(CANDIDATE), F.lit(0)), F.split(column, CANDIDATE, -1)
    pieces = F.zip_with(parts, hits, lambda part, hit: F.concat(
        part, F.coalesce(F.when(_suspicious(hit)["start"].isNotNull(), F.lit(mask)).otherwise(hit), F.lit(""))
    ))
    return df.withColumn(text, F.when(column.rlike(CANDIDATE), F.array_join(pieces, "")).otherwise(column))
