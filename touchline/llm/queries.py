"""The registered queries of the text operators: each applies one, with its production parameters, to a
whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    bpe, counts, imatch, langid, linededup, packing, quality, secrets, simhash, spelling, toxicity, trie, warc,
)
from touchline.sources.scratch import scratch_folder

# Vocabulary files of public tokenizers, by name in their folder.
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
PLAIN_TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
CAPACITY = 2048
END_ID = 1
SHINGLE, RADIUS = 3, 3
TOXIC_FROM = 0.3
# Of every SPOIL words one, by hash, loses a letter; conversations begin with turns of another one.
SPOIL = 199
CONVERSATIONS, START_TURNS = 5, 9


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; digests of both."""
    ranks = public_tokenizers.path(MULTI_RANKS)
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    decoded = bpe.decode(encoded, ranks)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the documents that are not held out, predict all."""
    docs = _documents(spark, sf_dir)
    model = langid.train(docs.where(~langid.held_out("doc_id")))
    named = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return named.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, posterior quality and verdict of every document."""
    judged = quality.judge(_documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])
    measures = [name for name in quality.MEASURES if name != "n_words"]
    return judged.select("doc_id", "n_words", *measures, "base_failed", "kept", "quality")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts through a cache that starts empty, as each run of the query has its own."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    counted = counts.count_tokens(
        sized, public_tokenizers.path(PLAIN_TOKENIZER), public_tokenizers.PATTERN, scratch_folder(spark, "token-counts")
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings of every document, by kind and as text."""
    found = secrets.scan(_documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "findings")

    def of(kind: str):
        return F.size(F.filter("findings", lambda one: one["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("findings", lambda one: one["kind"] != secrets.ENTROPY)
    return found.select(
        "doc_id", *[of(kind.name) for kind in secrets.BASE],
        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("findings")).alias("spans"),
    )


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return imatch.edit_likeness(_documents(spark, sf_dir))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to archives and read them back."""
    folder = scratch_folder(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    warc.write_warc(pages, folder, "page_id", "url", "html", least_bytes=0)
    records = warc.read_warc(spark, folder)
    # What a response says of its payload is read off the payload; a revisit has none.
    revisit = F.col("record_type") == "revisit"
    return records.select(
        F.expr("try_cast(record_id as bigint)").alias("page_id"),
        F.when(revisit, F.col("header_length")).otherwise(F.col("n_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("header_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", F.expr("try_cast(refers_to as bigint)").alias("refers_to"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = simhash.near_duplicates(docs, SHINGLE, RADIUS, keep=["doc_id"])
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(
        _documents(spark, sf_dir), public_tokenizers.path(PLAIN_TOKENIZER), public_tokenizers.PATTERN, END_ID, CAPACITY
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated runs of lines."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return linededup.dedup_lines(docs, removed="n_removed").select("doc_id", "text", "n_removed")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the labels of documents that are not held out, score all."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels.where(~langid.held_out("doc_id")))
    scored = toxicity.predict(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie over all rebuilt conversations."""
    found = trie.turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    rebuilt = trie.sequences(found, trie.shared_starts(CONVERSATIONS, START_TURNS), CONVERSATIONS, START_TURNS)
    return trie.prefix_nodes(rebuilt)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling.group_variants(spelling.count_words(_documents(spark, sf_dir), spoil=SPOIL))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_byte_bpe, op2_language_id, op3_quality, op4_token_counts, op5_secrets, op6_imatch, op7_warc, op8_simhash,
        op9_packing, op10_line_dedup, op11_toxicity, op12_prefix_trie, op13_spelling,
    )
}

# Base 32 of a SHA-1: its 160 bits as text, five at a time.
_NIBBLE = "lpad(bin(('0x' || substr(sha1(body), i + 1, 1))::INT), 4, '0')"
_BITS = f"array_to_string(list_transform(range(0, 40), lambda i: {_NIBBLE}), '')"
_DIGIT = """substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
    + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)"""

def _crc32(values: str) -> str:
    """The CRC-32 of a list of bytes."""
    byte = "list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b))"
    return f"xor(list_reduce({values}, lambda c, b: {byte}, 4294967295::BIGINT), 4294967295)"


ORACLE_SQL: dict[str, str] = {
    "op12_prefix_trie": f"""
        WITH turns AS (
            SELECT conv_id, md5(coalesce(role, '') || ' ' || coalesce(text, '')) AS turn,
                   strlen(coalesce(text, '')) AS size,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (
            SELECT DISTINCT conv_id, list_transform(range(1, len(conv_id::VARCHAR) + 1),
                   lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT) AS digits FROM turns),
        starts AS (SELECT conv_id, {_crc32("digits")} % {START_TURNS} AS h FROM ids),
        rebuilt AS (
            SELECT s.conv_id, t.place, t.turn, t.size FROM starts s JOIN turns t
              ON t.conv_id = s.conv_id - s.conv_id % {CONVERSATIONS} AND t.place < s.h
            UNION ALL
            SELECT s.conv_id, t.place, t.turn, t.size FROM starts s JOIN turns t
              ON t.conv_id = s.conv_id AND t.place >= s.h),
        paths AS (
            SELECT s.conv_id, coalesce(list(r.turn ORDER BY r.place) FILTER (r.turn IS NOT NULL), []) AS path,
                   coalesce(list(r.size ORDER BY r.place) FILTER (r.turn IS NOT NULL), []) AS sizes
            FROM starts s LEFT JOIN rebuilt r ON r.conv_id = s.conv_id GROUP BY s.conv_id),
        steps AS (
            SELECT conv_id, unnest(range(0, len(path) + 1)) AS depth, path, sizes FROM paths),
        nodes AS (
            SELECT array_to_string(path[1:depth], ' ') AS node, depth, min(conv_id) AS conv_id, count(*) AS n,
                   any_value(CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END) AS size,
                   any_value(path[1:depth]) AS path,
                   string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth) AS ends
            FROM steps GROUP BY ALL),
        links AS (
            SELECT *, array_to_string(path[1:depth - 1], ' ') AS above FROM nodes WHERE depth > 0),
        children AS (SELECT above, depth - 1 AS depth, count(*) AS n_children FROM links GROUP BY ALL),
        own AS (
            SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n
            LEFT JOIN children c ON c.above = n.node AND c.depth = n.depth),
        spread AS (
            SELECT path, unnest(range(0, depth + 1)) AS depth, (n_children = 0)::INT AS leaf, (n - 1) * size AS saved
            FROM own),
        sums AS (
            SELECT array_to_string(path[1:depth], ' ') AS node, depth, sum(leaf) AS leaves, sum(saved) AS saved
            FROM spread GROUP BY ALL)
        SELECT o.conv_id::BIGINT AS conv_id, o.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id,
               o.n::BIGINT AS n_convs, o.n_children::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves,
               s.saved::BIGINT AS saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
        FROM own o JOIN sums s ON s.node = o.node AND s.depth = o.depth
        LEFT JOIN links l ON l.node = o.node AND l.depth = o.depth
        LEFT JOIN nodes p ON p.node = l.above AND p.depth = l.depth - 1""",
    "op13_spelling": f"""
        WITH RECURSIVE runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') || ':' AS doc, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
            FROM documents),
        low AS (
            SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM runs GROUP BY ALL),
        codes AS (
            SELECT *, list_transform(range(1, len(doc || run) + 1), lambda i: unicode(substr(doc || run, i, 1))) AS code
            FROM low WHERE len(run) >= {spelling.LEAST_LETTERS}),
        hashed AS (
            SELECT run, n, {_crc32("flatten(list_transform(code, lambda c: CASE WHEN c < 128 THEN [c::BIGINT] ELSE [(192 + (c >> 6))::BIGINT, (128 + (c & 63))::BIGINT] END))")} AS h
            FROM codes),
        spoilt AS (
            SELECT CASE WHEN h % {SPOIL} = 0 THEN substr(run, 1, (h % len(run))::INT) || substr(run, (h % len(run))::INT + 2)
                   ELSE run END AS word, n FROM hashed),
        words AS (
            SELECT word, sum(n)::BIGINT AS n FROM spoilt WHERE len(word) >= {spelling.LEAST_LETTERS}
            GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
        places AS (SELECT word, n, unnest(range(0, len(word))) AS i FROM words),
        masked AS (
            SELECT word, n, substr(word, 1, i) || '*' || substr(word, i + 2) AS mask,
                   substr(word, 1, i) || substr(word, i + 2) AS less FROM places),
        shorter AS (SELECT DISTINCT m.word AS a, m.n AS n_a, w.word AS b, w.n AS n_b FROM masked m JOIN words w ON w.word = m.less),
        near AS (
            SELECT l.word, r.word AS near, r.n FROM masked l JOIN masked r ON l.mask = r.mask AND l.word <> r.word
            UNION ALL SELECT a, b, n_b FROM shorter UNION ALL SELECT b, a, n_a FROM shorter),
        ranked AS (
            SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
                   row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS rank FROM near),
        forms AS (
            SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near,
                   CASE WHEN r.n >= {spelling.RATIO} * w.n THEN r.near END AS form,
                   CASE WHEN r.n >= {spelling.RATIO} * w.n THEN r.n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.rank = 1),
        follow AS (
            SELECT word, word AS root FROM forms
            UNION ALL SELECT f.word, o.form FROM follow f JOIN forms o ON o.word = f.root WHERE o.form IS NOT NULL)
        SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM forms f
        JOIN follow t ON t.word = f.word JOIN forms e ON e.word = t.root WHERE e.form IS NULL""",
    "op7_warc": f"""
        WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        digests AS (
            SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_BITS} AS bits,
                   min(page_id) OVER (PARTITION BY body) AS first_id
            FROM bodies)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: {_DIGIT}), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM digests""",
}
