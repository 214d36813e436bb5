"""SimHash components and WARC archives."""

import base64
import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from touchline.llm import simhash, warc
from touchline.sources.scratch import scratch_folder


def brute_fingerprint(text, shingle=3):
    words = [word for word in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if word]
    if not words:
        return 0
    grams = [" ".join(words[at:at + shingle]) for at in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """Least id reachable, over all pairs; prints: id -> fingerprint."""
    ids = sorted(prints)
    root = {doc: doc for doc in ids}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    for at, a in enumerate(ids):
        for b in ids[at + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {doc: find(doc) for doc in ids}


def as_long(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints_equal_brute_force(documents, awkward):
    for df in (documents.limit(80), awkward):
        for row in simhash.fingerprints(df, 3, keep=["doc_id", "text"]).collect():
            assert row.fingerprint % (1 << 64) == brute_fingerprint(row.text)
            assert simhash.fingerprint_of((row.text or "").encode(), 3) == brute_fingerprint(row.text)


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_links_connect_what_brute_force_connects(spark, radius, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)  # several chunks to a tile
    rnd = random.Random(radius)
    seeds = [rnd.getrandbits(64) for _ in range(25)] + [0, (1 << 64) - 1]
    prints = set(seeds)
    for _ in range(500):  # clusters, and chains that lead away from them
        value = rnd.choice(sorted(prints)) if rnd.random() < 0.3 else rnd.choice(seeds)
        for _ in range(rnd.randint(1, 4)):
            value ^= 1 << rnd.randrange(64)
        prints.add(value)
    prints = dict(enumerate(sorted(prints)))
    distinct = spark.createDataFrame([(as_long(value),) for value in prints.values()], "fingerprint BIGINT")
    edges = simhash.links(distinct, radius)
    for row in edges.collect():
        assert ((row.a ^ row.b) % (1 << 64)).bit_count() <= radius
    found = {row.node: row.root for row in simhash.components(edges).collect()}
    wanted = brute_components(prints, radius)
    groups, theirs = {}, {}
    for doc, value in prints.items():
        groups.setdefault(found.get(as_long(value), as_long(value)), set()).add(doc)
        theirs.setdefault(wanted[doc], set()).add(doc)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, theirs.values()))


def test_edges_are_no_more_than_what_is_read(spark):
    # A dense cluster: all pairs link, but a forest is enough.
    prints = [as_long(sum(1 << bit for bit in bits)) for bits in
              {frozenset(random.Random(at).sample(range(64), 1)) for at in range(2000)}]
    distinct = spark.createDataFrame([(value,) for value in prints], "fingerprint BIGINT")
    assert simhash.links(distinct, 3).count() <= 200 * len(prints) / 2
    assert len({row.root for row in simhash.components(simhash.links(distinct, 3)).collect()}) == 1


def test_long_chains_have_one_root(spark):
    n = 300
    edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = {row.node: row.root for row in simhash.components(edges.orderBy(F.rand(3))).collect()}
    assert found == dict.fromkeys(range(n), 0)
    assert simhash.components(edges.limit(0)).collect() == []


def test_components_of_documents(documents):
    rows = simhash.near_duplicates(documents, keep=["doc_id"]).collect()
    prints = {row.doc_id: brute_fingerprint(row.text) for row in documents.collect()}
    assert {row.doc_id: row.component_id for row in rows} == brute_components(prints, 3)


def test_near_duplicates_of_awkward_rows(awkward, none):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {row.doc_id: row.component_id for row in rows}
    assert by_id[2] == by_id[3] == by_id[4] == 2  # empty texts have fingerprint 0 and link
    assert by_id[6] == by_id[7] == 6 and by_id[None] is None
    assert simhash.near_duplicates(none).collect() == [] and simhash.first_of_each(none).collect() == []
    kept = simhash.first_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted((row.doc_id or -1) for row in kept.collect()) == [-1, 1, 2, 5, 6, 8, 9]


# --- WARC ---------------------------------------------------------------------------------

FAKE = (
    "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:999>\r\nContent-Length: 5\r\n\r\nabcde"
    "\r\n\r\nWARC/1.0\r\nno header\r\n\r\nWARC/1.1\r\nWARC-Record-ID: <urn:record:998>\r\nContent-Length: 100000\r\n\r\nzz"
)


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def pages(spark, n=120):
    bodies = {0: "", 1: FAKE, 2: FAKE * 30, 3: None, 4: "é" * 300, 5: "same", 6: "same"}
    rows = []
    for at in range(n):
        body = bodies.get(at % 9, f"<p>{at}</p>" * (at % 50))
        rows.append((at, f"http://a/{at}\r\nx", body if at % 9 in (3, 5, 6) or at % 4 else f"{body}{at}"))
    return rows, spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").coalesce(1)


@pytest.mark.parametrize("split", ["128m", "5000b", "600b"])
def test_archives_are_read_back_whole(spark, split):
    rows, df = pages(spark, 120 if split != "600b" else 50)
    folder = scratch_folder(spark, "warc-test")
    warc.write_warc(df, folder, "page_id", "url", "html")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = warc.read_warc(spark, folder, payload=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(found) == len(rows)
    by_id, first = {int(row.record_id): row for row in found}, {}
    for page, _, body in rows:
        first.setdefault(body or "", page)
    for page, _, body in rows:
        row, raw = by_id[page], (body or "").encode()
        assert (row.header_digest, row.header_length) == (b32(raw), len(raw))
        if first[body or ""] == page:
            assert row.record_type == "response" and row.refers_to == ""
            assert (bytes(row.payload), row.digest, row.n_bytes) == (raw, b32(raw), len(raw))
        else:
            assert (row.record_type, row.refers_to, row.n_bytes) == ("revisit", str(first[body or ""]), 0)


@pytest.mark.parametrize("split, n", [("128m", 200_000), ("300k", 60_000), ("700b", 60)])
def test_no_record_is_lost_whatever_payloads_end_in(spark, split, n):
    """Payloads that end in parts of the separator, at all lengths: a reader's buffer ends within some."""
    ends = F.array(*[F.lit(end) for end in ("\r\n", "\r\n\r\n", "\r", "\n\r\n", "\r\n\r\nWARC/1.", "WARC/1", "")])
    body = F.concat(F.repeat(F.lit("x"), (F.col("id") % 61).cast("int")), F.col("id").cast("string"), F.get(ends, (F.col("id") % 7).cast("int")))
    df = spark.range(n).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), body.alias("html")).coalesce(1)
    folder = scratch_folder(spark, "warc-test")
    warc.write_warc(df, folder, "page_id", "url", "html")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = warc.read_warc(spark, folder)
        want = df.select(F.col("page_id").cast("string").alias("record_id"), warc.base32_sha1(F.col("html").cast("binary")).alias("digest"))
        got = found.select("record_id", "digest")
        assert got.count() == n and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_broken_archive_is_no_short_one(spark, tmp_path):
    """A file cut short, one with a wrong length, one that does not begin with a record."""
    def record(text, length=None):
        return f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {len(text) if length is None else length}\r\n\r\n{text}\r\n\r\n"

    sound = record("one") + record("two\r\n")
    (tmp_path / "sound").mkdir()
    (tmp_path / "sound" / "a.warc").write_bytes(sound.encode())
    assert warc.read_warc(spark, str(tmp_path / "sound")).count() == 2
    for name, text, whole in (
        ("cut", sound[:-6], 1), ("short", record("one") + record("three", 2) + record("x"), 2), ("head", "x" + sound, 0),
    ):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.warc").write_bytes(text.encode())
        with pytest.raises(warc.BrokenArchive):
            warc.read_warc(spark, str(folder))
        assert warc.read_warc(spark, str(folder), broken="skip").count() == whole


def test_small_payloads_may_all_be_responses(spark):
    df = spark.createDataFrame([(1, "tiny"), (2, "tiny"), (3, "a larger body"), (4, "a larger body")], "page_id INT, html STRING")
    marked = {row.page_id: row.refers_to for row in warc.mark_revisits(df, "page_id", "html", least_bytes=5).collect()}
    assert marked == {1: None, 2: None, 3: None, 4: 3}


def test_archives_of_awkward_rows(spark):
    schema = "page_id BIGINT, url STRING, html STRING, digest INT, Payload_Bytes INT, first INT"
    rows = [(2, None, "x", 1, 1, 1), (2, None, "x", 1, 1, 1), (None, "u", "x", 1, 1, 1), (None, "u", "only", 1, 1, 1), (1, "u", "x", 1, 1, 1)]
    folder = scratch_folder(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(rows, schema), folder, "page_id", "url", "html")
    got = sorted((row.record_id, row.record_type, row.refers_to) for row in warc.read_warc(spark, folder).collect())
    assert got == [
        ("", "response", ""), ("", "revisit", "1"), ("1", "response", ""), ("2", "revisit", "1"), ("2", "revisit", "1"),
    ]
    empty = scratch_folder(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([], schema), empty, "page_id", "url", "html")
    assert warc.read_warc(spark, empty).collect() == []


def test_headers_that_are_none():
    good = b"1\r\nContent-Length: 3\r\n\r\nabc"
    assert warc.parse_header(good) == ({b"content-length": b"3"}, 24, 3)
    for bad in (b"", b"1\r\nContent-Length: 3", b"x\r\nContent-Length: 3\r\n\r\n", b"1\r\nno colon\r\n\r\n",
                b"1\r\nContent-Length: -3\r\n\r\n", b"1\r\nA: b\r\n\r\n"):
        assert warc.parse_header(bad) is None


def test_base32(spark):
    rows = spark.createDataFrame([("",), ("abc",), ("é" * 99,)], "t STRING")
    for row in rows.select("t", warc.base32_sha1(F.col("t").cast("binary")).alias("b")).collect():
        assert row.b == b32(row.t.encode())
