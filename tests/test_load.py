"""The load on the golden star: every table, missing sources, audits, publishing."""

from datetime import date

import golden
import pytest

from touchline import schemas
from touchline.operators import audit
from touchline.plans import load as loading
from touchline.sources import entities as files
from touchline.sources import star as stars
from touchline.sources.scratch import materialize


@pytest.fixture(scope="module")
def raw(spark):
    return golden.entities(spark)


@pytest.fixture(scope="module")
def star(raw):
    return loading.build_star(raw, lambda name, df: materialize(df, name))


def rows(df, *columns):
    return sorted([tuple(row) for row in df.select(*columns).collect()], key=repr)


def test_competitions(star):
    assert rows(star["dim_competition"], "competition_id", "href", "competition_name", "country") == [
        (1, "/es1", "LaLiga", "Spain"), (2, "/gb1", "Premier League", "England"),
        (3, None, "Abroad League", None), (4, None, "Cup", None),
    ]


def test_clubs(star):
    assert rows(star["dim_club"], "club_id", "href", "club_name", "competition_id") == [
        (1, "/city", "City", 2), (2, "/lost", "Lost", None), (3, "/madrid", "Madrid", 1),
        (4, "/twin-a", "Twin", 2), (5, "/twin-b", "Twin", 1),
        (6, None, "City", None),  # the padded spelling, stored trimmed
        (7, None, "Dortmund", None), (8, None, "Youth", None),
    ]


def test_clubs_with_trimmed_names(raw):
    from touchline.plans import dims, facts

    competitions = dims.dim_competition(raw["competitions"])
    clubs = dims.dim_club(raw["clubs"], competitions)
    stubs = dims.stub_clubs(raw["transfers"], clubs, trim_names=True)
    assert rows(stubs, "club_id", "club_name") == [(6, "Dortmund"), (7, "Youth")]
    players = dims.dim_player(raw["players"])
    moved = facts.fact_transfer(raw["transfers"], players, clubs.unionByName(stubs), trim_names=True)
    assert (2, 1, 6, 20191229) in rows(moved, "player_id", "from_club_id", "to_club_id", "date_id")


def test_players(star):
    assert rows(star["dim_player"], "player_id", "href", "name", "date_birth") == [
        (1, "/p/ann", "Ann", None), (2, "/p/bo", "Aaa", date(1999, 1, 1)),
        (3, "/p/zed", None, date(2001, 2, 3)),
    ]


def test_dates(star):
    got = {row.date_id: row.season for row in star["dim_date"].collect()}
    assert got[20250701] == "2025" and got[20260226] == "25/26" and got[20161218] is None
    assert 20150505 in got and 20250202 in got  # dates of unknown players count
    assert 20000721 not in got  # births do not
    first = star["dim_date"].where("date_id = 20260226").first()
    assert (first.date, first.year, first.month, first.day) == (date(2026, 2, 26), 2026, 2, 26)


def test_stats(star):
    assert rows(star["fact_stats"], *schemas.STAR["fact_stats"].fieldNames()) == [
        (1, 1, 1, 20240701, 10, 1, 1, 0, 0, 900),  # listed by two clubs: one row for each
        (1, 3, 1, 20240701, 10, 1, 1, 0, 0, 900),
        (2, 1, 2, 20250701, 31, 22, 7, 2, None, 2509),
        (2, 1, 4, 20250701, 3, None, None, None, None, 199),
    ]


def test_injuries(star):
    assert rows(star["fact_injury"], *schemas.STAR["fact_injury"].fieldNames()) == [
        (2, 20250101, 20250105, None, None, None), (2, 20260226, 20260301, "Bruise", 4, 1),
    ]


def test_transfers(star):
    assert rows(star["fact_transfer"], *schemas.STAR["fact_transfer"].fieldNames()) == [
        (1, 4, 3, 20180101, "Twin", "Madrid", 5, None), (1, 5, 3, 20180101, "Twin", "Madrid", 5, None),
        (2, 7, 1, 20220701, "Dortmund", "City", 150, 75), (2, 7, 6, 20220701, "Dortmund", "City", 150, 75),
    ]


def test_market_values(star):
    assert rows(star["fact_market_value"], "player_id", "date_id", "market_value") == [
        (1, 20170505, None), (2, 20161218, 300),
    ]


def test_contracts(star):
    assert rows(star["fact_contract"], *schemas.STAR["fact_contract"].fieldNames()) == [
        (1, 1, 20230115, 20260630), (1, 3, 20210701, 20250630), (2, 1, 20240701, 20300630),
    ]


def test_the_star_is_the_same_with_hot_keys_and_without_broadcasts(spark, raw, star):
    # With many partitions every repeated key is hot; without a broadcast limit all joins shuffle.
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        again = loading.build_star(raw, lambda name, df: materialize(df, name))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name, schema in schemas.STAR.items():
        columns = schema.fieldNames()
        assert rows(again[name], *columns) == rows(star[name], *columns)


def test_scratch_tables_go_with_their_job(spark):
    from pathlib import Path

    from touchline.sources.scratch import scratch_job, scratch_root

    root = Path(scratch_root(spark).removeprefix("file:"))
    before = set(root.glob("job-*"))
    with scratch_job(spark):
        assert materialize(spark.range(3), "some").count() == 3
        assert len(set(root.glob("job-*")) - before) == 1
    assert set(root.glob("job-*")) == before


def test_star_keeps_its_rules(star):
    assert audit.audit_star(star).where("n_violations > 0").collect() == []
    names = rows(audit.audit_names(star), "table_name", "n_violations")
    assert names == [("dim_club", 2), ("dim_competition", 0)]  # City and Twin


def test_audit_finds_planted_violations(spark, star):
    broken = dict(star)
    broken["dim_player"] = star["dim_player"].where("player_id <> 2").unionByName(star["dim_player"].where("player_id = 1"))
    bad_contract = spark.createDataFrame([(1, 1, None, 20991231)], schemas.STAR["fact_contract"])
    broken["fact_contract"] = star["fact_contract"].unionByName(bad_contract)
    found = {(r.table_name, r.rule): r.n_violations
             for r in audit.audit_star(broken).where("n_violations > 0").collect()}
    assert found == {
        ("dim_player", "primary key (player_id)"): 1, ("dim_player", "unique href"): 1,
        ("fact_stats", "foreign key player_id -> dim_player"): 2,
        ("fact_injury", "foreign key player_id -> dim_player"): 2,
        ("fact_transfer", "foreign key player_id -> dim_player"): 2,
        ("fact_market_value", "foreign key player_id -> dim_player"): 1,
        ("fact_contract", "foreign key player_id -> dim_player"): 1,
        ("fact_contract", "not null joined_date_id"): 1,
        ("fact_contract", "foreign key contract_until_id -> dim_date"): 1,
    }


def test_load_from_files_and_publish(spark, raw, tmp_path):
    data, out = str(tmp_path / "data"), str(tmp_path / "star")
    for name, df in raw.items():
        files.write_entity(df, data, name)
    counts = loading.load(spark, data, out)
    assert list(counts) == list(schemas.STAR)
    assert counts == {
        "dim_competition": 4, "dim_club": 8, "dim_player": 3, "dim_date": counts["dim_date"],
        "fact_stats": 4, "fact_injury": 2, "fact_transfer": 4, "fact_market_value": 2, "fact_contract": 3,
    }
    published = stars.read_star(spark, out)
    assert {name: df.count() for name, df in published.items()} == counts
    assert published["dim_club"].schema == schemas.STAR["dim_club"]

    # A load that breaks a rule leaves the star as it was.
    broken = dict(raw)
    broken["injuries"] = spark.createDataFrame(
        [("injury", "/p/bo", "x", "y", "no day", "2025-01-01", 1, 1)], schemas.RAW["injuries"]
    )
    with pytest.raises(loading.ConstraintError, match="start_date_id"):
        loading.load(spark, broken, out)
    assert stars.read_star(spark, out)["fact_injury"].count() == 2

    # A good one replaces it as a whole, down to tables that are now empty.
    fewer = dict(raw)
    fewer["injuries"] = files.empty_entity(spark, "injuries")
    assert loading.load(spark, fewer, out)["fact_injury"] == 0
    assert stars.read_star(spark, out)["fact_injury"].count() == 0
    # The broken run left nothing behind, and of the good ones the last two stay.
    assert len(list((tmp_path / "star" / "runs").iterdir())) == 2
    assert loading.load(spark, raw, out) == counts
    assert len(list((tmp_path / "star" / "runs").iterdir())) == 2


def test_conflicting_links_break_the_load(spark, raw, tmp_path):
    twice = dict(raw)
    twice["clubs"] = raw["clubs"].unionByName(raw["clubs"].where("href = '/city'"))
    with pytest.raises(loading.ConstraintError, match="clubs: unique href"):
        loading.load(spark, twice, str(tmp_path / "star"))
    with pytest.raises(FileNotFoundError):
        stars.read_star(spark, str(tmp_path / "star"))


def test_missing_and_empty_sources(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    with pytest.raises(FileNotFoundError):
        files.read_entities(spark, str(data))
    (data / "clubs.jsonl").write_text("")
    (data / "players.jsonl").write_text(
        '{"href": "/p/1", "name": "A", "joined": "2020-07-01", "contract_until": "2021-06-30", "new": 1}\n\n  \n'
    )
    counts = loading.load(spark, str(data), str(tmp_path / "star"))
    assert {name for name, n in counts.items() if n} == {"dim_player", "dim_date"}
    assert counts["dim_date"] == 2


def test_lines(spark, tmp_path):
    seeds = tmp_path / "seeds.json"
    seeds.write_text('{"type": "competition", "href": "/a"}\n\n   \n{"type": "competition", "href": "/b"}\n')
    assert [row.href for row in files.read_seeds(spark, str(seeds)).collect()] == ["/a", "/b"]
    with pytest.raises(FileNotFoundError):
        files.read_seeds(spark, str(tmp_path / "none.json"))
    (tmp_path / "clubs.jsonl").write_text('{"name": "A", "href": "/a"}\n{"name": broken\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_entity(spark, str(tmp_path), "clubs").collect()
    good, bad = files.split_malformed(spark, str(tmp_path), "clubs")
    assert [row.href for row in good.collect()] == ["/a"]
    assert [row.line for row in bad.collect()] == ['{"name": broken']


def test_entity_files_are_packed_and_bad_lines_cost_no_second_reading(spark, raw, tmp_path):
    files.write_entity(raw["clubs"], str(tmp_path), "clubs")
    written = list((tmp_path / "clubs.jsonl").glob("part-*"))
    assert written and all(path.name.endswith(".json.gz") for path in written)
    (tmp_path / "clubs.jsonl" / "more.json").write_text('{"name": broken\n')
    good, bad = files.split_malformed(spark, str(tmp_path), "clubs")
    for path in (tmp_path / "clubs.jsonl").iterdir():
        path.write_bytes(b"")
    assert rows(good, *good.columns) == rows(raw["clubs"], *good.columns)
    assert [row.line for row in bad.collect()] == ['{"name": broken']
    assert loading.land({"clubs": good})["clubs"] is good


def test_numbers_may_be_written_as_texts_or_fractions(spark, tmp_path):
    (tmp_path / "clubs.jsonl").write_text(
        '{"href": "/a", "squad_size": "27", "total_market_value": 150000000.0, "avg_age": "26.5"}\n'
        '{"href": "/b", "squad_size": 27.6, "total_market_value": 9007199254740993, "avg_age": 26}\n'
        '{"href": "/c", "squad_size": "many", "total_market_value": null, "avg_age": {"x": 1}}\n'
    )
    got = files.read_entity(spark, str(tmp_path), "clubs")
    assert got.schema == schemas.RAW["clubs"]
    assert rows(got, "href", "squad_size", "total_market_value", "avg_age") == [
        ("/a", 27, 150000000, 26.5), ("/b", 28, 9007199254740993, 26.0), ("/c", None, None, None),
    ]
    good, _ = files.split_malformed(spark, str(tmp_path), "clubs")
    assert rows(good, *got.columns) == rows(got, *got.columns)


def test_the_report_counts_what_did_not_stop_the_load(spark, raw, tmp_path):
    data = str(tmp_path / "data")
    odd = dict(raw)
    stranger = spark.createDataFrame([("/p/odd", "Odd", "sometime")], "href STRING, name STRING, dob STRING")
    odd["players"] = raw["players"].unionByName(stranger, allowMissingColumns=True)
    for name, df in odd.items():
        files.write_entity(df.coalesce(1), data, name)
    (tmp_path / "data" / "clubs.jsonl" / "more.json").write_text('{"name": broken\n\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        loading.load(spark, data, str(tmp_path / "star"))
    report = loading.load(spark, data, str(tmp_path / "star"), bad_lines="skip")
    assert report["dim_player"] == 4
    assert report.notes[("clubs", "malformed lines")] == 1
    assert report.notes[("players", "unread date dob")] >= 1
    assert report.notes[("dim_club", "ambiguous club_name")] == 2


def test_each_of_two_loads_gets_its_own_turn(spark, tmp_path):
    out = str(tmp_path / "star")
    one, two = stars.StarWriter(spark, out), stars.StarWriter(spark, out)
    folder = stars._Folder(spark, f"{out}/current")
    assert folder.create(1, one.run) and not folder.create(1, two.run)
    two.publish()
    assert folder.names() == [1, 2] or sorted(folder.names()) == [1, 2]
    assert folder.read(2) == two.run
    for _ in range(3):
        two.publish()
    assert sorted(folder.names()) == [4, 5]


def test_written_tables_are_not_landed_again(spark, raw):
    once = loading.land(raw)
    assert all(again is df for again, df in zip(loading.land(once).values(), once.values()))


def test_rows_and_nulls_are_counted_while_tables_are_written(spark, raw, star, tmp_path):
    writer = stars.StarWriter(spark, str(tmp_path))
    written = {name: writer.write(name, df) for name, df in star.items()}
    assert writer.rows == {name: df.count() for name, df in star.items()}
    odd = star["dim_player"].selectExpr("player_id", "nullif(href, '/p/ann') href", *star["dim_player"].columns[2:])
    written["dim_player"] = stars.StarWriter(spark, str(tmp_path / "odd"))
    known = written.pop("dim_player")
    written["dim_player"] = known.write("dim_player", odd)
    writer.nulls["dim_player"] = known.nulls["dim_player"]
    assert known.nulls == {"dim_player": {"href": 1}}
    columns = ("table_name", "rule", "n_violations")
    assert rows(audit.audit_star(written, writer.nulls), *columns) == rows(audit.audit_star(written), *columns)


def test_an_empty_star_is_counted(spark, raw, tmp_path):
    report = loading.load(spark, {name: df.limit(0) for name, df in raw.items()}, str(tmp_path))
    assert set(report.values()) == {0} and len(report) == 9


def test_a_load_that_dies_leaves_the_old_star_and_no_scratch(spark, raw, tmp_path, monkeypatch):
    from touchline.sources import scratch

    out = str(tmp_path / "star")
    loading.load(spark, raw, out)
    before = {name: rows(df, *df.columns) for name, df in stars.read_star(spark, out).items()}
    runs = set((tmp_path / "star" / "runs").iterdir())
    folders = []
    monkeypatch.setattr(scratch, "delete", lambda spark, folder, real=scratch.delete: (folders.append(folder), real(spark, folder)))

    def dies(*args):
        raise KeyboardInterrupt("killed in the last fact")

    monkeypatch.setattr(loading.facts, "fact_contract", dies)
    with pytest.raises(KeyboardInterrupt):
        loading.load(spark, {name: df.limit(1) for name, df in raw.items()}, out)
    assert {name: rows(df, *df.columns) for name, df in stars.read_star(spark, out).items()} == before
    assert set((tmp_path / "star" / "runs").iterdir()) == runs
    (job,) = [folder for folder in folders if "/job-" in folder]
    path = spark._jvm.org.apache.hadoop.fs.Path(job)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    monkeypatch.undo()
    loading.load(spark, raw, out)  # and the next load goes through


def test_references_to_many_rows_are_not_broadcast(spark):
    def table(name, n=0, **values):
        fields = [values.get(f.name, "null") + f" as `{f.name}`" for f in schemas.STAR[name]]
        rows = spark.range(n).selectExpr(*fields)
        return materialize(rows.select(*[rows[f.name].cast(f.dataType) for f in schemas.STAR[name]]), name)

    star = {name: table(name) for name in schemas.STAR}
    star["dim_player"] = table("dim_player", 60_000, player_id="id", href="concat('/p/', id)")
    star["fact_market_value"] = table("fact_market_value", 70_000, player_id="id", date_id="20200101")
    found = audit._all_references(star)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    broken = {(row.table_name, row.rule): row.n_violations for row in found.where("n_violations > 0").collect()}
    assert broken == {
        ("fact_market_value", "foreign key player_id -> dim_player"): 10_000,
        ("fact_market_value", "foreign key date_id -> dim_date"): 70_000,
    }
