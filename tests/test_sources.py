"""Readers and writers."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from playstar.schemas import LOG_MAPPING, SONG_MAPPING, PathMapping
from playstar.sources.csv_files import read_csv, write_csv
from playstar.sources.json_files import (
    ErrorBudget,
    TooManyErrors,
    load_json,
    match_by_name,
    parse_json,
    read_mapping,
)
from playstar.sources.ledger import LoadLedger, committed_files
from playstar.sources.listing import HiddenFiles, list_files
from playstar.sources.manifest import generate_manifest, load_manifest, read_manifest, write_manifest
from tests.samples import SONGS, play, write_lines


def by_id(rows):
    return {row.song_id: row for row in rows}


def test_songs_one_file_each(spark, tmp_path, folder):
    for i, song in enumerate(SONGS):
        write_lines(tmp_path / "songs" / "A" / str(i) / "s.json", [song])
    rows = by_id(load_json(spark, folder("songs"), SONG_MAPPING, folder("staged")).rows.collect())
    assert len(rows) == len(SONGS)
    for song in SONGS:
        assert rows[song["song_id"]].asDict() == song
    assert rows["SOPAPERBOATS000001"].artist_location == ""
    assert rows["SOPAPERBOATS000001"].year == 0
    assert rows["SONOPLACE"].artist_location is None


def test_log_numbers_in_any_dress(spark, tmp_path, folder):
    records = [play(userId="7", itemInSession=0), play(userId="", itemInSession=1), play(userId=8, itemInSession=2)]
    without = play(itemInSession=3)
    del without["userId"]
    path = write_lines(tmp_path / "log.json", [*records, without])
    rows = load_json(spark, [path], LOG_MAPPING, folder("staged")).rows.orderBy("itemInSession").collect()
    assert [r.userId for r in rows] == [7, None, 8, None]
    assert {r.registration for r in rows} == {1540919166796}
    assert rows[0].ts == 1542241826796


def test_columns_follow_paths_and_not_positions(spark, tmp_path, folder):
    path = write_lines(tmp_path / "x.json", [{"b": 2, "a": "n"}])
    mapping_file = tmp_path / "paths.json"
    mapping_file.write_text(json.dumps({"jsonpaths": SONG_MAPPING.paths}, indent=2))
    assert read_mapping(spark, "staging_song_data", str(mapping_file)) == SONG_MAPPING
    with pytest.raises(ValueError):
        parse_json(spark.read, path, PathMapping("staging_song_data", ("$.a",)))


def test_nested_paths(spark, tmp_path, folder):
    nested = PathMapping("staging_song_data", tuple(f"$['song']['{p[2:]}']" for p in SONG_MAPPING.paths))
    assert nested.top_level_keys() is None and SONG_MAPPING.top_level_keys() is not None
    path = write_lines(tmp_path / "n.json", [*({"song": s} for s in SONGS), '{"song": {"song_id"'])
    loaded = load_json(spark, path, nested, folder("staged"), max_errors=2)
    rows = by_id(loaded.rows.collect())
    assert {k: r.asDict() for k, r in rows.items()} == {s["song_id"]: s for s in SONGS}
    assert loaded.rejected.count() == 1


def test_error_budget(spark, tmp_path, folder):
    bad_number = {**SONGS[0], "year": "nineteen"}
    path = write_lines(tmp_path / "b.json", [*SONGS, '{"song_id": "SO', bad_number, "no json"])
    loaded = load_json(spark, path, SONG_MAPPING, folder("a"), max_errors=4)
    assert loaded.rows.count() == len(SONGS)
    assert loaded.rejected.count() == 3
    assert {r["_corrupt_record"] for r in loaded.rejected.collect()} == {'{"song_id": "SO', "no json", None}
    with pytest.raises(TooManyErrors):
        load_json(spark, path, SONG_MAPPING, folder("b"), max_errors=3)
    with pytest.raises(TooManyErrors):
        load_json(spark, path, SONG_MAPPING, folder("c"))


def test_error_budget_of_a_direct_write(spark, tmp_path, folder):
    path = write_lines(tmp_path / "b.json", [*SONGS, "no json", "neither"])
    for limit, fits in ((3, True), (2, False)):
        budget = ErrorBudget("staging_song_data", limit)
        budget.watch(parse_json(spark.read, path, SONG_MAPPING)).write.parquet(folder(f"t{limit}"))
        assert spark.read.parquet(folder(f"t{limit}")).count() == len(SONGS)
        if fits:
            budget.check()
        else:
            with pytest.raises(TooManyErrors):
                budget.check()


def test_empty_files_are_within_any_budget(spark, tmp_path, folder):
    path = write_lines(tmp_path / "e.json", [""])
    budget = ErrorBudget("staging_song_data")
    budget.watch(parse_json(spark.read, path, SONG_MAPPING)).write.parquet(folder("t"))
    budget.check()


def test_match_by_name(spark):
    text = json.dumps({**SONGS[1], "unknown": 1}, sort_keys=True)
    row = spark.createDataFrame([(text,)], "value string").select(match_by_name(F.col("value"), SONG_MAPPING)).first()[0]
    assert (row.title, row.year, row.artist_name) == ("Don't Wait (For Me)", "1981", "The Tidewaters")


def test_list_files(spark, tmp_path):
    for name in ("log/2018/11/a.json", "log/2018/12/b.json", "song/A/c.json"):
        write_lines(tmp_path / "bucket" / name, ["{}"])
    root = str(tmp_path / "bucket")
    keys = lambda *a: sorted(r.key for r in list_files(spark, root, *a).collect())
    assert keys() == ["log/2018/11/a.json", "log/2018/12/b.json", "song/A/c.json"]
    assert keys("log/") == ["log/2018/11/a.json", "log/2018/12/b.json"]
    assert keys("log/", 1) == ["log/2018/11/a.json"]
    assert keys("log/", 0) == keys("log/")
    plan = list_files(spark, root)._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]


def test_manifest_parts_are_bounded(spark, tmp_path, folder):
    urls = [f"s3://bucket/f{i:03}" for i in range(25)]
    df = spark.createDataFrame([(u,) for u in [*urls, *urls[:5]]], "path string")
    write_manifest(df, "path", folder("m"), max_entries=10)
    assert sorted(map(tuple, read_manifest(spark, folder("m")).collect())) == [(u, True) for u in urls]
    parts = [json.loads(p.read_text()) for p in (tmp_path / "m").glob("*.json") if p.stat().st_size]
    assert sorted(len(p["entries"]) for p in parts) == [5, 10, 10]
    assert sorted(parts, key=lambda p: p["entries"][0]["url"])[0]["entries"][0] == {"url": urls[0], "mandatory": True}


def test_listed_files_have_to_exist(spark, tmp_path, folder):
    there = write_lines(tmp_path / "a.json", [SONGS[0]])
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_json(spark, [there, str(tmp_path / "gone.json")], SONG_MAPPING, folder("staged"))


def test_committed_files_match_like_a_pattern(spark):
    names = ["s3://b/log-data/1 ", "s3://b/log-data/1", "s3://b/logXdata/2", "s3://b/song/3"]
    ledger = spark.createDataFrame([(n,) for n in [*names, names[0]]], "filename string")
    got = lambda prefix: sorted(r.filename for r in committed_files(ledger, prefix).collect())
    assert got("log-data") == ["s3://b/log-data/1", "s3://b/log-data/1"]
    assert got("log_data") == ["s3://b/log-data/1", "s3://b/log-data/1", "s3://b/logXdata/2"]


def test_ledger(spark, folder):
    ledger = LoadLedger(spark, folder("ledger"))
    assert ledger.next_batch("t") == 0
    files = spark.createDataFrame([("a", 0), ("b", 1)], "filename string, load_batch bigint")
    ledger.commit(files, "t")
    ledger.commit(files.select("filename", (F.col("load_batch") + 4).alias("load_batch")), "u")
    assert sorted((r.table_name, r.load_batch, r.filename) for r in ledger.entries().collect()) == [
        ("t", 0, "a"), ("t", 1, "b"), ("u", 4, "a"), ("u", 5, "b"),
    ]
    assert (ledger.next_batch("t"), ledger.next_batch("u")) == (2, 6)


def test_keys_are_relative_to_the_root(spark, tmp_path):
    """Also where the root's own name comes again below it."""
    root = tmp_path / "logs"
    for name in ("2018/logs/c.json", "2018/a b.json", "2019/x.json"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("{}")
    keys = lambda prefix: sorted(r.key for r in list_files(spark, str(root), prefix).collect())
    assert keys("") == ["2018/a b.json", "2018/logs/c.json", "2019/x.json"]
    assert keys("2018/lo") == ["2018/logs/c.json"] and keys("2018/") == ["2018/a b.json", "2018/logs/c.json"]
    assert keys("2020/") == []
    assert [r.key for r in list_files(spark, f"file:{root}", "2019").collect()] == ["2019/x.json"]


def test_hidden_names_are_refused(spark, tmp_path):
    (tmp_path / "in" / "2018").mkdir(parents=True)
    for name in ("a.json", "_SUCCESS", ".a.json.crc"):
        (tmp_path / "in" / name).write_text("{}")
    assert list_files(spark, str(tmp_path / "in")).count() == 1
    (tmp_path / "in" / "2018" / "_x.json").write_text("{}")
    with pytest.raises(HiddenFiles, match="_x.json"):
        list_files(spark, str(tmp_path / "in"))


def test_csv_keeps_quotes_breaks_and_blanks(spark, folder):
    rows = [('say "hi"', 1), ("two\nlines\r\n, and, commas", 2), ("", 3), (None, 4), ("  ends  ", 5), ("back\\slash\\", 6)]
    df = spark.createDataFrame(rows, "t string, n int")
    write_csv(df, folder("csv"))
    assert sorted(map(tuple, read_csv(spark, folder("csv"), df.schema, line_breaks=True).collect()), key=lambda r: r[1]) == rows


def test_optional_entries_may_be_missing(spark, tmp_path, folder):
    (tmp_path / "a.json").write_text('{"num_songs": 1, "song_id": "s"}')
    manifest = tmp_path / "m.json"
    entries = [{"url": str(tmp_path / "a.json"), "mandatory": True}, {"url": str(tmp_path / "gone.json"), "mandatory": False}]
    manifest.write_text(json.dumps({"entries": entries}))
    loaded = load_manifest(spark, str(manifest), SONG_MAPPING, folder("staged"))
    assert [r.song_id for r in loaded.rows.collect()] == ["s"]
    manifest.write_text(json.dumps({"entries": [{"url": str(tmp_path / "gone.json"), "mandatory": True}]}))
    with pytest.raises(Exception, match="gone.json"):
        load_manifest(spark, str(manifest), SONG_MAPPING, folder("staged"))


def test_manifest_parts_share_one_budget(spark, tmp_path, folder):
    names = []
    for i in range(3):
        (tmp_path / f"{i}.json").write_text('{"song_id": "s%d"}\nbroken' % i)
        names.append(str(tmp_path / f"{i}.json"))
    write_manifest(spark.createDataFrame([(n,) for n in names], "url string"), "url", folder("m"), max_entries=1)
    assert load_manifest(spark, folder("m"), SONG_MAPPING, folder("s"), max_errors=4).rows.count() == 3
    with pytest.raises(TooManyErrors):
        load_manifest(spark, folder("m"), SONG_MAPPING, folder("s2"), max_errors=3)


def test_generate_manifest(spark, tmp_path, folder):
    for name in ("log/a.json", "log/b.json", "log/c.json", "song/d.json"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text("{}")
    none = spark.createDataFrame([], "filename string")
    urls = lambda *a: [r.url.rsplit("/", 1)[1] for r in generate_manifest(spark, str(tmp_path / "in"), "log/", *a).orderBy("url").collect()]
    assert urls(none, folder("m1")) == ["a.json", "b.json", "c.json"]
    done = spark.createDataFrame([(f"file:{tmp_path}/in/log/a.json",)], "filename string")
    assert urls(done, folder("m2")) == ["b.json", "c.json"]
    assert urls(done, folder("m3"), 2) == ["b.json"]
    assert urls(spark.createDataFrame([(f"file:{tmp_path}/in/log/{c}.json",) for c in "abc"], "filename string"), folder("m4")) == []
