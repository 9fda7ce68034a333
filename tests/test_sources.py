"""CSV records across blocks, balanced writes, table loading."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.schemas import RAW_SCHEMAS, canonical
from reviewlens.sources import files, ingest, readers, writers
from reviewlens.sources.csv import read_csv, read_csv_in_parallel

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def write(path, rows, header=("id", "body", "score"), end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


def awkward_rows(n, seed=1):
    rng = random.Random(seed)
    pieces = ['"', '""', "\n", "\n\n", ",", "plain", "ñandú", " lead", '\n"quoted"\n', "a,b", "\r\n"]
    return [
        (i, "x" + "".join(rng.choice(pieces) for _ in range(rng.randrange(12))), i / 4)
        for i in range(n)
    ]


@pytest.fixture
def small_blocks(spark):
    """Splits of a few hundred bytes, so that records lie across them."""
    keys = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_parallel_csv_equals_rows_written(spark, tmp_path, small_blocks):
    rows = awkward_rows(400)
    # One record longer than several blocks.
    rows.append((400, "long\n" * 300 + '"end"', 1.0))
    rows += [(r[0] + 401, r[1], r[2]) for r in awkward_rows(50, seed=2)]
    path = str(tmp_path / "rows.csv")
    write(path, rows)
    found = read_csv_in_parallel(spark, path, SCHEMA)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    want = sorted(rows)
    assert sorted(tuple(r) for r in found.collect()) == want
    assert sorted(tuple(r) for r in read_csv(spark, path, SCHEMA).collect()) == want


def test_parallel_csv_with_windows_line_ends_and_several_files(spark, tmp_path, small_blocks):
    folder = tmp_path / "parts"
    folder.mkdir()
    first, second = awkward_rows(60, 3), [(i + 1000, b, s) for i, b, s in awkward_rows(60, 4)]
    write(folder / "a.csv", first, end="\r\n")
    write(folder / "b.csv", second, end="\r\n")
    found = read_csv_in_parallel(spark, str(folder), SCHEMA)
    want = sorted((i, body.replace("\r\n", "\n"), score) for i, body, score in first + second)
    assert sorted(tuple(r) for r in found.collect()) == want
    assert sorted(tuple(r) for r in read_csv(spark, str(folder), SCHEMA).collect()) == want


def test_both_csv_readers_agree(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    write(path, [("1", 'a ""q"", b\nsecond', "2.5"), ("x", "", ""), ("3.0", "z", "bad")])
    simple = sorted(map(str, read_csv(spark, path, SCHEMA).collect()))
    parallel = sorted(map(str, read_csv_in_parallel(spark, path, SCHEMA).collect()))
    assert simple == parallel
    assert {r.id for r in read_csv(spark, path, SCHEMA).collect()} == {1, None, 3}


def test_csv_columns_match_by_name_and_inference_works(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    write(path, [("b", "7", "extra")], header=("body", "ID", "other"))
    for read in (read_csv, read_csv_in_parallel):
        found = read(spark, path, SCHEMA, missing="null")
        assert found.columns == ["id", "body", "score", "other"]
        assert found.first() == (7, "b", None, "extra")
        with pytest.raises(ValueError, match="score"):
            read(spark, path, SCHEMA)
    assert dict(read_csv(spark, path).dtypes)["ID"] == "int"


def test_files_with_different_headers_are_matched_by_name(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder / "a.csv", [(1, "a", 0.5)])
    write(folder / "b.csv", [("b", 2, "x")], header=("body", "id", "more"))
    found = read_csv(spark, str(folder), SCHEMA, missing="null")
    assert sorted(map(tuple, found.select("id", "body", "score", "more").collect())) == [
        (1, "a", 0.5, None), (2, "b", None, "x"),
    ]
    with pytest.raises(ValueError, match="different headers"):
        read_csv_in_parallel(spark, str(folder), SCHEMA)


STRAY = [
    'id,body,score\n1,17" disk,2\n2,b,3\n3,c,4\n4,d,5\n',
    'id,body,score\n1,"a"b,2\n2,b,3\n',
    'id,body,score\r1,a,2\r2,b,3\r',
    'id,body,score\n1,a "b" c,2\n',
]


@pytest.mark.parametrize("text", STRAY)
def test_loose_quotes_keep_every_row_or_raise(spark, tmp_path, text, small_blocks):
    path = tmp_path / "rows.csv"
    path.write_bytes(text.encode())
    rows = read_csv(spark, str(path), SCHEMA).collect()
    assert len(rows) == len(text.replace("\r", "\n").strip().split("\n")) - 1
    with pytest.raises(Exception, match="(?s)strictly quoted|different headers|no column"):
        read_csv_in_parallel(spark, str(path), SCHEMA).collect()


def test_blank_lines_are_read_alike(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('id,body,score\n\n1,a,2\n   \n2,"b\n\nc",3\n')
    one, two = (read(spark, str(path), SCHEMA).collect() for read in (read_csv, read_csv_in_parallel))
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_ingest_reads_files_of_any_size_alike(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "notes.csv").write_text(STRAY[0])
    tables = ingest.ingest_folder(spark, str(raw), str(tmp_path / "silver"), {"notes": SCHEMA})
    assert tables["notes"].count() == 4
    with pytest.raises(Exception, match="strictly quoted"):
        ingest.ingest_folder(
            spark, str(raw), str(tmp_path / "strict"), {"notes": SCHEMA}, strict_quotes=True
        )
    assert [p.name for p in (tmp_path / "strict").iterdir()] == []


def test_header_only_file(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    write(path, [])
    assert read_csv(spark, path, SCHEMA).count() == 0
    assert read_csv_in_parallel(spark, path, SCHEMA).count() == 0


def test_ingest_names_and_schema(spark, tmp_path):
    raw, silver = tmp_path / "raw", tmp_path / "silver"
    raw.mkdir()
    write(raw / "application_genres.csv", [(1, 2)], header=("appid", "genre_id"))
    write(raw / "other_table.csv", [(1, "x")], header=("n", "s"))
    tables = ingest.ingest_folder(spark, str(raw), str(silver))
    assert set(tables) == {"application_genres", "other_table"}
    assert dict(tables["application_genres"].dtypes) == {"appid": "bigint", "genre_id": "bigint"}
    assert ingest.display_name("/a/application_genres.csv") == "Application Genres"
    with pytest.raises(FileNotFoundError):
        ingest.ingest_folder(spark, str(silver), str(tmp_path / "none"))


def test_balanced_write(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    df = spark.range(200_000).select("id", F.md5(F.col("id").cast("string").cast("binary")).alias("h"))
    n = writers.write_balanced(df, path, max_bytes=1_000_000, target_bytes=900_000)
    sizes = files.data_files(spark, path)
    assert n == len(sizes) > 1
    assert max(sizes) < 1.2 * min(sizes)
    assert spark.read.parquet(path).exceptAll(df).count() == 0
    # A later, smaller table replaces all of it with one file.
    assert writers.write_balanced(df.limit(10), path) == 1
    assert len(files.data_files(spark, path)) == 1
    assert spark.read.parquet(path).count() == 10
    assert [p.name for p in tmp_path.iterdir() if "__" in p.name] == []


def test_order_of_rows_in_the_files(spark, tmp_path):
    df = spark.range(100_000).select("id", F.md5(F.col("id").cast("string").cast("binary")).alias("h"))
    for limit in (100_000_000, 500_000):
        path = str(tmp_path / f"t{limit}.parquet")
        writers.write_balanced(df, path, limit, limit, order=[F.desc("id")])
        parts = sorted(p for p in (tmp_path / f"t{limit}.parquet").iterdir() if p.suffix == ".parquet")
        got = [r["id"] for p in parts for r in spark.read.parquet(str(p)).collect()]
        assert got == list(range(99_999, -1, -1))


def test_a_failed_write_leaves_the_old_table_alone(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    writers.write_balanced(spark.range(3), path)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("id"))
    with pytest.raises(Exception, match="no"):
        writers.write_balanced(bad, path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t.parquet"]


def test_a_table_is_normally_written_once(spark, tmp_path, monkeypatch):
    written = []
    real = writers.write_table
    monkeypatch.setattr(writers, "write_table", lambda df, path: (written.append(path), real(df, path)))
    df = spark.range(300_000).select("id", F.md5(F.col("id").cast("string").cast("binary")).alias("h"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert writers.write_balanced(df, str(tmp_path / "one.parquet")) == 1
    assert writers.write_balanced(df, str(tmp_path / "sorted.parquet"), order=[F.desc("id")]) == 1
    assert len(written) == 2
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_files_that_fit():
    assert writers.fits([], 1, 100) and writers.fits([90], 1, 100) and not writers.fits([40, 40], 1, 100)
    assert writers.fits([90, 95, 88], 3, 100) and writers.fits([45] * 6, 3, 100)
    assert not writers.fits([45] * 7, 3, 100)
    assert not writers.fits([101, 99], 2, 100) and not writers.fits([90, 90, 40], 3, 100)


@pytest.mark.parametrize("order", [[], [F.desc]])
def test_a_failed_swap_puts_the_old_table_back(spark, tmp_path, monkeypatch, order):
    path = str(tmp_path / "t.parquet")
    writers.write_balanced(spark.range(3), path)
    real, calls = files.rename, []

    def failing(session, source, target):
        calls.append(target)
        if target == path and "ready" in source:
            raise OSError("disk is gone")
        real(session, source, target)

    monkeypatch.setattr(files, "rename", failing)
    with pytest.raises(OSError, match="disk is gone"):
        writers.write_balanced(spark.range(5), path, order=[f("id") for f in order])
    assert len(calls) >= 3
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t.parquet"]


def test_a_crash_between_the_renames_is_mended_by_the_next_write(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    writers.write_balanced(spark.range(3), path)
    files.rename(spark, path, f"{path}__old_0000")
    assert writers.recover(spark, path) and spark.read.parquet(path).count() == 3
    assert not writers.recover(spark, path)
    files.rename(spark, path, f"{path}__old_0000")
    assert writers.write_balanced(spark.range(4), path) == 1
    assert spark.read.parquet(path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["t.parquet"]


def test_empty_table_is_written_and_read(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    writers.write_balanced(spark.range(5).filter("id < 0"), path)
    assert spark.read.parquet(path).count() == 0


def test_partition_refresh_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v long")
    writers.write_partitions(df, path, "p")
    writers.write_partitions(spark.createDataFrame([("b", 3)], "p string, v long"), path, "p")
    assert sorted((r.p, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]


def test_fact_layouts(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        readers.read_parts(spark, folder, "reviews")
    spark.range(3).write.parquet(f"{folder}/reviews.parquet")
    assert readers.read_parts(spark, folder, "reviews").count() == 3
    spark.range(5).write.parquet(f"{folder}/reviews_by_author.parquet")
    assert readers.read_parts(spark, folder, "reviews").count() == 3
    spark.range(2).write.parquet(f"{folder}/reviews_part01.parquet")
    with pytest.raises(ValueError, match="more than one layout"):
        readers.read_parts(spark, folder, "reviews")
    for name in ("users_2023", "users_2024", "users_by_day"):
        spark.range(2).write.parquet(f"{folder}/{name}.parquet")
    assert readers.read_parts(spark, folder, "users").count() == 4


def test_missing_tables_are_reported(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/one.parquet")
    found, missing = readers.load_tables(spark, str(tmp_path), ["one", "two"])
    assert list(found) == ["one"] and missing == ["two"]


def test_canonical_casts_loosely_typed_columns(spark):
    df = spark.createDataFrame(
        [("12", "true", "abc"), ("x", "no idea", "3")],
        "appid string, is_free string, mat_initial_price string",
    )
    found = canonical(df, "applications").collect()
    assert [tuple(r) for r in found] == [(12, True, None), (None, None, 3.0)]
    assert len(RAW_SCHEMAS["reviews"]) == 11


LOOSE_PIECES = ['"', '""', '"""', "a", '17"', ' "', '" ', "\n", ",", "\t", '"x"y', '"a,b"', "\r", "", " ", '",', 'é"', '"\n"']


def loose_text(seed, end):
    """Lines that open, double and forget quotes anywhere."""
    rng = random.Random(seed)
    LOOSE = [p for p in LOOSE_PIECES if end == "\n" or "\n" not in p and (end != "\r" or p != "\r")]
    lines = [
        ",".join("".join(rng.choice(LOOSE) for _ in range(rng.randrange(4))) for _ in range(rng.randrange(1, 6)))
        for _ in range(rng.randrange(1, 40))
    ]
    return "id,body,score" + end + end.join(lines) + rng.choice([end, ""])


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_loose_files_in_parallel_equal_sparks_reader(spark, tmp_path, small_blocks, end):
    text = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "body", "score")])
    for seed in range(12):
        path = tmp_path / f"rows{seed}.csv"
        path.write_bytes((loose_text(100 * len(end) + seed, end) + "last,x,y").encode())
        want = sorted(map(tuple, read_csv(spark, str(path), text).collect()), key=repr)
        found = read_csv_in_parallel(spark, str(path), text, strict=False)
        assert sorted(map(tuple, found.collect()), key=repr) == want, seed


@pytest.mark.parametrize("text", STRAY)
def test_stray_quotes_in_parallel(spark, tmp_path, text, small_blocks):
    path = tmp_path / "rows.csv"
    path.write_bytes(text.encode())
    found = read_csv_in_parallel(spark, str(path), SCHEMA, strict=False)
    want = sorted(map(tuple, read_csv(spark, str(path), SCHEMA).collect()))
    assert sorted(map(tuple, found.collect())) == want


def test_a_quoted_field_over_many_blocks(spark, tmp_path, small_blocks):
    path = tmp_path / "rows.csv"
    body = "\n".join(f'line {k}, 5"" long' for k in range(300))
    path.write_text(f'id,body,score\n1,17" disk,2\n2,"{body}",3\n3,"a" b,4\n4,d\n')
    rows = read_csv_in_parallel(spark, str(path), SCHEMA, strict=False).collect()
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 10
    assert sorted(map(tuple, rows)) == [
        (1, '17" disk', 2.0), (2, body.replace('""', '"'), 3.0), (3, '"a" b', 4.0), (4, "d", None),
    ]


def test_a_large_loose_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = tmp_path / "rows.csv"
    path.write_text("id,body,score\n" + "".join(f'{k},{k}" wide,1\n' for k in range(500)))
    found = read_csv_in_parallel(spark, str(path), SCHEMA, strict=False)
    plan = found._jdf.queryExecution().toString()
    assert "FileScan text" in plan and "FileScan csv" not in plan
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 15
    assert found.count() == 500 and found.agg({"id": "sum"}).first()[0] == sum(range(500))


def test_ingest_reads_loose_files_in_parallel(spark, tmp_path, small_blocks):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "notes.csv").write_bytes(b'id,body,score\r\n1,"a\r\nb",2\r\n2,6" pipe,3\r\n')
    tables = ingest.ingest_folder(spark, str(raw), str(tmp_path / "silver"), {"notes": SCHEMA})
    assert sorted(map(tuple, tables["notes"].collect())) == [(1, "a\nb", 2.0), (2, '6" pipe', 3.0)]


@pytest.mark.parametrize("read", [read_csv, lambda *a, **k: read_csv_in_parallel(*a, **k, strict=False)])
def test_every_file_is_held_against_the_schema(spark, tmp_path, read):
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder / "a.csv", [(1, "a", 0.5)])
    write(folder / "b.csv", [(2,)], header=("id",))
    with pytest.raises(ValueError, match="body, score"):
        read(spark, str(folder), SCHEMA)
    found = read(spark, str(folder), SCHEMA, missing="null")
    assert sorted(map(tuple, found.collect())) == [(1, "a", 0.5), (2, None, None)]


@pytest.mark.parametrize("line", ["a\nb,c,1", '"a" \nb,c,1', '"a"x\n,c,1', "\n", '"a\nb"c\n"d,e,1'])
@pytest.mark.parametrize("end", ["\r\n", "\r"])
def test_a_line_feed_outside_quotes_raises_where_lines_end_otherwise(spark, tmp_path, line, end):
    path = tmp_path / "rows.csv"
    path.write_bytes(end.join(["id,body,score", '1,"in\nside",2', line, "3,z,4", ""]).encode())
    with pytest.raises(Exception, match="line feed outside quotes"):
        read_csv_in_parallel(spark, str(path), SCHEMA, strict=False).collect()
    path.write_bytes(end.join(["id,body,score", '1,"in\n""side\n",2', "3,z,4", ""]).encode())
    rows = read_csv_in_parallel(spark, str(path), SCHEMA, strict=False).collect()
    assert sorted(map(tuple, rows)) == [(1, 'in\n"side\n', 2.0), (3, "z", 4.0)]


def test_first_lines_and_line_ends(spark, tmp_path):
    wide = "x" * 5000
    texts = ["a,b\n1", "a,b\r\n1", "a,b\r1", "a,b", "", f"{wide}\r\n1", "x" * 4095 + "\r\ny", "é\nb"]
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
    found = files.first_lines(spark, [str(tmp_path / f"{k}.csv") for k in range(len(texts))])
    assert found == [
        ("a,b", "\n"), ("a,b", "\r\n"), ("a,b", "\r"), ("a,b", "\n"), ("", "\n"), (wide, "\r\n"),
        ("x" * 4095, "\r\n"), ("é", "\n"),
    ]


def test_a_task_writes_many_small_files(spark, tmp_path):
    """Small files cost a task each no more: parts of one task share its number in the name."""
    path = str(tmp_path / "small.parquet")
    df = spark.range(200_000).select(F.col("id"), F.xxhash64("id").alias("x"))
    n = writers.write_balanced(df, path, max_bytes=20_000, target_bytes=15_000)
    names = [f.name for f in (tmp_path / "small.parquet").glob("*.parquet")]
    sizes = files.data_files(spark, path)
    assert n == len(names) == len(sizes) > 8 * len({name.split("-")[1] for name in names})
    assert max(sizes) <= 20_000 and min(sizes) >= sum(sizes) / len(sizes) / 2
    stored = spark.read.parquet(path)
    assert stored.count() == stored.distinct().count() == 200_000
