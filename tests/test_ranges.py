"""Byte ranges: any range size gives the rows of the whole file, by the readers themselves and by Spark's own sources."""

import gzip
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stridewise.plans import queries
from stridewise.sources import exports
from stridewise.sources import ranges as ranges_module
from stridewise.sources.ranges import (
    FileRange, list_files, pack_ranges, quoted_starts, read_text_records, read_xml_elements, split_files, text_records, xml_elements)


def csv_file(path, seed, rows=40):
    rng = random.Random(seed)
    pieces = ["a", "é", '"', ";", "\n", "\r\n", " ", "1", "--"]
    lines = ["Activity Type;Title;Date"]
    for i in range(rows):
        values = [f"Run{i}", "".join(rng.choices(pieces, k=rng.randint(0, 8))), f"{i:02d}.01.2025 07:00"]
        lines.append(";".join('"' + v.replace('"', '""') + '"' if any(c in v for c in '";\r\n') else v for v in values))
    raw = "\n".join(lines).encode("latin-1") + (b"\n" if seed % 2 else b"")
    path.write_bytes(raw)
    return raw


def xml_file(path, seed, workouts=30):
    rng = random.Random(seed)
    parts = []
    for i in range(workouts):
        parts.append(f"<Record type='x' value='{i}>{i}'/>\n" * rng.randint(0, 4))
        start = f"workoutActivityType=\"HKWorkoutActivityTypeRunning\" startDate='2025-01-01 07:00:{i:02d} +0100' duration=\"{i}\" note=\"a>b\""
        stat = f'\n  <WorkoutStatistics type="{exports.ENERGY_TYPE}" sum="{i}.5"/>\n <!-- </Workout> -->'
        parts.append(rng.choice([f"<Workout {start}/>", f"<Workout {start}>{stat}</Workout>", f"<Workout {start}>é</Workout >", "<WorkoutPlan/>"]))
    path.write_text("<?xml version='1.0'?><HealthData>" + "".join(parts) + "</HealthData>", encoding="utf-8")
    return path.stat().st_size


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("block", [1, 7, 5000])
def test_text_records_of_any_ranges(tmp_path, seed, block):
    raw = csv_file(tmp_path / "f.csv", seed)
    name = str(tmp_path / "f.csv")
    whole = list(text_records(FileRange(name, len(raw), 0, len(raw)), b'"'))
    assert len(whole) == 41
    for size in (1, 2, 5, 33, 200, len(raw) - 1):
        parts = [FileRange(r.file, r.size, r.start, r.stop, raw[: r.start].count(b'"') % 2 == 1) for r in split_files([(name, len(raw))], size)]
        assert [x for r in parts for x in text_records(r, b'"', block)] == whole


@pytest.mark.parametrize("seed", range(4))
def test_xml_elements_of_any_ranges(tmp_path, seed):
    size = xml_file(tmp_path / "f.xml", seed)
    name = str(tmp_path / "f.xml")
    whole = list(xml_elements(FileRange(name, size, 0, size), "Workout"))
    assert 10 < len(whole) < 30
    for step in (60, 97, 1000):
        found = [x for r in split_files([(name, size)], step) for x in xml_elements(r, "Workout", 11)]
        assert [x for x in found if x in whole] == whole and all(b"</Workout>" not in x[1][:9] for x in found)


@pytest.mark.parametrize("block", [1, 5, 64, 4096])
def test_an_element_may_end_with_the_file(tmp_path, block):
    text = b"<Workout a='1'><S/></Workout><Workout b='2'></Workout>"
    (tmp_path / "f.xml").write_bytes(text)
    found = [x for _, x in xml_elements(FileRange(str(tmp_path / "f.xml"), len(text), 0, len(text)), "Workout", block)]
    assert b"".join(found) == text and len(found) == 2


def test_broken_xml_raises(tmp_path):
    (tmp_path / "f.xml").write_text("<H><Workout a='1'><S/>")
    with pytest.raises(ValueError, match="does not end"):
        list(xml_elements(FileRange(str(tmp_path / "f.xml"), 22, 0, 22), "Workout"))


def test_parity_is_counted_in_tasks(spark, tmp_path):
    raw = csv_file(tmp_path / "a.csv", 1, rows=200)
    other = csv_file(tmp_path / "b.csv", 2, rows=5)
    files = [(str(tmp_path / "a.csv"), len(raw)), (str(tmp_path / "b.csv"), len(other))]
    ranges = quoted_starts(spark, split_files(files, 300), b'"')
    assert len(ranges) > 10 and any(r.quoted for r in ranges)
    for r in ranges:
        assert r.quoted == ((raw if r.file.endswith("a.csv") else other)[: r.start].count(b'"') % 2 == 1)
    df = read_text_records(spark, files, range_bytes=300, encoding="latin-1")
    assert df.rdd.getNumPartitions() == len(pack_ranges(ranges, 300)) > 10
    assert df.count() == 201 + 6


@pytest.mark.parametrize("seed", [1, 2])
def test_csv_equals_sparks_reader(spark, tmp_path, seed):
    folder = tmp_path / "2025-08-22"
    folder.mkdir()
    csv_file(folder / "Activities.csv", seed, rows=300)
    want = (spark.read.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").option("escape", '"').option("multiLine", True)
            .csv(str(folder)).select(F.col("Activity Type").alias("activity_type"), "Title", F.col("Date").alias("date")).collect())
    for size in (100, 1 << 20):
        got = exports.import_garmin_activities(spark, f"{folder}/*.csv", position=True, range_bytes=size)
        ordered = got.orderBy(exports.POSITION).collect()
        # a lone line break inside quotes is read as it stands
        assert [(r["activity_type"], r["Title"], r["date"]) for r in ordered] == [tuple(r) for r in want]
        assert {r["export_date"] for r in ordered} == {"2025-08-22"}


def test_xml_equals_sparks_reader(spark, tmp_path):
    folder = tmp_path / "2025-08-22"
    folder.mkdir()
    xml_file(folder / "Export.xml", 3, workouts=200)
    whole = spark.read.format("xml").option("rowTag", "Workout").schema(exports.WORKOUT_SCHEMA).load(str(folder))
    want = sorted(exports.workouts_from_xml_frame(whole, F.lit("2025-08-22")).collect())
    for size in (500, 1 << 20):
        got = exports.import_apple_workouts(spark, f"{folder}/*.xml", range_bytes=size)
        assert sorted(got.collect()) == want
    assert got.rdd.getNumPartitions() == 1 and exports.import_apple_workouts(spark, f"{folder}/*.xml", range_bytes=500).rdd.getNumPartitions() > 20


def test_headers_and_empty_files(spark, tmp_path):
    for day, text in (("a", ""), ("b", "Date;;Date\n1;2;3\n\n4;5\n"), ("c", "\"Da\nte\";Time\n\"x\ny\";2")):
        (tmp_path / day).mkdir()
        (tmp_path / day / "f.csv").write_text(text)
    got = exports.import_garmin_activities(spark, f"{tmp_path}/*/f.csv")
    assert got.columns == ["Date0", "_c1", "Date2", "source", "export_date", "Da\nte", "duration"]
    assert sorted(map(str, got.drop("source").collect())) == sorted(map(str, got.drop("source").collect()))
    rows = {(r["export_date"], r["Date0"], r["_c1"], r["Date2"], r["Da\nte"], r["duration"]) for r in got.collect()}
    assert rows == {("b", "1", "2", "3", None, None), ("b", "4", "5", None, None, None), ("c", None, None, None, "x\ny", "2")}


def test_small_ranges_share_tasks(spark, tmp_path):
    """Tasks grow with the cores, not with the ranges of a large file."""
    size = xml_file(tmp_path / "f.xml", 3, workouts=600)
    files = [(f"file:{tmp_path}/f.xml", size)]
    whole = read_xml_elements(spark, files, "Workout").orderBy("start").collect()
    cut = read_xml_elements(spark, files, "Workout", range_bytes=100)
    assert len(split_files(files, 100)) > 500 and cut.rdd.getNumPartitions() <= 17 * spark.sparkContext.defaultParallelism
    assert cut.orderBy("start").collect() == whole


def test_blocks_are_no_longer_than_their_range(tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_bytes(b"abc;def\n" * 200_000)
    asked = []
    init = ranges_module._Bytes.__init__
    monkeypatch.setattr(ranges_module._Bytes, "__init__", lambda self, r, position, block: (asked.append(block), init(self, r, position, block))[1])
    assert len(list(text_records(FileRange(str(tmp_path / "f.csv"), 1_600_000, 800, 1600), b'"'))) == 100
    assert asked == [800 + ranges_module.BEYOND]


def test_compressed_files_are_read_whole(spark, tmp_path):
    (tmp_path / "plain" / "2025-01-01").mkdir(parents=True)
    (tmp_path / "packed" / "2025-01-01").mkdir(parents=True)
    for i in range(3):
        xml_file(tmp_path / f"plain/2025-01-01/f{i}.xml", i)
        csv_file(tmp_path / f"plain/2025-01-01/f{i}.csv", i)
        for kind in ("xml", "csv"):
            raw = (tmp_path / f"plain/2025-01-01/f{i}.{kind}").read_bytes()
            # two members, as appended files have
            (tmp_path / f"packed/2025-01-01/f{i}.{kind}.gz").write_bytes(gzip.compress(raw[:500]) + gzip.compress(raw[500:]))
    for size in (300, 64 << 20):
        want = exports.import_apple_workouts(spark, f"{tmp_path}/plain/*/*.xml")
        got = exports.import_apple_workouts(spark, f"{tmp_path}/packed/*/*.xml.gz", range_bytes=size)
        assert want.count() > 30 and sorted(got.collect()) == sorted(want.collect())
        want = exports.import_garmin_activities(spark, f"{tmp_path}/plain/*/*.csv").collect()
        got = exports.import_garmin_activities(spark, f"{tmp_path}/packed/*/*.csv.gz", range_bytes=size).collect()
        assert len(want) > 100 and sorted(map(str, got)) == sorted(map(str, want))


def test_export_folder_of_any_path(spark):
    paths = ["file:/a/2025-01-01/f.xml", "s3://b/f.xml", "d/f", "/f", "f", "", "a//f", "a/b/", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(exports.export_folder("p")).collect()] == \
        [r[0] for r in df.select(F.regexp_extract("p", r"([^/]+)/[^/]+$", 1)).collect()]
    assert "regexp" not in df.select(exports.export_folder("p"))._jdf.queryExecution().analyzed().toString()


@pytest.fixture(scope="module")
def few_lines(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lines"))
    n = F.col("id")
    spark.range(500).select(
        (n * 97).alias("l_orderkey"), (n % 90).alias("l_partkey"), (n % 7).alias("l_suppkey"), (n % 7 + 1).cast("int").alias("l_linenumber"),
        (n % 50).cast("double").alias("l_quantity"), F.lit(0.0).alias("l_discount"), F.lit(0.02).alias("l_tax"), F.lit("A").alias("l_returnflag"),
        F.lit("2025-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize("kind", ["xml", "csv"])
def test_export_files_grow_in_number(spark, few_lines, kind):
    """No file, and so no task that writes one, holds much more than the rows asked for."""
    write = queries._write_xml_exports if kind == "xml" else queries._write_garmin_exports
    root = write(spark, few_lines, files=2, most_rows=100)
    files = list_files(spark, f"{root}/*/*.{kind}{'.gz' if kind == 'xml' else ''}")
    assert len(files) == 10  # five a folder
    read = exports.import_apple_workouts(spark, f"{root}/*/*.xml.gz") if kind == "xml" else exports.import_garmin_activities(spark, f"{root}/*/*.csv")
    assert read.count() == 1000
    assert len(list_files(spark, f"{write(spark, few_lines, files=2)}/*/*.{kind}*")) == 4


def blocks_file(path, text, block, piece):
    """The text in Hadoop's Snappy blocks of several pieces, an empty block among them."""
    codec, out = pa.Codec("snappy"), []
    for at in range(0, len(text), block):
        body = text[at : at + block]
        pieces = [codec.compress(body[i : i + piece], asbytes=True) for i in range(0, len(body), piece)]
        out += [len(body).to_bytes(4, "big"), *[x for p in pieces for x in (len(p).to_bytes(4, "big"), p)], bytes(4) if at == block else b""]
    path.write_bytes(b"".join(out))


@pytest.mark.parametrize(("block", "piece"), [(70, 70), (200, 33), (1 << 20, 1 << 20)])
def test_files_of_blocks_are_read_by_ranges(spark, tmp_path, monkeypatch, block, piece):
    monkeypatch.setattr(ranges_module, "LEAST_RANGE", 50)
    for i in range(3):
        xml_file(tmp_path / f"{i}.xml", i)
        blocks_file(tmp_path / f"{i}.xml.snappy", (tmp_path / f"{i}.xml").read_bytes(), block, piece)
    (tmp_path / "empty.xml.snappy").write_bytes(b"")
    plain = [tuple(r) for r in read_xml_elements(spark, list_files(spark, f"{tmp_path}/*.xml"), "Workout", 1 << 20).collect()]
    files = list_files(spark, f"{tmp_path}/*.snappy")
    for size in (60, 500, 1 << 20):
        got = [tuple(r) for r in read_xml_elements(spark, files, "Workout", size).collect()]
        whole = {(f.removesuffix(".snappy"), start, text) for f, start, text in got}
        # elements inside a comment are only passed over where their range holds its start
        assert whole >= set(plain) and all(text.startswith("<Workout") for _, _, text in got) and len(got) == len(whole)
        assert size < 1 << 20 or len(got) == len(plain)
    starts = ranges_module.block_starts(spark, files)
    cut = split_files([(f, int(x[0, -1])) for f, x in starts.items()], 60, {f: x[:, :-1] for f, x in starts.items()})
    assert len(starts) == 3 and (len(cut) > 30) == (block < 1 << 20)


def test_a_single_export_is_written_in_blocks_and_read_by_ranges(spark):
    root = queries._write_xml_exports(spark, "/root/testdata/sf0.001", files=1, compression="snappy")
    files = list_files(spark, f"{root}/*/*.xml.snappy")
    plain = queries._write_xml_exports(spark, "/root/testdata/sf0.001", files=1, compression="none")
    assert len(files) == 2 and 4 * sum(size for _, size in files) < sum(size for _, size in list_files(spark, f"{plain}/*/*.xml"))
    got, want = (sorted(r["record"] for r in read_xml_elements(spark, list_files(spark, f"{x}/*/*.xml*"), "Workout", 1 << 20).collect()) for x in (root, plain))
    assert got == want and len(got) > 6000
