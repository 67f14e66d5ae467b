"""One file read by many tasks equals the one-task reader."""

from __future__ import annotations

import csv
import io
import random

import pytest
from conftest import rows

from stacklore import schemas
from stacklore.sources import csv_drop
from stacklore.sources.split_csv import csv_records

HEADER = "category_id,category_name,extracted_at"


@pytest.fixture
def small_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def field(rng, long):
    parts = ["a", "é", " ", ",", '"', '""', "\n", "\r\n", "\n\n", "NULL", "x" * 30, "日本", "'", "\\"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 12) if not long else rng.randint(2000, 4000)))


def one_task(spark, path):
    """The multi-line reader: one task for a whole file."""
    raw = spark.read.options(**csv_drop.CSV_OPTIONS, multiLine=True, mode="FAILFAST").schema("c0 string, c1 string, c2 string").csv(path)
    return sorted((tuple(r) for r in raw.collect()), key=repr)


def records(spark, path):
    parsed = csv_drop.F.from_csv("record", "c0 string, c1 string, c2 string", csv_drop.PARSE_OPTIONS)
    found = csv_records(spark, [path], csv_drop.FILE_OPTIONS).select(csv_drop.F.inline(csv_drop.F.array(parsed)))
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_many_tasks_read_what_one_reads(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    ends = "\r\n" if seed == 5 else "\n"
    for name in ("a.csv", "sub/b.csv"):
        out = io.StringIO()
        writer = csv.writer(out, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator=ends)
        # The one-task reader takes the first line end it meets for that of the records.
        writer.writerow(["id", "a\nname" * (1 + 400 * (seed == 3)) if seed != 5 else "name", "at"])
        for i in range(300):
            writer.writerow([i, field(rng, long=rng.random() < 0.02), rng.choice(["", "x", "a\nb", '"'])])
        text = out.getvalue()
        path = tmp_path / "t" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes((text if seed % 2 else text.removesuffix(ends)).encode())
    found = records(spark, f"{tmp_path}/t")
    if seed == 5:
        # That reader rewrites such line ends within quotes too; here they stay.
        texts = [(tmp_path / "t" / n).read_bytes().decode() for n in ("a.csv", "sub/b.csv")]
        want = [tuple(v or None for v in r) for t in texts for r in list(csv.reader(io.StringIO(t, newline="")))[1:]]
        assert sorted((tuple(v or None for v in r) for r in found), key=repr) == sorted(want, key=repr)
        return
    assert found == sorted(one_task(spark, f"{tmp_path}/t/a.csv") + one_task(spark, f"{tmp_path}/t/sub/b.csv"), key=repr)
    assert len(found) == 600


def test_one_file_is_many_tasks(spark, tmp_path, small_ranges):
    body = "".join(f'{i},"line {i}\nand ""quoted"" more",2024-01-01T10:00:00+00:00\n' for i in range(2000))
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{body}")
    got = csv_drop.read_raw_csv(spark, str(tmp_path), schemas.RAW_CATEGORIES)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert got.count() == 2000
    assert {r.category_name for r in got.collect()} == {f'line {i}\nand "quoted" more' for i in range(2000)}


def test_a_field_over_many_ranges(spark, tmp_path, small_ranges):
    long = "word\n" * 5000
    (tmp_path / "a.csv").write_text(f'{HEADER}\n1,"{long}",\n2,b,\n')
    got = csv_drop.read_raw_csv(spark, str(tmp_path), schemas.RAW_CATEGORIES).drop(csv_drop.SOURCE_FILE)
    assert rows(got) == [(1, long, None), (2, "b", None)]


@pytest.mark.parametrize("text", ["", HEADER, f"{HEADER}\n", f"{HEADER}\n\n\n", f"{HEADER}\r\n\r\n"])
def test_files_without_records(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    assert csv_drop.read_raw_csv(spark, str(tmp_path), schemas.RAW_CATEGORIES).count() == 0


def test_missing_folder_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_drop.read_raw_csv(spark, f"{tmp_path}/none", schemas.RAW_CATEGORIES)
