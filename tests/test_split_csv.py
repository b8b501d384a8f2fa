"""CSV with quoted line breaks in many splits against Spark's multiLine reader."""

import random

import pytest
from pyspark.sql import functions as F

from placerank.sources import REVIEW_COLUMNS, csv_records, read_csv_in_splits, read_posts
from placerank.sources.readers import CSV_OPTIONS


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in names}
    yield lambda size: [spark.conf.set(names[0], size), spark.conf.set(names[1], 0)]
    for k, v in old.items():
        spark.conf.set(k, v)


def field(r):
    text = "".join(r.choice(["a", "bc", " ", ",", '"', "\n", "\n\n", "é", "x y", ""]) for _ in range(r.randint(1, 12))) or "z"
    if any(c in text for c in ',"\n') or r.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("size", [37, 256, 100_000])
def test_equals_the_multiline_reader(spark, small_splits, tmp_path, size):
    r = random.Random(size)
    for name in ("a.csv", "b.csv"):
        lines = ["h1,h2,h3"] + [",".join(["k" + str(i), field(r), field(r)]) for i in range(120)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    want = rows_of(spark.read.options(**CSV_OPTIONS, multiLine="true").csv(str(tmp_path)))
    small_splits(size)
    got = read_csv_in_splits(spark, str(tmp_path), CSV_OPTIONS)
    assert got.columns == ["h1", "h2", "h3"]
    assert len(want) == 240 and rows_of(got) == want


def test_a_record_over_many_splits(spark, small_splits, tmp_path):
    text = "\n".join(f"line {i}" for i in range(300))
    (tmp_path / "a.csv").write_text(f'h1,h2\nx,"{text}"\ny,"{text}"\n\nz,end')
    small_splits(64)
    got = rows_of(read_csv_in_splits(spark, str(tmp_path), CSV_OPTIONS))
    assert got == [("x", text), ("y", text), ("z", "end")]
    assert csv_records(spark, str(tmp_path)).where("first").count() == 1


def test_windows_line_ends_and_empty_files(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'h1,h2\r\nx,"one\r\ntwo"\r\n\r\ny,z\r\n')
    (tmp_path / "b.csv").write_text("h1,h2\n")
    small_splits(8)
    assert rows_of(read_csv_in_splits(spark, str(tmp_path), CSV_OPTIONS)) == [("x", "one\ntwo"), ("y", "z")]


def test_posts_of_the_review_layout(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('Destination,District,Timespan,Review\nA,X,2 years ago,"good\nplace, ""very"""\nB,,a year ago,\n')
    small_splits(20)
    df = read_posts(spark, str(tmp_path), fmt="csv", columns=REVIEW_COLUMNS, multiline="split")
    got = sorted(map(tuple, df.select("item", "grp", "period", "text").collect()))
    assert got == [("A", "X", "2 years ago", 'good\nplace, "very"'), ("B", None, "a year ago", None)]
    assert df.select(F.col("post_id")).distinct().count() == 2
    with pytest.raises(ValueError):
        read_posts(spark, str(tmp_path), fmt="csv", columns=REVIEW_COLUMNS)
