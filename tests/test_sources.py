"""Readers: the reference's CSV layouts (FIXTURES.md §3.3) and format round trips."""

from placerank import operators as op
import pytest

from placerank.sources import LISTING_COLUMNS, REVIEW_COLUMNS, read_listings, read_posts, write_table


def _write(path, text):
    with open(path, "wb") as f:
        f.write(text.encode("utf-8"))


def test_reviews_csv_with_bom_quotes_and_newlines(spark, tmp_path):
    csv = (
        '\ufeff"Destination","District","Timespan","Review"\n'
        'Lakeside,North,2 years ago,"Great view,\nsecond line"\n'
        'Hilltop,Hilltop,a year ago,"She said ""wow"""\n'
        'Harbour,,3 months ago,\n'
        'Bay,South,"",ok\n'
    )
    path = str(tmp_path / "reviews.csv")
    _write(path, csv)
    df = read_posts(spark, path, fmt="csv", columns=REVIEW_COLUMNS, multiline=True)
    assert df.columns == ["post_id", "item", "grp", "period", "text"]
    got = {r.item: r for r in df.collect()}
    assert set(got) == {"Lakeside", "Hilltop", "Harbour", "Bay"}
    assert got["Lakeside"].text == "Great view,\nsecond line"
    assert got["Hilltop"].text == 'She said "wow"'
    assert got["Harbour"].grp is None and got["Harbour"].text is None
    assert got["Bay"].period in (None, "")
    assert df.select("post_id").distinct().count() == 4


def test_listings_csv_messy_headers_then_clean(spark, tmp_path):
    csv = (
        '\ufeff name ,"roomType", numberOfGuests ,"stars"\n'
        'Villa,Entire villa, 4 guests ,4.8\n'
        'Room,Private room,n/a,4.5\n'
        'Hotel,Hotel room,2, 3.9 \n'
    )
    path = str(tmp_path / "listings.csv")
    _write(path, csv)
    raw = read_listings(spark, path, fmt="csv", columns=LISTING_COLUMNS, multiline=True)
    assert raw.columns == ["listing_id", "name", "room_type", "guests_raw", "stars_raw"]
    clean = op.clean_listings(raw)
    got = sorted((r.name, r.guests, round(r.stars, 2)) for r in clean.collect())
    assert got == [("Hotel", 2, 3.9), ("Villa", 4, 4.8)]


def test_parquet_round_trip(spark, posts, tmp_path):
    path = str(tmp_path / "posts_parquet")
    write_table(posts, path, partition_by=["grp"])
    back = read_posts(spark, path)
    assert back.columns == posts.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, posts.collect()))


def test_json_reader(spark, posts, tmp_path):
    path = str(tmp_path / "posts_json")
    write_table(posts, path, fmt="json")
    back = read_posts(spark, path, fmt="json")
    assert back.count() == 5 and back.schema == posts.schema


def test_single_line_csv_is_splittable(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    lines = ["Destination,District,Timespan,Review"] + [f"p{i % 7},d{i % 3},1 day ago,text {i}" for i in range(20000)]
    _write(path, "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        split = read_posts(spark, path, fmt="csv", columns=REVIEW_COLUMNS, multiline=False)
        whole = read_posts(spark, path, fmt="csv", columns=REVIEW_COLUMNS, multiline=True)
        assert split.rdd.getNumPartitions() > 1 and whole.rdd.getNumPartitions() == 1
        assert split.count() == whole.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_orc_round_trip(spark, posts, tmp_path):
    path = str(tmp_path / "posts_orc")
    write_table(posts, path, fmt="orc")
    back = read_posts(spark, path, fmt="orc")
    assert back.schema == posts.schema
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, posts.collect()))


def test_missing_columns_and_an_unsaid_multiline_are_errors(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text("Place,Region,When,Comment\nA,X,now,good\n")
    with pytest.raises(ValueError, match="item"):
        read_posts(spark, str(path), fmt="csv", multiline=True)
    with pytest.raises(ValueError, match="multiline"):
        read_posts(spark, str(path), fmt="csv", columns=REVIEW_COLUMNS)


def test_made_ids_do_not_depend_on_the_splits(spark, tmp_path):
    path = tmp_path / "listings.csv"
    lines = "".join(f"place {i},Entire villa,2,4.5\n" for i in range(400))
    path.write_text("name,roomType,numberOfGuests,stars\n" + lines)
    top = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            raw = read_listings(spark, str(path), fmt="csv", columns=LISTING_COLUMNS, multiline=False)
            top.append([tuple(r) for r in raw.orderBy("listing_id").limit(10).collect()])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert top[0] == top[1]
