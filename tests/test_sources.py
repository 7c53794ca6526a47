import gzip
from pathlib import Path

from pyspark.sql.types import LongType, StringType, StructField, StructType

from palaver import schemas
from palaver.operators.staging import conform, feeds_are_empty, run_sizes, run_slice, tag_activity, tag_events
from palaver.sources import delimited, feeds, lookups
from palaver.sources.feeds import feed_file
from tests.helpers import activity, bag, events, rows

AB = StructType([StructField("a", LongType()), StructField("b", StringType())])


def write(path: Path, text: str, encoding: str = "utf-8") -> str:
    path.write_text(text, encoding=encoding)
    return str(path)


def gz(folder: Path, name: str, header: list[str], *lines: list) -> None:
    text = "\n".join("\t".join(map(str, row)) for row in [header, *lines]) + "\n"
    (folder / name).write_bytes(gzip.compress(text.encode()))


BAD = "a;b\n1;x\nbad;y\n3;z;q\n4\n5;w\n"


def test_malformed_records_are_dropped_whatever_is_selected(spark, tmp_path):
    df = delimited.read_delimited(spark, write(tmp_path / "f.csv", BAD), AB, delimited.SEMICOLONS)
    assert rows(df) == bag((1, "x"), (5, "w"))
    assert rows(df, "b") == bag(("x",), ("w",))
    assert df.count() == 2


def test_malformed_records_are_quarantined(spark, tmp_path):
    path = write(tmp_path / "f.csv", BAD)
    df = delimited.read_delimited(spark, path, AB, delimited.SEMICOLONS, bad_records_path=str(tmp_path / "bad"))
    assert df.count() == 2
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert {r[0] for r in bad.select(delimited.MALFORMED).collect()} == {"bad;y", "3;z;q", "4"}
    assert all(r[0].endswith("f.csv") for r in bad.select("_source_file").collect())


def test_text_is_parsed_once_for_the_rows_and_the_quarantine(spark, tmp_path):
    path, bad = write(tmp_path / "f 1.csv", BAD), str(tmp_path / "bad")
    other = write(tmp_path / "g.csv", "a;b\n7;y\nworse\n")
    df = delimited.read_delimited(spark, [path, other], AB, delimited.SEMICOLONS, bad_records_path=bad)
    assert rows(df) == rows(delimited.read_delimited(spark, [path, other], AB, delimited.SEMICOLONS)) == bag((1, "x"), (5, "w"), (7, "y"))
    assert "Scan csv" not in df._jdf.queryExecution().toString() and all(x.endswith(".parquet") for x in df.inputFiles())
    stored = rows(spark.read.parquet(bad))
    delimited.read_delimited(spark, [path, other], AB, delimited.SEMICOLONS, bad_records_path=bad)
    assert rows(spark.read.parquet(bad)) == stored and len(stored) == 4
    # a file without malformed records leaves the quarantine; the other file's stay
    write(tmp_path / "f 1.csv", "a;b\n1;x\n")
    spark.catalog.refreshByPath(path)
    assert rows(delimited.read_delimited(spark, path, AB, delimited.SEMICOLONS, bad_records_path=bad)) == bag((1, "x"))
    assert [r[0] for r in spark.read.parquet(bad).select(delimited.MALFORMED).collect()] == ["worse"]


def test_feeds_keep_their_tags_with_a_quarantine(spark, tmp_path):
    names = schemas.EVENTS.names
    numbers = [i for i, f in enumerate(schemas.EVENTS) if f.dataType.typeName() != "string"]
    good = "\t".join("1" if i in numbers else "x" for i in range(len(names)))
    (tmp_path / "in").mkdir()
    for natco in ("mt", "cg"):
        with gzip.open(tmp_path / "in" / feeds.feed_file("events", "2024-01-02", natco), "wt") as out:
            out.write("\n".join(["\t".join(names), good, good + "\ttoo many", ""]))
    plain = feeds.read_feed(spark, str(tmp_path / "in"), "events")
    split = feeds.read_feed(spark, str(tmp_path / "in"), "events", bad_records_path=str(tmp_path / "bad"))
    assert split.columns == plain.columns and rows(split) == rows(plain)
    assert rows(split, "NatCo", "FileDate") == bag(("mt", "2024-01-02"), ("cg", "2024-01-02"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_header_only_file_is_empty_with_its_schema(spark, tmp_path):
    df = delimited.read_delimited(spark, write(tmp_path / "f.csv", "a;b\n"), AB, delimited.SEMICOLONS)
    assert df.schema == AB and df.isEmpty()


def test_encoding_quotes_and_line_breaks(spark, tmp_path):
    text = 'a;b\n1;"é;""q"""\n2;"two\nlines"\n'.replace('""', '\\"')
    dialect = delimited.Dialect(delimiter=";", encoding="ISO-8859-1", multiLine=True)
    path = write(tmp_path / "f.csv", text, "latin-1")
    assert rows(delimited.read_delimited(spark, path, AB, dialect)) == bag((1, 'é;"q"'), (2, "two\nlines"))


def test_nulls_blanks_and_quotes_survive(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (None, ' " '), (3, "a;b\\"), (4, "\\N")], AB)
    path = str(tmp_path / "out")
    delimited.write_delimited(df, path, delimited.SEMICOLONS)
    assert rows(delimited.read_delimited(spark, path, AB, delimited.SEMICOLONS)) == rows(df)


def test_empty_text_is_told_from_null_in_the_file(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "")], AB)
    path = str(tmp_path / "out")
    delimited.write_delimited(df.coalesce(1), path, delimited.SEMICOLONS)
    (part,) = Path(path).glob("part-*")
    assert part.read_text().splitlines() == ["a;b", "1;", '2;""']
    delimited.write_delimited(df.coalesce(1), path, null_value="NULL", empty_value="-", quote_all=True)
    (part,) = Path(path).glob("part-*")
    assert sorted(part.read_text().splitlines()) == ['"1","NULL"', '"2","-"', '"a","b"']


def test_writer_overwrites_and_sorts_over_its_files(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(50).selectExpr("id AS a", "cast(49 - id AS string) AS b").repartition(7)
    delimited.write_delimited(df, path)
    delimited.write_delimited(df, path, sort_by=["a"])
    lines = [line for part in sorted(Path(path).glob("part-*")) for line in part.read_text().splitlines()[1:]]
    assert lines == [f"{i},{49 - i}" for i in range(50)]


def test_several_files_in_one_scan(spark, tmp_path):
    for name, row in (("one.csv", "1,x"), ("two.csv", "2,y"), ("other.csv", "3,z")):
        write(tmp_path / name, f"a,b\n{row}\n")
    assert rows(delimited.read_many(spark, str(tmp_path), ["one.csv", "two.csv"], AB)) == bag((1, "x"), (2, "y"))


ACTIVITY_ROW = ["id1", "b1", "bot@h", "u1", "MT", "2024-01-02T10:00:00", "text_message", 10]


def test_feed_files_by_name(spark, tmp_path):
    names = schemas.ACTIVITY.names
    gz(tmp_path, feed_file("activity", "2024-01-02", "mt"), names, ACTIVITY_ROW)
    gz(tmp_path, feed_file("activity", "2024-01-03", "cg"), names, ACTIVITY_ROW, ACTIVITY_ROW)
    gz(tmp_path, feed_file("activity", "2024-01-04", "mt"), names)
    gz(tmp_path, feed_file("events", "2024-01-02", "mt"), schemas.EVENTS.names, ["e1"] + ["1"] * 14)
    every = feeds.read_feed(spark, str(tmp_path), "activity")
    assert every.columns == [*names, "NatCo", "FileDate"]
    assert rows(every, "NatCo", "FileDate") == bag(("mt", "2024-01-02"), ("cg", "2024-01-03"), ("cg", "2024-01-03"))
    one = feeds.read_feed(spark, str(tmp_path), "activity", ["2024-01-02"], ["mt"])
    assert rows(one) == bag((*ACTIVITY_ROW, "mt", "2024-01-02"))
    billed = feeds.read_feed(spark, str(tmp_path), "events")
    assert rows(billed, "billing_event_id", "duration", "NatCo") == bag(("e1", 1, "mt"))


def test_landed_feed_replaces_only_its_slices(spark, tmp_path):
    path = str(tmp_path / "landed")
    day1, day2 = ("2024-01-01", "mt"), ("2024-01-02", "cg")
    feeds.land_feed(activity(spark, {"run": day1}, {"run": day2, "user_id": "old"}), path)
    landed = feeds.land_feed(activity(spark, {"run": day2, "user_id": "new"}), path)
    assert rows(landed, "FileDate", "NatCo", "user_id") == bag(("2024-01-01", "mt", "u1"), ("2024-01-02", "cg", "new"))
    slice_ = run_slice(landed, "2024-01-02", ["cg", "mt"])
    assert rows(slice_, "user_id") == bag(("new",))
    plan = slice_._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [FileDate" in plan


def test_lookups_from_files_equal_the_built_in_rows(spark, tmp_path):
    for name, table in (
        (lookups.NATCO_FILE, lookups.natcos(spark)),
        (lookups.CONVERSATION_TYPE_FILE, lookups.conversation_types(spark)),
        (lookups.CONTENT_FILE, lookups.content_mapping(spark)),
    ):
        lines = [";".join(table.columns)] + [";".join(map(str, r)) for r in table.collect()]
        write(tmp_path / name, "\n".join(lines))
    folder = str(tmp_path)
    assert rows(lookups.natcos(spark, folder)) == rows(lookups.natcos(spark))
    assert rows(lookups.conversation_types(spark, folder)) == rows(lookups.conversation_types(spark))
    contents = lookups.content_mapping(spark, folder)
    assert rows(contents) == rows(lookups.content_mapping(spark))
    assert (1, "file_transfer", " File Transfer") in rows(contents)


def test_accumulators_by_glob(spark, tmp_path):
    for natco in ("mt", "cg"):
        write(
            tmp_path / f"acc_users_daily_{natco}.csv",
            f"FileDate;Date;NatCo;AgentID;user_id\n2024-01-02;2024-01-01;{natco};;007\n",
        )
    found = rows(feeds.read_accumulators(spark, str(tmp_path)))
    assert found == bag(("2024-01-02", "2024-01-01", "mt", None, "007"), ("2024-01-02", "2024-01-01", "cg", None, "007"))


def test_tags_and_guard(spark):
    a, e = activity(spark, {}).drop("NatCo", "FileDate"), events(spark, {}).drop("NatCo", "FileDate")
    assert rows(tag_activity(a, "cg"), "NatCo") == bag(("cg",))
    assert rows(tag_events(e, "cg", "2024-01-05"), "NatCo", "FileDate") == bag(("cg", "2024-01-05"))
    none = a.filter("false")
    assert feeds_are_empty(none, e.filter("false"))
    assert not feeds_are_empty(none, e) and not feeds_are_empty(a, e.filter("false"))


def test_run_sizes(spark):
    a, e = activity(spark, {}, {}), events(spark, {"run": ("2024-01-03", "mt")})
    wanted = spark.sql("SELECT * FROM VALUES (DATE'2024-01-02','mt'),(DATE'2024-01-03','mt'),(DATE'2024-01-03','cg') t(FileDate,NatCo)")
    assert rows(run_sizes(wanted, a, e)) == bag(
        ("2024-01-02", "mt", 2, 0, True), ("2024-01-03", "mt", 0, 1, True), ("2024-01-03", "cg", 0, 0, False)
    )


def test_conform_orders_and_types_columns(spark):
    df = spark.sql("SELECT '5' AS NatCoID, 'mt' AS NatCo, 1 AS more UNION ALL SELECT 'x', 'cg', 2")
    found = conform(df, schemas.NATCO)
    assert found.columns == ["NatCo", "NatCoID"]
    assert rows(found) == bag(("mt", 5), ("cg", None))
