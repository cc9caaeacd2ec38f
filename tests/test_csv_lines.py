"""CSV files with line breaks in quoted values, read in splits, against Python's csv module; file order and first errors."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.apps import main
from tidemark.operators import summary, validate
from tidemark.plans import queries as Q
from tidemark.schema import EVENT_COLUMNS
from tidemark.sources import csv_events, csv_lines

HEADER = list(EVENT_COLUMNS)


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def event(r, i):
    text = lambda: r.choice(["a", "", 'q"uo"te', "two\nlines", "\n", "x,\n\ny", '"', "é\r\nend", 'say "hi"\nand\n"bye"', "tail\n"])
    return ["2024-01-01 00:00:%02d UTC" % (i % 60), "view", str(i), "7", text(), text(), "1.50", str(i % 9), text()]


def write(path, rows, end="\n", header=HEADER):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerows([header, *rows])
    path.write_bytes(out.getvalue().encode())


def expected(rows):
    none = lambda v: v or None
    return sorted((int(x[2]), none(x[4]), none(x[5]), x[8]) for x in rows)


def read(spark, path, **kw):
    good = validate.split(csv_events.read_csv_events(spark, str(path), multi_line=True, **kw)).good
    return sorted((r.product_id, r.category_code, r.brand, r.user_session) for r in good.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_many_tasks(spark, tmp_path, small_splits, end):
    r = random.Random(3)
    rows = [event(r, i) for i in range(300)]
    write(tmp_path / "a.csv", rows, end)
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path / "a.csv"))
    assert lines.rdd.getNumPartitions() >= 20
    assert read(spark, tmp_path / "a.csv") == expected(rows)


def test_many_files_headers_and_a_value_over_many_splits(spark, tmp_path, small_splits):
    r = random.Random(4)
    all_rows = []
    for k in range(3):
        rows = [event(r, 1000 * k + i) for i in range(40)]
        rows[20][5] = "\n".join(f"line {j} of a long value" for j in range(200))  # some 4 kB: six splits
        write(tmp_path / f"{k}.csv", rows, header=["multi\nline", *HEADER[1:]] if k == 1 else HEADER)
        all_rows += rows
    (tmp_path / "blank.csv").write_text(",".join(HEADER) + "\n\n   \n\n")
    (tmp_path / "empty.csv").write_text("")
    assert read(spark, tmp_path) == expected(all_rows)


def test_as_the_whole_file_reader(spark, tmp_path):
    r = random.Random(5)
    rows = [event(r, i) for i in range(120)] + [["x"] * 3, ["2024-13-01 00:00:00 UTC", *event(r, 7)[1:]], [*event(r, 8), "more", "columns"]]
    write(tmp_path / "a.csv", rows)
    split = csv_events.read_csv_events(spark, str(tmp_path), multi_line=True)
    whole = csv_events.type_csv(csv_events.csv_reader(spark, multi_line=True).csv(str(tmp_path)))
    key = lambda df: sorted(map(str, df.drop("raw_record").collect()))
    assert key(split) == key(whole)


def test_quotes_that_are_never_closed(spark, tmp_path, small_splits):
    r = random.Random(6)
    rows = [event(r, i) for i in range(30)]
    write(tmp_path / "a.csv", rows)
    with open(tmp_path / "a.csv", "a") as f:
        f.write('2024-01-01 00:00:00 UTC,view,999,7,"open\n' + "".join(f"line {i}\n" for i in range(50)))
    checked = csv_events.read_csv_events(spark, str(tmp_path), multi_line=True)
    good, rejects = validate.split(checked)
    assert sorted(x.product_id for x in good.collect()) == list(range(30))
    (bad,) = rejects.collect()
    assert bad.raw_record.count("\n") >= 50 and bad.reject_reason == "short_row"
    # beyond the bound nothing is gathered: each line is rejected by itself, none is lost
    short = csv_lines.csv_records(spark, str(tmp_path), max_lines=20)
    assert short.where("not closed").count() == 51 and short.where("closed").count() == 30


def test_order_of_files_and_first_error(spark, tmp_path, small_splits):
    r = random.Random(7)
    rows = [event(r, i) for i in range(200)]
    rows[130][1] = rows[150][1] = "refund"
    write(tmp_path / "a.csv", rows[:90])
    write(tmp_path / "b.csv", rows[90:])
    for multi in (True,):
        checked = csv_events.read_csv_events(spark, str(tmp_path), multi_line=multi, position=True)
        assert [x.product_id for x in summary.preview(checked, 7, ("position",)).collect()] == list(range(7))
        good, bad = validate.until_first_error(checked)
        assert sorted(x.product_id for x in good.collect()) == list(range(130)) and bad.reject_reason == "unknown_event_type"
    plain = [[c.replace("\n", " ").replace("\r", "").replace('"', "") for c in x] for x in rows]
    (tmp_path / "plain").mkdir()
    write(tmp_path / "plain" / "a.csv", plain)
    checked = csv_events.read_csv_events(spark, str(tmp_path / "plain"), position=True)
    assert checked.rdd.getNumPartitions() > 10
    assert [x.product_id for x in summary.preview(checked, 7, ("position",)).collect()] == list(range(7))
    assert sorted(x.product_id for x in validate.until_first_error(checked)[0].collect()) == list(range(130))
    clean, none = validate.until_first_error(checked.where("product_id < 100"))
    assert none is None and clean.count() == 100


def test_a_run_that_stops_has_published_what_came_before(spark, tmp_path):
    rows = [["2024-01-01 00:00:%02d UTC" % i, "view", str(i), "7", "c", "b", "1", "1", "s"] for i in range(20)]
    rows[12][6] = "much"
    (tmp_path / "csv").mkdir()
    write(tmp_path / "csv" / "a.csv", rows)
    args = ["replay-csv", "--csv", str(tmp_path / "csv"), "--topic-dir", str(tmp_path / "topic"), "--on-error", "fail",
            "--checkpoint", str(tmp_path / "ck")]
    for _ in range(2):  # again: the same micro-batch, the same files
        with pytest.raises(Exception, match="bad_price"):
            main(args, spark)
        values = [json.loads(x.value) for x in spark.read.json(str(tmp_path / "topic")).collect()]
        assert sorted(v["productId"] for v in values) == list(range(12))


def test_preview_shows_the_first_rows_of_the_file(spark, tmp_path, capsys):
    rows = [["2024-01-01 00:00:%02d UTC" % (59 - i), "view", str(i), "7", "c", "b", "1", "1", "s"] for i in range(20)]
    write(tmp_path / "a.csv", rows)
    main(["preview-csv", "--csv", str(tmp_path / "a.csv"), "--rows", "3"], spark)
    shown = capsys.readouterr().out.strip().splitlines()
    assert [f"product_id={i}" in line for i, line in enumerate(shown[:3])] == [True] * 3


def test_rows_that_read_positions(spark):
    sf = "/root/testdata/sf0.001"
    first = [x.event_id for x in Q.events_preview(spark, sf).collect()]
    assert first == sorted(first) and len(first) == 10
    assert 0 < Q.csv_until_first_error(spark, sf).count() < Q.valid_events(spark, sf).count()
    assert Q.csv_multiline_ingest(spark, sf).where(F.contains("brand", F.lit("\n"))).count() > 100
