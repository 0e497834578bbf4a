"""Readers and writers on files made by the test."""

from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import DataFrameReader

from chartloom import errors
from chartloom.operators.price import clean_prices, missing_expected_columns
from chartloom.plans.clean_sample import EmptyResultError, process_file
from chartloom.plans.staging import kept, reused, staged
from chartloom.sources.json_documents import read_column_documents
from chartloom.sources.readers import read_table
from chartloom.sources.sinks import write_csv_file
from chartloom.sources.typed_csv import files_by_breaks, read_csv_with_rejects
from chartloom.streaming.prices import write_clean_prices


def put(folder, name, content):
    path = folder / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_typed_csv(spark, tmp_path):
    path = put(
        tmp_path, "T.CSV",
        'whole,part,truth,text,day,none,quoted\n1,1.5,True,a,2024-01-01,,"x ""y"", z"\n'
        "NA,n/a,False,NULL,2024-01-02,,q\n 3 ,nan,True,c,,,\n",
    )
    rows = read_table(spark, path)
    assert dict(rows.dtypes) == {
        "whole": "bigint", "part": "double", "truth": "boolean", "text": "string",
        "day": "string", "none": "double", "quoted": "string",
    }
    assert [tuple(r) for r in rows.collect()][:2] == [
        (1, 1.5, True, "a", "2024-01-01", None, 'x "y", z'),
        (None, None, False, None, "2024-01-02", None, "q"),
    ]


def test_untyped_csv_keeps_text(spark, tmp_path):
    rows = read_table(spark, put(tmp_path, "t.csv", "a,b\n1,NA\n"), typed=False)
    assert [tuple(r) for r in rows.collect()] == [("1", "NA")]


RECORDS = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]


def test_json_layouts(spark, tmp_path):
    array = read_table(spark, put(tmp_path, "array.json", json.dumps(RECORDS, indent=2)))
    lines = read_table(spark, put(tmp_path, "lines.json", "\n".join(map(json.dumps, RECORDS))))
    frame = pd.DataFrame(RECORDS).to_json()
    columns = read_table(spark, put(tmp_path, "columns.json", frame))
    for rows in (array, lines, columns):
        assert sorted((r["a"], r["b"]) for r in rows.collect()) == [(1, "x"), (2, None)]
        assert dict(rows.dtypes) == {"a": "bigint", "b": "string"}


def test_json_layout_can_be_named(spark, tmp_path):
    path = put(tmp_path, "c.json", '{"b": {"u": 1.5, "v": 2}, "a": {"u": "p"}}')
    rows = read_table(spark, path, orient="columns")
    assert rows.columns == ["b", "a"]
    assert sorted(tuple(r) for r in rows.collect()) == [(1.5, "p"), (2.0, None)]
    assert read_column_documents(spark, path, ["a"]).columns == ["a"]


def test_bad_json_line_is_kept_apart(spark, tmp_path):
    rows = read_table(spark, put(tmp_path, "l.jsonl", '{"a": 1}\noops\n')).cache()
    assert sorted((r["a"] or 0, r["_corrupt_record"]) for r in rows.collect()) == [(0, "oops"), (1, None)]


def test_suffixes_and_formats(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    spark.range(3).write.orc(str(tmp_path / "t.orc"))
    assert read_table(spark, str(tmp_path / "plain")).count() == 3
    assert read_table(spark, str(tmp_path / "t.orc"), "orc").count() == 3


def test_errors(spark, tmp_path):
    with pytest.raises(errors.MissingPathError):
        read_table(spark, str(tmp_path / "missing.parquet"))
    with pytest.raises(errors.UnsupportedFormatError):
        read_table(spark, put(tmp_path, "t.xls", "x"))
    with pytest.raises(errors.UnreadableTableError):
        read_table(spark, put(tmp_path, "bad.parquet", "not a parquet file at all"))


PRICE_CSV = (
    'actual_price,selling_price,average_rating,name\n"$1,000",₹900,4.5,a\nN/A,1,1,b\n'
    " 5 ,4, 3 ,c\n5,,3,d\n5,4,unrated,e\n"
)


def test_process_file_writes_one_csv(spark, tmp_path):
    source = put(tmp_path, "prices.csv", PRICE_CSV)
    target = process_file(spark, source, str(tmp_path / "out.csv"), n=10, seed=1)
    assert (tmp_path / "out.csv").is_file() and [p.name for p in tmp_path.iterdir() if "parts" in p.name] == []
    again = process_file(spark, source, str(tmp_path / "out.csv"), n=1, seed=1)
    assert len((tmp_path / "out.csv").read_text().splitlines()) == 2
    target = process_file(spark, source, again, n=10, seed=1)
    rows = sorted(tuple(r) for r in read_table(spark, target).collect())
    assert rows == [(5.0, 4.0, 3.0, "c"), (1000.0, 900.0, 4.5, "a")]


def test_process_file_without_rows(spark, tmp_path):
    source = put(tmp_path, "p.csv", "actual_price,selling_price,average_rating\nx,y,z\n")
    with pytest.raises(EmptyResultError):
        process_file(spark, source, str(tmp_path / "out"), n=10)


def test_price_cleaning_needs_all_columns(spark):
    rows = spark.createDataFrame([("$1",)], "actual_price string")
    assert missing_expected_columns(rows) == ["average_rating", "selling_price"]
    assert clean_prices(rows) is rows


def test_price_cleaning_of_numbers_drops_nan(spark):
    rows = spark.createDataFrame(
        [(1.0, 2, "3"), (float("nan"), 2, "3")], "actual_price double, selling_price int, average_rating string"
    )
    assert [tuple(r) for r in clean_prices(rows).collect()] == [(1.0, 2.0, 3.0)]


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema = "actual_price string, selling_price string, average_rating string"
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()

    def run():
        rows = spark.readStream.schema(schema).option("header", True).csv(str(source))
        write_clean_prices(rows, str(target), str(tmp_path / "state")).awaitTermination()
        return sorted(r["actual_price"] for r in spark.read.parquet(str(target)).collect())

    put(source, "one.csv", "a,s,r\n$1,2,3\nN/A,2,3\n")
    assert run() == [1.0]
    put(source, "two.csv", "a,s,r\n₹4,5,6\n")
    assert run() == [1.0, 4.0]


def test_staged_and_reused(spark):
    assert staged(spark.range(5), "test_staged").count() == 5
    with reused(spark.range(5)) as rows:
        assert rows.is_cached and rows.count() == 5
    assert not rows.is_cached


def test_line_breaks_in_cells_and_ragged_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a\n"b",\r\nc'), (2, None)], "id long, text string")
    path = str(tmp_path / "broken.csv")
    rows.repartition(1).write.options(quote='"', escape='"', header=True).csv(path)
    assert read_table(spark, path, fmt="csv").count() == 2
    for content in ("a,b\n3,4,5\n", "a,b\n3\n"):
        with pytest.raises(errors.UnreadableTableError):
            read_table(spark, put(tmp_path, f"ragged{len(content)}.csv", content))


def test_long_whole_numbers_stay_apart(spark, tmp_path):
    ids = [1234567890123456789, 1234567890123456790, 1234567890123456791]
    path = put(tmp_path, "ids.csv", "id,huge\n" + "".join(f"{i},{i}00\n" for i in ids))
    rows = read_table(spark, path)
    assert dict(rows.dtypes) == {"id": "bigint", "huge": "string"} and rows.distinct().count() == 3


def test_json_layout_follows_from_the_whole_content(spark, tmp_path):
    lines = put(tmp_path, "maps.json", '{"m":{"1":"x"},"z":5}\n{"m":{"1":"y"},"z":6}\n')
    assert sorted(r["z"] for r in read_table(spark, lines).collect()) == [5, 6]
    labelled = put(tmp_path, "labelled.json", '{"a": {"r1": 1, "r2": 2}, "b": {"r1": "x", "r2": "y"}}')
    assert sorted((r["a"], r["b"]) for r in read_table(spark, labelled).collect()) == [(1, "x"), (2, "y")]
    mixed = tmp_path / "mixed.json"
    mixed.mkdir()
    put(mixed, "a.json", '[{"a": 1}, {"a": 2}]')
    put(mixed, "b.json", '{"a": 3}\n{"a": 4}\n')
    with pytest.raises(errors.UnreadableTableError):
        read_table(spark, str(mixed))
    with pytest.raises(errors.UnreadableTableError):
        read_table(spark, put(tmp_path, "broken.json", '{"a": {"0": 1}'))


def test_batch_entry_point(spark, tmp_path):
    from chartloom.__main__ import main

    source = put(tmp_path, "p.csv", "id,actual_price\n" + "".join(f"{i},₹{i}\n" for i in range(50)))
    target = main([source, str(tmp_path / "out.csv"), "--rows", "10", "--seed", "3", "--key", "id", "--unique-key"])
    assert read_table(spark, target, fmt="csv").count() == 10


def test_a_folder_is_not_overwritten_by_a_file(spark, tmp_path):
    (tmp_path / "there.csv").mkdir()
    with pytest.raises(errors.TableWriteError):
        write_csv_file(spark.range(3), str(tmp_path / "there.csv"))
    assert [p.name for p in tmp_path.iterdir()] == ["there.csv"]


def test_only_files_with_line_breaks_in_cells_are_read_whole(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    put(folder, "plain one.csv", "a,b\n" + "".join(f'{i},"x ""y"" z"\n' for i in range(500_000)))
    put(folder, "broken.csv", 'a,b\n1000001,"two\nlines"\n1000002,q\n')
    split = files_by_breaks(spark, str(folder))
    assert [p.rsplit("/", 1)[1] for p in split[True] + split[False]] == ["broken.csv", "plain one.csv"]
    rows = read_table(spark, str(folder), "csv")
    assert rows.count() == 500_002 and rows.where("b = 'two\\nlines'").count() == 1
    assert read_table(spark, str(folder / "plain one.csv")).rdd.getNumPartitions() > 1
    assert read_table(spark, str(folder / "broken.csv"), typed=False).count() == 2


def test_types_of_a_very_wide_table(spark, tmp_path):
    names = [f"c.{i}" for i in range(3_000)]
    cells = [("7", "1.5", "true", "t", "")[i % 5] for i in range(3_000)]
    path = put(tmp_path, "wide.csv", ",".join(names) + "\n" + (",".join(cells) + "\n") * 5)
    kinds = [kind for _, kind in read_table(spark, path).dtypes]
    assert kinds == [("bigint", "double", "boolean", "string", "double")[i % 5] for i in range(3_000)]


def test_rejected_rows_are_kept_apart(spark, tmp_path):
    path = put(tmp_path, "r.csv", 'a,b,c\n1,x,y\n2,x\n3,"x,x",y\n4,x,y,z\n5,,\n')
    good, rejects = read_csv_with_rejects(spark, path)
    assert sorted(tuple(r) for r in good.collect()) == [(1, "x", "y"), (3, "x,x", "y"), (5, None, None)]
    told = sorted((r["row"], r["reason"], r["file"].rsplit("/", 1)[1]) for r in rejects.collect())
    assert told == [("2,x", "too few cells", "r.csv"), ("4,x,y,z", "too many cells", "r.csv")]
    with pytest.raises(errors.UnreadableTableError):
        read_table(spark, path).collect()


def test_json_lines_are_never_read_whole(spark, tmp_path, monkeypatch):
    folder = tmp_path / "lines.json"
    folder.mkdir()
    for k in range(3):
        put(folder, f"{k}.txt", "\n".join(json.dumps({"a": i, "b": {"c": i}}) for i in range(1 + 20 * k)))
    whole = []
    text = DataFrameReader.text
    monkeypatch.setattr(DataFrameReader, "text", lambda self, paths, wholetext=False, **o: whole.append(wholetext) or text(self, paths, wholetext, **o))
    assert read_table(spark, str(folder)).count() == 63
    assert not any(whole)


def test_kept_results_follow_their_files(spark, tmp_path):
    path, made = put(tmp_path, "k.csv", "a\n1\n"), []

    def build():
        made.append(1)
        return read_table(spark, path)

    assert [r["a"] for r in kept(spark, path, build, x=1).collect()] == [1]
    assert [r["a"] for r in kept(spark, path, build, x=1).collect()] == [1] and len(made) == 1
    kept(spark, path, build, x=2)
    assert len(made) == 2
    put(tmp_path, "k.csv", "a\n1\n22\n")
    assert sorted(r["a"] for r in kept(spark, path, build, x=1).collect()) == [1, 22] and len(made) == 3
