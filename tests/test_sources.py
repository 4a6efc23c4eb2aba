from __future__ import annotations

import csv

import pytest

from tallyloom.session import run_together, shared_dir
from tallyloom.sources.results import read_result, write_result
from tallyloom.sources.split_csv import read_records
from tallyloom.sources.survey_csv import DIALECT, header_drift, header_layouts, read_survey_csv, scanned, survey_files, write_survey_csv
from tallyloom.sources import tables
from tallyloom.sources.tables import Outrun, new_build, present, publish, published, register_folder, save_table, versions

TEXTS = ["plain", "two\nlines", 'a "quoted" word', 'ends with "x"', " blanks kept ", "comma, and\r\nreturn", "back\\slash", 'mix "",\n" end']


def test_csv_round_trip(spark, tmp_path):
    rows = [(str(i), text) for i, text in enumerate(TEXTS)]
    write_survey_csv(spark.createDataFrame(rows, "id string, text string"), str(tmp_path / "csv"), rows_per_file=3)
    read = read_survey_csv(spark, str(tmp_path / "csv"))
    assert read.schema.simpleString() == "struct<id:string,text:string>"
    assert sorted(tuple(r) for r in read.collect()) == sorted(rows)


def test_csv_folders_are_read_recursively_and_blanks_are_missing(spark, tmp_path):
    for name, body in {"a/x.csv": 'h,k\n1,""\n', "a/b/y.csv": 'h,k\n2,\n"3","v"\n'}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body)
    assert sorted(map(tuple, read_survey_csv(spark, str(tmp_path)).collect())) == [("1", None), ("2", None), ("3", "v")]


def test_duplicate_headers_stay_apart(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a,a,b\n1,2,3\n")
    read = read_survey_csv(spark, str(tmp_path))
    assert len(set(read.columns)) == 3 and tuple(read.first()) == ("1", "2", "3")


def _export(path, rows, record_end):
    with open(path, "w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator=record_end).writerows(rows)


def test_exports_with_their_own_record_end_are_split(spark, tmp_path):
    rows = [(str(i), f'answer "{i}",\nsecond line é\n' * (i % 4)) for i in range(5_000)]
    _export(tmp_path / "d.csv", [("id", "te\nxt"), *rows], "\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        read = read_survey_csv(spark, str(tmp_path), record_end="\r\n")
        assert read.columns == ["id", "te\nxt"] and read.rdd.getNumPartitions() > 2
        got = sorted(map(tuple, read.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((i, text or None) for i, text in rows)
    assert got == sorted(map(tuple, read_survey_csv(spark, str(tmp_path)).collect()))


@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
@pytest.mark.parametrize("record_ends", [["\n"], ["\r\n"], ["\n", "\r\n"]])
def test_any_record_end_reads_the_same(spark, tmp_path, record_ends, quoting):
    rows = [("1", "a"), ("2", ""), ("3", 'b\n"c"'), ("4", "d\r\ne"), ("5", " f "), ("6", "g\n")]
    for number, record_end in enumerate(record_ends):
        with open(tmp_path / f"{number}.csv", "w", newline="", encoding="utf-8") as file:
            csv.writer(file, lineterminator=record_end, quoting=quoting).writerows([("id", "te\nxt"), *rows])
    read = read_survey_csv(spark, str(tmp_path))
    assert read.columns == ["id", "te\nxt"]
    assert sorted(map(tuple, read.collect()), key=str) == sorted([(i, t or None) for i, t in rows] * len(record_ends), key=str)


def test_the_last_header_keeps_no_carriage_return(spark, tmp_path):
    (tmp_path / "d.csv").write_bytes(b"a,b,a\r\n1,2,3\r\n4,5,\r\n")
    read = read_survey_csv(spark, str(tmp_path))
    assert len(set(read.columns)) == 3 and not any("\r" in name for name in read.columns)
    assert list(map(tuple, read.collect())) == [("1", "2", "3"), ("4", "5", None)]


@pytest.mark.parametrize("record_end", [None, "\n"])
def test_files_are_read_each_under_its_own_header(spark, tmp_path, record_end):
    for name, body in {"a.csv": "id,sql,r\n1,S1,R1\n", "b.csv": "id,r,sql\n2,R2,S2\n", "c/c.csv": "sql,id\nS3,3\n", "d.csv": "id,r,sql,extra\n4,R4,S4,E4\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    (tmp_path / "empty.csv").write_text("")
    read = read_survey_csv(spark, str(tmp_path), record_end)
    got = sorted(tuple(row[c] for c in ("id", "sql", "r", "extra")) for row in read.collect())
    assert got == [("1", "S1", "R1", None), ("2", "S2", "R2", None), ("3", "S3", None, None), ("4", "S4", "R4", "E4")]
    drift = header_drift(survey_files(spark, str(tmp_path)))
    assert sorted(map(sorted, drift.values())) == [[], ["extra"], ["extra"], ["extra", "r"]]


@pytest.mark.parametrize("record_end", [None, "\n"])
@pytest.mark.parametrize("body", ["id,a,b\n1,A,B\n2,A,B,LOST\n", "id,a,b\n1,A\n"])
def test_a_ragged_record_fails(spark, tmp_path, body, record_end):
    (tmp_path / "d.csv").write_text(body)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_survey_csv(spark, str(tmp_path), record_end).select("id").collect()


@pytest.mark.parametrize("body", ["a,a\n1,2\n", "a,A\n1,2\n", "a,\n1,2\n"])
def test_names_that_are_not_their_own_fail_where_headers_differ(spark, tmp_path, body):
    (tmp_path / "d.csv").write_text(body)
    (tmp_path / "e.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_survey_csv(spark, str(tmp_path))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_carriage_return_in_an_answer_stays(spark, tmp_path, end):
    (tmp_path / "d.csv").write_bytes(f'id,text{end}1,"abc\r"{end}2,"x\r\ny"{end}3,plain{end}'.encode())
    assert [row.text for row in read_survey_csv(spark, str(tmp_path)).orderBy("id").collect()] == ["abc\r", "x\r\ny", "plain"]


def test_record_ends_that_are_not_the_promised_ones_fail(spark, tmp_path):
    (tmp_path / "d.csv").write_bytes(b"a,b\r\n1,2\r\n")
    with pytest.raises(ValueError, match="records do not end"):
        read_survey_csv(spark, str(tmp_path), record_end="\n")
    (tmp_path / "d.csv").write_bytes(b"a,b\r\n1,2\n3,4\r\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_survey_csv(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="no file"):
        (tmp_path / "none").mkdir()
        (tmp_path / "none" / "e.csv").write_text("")
        read_survey_csv(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("rows", [[("1", "a\nb", "c")], [("1", "a", "b\nc")], [("1\n2", "a", "b")]])
def test_a_record_that_spans_lines_is_never_cut_silently(spark, tmp_path, rows):
    _export(tmp_path / "d.csv", [("x", "y", "z"), *rows], "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_survey_csv(spark, str(tmp_path), record_end="\n").select("x").collect()


def test_result_round_trip_keeps_order_and_missing_values(spark, tmp_path):
    schema = "qtd int, nome string, salario double, total bigint"
    rows = [(0, "a", 5581.38, 785), (1, 'b "x"', 8354.26, 2414), (None, None, 17002.64, 4368)]
    result = spark.createDataFrame(rows, schema).orderBy("salario")
    write_result(result, str(tmp_path / "r"))
    files = list((tmp_path / "r").glob("part-*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[:2] == ['"qtd","nome","salario","total"', '"0","a","5581.38","785"']
    assert [tuple(r) for r in read_result(spark, str(tmp_path / "r"), schema).collect()] == rows


def test_table_with_odd_names_is_replaced(spark, tmp_path):
    odd = "`('P0', 'a.b')` string, `4.d_c/c++#1` string"
    for count in (3, 2):
        df = spark.createDataFrame([("x", str(i)) for i in range(count)], odd)
        table = save_table(df, "odd_names", str(tmp_path / "t"))
    assert table.count() == 2 and table.columns == ["('P0', 'a.b')", "4.d_c/c++#1"]
    assert list((tmp_path / "t").glob("*.snappy.parquet"))


def test_a_build_is_present_once_it_is_published(spark, tmp_path):
    root = str(tmp_path / "t")
    assert published(spark, root) is None
    for count in (3, 2):
        build = new_build(root)
        spark.range(count).write.parquet(build)
        publish(spark, root, build, ["x", "y"])
        assert published(spark, root) == (build, ["x", "y"])
        assert register_folder(spark, "built_table", build).count() == count
    assert len(list((tmp_path / "t").glob("build-*"))) == 2  # the one before stays for its readers


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_no_machine_local_folder_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)


def test_jobs_run_together_and_a_failure_is_raised(spark):
    counted = []
    run_together(spark, [lambda n=n: counted.append(spark.range(n).count()) for n in range(5)], concurrency=3)
    assert sorted(counted) == [0, 1, 2, 3, 4]

    def fail():
        raise ValueError("job failed")

    with pytest.raises(ValueError, match="job failed"):
        run_together(spark, [lambda: spark.range(1).count(), fail], concurrency=2)


def test_drifting_files_hold_rows_with_negative_and_missing_ids(spark, tmp_path):
    from tallyloom.standin.queries import src_csv_drifting_files

    rows = [(i, f"text {i}", "en", "web") for i in (0, 1, 2, -1, -2, -3, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.text, r.lang, r.source) for r in src_csv_drifting_files(spark, str(tmp_path)).collect()}
    first, last = ("en", None), (None, None)
    places = {0: first, 1: ("en", "web"), 2: last, -1: first, -2: first, -3: first, None: last}
    assert got == {(f"text {i}", *place) for i, place in places.items()}


def _layouts(ranges):
    return {text: number for number, text in enumerate(header_layouts(ranges))}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_every_range_border_reads_the_same(spark, tmp_path, end, quoting):
    rows = [(str(i), TEXTS[i % len(TEXTS)] + '"\nx\n\ny,' * (i % 3), "" if i % 5 else "\n") for i in range(23)]
    with open(tmp_path / "d.csv", "w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator=end, quoting=quoting).writerows([("id", "text", "more"), *rows])
    expected = sorted((i, text, more or None) for i, text, more in rows)
    size = (tmp_path / "d.csv").stat().st_size
    tasks = set()
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for length in (41, 97, size - 3):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(length))
            read = read_survey_csv(spark, str(tmp_path))
            tasks.add(read.rdd.getNumPartitions())
            assert sorted(map(tuple, read.collect())) == expected, length
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert max(tasks) > 10


def test_divided_files_equal_the_multiline_reader(spark, tmp_path):
    rows = [(str(i), f'answer "{i}",\nsecond line é\n' * (i % 40), "z") for i in range(3_000)]
    for part in range(3):
        _export(tmp_path / f"{part}.csv", [("id", "te\nxt", "z"), *rows[part::3]], "\n")
    whole = spark.read.options(**DIALECT).options(multiLine=True, lineSep="\n").csv(str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = read_survey_csv(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 50 and read.columns == whole.columns
        assert sorted(map(tuple, read.collect())) == sorted(map(tuple, whole.collect()))
        ranges = scanned(spark, str(tmp_path))
        apart, together = (read_records(spark, str(tmp_path), ranges, _layouts(ranges), most).select("layout", "text") for most in (0, 10**6))
        assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, together.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_many_files_cost_one_job(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"{i}.csv").write_text(f'id,"te\nxt"\n{i},a\n' if i % 2 else f"text,id\nb,{i}\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        ranges = scanned(spark, str(tmp_path))
        assert len(tracker.getJobIdsForGroup("headers")) == 1
        assert len(survey_files(spark, str(tmp_path), ranges)) == 60
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {row["id"]: (row["te\nxt"], row["text"]) for row in read_survey_csv(spark, str(tmp_path), ranges=ranges).collect()}
    assert got == {str(i): ("a", None) if i % 2 else (None, "b") for i in range(60)}


def test_a_header_with_open_quotes_and_a_file_without_a_last_line_break(spark, tmp_path):
    (tmp_path / "d.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n\r\n2,z')
    assert sorted(map(tuple, read_survey_csv(spark, str(tmp_path)).collect())) == [("1", "x\r\ny"), ("2", "z")]
    (tmp_path / "d.csv").write_text('a,"b\n1,2\n')
    with pytest.raises(ValueError, match="quotes stay open"):
        read_survey_csv(spark, str(tmp_path))


def _builds(root):
    return sorted(p.name for p in root.glob("build-*"))


def test_versions_stay_for_the_readers_that_are_on_them(spark, tmp_path):
    root, readers = str(tmp_path / "t"), []
    for count in (4, 3, 2):
        build = new_build(root)
        spark.range(count).write.parquet(build)
        version = publish(spark, root, build)
        assert present(spark, root) == version and published(spark, root) == (build, [])
        readers.append((count, register_folder(spark, "versioned_table", build)))
        assert spark.table("versioned_table").count() == count
        if len(readers) > 1:  # began before this version was published
            before, reader = readers[-2]
            assert reader.count() == before
    assert [v.number for v in versions(spark, root)] == [2, 3] and len(_builds(tmp_path / "t")) == 2


def test_a_crash_between_two_steps_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    first, second = new_build(root), new_build(root)
    spark.range(3).write.parquet(first)
    publish(spark, root, first)
    spark.range(9).write.parquet(second)  # written, never published
    assert spark.read.parquet(published(spark, root)[0]).count() == 3

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(tables, "_rename", crash)
        with pytest.raises(RuntimeError, match="lost"):
            publish(spark, root, second)
    assert spark.read.parquet(published(spark, root)[0]).count() == 3
    with monkeypatch.context() as broken:  # published, then lost before the old folders go
        broken.setattr(tables, "drop_folder", crash)
        with pytest.raises(RuntimeError, match="lost"):
            publish(spark, root, second, keep=1)
    assert spark.read.parquet(published(spark, root)[0]).count() == 9


def test_of_two_writers_one_publishes(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    publish(spark, root, new_build(root))
    with pytest.raises(Outrun):
        publish(spark, root, new_build(root), after=0)
    seen = versions(spark, root)
    publish(spark, root, new_build(root))
    monkeypatch.setattr(tables, "versions", lambda *_: seen)  # a writer that looked before the other had published
    with pytest.raises(Outrun):
        publish(spark, root, new_build(root), after=1)
    monkeypatch.undo()
    assert [v.number for v in versions(spark, root)] == [1, 2]
    assert not [p for p in (tmp_path / "t" / "versions").iterdir() if "v0" not in p.name]
