import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyarrow.fs import LocalFileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from curbair.sources import catalogue, files, grouped, sinks, staging


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_columns_follow_the_header(spark, tmp_path):
    a = write(tmp_path / "a.csv", "a,b\n1,x\n")
    b = write(tmp_path / "b.csv", "b,a\ny,2\n")
    frames = files.scan_csv_sets(spark, [a, b], {"a": "int"})
    assert len(frames) == 2
    assert sorted(r for f in frames for r in rows(f, "a", "b")) == [(1, "x"), (2, "y")]


def test_one_scan_refuses_another_header(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b\n1,x\n")
    write(tmp_path / "b.csv", "b,a\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_csv(spark, str(tmp_path), "a string, b string", skip_corrupt_files=False).collect()


def test_corrupt_rows_are_split_off(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\n1,x\nbad,y\n")
    good, bad = files.split_corrupt(files.scan_csv(spark, path, "a int, b string", keep_corrupt=True))
    assert rows(good) == [(1, "x")] and rows(good, "b") == [("x",)]
    assert rows(bad, files.CORRUPT, "b") == [("bad,y", "y")]


def test_csv_text_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([('say "hi", you', 1), ("back\\slash", 2), (None, 3), ("", 4)], "s string, i int")
    sinks.write_csv(df.coalesce(1), path)
    part = next(p for p in os.listdir(path) if p.startswith("part-"))
    lines = open(os.path.join(path, part), encoding="utf-8").read().splitlines()
    assert lines == ["s,i", '"say ""hi"", you",1', "back\\slash,2", ",3", ",4"]
    assert rows(files.scan_csv(spark, path, df.schema), "i", "s")[0] == (1, 'say "hi", you')


def test_listing_and_tree(spark, tmp_path):
    write(tmp_path / "d" / "green_1.csv", "a\n1\n")
    write(tmp_path / "d" / "x" / "yellow_2.csv", "a\n2\n")
    write(tmp_path / "d" / "x" / "note.txt", "a\n3\n")
    listing = files.list_files(spark, str(tmp_path / "d"), "*.csv", recursive=True)
    assert rows(listing, "source_file") == [("green_1.csv",), ("yellow_2.csv",)]
    assert rows(files.scan_tree_csv(spark, str(tmp_path / "d"), "a int")) == [(1,), (2,)]
    typed = files.with_taxi_type(files.scan_tree_csv(spark, str(tmp_path / "d"), "a int"))
    assert rows(typed) == [(1, "green"), (2, "yellow")]
    assert files.paths_of(listing)[0].endswith("green_1.csv")


def test_inputs_are_files_or_directories_of_parts(spark, tmp_path):
    spark.range(6).repartition(3).write.parquet(str(tmp_path / "in" / "a.parquet"))
    write(tmp_path / "in" / "b.csv", "x\n1\n")
    write(tmp_path / "in" / "deeper" / "c.csv", "x\n1\n")
    write(tmp_path / "in" / "note.txt", "x")
    inputs = files.list_inputs(spark, str(tmp_path / "in"))
    assert rows(inputs, files.SOURCE_FILE) == [("a.parquet",), ("b.csv",)]
    path = files.paths_of(inputs)[0]
    named = files.with_source_file(files.scan_parquet(spark, path))
    assert rows(named.groupBy(files.SOURCE_FILE).count()) == [("a.parquet", 6)]
    out = str(tmp_path / "out")
    assert sinks.convert_parquet_to_csv(spark, str(tmp_path / "in"), out) == {"a.parquet": "converted"}
    assert files.scan_csv(spark, f"{out}/source_file=a.parquet", "id bigint").count() == 6


def test_a_folder_may_be_written_in_any_form(spark, tmp_path):
    write(tmp_path / "raw" / "a b+c.csv", "x\n1\n")
    write(tmp_path / "old_raw" / "d.csv", "x\n1\n")
    raw = str(tmp_path / "raw")
    forms = [raw, raw + "/", f"file://{raw}", f"{tmp_path}/./raw", f"{tmp_path}/old_raw/../raw", f"{tmp_path}/ra*"]
    for form in forms:
        assert rows(files.list_inputs(spark, form), files.SOURCE_FILE) == [("a b+c.csv",)]
    named = files.with_source_file(files.scan_csv(spark, raw, "x int"))
    assert rows(named, files.SOURCE_FILE) == [("a b+c.csv",)]


def test_parquet_type_drift_and_junk(spark, tmp_path):
    spark.createDataFrame([(1,)], "x bigint").write.parquet(str(tmp_path / "a.parquet"))
    spark.createDataFrame([(2.5,)], "x double").write.parquet(str(tmp_path / "b.parquet"))
    junk = write(tmp_path / "c.parquet", "not parquet")
    paths = [str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet"), junk]
    shapes, failed = files.parquet_shapes(spark, paths)
    assert len(shapes) == 2 and list(failed) == [junk]
    frames = files.scan_parquet_sets(spark, paths, {"x": "double"})
    assert sorted(r for f in frames for r in rows(f)) == [(1.0,), (2.5,)]


def test_convert_skips_overwrites_and_reports(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"x": [1, 2]}), folder / "a.parquet")
    pq.write_table(pa.table({"y": ["q"]}), folder / "b.parq")
    write(folder / "c.parquet", "junk")
    assert sinks.convert_parquet_to_csv(spark, str(folder), out) == {
        "a.parquet": "converted", "b.parq": "converted", "c.parquet": "failed"}
    assert rows(files.scan_csv(spark, f"{out}/source_file=a.parquet", "x int")) == [(1,), (2,)]
    pq.write_table(pa.table({"x": [9]}), folder / "a.parquet")
    again = sinks.convert_parquet_to_csv(spark, str(folder), out)
    assert again["a.parquet"] == "skipped"
    assert rows(files.scan_csv(spark, f"{out}/source_file=a.parquet", "x int")) == [(1,), (2,)]
    sinks.convert_parquet_to_csv(spark, str(folder), out, overwrite=True)
    assert rows(files.scan_csv(spark, f"{out}/source_file=a.parquet", "x int")) == [(9,)]
    assert rows(files.scan_csv(spark, f"{out}/source_file=b.parq", "y string")) == [("q",)]


def test_convert_one(spark, tmp_path):
    source, out = str(tmp_path / "s"), str(tmp_path / "o")
    spark.range(2).write.parquet(source)
    sinks.convert_one(spark, source, out)
    spark.range(5).write.mode("overwrite").parquet(source)
    sinks.convert_one(spark, source, out, overwrite=False)
    assert files.scan_csv(spark, out, "id bigint").count() == 2
    sinks.convert_one(spark, source, out)
    assert files.scan_csv(spark, out, "id bigint").count() == 5
    assert sinks.preview(spark.read.parquet(source)) == (5, ["id"])


def test_grouped_layout_keeps_keys_and_cuts_hot_groups(spark, tmp_path):
    path = str(tmp_path / "grouped")
    df = spark.range(40000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("parameter"),
        (F.col("id") % 2).alias("location_id"), F.uuid().alias("v"))
    source = str(tmp_path / "source")
    df.repartition(8).write.parquet(source)
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
              "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k"}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        sinks.write_by_group(spark.read.parquet(source), path, ["parameter", "location_id"], fmt="parquet",
                             sort_by=["v"])
    finally:
        for k in wanted:
            spark.conf.unset(k)
    back = spark.read.parquet(path)
    assert rows(back.select("parameter", "location_id", "v")) == rows(spark.read.parquet(source))
    hot = os.listdir(os.path.join(path, "parameter_p=hot", "location_id_p=0"))
    assert len([f for f in hot if f.endswith(".parquet")]) > 1


def groups_below(path):
    """Part files of a data set by their directory."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if not name.startswith(("_", ".")):
                found.setdefault(os.path.relpath(folder, path), []).append(name)
    return found


def odd_groups(spark):
    return spark.createDataFrame(
        [("a=b/c", 1, 1.5, 'x,"y"'), ("a=b/c", 1, 2.5, "l\n2"), ("", 2, None, ""), (None, 2, 1e20, None), ("\u00e9 %20", 3, 0.1, " z ")],
        "g string, h long, v double, `t.u` string").withColumns({
            "at": F.expr("timestamp'2024-01-01 10:00:00.123'"), "plain": F.expr("timestamp_ntz'1500-01-01 10:00:00.123'"),
            "day": F.expr("date'2024-01-01'"), "flag": F.lit(True)})


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_groups_are_named_and_filled_as_by_spark(spark, tmp_path, fmt):
    ours, theirs, df = str(tmp_path / "ours"), str(tmp_path / "theirs"), odd_groups(spark)
    sinks.write_by_group(df, ours, ["g", "h"], fmt=fmt, sort_by=["v"])
    copied = df.withColumns({"g_p": F.col("g"), "h_p": F.col("h")}).repartition(1).sortWithinPartitions("g_p", "h_p", "v")
    copied.write.partitionBy("g_p", "h_p").options(**sinks.CSV_OPTIONS).format(fmt).save(theirs)
    assert set(groups_below(ours)) == set(groups_below(theirs)) and os.path.exists(f"{ours}/_SUCCESS")
    if fmt == "csv":
        lines = [{folder: sorted(line for n in names for line in open(f"{path}/{folder}/{n}", newline=""))
                  for folder, names in groups_below(path).items()} for path in (ours, theirs)]
        assert lines[0] == lines[1]
        return
    a, b = (spark.read.parquet(p) for p in (ours, theirs))
    assert a.schema == b.schema and rows(a) == rows(b)
    texts = b.withColumn("h_p", F.col("h_p").cast("string"))
    found = grouped.read_groups(spark, ours, ["g_p", "h_p"])
    assert found.columns == texts.columns and rows(found) == rows(texts)
    assert rows(grouped.read_groups(spark, theirs, ["g_p"], ["h", "v"])) == rows(b.select("h", "v", "g_p"))


def test_small_groups_are_written_by_many_tasks(spark, tmp_path):
    # by bytes, AQE would give them all to one task
    path, df = str(tmp_path / "many"), spark.range(300).selectExpr("id % 5 as a", "id as b", "id as v")
    merging = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    sinks.write_by_group(df, path, ["a", "b"], fmt="parquet")
    found = groups_below(path)
    assert len(found) == 300 and all(len(names) == 1 for names in found.values())
    assert len({names[0].split("-")[1] for names in found.values()}) > 1
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == merging
    assert rows(spark.read.parquet(path).select("a", "b", "v")) == rows(df)


def test_groups_appear_whole_or_not_at_all(spark, tmp_path):
    path, df = str(tmp_path / "out"), spark.range(100).selectExpr("id as a", "if(id = 77, raise_error('no'), id) as v")
    with pytest.raises(Exception, match="no"):
        sinks.write_by_group(df, path, ["a"])
    assert not os.listdir(tmp_path)
    sinks.write_by_group(spark.range(3), path, ["id"])
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.write_by_group(spark.range(2), path, ["id"])
    sinks.write_by_group(spark.range(2), path, ["id"], mode="overwrite")
    assert set(groups_below(path)) == {"id_p=0", "id_p=1"}
    sinks.write_by_group(spark.range(2, 4), path, ["id"], mode="append")
    assert rows(spark.read.option("header", True).csv(path).select("id")) == [("0",), ("1",), ("2",), ("3",)]


@pytest.mark.parametrize("header", ["a,v", None])
def test_a_group_larger_than_a_task_holds_is_one_file(tmp_path, monkeypatch, header):
    monkeypatch.setattr(grouped, "HELD_BYTES", 1000)
    file = grouped.GroupFile(LocalFileSystem(), str(tmp_path / "a_p=1"), "part", 7, header)
    for start in range(0, 5000, 100):
        numbers = range(start, start + 100)
        columns = {"line": [f"1,{v}" for v in numbers]} if header else {"a": [1] * 100, "v": list(numbers)}
        file.add(pa.record_batch(columns), 800)
    file.close()
    assert os.listdir(tmp_path / "a_p=1") == ["part"]
    made = tmp_path / "a_p=1" / "part"
    if header:
        assert made.read_text().splitlines() == ["a,v", *[f"1,{v}" for v in range(5000)]]
    else:
        assert pq.ParquetFile(made).read().column("v").to_pylist() == list(range(5000))


def test_zone_lookup_keeps_na_text(spark, tmp_path):
    path = write(tmp_path / "zones.csv",
                 '"LocationID","Borough","Zone","service_zone"\r\n1,"EWR","Newark Airport","EWR"\r\n'
                 '264,"Unknown","N/A","N/A"\r\n')
    assert rows(catalogue.zone_lookup(spark, path)) == [
        (1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", "N/A", "N/A")]


def test_shared_folder_is_read_from_the_session(spark):
    given = spark.conf.get("spark.checkpoint.dir", None)
    folder = staging.shared_folder(spark)
    assert folder == (given.rstrip("/") if given else staging.shared_folder(spark))


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        def getCheckpointDir(self):
            return None

        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


def test_staged_keeps_schema(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    back = staging.staged(df)
    assert back.schema == df.schema and rows(back) == [(1, None)]
    assert isinstance(back.schema["a"].dataType, T.IntegerType)


def test_shapes_of_many_inputs_take_a_fixed_number_of_jobs(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    tables = [pa.table({"a": [1], "b": ["x"]}), pa.table({"b": ["x"], "a": [1.5]})]
    paths = []
    for i in range(1000):
        path = tmp_path / f"in {i}+.parquet"
        pq.write_table(tables[i % 2], path) if i != 500 else path.write_text("junk")
        paths.append(str(path))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("shapes", "shapes")
    shapes, failed = files.parquet_shapes(spark, paths)
    jobs = len(tracker.getJobIdsForGroup("shapes"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(failed) == [paths[500]]
    assert sorted((s.simpleString(), len(m)) for s, m in shapes) == [
        ("struct<a:bigint,b:string>", 499), ("struct<b:string,a:double>", 500)]
    assert jobs <= 12


def test_csv_headers_are_read_from_the_first_block(spark, tmp_path):
    import gzip
    texts = {"a.csv": "x,y\n1,2\n", "b.csv": "\ufeffx,y\r\n3,4\r\n", "c.csv": '"x ""q""\nz",y\n5,6\n', "e.csv": "x,y", "f.csv": "y,x\n1,2\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "d.csv.gz").write_bytes(gzip.compress(b"x,y\n7,8\n"))
    (tmp_path / "g.csv.gz").write_text("not compressed")
    paths = [str(tmp_path / n) for n in (*texts, "d.csv.gz", "g.csv.gz")]
    shapes, failed = files.csv_shapes(spark, paths)
    found = {h: sorted(os.path.basename(p) for p in m) for h, m in shapes}
    assert found[("x", "y")] == ["a.csv", "b.csv", "d.csv.gz", "e.csv"] and found[("y", "x")] == ["f.csv"]
    assert [os.path.basename(p) for p in failed] == ["g.csv.gz"]
    (tmp_path / "dir.parquet").mkdir()
    assert list(files.parquet_shapes(spark, [str(tmp_path / "dir.parquet"), str(tmp_path / "absent")])[1]) == [
        str(tmp_path / "dir.parquet"), str(tmp_path / "absent")]
