import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.session import scratch_dir
from touchline.sinks.tables import Published, clustered, materialize, write_clustered, write_snapshot
from touchline.sources.landing import list_files, newest_file, read_newest, scan_landing
from touchline.sources.rescue import read_with_rescue
from touchline.sources.schemas import evolve_schema, load_schema, path_columns, save_schema
from touchline.streaming.ingest import append_stream, ingest_files, read_ingested


def schema(text):
    return StructType.fromDDL(text)


def write(spark, path, data, ddl, mode="append"):
    spark.createDataFrame(data, ddl).coalesce(1).write.mode(mode).parquet(path)


def files(spark, path):
    return [r["path"] for r in list_files(spark, path).collect()]


def test_evolve_adds_columns_and_keeps_types(spark):
    merged = evolve_schema(schema("a int, b string"), schema("A string, c double"))
    assert [(f.name, f.dataType.simpleString()) for f in merged] == [
        ("a", "int"), ("b", "string"), ("c", "double")]
    assert evolve_schema(None, schema("a int")) == schema("a int")


def test_remembered_schema(spark):
    place = scratch_dir(spark, "test")
    assert load_schema(spark, place) is None
    save_schema(spark, place, schema("a int"))
    save_schema(spark, place, schema("a int, b string"))
    assert load_schema(spark, place) == schema("a int, b string")


def test_path_columns():
    assert path_columns("file:/x/y/season=2526/day=d/part-0.parquet", "file:///x/y") == ["season", "day"]
    assert path_columns("/x/a=1/y/part-0.parquet", "/x/a=1/y/") == []


def test_rescue(spark):
    place = scratch_dir(spark, "test")
    write(spark, place, [(1, 5, "x")], "id int, GF int, s string")
    write(spark, place, [(2, "6", 7), (3, "2 (4)", 8), (4, None, None)], "id int, gf string, s int")
    write(spark, place, [(5, 1.5, None, "new"), (6, 2.0, None, None)], "id int, GF double, s string, extra string")
    target = schema("id int, GF int, s string, gone date")
    df = read_with_rescue(spark, files(spark, place), target, place)
    got = {r["id"]: r for r in df.collect()}
    assert {i: r["GF"] for i, r in got.items()} == {1: 5, 2: 6, 3: None, 4: None, 5: None, 6: 2}
    assert {i: r["s"] for i, r in got.items()} == {1: "x", 2: "7", 3: "8", 4: None, 5: None, 6: None}
    assert all(r["gone"] is None for r in got.values())
    notes = {i: r["_rescued_data"] and json.loads(r["_rescued_data"]) for i, r in got.items()}
    assert [notes[i] for i in (1, 2, 4, 6)] == [None] * 4
    assert notes[3]["gf"] == "2 (4)" and notes[3]["_file_path"] == got[3]["source_file"]
    assert notes[5]["GF"] == 1.5 and notes[5]["extra"] == "new"
    assert all(r["file_modification_time"] for r in got.values())


def test_partition_folder_wins_and_stays_text(spark):
    place = scratch_dir(spark, "test")
    write(spark, f"{place}/season=2526", [(1, 1)], "id int, season int")
    df = read_with_rescue(spark, files(spark, place), schema("id int, season string"), place)
    assert [tuple(r) for r in df.select("id", "season").collect()] == [(1, "2526")]


def test_missing_and_empty_folders(spark):
    place = scratch_dir(spark, "test")
    assert newest_file(spark, place) is None and read_newest(spark, place) is None
    assert scan_landing(spark, place, schema("a int")).count() == 0
    assert scan_landing(spark, place, schema("a int")).columns == ["a", "source_file", "file_modification_time"]
    with pytest.raises(AnalysisException):
        scan_landing(spark, place)


def test_newest_snapshot_has_all_files_of_its_write(spark):
    place = scratch_dir(spark, "test")
    write_snapshot(spark.range(10).repartition(3), place, "2025-01-02")
    write_snapshot(spark.range(100, 110).repartition(2), place, "2025-01-01")
    newest = read_newest(spark, place)
    read = {r[0] for r in newest.select("_metadata.file_path").distinct().collect()}
    assert len(read) == 2 and all("ingestion_date=2025-01-01" in p for p in read)
    assert sorted(r["id"] for r in newest.collect()) == list(range(100, 110))


def test_newest_snapshot_over_many_folders_and_of_other_writers(spark, tmp_path):
    import pandas as pd
    place = scratch_dir(spark, "test")
    rows = spark.range(40).selectExpr("id", "string(id % 5) AS season")
    write_snapshot(rows.selectExpr("id + 100 AS id", "season"), place, "2025-01-02", ["season"])
    write_snapshot(rows, place, "2025-01-01", ["season"])
    newest = read_newest(spark, place, schema("id long, season string, ingestion_date string"))
    assert sorted(r["id"] for r in newest.collect()) == list(range(40))
    assert {r["ingestion_date"] for r in newest.select("ingestion_date").collect()} == {"2025-01-01"}
    for name in ("a[1].parquet", "b{2}.parquet", "b2.parquet"):
        pd.DataFrame({"n": [name]}).to_parquet(tmp_path / name)
        assert [r["n"] for r in read_newest(spark, str(tmp_path)).collect()] == [name]


def by_hand(folder, name, **columns):
    """A file as another program would write it."""
    import pandas as pd
    folder.mkdir(parents=True, exist_ok=True)
    pd.DataFrame(columns).to_parquet(folder / f"{name}.parquet")


def test_many_single_files_cost_few_driver_reads(spark, tmp_path, monkeypatch):
    from touchline.sources import schemas
    for i in range(200):
        columns = [{"id": [i], "gf": [i]}, {"id": [i], "gf": [f"{i} (4)"]}, {"id": [i], "gf": [i], "extra": ["x"]}][i % 3]
        by_hand(tmp_path / f"day={i % 7}", f"f{i}", **columns)
    opened = []
    footer = schemas._footer
    monkeypatch.setattr(schemas, "_footer", lambda *a: opened.append(a[1]) or footer(*a))
    paths = files(spark, str(tmp_path))
    found = schemas.footer_schemas(spark, paths, str(tmp_path))
    assert len(paths) == 200 and len(opened) == 3 == len(found)
    assert sorted(len(f) for f in found.values()) == [66, 67, 67]
    df = read_with_rescue(spark, paths, schema("id long, gf long, extra string, day string"), str(tmp_path), by_schema=found)
    got = {r["id"]: (r["gf"], r["extra"], r["_rescued_data"] is not None) for r in df.collect()}
    assert got == {i: [(i, None, False), (None, None, True), (i, "x", False)][i % 3] for i in range(200)}
    # Files that a task must not read, or cannot, stand for themselves.
    assert schemas.footer_prints(spark, paths, max_bytes=10) == {}
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 no footer PAR1")
    assert schemas.footer_prints(spark, [str(tmp_path / "broken.parquet")]) == {}


def test_a_late_file_with_an_old_time_is_read_once(spark, tmp_path):
    import os
    source, place = tmp_path / "in", scratch_dir(spark, "test")

    def ingest(**options):
        ingest_files(spark, str(source), f"{place}/t", f"{place}/c", f"{place}/s", max_files=2, **options)
        return sorted(r["id"] for r in read_ingested(spark, f"{place}/t", f"{place}/s").collect())
    for i, day in enumerate(("2023-01-01", "2025-06-01", "2025-06-08", "2025-06-15")):
        by_hand(source / f"ingestion_date={day}", "a", id=[i])
    assert ingest(open_days=30) == [0, 1, 2, 3]  # the first run reads all days
    by_hand(source / "ingestion_date=2025-06-01", "late", id=[10])
    os.utime(source / "ingestion_date=2025-06-01" / "late.parquet", (0, 0))
    assert ingest(open_days=30) == [0, 1, 2, 3, 10]
    by_hand(source / "ingestion_date=2023-01-01", "closed", id=[11])
    assert ingest(open_days=30) == [0, 1, 2, 3, 10]
    assert ingest(open_days=None) == [0, 1, 2, 3, 10, 11]


def test_closed_days_leave_the_ledger(spark, tmp_path):
    from touchline.sinks.records import subfolders
    from touchline.streaming.ingest import FileLedger
    source, place = tmp_path / "in", scratch_dir(spark, "test")
    for i, day in enumerate(("2025-01-01", "2025-01-02", "2025-03-01", "2025-03-02", "2025-03-03")):
        by_hand(source / f"ingestion_date={day}", "a", id=[i])
    for _ in range(2):
        ingest_files(spark, str(source), f"{place}/t", f"{place}/c", f"{place}/s", max_files=1, open_days=10)
        assert [int(f.rpartition("=")[2]) for f in subfolders(spark, f"{place}/c/ledger")] == [2, 3, 4]
    assert FileLedger(spark, f"{place}/c/ledger", 10).position() == (5, "2025-02-21")
    assert read_ingested(spark, f"{place}/t", f"{place}/s").count() == 5


def test_a_batch_that_was_not_recorded_is_written_again(spark, tmp_path, monkeypatch):
    from touchline.streaming import ingest as module
    source, place = tmp_path / "in", scratch_dir(spark, "test")
    by_hand(source, "a", id=[1])
    by_hand(source, "b", id=[2])
    commit = module.FileLedger.commit
    monkeypatch.setattr(module.FileLedger, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        ingest_files(spark, str(source), f"{place}/t", f"{place}/c", f"{place}/s")
    monkeypatch.setattr(module.FileLedger, "commit", commit)
    by_hand(source, "c", id=[3])
    for _ in range(2):
        ingest_files(spark, str(source), f"{place}/t", f"{place}/c", f"{place}/s")
    assert sorted(r["id"] for r in read_ingested(spark, f"{place}/t", f"{place}/s").collect()) == [1, 2, 3]


def test_ingestion_reads_each_file_once_and_adds_columns(spark, rows):
    place = scratch_dir(spark, "test")
    def ingest():
        ingest_files(spark, f"{place}/in", f"{place}/t", f"{place}/c", f"{place}/s", ["ingestion_date"], max_files=1)
    def land(data, ddl, day):
        write_snapshot(spark.createDataFrame(data, ddl).coalesce(1), f"{place}/in", day)
    land([(1, 5)], "id int, gf int", "2025-01-01")
    ingest()
    land([(2, "2 (4)")], "id int, gf string", "2025-01-02")
    land([(3, 1, "n")], "id int, gf int, extra string", "2025-01-03")
    ingest()
    ingest()
    df = read_ingested(spark, f"{place}/t", f"{place}/s")
    assert rows(df, "id", "gf", "extra", "ingestion_date") == [
        (1, 5, None, "2025-01-01"), (2, None, None, "2025-01-02"), (3, 1, "n", "2025-01-03")]
    rescued = df.filter("_rescued_data IS NOT NULL").select("id", F.get_json_object("_rescued_data", "$.gf"))
    assert [tuple(r) for r in rescued.collect()] == [(2, "2 (4)")]


def test_plain_append_stream(spark):
    place = scratch_dir(spark, "test")
    write(spark, f"{place}/in", [(1,)], "id int")
    for extra in (2, 3):
        append_stream(scan_landing(spark, f"{place}/in", schema("id int"), True), f"{place}/t", f"{place}/c")
        write(spark, f"{place}/in", [(extra,)], "id int")
    append_stream(scan_landing(spark, f"{place}/in", schema("id int"), True), f"{place}/t", f"{place}/c")
    assert sorted(r["id"] for r in spark.read.parquet(f"{place}/t").collect()) == [1, 2, 3]


def test_partitioned_snapshot_replaces_only_its_day(spark):
    place = scratch_dir(spark, "test")
    for day, data in (("2025-01-01", [(1, "a"), (2, "b")]), ("2025-01-02", [(3, "a")]), ("2025-01-02", [(4, "a")])):
        write_snapshot(spark.createDataFrame(data, "id int, season string"), place, day, ["season"])
    got = spark.read.schema("id int, season string, ingestion_date string").parquet(place)
    assert sorted(map(tuple, got.collect())) == [
        (1, "a", "2025-01-01"), (2, "b", "2025-01-01"), (4, "a", "2025-01-02")]


def test_clustered_files_split_a_hot_key(spark):
    place = scratch_dir(spark, "test")
    df = spark.range(4000).select(F.when(F.col("id") < 3600, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    write_clustered(df, place, ["k"], files=4)
    sizes = scan_landing(spark, place).groupBy("source_file").agg(
        F.count("*").alias("n"), F.countDistinct("k").alias("keys")).collect()
    assert len(sizes) == 4 and max(r["n"] for r in sizes) < 2000
    assert spark.read.parquet(place).count() == 4000


def test_materialized_table(spark):
    materialize(spark.range(3), "t_materialized", "It's a table", {"quality": "gold"})
    materialize(spark.range(2), "t_materialized", "It's a table", {"quality": "gold"})
    assert spark.table("t_materialized").count() == 2
    facts = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED t_materialized").collect()}
    assert facts["Comment"] == "It's a table" and "quality=gold" in facts["Table Properties"]


def test_published_versions(spark):
    table = Published(spark, scratch_dir(spark, "test"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.publish(spark.range(3))
    before = table.read()
    with pytest.raises(Exception, match="broken"):
        table.publish(spark.range(5).withColumn("id", F.raise_error(F.lit("broken")).cast("bigint")))
    assert table.read().count() == 3
    table.publish(table.read().union(table.read()), cluster_by=["id"])
    assert (table.version(), table.read().count(), before.count()) == (1, 6, 3)


def test_dates_in_snapshots_are_text(spark):
    place = scratch_dir(spark, "test")
    write_snapshot(spark.range(1), place, dt.date(2025, 3, 4))
    assert spark.read.schema("id long, ingestion_date string").parquet(place).first() == (0, "2025-03-04")


def file_bytes(spark, table):
    at = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return sorted(r["length"] for r in at.load(f"{table.path}/data-{table.version()}").select("length").collect())


def test_published_files_have_the_target_size(spark):
    """Many small parts become few files and one large part becomes several, whatever the input's own parts."""
    from functools import reduce

    target = 1 << 20
    noise = F.expr("string(rand(7))")
    small = reduce(lambda a, b: a.union(b), [spark.range(i * 50, i * 50 + 50, numPartitions=1).select("id", noise.alias("s")) for i in range(64)])
    many, one = (Published(spark, scratch_dir(spark, "test")) for _ in range(2))
    many.publish(small, file_bytes=target)
    assert len(file_bytes(spark, many)) == 1
    one.publish(spark.range(0, 400_000, numPartitions=1).select("id", noise.alias("s")), file_bytes=target)
    sizes = file_bytes(spark, one)
    assert sum(sizes) > 4 * target and len(sizes) >= 4 and max(sizes) < 2 * target and sizes[1] > target / 4
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(128 << 20)
    hot = Published(spark, scratch_dir(spark, "test"))
    hot.publish(spark.range(0, 400_000).selectExpr("id", "string(rand(7)) AS s", "IF(id < 350000, 'hot', string(id % 3)) AS k"),
                partition_by=["k"], file_bytes=target)
    assert max(file_bytes(spark, hot)) < 2 * target and hot.read().columns == ["id", "s", "k"]
    assert hot.read().filter("k = 'hot'").count() == 350_000


def test_a_version_records_comment_tag_and_rule_counts(spark):
    from touchline.operators.quality import Rule
    table = Published(spark, scratch_dir(spark, "test"))
    rules = [Rule("even", "id % 2 = 0", "drop"), Rule("small", "id < 8", "drop"), Rule("odd_ones", "id % 2 = 1", "warn"), Rule("not_negative", "id >= 0")]
    df = spark.range(10).withColumn("k", F.lit("x"))
    for options in ({}, {"cluster_by": ["id"]}, {"partition_by": ["k"]}):
        table.publish(df, comment="It's a table", tags={"quality": "silver"}, rules=rules, **options)
        assert sorted(r["id"] for r in table.read().collect()) == [0, 2, 4, 6]
        assert table.read().columns == ["id", "k"]
    report = table.report().collect()
    assert len(report) == 12 and {r["version"] for r in report} == {0, 1, 2}
    assert {(r["comment"], r["quality"], r["checked"], r["kept"]) for r in report} == {("It's a table", "silver", 10, 4)}
    assert {(r["rule"], r["action"], r["broken"]) for r in report} == {
        ("even", "drop", 5), ("small", "drop", 2), ("odd_ones", "warn", 5), ("not_negative", "fail", 0)}
    with pytest.raises(Exception, match="rule not_negative broken"):
        table.publish(spark.range(-2, 3).withColumn("k", F.lit("x")), rules=rules)
    assert table.version() == 2 and table.read().count() == 4
    plain = Published(spark, scratch_dir(spark, "test"))
    plain.publish(spark.range(0))
    row = plain.report().first()
    assert (row["checked"], row["kept"], row["rule"], row["quality"]) == (0, 0, None, None) and plain.read().count() == 0


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = []
    while found.hasNext():
        names.append(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_a_run_of_many_steps_keeps_no_shuffle_files(spark):
    from touchline.session import CODEC, small_on_disk
    out = scratch_dir(spark, "test")
    rows = spark.range(1000, numPartitions=4).selectExpr("id % 7 AS k", "id")
    before = shuffle_files(spark)
    with small_on_disk(spark):
        table = Published(spark, out)
        table.publish(rows.groupBy("k").agg(F.sum("id").alias("s")), partition_by=["k"])
        assert spark.conf.get(CODEC) == "zstd"
    assert shuffle_files(spark) <= before and table.read().count() == 7
    assert spark.conf.get(CODEC, None) is None


def test_stored_rows_are_compressed_and_removed(spark):
    from touchline.session import stored
    with stored(spark.range(10_000).select("id", F.lit("x" * 100).alias("s"))) as rows:
        sizes = [r["length"] for p in rows.inputFiles() for r in spark.read.format("binaryFile").load(p).select("length").collect()]
        assert rows.count() == 10_000 and sum(sizes) < 200_000
        folder = rows.inputFiles()[0].rpartition("/")[0]
    from touchline.sinks.records import subfolders
    assert folder not in subfolders(spark, folder.rpartition("/")[0])


def test_a_published_table_is_laid_out_without_a_shuffle(spark):
    """Rows dealt in turn are shuffled whole and lose their order; a copy in scans of the target size keeps it."""
    table = Published(spark, scratch_dir(spark, "test"))
    before = shuffle_files(spark)
    table.publish(spark.range(0, 5000, numPartitions=8))
    assert shuffle_files(spark) <= before and table.read().count() == 5000
    assert len(file_bytes(spark, table)) == 1


def test_a_large_batch_is_laid_out_in_slices_of_its_files(spark, tmp_path, monkeypatch):
    from touchline.sinks.records import subfolders
    from touchline.streaming import ingest as module
    assert module.file_slices([("d2", "c", 3 << 20), ("d1", "b", 1 << 20), ("d1", "a", 1 << 20)]) == [["a", "b", "c"]]
    monkeypatch.setattr(module, "SLICE_BYTES", 1)
    assert module.file_slices([("d2", "c", 2), ("d1", "b", 1), ("d1", "a", 1)]) == [["a"], ["b"], ["c"]]
    assert module.file_slices([("", "a", 0)]) == [["a"]]
    source, place = tmp_path / "in", scratch_dir(spark, "test")
    for i, day in enumerate(("2025-01-01", "2025-01-02", "2025-01-02", "2025-01-03", "2025-01-04", "2025-01-05")):
        by_hand(source / f"ingestion_date={day}", f"f{i}", id=[i] * 3 if i % 2 else [str(i)] * 3)
    written = []
    monkeypatch.setattr(module, "clustered", lambda rows, keys: written.append(1) or clustered(rows, keys))
    for _ in range(2):
        ingest_files(spark, str(source), f"{place}/t", f"{place}/c", f"{place}/s", cluster_by=["ingestion_date"])
    got = read_ingested(spark, f"{place}/t", f"{place}/s")
    assert sorted(r["id"] for r in got.collect()) == sorted(str(i) for i in range(6) for _ in range(3)) and len(written) == 4
    assert [f.rpartition("/")[2] for f in subfolders(spark, place)] == ["c", "s", "t"]


def test_a_table_published_in_parts_counts_all_of_them(spark):
    from touchline.operators.quality import Rule
    table = Published(spark, scratch_dir(spark, "test"))
    rules = [Rule("even", "id % 2 = 0", "drop")]
    for options in ({}, {"partition_by": ["k"]}):
        table.publish([spark.range(i, i + 5).withColumn("k", F.lit("x")) for i in (0, 5, 10)], rules=rules, **options)
        assert sorted(r["id"] for r in table.read().collect()) == list(range(0, 15, 2))
    assert {(r["checked"], r["kept"], r["broken"]) for r in table.report().collect()} == {(15, 8, 7)}
