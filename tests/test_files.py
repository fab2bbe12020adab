import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.operators.counts import pair_count
from numberplace.operators.paging import find_records
from numberplace.operators.profile import column_profile, file_profile, load_profile
from numberplace.plans.jobs import (
    pair_result,
    report,
    result_lines,
    run_pair_count,
    run_report,
    run_sampling,
)
from numberplace.session import scratch, scratch_path, stored
from numberplace.sources.csv_files import load_csv, read_csv, write_csv
from numberplace.sources.generate import generate
from numberplace.sources.results import latest, read_result, write_result
from numberplace.sources.tables import cached, read_table, write_table

HEADER = ",".join(S.COLUMNS)
LINES = [
    "1,p,广东,广州,中国移动,020,510000",
    "2,p, 广东 ,广州,X,020,510000",
    "3,p,　广东,广州,X,020,510000",
    "4,p,\t广东,广州,X,020,510000",
    "5,p,广东,,X,020,510000",
    '6,p,"",广州,X,020,510000',
    '7,p,"  ",广州,X,020,510000',
    "8,p,广东",
    "",
    "9,p,北京,北京,AbC,010,100000,extra,extra2",
]


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n", encoding="utf-8")
    return str(path)


def test_cells_are_read_as_they_stand(spark, csv):
    table = load_csv(spark, csv)
    assert {f.dataType.simpleString() for f in table.schema} == {"string"}
    rows = {r.record_id: r for r in table.collect()}
    assert {k: r.province for k, r in rows.items()} == {
        "1": "广东", "2": " 广东 ", "3": "　广东", "4": "\t广东", "5": "广东",
        "6": None, "7": "  ", "8": "广东", "9": "北京",
    }
    assert rows["5"].city is None and rows["8"].postal_code is None
    assert rows["1"].area_code == "020"
    assert rows["9"].postal_code == "100000"
    assert table.count() == 9
    assert sorted(r.record_id for r in find_records(table, "广东").collect()) == ["1", "2", "5", "8"]


def test_columns_go_by_name_and_more_of_them_pass(spark, tmp_path):
    (tmp_path / "a.csv").write_text("more," + ",".join(reversed(S.COLUMNS)) + "\nm,1,2,3,4,5,6,7\n", encoding="utf-8")
    row = load_csv(spark, str(tmp_path / "a.csv")).first()
    assert (row.more, row.record_id, row.postal_code) == ("m", "7", "1")


def test_files_of_a_folder_must_agree_on_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("record_id,city\n1,a\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("city,record_id\nb,2\n", encoding="utf-8")
    with pytest.raises((PySparkException, Py4JJavaError), match="does not conform"):
        read_csv(spark, str(tmp_path)).collect()


def test_profile_of_a_file_that_fails_while_it_is_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{LINES[0]}\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text(",".join(reversed(S.COLUMNS)) + "\n1,2,3,4,5,6,7\n", encoding="utf-8")
    row = load_profile(spark, str(tmp_path), "records").first()
    assert (row.ready, row.records_loaded) == (False, 0) and "does not conform" in row.error


def test_missing_columns_and_missing_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("record_id,City\n1,a\n", encoding="utf-8")
    with pytest.raises(ValueError, match="'area_code', 'city'"):
        load_csv(spark, str(tmp_path / "a.csv"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_csv(spark, str(tmp_path / "none.csv"))


def test_written_cells_come_back(spark, tmp_path):
    cells = [" x ", "\tx", "a,b", 'say "hi"', "　", None, "020", "back\\slash", "'"]
    table = spark.createDataFrame([(str(k), c) for k, c in enumerate(cells)], "record_id string, city string")
    path = str(tmp_path / "new" / "out")
    assert write_csv(table.repartition(3), path) == len(cells)
    back = load_csv(spark, path, ["record_id", "city"], written_here=True)
    assert {r.record_id: r.city for r in back.collect()} == {str(k): c for k, c in enumerate(cells)}
    assert write_csv(table.limit(2), path) == 2
    assert read_csv(spark, path, True).count() == 2


def test_generated_table_as_csv(spark, tmp_path):
    path = str(tmp_path / "out")
    assert write_csv(generate(spark, 1_000), path) == 1_000
    assert load_csv(spark, path).exceptAll(generate(spark, 1_000)).count() == 0


def test_results_keep_nulls_and_characters(spark, tmp_path):
    path = str(tmp_path / "r")
    write_result(spark.sql("SELECT '广东' AS province, CAST(NULL AS string) AS input"), path)
    (part,) = (tmp_path / "r").glob("part-*")
    assert part.read_text(encoding="utf-8") == '{"province":"广东","input":null}\n'


def test_jobs_and_report(spark, tmp_path, csv):
    pairs, samples = str(tmp_path / "pairs"), str(tmp_path / "samples")
    first = run_pair_count(spark, csv, pairs, "北京", "北京").first()
    assert (first["count"], first.records_scanned, first.input) == (1, 9, csv)
    assert first.master.startswith("local")
    second = run_pair_count(spark, csv, pairs, append=True).first()
    assert (second.province, second["count"]) == ("广东", 1)
    assert spark.read.json(pairs).count() == 2
    assert second.completed_at_utc > first.completed_at_utc
    assert second.completed_at_utc.endswith("+00:00")

    sample = run_sampling(spark, samples, "sampling").first()
    assert (sample.inside_points, sample.pi, sample.total_points) == (785_050, 3.1402, 1_000_000)
    assert (sample.partitions, sample.points_per_partition, sample.seed) == (4, 250_000, 20260917)

    both = run_report(spark, pairs, samples).first()
    assert (both.pi_text, both.total_points_text, both.match_count_text) == ("3.14020000", "1,000,000", "1")
    assert both.pair_count.province == "广东"
    assert both.sampling.seed == 20260917
    assert [r.line for r in result_lines(spark.read.schema(S.SAMPLE_RESULT_SCHEMA).json(samples)).collect()] == [
        "PI_RESULT=3.14020000", "POINTS=1000000", "INSIDE=785050", "PARTITIONS=4",
    ]
    assert [r.line for r in result_lines(run_pair_count(spark, csv, pairs)).collect()] == [
        "MATCH_COUNT=1", "RECORDS_SCANNED=9",
    ]


def test_time_is_utc_in_any_session_zone(spark, tmp_path, csv):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        there = run_pair_count(spark, csv, str(tmp_path / "a")).first().completed_at_utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    here = run_pair_count(spark, csv, str(tmp_path / "b")).first().completed_at_utc
    apart = datetime.fromisoformat(here) - datetime.fromisoformat(there)
    assert timedelta(0) < apart < timedelta(minutes=30)


def test_a_report_with_one_side_only(spark):
    pair = spark.createDataFrame([], S.PAIR_RESULT_SCHEMA)
    row = S.SAMPLE_RESULT_SCHEMA
    sample = spark.createDataFrame([("a", 1, 2, 2, 1, 2.0, 3, "m", "2026-01-01T00:00:00+00:00")], row)
    both = report(latest(pair), latest(sample)).first()
    assert both.pair_count is None and both.match_count_text is None
    assert both.pi_text == "2.00000000"


def test_indented_results_are_read(spark, tmp_path):
    value = {"province": "广东", "city": "广州", "count": 400_000, "records_scanned": 1_000_000}
    (tmp_path / "r.json").write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    row = read_result(spark, str(tmp_path / "r.json"), S.PAIR_RESULT_SCHEMA, indented=True).first()
    assert (row.city, row["count"], row.input) == ("广州", 400_000, None)


def test_profile_of_a_file(spark, csv):
    row = load_profile(spark, csv, "records").first()
    assert (row.service, row.ready, row.records_loaded, row.error) == ("records", True, 9, None)
    assert (row.province_nulls, row.province_blanks, row.city_nulls) == (1, 1, 2)
    assert row.data_path == csv


def test_profile_of_what_does_not_load(spark, tmp_path):
    row = load_profile(spark, str(tmp_path / "none.csv"), "records").first()
    assert (row.ready, row.records_loaded, row.province_nulls) == (False, 0, None)
    assert "PATH_NOT_FOUND" in row.error
    (tmp_path / "a.csv").write_text("record_id,City\n1,a\n", encoding="utf-8")
    row = load_profile(spark, str(tmp_path / "a.csv"), "records").first()
    assert not row.ready and "'city'" in row.error


def test_cached_table_is_counted(spark):
    table, rows = cached(generate(spark, 50))
    assert rows == 50 and table.storageLevel.useDisk and table.storageLevel.useMemory
    assert pair_count(table).first().records_scanned == 50
    table.unpersist()


def test_profile_of_nothing(spark):
    row = column_profile(spark.createDataFrame([], S.RECORD_SCHEMA)).first()
    assert set(row) == {0}


def test_scratch_of_a_call_is_deleted(spark, records):
    root = Path(scratch_path(spark)).parent
    before = set(root.iterdir())
    with scratch(spark):
        kept = stored(records)
        assert kept.count() == 3_000 and set(root.iterdir()) > before
    assert set(root.iterdir()) == before


def test_profiles_of_quoted_cells_and_tables(spark, records):
    odd = records.limit(3).withColumn("province", F.lit('say "hi", now'))
    path, table = scratch_path(spark), scratch_path(spark)
    write_csv(odd, path)
    write_table(odd, table)
    for row in (load_profile(spark, path, "s", written_here=True).first(), load_profile(spark, table, "s", table=True).first()):
        assert row.ready and row.records_loaded == 3 and row.province_nulls == 0
    assert load_csv(spark, path, written_here=True).first().province == 'say "hi", now'
    missing = scratch_path(spark)
    write_table(odd.drop("city"), missing, fields=("province",))
    row = load_profile(spark, missing, "s", table=True).first()
    assert not row.ready and "['city']" in row.error


def test_result_lines_end_with_the_file(spark, records):
    lines = [r.line for r in result_lines(pair_result(pair_count(records), "x"), "out/count").collect()]
    assert lines == ["MATCH_COUNT=1200", "RECORDS_SCANNED=3000", "RESULT_FILE=out/count"]


def test_latest_of_equal_times_is_one_row(spark):
    rows = [("a", 1, "2026-01-01T00:00:00+00:00"), ("b", 2, "2026-01-01T00:00:00+00:00")]
    df = spark.createDataFrame(rows, "name string, n int, completed_at_utc string")
    assert {latest(df.repartition(k)).first().name for k in (1, 2, 3)} == {"b"}


def test_profile_names_the_file_that_is_faulty(spark, records, tmp_path):
    """Columns in another order, too few of them, an empty file and two right ones, cells with nulls and blanks."""
    right = records.limit(40).coalesce(1)
    parts = {
        "a": right, "b": right.withColumn("city", F.when(F.col("record_id") > "115050", F.lit(" ")).otherwise(F.col("city"))),
        "short": right.drop("city", "operator"), "turned": right.select(*reversed(right.columns)), "none": right.limit(0),
    }
    for name, df in parts.items():
        write_csv(df, f"{tmp_path}/{name}")
    found = {r.file.split("/")[-2]: r for r in file_profile(spark, [f"{tmp_path}/{name}" for name in parts], written_here=True).collect()}
    assert [found[name].records_loaded for name in parts if name in found] == [40, 40, 0, 0, *([0] if "none" in found else [])]
    assert found["short"].error == "input lacks columns: ['city', 'operator']" and not found["short"].ready
    assert found["turned"].error == "columns in another order than in other files" and found["turned"].city_nulls is None
    assert found["a"].ready and found["b"].ready
    blanks = parts["b"].filter("trim(city) = ''").count()
    assert (found["a"].city_blanks, found["b"].city_blanks) == (0, blanks) and blanks


def test_search_on_any_field_skips_row_groups(spark, records, tmp_path):
    """Row groups hold all provinces, and one of them the only row with an area code of its own."""
    own = records.limit(1).withColumns({"area_code": F.lit("0999"), "record_id": F.lit("1")})
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.row.count.limit", "500")
    try:
        write_table(records.unionByName(own).coalesce(1), str(tmp_path / "t"))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.row.count.limit")
    table = read_table(spark, str(tmp_path / "t"))
    found = find_records(table, "0999", "area_code")
    assert found.count() == 1
    rows = found._jdf.queryExecution()
    rows.toRdd().count()
    scan = [p for p in _nodes(rows.executedPlan()) if p.nodeName().startswith("Scan parquet")]
    assert scan[0].metrics().apply("numOutputRows").value() <= 500 < records.count()


def _nodes(plan):
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    out, children = [plan], plan.children()
    for k in range(children.size()):
        out += _nodes(children.apply(k))
    return out
