import pytest

from numberplace import schema as S
from numberplace.functions.match import (
    cell_key,
    check_columns,
    check_request,
    key_column,
    missing_columns,
    normalise,
    plain_columns,
    search_text,
    sql_text,
    with_keys,
)
from numberplace.operators.counts import pair_count, place_counts
from numberplace.operators.paging import find_records, page_summary
from numberplace.sources.generate import generate
from numberplace.sources.tables import read_table, write_table
from numberplace.session import scratch_path
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def edges(spark):
    rows = [
        ("1", "广东", "广州", "中国移动", "020", "510000"),
        ("2", " 广东 ", "广州", "X", "020", "510000"),
        ("3", "　广东", "广州", "X", "020", "510000"),
        ("4", "\t广东", "广州", "X", "020", "510000"),
        ("5", "广东", None, "X", "020", "510000"),
        ("6", None, "广州", "X", "020", "510000"),
        ("7", "  ", "广州", "X", "020", "510000"),
        ("8", "广东", None, None, None, None),
        ("9", "北京", "北京", "AbC", "010", "100000"),
        ("10", None, None, None, None, None),
    ]
    names = ["record_id", *S.SEARCH_FIELDS]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


CASES = [
    ("广东", [1, 2, 5, 8]),
    (" 广东\t", [1, 2, 5, 8]),
    ("　广东", [1, 2, 5, 8]),
    ("北京", [9]),
    ("ABC", [9]),
    ("abc", [9]),
    ("  ", [7]),
    ("020", [1, 2, 3, 4, 5, 6, 7]),
    ("20", []),
]


@pytest.mark.parametrize(("location", "ids"), CASES)
@pytest.mark.parametrize("keyed", [False, True])
def test_any_field(edges, location, ids, keyed):
    table = with_keys(edges) if keyed else edges
    found = find_records(table, location)
    assert found.columns == edges.columns
    assert sorted(int(r.record_id) for r in found.collect()) == ids
    assert page_summary(table, location).first().total == len(ids)


def test_one_field(edges):
    assert [r.record_id for r in find_records(edges, "北京", "city").collect()] == ["9"]
    assert find_records(edges, "广东", "city").count() == 0


@pytest.mark.parametrize("text", ["  Ab\t", "　ÄÖ ΑΣ\x1f", "İx\xa0", "\x85中 "])
def test_a_column_of_texts_is_normalised_like_one_text(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(
        F.lower(search_text("t")).alias("key"), search_text("t").alias("stripped")
    )
    assert tuple(row.first()) == (normalise(text), text.strip())


def test_whitespace_is_what_python_strips():
    assert set(S.PY_WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_cells_lose_only_spaces(spark):
    cells = spark.createDataFrame([(" A ",), ("\tA",), ("　A",)], "c string")
    assert [r[0] for r in cells.select(cell_key("c")).collect()] == ["a", "\ta", "　a"]


def test_literals(spark):
    for text in ["a'b", 'a"b', "a\\b", "a\\'b", "\\u0041", "%s"]:
        assert spark.range(1).selectExpr(f"{sql_text(text)} AS t").first().t == text


@pytest.mark.parametrize(
    ("location", "field", "offset", "limit"),
    [
        ("", None, 0, 1),
        ("x" * 65, None, 0, 1),
        (" " * 64 + "x", None, 0, 1),
        ("x", "", 0, 1),
        ("x", "phone_number", 0, 1),
        ("x", None, -1, 1),
        ("x", None, 10_000_001, 1),
        ("x", None, 0, -1),
        ("x", None, 0, 10_001),
    ],
)
def test_bounds(location, field, offset, limit):
    with pytest.raises(ValueError):
        check_request(location, field, offset, limit)


def test_limits_of_the_bounds_pass():
    check_request("x" * 64, "city", 10_000_000, 10_000)
    check_request(" ", None, 0, 0)


def test_required_columns(spark):
    table = spark.createDataFrame([("1", "2")], "record_id string, City string")
    assert missing_columns(table) == [
        "area_code", "city", "operator", "phone_number", "postal_code", "province",
    ]
    with pytest.raises(ValueError, match="'area_code', 'city', 'operator'"):
        check_columns(table)


def test_pair_is_exact(edges):
    row = pair_count(edges).first()
    assert tuple(row) == ("广东", "广州", 1, 10)
    assert pair_count(edges, "x", "y").first().match_count == 0


def test_all_places_agree_with_pairs_and_the_table(records):
    counts = place_counts(records).collect()
    assert sum(r.n for r in counts) == 3_000
    for r in counts:
        assert pair_count(records, r.province, r.city).first().match_count == r.n
    assert sum(r.n for r in place_counts(records, ["operator"]).collect()) == 3_000


def test_stored_table_answers_from_pushed_filters(spark, records):
    path = scratch_path(spark)
    assert write_table(records, path) == 3_000
    table = read_table(spark, path)
    found = find_records(table, "北京")
    assert found.exceptAll(find_records(records, "北京")).count() == 0
    assert found.count() == find_records(records, "北京").count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo({key_column('city')},北京)" in plan


def test_a_filter_on_places_is_not_worked_out_per_row(spark):
    plan = find_records(generate(spark, 10), "北京")._jdf.queryExecution().optimizedPlan().toString()
    assert "lower" not in plan


def test_columns_named_like_keys_are_the_callers_own(spark):
    df = spark.createDataFrame([("1", "广州", "C-77", 5)], "record_id string, city string, city_key string, record_no int")
    rows = find_records(df, "广州", "city", fields=("city",))
    assert rows.columns == df.columns and rows.count() == 1
    assert find_records(df, "C-77", fields=("city",)).count() == 0
    keyed = with_keys(df, ("city",))
    assert plain_columns(keyed) == df.columns
    with pytest.raises(ValueError):
        with_keys(df.withColumn(key_column("city"), df.city), ("city",))
