import pytest

from numberplace import schema as S
from numberplace.functions.match import check_request, with_keys
from numberplace.operators import bulk
from numberplace.operators.bulk import bulk_lookup_rows, bulk_lookup_summary, key_counts
from numberplace.operators.paging import find_records, page_rows, page_summary

REQUESTS = [
    (1, "广州", "city", 0, 5),
    (2, " 北京\t", None, 3, 7),
    (3, "020", "area_code", 50, 200),
    (4, "广东", "city", 0, 10),
    (5, "中国移动", None, 1_200, 30),
    (6, "北京", None, 7, 0),
    (7, "OP1", "operator", 100, 50),
    (8, "op1", None, 290, 120),
    (9, "广州", "phone_number", 0, 5),
    (10, "", None, 0, 5),
    (11, "广州", None, -1, 5),
    (12, "广州", None, 0, 10_001),
    (13, "广州", "", 0, 5),
    (14, None, None, 0, 5),
    (15, "x" * 65, None, 0, 5),
    (16, "广东", None, 0, 10_000),
    (17, "广东", "province", 90, 60),
    (18, "广东", "province", 90, 60),
    (19, "广东", None, 0, 0),
]


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame(REQUESTS, S.REQUEST_SCHEMA)


def valid(location, field, offset, limit):
    try:
        check_request(location or "", field, offset, limit)
    except ValueError as error:
        return str(error)
    return None


@pytest.fixture(scope="module")
def expected_pages(records, awkward):
    return {name: single_pages(df, REQUESTS) for name, df in (("records", records), ("awkward", awkward))}


def single_pages(df, requests):
    """What one look-up per request gives."""
    answers = {}
    for number, location, field, offset, limit in requests:
        if valid(location, field, offset, limit) is None:
            answers[number] = [tuple(r) for r in page_rows(df, location, field, offset, limit).collect()]
    return answers


@pytest.mark.parametrize("table", ["records", "awkward"])
def test_envelopes_are_those_of_single_look_ups(request, requests, table):
    df = request.getfixturevalue(table)
    answered = {r.request_id: r for r in bulk_lookup_summary(df, requests).collect()}
    assert sorted(answered) == [r[0] for r in REQUESTS]
    for number, location, field, offset, limit in REQUESTS:
        row = answered[number].asDict()
        error = valid(location, field, offset, limit)
        assert row.pop("error") == error
        assert row.pop("request_id") == number
        if error is None:
            assert row == page_summary(df, location, field, offset, limit).first().asDict()
        else:
            assert (row["total"], row["returned"], row["has_more"]) == (None, None, None)


PATHS = {
    "broadcast": {},
    "shuffled": {"BROADCAST_BYTES": -1, "FILTER_KEYS": 0},
    "hot and cold": {"BROADCAST_BYTES": -1, "HOT_SHARE": 4, "SALTS": 3, "LEVEL_BITS": 3, "REFINE_ROWS": 20},
    "shuffled, numbered": {"BROADCAST_BYTES": -1, "HOT_SHARE": 2, "GROUP_ROWS": 0, "BLOCK_ROWS": 7, "REFINE_ROWS": 0},
    "coarse buckets": {"LEVEL_BITS": 1, "BLOCK_ROWS": 13, "REFINE_ROWS": 500, "GROUP_ROWS": 10},
}


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("table", ["records", "awkward"])
def test_rows_are_those_of_single_look_ups(request, monkeypatch, requests, expected_pages, table, path):
    for name, value in PATHS[path].items():
        monkeypatch.setattr(bulk, name, value)
    df, expected = request.getfixturevalue(table), expected_pages[table]
    found = {}
    for row in bulk_lookup_rows(df, requests).collect():
        found.setdefault(row.request_id, []).append((row.position, tuple(row)[2:]))
    assert set(found) <= set(expected)
    for number, _, _, offset, limit in REQUESTS:
        if number not in expected:
            continue
        mine = found.get(number, [])
        if limit:
            mine = sorted(mine, key=lambda pair: pair[0])
            assert [position for position, _ in mine] == list(range(offset + 1, offset + 1 + len(mine)))
            assert [cells for _, cells in mine] == expected[number], number
        else:
            assert {position for position, _ in mine} <= {None}

            def plain(rows):
                return sorted(rows, key=lambda cells: tuple((c is None, c or "") for c in cells))

            assert plain(cells for _, cells in mine) == plain(expected[number]), number


def test_only_full_matches_only_pages_and_no_request(spark, records, requests):
    full = bulk_lookup_rows(records, requests.filter("limit = 0"))
    assert full.filter("request_id = 6").count() == find_records(records, "北京").count()
    assert bulk_lookup_rows(records, requests.filter("request_id = 1")).count() == 5
    none = requests.filter("request_id < 0")
    assert bulk_lookup_rows(records, none).count() == 0
    assert bulk_lookup_rows(records, requests.filter("request_id = 9")).count() == 0
    assert bulk_lookup_rows(records, requests.filter("request_id = 4")).count() == 0
    assert bulk_lookup_summary(records, none).count() == 0
    assert bulk_lookup_rows(records.filter("1 = 0"), requests).count() == 0


def test_stored_keys_change_nothing(records, requests):
    rows = bulk_lookup_rows(records, requests)
    assert rows.exceptAll(bulk_lookup_rows(with_keys(records), requests)).count() == 0


def test_a_record_meets_a_key_once(records):
    both = records.filter("province = '北京'")
    counts = {(r.in_field, r.key): r.total for r in key_counts(both).collect()}
    assert counts["*", "北京"] == counts["city", "北京"] == both.count()


def test_records_are_never_spread_into_entries(spark, records, requests):
    plan = bulk_lookup_rows(records, requests.filter("request_id = 1"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "inline" not in text and "Cartesian" not in text


def test_numbers_far_away(spark, records, requests, monkeypatch):
    """Outer numbers put all others into one part, which is split again; few rows are read for a page of 5."""
    monkeypatch.setattr(bulk, "REFINE_ROWS", 50)
    far = spark.createDataFrame(
        [(str(n), "p", "广东", "广州", "中国移动", "020", "510000") for n in (-(2**63), 2**63 - 1, 2**62, -5, "x")],
        records.schema,
    )
    table = records.union(far)
    expected = single_pages(table, REQUESTS)
    read = []
    join = bulk._join
    monkeypatch.setattr(bulk, "_join", lambda records, *a: read.append(join(records, *a)) or read[-1])
    rows = bulk_lookup_rows(table, requests).orderBy("request_id", "position").collect()
    for number, _, _, _, limit in REQUESTS:
        if limit and number in expected:
            assert [tuple(r)[2:] for r in rows if r.request_id == number] == expected[number]
    first = requests.filter("request_id = 1")
    assert [tuple(r)[2:] for r in bulk_lookup_rows(table, first).orderBy("position").collect()] == expected[1]
    assert 5 <= read[-1].count() <= 2 * 50


def test_own_names(spark, records, requests):
    names = ("start", "key", "bucket", "rank", "copies", "combo", "n", "record", "in_field", "location")
    own = records.selectExpr("*", *(f"concat('{name}', record_id) AS {name}" for name in names))
    rows = bulk_lookup_rows(own, requests)
    assert rows.columns == ["request_id", "position", *own.columns]
    assert rows.filter(" OR ".join(f"{name} <> concat('{name}', record_id)" for name in names)).count() == 0
    assert rows.select("request_id", "position", *records.columns).exceptAll(bulk_lookup_rows(records, requests)).count() == 0
    for name in ("request_id", "position"):
        with pytest.raises(ValueError, match=name):
            bulk_lookup_rows(records.selectExpr("*", f"1 AS {name}"), requests)


def test_columns_named_like_keys_are_the_callers_own(spark):
    df = spark.createDataFrame([("1", "广州", "C-77", 5)], "record_id string, city string, city_key string, record_no int")
    request = spark.createDataFrame([(1, "广州", None, 0, 5)], S.REQUEST_SCHEMA)
    assert bulk_lookup_summary(df, request, ("city",)).first().total == 1
    assert bulk_lookup_rows(df, request, ("city",)).columns == ["request_id", "position", *df.columns]


def test_only_what_is_asked_for_is_kept(spark):
    """A table with a cell of its own for every record, and one request."""
    df = spark.range(20_000).selectExpr("CAST(id AS string) AS record_id", "concat('c', id) AS city", "'p' AS province")
    request = bulk.prepared(spark.createDataFrame([(1, "C77", "city", 0, 5)], S.REQUEST_SCHEMA), ("city", "province"))
    found, measured = bulk._answering(df, request, ("city", "province"), {"named": 1, "anywhere": 0})
    assert [(r.in_field, r.key, r.n) for r in found.collect()] == [("city", "c77", 1)] and measured["rows"] == 1
    page = bulk_lookup_rows(df, spark.createDataFrame([(1, "C77", "city", 0, 5)], S.REQUEST_SCHEMA), ("city", "province"))
    assert [(r.position, r.record_id) for r in page.collect()] == [(1, "77")]


def test_salt_splits_a_table_of_one_task(spark, monkeypatch):
    monkeypatch.setattr(bulk, "BROADCAST_BYTES", -1)
    df = spark.range(0, 5_000, 1, 1).selectExpr("struct('a' AS cell0) AS combo", "id")
    met = spark.createDataFrame([("a", 7)], "cell0 string, request_id long").selectExpr("struct(cell0) AS combo", "request_id")
    hot = spark.createDataFrame([("a", 5_000)], "cell0 string, n long").selectExpr("struct(cell0) AS combo", "n")
    joined = bulk._join(df, met, ["combo"], hot, 5_000)
    assert joined.count() == 5_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "salt" in plan and "spark_partition_id" not in plan.lower()
    assert df.select((bulk.F.pmod(bulk.F.xxhash64(bulk.F.monotonically_increasing_id()), bulk.F.lit(200)))).distinct().count() == 200


def test_equal_requests_are_answered_once(spark, records):
    same = [(k, " 北京 ", None, k, 0) for k in range(500)] + [(k, "北京", "city", 2, 3) for k in range(500, 600)]
    requests = spark.createDataFrame(same + [(600, "北京", "nowhere", 0, 5), (601, "020", None, 0, 1)], S.REQUEST_SCHEMA)
    answers, members = bulk.bulk_lookup_answers(records, requests)
    assert answers.count() == find_records(records, "北京").count() + 3 + 1
    assert members.count() == 601 and members.select("answer_id").distinct().count() == 3
    both = members.join(answers, "answer_id").drop("answer_id").filter("request_id IN (7, 8, 555, 601)")
    few = bulk_lookup_rows(records, requests.filter("request_id IN (7, 8, 555, 601)"))
    assert both.count() == few.count() and both.select(few.columns).exceptAll(few).count() == 0
