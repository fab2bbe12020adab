import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from numberplace.functions.match import NUMBER, number_of, with_keys, with_number
from numberplace.functions.ordering import range_order, record_order
from numberplace.operators import paging
from numberplace.operators.numbering import cut, number_rows
from numberplace.operators.paging import cursor, find_records, lookup, page_after, page_rows, page_summary


def number(text):
    try:
        return int(text) if text is not None else None
    except ValueError:
        return None


def in_order(rows):
    """Rows as tuples in record order, worked out in Python."""

    def last(value):
        return (value is None, value if value is not None else "")

    def key(row):
        n = number(row[0])
        return ((n is None, n or 0), *map(last, row))

    return sorted((tuple(r) for r in rows), key=key)


def texts(rows):
    return [tuple(r) for r in rows]


PAGES = [(0, 100), (7, 1), (90, 60), (250, 100), (0, 10_000), (5_000, 10), (1_100, 50)]


@pytest.mark.parametrize(("direct", "candidates", "accuracy"),
                         [(True, 100_000, 20), (False, 60, 25_000), (False, 1, 50)])
@pytest.mark.parametrize("table", ["records", "awkward"])
def test_pages_are_slices_of_the_ordered_match(request, monkeypatch, table, candidates, direct, accuracy):
    monkeypatch.setattr(paging, "DIRECT_ROWS", 1_000 if direct else 0)
    monkeypatch.setattr(paging, "CANDIDATE_ROWS", candidates)
    monkeypatch.setattr(paging, "ACCURACY", accuracy)
    df = request.getfixturevalue(table)
    expected = in_order(find_records(df, "广东").collect())
    for offset, limit in PAGES if not direct else PAGES[:4]:
        page = page_rows(df, "广东", None, offset, limit)
        assert texts(page.collect()) == expected[offset : offset + limit], (offset, limit)


def test_pages_without_any_number(spark, awkward, monkeypatch):
    monkeypatch.setattr(paging, "DIRECT_ROWS", 0)
    table = awkward.filter(F.col("record_id").startswith("x"))
    expected = in_order(find_records(table, "广州").collect())
    for candidates in (10, 100_000):
        monkeypatch.setattr(paging, "CANDIDATE_ROWS", candidates)
        assert texts(page_rows(table, "广州", None, 5, 20).collect()) == expected[5:25]


def test_numbers_at_both_ends_of_the_range(spark, monkeypatch):
    monkeypatch.setattr(paging, "DIRECT_ROWS", 0)
    monkeypatch.setattr(paging, "CANDIDATE_ROWS", 1)
    ids = [-(2**63), 2**63 - 1, 0, -1, 1, 2**62, 2**63 - 1]
    table = spark.createDataFrame([(str(i), "a") for i in ids], "record_id string, city string")
    page = page_rows(table, "A", None, 1, 4, fields=["city"]).collect()
    assert [int(r.record_id) for r in page] == sorted(ids)[1:5]


def test_stored_keys_do_not_change_pages(records):
    keyed = with_keys(records)
    assert page_rows(keyed, "广州", "city", 20, 30).collect() == page_rows(records, "广州", "city", 20, 30).collect()


def test_limit_zero_is_the_full_match_whatever_the_offset(records):
    assert texts(sorted(page_rows(records, "北京", None, 40, 0).collect())) == texts(
        sorted(find_records(records, "北京").collect())
    )


@pytest.mark.parametrize("table", ["records", "awkward"])
@pytest.mark.parametrize("limit", [37, 250])
def test_pages_after_rows_are_the_full_match(request, table, limit):
    df = request.getfixturevalue(table)
    expected = in_order(find_records(df, "广东").collect())
    page = page_rows(df, "广东", limit=limit).collect()
    found, mark = texts(page), None
    while len(page) == limit:
        mark = cursor(page, mark)
        page = page_after(df, "广东", *mark, limit=limit).collect()
        found += texts(page)
    assert found == expected


@pytest.mark.parametrize(
    ("offset", "limit", "returned", "more"),
    [(0, 100, 100, True), (200, 100, 50, False), (250, 100, 0, False), (300, 100, 0, False),
     (0, 0, 250, False), (40, 0, 250, False)],
)
def test_envelope(spark, offset, limit, returned, more):
    table = spark.range(250).selectExpr("'x' AS city")
    row = page_summary(table, " X ", "city", offset, limit, ["city"]).first()
    assert row.asDict() == {
        "location": "X", "field": "city", "total": 250, "offset": offset,
        "returned": returned, "has_more": more,
    }


def test_envelope_of_nothing(records):
    row = page_summary(records, "nowhere").first()
    assert tuple(row) == ("nowhere", "all-attribution-fields", 0, 0, 0, False)


def test_near_page_is_a_heap_of_the_rows_up_to_a_bound(records):
    plan = page_rows(records, "广州", "city", 200, 100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "<= " in plan
    assert not any(word in plan for word in ("Sort ", "Window", "Exchange hashpartitioning", "Coalesce"))


def test_rows_that_stay_behind_the_bound(spark):
    """What the sketch leaves of a million rows for a page of 100."""
    rows = with_number(spark.range(0, 1_000_000, 1, 8).selectExpr("CAST(id * 7919 % 1000003 AS string) AS record_id"))
    sketch = paging._sketch(rows)
    assert 100 <= rows.filter(sketch.near(100)).count() <= 1_000
    low, high = sketch.below(500_000), sketch.above(500_100)
    assert rows.filter(F.col(NUMBER) < low).count() <= 500_000 < 500_100 <= rows.filter(F.col(NUMBER) <= high).count()
    assert rows.filter(F.col(NUMBER).between(low, high)).count() < 1_000_000 / 200


def test_numbers_of_single_values(spark):
    values = ["12", " +7\t", "-0", "", " ", "1.5", "x1", "９", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "1\n", "\u00a05", None]
    df = spark.createDataFrame([(v,) for v in values], "record_id string")
    assert [number_of(r.record_id) for r in df.collect()] == [r[0] for r in with_number(df).select(NUMBER).collect()]


def test_a_deep_page_takes_three_scans(spark, monkeypatch):
    """Ids of 40 bits, three quarters of them close together."""
    df = spark.range(0, 200_000, 1, 4).selectExpr(
        "CAST(IF(id % 4 = 0, id * 5497558, 549755813888 + id) AS string) AS record_id", "'a' AS city")
    jobs = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: jobs.append(1) or collect(self))
    page = page_rows(df, "a", "city", 120_000, 50, ["city"])
    assert len(jobs) == 2  # the sketch and the histogram; the page itself is the third
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    ids = sorted(549755813888 + k if k % 4 else k * 5497558 for k in range(200_000))
    assert [int(r.record_id) for r in page.toLocalIterator()] == ids[120_000:120_050]


def test_range_keys_hold_no_whole_rows(spark):
    wide = with_number(spark.createDataFrame([("x", "a" * 1_000, [1])], "record_id string, text string, list array<int>"))
    taken = [str(c) for c in range_order(wide)]
    assert len(taken) == 3 and all("substring" in c for c in taken[1:])


def test_row_numbers_of_groups_with_copies(spark, awkward):
    table = with_number(awkward)
    numbered = number_rows(table, ["city"], record_order(table))
    rows = cut(numbered, F.lit(0), F.lit(10_000), "position").collect()
    assert len(rows) == awkward.count()
    for city in ("广州", "北京"):
        mine = sorted((r for r in rows if r.city == city), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(len(mine)))
        cells = [tuple(r[c] for c in awkward.columns) for r in mine]
        assert cells == in_order(awkward.filter(F.col("city") == city).collect())


def test_own_names_and_maps(spark, records):
    own = records.selectExpr("*", "record_id AS start_position", "city AS copies", "1 AS rank", "'x' AS record", "2 AS task_group")
    for offset, limit in ((3, 5), (1_100, 40)):
        page = page_rows(own, "广州", "city", offset, limit)
        assert page.columns == own.columns
        plain = page_rows(records, "广州", "city", offset, limit).collect()
        assert page.select(*records.columns).collect() == plain
    with pytest.raises(ValueError, match="map"):
        page_rows(records.selectExpr("*", "map(city, 1) AS m"), "广州", "city")


@pytest.mark.parametrize("offset, limit", [(0, 7), (20, 100), (990, 40), (1_190, 100), (5_000, 10)])
def test_lookup_is_summary_and_page(records, offset, limit):
    found = lookup(records, " 广州", None, offset, limit)
    assert found.count() == 1
    envelope = page_summary(records, " 广州", None, offset, limit).first().asDict()
    row = found.first().asDict()
    assert row.pop("records") == page_rows(records, "广州", None, offset, limit).collect()
    assert row == envelope


def test_lookup_has_a_bound(records):
    with pytest.raises(ValueError):
        lookup(records, "广州", limit=0)
