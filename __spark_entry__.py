"""

The given tables hold no records, so records are derived from them, one per
row: from ``orders`` by order key (0, 1, 2, ... without gaps), and from
``lineitem`` by order key and line number, where some rows coincide and give
identical records. Requests come from ``customer``, ``nation`` and ``region``,
sampling ids from ``supplier``. Other queries read columns of the tables as
they are.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numberplace import schema as S
from numberplace.functions.match import NUMBER, key_column, sql_text, with_keys
from numberplace.operators.bulk import bulk_lookup_answers, bulk_lookup_rows, bulk_lookup_summary
from numberplace.operators.counts import pair_count, place_counts
from numberplace.operators.paging import cursor, find_records, lookup, page_after, page_rows, page_summary
from numberplace.operators.profile import column_profile, file_profile, load_profile
from numberplace.operators.sampling import sample_exact, sample_native
from numberplace.plans.jobs import pair_result, report, result_lines, sample_result
from numberplace.session import scratch_path
from numberplace.sources.csv_files import load_csv, write_csv
from numberplace.sources.generate import generate, records_from
from numberplace.sources.results import latest, read_result, write_result
from numberplace.sources.tables import cached, read_table, write_table

try:
    import corpus_pipeline
    from numberplace.llm import queries as _llm
except ModuleNotFoundError as error:
    # The subpackage may have been taken out; anything else that is missing is a fault.
    if error.name != "corpus_pipeline" and not (error.name or "").startswith("numberplace.llm"):
        raise
    _llm = None

_POINTS = 10_000
_PART_FIELDS = ("p_name", "p_brand", "p_type")
_DOCUMENT_FIELDS = ("lang", "source")
_LOCATIONS = ("广州", " 北京　", "020", "广东", "中国移动", "20", "NOWHERE", "上海\t", "0755", "中国联通")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from(_table(spark, sf_dir, "lineitem"), "l_orderkey * 8 + l_linenumber")


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from(_table(spark, sf_dir, "orders"), "o_orderkey")


def _sampling_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier keys, dealt out over the cores: a few rows make a lot of work."""
    tasks = spark.sparkContext.defaultParallelism
    return _table(spark, sf_dir, "supplier").select("s_suppkey").repartition(tasks, "s_suppkey")


def _requests(df: DataFrame, number: str, choice: str, field: str, offset: str, limit: str) -> DataFrame:
    locations = ", ".join(map(sql_text, _LOCATIONS))
    return df.selectExpr(
        f"CAST({number} AS bigint) AS request_id",
        f"get(array({locations}), CAST({choice} % {len(_LOCATIONS)} AS int)) AS location",
        f"{field} AS field",
        f"CAST({offset} AS bigint) AS offset",
        f"CAST({limit} AS bigint) AS limit",
    )


def _customer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small pages; some requests name a field, some a wrong one, most name none."""
    names = ", ".join(map(sql_text, (*S.SEARCH_FIELDS, "phone_number")))
    field = f"get(array({names}), CAST(c_custkey % 12 AS int))"
    customers = _table(spark, sf_dir, "customer")
    return _requests(customers, "c_custkey", "c_nationkey", field, "c_custkey % 17", "c_custkey % 5 + 1")


def _nation_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deep pages over any field."""
    nations = _table(spark, sf_dir, "nation")
    none = "CAST(NULL AS string)"
    return _requests(nations, "n_nationkey", "n_nationkey", none, "n_nationkey * 130", "n_nationkey + 20")


def _region_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full matches over any field; the offset has no effect."""
    regions = _table(spark, sf_dir, "region")
    return _requests(regions, "r_regionkey", "r_regionkey", "CAST(NULL AS string)", "7", "0")


def entry(spark: SparkSession) -> DataFrame:
    """Rows of 广东/广州 among the records of sf0.001, counted in one pass."""
    return pair_count(_line_records(spark, "/root/testdata/sf0.001"))


def gen_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate(spark, _table(spark, sf_dir, "lineitem").count())


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_csv(_line_records(spark, sf_dir), path)
    return load_csv(spark, path, written_here=True)


def json_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_result(pair_result(pair_count(_line_records(spark, sf_dir)), "lineitem"), path)
    stored = read_result(spark, path, S.PAIR_RESULT_SCHEMA)
    return stored.select("province", "city", "count", "records_scanned", "input")


def stored_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_table(_line_records(spark, sf_dir), path)
    return find_records(read_table(spark, path), "中国电信")


def next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page after the first one, found from that page's last row."""
    records = _line_records(spark, sf_dir)
    after, seen = cursor(page_rows(records, "广东", limit=150).collect())
    return page_after(records, "广东", after, seen, limit=150)


def csv_load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_csv(_line_records(spark, sf_dir), path)
    return load_profile(spark, path, "records", written_here=True).drop("service", "master", "data_path")


def load_profile_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV folder that holds no records: reported, not raised."""
    path = scratch_path(spark)
    write_csv(_table(spark, sf_dir, "customer"), path)
    return load_profile(spark, path, "records", written_here=True).drop("service", "master", "data_path")


def load_profile_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An input for each nation of which none is there: reported, not raised."""
    path = scratch_path(spark)
    states = [load_profile(spark, f"{path}/{row.r_name}", row.r_name) for row in _table(spark, sf_dir, "region").collect()]
    every = functools.reduce(DataFrame.unionByName, states)
    return every.select("service", "ready", "records_loaded", F.contains("error", F.lit("PATH_NOT_FOUND")).alias("absent"))


def file_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of two CSV files of records, one by line and one by order, and one of customers."""
    path = scratch_path(spark)
    parts = {"lines": _line_records(spark, sf_dir), "orders": _order_records(spark, sf_dir), "customers": _table(spark, sf_dir, "customer")}
    for name, df in parts.items():
        write_csv(df.coalesce(1), f"{path}/{name}")
    found = file_profile(spark, [f"{path}/{name}" for name in parts], written_here=True)
    return found.withColumn("file", F.regexp_extract("file", "([a-z]+)/[^/]+$", 1))


def cached_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is kept, counted while it is loaded, and asked twice."""
    kept, rows = cached(_line_records(spark, sf_dir))
    try:
        cities = kept.groupBy("city").count().collect()
        pair = pair_count(kept).first()
    finally:
        kept.unpersist()
    return spark.createDataFrame(
        [(row.city, row["count"], rows, pair.match_count) for row in cities], "city string, records long, loaded long, pair long")


def generate_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many records as each region's key less two: none or fewer are refused, not made."""
    states = []
    for row in _table(spark, sf_dir, "region").select((F.col("r_regionkey") - 2).alias("asked")).collect():
        try:
            states.append((row.asked, generate(spark, row.asked).count(), None))
        except ValueError as error:
            states.append((row.asked, 0, str(error)))
    return spark.createDataFrame(states, "asked long, made long, error string")


def bulk_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of the customers' different requests, with the number of requests that share each."""
    answers, members = bulk_lookup_answers(_line_records(spark, sf_dir), _customer_requests(spark, sf_dir))
    shared = members.groupBy("answer_id").agg(F.count("*").alias("requests"))
    return answers.join(shared, "answer_id").select("answer_id", "requests", "position", "record_id", "phone_number", "city")


def keyed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with their stored keys and numbers, under names of this query's own."""
    named = {key_column(field): f"{field}_key" for field in S.SEARCH_FIELDS} | {NUMBER: "record_no"}
    return with_keys(_order_records(spark, sf_dir)).withColumnsRenamed(named)


def match_own_key_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are named like keys are the caller's own."""
    own = _table(spark, sf_dir, "customer").selectExpr(
        "*", "concat('S-', c_custkey) AS c_mktsegment_key", "c_custkey * 2 AS record_no")
    return find_records(own, "Building ", "c_mktsegment", fields=("c_mktsegment",))


_OWN_NAMES = ("start", "key", "bucket", "rank", "copies", "record", "n", "combo")


def bulk_lookup_rows_own_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with columns that are named like the operator's own state."""
    own = _line_records(spark, sf_dir).selectExpr("*", *(f"concat('{name} ', record_id) AS {name}" for name in _OWN_NAMES))
    return bulk_lookup_rows(own, _customer_requests(spark, sf_dir))


def _faulty_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests over every bound, made from the customers, and right ones."""
    texts = "get(array('', NULL, repeat('x', 65), repeat('x', 64), '广州'), CAST(c_custkey % 5 AS int))"
    return _table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS bigint) AS request_id",
        f"{texts} AS location",
        "CAST(NULL AS string) AS field",
        "CAST(c_custkey % 3 - 1 AS bigint) AS offset",
        "CAST(IF(c_custkey % 7 = 0, 10001, c_custkey % 7) AS bigint) AS limit",
    )


def lookup_page(spark: SparkSession, sf_dir: str, offset: int = 200, limit: int = 50) -> DataFrame:
    """An envelope with its records; of those, the ids and numbers are returned as text."""
    found = lookup(_line_records(spark, sf_dir), " 广东 ", None, offset, limit)
    texts = F.transform("records", lambda r: F.concat_ws(" ", r.record_id, r.phone_number, r.city))
    return found.withColumn("records", F.array_join(texts, ","))


def count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_lines(pair_result(pair_count(_line_records(spark, sf_dir)), "lineitem"), "results/count")


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, samples = scratch_path(spark), scratch_path(spark)
    write_result(pair_result(pair_count(_line_records(spark, sf_dir)), "lineitem"), pairs)
    sampled = sample_native(_sampling_ids(spark, sf_dir), _POINTS, id_column="s_suppkey")
    write_result(sample_result(sampled, "sampling", S.SAMPLE_SEED), samples)
    both = report(
        latest(read_result(spark, pairs, S.PAIR_RESULT_SCHEMA)),
        latest(read_result(spark, samples, S.SAMPLE_RESULT_SCHEMA)),
    )
    return both.select(
        "pi_text",
        "total_points_text",
        "match_count_text",
        "pair_count.province",
        "pair_count.city",
        "pair_count.count",
        "pair_count.records_scanned",
        "sampling.inside_points",
        "sampling.seed",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every operator over the given tables; each takes (spark, sf_dir)."""
    lines, orders = _line_records, _order_records
    return {
        "gen_records": gen_records,
        "order_records": orders,
        "line_records": lines,
        "csv_scan": csv_scan,
        "json_result": json_result,
        "pair_count": lambda s, d: pair_count(lines(s, d)),
        "pair_count_lineitem": lambda s, d: pair_count(
            _table(s, d, "lineitem"), "R", "F", ("l_returnflag", "l_linestatus")
        ),
        "match_any_field": lambda s, d: find_records(lines(s, d), " 北京\t"),
        "match_one_field": lambda s, d: find_records(lines(s, d), "020", "area_code"),
        "match_any_part": lambda s, d: find_records(_table(s, d, "part"), "Economy ", fields=_PART_FIELDS),
        "match_any_document": lambda s, d: find_records(
            _table(s, d, "documents"), "FR", fields=_DOCUMENT_FIELDS
        ),
        "stored_match": stored_match,
        "keyed_records": keyed_records,
        "match_own_key_column": match_own_key_column,
        "page_rows": lambda s, d: page_rows(lines(s, d), "广州", "city", 200, 100),
        "page_rows_deep": lambda s, d: page_rows(lines(s, d), "广东", None, 2_000, 1_500),
        "page_rows_end": lambda s, d: page_rows(orders(s, d), "上海", "city", 450, 10_000),
        "page_rows_orders": lambda s, d: page_rows(
            _table(s, d, "orders"), "f", offset=3_000, limit=500, fields=("o_orderstatus",), id_column="o_orderkey"
        ),
        "page_rows_unlimited": lambda s, d: page_rows(lines(s, d), "四川", None, 40, 0),
        "next_page": next_page,
        "page_summary": lambda s, d: page_summary(lines(s, d), " 广东 ", None, 200, 100),
        "page_summary_end": lambda s, d: page_summary(orders(s, d), "上海", "city", 450, 10_000),
        "page_summary_unlimited": lambda s, d: page_summary(lines(s, d), "广州", "city", 40, 0),
        "page_summary_empty": lambda s, d: page_summary(lines(s, d), "20", None, 0, 100),
        "bulk_lookup_summary": lambda s, d: bulk_lookup_summary(lines(s, d), _customer_requests(s, d)),
        "bulk_lookup_rows": lambda s, d: bulk_lookup_rows(lines(s, d), _customer_requests(s, d)),
        "bulk_lookup_rows_deep": lambda s, d: bulk_lookup_rows(lines(s, d), _nation_requests(s, d)),
        "bulk_lookup_rows_unlimited": lambda s, d: bulk_lookup_rows(lines(s, d), _region_requests(s, d)),
        "bulk_lookup_rows_own_names": bulk_lookup_rows_own_names,
        "bulk_lookup_answers": bulk_answers,
        "bulk_lookup_summary_errors": lambda s, d: bulk_lookup_summary(lines(s, d), _faulty_requests(s, d)),
        "lookup_page": lookup_page,
        "lookup_page_deep": lambda s, d: lookup_page(s, d, 2_000, 500),
        "place_counts": lambda s, d: place_counts(lines(s, d)),
        "operator_counts": lambda s, d: place_counts(lines(s, d), ["operator"]),
        "customer_place_counts": lambda s, d: place_counts(
            _table(s, d, "customer"), ["c_mktsegment", "c_nationkey"]
        ),
        "column_profile": lambda s, d: column_profile(lines(s, d)),
        "load_profile": csv_load_profile,
        "load_profile_missing_columns": load_profile_missing_columns,
        "load_profile_absent": load_profile_absent,
        "file_profile": file_profiles,
        "cached_count": cached_count,
        "generate_refused": generate_refused,
        "result_lines": count_lines,
        "sample_exact": lambda s, d: sample_exact(_sampling_ids(s, d), _POINTS, id_column="s_suppkey"),
        "sample_native": lambda s, d: sample_native(_sampling_ids(s, d), _POINTS, id_column="s_suppkey"),
        "run_report": run_report,
    } | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _llm.QUERIES | {"pipeline": corpus_pipeline.run} if _llm else {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LOC = ", ".join(f"({k}, {', '.join(map(_quoted, place))})" for k, place in enumerate(S.PLACES))


def _records_sql(index: str, source: str) -> str:
    return f"""
    SELECT CAST(115036 + i AS VARCHAR) AS record_id,
           CASE WHEN i = 0 THEN '1477799'
                ELSE '1' || lpad(CAST(4700000000 + i AS VARCHAR), 10, '0') END AS phone_number,
           province, city, operator, area_code, postal_code
    FROM (SELECT {index} AS i FROM {source}) AS idx
    JOIN (VALUES {_LOC}) AS loc (k, province, city, operator, area_code, postal_code)
      ON k = CASE WHEN i % 5 IN (0, 1) THEN 0 ELSE 1 + (i * 17) % 7 END"""


_LINES = _records_sql("l_orderkey * 8 + l_linenumber", "lineitem")
_ORDERS = _records_sql("o_orderkey", "orders")
_ANY = "({0} IN (lower(trim(province)), lower(trim(city)), lower(trim(operator)), lower(trim(area_code)), lower(trim(postal_code))))"
_ORDER = ", ".join(["TRY_CAST(record_id AS BIGINT)", *S.COLUMNS])


def _summary_sql(records: str, predicate: str, location: str, field: str, offset: int, limit: int) -> str:
    returned = "total" if limit == 0 else f"greatest(0, least({limit}, total - {offset}))"
    return f"""
    SELECT '{location}' AS location, '{field}' AS field, total, CAST({offset} AS BIGINT) AS "offset",
           CAST({returned} AS BIGINT) AS returned, {offset} + {returned} < total AS has_more
    FROM (SELECT count(*) AS total FROM ({records}) WHERE {predicate})"""


def _requests_sql(table: str, number: str, choice: str, field: str, offset: str, limit: str) -> str:
    """Requests as numbers and cleaned texts; the wrong field is the only error in them."""
    cleaned = ", ".join(_quoted(text.strip()) for text in _LOCATIONS)
    return f"""
    SELECT CAST({number} AS BIGINT) AS request_id, [{cleaned}][{choice} % {len(_LOCATIONS)} + 1] AS location,
           {field} AS field, CAST({offset} AS BIGINT) AS "offset", CAST({limit} AS BIGINT) AS "limit"
    FROM {table}"""


_CUSTOMER_REQUESTS = _requests_sql(
    "customer",
    "c_custkey",
    "c_nationkey",
    f"[{', '.join(map(_quoted, (*S.SEARCH_FIELDS, 'phone_number')))}][c_custkey % 12 + 1]",
    "c_custkey % 17",
    "c_custkey % 5 + 1",
)
_NATION_REQUESTS = _requests_sql(
    "nation", "n_nationkey", "n_nationkey", "CAST(NULL AS VARCHAR)", "n_nationkey * 130", "n_nationkey + 20"
)
_REGION_REQUESTS = _requests_sql("region", "r_regionkey", "r_regionkey", "CAST(NULL AS VARCHAR)", "7", "0")

_MEETS = " OR ".join(
    f"((field IS NULL OR field = '{name}') AND lower(trim({name})) = lower(location))" for name in S.SEARCH_FIELDS
)


def _bulk_sql(requests: str) -> str:
    """Records ranked for each different (field, location); requests join their ranks."""
    return f"""
    WITH requests AS ({requests}), records AS ({_LINES}),
    asked AS (SELECT DISTINCT field, location FROM requests),
    ranked AS (
      SELECT field, location, records.*,
             row_number() OVER (PARTITION BY field, location ORDER BY {_ORDER}) AS position
      FROM asked JOIN records ON {_MEETS})
    SELECT request_id, CASE WHEN "limit" = 0 THEN NULL ELSE position END AS position, {", ".join(S.COLUMNS)}
    FROM requests JOIN ranked
      ON requests.field IS NOT DISTINCT FROM ranked.field AND requests.location = ranked.location
     AND ("limit" = 0 OR position BETWEEN "offset" + 1 AND "offset" + "limit")"""


_WRONG_FIELD = "(field IS NOT NULL AND field NOT IN (" + ", ".join(map(_quoted, S.SEARCH_FIELDS)) + "))"
_BULK_SUMMARY = f"""
    WITH requests AS ({_CUSTOMER_REQUESTS}), records AS ({_LINES}),
    asked AS (SELECT DISTINCT field, location FROM requests),
    totals AS (SELECT field, location, count(*) AS n FROM asked JOIN records ON {_MEETS} GROUP BY ALL),
    answered AS (
      SELECT requests.*, {_WRONG_FIELD.replace("field ", "requests.field ")} AS wrong,
             CASE WHEN NOT wrong THEN coalesce(n, 0) END AS total
      FROM requests LEFT JOIN totals
        ON requests.field IS NOT DISTINCT FROM totals.field AND requests.location = totals.location)
    SELECT request_id, location, coalesce(field, 'all-attribution-fields') AS field, total, "offset",
           CASE WHEN total IS NOT NULL THEN greatest(0, least("limit", total - "offset")) END AS returned,
           "offset" + greatest(0, least("limit", total - "offset")) < total AS has_more,
           CASE WHEN wrong THEN 'field must be one of: {", ".join(S.SEARCH_FIELDS)}' END AS error
    FROM answered"""


def _hash_sql(relation: str, keep: str, value: str) -> str:
    """Chain the XXH64 of the integer ``value`` onto the 64-bit ``h`` of ``relation``."""
    p1, p2, p3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
    p4, p5 = 9650029242287828579, 2870177450012600261

    def low(x: str) -> str:
        return f"CAST(({x}) & 18446744073709551615 AS UBIGINT)"

    def times(x: str, factor: int) -> str:
        return low(f"CAST({x} AS UHUGEINT) * {factor}")

    def turned(x: str, bits: int) -> str:
        return f"({times(x, 1 << bits)} | ({x} >> {64 - bits}))"

    steps = [
        f"{times(value, p2)} AS a, {low(f'CAST(h AS UHUGEINT) + {p5 + 8}')} AS h",
        f"xor(h, {times(turned('a', 31), p1)}) AS h",
        f"{low(f'CAST({turned("h", 27)} AS UHUGEINT) * {p1} + {p4}')} AS h",
        f"{times('xor(h, h >> 33)', p2)} AS h",
        f"{times('xor(h, h >> 29)', p3)} AS h",
        "xor(h, h >> 32) AS h",
    ]
    for step in steps:
        relation = f"SELECT {keep}, {step} FROM ({relation})"
    return relation


def _sample_sql() -> str:
    """The points of every supplier, hashed from seed, axis, supplier and number."""
    streams = """SELECT s_suppkey AS id, axis, CAST(42 AS UBIGINT) AS h
                 FROM supplier, (VALUES (0), (1)) AS axes (axis)"""
    for value in (str(S.SAMPLE_SEED), "axis", "id"):
        streams = _hash_sql(streams, "id, axis", value)
    points = f"""SELECT x.id, point, x.h AS x, y.h AS y
                 FROM ({streams}) AS x JOIN ({streams}) AS y ON x.id = y.id AND x.axis = 0 AND y.axis = 1,
                      (SELECT unnest(range({_POINTS})) AS point)"""
    both = []
    for axis in "xy":
        hashed = _hash_sql(f"SELECT id, point, {axis} AS h FROM points", "id, point", "point")
        both.append(f"(SELECT id, point, CAST(h >> 11 AS DOUBLE) / 4503599627370496.0 - 1 AS {axis} FROM ({hashed}))")
    return f"""
    WITH points AS ({points})
    SELECT count(DISTINCT id) AS partitions, CAST({_POINTS} AS BIGINT) AS points_per_partition,
           count(*) AS total_points, count(*) FILTER (x * x + y * y <= 1) AS inside_points,
           4 * inside_points / total_points AS pi, printf('%.8f', pi) AS pi_text
    FROM {both[0]} JOIN {both[1]} USING (id, point)"""


def _lookup_sql(offset: int, limit: int) -> str:
    here = _ANY.format(_quoted("广东"))
    envelope = _summary_sql(_LINES, here, "广东", "all-attribution-fields", offset, limit)
    return f"""
    SELECT envelope.*, records FROM ({envelope}) AS envelope, (
      SELECT string_agg(record_id || ' ' || phone_number || ' ' || city, ',' ORDER BY {_ORDER}) AS records FROM (
        SELECT * FROM ({_LINES}) WHERE {here} ORDER BY {_ORDER} LIMIT {limit} OFFSET {offset}))"""


_FAULTY_SUMMARY = f"""
    WITH requests AS (
      SELECT CAST(c_custkey AS BIGINT) AS request_id,
             ['', NULL, repeat('x', 65), repeat('x', 64), '广州'][c_custkey % 5 + 1] AS location,
             CAST(c_custkey % 3 - 1 AS BIGINT) AS "offset",
             CAST(CASE WHEN c_custkey % 7 = 0 THEN 10001 ELSE c_custkey % 7 END AS BIGINT) AS "limit" FROM customer),
    judged AS (
      SELECT *, CASE WHEN location IS NULL OR length(location) NOT BETWEEN 1 AND 64
                       THEN 'location must have 1 to 64 characters'
                     WHEN "offset" < 0 THEN 'offset must be from 0 to 10000000'
                     WHEN "limit" > 10000 THEN 'limit must be from 0 to 10000' END AS error FROM requests),
    counted AS (SELECT count(*) AS n FROM ({_LINES}) WHERE city = '广州'),
    answered AS (
      SELECT judged.*, CASE WHEN error IS NULL THEN CASE WHEN location = '广州' THEN n ELSE 0 END END AS total
      FROM judged, counted)
    SELECT request_id, location, 'all-attribution-fields' AS field, total, "offset",
           CASE WHEN total IS NOT NULL THEN greatest(0, least("limit", total - "offset")) END AS returned,
           CASE WHEN total IS NOT NULL
                THEN "offset" + greatest(0, least("limit", total - "offset")) < total END AS has_more,
           error
    FROM answered"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries.

    ``sample_exact`` has none: it needs Python's generator. Tests compare it with
    that generator instead.
    """
    pair = "province = '广东' AND city = '广州'"
    counted = f"""SELECT '广东' AS province, '广州' AS city, count(*) FILTER ({pair}) AS {{0}},
                  count(*) AS records_scanned{{1}} FROM ({_LINES})"""
    page = f"SELECT * FROM ({{0}}) WHERE {{1}} ORDER BY {_ORDER} LIMIT {{2}} OFFSET {{3}}"
    city = "lower(trim(city)) = '{}'"
    profile = ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}_nulls, count(*) FILTER (trim({c}) = '') AS {c}_blanks"
        for c in S.COLUMNS
    )
    keys = ", ".join(f"lower(trim({c})) AS {c}_key" for c in S.SEARCH_FIELDS)
    sampled = _sample_sql()
    return {
        "gen_records": _records_sql("i", "(SELECT unnest(range((SELECT count(*) FROM lineitem))) AS i)"),
        "order_records": _ORDERS,
        "line_records": _LINES,
        "csv_scan": _LINES,
        "json_result": counted.format("count", ", 'lineitem' AS input"),
        "pair_count": counted.format("match_count", ""),
        "pair_count_lineitem": """
            SELECT 'R' AS province, 'F' AS city,
                   count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS match_count,
                   count(*) AS records_scanned FROM lineitem""",
        "match_any_field": f"SELECT * FROM ({_LINES}) WHERE {_ANY.format(_quoted('北京'))}",
        "match_one_field": f"SELECT * FROM ({_LINES}) WHERE lower(trim(area_code)) = '020'",
        "match_any_part": """
            SELECT * FROM part
            WHERE 'economy' IN (lower(trim(p_name)), lower(trim(p_brand)), lower(trim(p_type)))""",
        "match_any_document": "SELECT * FROM documents WHERE 'fr' IN (lower(trim(lang)), lower(trim(source)))",
        "stored_match": f"SELECT * FROM ({_LINES}) WHERE {_ANY.format(_quoted('中国电信'))}",
        "keyed_records": f"SELECT *, {keys}, TRY_CAST(record_id AS BIGINT) AS record_no FROM ({_ORDERS})",
        "page_rows": page.format(_LINES, city.format("广州"), 100, 200),
        "page_rows_deep": page.format(_LINES, _ANY.format(_quoted("广东")), 1_500, 2_000),
        "page_rows_end": page.format(_ORDERS, city.format("上海"), 10_000, 450),
        "page_rows_orders": """
            SELECT * FROM orders WHERE lower(trim(o_orderstatus)) = 'f'
            ORDER BY o_orderkey LIMIT 500 OFFSET 3000""",
        "page_rows_unlimited": f"SELECT * FROM ({_LINES}) WHERE {_ANY.format(_quoted('四川'))}",
        "next_page": page.format(_LINES, _ANY.format(_quoted("广东")), 150, 150),
        "page_summary": _summary_sql(
            _LINES, _ANY.format(_quoted("广东")), "广东", "all-attribution-fields", 200, 100
        ),
        "page_summary_end": _summary_sql(_ORDERS, city.format("上海"), "上海", "city", 450, 10_000),
        "page_summary_unlimited": _summary_sql(_LINES, city.format("广州"), "广州", "city", 40, 0),
        "page_summary_empty": _summary_sql(
            _LINES, _ANY.format(_quoted("20")), "20", "all-attribution-fields", 0, 100
        ),
        "bulk_lookup_summary": _BULK_SUMMARY,
        "bulk_lookup_rows": _bulk_sql(_CUSTOMER_REQUESTS),
        "bulk_lookup_rows_deep": _bulk_sql(_NATION_REQUESTS),
        "bulk_lookup_rows_unlimited": _bulk_sql(_REGION_REQUESTS),
        "bulk_lookup_rows_own_names": "SELECT *, " + ", ".join(
            f"'{name} ' || record_id AS \"{name}\"" for name in _OWN_NAMES
        ) + f" FROM ({_bulk_sql(_CUSTOMER_REQUESTS)})",
        "bulk_lookup_answers": f"""
            WITH same AS (
              SELECT min(request_id) AS answer_id, count(*) AS requests FROM ({_CUSTOMER_REQUESTS}) AS requests
              GROUP BY field, lower(location), "offset", "limit")
            SELECT answer_id, requests, position, record_id, phone_number, city
            FROM same JOIN ({_bulk_sql(_CUSTOMER_REQUESTS)}) AS pages ON answer_id = request_id""",
        "load_profile_absent": """
            SELECT r_name AS service, false AS ready, CAST(0 AS BIGINT) AS records_loaded, true AS absent FROM region""",
        "file_profile": f"""
            SELECT 'lines' AS file, true AS ready, CAST(NULL AS VARCHAR) AS error, count(*) AS records_loaded, {profile} FROM ({_LINES})
            UNION ALL SELECT 'orders', true, NULL, count(*), {profile} FROM ({_ORDERS})
            UNION ALL SELECT 'customers', false, {_quoted(f"input lacks columns: {sorted(S.COLUMNS)}")}, 0,
                   {", ".join("NULL" for _ in range(2 * len(S.COLUMNS)))}""",
        "cached_count": f"""
            SELECT city, count(*) AS records, (SELECT count(*) FROM lineitem) AS loaded,
                   (SELECT count(*) FILTER ({pair}) FROM ({_LINES})) AS pair FROM ({_LINES}) GROUP BY city""",
        "generate_refused": """
            SELECT CAST(r_regionkey - 2 AS BIGINT) AS asked, CAST(greatest(r_regionkey - 2, 0) AS BIGINT) AS made,
                   CASE WHEN r_regionkey <= 2 THEN 'the number of rows must be greater than 0' END AS error FROM region""",
        "bulk_lookup_summary_errors": _FAULTY_SUMMARY,
        "lookup_page": _lookup_sql(200, 50),
        "lookup_page_deep": _lookup_sql(2_000, 500),
        "match_own_key_column": """
            SELECT *, 'S-' || c_custkey AS c_mktsegment_key, c_custkey * 2 AS record_no
            FROM customer WHERE lower(trim(c_mktsegment)) = 'building'""",
        "place_counts": f"SELECT province, city, count(*) AS n FROM ({_LINES}) GROUP BY ALL",
        "operator_counts": f"SELECT operator, count(*) AS n FROM ({_LINES}) GROUP BY ALL",
        "customer_place_counts": """
            SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL""",
        "column_profile": f"SELECT count(*) AS records_loaded, {profile} FROM ({_LINES})",
        "load_profile": f"""
            SELECT true AS ready, count(*) AS records_loaded, CAST(NULL AS VARCHAR) AS error, {profile}
            FROM ({_LINES})""",
        "load_profile_missing_columns": "SELECT false AS ready, CAST(0 AS BIGINT) AS records_loaded, "
        + _quoted(f"input lacks columns: {sorted(S.COLUMNS)}") + " AS error, "
        + ", ".join(f"CAST(NULL AS BIGINT) AS {name}_{what}" for name in S.COLUMNS for what in ("nulls", "blanks")),
        "result_lines": f"""
            SELECT unnest(['MATCH_COUNT=' || "count", 'RECORDS_SCANNED=' || records_scanned, 'RESULT_FILE=results/count'])
                   AS line FROM ({counted.format('"count"', "")})""",
        "sample_native": sampled,
        "run_report": f"""
            SELECT pi_text, format('{{:,}}', total_points) AS total_points_text,
                   format('{{:,}}', pair."count") AS match_count_text, province, city, pair."count",
                   records_scanned, inside_points, CAST({S.SAMPLE_SEED} AS BIGINT) AS seed
            FROM ({counted.format('"count"', "")}) AS pair, ({sampled}) AS sample""",
    } | _llm_sql()


def _llm_sql() -> dict[str, str]:
    if not _llm:
        return {}
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return _llm.ORACLE_SQL | whole
