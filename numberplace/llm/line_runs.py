"""Repeated runs of lines, found by winnowing and deleted where they come again.

A window is the shortest run of lines from a line on, or back from a line, that
holds ``min_words`` words. The least line hash of a window is its fingerprint:
equal runs of at least so many words have equal windows and so equal
fingerprints. Only windows whose fingerprint occurs at several places go on.
Those meet the first place of their whole content. Windows that start forward
and backward together cover a match to both its ends, and touching ones make up
a run. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from numberplace.session import stored

#: A run of fewer words is left alone.
MIN_WORDS = 50

_WORD = r"[^\x20\x09-\x0D]+"


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(row, id, place, start, stop, kind, mark, content) of all whole windows."""
    of_row = Window.partitionBy("row")
    ahead = lines.withColumn("after", F.sum("words").over(of_row.orderBy("place"))).withColumn(
        "before", F.col("after") - F.col("words"))
    forward = of_row.orderBy("before").rangeBetween(0, min_words - 1)
    backward = of_row.orderBy("after").rangeBetween(1 - min_words, 0)

    def window(kind: str, frame: Window, whole: Column) -> Column:
        return F.when(whole, F.struct(
            F.lit(kind).alias("kind"),
            F.min("place").over(frame).alias("start"),
            F.max("place").over(frame).alias("stop"),
            F.min(F.struct("hash", "place")).over(frame).alias("mark"),
            F.xxhash64(F.collect_list("hash").over(frame)).alias("content")))

    found = ahead.select(
        "row", "id",
        window("f", forward, F.col("before") + min_words <= F.sum("words").over(of_row)).alias("forward"),
        window("b", backward, F.col("after") >= min_words).alias("backward"))
    each = found.select("row", "id", F.explode(F.array("forward", "backward")).alias("window")).filter("window IS NOT NULL")
    return each.select("row", "id", "window.*")


def repeated_runs(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, start, stop): the runs of lines of ``rows`` (row, id, text) that occurred before.

    Places count from 0. The order of texts is by id (nulls first), then by row.
    """
    split = rows.select("row", "id", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    lines = split.select(
        "row", "id", "place", F.xxhash64("line").alias("hash"), F.regexp_count("line", F.lit(_WORD)).alias("words")
    ).filter("words > 0")
    windows = stored(_windows(lines, min_words))
    marks = windows.select("row", "mark").distinct().groupBy(F.col("mark.hash").alias("hash")).agg(F.count("*").alias("n"))
    marks = stored(marks.filter("n > 1").select("hash"))
    likely = stored(windows.withColumn("hash", F.col("mark.hash")).join(marks, "hash", "left_semi").select(
        "kind", "content", "start", "stop", "row", "id"))
    place = F.struct("id", "row", "start")
    firsts = likely.groupBy("kind", "content").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = stored(firsts.filter("n > 1").drop("n"))
    later = likely.join(firsts, ["kind", "content"]).filter(place > F.col("first")).select("row", "start", "stop")
    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("start") > F.max("stop").over(before) + 1, F.lit(True))
    run = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("row").orderBy("start", "stop"))
    return later.withColumn("opens", opens).withColumn("run", run).groupBy("row", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def delete_repeated_lines(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """All rows and columns of ``df`` with later repeated runs deleted from the text, and ``n_lines``, ``n_deleted_lines``.

    Lines are what ``\\n`` separates, compared as they are; blank lines count only
    as lines, and go where they lie inside a deleted run. A run goes if its at
    least ``min_words`` words follow each other at an earlier place too: in a text
    of a smaller id, of an equal id in an earlier row, or higher up in the text.
    A null text stays null with 0 lines; ids may be null (they come first) or
    repeated. The two counts replace columns of their names.
    """
    base = stored(df.withColumn("_numberplace_row", F.monotonically_increasing_id()))
    runs = repeated_runs(
        base.select(F.col("_numberplace_row").alias("row"), F.col(id_column).alias("id"), F.col(text).alias("text")), min_words)
    # As many runs as a text has lines at most.
    runs = runs.groupBy(F.col("row").alias("_numberplace_row")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_numberplace_runs"))
    lines = F.split(text, "\n", -1)
    n_runs = F.size("_numberplace_runs")
    deleted = F.aggregate("_numberplace_runs", F.lit(0).cast("long"), lambda n, run: n + run.stop - run.start + 1)
    first = lambda k: F.when(k == 0, 0).otherwise(F.get("_numberplace_runs", k - 1).stop + 1)
    end = lambda k: F.when(k == n_runs, F.size("_numberplace_lines")).otherwise(F.get("_numberplace_runs", k).start)
    kept = F.flatten(F.transform(F.sequence(F.lit(0), n_runs), lambda k: F.slice("_numberplace_lines", first(k) + 1, end(k) - first(k))))
    out = base.join(runs, "_numberplace_row", "left").withColumn("_numberplace_lines", lines)
    return out.withColumns({
        text: F.when(F.col("_numberplace_runs").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")),
        "n_lines": F.coalesce(F.size("_numberplace_lines"), F.lit(0)).cast("long"),
        "n_deleted_lines": F.coalesce(deleted, F.lit(0)).cast("long"),
    }).drop("_numberplace_row", "_numberplace_runs", "_numberplace_lines")


def oracle_sql(table: str = "documents", min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL for the ids, counts and texts: all windows are compared as lists of lines."""
    return f"""
    WITH split AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM {table}),
    counted AS (
      SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM split),
    ahead AS (
      SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY place) AS past,
             sum(words) OVER (PARTITION BY doc_id) AS total
      FROM counted WHERE words > 0),
    windows AS (
      SELECT doc_id, 'f' AS kind, min(place) OVER w AS start, max(place) OVER w AS stop,
             list(line) OVER w AS content, past - words + {min_words} <= total AS whole
      FROM ahead WINDOW w AS (PARTITION BY doc_id ORDER BY past - words
        RANGE BETWEEN CURRENT ROW AND {min_words - 1} FOLLOWING)
      UNION ALL
      SELECT doc_id, 'b', min(place) OVER w, max(place) OVER w, list(line) OVER w, past >= {min_words}
      FROM ahead WINDOW w AS (PARTITION BY doc_id ORDER BY past
        RANGE BETWEEN {min_words - 1} PRECEDING AND CURRENT ROW)),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY kind, content ORDER BY doc_id, start) AS nth
      FROM windows WHERE whole),
    gone AS (
      SELECT DISTINCT doc_id, unnest(generate_series(start, stop)) AS place FROM ranked WHERE nth > 1)
    SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(gone.place) AS BIGINT) AS n_deleted_lines,
           coalesce(string_agg(line, chr(10) ORDER BY split.place) FILTER (gone.place IS NULL), '') AS text
    FROM split LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id"""
