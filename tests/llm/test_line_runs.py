import random

from pyspark.sql import functions as F

from numberplace.llm import line_runs as L

from .conftest import rows_of, words


def brute(rows, least):
    """Texts in order; each window of lines of `least` words, forward or back, that stood before is deleted."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    seen, out = {}, {}
    for k in order:
        text = rows[k][1]
        lines = [] if text is None else text.split("\n")
        spoken = [(i, len(words(line))) for i, line in enumerate(lines) if words(line)]
        gone = set()
        for kind in "fb":
            for a in range(len(spoken)):
                total, run = 0, []
                for i, n in spoken[a:] if kind == "f" else spoken[a::-1]:
                    run.append(i)
                    total += n
                    if total >= least:
                        break
                if total >= least:
                    low, high = min(run), max(run)
                    content = (kind, *(lines[i] for i in sorted(run)))
                    first = seen.setdefault(content, (order.index(k), low))
                    if (order.index(k), low) > first:
                        gone |= set(range(low, high + 1))
                    seen[content] = min(first, (order.index(k), low))
        kept = None if text is None else "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out[k] = (rows[k][0], len(lines), len(gone), kept)
    return sorted(out.values(), key=repr)


def deleted(df, least):
    return rows_of(L.delete_repeated_lines(df, min_words=least).select("doc_id", "n_lines", "n_deleted_lines", "text"))


def test_awkward_rows(awkward_docs, clashing):
    # Rows of equal id are taken in the order they are read in.
    unique = awkward_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).coalesce(1)
    expected = brute([(r.doc_id, r.text) for r in unique.collect()], 50)
    assert deleted(unique, 50) == expected and any(x[2] for x in expected)
    assert deleted(clashing(unique), 50) == expected
    assert deleted(unique.limit(0), 50) == []
    with_rest = L.delete_repeated_lines(clashing(awkward_docs))
    assert with_rest.count() == awkward_docs.count() and "own place" in {r.place for r in with_rest.collect()}


def test_runs_by_chance(spark):
    rng = random.Random(9)
    pool = [" ".join(["w"] * rng.randint(1, 4)) + str(k) for k in range(8)]
    for least in (1, 3, 7, 12):
        rows = [(k, "\n".join(rng.choice([*pool, "", " "]) for _ in range(rng.randint(1, 25)))) for k in range(40)]
        assert deleted(spark.createDataFrame(rows, "doc_id long, text string"), least) == brute(rows, least)


def test_first_place_stays_and_short_lines_stay(spark):
    passage = "\n".join(f"line {k} of a passage with nine words here" for k in range(7))
    rows = [(k, f"own start {k}\n{passage}\nown end {k}\nThe same short line.") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = L.delete_repeated_lines(df)
    assert out.filter(F.contains("text", F.lit(passage))).select("doc_id").collect() == [(0,)]
    assert out.filter(F.contains("text", F.lit("The same short line."))).count() == 200
    assert not any("Arrow" in x or "Python" in x for x in out._jdf.queryExecution().toString().split())
