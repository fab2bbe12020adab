import random
import re

import pytest

SF = "/root/testdata/sf0.001"
SPACE = r"[^\x20\x09-\x0D]+"

#: Names that the operators use inside.
CLASHING = ("node n token u v component row place hash words kind content start stop mark id part block size score "
            "held_out language gram value lower upper key label tokens file offset record payload item passage url "
            "html_text document term n_words perplexity kept base_failed n_lines n_shingles component_id").split()


def words(text):
    return re.findall(SPACE, text or "")


def prose(rng, n):
    return " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "été", "straße", "niño", "a", "of"]) +
                    rng.choice(["", "us", "en", ",", ".", "x" * rng.randint(0, 3)]) for _ in range(n))


def awkward_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty, blank and long texts, ties, repeated rows, near copies."""
    rng = random.Random(11)
    base = [prose(rng, n) for n in (3, 5, 40, 60, 80, 120, 200, 300)]
    lines = "\n".join(prose(rng, 12) for _ in range(30))
    texts = [None, "", " \n\t ", "one", "Same Five Words Are Here", "same five words are here", *base, lines, lines,
             lines + "\n" + base[5], base[4] + "\n" + lines, base[6] + " changed", base[6], "x" * 30_000,
             " ".join(["again"] * 500), prose(rng, 6_000), "# $ % | <b> & " * 30, "tail\n\n\n" + lines.split("\n")[0]]
    rows = [(k, text, ["en", "de", None][k % 3], f"s{k % 2}", len(text or "")) for k, text in enumerate(texts)]
    rows += [rows[10], rows[10], (None, texts[10], None, None, None), (None, None, "en", "s", 0), (7, texts[9], "en", "s", 1)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward_docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(spark):
    """Adds columns with the names that operators use inside."""
    from pyspark.sql import functions as F

    def add(df):
        return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING if name not in df.columns})

    return add


def rows_of(df):
    """All rows, in an order that nulls do not disturb."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
