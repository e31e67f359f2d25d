from __future__ import annotations

import pytest
from corpus_texts import prose
from pyspark.sql import types as T

CLASHING = ("kept", "_row", "_file", "_times", "doc", "id", "node", "size", "label", "toxicity", "times", "shard")
DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names the operators use themselves
        *[T.StructField(n, T.StringType()) for n in CLASHING],
    ]
)


def edge_rows() -> list[tuple]:
    long_text = prose(99, 40_000)
    texts: list[tuple[int | None, str | None]] = [
        (1, prose(1, 120)), (2, prose(1, 120)), (3, prose(1, 120).replace(" ", "  \t")), (4, prose(4, 90)),
        (5, None), (6, ""), (7, " \t\n "), (8, "one"), (9, "two words"), (10, "two words"), (10, "two words"),
        (None, prose(1, 120)), (None, "lost id"), (None, None), (11, long_text), (12, long_text + " end"),
        (13, "same " * 3000), (14, "a" * 5000), (15, prose(4, 45) + " " + prose(5, 60)),
        (16, "line one here\nline one here\n\n \nother # line | <x>\nline one here"),
        (17, "été çà là naïve  nbsp words that stay\x0btogether"), (18, "café <|endoftext|> tail "),
    ]
    copies = [(100 + k, prose(50, 100)) for k in range(30)]
    changed = []
    for k in range(45):
        words = prose(60, 150).split()
        words[(7 * k) % 150] = f"new{k}"
        changed.append((200 + k, " ".join(words)))
    rows = []
    for n, (doc, text) in enumerate([*texts, *copies, *changed]):
        lang = [None, "en", "de", "fr"][n % 4]
        source = [None, "src0", "src0", "src0", "src12", "plain"][n % 6]
        rows.append((doc, text, lang, source, None, *[f"{name} of {n}" for name in CLASHING]))
    return rows


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """A stored table with nulls, empty and long texts, ties, repeats and clashing names."""
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame(edge_rows(), DOCUMENT).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def unchanged():
    """Checks that rows of a stage are rows of the edge table, all columns with their values."""
    known = {row[-1]: row for row in edge_rows()}

    def check(stage):
        found = [tuple(r) for r in stage.collect()]
        assert all(known[row[-1]] == row for row in found)
        return found

    return check


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nothing") / "documents.parquet")
    spark.createDataFrame([], DOCUMENT).write.parquet(path)
    return spark.read.schema(DOCUMENT).parquet(path)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (4, 1, 0), (8, 0, 1), (None, 0, 1), (9, None, None), (9, 1, 1)], "doc_id long, quality int, toxic int"
    )
