from __future__ import annotations

import pytest

from tillwise.llm import workers

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


@pytest.fixture(autouse=True)
def _workers(spark):
    workers.reach(spark)


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeats, ties, and columns with names that operators use."""
    same = "the same words in the same order make the same windows again and again until the end of it"
    rows = [
        (1, "", "a"),
        (2, None, None),
        (3, " \n\t ", "b"),
        (4, LONG, "b"),
        (5, same, "b"),
        (5, same, "b"),
        (5, "another text under the same number, with a few words of its own and nothing else besides", "c"),
        (6, same + " tail", "a"),
        (7, "one", None),
        (8, "é ß 漢字 \U0001f600 İ don't <|endoftext|>  x\x1cy", "é"),
        (None, same, "a"),
        (None, None, None),
        (-3, same, "a"),
    ]
    clash = ["size", "copies", "target", "row", "_row", "print", "d", "k", "n", "ids", "hash", "w", "src", "score", "quality", "label"]
    data = [(i, t, None if i == 7 else "xx", s, None if t is None else len(t), *(j if i != 2 else None for j in range(len(clash)))) for i, t, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in clash)
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def stored(spark, nasty, tmp_path_factory):
    """The same rows as a table of files."""
    path = str(tmp_path_factory.mktemp("nasty") / "documents.parquet")
    nasty.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, nasty, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    nasty.where("false").write.parquet(path)
    return spark.read.parquet(path)
