import os

import pytest

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with every odd case: nulls in each column, empty and blank texts, one very
    long text, ties, repeated rows, and extra columns whose names operators use inside."""
    shared = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [
        (1, shared, "en", "a"), (2, shared, "en", "a"), (2, shared, "en", "a"), (3, shared + " tail", "en", "b"),
        (4, None, "en", "b"), (5, "", None, None), (6, " \t\n ", "fr", "c"), (None, "nobody owns this text at all", "en", "a"),
        (7, "Licensed under the Apache License, Version 2.0.\nRest of it", "en", None), (8, "word", "de", "c"),
        (9, "Éa ÉA don't 'll  漢字 <|endoftext|> x", "fr", "c"), (10, "long words " * 30_000, "en", "d"),
        (11, "A!! B!! C!! A!! B!! C!!", "en", "a"), (12, shared.upper(), "en", "b"),
    ]
    rows = [(*r, "x", 1, 2, "y", None) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                 "size string, v int, block int, label string, _doc string")


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.filter("false")
