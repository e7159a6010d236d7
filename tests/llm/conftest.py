from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm import plain

#: Names that the operators use themselves.
CLASHING = (
    "id copy node verdict _host _seen size copies component _id _copy pos line keep place band "
    "root task side code n_words kept terms all base said luck part level mass"
).split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows, with clashing columns if asked for."""

    def make(rows, clashing=False):
        schema = "doc_id long, text string, source string"
        docs = spark.createDataFrame([tuple(row) for row in rows], schema)
        docs = docs.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})
        if clashing:
            docs = docs.withColumns({name: F.lit(f"own {name}") for name in CLASHING})
        return docs

    return make


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents table and its rows in order."""
    docs = spark.read.parquet(f"{plain.FOLDER}/documents.parquet")
    return docs, docs.select("doc_id", "text", "source").orderBy("doc_id").collect()
