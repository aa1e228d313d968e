import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest  # noqa: E402

from pactmill.llm import queries  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, lang, source) rows, with columns of clashing names."""
    queries.prepare(spark)

    def make(rows, parts=3):
        full = [(*r, *(None,) * (4 - len(r)), None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        return df.selectExpr("*", "1 as kept", "'x' as row", "2 as size", "3 as score", "4 as key", "5 as id", "6 as bucket", "7 as _key")

    return make
