import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from genrec.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    yield local_session("*", shuffle_partitions=8, app_name="genrec-tests")


@pytest.fixture(scope="session")
def docs(spark):
    """Edge rows: null, empty and blank texts, a null id, a repeated row, a very long text, a clashing column."""
    def make(rows, extra=None):
        df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
        for name in extra or ():
            df = df.withColumn(name, df.doc_id)
        return df

    return make
