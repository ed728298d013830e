import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [REPO, os.path.join(REPO, "tests"), os.path.join(REPO, "tests", "llm")]

from llm_odd import ODD, SF_DIR  # noqa: E402
from navlake.llm.common import let_workers_import  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Columns that the operators might use themselves, on every small table.
CLASHING = [
    "size", "shard", "slot", "position", "row_number", "copies", "target", "source_size", "digest",
    "maybe", "block", "spread", "id", "mark", "line", "words", "removed_lines", "n_lines", "node",
    "other", "root", "fingerprint", "component_id", "score", "predicted", "held_out", "licenses",
    "ids", "kept", "keep_id", "group_size", "n_words", "rate", "weight",
]


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text[, source]) tuples, with extra columns of clashing names."""
    let_workers_import(spark)

    def build(*rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, SCHEMA)
        if clash:
            for name in CLASHING:
                frame = frame.selectExpr("*", f"'x' as {name}")
        return frame

    return build


@pytest.fixture
def odd(docs_of):
    return docs_of(*ODD)


@pytest.fixture
def empty(docs_of, spark):
    return docs_of((0, "x")).where("doc_id < 0")


@pytest.fixture
def given(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    let_workers_import(spark)
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
