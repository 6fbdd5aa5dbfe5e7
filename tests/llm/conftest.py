from pathlib import Path

import pytest

SMALL = Path("/root/testdata/sf0.001")

#: Internal names of the operators, as columns of a caller's table.
CLASHING = {"_id": 7, "_text": "x", "_n": 1, "row": "r", "_row": 2, "_class": 3, "_source": "s", "_quality": 0}


@pytest.fixture(scope="session")
def small(spark):
    if not SMALL.exists():
        pytest.skip("test tables are absent")
    return lambda name: spark.read.parquet(str(SMALL / f"{name}.parquet"))


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a table of documents, with columns that clash with the operators' own."""

    def build(rows):
        """``rows``: ``(doc_id, text)`` or ``(doc_id, text, lang, source)``."""
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        types = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        clash = ", ".join(f"{c} {'string' if isinstance(v, str) else 'bigint'}" for c, v in CLASHING.items())
        values = [(*r, None if r[1] is None else len(r[1]), *CLASHING.values()) for r in full]
        return spark.createDataFrame(values, f"{types}, {clash}")

    return build
