import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clauselens.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "clauselens-tests")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def one(spark):
    """Extract one field from one text: (value, confidence) or None."""
    from clauselens.operators.extract import extract_field

    def run(field, *texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "contract_id long, text string")
        found = extract_field(rows, field).orderBy("contract_id").collect()
        values = [None if r.candidate is None else r.candidate.value for r in found]
        return values[0] if len(values) == 1 else values

    return run
