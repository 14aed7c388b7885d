import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)  # for Python workers


@pytest.fixture(scope="session")
def spark():
    from tests.check import session

    from medtable.session import configure
    s = configure(session("4"))
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def one(spark):
    """Evaluate named columns over a single row."""
    from pyspark.sql import functions as F

    def run(**cols):
        row = spark.range(1).select(*[(c if not isinstance(c, str) else F.expr(c)).alias(n) for n, c in cols.items()]).collect()[0]
        return row.asDict(recursive=True)
    return run
