import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]").appName("quarry-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None) and not session.sparkContext.getCheckpointDir():
        # Only where the cluster names none (tests): our own scratch folder,
        # registered on the SparkContext (a core setting cannot be changed
        # through spark.conf at runtime).
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_table(spark):
    from quarry.session import run_path

    def make(name="t"):
        return run_path(spark, f"test-{name}")
    return make


def plan_text(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() if mode == "executed" else _explain(df, mode)


def _explain(df, mode):
    import io
    import contextlib

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
