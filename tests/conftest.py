import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from recordlake.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="rl-test-ckpt-")
    s = get_spark("local[4]", 4, app_name="recordlake-tests",
                  extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from recordlake.session import scratch_path

    return scratch_path(spark, "test")


def rows(df, *cols):
    """Sorted list of tuples (None sorts first)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is not None, x) for x in t))


def plan_text(df, mode="formatted"):
    """The physical plan as text."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
