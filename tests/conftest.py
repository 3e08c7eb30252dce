import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from reelpulse.session import build_session

    s = build_session(
        "local[*]",
        app="reelpulse-tests",
        shuffle_partitions=8,
        extra={
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.sources.parallelPartitionDiscovery.threshold": "100000",
        },
    )
    # scratch goes to the configured spark.checkpoint.dir; only when none is
    # configured does reelpulse.session.scratch_dir pick a private temp dir
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparisons."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def plan_text(df, mode="formatted"):
    """What ``df.explain(mode)`` prints."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
