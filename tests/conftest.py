import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from dealspark import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_json(tmp_path):
    """Write JSON-lines envelopes into a fresh folder and return its path."""
    def write(*lines: str) -> str:
        d = tmp_path / "landed"
        d.mkdir(exist_ok=True)
        (d / f"part-{len(list(d.iterdir())):03d}.json").write_text("\n".join(lines) + "\n")
        return str(d)
    return write


def plan_text(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
