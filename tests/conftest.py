import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(str(tmp_path_factory.mktemp("shared")), 4, memory="4g", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def jsonl(tmp_path):
    """Write records (or raw lines) as a JSON lines file and give its path."""

    def write(*records, name="in.jsonl"):
        path = tmp_path / name
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        path.write_text("".join(line + "\n" for line in lines))
        return str(path)

    return write


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
