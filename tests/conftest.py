import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tickwell.session import create_root, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture
def root(spark, tmp_path):
    return create_root(spark, str(tmp_path / "lake"))


@pytest.fixture
def put(root):
    """Store a document the way a fetch job does: one file under its key."""

    def write(prefix: str, at: str, text: str) -> str:
        date, time = at.split("T")
        path = f"{root}/raw/{prefix}/date={date}/fetched_at={date}T{time.replace(':', '-')}Z.json"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        return path

    return write
