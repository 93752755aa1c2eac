import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from airlens.session import build_session

    s = build_session("local[4]", 4, app_name="airlens-tests")
    yield s
    s.stop()


@pytest.fixture
def write_files(tmp_path):
    """Write ``{name: text}`` into a fresh folder and return its path."""
    def make(files: dict, sub: str = "in"):
        d = tmp_path / sub
        d.mkdir(parents=True, exist_ok=True)
        for name, text in files.items():
            (d / name).write_text(text)
        return str(d)
    return make
