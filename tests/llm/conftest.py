import os
from pathlib import Path

import pytest

os.environ["PYTHONPATH"] = os.pathsep.join(
    x for x in (str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH", "")) if x
)


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
