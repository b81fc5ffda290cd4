from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for the Python workers


@pytest.fixture(scope="session")
def spark():
    from tessera.session import session

    found = session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__sql__sources__parallelPartitionDiscovery__parallelism="4")
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
