import os
import sys
from pathlib import Path

import pytest

REPO = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = f"{REPO}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from quillstone.session import session

    # Small tables: compiling each stage would take longer than running it.
    s = session("local[4]", "tests", **{"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "3", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
