import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(spark):
    from eventmart.llm.textbatch import prepare

    return prepare(spark)
