import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from hearth.session import build

    s = build(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
        },
    )
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Collected rows as a sorted list of plain tuples."""
    return lambda df, *cols: sorted(
        (tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: tuple((v is not None, str(v)) for v in r)
    )
