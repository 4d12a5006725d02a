import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from subledger.schemas import TX_SCHEMA  # noqa: E402
from subledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    """A timestamp from ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss``; None stays None."""
    return None if text is None else datetime.fromisoformat(text)


@pytest.fixture
def make_tx(spark):
    """Normalised transactions from short dicts; dates may be given as text."""
    def make(*rows):
        full = []
        for place, row in enumerate(rows):
            values = {"tie": place, **row}
            for name in ("trans_date", "act_date", "reno_date"):
                if isinstance(values.get(name), str):
                    values[name] = at(values[name])
            if values.get("trans_date") is not None:
                values.setdefault("year_month", values["trans_date"].strftime("%Y-%m"))
            full.append(tuple(values.get(f.name) for f in TX_SCHEMA.fields))
        return spark.createDataFrame(full, TX_SCHEMA)

    return make


def tuples(rows):
    """All rows as tuples, sorted."""
    return sorted((tuple(r) for r in rows.collect()), key=repr)
