import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from samples import RAW, SAMPLE  # noqa: E402

from stayline.operators.cleaning import standardise_names, to_number  # noqa: E402
from stayline.session import local_session  # noqa: E402
from stayline.sources.tables import read_customers_csv  # noqa: E402

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "stayline-tests",
        **{
            "spark__ui__showConsoleProgress": "false",
            "spark__sql__shuffle__partitions": "4",
            "spark__checkpoint__dir": str(tmp_path_factory.mktemp("shared")),
            "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return str(DATA / "sf0.001")


def _csv(spark, folder, name, text):
    path = folder / name
    path.write_text(text)
    return read_customers_csv(spark, str(path))


@pytest.fixture(scope="session")
def raw(spark, tmp_path_factory):
    return _csv(spark, tmp_path_factory.mktemp("csv"), "raw.csv", RAW)


@pytest.fixture(scope="session")
def sample(spark, tmp_path_factory):
    frame = standardise_names(_csv(spark, tmp_path_factory.mktemp("csv"), "sample.csv", SAMPLE))
    return frame.withColumn("total_charges", to_number(frame["total_charges"])).cache()
