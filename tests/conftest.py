import datetime as dt
import os
import sys
from dataclasses import replace

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ebbtide.params import ChurnParams, ModelParams
from ebbtide.session import local_session, shared_folder
from ebbtide.sources.schemas import ORDER_HEADER, ORDER_ITEM

AS_OF = dt.date(2001, 8, 1)
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def params():
    return ChurnParams(as_of=AS_OF)


def few_rounds(count: int) -> ModelParams:
    """Model settings for unit tests; the registered queries use the full ones."""
    full = ModelParams()
    return replace(
        full,
        specs={r: replace(s, trees=count) for r, s in full.specs.items()},
        other=replace(full.other, trees=count),
    )


def ago(days: int) -> dt.date:
    return AS_OF - dt.timedelta(days=days)


@pytest.fixture
def orders(spark):
    """order_header from dicts with ``days`` ago and any columns that matter."""

    def make(rows):
        full = []
        for number, row in enumerate(rows, start=1):
            on = ago(row["days"])
            full.append(
                (
                    row.get("id", number),
                    row.get("member", 1),
                    dt.datetime.combine(on, row.get("time", dt.time())),
                    on,
                    row.get("total", 100.0),
                    row.get("outlet", "A"),
                    row.get("tier", "GOLD"),
                    row.get("number", str(row.get("id", number))),
                )
            )
        return spark.createDataFrame(full, ORDER_HEADER)

    return make


@pytest.fixture
def items(spark):
    def make(rows):
        full = [
            (
                row["number"],
                row.get("group", "food"),
                row.get("brand", "b"),
                row.get("sku", "s"),
                row.get("quantity", 1.0),
                row.get("price", 10.0),
                row.get("paid", 10.0),
            )
            for row in rows
        ]
        return spark.createDataFrame(full, ORDER_ITEM)

    return make


@pytest.fixture(scope="session")
def modelling(spark):
    """The modelling set of the sample tables, stored once."""
    from ebbtide.checks.queries import dataset

    return dataset(spark, DATA)


@pytest.fixture(scope="session")
def model(spark, modelling):
    from ebbtide.plans.training import train_models

    return train_models(modelling, few_rounds(3))
