from __future__ import annotations

import pytest

from rebasket.schemas import TABLES
from rebasket.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# First orders, a repeated line, a product and an order that do not exist, a
# null label, an order without lines and a gap of zero days.
EDGE = {
    "orders": [
        (1, 10, "prior", 1, 1, 9, None),
        (2, 10, "prior", 2, 2, 10, 7.0),
        (3, 10, "train", 3, 3, 11, 0.0),
        (4, 20, "train", 1, 6, 23, None),
        (5, 20, "test", 2, 0, 0, 30.0),
    ],
    "order_products_prior": [
        (1, 501, 1, 0),
        (1, 502, 2, 0),
        (2, 501, 1, 1),
        (2, 501, 3, 1),
        (2, 999, 2, 0),
    ],
    "order_products_train": [(3, 501, 6, 1), (3, 502, 2, None), (4, 502, 1, 0), (77, 501, 1, 1)],
    "products": [(501, "p1", 11, 1), (502, "p2", 12, 2)],
    "aisles": [(11, "a1"), (12, "a2")],
    "departments": [(1, "d1"), (2, "d2")],
}


@pytest.fixture(scope="session")
def edge(spark):
    return {name: spark.createDataFrame(rows, TABLES[name]) for name, rows in EDGE.items()}


@pytest.fixture(scope="session")
def edge_joined(edge):
    from rebasket.operators.joined import build_joined

    return build_joined(
        edge["orders"], edge["order_products_prior"], edge["order_products_train"], edge["products"]
    )
