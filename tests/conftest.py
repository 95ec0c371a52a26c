import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.config import ORDER_FEED_COLUMNS  # noqa: E402
from quayside.session import build_session, workspace_root  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    workspace_root(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from contract.workspace import workspace

    return workspace(spark, SF_DIR)


# One complete feed row; tests override what they are about.
BASE = {
    "Type": "DEBIT",
    "Days for shipping (real)": "3",
    "Days for shipment (scheduled)": "4",
    "Benefit per order": "10.5",
    "Delivery Status": "Shipping on time",
    "Late_delivery_risk": "0",
    "Category Id": "7",
    "Category Name": "Golf",
    "Customer City": "Caguas",
    "Customer Country": "EE. UU.",
    "Customer Fname": "Ann",
    "Customer Id": "11",
    "Customer Lname": "Lee",
    "Customer Segment": "Consumer",
    "Customer State": "PR",
    "Customer Street": "1 Main",
    "Customer Zipcode": "725",
    "Department Id": "2",
    "Department Name": "Fitness",
    "Latitude": "18.25",
    "Longitude": "-66.03",
    "Market": "LATAM",
    "Order City": "Lima",
    "Order Country": "Peru",
    "Order Customer Id": "11",
    "order date (DateOrders)": "1/1/2018 12:30",
    "Order Id": "100",
    "Order Item Cardprod Id": "9",
    "Order Item Discount": "1.0",
    "Order Item Discount Rate": "0.1",
    "Order Item Id": "1000",
    "Order Item Product Price": "10.0",
    "Order Item Profit Ratio": "0.2",
    "Order Item Quantity": "2",
    "Sales": "20.0",
    "Order Item Total": "18.0",
    "Order Profit Per Order": "10.5",
    "Order Region": "South America",
    "Order State": "Lima",
    "Order Status": "COMPLETE",
    "Product Card Id": "9",
    "Product Name": "Ball",
    "Product Price": "10.0",
    "Product Status": "0",
    "shipping date (DateOrders)": "1/5/2018 9:00",
    "Shipping Mode": "Standard Class",
    "_ingested_at": "2024-01-01 00:00:00",
}


@pytest.fixture(scope="session")
def feed(spark):
    """feed([{column: value}, ...]) -> bronze rows with those values over a complete base row."""
    from pyspark.sql import functions as F

    columns = [*ORDER_FEED_COLUMNS, "_ingested_at"]

    def make(rows):
        data = [tuple({**BASE, **r}[c] for c in columns) for r in rows]
        schema = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame(data, schema).withColumn("_ingested_at", F.to_timestamp("_ingested_at"))

    return make
