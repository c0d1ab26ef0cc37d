import os
import struct
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="areaweave-")
    session = (SparkSession.builder.master("local[8]").appName("areaweave-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", warehouse)
               .config("spark.driver.memory", "8g").config("spark.sql.maxMetadataStringLength", "10000")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def _ring(points, order):
    closed = [*points, points[0]]
    return struct.pack(order + "I", len(closed)) + b"".join(struct.pack(order + "dd", *p) for p in closed)


def polygon_wkb(*rings, order="<", srid=None):
    """Well-known binary of a polygon; ``srid`` makes it extended."""
    code = 3 | (0x20000000 if srid else 0)
    head = struct.pack(order + "BI", 1 if order == "<" else 0, code)
    if srid:
        head += struct.pack(order + "I", srid)
    return head + struct.pack(order + "I", len(rings)) + b"".join(_ring(r, order) for r in rings)


def multi_wkb(*polygons, order="<"):
    return (struct.pack(order + "BII", 1 if order == "<" else 0, 6, len(polygons))
            + b"".join(polygon_wkb(*rings, order=order) for rings in polygons))


def square(x, y, side=1.0, height=None):
    height = side if height is None else height
    return [(x, y), (x + side, y), (x + side, y + height), (x, y + height)]


def values(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
