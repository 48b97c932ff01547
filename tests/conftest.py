import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from urbanweave.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def make_ways(spark, rows):
    """Ways from ``(osm_id, tags, [(x, y), ...])``."""
    from pyspark.sql import functions as F

    from urbanweave.functions import lines

    data = [(i, i, t, [(float(x), float(y)) for x, y in c]) for i, t, c in rows]
    schema = "osm_id long, ord long, tags map<string,string>, coords array<struct<x:double,y:double>>"
    return spark.createDataFrame(data, schema).withColumn("closed", lines.is_closed(F.col("coords")))
