from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quayside.session import checkpoint_dir, local_session

    session = local_session(cores=4, shuffle_partitions=4, driver_memory="4g")
    # Tests are the one place that sets its own checkpoint folder, and only
    # because the session has none.
    checkpoint_dir(session, fallback=tempfile.mkdtemp(prefix="quayside-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quayside-test-")


def carrying(spark, *values):
    """Events of the given tables as bus messages, event n with the n-th of ``values`` as its value (text, or a mapping sent as JSON)."""
    from pyspark.sql import functions as F

    sent = F.array(*[F.lit(v if v is None or isinstance(v, str) else json.dumps(v)) for v in values])
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter(F.col("event_id").between(1, len(values)))
    return events.select(F.element_at(sent, F.col("event_id").cast("int")).cast("binary").alias("value"))
