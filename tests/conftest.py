import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from telemetry_rows import BASE, SECOND  # noqa: E402

from teletide.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1")
               .config("spark.log.level", "ERROR")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    return configure(session)


@pytest.fixture
def make(spark):
    """Rows of a telemetry table from dictionaries; columns left out are NULL."""
    from teletide.model import SCHEMAS

    def build(name, rows):
        schema = SCHEMAS[name]
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
    return build


@pytest.fixture
def logs(make):
    def build(rows):
        return make("logs", [
            {"attributes": "{}", "severity_number": 9, "record_id": i, "time": BASE + i * SECOND, **r}
            for i, r in enumerate(rows)])
    return build


@pytest.fixture
def gauge(make):
    def build(rows, name="metrics_gauge"):
        return make(name, [
            {"attributes": "{}", "service": "web", "unit": "", "point_time": BASE + i * SECOND, **r}
            for i, r in enumerate(rows)])
    return build


@pytest.fixture
def spans(make):
    def build(rows):
        return make("spans", [
            {"trace_id": f"{1:032x}", "span_id": f"{i + 1:016x}", "name": "op", "kind": "SERVER",
             "start_time": BASE + i, "duration_ns": 1_000_000, "status_code": "OK", "service": "web",
             "attributes": "{}", **r}
            for i, r in enumerate(rows)])
    return build
