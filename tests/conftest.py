from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false", "spark.local.dir": str(base / "local"),
        "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.checkpoint.dir": f"file://{base}/checkpoint", "spark.driver.memory": "4g", "spark.driver.extraJavaOptions": f"-Dderby.system.home={base}",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
