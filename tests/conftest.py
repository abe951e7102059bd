from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


FACTS = (
    "Domain string, Sub_domain string, Domain_table string, Area string, Item string, "
    "Element string, Unit string, Year string, Value string, `Area Code` string, __order__ bigint"
)


@pytest.fixture(scope="session")
def make_facts(spark):
    """Facts from (Area, Item, Element, Unit, Year, Value[, code]) tuples in order."""

    def make(rows, domain=("D", "S", "T")):
        full = [
            (*domain, *r[:6], r[6] if len(r) > 6 else None, i) for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(full, FACTS)

    return make
