"""JDBC wiring (no database may run here: the writer/reader calls are captured)."""

import pytest
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from strata.sources import jdbc


def test_write_options_and_env_credentials(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc",
                        lambda self, url, table, mode=None, properties=None:
                        calls.append((url, table, mode, properties)))
    monkeypatch.setenv("STRATA_JDBC_URL", "jdbc:postgresql://db/datamart")
    monkeypatch.setenv("STRATA_JDBC_USER", "etl")
    monkeypatch.setenv("STRATA_JDBC_PASSWORD", "from-env")
    monkeypatch.setenv("STRATA_JDBC_DRIVER", "org.postgresql.Driver")
    df = spark.range(3)
    jdbc.write_jdbc(df, "dm_weather_accidents", num_partitions=4, batch_size=500)
    url, table, mode, props = calls[0]
    assert (url, table, mode) == ("jdbc:postgresql://db/datamart", "dm_weather_accidents",
                                  "overwrite")
    assert props == {"user": "etl", "password": "from-env", "driver": "org.postgresql.Driver",
                     "numPartitions": "4", "batchsize": "500", "truncate": "true"}
    jdbc.jdbc_publisher()("gold_final_accidents", df)
    assert calls[1][1] == "gold_final_accidents" and "numPartitions" not in calls[1][3]


def test_missing_url_is_an_error(spark, monkeypatch):
    monkeypatch.delenv("STRATA_JDBC_URL", raising=False)
    with pytest.raises(ValueError):
        jdbc.write_jdbc(spark.range(1), "t")


def test_partitioned_read(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameReader, "jdbc",
                        lambda self, url, table, **kw: calls.append((url, table, kw)))
    jdbc.read_jdbc(spark, "gold_final_accidents", url="jdbc:x", properties={"user": "u"},
                   partition_column="Severity", lower=1, upper=4, num_partitions=4)
    url, table, kw = calls[0]
    assert (url, table, kw["column"], kw["lowerBound"], kw["upperBound"],
            kw["numPartitions"]) == ("jdbc:x", "gold_final_accidents", "Severity", 1, 4, 4)
