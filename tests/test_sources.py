import uuid

from tenantmart.operators.load import Warehouse
from tenantmart.operators.tenants import catalog_schemas
from tenantmart.sources import JdbcPartitioning, JdbcSource, ParquetSource

from conftest import SF_SMALL


def test_parquet_source_reads_driver_tables(spark):
    src = ParquetSource(spark, SF_SMALL)
    assert src("region").count() == 5


def test_jdbc_source_options_partition_large_tables(spark):
    src = JdbcSource(spark, "jdbc:sqlserver://host;databaseName=t1", {"user": "u"},
                     {"pointage": JdbcPartitioning("idpointage", 1, 1_000_000, 16)}, schema="dbo")
    o = src.options("pointage")
    assert o["dbtable"] == "dbo.pointage" and o["numPartitions"] == "16"
    assert o["partitionColumn"] == "idpointage" and o["user"] == "u"
    assert "numPartitions" not in src.options("fermes")


def test_catalog_schema_listing(spark):
    name = f"ten_{uuid.uuid4().hex[:8]}"
    Warehouse(spark, name)
    got = [r.schema_name for r in catalog_schemas(spark, "ten\\_%").collect()]
    assert name in got
