from __future__ import annotations

import os

import pytest

from fleetpulse.sources import staging
from fleetpulse.sources.tables import (
    create_schema,
    drop_schemas,
    save_table,
    use_catalog,
)
from tests.helpers import rows


@pytest.fixture
def schema(spark):
    name = "tables_test"
    drop_schemas(spark, name)
    yield name
    drop_schemas(spark, name)


def frame(spark, *values):
    return spark.createDataFrame([(v, f"t{v}") for v in values], "a int, b string")


def test_overwrite_replaces_and_append_adds(spark, schema):
    name = f"{schema}.t"
    save_table(frame(spark, 1, 2), name)
    save_table(frame(spark, 3), name)
    assert rows(spark.table(name), "a") == [(3,)]
    save_table(frame(spark, 4).select("b", "a"), name, mode="append")
    assert rows(spark.table(name)) == [(3, "t3"), (4, "t4")]


def test_managed_unless_given_a_location(spark, schema, tmp_path):
    save_table(frame(spark, 1), f"{schema}.managed")
    save_table(frame(spark, 1), f"{schema}.external", location=f"{tmp_path}/files")
    kinds = {t.name: t.tableType for t in spark.catalog.listTables(schema)}
    assert kinds == {"managed": "MANAGED", "external": "EXTERNAL"}
    assert rows(spark.read.parquet(f"{tmp_path}/files"), "a") == [(1,)]
    save_table(frame(spark, 2), f"{schema}.external", location=f"{tmp_path}/files")
    assert rows(spark.table(f"{schema}.external"), "a") == [(2,)]


def test_format_is_a_parameter(spark, schema):
    save_table(frame(spark, 1), f"{schema}.t", fmt="orc")
    detail = spark.sql(f"DESCRIBE EXTENDED {schema}.t").where("col_name = 'Provider'")
    assert detail.first()["data_type"].lower() == "orc"


def test_schema_without_a_namespace(spark):
    try:
        save_table(frame(spark, 1), "plain_table")
        assert rows(spark.table("plain_table"), "a") == [(1,)]
    finally:
        spark.sql("DROP TABLE IF EXISTS plain_table")


def test_only_named_schemas_are_dropped(spark, schema):
    create_schema(spark, schema)
    create_schema(spark, "tables_test_kept")
    save_table(frame(spark, 1), f"{schema}.t")
    drop_schemas(spark, schema, "tables_test_never_made")
    names = [d.name for d in spark.catalog.listDatabases()]
    assert schema not in names and "tables_test_kept" in names
    drop_schemas(spark, "tables_test_kept")


def test_catalog_can_be_chosen(spark):
    use_catalog(spark, "spark_catalog")
    assert spark.catalog.currentCatalog() == "spark_catalog"


def test_staged_rows_survive_their_source(spark):
    source = frame(spark, 1, 2)
    staged = staging.stage(source.where("a > 1"), "test")
    assert staged.path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert rows(staged.frame) == [(2, "t2")]
    assert staged.frame.schema == source.schema
    staged.discard()
    assert not os.path.exists(staged.path)


def test_a_cluster_must_name_its_shared_folder(monkeypatch):
    folders = []

    class Context:
        master = "spark://host:7077"
        setCheckpointDir = folders.append

        def getCheckpointDir(self):
            return folders[0] if folders else None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())
    monkeypatch.setattr(Context, "master", "local-cluster[2,1,1024]")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())
    monkeypatch.setattr(Context, "master", "local[2]")
    folder = staging.shared_folder(Session())
    assert os.path.isdir(folder) and folder == staging.shared_folder(Session())
