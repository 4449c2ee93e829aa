"""Catalog, lifecycle, topic views, point reads."""


from strata.operators.merge import bounded_scan, delete_keys, point_read
from strata.sources import catalog
from strata.sources.jdbc import to_camel


def test_table_lifecycle(spark):
    rows = [("r", None, {"sink_table": "dim_a", "sink_columns": "id,name"}),
            ("c", None, {"sink_table": "dim_b", "sink_columns": "id"}),
            ("u", {"sink_table": "dim_a"}, {"sink_table": "dim_a", "sink_columns": "id,name,extra"}),
            ("d", {"sink_table": "dim_b", "sink_columns": "id"}, None)]
    cfg = spark.createDataFrame(rows, "op string, before map<string,string>, after map<string,string>")
    catalog.apply_table_lifecycle(spark, cfg, "lifecycle_db")
    tables = {t.name for t in spark.catalog.listTables("lifecycle_db")}
    assert tables == {"dim_a"}
    assert spark.table("lifecycle_db.dim_a").columns == ["id", "name", "extra"]


def test_topic_view_and_point_reads(spark):
    lines = spark.createDataFrame([('{"id": "1", "v": "a"}',), ('{"id": "2", "v": "b"}',), ('{"id": "3"}',)], "value string")
    df = catalog.topic_view(spark, lines, "id string, v string", "topic_t")
    assert spark.sql("SELECT count(*) FROM topic_t WHERE v IS NOT NULL").first()[0] == 2
    assert [r.v for r in point_read(df, "id", "2").collect()] == ["b"]
    assert [r.id for r in bounded_scan(df, "id", 2).collect()] == ["1", "2"]
    keys = spark.createDataFrame([("1",)], "id string")
    assert sorted(r.id for r in delete_keys(df, keys, "id").collect()) == ["2", "3"]


def test_camel_names():
    assert to_camel("sink_row_key") == "sinkRowKey" and to_camel("id") == "id"
