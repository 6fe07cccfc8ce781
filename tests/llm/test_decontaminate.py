from __future__ import annotations

import pytest

from fleetpulse.llm import decontaminate
from fleetpulse.llm.decontaminate import contamination, drop_contaminated, word_rows
from tests.llm.helpers import contaminated, digest, documents

LONG = " ".join(f"q{i % 37}x{i}" for i in range(24))
ITEMS = [
    (1, LONG), (2, LONG.upper() + "!"), (3, "only three words"), (4, ""), (5, None),
    (6, "the the the the the the the the the the the"), (6, "only three words"),
    (7, "Ünïcode Ärger und über alles"), (8, "never seen in any document at all, not once here"),
    (9, "x"), (10, "only, THREE"), (11, "absent-word"),
]
ROWS = [
    (1, None), (2, ""), (3, LONG), (4, "pre " + LONG.replace(" ", "-") + " post"), (5, "the " * 500),
    (6, "Only THREE, words! only three words only three"), (7, LONG[:40]), (8, "--- \n"),
    (9, "ünïcode ärger und über alles"), (10, "Ünïcode Ärger und über alles"), (3, LONG), (3, "x"),
    (None, LONG), (11, ("filler " * 20_000) + LONG + " end"), (12, "only three"),
]
BENCHMARK = "item_id long, text string"


def found(spark, docs, benchmark):
    rows = word_rows(docs, decontaminate.F.col("doc_id"))
    hits = {r.row_no: r for r in contamination(rows, benchmark).collect()}
    out = []
    for r in rows.collect():
        own = hits.get(r.row_no)
        items = sorted(own["items"]) if own else []
        listed = digest(",".join(items).encode())
        out.append((r.doc_id or 0, len(r.words), own.n_hit if own else 0, len(items), listed))
    return sorted(out)


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_odd_rows_equal_brute_force(spark, limit):
    docs = documents(spark, ROWS, clashing=True)
    benchmark = spark.createDataFrame(ITEMS, BENCHMARK).selectExpr("*", "'b' AS window", "1 AS words")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = found(spark, docs, benchmark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted((i or 0, *x) for (i, _), x in zip(ROWS, contaminated(ROWS, ITEMS)))


def test_items_without_an_id_count_as_one_that_is_not_listed(spark, tmp_path):
    documents(spark, [(1, LONG), (2, "clean words only")]).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(None, LONG), (None, LONG[:80]), (7, LONG)]
    spark.createDataFrame(items, BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = decontaminate.op7_decontamination(spark, str(tmp_path)).collect()
    got = {r.doc_id: (r.n_items, r.items_sha256, r.contaminated) for r in rows}
    assert got == {1: (2, digest(b"7"), True), 2: (0, digest(b""), False)}
    import duckdb

    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    expected = duckdb.sql(decontaminate.SQL).df().set_index("doc_id")
    assert {i: tuple(expected.loc[i, ["n_items", "items_sha256", "contaminated"]]) for i in got} == got


def test_empty_tables(spark):
    none = spark.createDataFrame([], BENCHMARK)
    assert found(spark, documents(spark, []), spark.createDataFrame(ITEMS, BENCHMARK)) == []
    assert all(x[2:4] == (0, 0) for x in found(spark, documents(spark, ROWS), none))


def test_clean_documents_stay(spark):
    docs = documents(spark, ROWS, clashing=True)
    kept = drop_contaminated(docs, spark.createDataFrame(ITEMS, BENCHMARK))
    assert kept.columns == docs.columns
    expected = [(i, t) for (i, t), x in zip(ROWS, contaminated(ROWS, ITEMS)) if not x[1]]
    got = sorted(((r.doc_id or 0, r.text or "") for r in kept.collect()))
    assert got == sorted((i or 0, t or "") for i, t in expected)


def test_main_path_has_no_python(spark, tmp_path, capsys):
    docs = documents(spark, ROWS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    decontaminate.op7_decontamination(spark, str(tmp_path)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
