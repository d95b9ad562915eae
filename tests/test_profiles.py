"""Environment profiles: completion of names, and errors that name every fault before any row is read."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from salesfacts.config import NA_PBC
from salesfacts.plans.pipeline import run
from salesfacts.plans.registry import LOAD_TS
from salesfacts.sources.catalog import LOGICAL_TABLES, SourceCatalog, write_standins
from salesfacts.sources.profiles import ProfileError, bind, load_profile, parse_profile


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    return write_standins(spark, SF_SMALL, str(tmp_path_factory.mktemp("in")))


def _spec(paths, **kw):
    return {"environment": "test", "tables": {n: {"path": p} for n, p in paths.items()}, **kw}


def test_names_are_completed():
    tables = {n: n for n in LOGICAL_TABLES} | {"order_lines": "other.lines", "account_xref": "c.n.`x.y`", "billing_lines": {"path": "bills"},
                                               "delivery_lines": {"path": "s3://b/d", "format": "orc"}}
    got = parse_profile(json.dumps({"environment": "np", "catalog": "main", "namespace": "erp", "root": "/r/", "tables": tables}))
    assert got.environment == "np"
    assert {n: str(b) for n, b in got.bindings.items()} == {
        "material_master": "main.erp.material_master", "exchange_rates": "main.erp.exchange_rates", "order_lines": "main.other.lines",
        "delivery_lines": "orc:s3://b/d", "billing_lines": "parquet:/r/bills", "account_xref": "c.n.`x.y`"}


@pytest.mark.parametrize("change,words", [
    (lambda s: s["tables"].pop("exchange_rates") and s["tables"].pop("account_xref"), ["exchange_rates: not bound", "account_xref: not bound"]),
    (lambda s: s["tables"].update(orders="x"), ["unknown table orders"]),
    (lambda s: s.update(schema="x"), ["unknown setting schema"]),
    (lambda s: s["tables"].update(order_lines={"table": "a", "path": "b"}), ["order_lines: a binding is"]),
])
def test_faults_of_the_file_are_named(paths, change, words):
    spec = _spec(paths)
    change(spec)
    with pytest.raises(ProfileError) as e:
        parse_profile(json.dumps(spec))
    assert all(f"profile test: {w}" in str(e.value) for w in words)


def test_not_json_and_no_tables():
    for text in ("{", "[]", "{}"):
        with pytest.raises(ProfileError):
            parse_profile(text)


def test_schemas_are_checked_before_any_read(spark, paths, tmp_path):
    """Missing columns, a wrong type and a missing table are reported together, and no Spark job runs over the rows."""
    orders = spark.read.parquet(paths["order_lines"])
    orders.drop("sold_to").write.parquet(str(tmp_path / "orders"))
    bills = spark.read.parquet(paths["billing_lines"])
    bills.withColumn("subtotal_1", F.col("subtotal_1").cast("double")).write.parquet(str(tmp_path / "bills"))
    spec = _spec({**paths, "order_lines": str(tmp_path / "orders"), "billing_lines": str(tmp_path / "bills"), "account_xref": str(tmp_path / "nowhere")})
    with pytest.raises(ProfileError) as e:
        bind(spark, parse_profile(json.dumps(spec)))
    lines = str(e.value).splitlines()
    assert len(lines) == 3
    assert "order_lines" in lines[0] and "missing column sold_to" in lines[0]
    assert "billing_lines" in lines[1] and "wider than the contract" in lines[1]
    assert "account_xref" in lines[2] and "nowhere" in lines[2]


def test_two_environments_give_the_same_result(spark, paths, tmp_path):
    file = str(tmp_path / "np.json")
    spark.sql("CREATE NAMESPACE np_test")
    try:
        for n, p in paths.items():
            spark.catalog.createTable(f"np_test.{n}", path=p, source="parquet")
        spec = {"environment": "np", "namespace": "np_test", "tables": {n: n for n in paths}}
        spark.createDataFrame([(json.dumps(spec, indent=1),)], "value string").coalesce(1).write.text(file)
        got = run(bind(spark, load_profile(spark, file)), NA_PBC, LOAD_TS)
    finally:
        spark.sql("DROP NAMESPACE np_test CASCADE")
    want = run(SourceCatalog.from_paths(spark, paths), NA_PBC, LOAD_TS)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_command_line_takes_a_profile(spark, paths, tmp_path):
    from salesfacts.__main__ import main

    file = tmp_path / "p.json"
    file.write_text(json.dumps(_spec(paths)))
    main(["--preset", "na_pbc", "--profile", str(file), "--out", str(tmp_path / "out"), "--load-ts", "2026-01-01T00:00:00"])
    assert len(spark.read.parquet(str(tmp_path / "out")).columns) == 73
    with pytest.raises(SystemExit):
        main(["--preset", "na_pbc", "--profile", str(file), "--table", "order_lines=x", "--out", "y"])
