"""Model reports are scored on rows the models have not seen."""

from kestrel.ml import jobs as ML
from kestrel.sources.tables import Tables

SF = "/root/testdata/sf0.001"
KEYS = ["l_orderkey", "l_linenumber"]


def test_hashed_split_is_a_partition(spark):
    li = Tables(spark, SF).lineitem.select(*KEYS)
    train, test = ML.hashed_split(li, KEYS)
    assert train.count() + test.count() == li.count()
    assert train.join(test, KEYS).count() == 0
    assert 0.1 < test.count() / li.count() < 0.3


def test_forest_report(spark):
    li = Tables(spark, SF).lineitem
    rows = ML.forest_report(li, ["l_quantity", "l_linenumber"], "l_returnflag", KEYS).collect()
    part = lambda p: {r["name"]: r["value"] for r in rows if r["part"] == p}
    _, test = ML.hashed_split(li, KEYS)
    cells = part("confusion")
    assert sum(cells.values()) == test.count()
    right = sum(v for k, v in cells.items() if len(set(k.split(" as "))) == 1)
    assert abs(right / test.count() - part("accuracy")["forest"]) < 1e-9
    best = part("parameter")
    chosen = f"maxDepth={best['maxDepth']:.0f}, numTrees={best['numTrees']:.0f}"
    assert part("validation")[chosen] == max(part("validation").values())


def test_cross_validated_regression_finds_the_line(spark):
    li = Tables(spark, SF).lineitem.selectExpr(*KEYS, "l_quantity", "l_tax", "3.0 * l_quantity - 50 * l_tax + 7 AS y")
    rows = ML.cross_validated_regression(li, ["l_quantity", "l_tax"], "y", KEYS).collect()
    value = {(r["part"], r["name"]): r["value"] for r in rows}
    assert value["held out", "r2"] > 0.999
    assert abs(value["coefficient", "l_quantity"] - 3) < 0.05
    assert len([k for k in value if k[0] == "fold mean rmse"]) == 4


def test_reports_read_prepared_rows(spark, monkeypatch):
    """The fits read rows that were prepared and pruned once; slots stay categorical."""
    kept = {}
    monkeypatch.setattr(ML, "written", lambda df, name, w=ML.written: kept.setdefault(name, w(df, name)))
    df = spark.range(400).selectExpr("id", "CAST(id % 3 AS INT) AS slot", "id * 1.0D AS size", "CAST(id % 2 AS STRING) AS label",
                                     "id * 2.0D AS y", "'unused' AS other")
    ML.forest_report(df, ["slot", "size"], "label", ["id"])
    assert {"forest-train", "forest-test"} <= set(kept) and kept["forest-train"].columns == ["__label", "__features"]
    assert "nominal" in str(kept["forest-train"].schema["__features"].metadata)
    ML.cross_validated_regression(df, ["size"], "y", ["id"])
    assert kept["regression-train"].columns == ["size", "y", "__fold"]
