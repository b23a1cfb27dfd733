"""B*/C* column functions on hand-made rows (null, boundary and blank cases)."""

from pyspark.sql import functions as F

from lathe.functions import columns as col


def test_split_cabin_null_and_parts(spark):
    df = spark.createDataFrame([("a", "B/12/P"), ("b", None), ("c", "T/0/S")], "id string, Cabin string")
    out = {r.id: (r.Deck, r.CabinNumber, r.Side) for r in col.split_cabin(df).collect()}
    assert out == {"a": ("B", 12, "P"), "b": ("Unknown", 0, "Unknown"), "c": ("T", 0, "S")}
    eda = {r.id: r.CabinNumber for r in col.split_cabin(df, number_default=None).collect()}
    assert eda["b"] is None


def test_age_category_boundaries_left_closed(spark):
    ages = [None, 0.0, 12.0, 12.9, 13.0, 17.9, 18.0, 29.9, 30.0, 59.9, 60.0, 99.0]
    df = spark.createDataFrame([(a,) for a in ages], "Age double")
    got = [r[0] for r in df.select(col.age_category("Age")).collect()]
    assert got == ["Unknown", "Child", "Child", "Child", "Teen", "Teen", "YoungAdult", "YoungAdult",
                   "Adult", "Adult", "Senior", "Senior"]


def test_last_token_blank_and_whitespace(spark):
    df = spark.createDataFrame([("Ann Lee",), ("  ",), ("",), (None,), ("Solo",), ("Bo  Ray  ",)], "Name string")
    got = [r[0] for r in df.select(col.last_token("Name")).collect()]
    assert got == ["Lee", None, None, None, "Solo", "Ray"]


def test_tri_state_and_side_codes(spark):
    df = spark.createDataFrame([(True, "P"), (False, "S"), (None, "Unknown")], "c boolean, s string")
    rows = df.select(col.tri_state("c", -1).alias("a"), col.tri_state("c", 0).alias("b"),
                     col.side_code("s").alias("d")).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 0), (0, 0, 1), (-1, 0, -1)]


def test_spend_totals_and_entropy(spark):
    cols = ["a", "b", "c"]
    df = spark.createDataFrame([(None, 0.0, 0.0), (10.0, None, 10.0), (1.0, 2.0, 3.0)], "a double, b double, c double")
    out = col.spend_totals(df, cols).withColumn("H", col.spend_entropy(cols)).collect()
    assert [r.TotalSpending for r in out] == [0.0, 20.0, 6.0]
    assert [r.HasSpending for r in out] == [0, 1, 1]
    assert [r.SpendingCategories for r in out] == [0, 2, 3]
    assert out[0].H == 0.0
    assert abs(out[1].H - 0.6931471805) < 1e-6


def test_route_keeps_unknown_and_isin_null_safe(spark):
    df = spark.createDataFrame([(None, "X"), ("P", None)], "HomePlanet string, Destination string")
    assert [r[0] for r in df.select(col.route(sep="_to_")).collect()] == ["Unknown_to_X", "P_to_Unknown"]
    assert [r[0] for r in df.select(~col.isin_safe("HomePlanet", ["P"])).collect()] == [True, False]


def test_align_schema_fills_missing_and_normalises(spark):
    df = spark.createDataFrame([(1, 2.0, 3)], "id int, `Room_Service` double, extra int")
    out = col.align_schema(df, ["Room Service", "Missing"], keep=["id"])
    assert out.columns == ["id", "Room Service", "Missing"]
    assert tuple(out.first()) == (1, 2.0, 0)
