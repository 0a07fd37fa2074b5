from pyspark.sql import functions as F

from emergent.functions.items import (
    INF,
    bridge_symbols,
    display_item,
    feature_tokens,
    finite_growth,
    growth_text,
    mesh_id,
    strip_prefix_upper,
)


def test_mesh_id_and_strip(spark):
    df = spark.createDataFrame([("D001",), ("MESH:D002",)], "id string")
    out = [r[0] for r in df.select(mesh_id("id")).collect()]
    assert out == ["MESH:D001", "MESH:D002"]
    df2 = spark.createDataFrame([("GENE_abcGENE_",)], "g string")
    assert df2.select(strip_prefix_upper("g", "GENE_")).first()[0] == "ABC"


def test_feature_tokens_keep_first_occurrence(spark):
    df = spark.createDataFrame([(["beta one", "alpha", "beta one", "", None],)], "n array<string>")
    assert df.select(feature_tokens("n")).first()[0] == ["TARGET_beta_one", "TARGET_alpha"]
    g = spark.createDataFrame([(["abc", "ABC", "d", ""],)], "g array<string>")
    assert g.select(bridge_symbols("g")).first()[0] == ["ABC", "D"]


def test_growth_text_and_display(spark):
    df = spark.createDataFrame([(INF,), (52.9583,), (1.005,), (2.0,), (1.125,), (2.625,)], "g double")
    out = [r[0] for r in df.select(growth_text("g")).collect()]
    assert out[0] == "∞" and out[1] == "52.96" and out[3:] == ["2.00", "1.12", "2.62"]
    assert out[2] == "1.00"          # the binary value lies below the tie
    assert df.select(finite_growth("g")).first()[0] == 999999.0
    items = spark.createDataFrame([("LABEL_7", "Flu"), ("BRAND_x", None), ("other", None)], "i string, n string")
    got = [r[0] for r in items.select(display_item(F.col("i"), F.col("n"))).collect()]
    assert got == ["【Flu】", "[BRAND_x]", "other"]


def test_prefix_restriction_and_set_text(spark):
    from emergent.functions.items import items_text, restrict_prefix, sorted_text
    df = spark.createDataFrame([(["TARGET_b", "DISEASE_x", "TARGET_a"],)], "s array<string>")
    r = df.select(restrict_prefix("s", "TARGET_").alias("t"), sorted_text("s").alias("txt"),
                  items_text("s").alias("it")).first()
    assert r.t == ["TARGET_b", "TARGET_a"]
    assert r.txt == "DISEASE_x, TARGET_a, TARGET_b" and r.it == "DISEASE_x TARGET_a TARGET_b"
