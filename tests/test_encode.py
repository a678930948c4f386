import math
import random

from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import functions as F

from citylake.operators.encode import category_maps, class_report, confusion, evaluation, label_index
from citylake.plans import forest, ml


def test_labels_as_the_fitted_stage_orders_them(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.choice("aabbccdée"),) for _ in range(200)] + [(None,)], "label string").repartition(3)
    fitted = StringIndexer(inputCol="label", outputCol="i").fit(df.dropna()).labels
    got = {r.label: (r["index"], r.n) for r in label_index(df, "label").collect()}
    assert [k for k, v in sorted(got.items(), key=lambda x: x[1][0])] == fitted
    assert sum(n for _, n in got.values()) == 200 and label_index(df.limit(0), "label").count() == 0


def test_category_maps_as_the_fitted_stage_has_them(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0.0, 2.0, -1.0]), float(i), rng.choice([3.0, 1.0]), rng.choice([0.0, 1.0, 2.0, 3.0]), 7.0) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    model = VectorIndexer(inputCol="v", outputCol="o", maxCategories=3).fit(VectorAssembler(inputCols=df.columns, outputCol="v").transform(df))
    want = {(df.columns[f], v): i for f, m in dict(model.categoryMaps).items() for v, i in dict(m).items()}
    assert {(r.column, r.value): r["index"] for r in category_maps(df, df.columns, 3).collect()} == want
    odd = spark.createDataFrame([(None, 1.0), (math.nan, 2.0), (5.0, None)], "a double, b double")
    assert sorted(map(tuple, category_maps(odd, ["a", "b"], 2).collect())) == [("a", 5.0, 0), ("b", 1.0, 0), ("b", 2.0, 1)]


def test_evaluation(spark):
    df = spark.createDataFrame([("a", "a")] * 3 + [("a", "b"), ("b", None), ("b", "b"), (None, "a")], "l string, p string")
    c = confusion(df, "l", "p")
    assert {(r.label, r.prediction): r.n for r in c.collect()} == {("a", "a"): 3, ("a", "b"): 1, ("b", None): 1, ("b", "b"): 1}
    r = evaluation(c).collect()[0]
    assert abs(r.accuracy - 4 / 6) < 1e-12 and abs(r.test_error - 2 / 6) < 1e-12 and r.n_test == 6
    got = {x["class"]: (x.n, x.n_predicted, x.n_hit, x.precision, x.recall) for x in class_report(c).collect()}
    assert got == {"a": (4, 3, 3, 1.0, 0.75), "b": (2, 2, 1, 0.5, 0.5)}
    none = evaluation(confusion(df.limit(0), "l", "p")).collect()[0]
    assert none.accuracy is None and none.n_test == 0


def test_the_forest_as_a_table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x, k = rng.random(), rng.choice([0.0, 1.0, 2.0])
        rows.append((str(i), x, k, rng.random(), "Low" if x + k / 3 < 0.5 else "High" if k == 2 else "Medium"))
    df = spark.createDataFrame(rows, "neighborhood_id string, x double, k double, z double, index_rfd string")
    model, train_df, test_df = ml.train(df, seed=5)
    table = forest.forest_table(spark, model).cache()
    assert table.where("categories IS NOT NULL").count() > 0 and table.where("node = 0").count() == ml.NUM_TREES
    weights = ml.forest(model).featureImportances
    got = {r.feature: r.importance for r in forest.importances(table).collect()}
    assert all(abs(got.get(f, 0.0) - weights[f]) < 1e-9 for f in range(3))
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(df).select("neighborhood_id", vector_to_array("indexedFeatures").alias("indexedFeatures"), "prediction",
                                        vector_to_array("rawPrediction").alias("raw"))
    rows = forest.score(table, scored).collect()
    assert len(rows) == 400
    for r in rows:
        assert max(abs(a - b) for a, b in zip(r.votes, r.raw)) < 1e-9 and r.forest_prediction == r.prediction
