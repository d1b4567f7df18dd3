import numpy as np
import pytest
from pyspark.ml import feature
from pyspark.ml.linalg import Vectors

from voxscope.operators import mining


@pytest.mark.parametrize("sparse", [True, False])
def test_points_are_projections_on_the_first_two_axes(spark, monkeypatch, sparse):
    rng = np.random.default_rng(3)
    found = rng.normal(size=(60, 6)) * [5, 3, 1, 0.5, 0, 0.1] + [0, 2, 0, 0, 4, 0]
    found[rng.random((60, 6)) < 0.3] = 0.0
    found[:, 4] = 4.0  # without spread
    vector = (lambda r: Vectors.sparse(6, {i: float(x) for i, x in enumerate(r) if x})) if sparse else Vectors.dense
    df = spark.createDataFrame([(i, vector(r)) for i, r in enumerate(found)], ["id", "features"])
    model = feature.PCA(k=2, inputCol="features", outputCol="p").fit(df)
    axes = model.pc.toArray() * [1 if c[abs(c).argmax()] >= 0 else -1 for c in model.pc.toArray().T]

    def slow(*_):
        raise AssertionError("decomposed without a native library")

    monkeypatch.setattr(feature.PCA, "fit", slow)
    got = mining.pca_points(df)
    assert got.columns == ["id", "features", "x", "y"]
    points = np.array([(r.x, r.y) for r in got.orderBy("id").collect()])
    assert np.allclose(points, found @ axes, atol=1e-9)
