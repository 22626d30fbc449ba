import numpy as np
from pyspark.sql import functions as F


def vec_frame(spark, rows, ids=None):
    """(user_id, z array<double>) from a list of vectors."""
    ids = ids if ids is not None else list(range(len(rows)))
    data = [(int(i), [float(x) for x in r]) for i, r in zip(ids, rows)]
    return spark.createDataFrame(data, "user_id long, z array<double>")


def cosine_matrix(x):
    x = np.asarray(x, dtype=float)
    n = np.linalg.norm(x, axis=1)
    u = np.divide(x, n[:, None], out=np.zeros_like(x), where=n[:, None] > 0)
    return u @ u.T


def collect_map(df, key, val):
    return {r[key]: r[val] for r in df.select(key, val).collect()}


def rand_vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, d))


__all__ = ["vec_frame", "cosine_matrix", "collect_map", "rand_vectors", "F"]
