import numpy as np
from edge import clashing, documents, edge, labels, none
from pyspark.sql import functions as F

from stray.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, marks = documents(spark, SF), labels(spark, SF)
    held = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(4)) == 0
    model = T.train(docs, marks.where(~held))
    test = docs.join(marks.where(held), "doc_id").select("text", "toxic").collect()
    said = np.array([model.grade_probabilities(r.text)[0] >= 0.5 for r in test])
    true = np.array([r.toxic == 1 for r in test])
    assert (said == true).mean() > 0.97
    assert said[true].mean() > 0.85 and said[~true].mean() < 0.01


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    n, k = 40, 5
    rows, cols = np.nonzero(rng.random((n, k)) < 0.6)
    vals = rng.random(len(rows)) + 0.5
    grade = rng.integers(0, T.GRADES + 1, n)
    f = T.Fit(l2=0.0, steps=3000, rate=0.02)
    w, t = T.fit_cumulative_link(rows, cols, vals, grade, np.ones(n), k, f)

    def loss(w, t):
        x = np.bincount(rows, vals * w[cols], n)
        above = np.c_[np.ones(n), 1 / (1 + np.exp(-(x[:, None] - t))), np.zeros(n)]
        return -np.log(above[np.arange(n), grade] - above[np.arange(n), grade + 1]).mean()

    best = loss(w, t)
    assert (np.diff(t) > 0).all()
    for i in range(k):  # no step in any direction improves
        for d in (-0.05, 0.05):
            assert loss(w + d * np.eye(k)[i], t) > best - 1e-4
    for i in range(len(t)):
        for d in (-0.02, 0.02):
            assert loss(w, t + d * np.eye(len(t))[i]) > best - 1e-4


def test_severity_grows_with_insults(spark):
    model = T.train(documents(spark, SF), labels(spark, SF))
    p = [sum(model.grade_probabilities(f"the plain words {'idiot ' * k}")) for k in (0, 1, 4)]
    assert p[0] < p[1] < p[2] and p[0] < 0.5 < p[1]
    q = model.grade_probabilities("idiot moron")
    assert all(a >= b for a, b in zip(q, q[1:]))


def test_edges(spark):
    out = T.toxicity_query(edge(spark), labels(spark)).collect()
    assert len(out) == edge(spark).count()
    none_known = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {(r.expected_severity, r.toxic) for r in T.toxicity_query(edge(spark), none_known).collect()} == {(0.0, False)}
    assert T.toxicity_query(none(spark), labels(spark)).count() == 0
    docs = clashing(spark)
    assert T.toxicity_stage(docs, none_known).columns == docs.columns


def test_scores_of_a_table_by_brute_force(spark):
    """Every row of the query from the fitted weights, term by term; the fit itself is tested above."""
    import math
    import re
    docs, marks = documents(spark, SF).where("doc_id % 7 = 0 and n_chars < 20000"), labels(spark, SF)
    model = T.train(docs, marks)
    assert model.weights and len(model.thresholds) == T.GRADES
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = T.toxicity_query(docs, marks).collect()
    assert len(rows) == len(texts) and 0 < sum(r.toxic for r in rows) < len(rows) / 2
    for r in rows:
        words = [w for w in re.split(r"[\W_]+", (texts[r.doc_id] or "").lower()) if w]
        terms = words + [w[:4] + "-" for w in words if len(w) > 4] + [w[:5] + "-" for w in words if len(w) > 5]
        x = sum(w * math.log(1 + terms.count(t)) for t, w in model.weights.items() if t in terms)
        p = [1 / (1 + math.exp(-(x - t))) for t in model.thresholds]
        assert np.allclose([r.p_grade_1, r.p_grade_2, r.p_grade_3], p, atol=1e-9)
        each = -np.diff(np.r_[1.0, p, 0.0])
        assert abs(r.expected_severity - sum(k * each[k] for k in range(4))) < 1e-9
        assert each[r.grade] >= each.max() - 1e-9 and r.toxic == (p[0] >= 0.5)
