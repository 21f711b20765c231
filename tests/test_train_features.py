"""Training writes its features once, whatever the number of fits."""

from glossa.operators import model as MD


def test_features_are_written_once_for_all_fits(spark, monkeypatch):
    rows = [(str(i), ["good" if i % 2 else "bad", f"w{i % 7}"], float(i % 2), 1.0) for i in range(200)]
    d = spark.createDataFrame(rows, "id string, toks array<string>, label double, w double")
    seen, write = [], MD.materialize
    monkeypatch.setattr(MD, "materialize", lambda x: (seen.append("_features" in x.columns), write(x))[1])
    model, auc = MD.train_classifier(d, "toks", "label", "w", reg_params=(0.01, 0.1, 1.0))
    assert sum(seen) == 2 and auc == 1.0
    assert {r.id: r.toxic > 0.5 for r in MD.predict(model, d).collect()} == {r[0]: r[2] == 1 for r in rows}
