"""Any number of labels gives the same model."""

from ledgerloom.operators import classifier


def test_weights_by_join_and_by_constant(spark, monkeypatch):
    rows = [(f"{w} shop {i % 3}", l) for i in range(30) for w, l in (("coffee", "A"), ("fuel", "B"), ("rent", "C"))] + [("coffee", None)]
    train = spark.createDataFrame(rows + [("fuel", "B")] * 20, "description string, label string")

    def fitted():
        out = classifier.predict(classifier.fit(train, 64, 5), train.select("description").distinct())
        return {r.description: (r.model_code, round(r.model_confidence, 6)) for r in out.collect()}

    few = fitted()
    monkeypatch.setattr(classifier, "MAX_LABELS", 2)
    assert fitted() == few and few["coffee shop 0"][0] == "A" and few["fuel"][0] == "B"
