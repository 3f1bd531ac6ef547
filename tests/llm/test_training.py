"""Where the classifier learns."""

import os

from tests.llm import models
from tiffin.llm import classifier


def test_classifier_learns_in_a_task(spark, tmp_path, monkeypatch):
    place, learn, driver = str(tmp_path / "pid"), classifier.train, os.getpid()

    def noted(features, labels):
        with open(place, "w") as file:
            file.write(str(os.getpid()))
        return learn(features, labels)

    monkeypatch.setattr(classifier, "train", noted)
    docs = models.table(spark, [(k, "good words here" if k % 2 else "bad $$$ junk") for k in range(40)])
    marks = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, quality int")
    model = classifier.fit(docs, marks, ~classifier.held_out())
    assert int(open(place).read()) != driver
    assert model.vectors.shape == (2 << classifier.BITS, classifier.SIZE) and model.weights.shape == (classifier.SIZE, 2)
