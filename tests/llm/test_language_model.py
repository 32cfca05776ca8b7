"""Scores and steps of the language model against plain sums."""

import numpy as np
import pytest

from pampero.llm.language_model import BATCH, CLASSES, CONTEXT, WIDTH, Bilinear, contexts_of, rows_added


def drawn(scale):
    rng = np.random.default_rng(3)
    model = Bilinear.start(np.full(CLASSES, 1 / CLASSES))
    model.outputs *= scale
    model.inputs *= scale
    classes = rng.integers(0, CLASSES, 3 * BATCH + 7)
    return model, classes, contexts_of(classes, np.array([0, 5, 300, len(classes)]))


def plain(model, classes, contexts):
    told = sum(model.inputs[contexts[:, i]] * model.distance[i] for i in range(CONTEXT)).astype(np.float64)
    scores = told @ model.outputs.T.astype(np.float64) + model.bias
    scores -= scores.max(axis=1, keepdims=True)
    own = scores[np.arange(len(classes)), classes]
    return (own - np.log(np.exp(scores).sum(axis=1))) / np.log(10)


@pytest.mark.parametrize("scale", [1, 60])
def test_scores_are_normalised_however_large_they_get(scale):
    model, classes, contexts = drawn(scale)
    own = model.log10(contexts, classes)
    assert np.isfinite(own).all()
    assert np.allclose(own, plain(model, classes, contexts), rtol=1e-4, atol=1e-4)


def test_near_certain_tokens_keep_their_digits():
    model, classes, contexts = drawn(1)
    model.bias[:] = -9
    model.bias[7] = 9
    classes[:] = 7
    own, plainly = model.log10(contexts, classes), plain(model, classes, contexts)
    assert np.allclose(own, plainly, rtol=1e-5, atol=0)


def test_vectors_are_weighed_once_for_all_batches(monkeypatch):
    model, classes, contexts = drawn(1)
    made, weighed = [], Bilinear.weighed
    monkeypatch.setattr(Bilinear, "weighed", lambda self: made.append(1) or weighed(self))
    model.log10(contexts, classes)
    assert len(made) == 1


def test_rows_are_added_by_class():
    rng = np.random.default_rng(4)
    index, rows = rng.integers(0, CLASSES, 500), rng.normal(size=(500, WIDTH)).astype(np.float32)
    total = np.zeros((CLASSES, WIDTH))
    for i, row in zip(index, rows):
        total[i] += row
    assert (rows_added(index, rows, CLASSES) == total.astype(np.float32)).all()
