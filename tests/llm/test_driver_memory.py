"""What operators hold in the driver."""

import tracemalloc

import numpy as np

from pampero.llm import toxicity


def test_the_fit_holds_little_beside_the_machine(monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    rng, n = np.random.default_rng(1), 200_000
    rows = [np.unique(rng.integers(0, n, 20)).astype(np.int32) for _ in range(300)]
    labels = (np.arange(300) % 3 == 0).astype(float)
    tracemalloc.start()
    try:
        machine = toxicity.fit(np.zeros(1, np.int32), rows, labels, n)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Parameters and the squares of their gradients take 9 doubles a term each.
    assert machine.vectors.shape == (n, toxicity.FACTORS)
    assert most < 1.5 * 2 * 9 * 8 * n
