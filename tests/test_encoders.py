"""Encoders as plug-ins, and the mask in their pooling."""

import sys

import numpy as np
from pyspark import cloudpickle

from lakemill.operators import encoders

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests


class Table:
    """Token states from a table, mixed with the mean of the row, so that a wrong mask shows."""

    def __init__(self):
        self.table = np.random.default_rng(5).normal(size=(97, 6))

    def tokenize(self, texts):
        return encoders.padded([[sum(map(ord, w)) % 97 for w in t.split()] for t in texts], 12)

    def states(self, ids, mask):
        own = self.table[ids]
        return own + 0.5 * encoders.mean_pooled(own, mask)[:, None] + 9.0 * (mask == 0)[..., None]


def test_equal_to_one_text_at_a_time(spark):
    texts = [" ".join(f"w{i * j % 31}" for j in range(i % 20)) for i in range(150)] + [None, "", "é ü"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)
    for size in (7, 64):
        got = {r["i"]: r["embedding"] for r in encoders.encode(df, Table, batch_size=size).collect()}
        table = Table().table
        for i, t in enumerate(texts):
            ids = [sum(map(ord, w)) % 97 for w in (t or "").split()][:12]
            want = 1.5 * table[ids].mean(0) if ids else np.zeros(6)
            assert np.allclose(got[i], want), (i, t)


def test_skipped_fine_tuning():
    class Trainer:
        def run(self):
            return {"metrics": {"f1": 1.0}}

    assert encoders.fine_tuned()["metrics"] == {"skipped": True}
    assert encoders.fine_tuned(Trainer, force_gpu=True)["status"] == "skipped"
    assert encoders.fine_tuned(Trainer)["metrics"] == {"f1": 1.0}
