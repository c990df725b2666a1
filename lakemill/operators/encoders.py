"""Frozen encoders as plug-ins: batches of texts to token states, pooled under the attention mask.

An encoder is an object with ``tokenize(texts) -> (ids, mask)``, arrays of (texts, tokens), and ``states(ids, mask)``, an array of
(texts, tokens, dimension). Spark gives it Arrow batches, and each Python worker makes it once. Any library fits, as long as
its files are where the workers are.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Encoder(Protocol):
    def tokenize(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]: ...

    def states(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray: ...


def mean_pooled(states: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The mean of the states of tokens that the mask shows; zeros where it shows none."""
    shown = mask[..., None].astype(states.dtype)
    return (states * shown).sum(1) / np.maximum(shown.sum(1), 1e-9)


def encode(df: DataFrame, make_encoder: Callable[[], Encoder], text: str = "text", out: str = "embedding", batch_size: int = 64) -> DataFrame:
    """``df`` with the mean-pooled embedding of each text; null counts as empty. ``batch_size`` texts are encoded at once."""

    def make():
        encoder = make_encoder()

        def predict(texts: np.ndarray) -> np.ndarray:
            ids, mask = encoder.tokenize([str(t) for t in texts.ravel()])
            return mean_pooled(encoder.states(ids, mask), mask).astype(np.float64)

        return predict

    return df.withColumn(out, predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)(F.coalesce(text, F.lit(""))))


def padded(rows: list[list[int]], max_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids cut to ``max_length`` and filled up with zeros, and their mask."""
    rows = [r[:max_length] for r in rows]
    width = max(1, max(map(len, rows), default=1))
    ids, mask = np.zeros((len(rows), width), np.int64), np.zeros((len(rows), width), np.int8)
    for k, r in enumerate(rows):
        ids[k, : len(r)], mask[k, : len(r)] = r, 1
    return ids, mask


class WordShapes:
    """A small encoder without weights: a word's id is its length, its state its length, its place, and the next shown word's length."""

    def __init__(self, max_length: int = 256):
        self.max_length = max_length

    def tokenize(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return padded([[len(w) for w in t.split(" ") if w] for t in texts], self.max_length)

    def states(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        places = np.broadcast_to(np.arange(ids.shape[1]), ids.shape)
        after = np.concatenate([ids[:, 1:], np.zeros((len(ids), 1), ids.dtype)], 1)
        return np.stack([ids, places, after], -1).astype(np.float64)


def fine_tuned(make_trainer: Callable[[], object] | None = None, force_gpu: bool = False, gpu: bool = False) -> dict:
    """Fine-tuning is a trainer's business; without one, or with a GPU asked for that is not there, the run is marked as skipped."""
    if make_trainer is None or (force_gpu and not gpu):
        return {"metrics": {"skipped": True}, "gpu_unavailable": not gpu, "artifact_paths": {}, "status": "skipped"}
    return make_trainer().run()
