"""Text to vector: a deterministic hashing vectoriser, or a caller's model by Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import EMBEDDING_DIM, MAX_CHARS

HANDED_ON = 512  # vectors a model's task holds before it hands them on
DOCUMENT, QUERY = "search_document", "search_query"


def model_input(col: Column, mode: str) -> Column:
    """The whole text, of a document as of a question; null is empty."""
    if mode not in (DOCUMENT, QUERY):
        raise ValueError(f"unknown mode {mode!r}")
    return F.coalesce(col, F.lit(""))


def hashing_vectors(df: DataFrame, text: str, mode: str = DOCUMENT, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Add ``embedding array<float>``: hashed word counts at unit length."""
    stages = Pipeline(stages=[
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[\p{L}\p{N}]+", gaps=False, toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim),
        Normalizer(inputCol="_counts", outputCol="_unit", p=2.0),
    ])
    staged = df.withColumn("_text", model_input(F.col(text), mode))
    vectors = stages.fit(staged.limit(0)).transform(staged)
    return vectors.withColumn("embedding", vector_to_array("_unit", "float32")).drop("_text", "_words", "_counts", "_unit")


def _pieces(text: str, width: int | None) -> list[str]:
    return [text[i:i + width] for i in range(0, len(text), width)] or [""] if width else [text]


def _mean(vectors: list, pieces: list[str]) -> np.ndarray:
    """Mean of the pieces' vectors by length."""
    if len(pieces) == 1:
        return np.asarray(vectors[0], dtype=np.float32)
    return np.average(np.asarray(vectors, dtype=np.float64), axis=0, weights=[len(p) for p in pieces]).astype(np.float32)


def _embedded(batches: Iterator[pa.Array], model: Callable, mode: str, cut: int | None, at_once: int) -> Iterator[pa.Array]:
    """Vectors of texts. A text becomes a string when its turn comes, and vectors are handed on in small batches."""
    def embedded(texts: list[list[str]]) -> list[np.ndarray]:
        found = list(model([piece for pieces in texts for piece in pieces], mode))
        ends = np.cumsum([len(pieces) for pieces in texts])
        return [_mean(found[end - len(pieces):end], pieces) for end, pieces in zip(ends.tolist(), texts, strict=True)]

    def safely(texts: list[list[str]]) -> list[np.ndarray | None]:
        try:
            return embedded(texts)
        except Exception:
            return [None] if len(texts) == 1 else [vector for one in texts for vector in safely([one])]

    for batch in batches:
        out, waiting, n = [], [], 0
        for text in batch:
            waiting.append(_pieces(text.as_py(), cut))
            n += len(waiting[-1])
            if n >= at_once:
                out += safely(waiting)
                waiting, n = [], 0
            if len(out) >= HANDED_ON:
                yield pa.array(out, pa.list_(pa.float32()))
                out = []
        out += safely(waiting) if waiting else []
        if out:
            yield pa.array(out, pa.list_(pa.float32()))


def model_vectors(
    df: DataFrame, text: str, load: Callable[[], Callable[[list[str], str], np.ndarray]], mode: str = DOCUMENT,
    width: int | None = MAX_CHARS, at_once: int = 64,
) -> DataFrame:
    """Add ``embedding`` from a model. ``load`` runs once per task and returns a batch function.

    A document goes to the model in pieces of ``width`` characters, and its vector is their mean by length; a question
    goes whole. The model gets some ``at_once`` pieces at a time. Texts of a call that fails are retried one by one; a text
    it still fails on gets a null vector, so one bad row never stops the rest.
    """
    cut = width if mode == DOCUMENT else None

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _embedded(batches, load(), mode, cut, at_once)

    return df.withColumn("embedding", vectors(model_input(F.col(text), mode)))


def embed(df: DataFrame, text: str, mode: str = DOCUMENT, load=None, dim: int = EMBEDDING_DIM) -> DataFrame:
    return hashing_vectors(df, text, mode, dim) if load is None else model_vectors(df, text, load, mode)
