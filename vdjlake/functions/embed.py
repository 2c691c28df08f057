"""Sequences through a model that is loaded once a worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Model = Callable[[list[str]], list[list[float]]]


def embed(df: DataFrame, load: Callable[[], Model], value: str = "sequence_aa", output: str = "embedding", batch: int = 512) -> DataFrame:
    """``df`` with the model's vector for each value; null values have none. ``load`` is called once a task.

    Values go to the model in batches of ``batch``, ordered by length within each Arrow batch so that padding is small.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for b in batches:
            there = b[value].notna().to_numpy().nonzero()[0]
            order = sorted(there, key=lambda i: len(b[value].iat[i]))
            out: list[list[float] | None] = [None] * len(b)
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                for i, v in zip(part, model([b[value].iat[i] for i in part])):
                    out[i] = [float(x) for x in v]
            yield b.assign(**{output: pd.Series(out, index=b.index, dtype="object")})

    return df.mapInPandas(run, schema)


def composition_model() -> Model:
    """A stand-in that needs no weights: shares of the 20 residues, in alphabetical order."""
    letters = "ACDEFGHIKLMNPQRSTVWY"
    return lambda seqs: [[s.count(c) / max(1, len(s)) for c in letters] for s in seqs]
