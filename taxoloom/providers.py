"""Models behind interfaces. Offline, answers come from tables; a model is a function over batches of rows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Encoder(Protocol):
    """Texts to vectors."""

    def encode(self, df: DataFrame, text: str, into: str) -> DataFrame: ...


class TableEncoder:
    """Vectors looked up by text; a text without one gets null."""

    def __init__(self, table: DataFrame):
        self.table = table.groupBy("text").agg(F.first("vector").alias("vector"))

    def encode(self, df: DataFrame, text: str, into: str) -> DataFrame:
        return df.join(self.table.select(F.col("text").alias(text), F.col("vector").alias(into)), text, "left")


class ModelEncoder:
    """Vectors from a model. ``load`` makes the model once a worker; it maps a list of texts to a list of vectors."""

    def __init__(self, load: Callable[[], Callable[[list[str]], list[list[float]]]], batch: int = 256):
        self.load, self.batch = load, batch

    def encode(self, df: DataFrame, text: str, into: str) -> DataFrame:
        load, size = self.load, self.batch

        @F.pandas_udf("array<double>")
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for s in parts:
                out: list[list[float]] = []
                for lo in range(0, len(s), size):
                    out += model([x or "" for x in s.iloc[lo : lo + size]])
                yield pd.Series([list(map(float, v)) for v in out])

        return df.withColumn(into, run(F.col(text)))


class TableScorer:
    """Cross scores looked up by (query, item)."""

    def __init__(self, table: DataFrame):
        self.table = table.select("query", "item", "cross")

    def score(self, df: DataFrame) -> DataFrame:
        return df.join(self.table, ["query", "item"], "left")


class TableAnswers:
    """Language-model answers looked up by ``cache_key``; rows without one get null."""

    def __init__(self, table: DataFrame):
        self.table = table.select("cache_key", "answer")

    def ask(self, df: DataFrame) -> DataFrame:
        return df.join(self.table, "cache_key", "left")


class ModelAnswers:
    """Answers of a model that maps prompts to texts. ``load`` makes as many clients as it has keys; they take turns,
    and a prompt that fails with one is tried with the next. A prompt that fails with all gets null."""

    def __init__(self, load: Callable[[], list[Callable[[str], str]]]):
        self.load = load

    def ask(self, df: DataFrame, prompt: str = "prompt") -> DataFrame:
        load = self.load

        @F.pandas_udf("string")
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            clients, turn = load(), 0
            for s in parts:
                out = []
                for x in s:
                    answer = None
                    for _ in clients:
                        client, turn = clients[turn % len(clients)], turn + 1
                        try:
                            answer = client(x)
                            break
                        except Exception:  # a client's failure is the next one's turn
                            continue
                    out.append(answer if answer is None or isinstance(answer, str) else json.dumps(answer))
                yield pd.Series(out, dtype=object)

        return df.withColumn("answer", run(F.col(prompt)))


def prompt_batches(df: DataFrame, by: str, order: str, payload: str, size: int) -> DataFrame:
    """One prompt for each ``size`` rows of a group: ``(by, batch, items)`` with JSON of the payloads in order."""
    from taxoloom.operators.ranking import batches

    return batches(df, [by], [order], size).groupBy(by, "batch").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(order, payload))), lambda x: x[payload])).alias("items"))


def grounded(extractions: DataFrame, source_code: str = "source_code") -> DataFrame:
    """Extractions that have a place in the source; the source's own code wins over the model's."""
    return extractions.where(F.col("char_start").isNotNull() & F.col("char_end").isNotNull()).withColumn("code", F.coalesce(source_code, "code"))
