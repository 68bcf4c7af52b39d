"""Plug-in points (F1 tokenizer, F2 batch generation, F3 entity extractor).

The default for each is a native expression; a user function runs in Arrow
batches (iterator ``pandas_udf`` / ``mapInPandas``) and is built once per
task, never per row.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import TOKEN_PATTERN
from quarry.session import ship_package

_DEFAULT_RX = re.compile(TOKEN_PATTERN)


def default_tokenizer() -> Callable[[str], list[str]]:
    """The default token rule in Python (same as the native ``token_count``)."""
    return _DEFAULT_RX.findall


def token_count_udf(make_tokenizer: Callable[[], Callable[[str], list]] = default_tokenizer, spark=None):
    """token count with a plug-in tokenizer; ``make_tokenizer`` runs once per task."""
    from pyspark.sql import SparkSession
    ship_package(spark or SparkSession.getActiveSession())

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = make_tokenizer()
        for s in batches:
            yield s.map(lambda t: len(tok(t)) if isinstance(t, str) else 0).astype("int64")

    return count


def extractor_udf(make_extractor: Callable[[], Callable[[str], list[str]]], spark=None):
    """custom entity extractor returning ``array<string>`` (sorted, distinct)."""
    from pyspark.sql import SparkSession
    ship_package(spark or SparkSession.getActiveSession())

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = make_extractor()
        for s in batches:
            yield s.map(lambda t: sorted(set(fn(t))) if isinstance(t, str) else [])

    return extract


GENERATION_SCHEMA = ("prompt_id long, output string, tokens_generated long, latency_ms double, "
                     "error string")


def batch_generate(prompts: DataFrame, make_fn: Callable[[], Callable[[str], str]], id_col: str = "item_id",
                   prompt_col: str = "prompt", count_tokens: Callable[[str], int] | None = None) -> DataFrame:
    """run a text function over a prompt table; per row the output, token count,
    latency and the error text (a failing row does not fail the task)."""
    ship_package(prompts.sparkSession)
    counter = count_tokens or (lambda s: len(_DEFAULT_RX.findall(s)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make_fn()
        for pdf in batches:
            out, toks, lat, err = [], [], [], []
            for p in pdf[prompt_col]:
                t0 = time.perf_counter()
                try:
                    o = fn(p)
                    out.append(o)
                    toks.append(counter(o))
                    err.append(None)
                except Exception as ex:  # noqa: BLE001 - captured per row
                    out.append(None)
                    toks.append(0)
                    err.append(f"{type(ex).__name__}: {ex}")
                lat.append((time.perf_counter() - t0) * 1000.0)
            yield pd.DataFrame({"prompt_id": pdf[id_col].astype("int64"), "output": out,
                                "tokens_generated": pd.Series(toks, dtype="int64"), "latency_ms": lat,
                                "error": err})

    return prompts.select(F.col(id_col), F.col(prompt_col)).mapInPandas(run, GENERATION_SCHEMA)


def half_echo() -> Callable[[str], str]:
    """Deterministic stand-in model for tests: the first half of the prompt's tokens;
    raises on prompts whose length is a multiple of 7 (to exercise error capture)."""

    def fn(p: str) -> str:
        if len(p) % 7 == 0:
            raise ValueError("stub refuses this prompt")
        toks = _DEFAULT_RX.findall(p)
        return " ".join(toks[: len(toks) // 2])

    return fn
