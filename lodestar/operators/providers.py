"""Calls of models, fetchers and probes as plug-ins; the default ones are deterministic and need no network.

A provider works on one Arrow batch at a time and never fails the job: an error is a column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_vector(text: str | None, size: int = 64) -> list[float]:
    """A unit vector that depends on the text alone."""
    seed = int.from_bytes(hashlib.sha256((text or "").encode()).digest()[:8], "big")
    v = np.random.default_rng(seed).standard_normal(size)
    return (v / np.linalg.norm(v)).tolist()


def embed(rows: DataFrame, text: str, provider: Callable[[list[str]], list[list[float]]] | None = None, batch: int = 50) -> DataFrame:
    """Adds vector and error; requests hold at most ``batch`` texts and keep their order."""
    call = provider or (lambda texts: [hash_vector(t) for t in texts])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows_ in batches:
            vectors, errors = [], []
            for at in range(0, len(rows_), batch):
                texts = rows_[text].iloc[at : at + batch].fillna("").tolist()
                try:
                    vectors += call(texts)
                    errors += [None] * len(texts)
                except Exception as error:  # the rows of this request only
                    vectors += [None] * len(texts)
                    errors += [str(error)] * len(texts)
            yield rows_.assign(vector=vectors, error=errors)

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.mapInPandas(work, f"{kinds}, vector array<double>, error string")


def fetch(rows: DataFrame, url: str, provider: Callable[[str], tuple[int, str]] | None = None) -> DataFrame:
    """Adds status, body and error of the page at each address, from a provider that turns an address into status and text.

    Statuses of 400 and more are errors without a body; null and blank addresses are not asked for. Without a provider the
    page is a short one that depends on the address alone.
    """
    call = provider or (lambda address: (200, f"<html><title>{address}</title><body>{hashlib.sha256(address.encode()).hexdigest()}</body></html>"))

    def one(address) -> tuple[int | None, str | None, str | None]:
        if not isinstance(address, str) or not address.strip():
            return None, None, "no address"
        try:
            status, body = call(address)
        except Exception as error:  # this page only
            return None, None, str(error)
        return (status, None, f"status {status}") if status >= 400 else (status, body, None)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows_ in batches:
            pages = pd.DataFrame([one(a) for a in rows_[url]], columns=["status", "body", "error"], index=rows_.index)
            yield rows_.assign(status=pages["status"].astype("Int32"), body=pages["body"], error=pages["error"])

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.mapInPandas(work, f"{kinds}, status int, body string, error string")


def answer(rows: DataFrame, prompt: str, schema: str, provider: Callable[[str], str]) -> DataFrame:
    """Adds answer (parsed by ``schema``) and error for a provider that turns a prompt into JSON text."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows_ in batches:
            texts, errors = [], []
            for value in rows_[prompt]:
                try:
                    texts.append(provider(value))
                    errors.append(None)
                except Exception as error:
                    texts.append(None)
                    errors.append(str(error))
            yield rows_.assign(_answer=texts, error=errors)

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    told = rows.mapInPandas(work, f"{kinds}, _answer string, error string")
    parsed = F.from_json("_answer", schema)
    return told.withColumn("answer", parsed).withColumn("error", F.coalesce("error", F.when(F.col("answer").isNull(), "no readable answer"))).drop("_answer")


def first_probe(*probes: tuple[Column, Column, Column, int, Column]) -> Column:
    """The result of the first probe (status, content type, bytes, least bytes, result) that is an image and large enough."""
    return F.coalesce(*[F.when((status == 200) & kind.startswith("image/") & (size >= least), result) for status, kind, size, least, result in probes])
