"""Terms of any length found in token streams by one automaton.

The terms form a trie over tokens; a node's link names the longest shorter
suffix that is a node, too, so a text takes one step per token whatever the
lengths of the terms, and no token run is ever made a string. The trie is sent
to the executors, so its use is bound to a counted list of terms.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import TOKEN_PATTERN
from quarry.session import ship_package

BROADCAST_TERMS = 200_000           # a trie of more terms is not sent to the executors


class TermTrie:
    """Terms as sequences of tokens; ``matches`` gives the numbers of those that stand in a text's tokens."""

    def __init__(self, terms: Iterable[list[str]]):
        self.steps: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        for number, words in enumerate(terms):
            at = 0
            for word in words:
                if word not in self.steps[at]:
                    self.steps[at][word] = len(self.steps)
                    self.steps.append({})
                    self.ends.append(-1)
                at = self.steps[at][word]
            self.ends[at] = number
        self.link = [0] * len(self.steps)            # longest proper suffix that is a node
        self.hit = [0] * len(self.steps)             # nearest suffix that is a whole term
        todo = deque(self.steps[0].values())
        while todo:
            node = todo.popleft()
            for word, child in self.steps[node].items():
                self.link[child] = self._next(self.link[node], word)
                todo.append(child)
            up = self.link[node]
            self.hit[node] = up if self.ends[up] >= 0 else self.hit[up]

    def _next(self, at: int, word: str) -> int:
        while word not in self.steps[at]:
            if at == 0:
                return 0
            at = self.link[at]
        return self.steps[at][word]

    def matches(self, tokens: Iterable[str]) -> set[int]:
        found, at = set(), 0
        for word in tokens:
            at = node = self._next(at, word)
            while node:
                if self.ends[node] >= 0:
                    found.add(self.ends[node])
                node = self.hit[node]
        return found


def rows_with_terms(corpus: DataFrame, terms: list[str], id_col: str, text_col: str = "text", term_col: str = "term") -> DataFrame:
    """``(term_col, id_col)``, once per row of ``corpus`` and term whose words are consecutive lower-cased tokens of it.

    ``terms`` are distinct and lower-cased, words joined by one space, at most
    ``BROADCAST_TERMS``. Null and empty texts hold none.
    """
    spark = corpus.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast((terms, TermTrie(t.split(" ") for t in terms)))
    token = re.compile(TOKEN_PATTERN)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, trie = sent.value
        for batch in batches:
            ids, hits = [], []
            for key, text in zip(batch["id"], batch["text"]):
                here = trie.matches(m.group() for m in token.finditer(text))
                ids += [key] * len(here)
                hits += [names[i] for i in here]
            if hits:
                yield pd.DataFrame({"term": hits, "id": pd.Series(ids, dtype=batch["id"].dtype)})

    rows = corpus.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("text"))
    out = rows.mapInPandas(find, f"term string, id {corpus.schema[id_col].dataType.simpleString()}")
    return out.select(F.col("term").alias(term_col), F.col("id").alias(id_col))
