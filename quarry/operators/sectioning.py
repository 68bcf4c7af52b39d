"""Sections under a token budget (P14): long texts cut into the fewest sections at the mildest places.

A text may be cut after the white space that follows any token. A cut costs
little at a blank line, more at a line break or the end of a sentence, most
inside one. Of all ways to stay within the budget, those with the fewest
sections count, of these the one with the least cost. With ``f(j)`` the best
(sections, cost) of the first ``j`` tokens, ``f(j)`` is the least ``f(i)`` of the
``budget`` places before plus one section and the cost of a cut at ``j``: a
sliding minimum, so a text takes time in proportion to its length. Only texts
over the budget go to Python.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import token_count
from quarry.session import ship_package

SECTION_TOKENS = 3500
CUT_COSTS = (0, 1, 2, 4)            # after a blank line, a line break, the end of a sentence, elsewhere
UNIT = re.compile(r"[^ \t\n\r\f]+[ \t\n\r\f]*")
BLANK_LINE = re.compile(r"\n[ \t\r\f]*\n")
SENTENCE_END = re.compile(r"[.!?][\"')\]]*[ \t\r\f]*\Z")


def cut_cost(unit: str, costs: Sequence[int] = CUT_COSTS) -> int:
    """Cost of a cut after ``unit``, a token with the white space behind it."""
    if "\n" in unit:
        return costs[0] if BLANK_LINE.search(unit) else costs[1]
    return costs[2] if SENTENCE_END.search(unit) else costs[3]


def best_cuts(cost: Sequence[int], budget: int) -> list[int]:
    """Ends (in tokens) of the sections of a text whose cut after token ``i`` costs ``cost[i]``; the text's end costs nothing."""
    n = len(cost)
    best, back = [(0, 0)] * (n + 1), [0] * (n + 1)
    window = deque([0])                                    # places within the budget, best first; of equal ones the latest
    for j in range(1, n + 1):
        while window[0] < j - budget:
            window.popleft()
        i = window[0]
        best[j], back[j] = (best[i][0] + 1, best[i][1] + (cost[j - 1] if j < n else 0)), i
        while window and best[window[-1]] >= best[j]:
            window.pop()
        window.append(j)
    ends, j = [], n
    while j > 0:
        ends.append(j)
        j = back[j]
    return ends[::-1]


def budget_sections(df: DataFrame, id_col: str, text_col: str = "text", budget: int = SECTION_TOKENS, costs: Sequence[int] = CUT_COSTS) -> DataFrame:
    """``(id_col, section_pos, section, n_tokens, text_sha256)`` for the texts over ``budget`` tokens.

    Sections of a text in order join to the text itself, whose hash every one
    carries, so that can be checked without the texts. White space before the
    first token belongs to the first section. Texts within the budget, null and
    empty ones have no rows; repeated rows have their sections each.
    """
    if budget < 1:
        raise ValueError("a section holds one token at least")
    ship_package(df.sparkSession)
    costs = tuple(costs)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text, whole in zip(batch["id"], batch["text"], batch["whole"]):     # one text's sections at a time
                starts = [m.start() for m in UNIT.finditer(text)]
                starts[0] = 0
                edges = [*starts, len(text)]
                ends = best_cuts([cut_cost(text[a:b], costs) for a, b in zip(edges, edges[1:])], budget)
                begins = [0, *ends[:-1]]
                yield pd.DataFrame({"id": [key] * len(ends), "section_pos": range(len(ends)),
                                    "section": [text[edges[a]:edges[b]] for a, b in zip(begins, ends)],
                                    "n_tokens": [b - a for a, b in zip(begins, ends)], "text_sha256": [whole] * len(ends)})

    rows = df.where(token_count(text_col) > budget).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                                           F.sha2(F.col(text_col), 256).alias("whole"))
    kind = df.schema[id_col].dataType.simpleString()
    out = rows.mapInPandas(cut, f"id {kind}, section_pos int, section string, n_tokens int, text_sha256 string")
    return out.withColumnRenamed("id", id_col)
