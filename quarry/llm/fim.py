"""Fill-in-middle transformation with counted-quantifier regular expressions, all in SQL functions.

A text is a sequence of units: a run of white space with the word after it, or
white space at the end. ``regexp_count`` gives their number n, a hash of the id
two places a <= b in 0..n, and the row's own pattern

    \\A((?:unit){a}+)((?:unit){b-a}+)(.*)\\z

captures prefix, middle and suffix in one match, whose groups ``regexp_replace``
puts into the order of the form. The quantifiers are possessive, so the match
runs in a loop that neither backtracks nor recurses, whatever the length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Order of the captured groups (1 prefix, 2 middle, 3 suffix) and markers by form.
ORDER = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
BACK = {"psm": (rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\z", "$1$3$2"),
        "spm": (rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\z", "$2$3$1")}


def _draw(name: str, i: int) -> Column:
    """The i-th 8-digit group of a hexadecimal hash as an unsigned integer."""
    return F.conv(F.substring(name, 8 * i + 1, 8), 16, 10).cast("long")


def pattern(first: str, second: str) -> Column:
    """The row's pattern: ``first`` units, then the units up to ``second``, then the rest."""
    return F.concat(F.lit(rf"(?s)\A((?:{UNIT}){{"), F.col(first).cast("string"), F.lit(rf"}}+)((?:{UNIT}){{"),
                    (F.col(second) - F.col(first)).cast("string"), F.lit(r"}+)(.*)\z"))


def restored(output: str, form: str) -> Column:
    """The original text, from the output and its form alone."""
    col = F.col(output)
    return (F.when(F.col(form) == "psm", F.regexp_replace(col, *BACK["psm"]))
            .when(F.col(form) == "spm", F.regexp_replace(col, *BACK["spm"])).otherwise(col))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                   percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``(<id_col>, n, form, prefix_chars, middle_chars, output)`` for every row of ``docs``.

    ``percent`` of the texts are transformed, ``spm_percent`` of those into the
    order suffix, prefix, middle, the others into prefix, suffix, middle; the
    rest stays plain. The draw depends on ``seed`` and the id only.

    Defined cases: a null or empty text and a text that holds a marker is plain;
    prefix, middle or suffix may be empty; a null id draws as an empty one;
    repeated rows get equal results; white space alone is one unit; other
    columns are never read; an empty table gives an empty result. A text of any
    length is matched whole.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                       F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256).alias("hash"))
    rows = rows.select("id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
                       *[_draw("hash", i).alias(f"h{i + 1}") for i in range(4)])
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = (F.when((F.col("n") == 0) | marked | (F.col("h3") % 100 >= percent), "plain")
            .when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm"))
    x, y = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    cut = rows.select("id", "text", "n", form.alias("form"), F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    order = F.when(F.col("form") == "spm", ORDER["spm"]).otherwise(ORDER["psm"])
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern("a", "b"), order))
    made = cut.select("id", "n", "form", output.alias("output"), F.length("text").alias("chars"))
    # no part holds a marker, and none can arise where a part meets one: each stands once in the output
    p, s, m = (F.locate(t, F.col("output")) for t in (PREFIX, SUFFIX, MIDDLE))
    prefix = F.when(F.col("form") == "psm", s - p - 3).when(F.col("form") == "spm", m - p - 3)
    middle = F.when(F.col("form") != "plain", F.length("output") - m - 2)
    return made.select(F.col("id").alias(id_col), "n", "form", prefix.cast("long").alias("prefix_chars"),
                       middle.cast("long").alias("middle_chars"), "output")
