"""Column expressions for text: stripping, tokens, formatting, routing.

Everything here returns a ``Column`` built from native Spark SQL functions,
so it stays inside whole-stage codegen and runs on every partition in place.
Nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must match the behaviour being reproduced)
# ---------------------------------------------------------------------------
# Characters removed at both ends by "strip" (Python str.strip() on ASCII).
STRIP_CHARS = " \t\n\r\f\x0b"
# A token is a maximal run of characters that are not space, tab, newline,
# carriage return or form feed.
TOKEN_PATTERN = r"[^ \t\n\r\f]+"
# Minimum stripped character counts used by the loaders (strictly greater).
MIN_CHARS_HUB = 50
MIN_CHARS_CASES = 100
MIN_CHARS_BACKFILL = 200
# Token length band of the mix filter (inclusive) and of calibration routing.
MIN_TOKENS = 256
MAX_TOKENS = 4096
PACK_MIN_TOKENS = 50
# Chat markers of the single-turn prompt and of the conversation template.
BEGIN_OF_TEXT = "<|begin_of_text|>"
END_OF_TEXT = "<|end_of_text|>"
START_HEADER = "<|start_header_id|>"
END_HEADER = "<|end_header_id|>"
END_OF_TURN = "<|eot_id|>"
DEFAULT_SYSTEM_PROMPT = (
    "You are a medical AI assistant. Provide accurate, evidence-based medical information.\n"
    "Be concise and professional. Always recommend verification by healthcare professionals."
)
# Output-token budget tiers by input length: (< 1000 -> 150, < 2500 -> 250, else 400).
TOKEN_TIERS = ((1000, 150), (2500, 250))
TOKEN_TIER_TOP = 400
# Markers of the uncertainty (hallucination-resistance) check.
UNCERTAINTY_MARKERS = (
    "not familiar", "don't recognize", "cannot find", "no information",
    "not aware", "fictional", "doesn't exist", "unable to", "i don't",
)
# Terms that make a patient summary "not simple" in the readability check.
COMPLEX_TERMS = (
    "bilateral", "consolidation", "effusion", "pneumothorax", "mediastinum", "lymphadenopathy",
)
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stripped(c: str | Column) -> Column:
    """Python-style ``strip()``: whitespace removed at both ends."""
    return F.btrim(col(c), F.lit(STRIP_CHARS))


def stripped_length(c: str | Column) -> Column:
    return F.length(stripped(c))


def min_chars(c: str | Column, n: int) -> Column:
    """Keep when the stripped text is strictly longer than ``n``."""
    return F.coalesce(stripped_length(c) > F.lit(n), F.lit(False))


# Separator characters of the token rule (the complement of TOKEN_PATTERN's class).
TOKEN_SEPARATORS = " \t\n\r\f"
TOKEN_SEPARATOR_RUN = r"[ \t\n\r\f]+"


def tokens(c: str | Column) -> Column:
    """Token list in order (``array<string>``): maximal runs of non-separator characters.

    ``split`` of the separator-trimmed text on separator runs yields exactly
    the runs ``TOKEN_PATTERN`` matches, and is cheaper than a regex extraction.
    """
    t = F.btrim(col(c), F.lit(TOKEN_SEPARATORS))
    return F.when(t == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(t, TOKEN_SEPARATOR_RUN))


def token_count(c: str | Column) -> Column:
    """Untruncated token count (0 for null)."""
    return F.when(col(c).isNull(), F.lit(0)).otherwise(F.size(tokens(c)))


def lower_tokens(c: str | Column) -> Column:
    return tokens(F.lower(col(c)))


def truncate_tokens(c: str | Column, max_length: int, n_tokens: Column | None = None) -> Column:
    """First ``max_length`` tokens joined by one space.

    Rows at or under the limit are returned unchanged; only longer rows are
    rewritten (runs of whitespace then become one space).
    """
    n = n_tokens if n_tokens is not None else token_count(c)
    return F.when(n > F.lit(max_length),
                  F.array_join(F.slice(tokens(c), 1, max_length), " ")).otherwise(col(c))


def length_class(n_tokens: str | Column, lo: int = MIN_TOKENS, hi: int = MAX_TOKENS) -> Column:
    """P5 classes: ``too_short`` (< lo), ``too_long`` (> hi), else ``accepted``."""
    n = col(n_tokens)
    return (F.when(n < F.lit(lo), F.lit("too_short"))
             .when(n > F.lit(hi), F.lit("too_long"))
             .otherwise(F.lit("accepted")))


def route_by_length(text: str | Column, n_tokens: str | Column,
                    min_length: int = MIN_TOKENS, pack_min: int = PACK_MIN_TOKENS) -> Column:
    """``keep`` (>= min_length), ``pack`` (>= pack_min), else ``drop``; empty text dropped."""
    t, n = col(text), col(n_tokens)
    return (F.when(t.isNull() | (t == F.lit("")), F.lit("drop"))
             .when(n >= F.lit(min_length), F.lit("keep"))
             .when(n >= F.lit(pack_min), F.lit("pack"))
             .otherwise(F.lit("drop")))


def format_qa(question: str | Column, answer: str | Column) -> Column:
    """``question + "\\n\\n" + answer``; a missing side reads as ``""``."""
    return F.concat(F.coalesce(col(question), F.lit("")), F.lit("\n\n"),
                    F.coalesce(col(answer), F.lit("")))


def format_qa_rows(df, question: str, answer: str, out: str = "text", on_missing: str = "empty"):
    """P1 over a table with its three variants: ``empty`` (missing side -> ""), ``error``
    (a missing side fails the job) and ``drop`` (rows with an empty side are dropped)."""
    q, a = col(question), col(answer)
    if on_missing == "empty":
        return df.withColumn(out, format_qa(q, a))
    if on_missing == "error":
        bad = q.isNull() | a.isNull()
        return df.withColumn(out, F.when(bad, F.raise_error(F.lit("missing question or answer")))
                             .otherwise(format_qa(q, a)))
    if on_missing == "drop":
        keep = F.coalesce(q, F.lit("")) != F.lit("")
        keep = keep & (F.coalesce(a, F.lit("")) != F.lit(""))
        return df.filter(keep).withColumn(out, format_qa(q, a))
    raise ValueError(f"on_missing must be empty, error or drop, not {on_missing}")


def format_mcq(question: str | Column, choices: str | Column) -> Column:
    """Question, blank line, ``Options:`` and numbered choices; question alone without choices."""
    ch = col(choices)
    numbered = F.array_join(
        F.transform(ch, lambda c, i: F.concat((i + 1).cast("string"), F.lit(". "), F.coalesce(c, F.lit("")))),
        "\n")
    q = F.coalesce(col(question), F.lit(""))
    return F.when(F.coalesce(F.size(ch), F.lit(0)) > 0,
                  F.concat(q, F.lit("\n\nOptions:\n"), numbered)).otherwise(q)


def render_prompt(query: str | Column, system: str | None = DEFAULT_SYSTEM_PROMPT) -> Column:
    """Single-turn chat string with header and end-of-turn markers."""
    user = F.concat(F.lit(f"{START_HEADER}user{END_HEADER}\n\n"), col(query), F.lit(END_OF_TURN))
    tail = F.lit(f"{START_HEADER}assistant{END_HEADER}\n\n")
    if system is None:
        return F.concat(F.lit(BEGIN_OF_TEXT), user, tail)
    head = F.lit(f"{BEGIN_OF_TEXT}{START_HEADER}system{END_HEADER}\n\n{system}{END_OF_TURN}")
    return F.concat(head, user, tail)


def extract_response(full: str | Column, prompt: str | Column) -> Column:
    """P10: text after the last lower-case ``assistant`` when the word occurs in
    any case; else the text after the prompt when longer (stripped); else as is."""
    f, p = col(full), col(prompt)
    return (F.when(F.lower(f).contains("assistant"), stripped(F.substring_index(f, "assistant", -1)))
             .when(F.length(f) > F.length(p), stripped(f.substr(F.length(p) + 1, F.length(f))))
             .otherwise(f))


def drop_prompt_prefix(full: str | Column, prompt: str | Column) -> Column:
    """P10 simple variant: the text after the prompt's length, stripped."""
    f, p = col(full), col(prompt)
    return stripped(f.substr(F.length(p) + 1, F.greatest(F.length(f) - F.length(p), F.lit(0))))


def _lit_array(words: Iterable[str]) -> Column:
    return F.array(*[F.lit(w.lower()) for w in words])


def _quoted_alternation(words: Iterable[str]) -> str:
    """Regex matching any of the literal (lower-cased) words: ``\\Q..\\E`` quoting, one alternation."""
    return "|".join("\\Q" + w.lower().replace("\\E", "\\E\\\\E\\Q") + "\\E" for w in words)


def has_any(text: str | Column, keywords: Sequence[str]) -> Column:
    """Case-insensitive substring test, any keyword.

    One regex alternation over ``lower(text)``: the text is lower-cased and
    scanned once, instead of once per keyword inside a lambda.
    """
    if not keywords:
        return F.lit(False)
    return F.coalesce(F.lower(col(text)).rlike(_quoted_alternation(keywords)), F.lit(False))


def has_none(text: str | Column, terms: Sequence[str] = COMPLEX_TERMS) -> Column:
    """P12 readability: none of the terms present."""
    return ~has_any(text, terms)


def shows_uncertainty(text: str | Column, markers: Sequence[str] = UNCERTAINTY_MARKERS) -> Column:
    """P12 hedge check: any marker present."""
    return has_any(text, markers)


def max_tokens_tier(length: str | Column) -> Column:
    """Output token budget by input length."""
    n = col(length)
    expr = None
    for bound, budget in TOKEN_TIERS:
        expr = (F.when(n < F.lit(bound), F.lit(budget)) if expr is None
                else expr.when(n < F.lit(bound), F.lit(budget)))
    return expr.otherwise(F.lit(TOKEN_TIER_TOP))


# Identifier patterns (ours: the rule "exclude personal identifiers" comes
# without patterns). Checked in this order; the first match names the reason.
# Written in the regex subset shared by Java and RE2 (no \b, no \s).
IDENTIFIER_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    ("card", r"[0-9]{13,19}"),
    ("ip", r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"),
    ("phone", r"[+]?[0-9][0-9 ().-]{7,}[0-9]"),
    ("secret", r'(?i)(token|api_key|secret|password) *[=:] *"'),
)
# A character every match of the pattern must contain: a plain substring test
# first skips the regex on texts that cannot match (same result, less work).
_IDENTIFIER_GUARDS = {"email": "@", "secret": '"'}


def identifier_reason(text: str | Column) -> Column:
    """First identifier kind found (see ``IDENTIFIER_PATTERNS``) or null."""
    t = col(text)
    has_digit = t.rlike("[0-9]")
    expr = None
    for kind, pattern in IDENTIFIER_PATTERNS:
        guard = t.contains(_IDENTIFIER_GUARDS[kind]) if kind in _IDENTIFIER_GUARDS else has_digit
        cond = guard & t.rlike(pattern)
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    return expr


def has_identifier(text: str | Column) -> Column:
    return identifier_reason(text).isNotNull()


def content_hash(text: str | Column) -> Column:
    """P20: 64-hex SHA-256 of the text."""
    return F.sha2(col(text), 256)


def mask_id(c: str | Column, salt: str) -> Column:
    """P20: salted SHA-256 of an identifier (stable for grouping, not reversible)."""
    return F.sha2(F.concat(F.lit(salt), col(c).cast("string")), 256)


def encrypt_id(c: str | Column, key: str | Column) -> Column:
    """P20 reversible variant: AES-GCM encryption of an identifier, base64 text
    (``decrypt_id`` with the same 16/24/32-byte key restores it)."""
    k = F.lit(key) if isinstance(key, str) else key
    return F.base64(F.aes_encrypt(col(c).cast("string"), k))


def decrypt_id(c: str | Column, key: str | Column) -> Column:
    k = F.lit(key) if isinstance(key, str) else key
    return F.aes_decrypt(F.unbase64(col(c)), k).cast("string")


def seeded_hash(key: str | Column, seed: int | str, tag: str | None = None) -> Column:
    """Hex md5 of ``key|seed[|tag]``: a uniform, partition-independent sort key."""
    parts = [col(key).cast("string"), F.lit(f"|{seed}" + (f"|{tag}" if tag else ""))]
    return F.md5(F.concat(*parts))


def fill_template(template: str | Column, values: dict[str, Column | str | None],
                  placeholder: str = "TBD") -> Column:
    """Replace every ``{{KEY}}`` by its value; null values get ``placeholder``."""
    out = F.lit(template) if isinstance(template, str) else template
    for key, value in values.items():
        v = F.lit(placeholder) if value is None else F.coalesce(col(value).cast("string"), F.lit(placeholder))
        out = F.replace(out, F.lit("{{" + key + "}}"), v)
    return out
