"""K1: calibration mix preparation as one lazy plan.

Order of steps (it matters, see SURVEY 7.3): per-source seeded sample ->
character filter on the sample (shortfall is not refilled) -> union ->
seeded shuffle -> token-length band -> trim to ``total`` -> distribution.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import MAX_TOKENS, MIN_CHARS_CASES, MIN_TOKENS, min_chars, token_count
from quarry.operators.sampling import MIX_PRESETS, apply_quota, scale_quotas, shuffle_trim
from quarry.operators.stats import distribution


def preset_quotas(mix_name: str) -> dict[str, int]:
    """Quotas of a named preset; an unknown mix raises."""
    if mix_name not in MIX_PRESETS:
        raise ValueError(f"no mix preset named {mix_name!r}; presets: {', '.join(sorted(MIX_PRESETS))}")
    return dict(MIX_PRESETS[mix_name])


def prepare_mix(docs: DataFrame, quotas: Mapping[str, int], total: int = 512, seed: int = 42,
                source_col: str = "lang", key: str = "doc_id", text_col: str = "text",
                min_chars_after_sample: int = MIN_CHARS_CASES,
                min_tokens: int = MIN_TOKENS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Rows of the final mix with their position (``pos``) and token count."""
    q = scale_quotas(quotas, total)
    sampled = (apply_quota(docs.select(key, source_col, text_col), source_col, q, seed, key)
               .filter(min_chars(text_col, min_chars_after_sample)))
    band = (sampled.withColumn("n_tokens", token_count(text_col))
                   .filter(F.col("n_tokens").between(min_tokens, max_tokens)))
    return shuffle_trim(band, total, seed, key)


def mix_distribution(docs: DataFrame, quotas: Mapping[str, int], total: int = 512, seed: int = 42,
                     source_col: str = "lang", **kw) -> DataFrame:
    """K1 result summary: A1 by source over the prepared mix."""
    mix = prepare_mix(docs, quotas, total, seed, source_col=source_col, **kw)
    return distribution(mix, source_col)


log = logging.getLogger("quarry.mix")

# ---------------------------------------------------------------------------
# Labels of the preset loaders, the stand-in source and which
# loaders drop short texts (stripped length <= 100) after sampling.
# ---------------------------------------------------------------------------
LOADER_LABELS = {
    "pubmedqa": ("PubMedQA", "medical_qa"),
    "medqa": ("MedQA", "medical_qa"),
    "pmc_patients": ("PMC-Patients", "clinical_case"),
    "asclepius_notes": ("Asclepius", "clinical_note"),
}
STAND_INS = {"custom_radiology": ("pmc_patients", "PMC-Patients (radiology-filtered)")}
CHAR_FILTERED = ("pmc_patients", "asclepius_notes")
# ---------------------------------------------------------------------------


def prepare_preset_mix(mix_name: str, tables: Mapping[str, tuple[DataFrame, Callable[[DataFrame], Column]]],
                       total: int = 512, seed: int = 42, key: str = "doc_id",
                       min_tokens: int = MIN_TOKENS, max_tokens: int = MAX_TOKENS
                       ) -> tuple[DataFrame, list[str]]:
    """K1 driven by a named preset: per source a seeded loader (S4) with its label and type,
    stand-in sources re-drawn from their base loader with the same seed and relabelled (P21),
    unknown or failing sources skipped (S5); then shuffle, token band, trim (W4, P5).

    ``tables`` maps loader names to ``(rows, formatter)``; returns the mix rows and the skipped names.
    """
    from quarry.sources.registry import sample_source

    quotas = scale_quotas(preset_quotas(mix_name), total)
    parts, skipped = [], []
    for name, q in quotas.items():
        base, relabel = STAND_INS.get(name, (name, None))
        if base not in tables or base not in LOADER_LABELS:
            log.warning("no loader for %s: left out of the mix", name)
            skipped.append(name)
            continue
        try:
            rows, fmt = tables[base]
            label, type_ = LOADER_LABELS[base]
            part = sample_source(rows, q, seed, fmt(rows), relabel or label, type_, key,
                                 min_len_after=MIN_CHARS_CASES if base in CHAR_FILTERED else None)
            parts.append(part)
        except Exception as ex:  # noqa: BLE001 - the mix continues without this source
            log.warning("%s left out of the mix, its loader failed: %s", name, ex)
            skipped.append(name)
    if not parts:
        raise ValueError(f"No source of mix {mix_name} could be loaded")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    band = (u.withColumn("n_tokens", token_count("text"))
             .filter(F.col("n_tokens").between(min_tokens, max_tokens)))
    return shuffle_trim(band, total, seed, key, tie="source"), skipped
