"""License scans by ordered signature rules.

A text is reduced to its words (A-Z lower-cased; runs of 0-9, a-z and non-ASCII
characters) with single spaces between them. A rule is a regular expression over
whole words, gated by a keyword that every match contains. Rules are the table of
license names crossed with the ways in which a license is granted (a bare name
counts, the longer forms raise the confidence), short SPDX identifiers after tags
and in the ways in which they declare a license, and headers, addresses and
sentences of license texts. All matches of a rule count, overlapping ones too. A detection that
lies within a longer one, or within an equal one of a rule of higher priority, is
suppressed. Everything is computed in the row of the document with SQL
functions: no join, no shuffle, no Python.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that always count, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# License names as regular expressions over words, with the keyword that each contains.
NAMES = (
    ("mit", "mit licen[cs]e", "mit licen"), ("mit", "expat licen[cs]e", "expat licen"), ("mit", "x11 licen[cs]e", "x11 licen"),
    ("mit-0", "mit no attribution", "mit no attribution"),
    ("apache-2", "apache licen[cs]e (?:version )?2(?: 0)?", "apache licen"), ("apache-2", "apache 2(?: 0)?", "apache 2"),
    ("apache-1.1", "apache (?:software )?licen[cs]e (?:version )?1 1", "1 1"),
    ("gpl-3", "gnu general public licen[cs]e (?:version |v )?3(?: 0)?", "general public licen"),
    ("gpl-3", "gnu general public licen[cs]e v3", "general public licen"), ("gpl-3", "(?:gnu )?gpl ?(?:version |v ?)?3(?: 0)?", "gpl"),
    ("gpl-2", "gnu general public licen[cs]e (?:version |v )?2(?: 0)?", "general public licen"),
    ("gpl-2", "gnu general public licen[cs]e v2", "general public licen"), ("gpl-2", "(?:gnu )?gpl ?(?:version |v ?)?2(?: 0)?", "gpl"),
    ("gpl", "gnu general public licen[cs]e", "general public licen"),
    ("lgpl-3", "gnu lesser general public licen[cs]e (?:version |v ?)?3(?: 0)?", "lesser general"),
    ("lgpl-3", "(?:gnu )?lgpl ?(?:version |v ?)?3(?: 0)?", "lgpl"),
    ("lgpl-2.1", "gnu lesser general public licen[cs]e (?:version |v ?)?2 1", "lesser general"),
    ("lgpl-2.1", "(?:gnu )?lgpl ?(?:version |v ?)?2 1", "lgpl"),
    ("agpl-3", "gnu affero general public licen[cs]e (?:version |v ?)?3(?: 0)?", "affero"), ("agpl-3", "(?:gnu )?agpl ?(?:version |v ?)?3(?: 0)?", "agpl"),
    ("bsd-2", "(?:simplified bsd|bsd 2 clause|2 clause bsd) licen[cs]e", "bsd"), ("bsd-3", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd) licen[cs]e", "bsd"),
    ("bsd-4", "(?:original bsd|bsd 4 clause|4 clause bsd) licen[cs]e", "bsd"), ("0bsd", "(?:zero clause bsd|0bsd) licen[cs]e", "bsd"),
    ("bsd", "bsd (?:style )?licen[cs]e", "bsd"),
    ("mpl-2", "mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?", "mozilla public"), ("mpl-1.1", "mozilla public licen[cs]e (?:version |v ?)?1 1", "mozilla public"),
    ("epl-2", "eclipse public licen[cs]e (?:version |v ?)?2(?: 0)?", "eclipse public"), ("epl-1", "eclipse public licen[cs]e (?:version |v ?)?1(?: 0)?", "eclipse public"),
    ("cddl-1", "common development and distribution licen[cs]e", "common development"), ("eupl-1.2", "european union public licen[cs]e", "european union public"),
    ("cc-by-nc-sa", "cc by nc sa(?: [1-4] [05])?", "cc by nc sa"), ("cc-by-nc-nd", "cc by nc nd(?: [1-4] [05])?", "cc by nc nd"),
    ("cc-by-nc", "cc by nc(?: [1-4] [05])?", "cc by nc"), ("cc-by-sa", "cc by sa(?: [1-4] [05])?", "cc by sa"),
    ("cc-by-nd", "cc by nd(?: [1-4] [05])?", "cc by nd"), ("cc-by", "cc by(?: [1-4] [05])?", "cc by"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", "creative commons attribution non"),
    ("cc-by-nc", "creative commons attribution non ?commercial", "creative commons attribution non"),
    ("cc-by-sa", "creative commons attribution share ?alike", "creative commons attribution share"),
    ("cc-by", "creative commons attribution", "creative commons attribution"), ("cc0", "cc0(?: 1 0)?", "cc0"), ("cc0", "creative commons zero", "creative commons zero"),
    ("isc", "isc licen[cs]e", "isc licen"), ("zlib", "zlib licen[cs]e", "zlib licen"), ("bsl-1", "boost software licen[cs]e", "boost software"),
    ("unlicense", "the unlicense", "unlicense"), ("wtfpl", "wtfpl", "wtfpl"), ("artistic-2", "artistic licen[cs]e (?:version )?2(?: 0)?", "artistic licen"),
    ("odbl", "open (?:data commons open )?database licen[cs]e", "database licen"), ("ofl-1.1", "(?:sil )?open font licen[cs]e", "open font"),
    ("postgresql", "postgresql licen[cs]e", "postgresql licen"), ("psf", "python software foundation licen[cs]e", "python software foundation"),
    ("ms-pl", "microsoft public licen[cs]e", "microsoft public"), ("sspl", "server side public licen[cs]e", "server side public"),
    ("elastic-2", "elastic licen[cs]e(?: 2 0)?", "elastic licen"), ("busl-1.1", "business source licen[cs]e", "business source"),
    ("public-domain", "public domain", "public domain"), ("proprietary", "all rights reserved", "rights reserved"),
)
# How a license is granted, with confidence; the first has the highest priority.
FORMS = (
    ("spdx licen[cs]e identifier {}", 1.0), ("(?:is |are )?licensed under (?:the )?(?:terms of the )?{}", 0.97),
    ("(?:is |are )?released (?:under|into) (?:the )?(?:terms of the )?{}", 0.95), ("(?:is |are )?distributed under (?:the )?(?:terms of the )?{}", 0.95),
    ("(?:is |are )?available under (?:the )?(?:terms of the )?{}", 0.93), ("subject to (?:the )?(?:terms of the )?{}", 0.9), ("see the {}", 0.7), ("{}", 0.6),
)
#: (number, label, keyword, expression, confidence); the order is the priority.
RULES = [(f * len(NAMES) + n, label, keyword, form.format(f"(?:{name})"), confidence)
         for f, (form, confidence) in enumerate(FORMS) for n, (label, name, keyword) in enumerate(NAMES)]
# Short identifiers as expressions over words, with the literal that each starts with; alone they say nothing.
IDS = (
    ("mit", "mit", "mit "), ("mit-0", "mit 0", "mit 0"), ("apache-2", "apache 2(?: 0)?", "apache 2"), ("apache-1.1", "apache 1 1", "apache 1 1"),
    ("gpl-3", "gpl 3(?: 0)?(?: only| or later)?", "gpl 3"), ("gpl-2", "gpl 2(?: 0)?(?: only| or later)?", "gpl 2"), ("gpl-1", "gpl 1(?: 0)?(?: only| or later)?", "gpl 1"),
    ("lgpl-3", "lgpl 3(?: 0)?(?: only| or later)?", "lgpl 3"), ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", "lgpl 2 1"), ("lgpl-2", "lgpl 2(?: 0)?(?: only| or later)?", "lgpl 2"),
    ("agpl-3", "agpl 3(?: 0)?(?: only| or later)?", "agpl 3"), ("bsd-2", "bsd 2 clause", "bsd 2"), ("bsd-3", "bsd 3 clause", "bsd 3"), ("bsd-4", "bsd 4 clause", "bsd 4"),
    ("bsd", "bsd", "bsd "), ("0bsd", "0bsd", "0bsd"), ("mpl-2", "mpl 2(?: 0)?", "mpl 2"), ("mpl-1.1", "mpl 1 1", "mpl 1 1"), ("epl-2", "epl 2(?: 0)?", "epl 2"),
    ("epl-1", "epl 1(?: 0)?", "epl 1"), ("cddl-1", "cddl 1 [01]", "cddl 1"), ("eupl-1.2", "eupl 1 2", "eupl 1 2"), ("isc", "isc", "isc "), ("zlib", "zlib", "zlib "),
    ("bsl-1", "bsl 1 0", "bsl 1 0"), ("unlicense", "unlicense", "unlicense"), ("wtfpl", "wtfpl", "wtfpl"), ("artistic-2", "artistic 2 0", "artistic 2"),
    ("artistic-1", "artistic 1 0", "artistic 1"), ("odbl", "odbl(?: 1 0)?", "odbl"), ("ofl-1.1", "ofl 1 1", "ofl 1 1"), ("postgresql", "postgresql", "postgresql "),
    ("psf", "(?:psf|python) 2 0(?: 1)?", " 2 0"), ("ms-pl", "ms pl", "ms pl"), ("ms-rl", "ms rl", "ms rl"), ("sspl", "sspl 1 0", "sspl 1 0"), ("elastic-2", "elastic 2 0", "elastic 2"),
    ("busl-1.1", "busl 1 1", "busl 1 1"), ("ncsa", "ncsa", "ncsa "), ("afl-3", "afl 3 0", "afl 3"), ("ecl-2", "ecl 2 0", "ecl 2"), ("cecill-2.1", "cecill 2 1", "cecill 2 1"),
    ("cc0", "cc0(?: 1 0)?", "cc0"), ("cc-by", "cc by(?: [1-4] [05])?", "cc by"), ("cc-by-sa", "cc by sa(?: [1-4] [05])?", "cc by sa"),
    ("cc-by-nd", "cc by nd(?: [1-4] [05])?", "cc by nd"), ("cc-by-nc", "cc by nc(?: [1-4] [05])?", "cc by nc"),
    ("cc-by-nc-sa", "cc by nc sa(?: [1-4] [05])?", "cc by nc sa"), ("cc-by-nc-nd", "cc by nc nd(?: [1-4] [05])?", "cc by nc nd"),
)
# How a short identifier declares a license: form, keyword, confidence. The second and third identifier of
# an SPDX expression start one and two words after the tag, so that none lies within another.
ANY = "(?:" + "|".join(x for _, x, _ in IDS) + ")"
ID_FORMS = (
    ("spdx licen[cs]e identifier {}", "identifier {}", 1.0), (f"licen[cs]e identifier {ANY} (?:or|and) {{}}", "e identifier ", 1.0),
    (f"identifier {ANY} (?:or|and) {ANY} (?:or|and) {{}}", "identifier ", 1.0),
    ("(?:is |are )?(?:dual )?licen[cs]ed under (?:the )?(?:terms of )?(?:the )?{}", "{}", 0.95),
    ("(?:released under|distributed under|available under|published under) (?:the )?(?:terms of )?(?:the )?{}", "{}", 0.93),
    ("{} licen[cs]ed", "{}", 0.9), ("(?:opensource|spdx) org licen[cs]es? {}", " org licen", 0.9), ("licen[cs]e {}", "e {}", 0.8), ("{} licen[cs]e", "{}", 0.8),
)
# Headers, addresses and sentences of license texts (at most 24 words): label, expression, keyword, confidence.
GNU = "as published by the free software foundation(?: either)? version"
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "is hereby granted free of charge", 0.95),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "is hereby granted free of charge", 0.95),
    ("isc", "distribute this software for any purpose with or without fee is hereby granted provided that the above", "fee is hereby granted provided", 0.95),
    ("0bsd", "distribute this software for any purpose with or without fee is hereby granted the software is provided", "fee is hereby granted the", 0.95),
    ("postgresql", "distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "agreement is hereby granted", 0.95),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source", 0.9),
    ("bsd-3", "may be used to endorse or promote products derived from this software without (?:specific )?prior written permission", "promote products derived", 0.9),
    ("bsd-4", "all advertising materials mentioning features or use of this software must display the following", "advertising materials mentioning", 0.95),
    ("zlib", "provided as is without any express or implied warranty in no event will the authors be held liable", "provided as is without any express", 0.9),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software", 0.95),
    ("wtfpl", "do what the fuck you want to public licen[cs]e", "you want to public licen", 0.95),
    ("apache-2", "apache org licen[cs]es licen[cs]e 2 0", "apache org licen", 0.95),
    ("apache-2", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge", "contributor hereby grants to you", 0.95),
    ("mpl-2", "each contributor hereby grants you a world wide royalty free non exclusive", "contributor hereby grants you", 0.95),
    ("mpl-2", "mozilla org mpl 2 0", "mozilla org mpl", 0.9), ("mpl-1.1", "mozilla org mpl mpl 1 1", "mozilla org mpl", 0.9),
    ("epl-2", "eclipse org legal epl (?:v20|2 0)", "eclipse org legal", 0.9), ("epl-1", "eclipse org legal epl v10", "eclipse org legal", 0.9),
    ("ofl-1.1", "scripts sil org ofl", "scripts sil org", 0.9), ("cc0", "creativecommons org publicdomain zero(?: 1 0)?", "creativecommons org", 0.95),
    *((f"cc-{x.replace(' ', '-')}", f"creativecommons org licen[cs]es {x}(?: [1-4] [05])?", "creativecommons org", 0.95)
      for x in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")),
    *((label, f"gnu {kind}general public licen[cs]e {GNU} {version}", "as published by the free software foundation", 0.97) for label, kind, version in (
        ("gpl-3", "", "3"), ("gpl-2", "", "2"), ("lgpl-3", "lesser ", "3"), ("lgpl-2.1", "lesser ", "2 1"), ("lgpl-2", "library ", "2"), ("agpl-3", "affero ", "3"))),
    ("lgpl-2", "gnu library general public licen[cs]e", "library general public licen", 0.7),
)
RULES += [(len(RULES) + f * len(IDS) + n, label, keyword.format(literal).replace("  ", " "), form.format(f"(?:{x})"), confidence)
          for f, (form, keyword, confidence) in enumerate(ID_FORMS) for n, (label, x, literal) in enumerate(IDS)]
RULES += [(len(RULES) + n, label, keyword, x, confidence) for n, (label, x, keyword, confidence) in enumerate(TEXTS)]
# Every rule's match holds one of these.
GATES = ("licen", "gpl", " cc by ", " cc0 ", "creative commons", " public domain ", " rights reserved ", " apache 2 ", " mit no attribution ", " wtfpl ",
         " identifier ", " released under ", " distributed under ", " available under ", " published under ", " is hereby granted ", " redistribution and use in source ",
         " promote products derived ", " advertising materials mentioning ", " provided as is without any express ", " unencumbered software ",
         " contributor hereby grants ", " mozilla org mpl ", " eclipse org legal ", " scripts sil org ", "creativecommons org")

NON_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\x01"
STRETCH = 256
TABLE = "array<struct<number:int,label:string,keyword:string,expression:string,confidence:double>>"
FINDING = "array<struct<start:bigint,neg_end:bigint,rule:int,label:string,confidence:double>>"


def _words(c: Column) -> Column:
    """Number of words in a piece of the reduced text (a space before each)."""
    return (F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")


def reduced(text: Column) -> Column:
    """`` w0 w1 ... `` (a space around every word); a single space without words."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NON_WORDS, " ")
    return F.concat(F.lit(" "), F.trim(flat), F.lit(" "))


def _pieces(norm: Column, expression) -> Column:
    """The reduced text cut before every match of whole words, overlapping matches included."""
    return F.split(F.regexp_replace(norm, F.concat(F.lit("(?= "), expression, F.lit(" )")), F.lit(MARK)), MARK)


def _before(values: Column, fold) -> Column:
    """For every number of an array (none below 0) the fold of those before it, 0 for the first.

    Results are gathered in stretches of ``STRETCH``, so that no long array grows number by number.
    """
    longs = F.array().cast("array<bigint>")
    start = F.struct(F.lit(0).cast("long").alias("now"), longs.alias("done"), longs.alias("open"))

    def step(a, x):
        full = F.size(a["open"]) >= STRETCH
        return F.struct(fold(a["now"], x).alias("now"), F.when(full, F.concat(a["done"], a["open"])).otherwise(a["done"]).alias("done"),
                        F.when(full, F.array(a["now"])).otherwise(F.concat(a["open"], F.array(a["now"]))).alias("open"))

    return F.aggregate(values, start, step, lambda a: F.concat(a["done"], a["open"]))


def _detections(norm: Column, rule: Column) -> Column:
    """Start and negated end (words, end exclusive) of every match of one rule."""
    parts = _pieces(norm, rule["expression"])
    found = F.regexp_extract_all(norm, F.concat(F.lit("(?=( "), rule["expression"], F.lit(" ))")), F.lit(1))
    starts = F.slice(_before(F.transform(parts, _words), lambda a, b: a + b), 2, F.size(parts) - 1)
    return F.zip_with(starts, found, lambda s, m: F.struct(
        s.alias("start"), (-(s + _words(m) - 1)).alias("neg_end"), rule["number"].alias("rule"), rule["label"].alias("label"),
        rule["confidence"].alias("confidence")))


def scan(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with ``license_scan``: struct of n_words, base (phrase places) and findings.

    findings: array of (start, end, rule, label, confidence) in words, sorted by
    place, after suppression. Defined cases: null and wordless texts have 0 words
    and no findings; repeated rows get equal results; other columns are kept
    whatever their names (the added one is ``license_scan``); an empty table
    gives an empty result.
    """
    # one literal, not some thousands of expressions to plan
    table = F.from_json(F.lit(json.dumps([dict(zip(("number", "label", "keyword", "expression", "confidence"), r)) for r in rules])), TABLE)
    out = docs.select(F.struct(*docs.columns).alias("row"), reduced(F.col(text_col).cast("string")).alias("norm"))
    norm = F.col("norm")
    gate = reduce(lambda a, b: a | b, [F.contains(norm, F.lit(g)) for g in GATES])
    active = F.filter(table, lambda r: F.contains(norm, r["keyword"]))
    every = F.sort_array(F.flatten(F.transform(active, lambda r: _detections(norm, r))).cast(FINDING))
    out = out.withColumn("found", F.when(gate, every).otherwise(F.array().cast(FINDING)))
    # sorted by start, longest first, then priority: what an earlier one reaches around is inside it
    reach = _before(F.transform("found", lambda d: -d["neg_end"]), F.greatest)
    kept = F.transform(F.filter(F.zip_with("found", reach, lambda d, r: F.struct(d.alias("d"), r.alias("r"))),
                                lambda x: x["r"] < -x["d"]["neg_end"]), lambda x: x["d"])
    places = []
    for phrase, label in BASE:
        parts = _pieces(norm, F.lit(phrase))
        none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"), F.lit(label).alias("label"))
        some = F.struct((F.size(parts) - 1).cast("long").alias("n"), _words(parts[0]).alias("first"),
                        _words(F.array_join(F.slice(parts, 1, F.size(parts) - 1), "")).alias("last"), F.lit(label).alias("label"))
        places.append(F.when(gate & F.contains(norm, F.lit(f" {phrase} ")), some).otherwise(none))
    ends = F.transform(kept, lambda d: F.struct(d["start"].alias("start"), (-d["neg_end"]).alias("end"), d["rule"].alias("rule"),
                                                d["label"].alias("label"), d["confidence"].alias("confidence")))
    n_words = F.when(norm == F.lit("  "), F.lit(0)).otherwise(_words(norm) - 1).cast("long")
    return out.select("row.*", F.struct(n_words.alias("n_words"), F.array(*places).alias("base"), ends.alias("findings")).alias("license_scan"))


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_findings)`` for every row of ``docs``."""
    s = scan(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    base = F.filter("license_scan.base", lambda b: b["n"] > 0)
    base_labels = F.transform(base, lambda b: b["label"])
    found = F.col("license_scan.findings")
    return s.select(
        "doc_id", F.col("license_scan.n_words").alias("n_words"),
        F.aggregate("license_scan.base", F.lit(0).cast("long"), lambda a, b: a + b["n"]).alias("n_base"),
        F.array_min(F.transform(base, lambda b: b["first"])).alias("first_word"), F.array_max(F.transform(base, lambda b: b["last"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.transform(found, lambda d: d["label"]))), ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform(found, lambda d: d["confidence"])), F.lit(0.0)), F.when(F.size(base) > 0, 0.9).otherwise(0.0)).alias("score"),
        F.size(found).cast("long").alias("n_findings"))


def report_sql() -> str:
    """The same report as DuckDB SQL over ``documents``."""
    rules = ",\n".join(f"({n}, '{label}', '{k}', '{x}', {c})" for n, label, k, x, c in RULES)
    base = ", ".join(f"('{p}', '{label}')" for p, label in BASE)
    return rf"""
WITH rules(rule, label, keyword, expression, confidence) AS (VALUES
{rules}),
phrases(phrase, label) AS (VALUES {base}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
n AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS norm FROM d),
b0 AS (SELECT rid, label, string_split(phrase, ' ') AS p, w, unnest(range(0, len(w))) AS i FROM n JOIN phrases ON contains(norm, ' ' || phrase || ' ')),
b AS (SELECT rid, label, i FROM b0 WHERE list_slice(w, i + 1, i + len(p)) = p),
bs AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY rid),
g AS (SELECT rid, w, rule, label, expression, confidence, unnest(range(0, len(w))) AS s FROM n JOIN rules ON contains(norm, keyword)),
m AS (SELECT *, regexp_extract(' ' || array_to_string(list_slice(w, s + 1, s + 24), ' ') || ' ', '^ (' || expression || ') ', 1) AS t FROM g),
f AS (SELECT rid, rule, label, confidence, s, s + len(string_split(t, ' ')) AS e FROM m WHERE t <> ''),
k AS (SELECT *, max(e) OVER (PARTITION BY rid ORDER BY s, e DESC, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f),
kept AS (SELECT * FROM k WHERE reach IS NULL OR reach < e),
ks AS (SELECT rid, max(confidence) AS c, count(*) AS n FROM kept GROUP BY rid),
l AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM kept UNION ALL SELECT rid, label FROM b) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(coalesce(c, 0), CASE WHEN n_base > 0 THEN 0.9 ELSE 0 END)::DOUBLE AS score, coalesce(ks.n, 0)::BIGINT AS n_findings
FROM n LEFT JOIN bs USING (rid) LEFT JOIN ks USING (rid) LEFT JOIN l USING (rid)
"""
