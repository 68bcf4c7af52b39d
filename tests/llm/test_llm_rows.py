"""Licenses, HTML, mixing, sharding, pipeline: brute force and defined cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm.html_text import extract, render
from quarry.llm.licenses import BASE, GATES, ID_FORMS, IDS, RULES, TEXTS, license_report, scan
from quarry.llm.mixing import hypergeometric, mix_report, mixed_documents, split_tree, targets, write_shards
from quarry.llm.ranks import positions
from quarry.llm.sharding import propagate, shard_documents

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_license_rules_are_gated():
    assert len({n for n, *_ in RULES}) == len(RULES) > 300
    for _, _, keyword, x, _ in RULES:
        literal = x.replace("licen[cs]e", "license")
        assert any(g.strip() in keyword or g.strip() in literal for g in GATES), x


def test_license_scan_matches_brute_force(spark):
    texts = ["Licensed under the MIT License. under the mit license under THE mit-license", "Apache License, Version 2.0 and CC BY-NC 4.0, CC-BY", None, "",
             "GNU General Public License version 3; cc by nc cc by nc sa", "mit einem Wort", "İ K ü-mit license É", "All rights reserved. " * 400,
             "word " * 200_000 + "released under the BSD 3-clause license", "SPDX-License-Identifier: MIT License", "...", "cc by nc"]
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)] + [(0, texts[0], "q"), (None, "cc by nc", "q")], "doc_id long, text string, _norm string")
    got = license_report(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = "cc by nc" if r.doc_id is None else texts[r.doc_id]
        w = words(t)
        places = [(i, label) for p, label in BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((min(i for i, _ in places), max(i for i, _ in places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        norm = [""] if not w else w
        found = []
        joined = " " + " ".join(norm) + " "
        for n, label, k, x, c in RULES:
            if k in joined:
                for m in re.finditer(f"(?=( {x} ))", joined):
                    s = joined[:m.start()].count(" ")
                    found.append((s, -(s + m[1].count(" ") - 1), n, label, c))
        kept, reach = [], 0
        for s, e, n, label, c in sorted(found):
            if -e > reach:
                kept.append((label, c))
                reach = -e
        assert r.n_findings == len(kept)
        assert r.labels == ",".join(sorted({x for _, x in places} | {x for x, _ in kept}))
        assert r.score == max([0.0, *(c for _, c in kept)] + [0.9] * bool(places))
    assert license_report(docs.limit(0)).count() == 0
    assert scan(docs).columns == ["doc_id", "text", "_norm", "license_scan"]
    spans = scan(docs.where("doc_id = 1")).select("license_scan.findings").first()[0]
    assert [(x.label, x.start, x.end) for x in spans] == [("apache-2", 0, 5), ("cc-by-nc", 6, 11), ("cc-by", 11, 13)]


PAGES = {
    "": "", "plain": "plain", "<p>a<p>b": "a\n\nb", "a<br>b<br><br>c": "a\nb\n\nc",
    "<ul><li>one<li>two<ol start=3><li>x<li>y</ol><li>z</ul>": "- one\n- two\n  3. x\n  4. y\n- z",
    "<table><tr><th>Name<th>Qty<tr><td>apple<td>12<tr><td>a<br>b<td>3</table>": "Name   Qty\napple  12\na      3\nb",
    "x<script>if (a < b) '</p>'</script>y<style>p{}</style>z<!-- c --><span hidden>h</span><i style='display : none'>n</i>!": "xyz!",
    "<pre>  a\n   b</pre>": "  a\n   b", "<div>1</div><div>2</div>3": "1\n2\n3", "a  \n b&amp;&lt;c&nbsp;d": "a b&<c d",
    "<title>t</title><body>b</body></html>": "b", "1 < 2 <b": "1 < 2", "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n  d\nu", "</p></div>x</li>": "x", "<table><tr><td><table><tr><td>in</table><td>out</table>": "in  out",
}


@pytest.mark.parametrize("page", PAGES)
def test_render(page):
    assert render(page) == PAGES[page]


STRAY = {
    "<table><tr><td>a</td></tr><p>all that follows": "all that follows\n\na", "<table><tr><td>a</td>s<td>b</table>c": "s\na  b\n\nc",
    "x<table>s<tr><td>a</td></tr><caption>cap</caption><div>d</div><form>f</form><tr><td>b</table>": "x\n\ns\ncap\nd\nf\na\nb",
    "<table><td>a<tr><td>b</table>c": "a\nb\n\nc", "<table><tr><td>a</td><div>d<td>e</div></table>": "d\na  e",
    "<table><tr><td><table><tr><td>in</td>s</table></td>t<td>out</table>": "t\ns   out\nin",
    "<pre><table>\n<tr><td>a</td>\n<td>b</td></tr>\n</table></pre>": "a  b",
    "<table><tr><td>a</td></tr><tr hidden>n<td>m</td></tr></table>": "a", "<ul><li><table><tr><td>a</td></tr>s</table><li>b</ul>": "- s\n  a\n\n- b",
}


@pytest.mark.parametrize("page", STRAY)
def test_text_of_a_table_outside_cells(page):
    assert render(page) == STRAY[page]


EMBEDDED = {
    "<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds": "so x=2 holds",
    "<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable><mspace/></math>": "1 2",
    "<svg><title>t</title><desc>d</desc><defs><text>n</text></defs><style>s</style><text x='1'>Jan</text><g><text>Fe<tspan>b</tspan></text></g>bare</svg>!": "Jan Feb !",
    "<svg><defs/><text display='none'>n</text><text>y</text><foreignObject><p>in</p></foreignObject></svg>z": "y\n\nin\n\nz",
    "<svg><g>bare<p>out": "out", "a<svg/>b<svg hidden><text>n</text></svg>c": "abc",
    "In <select><option>one<option selected>two</select> of": "In two of", "<select><option disabled>n<option>f&amp;g<option>h</select>": "f&g",
    "<select multiple><optgroup label=G><option>a</option><option label=L>b</option></optgroup><option hidden>n</select>c": "G\na\nL\nc",
    "<select size=3><option>a<optgroup label=H disabled><option>b</select>": "a\nH\nb", "<select hidden><option>n</select>x": "x",
    "<select><option>a<input>b": "a b", "<table><tr><td><select><option>a<td>b</table>": "a  b",
    "<select><option selected disabled hidden>Choose<option>x</select>": "Choose",
}


@pytest.mark.parametrize("page", EMBEDDED)
def test_embedded_vocabularies_and_choices(page):
    assert render(page) == EMBEDDED[page]


def test_extract_defined_cases(spark):
    rows = [(1, "<p>a</p>"), (1, "<p>a</p>"), (2, None), (3, "<div>" * 20_000 + "deep"), (None, "<b>x"), (4, "<p>w " * 100_000), (5, "<a href=\"x")]
    got = extract(spark.createDataFrame([(i, h, "t") for i, h in rows], "page_id long, html string, text string")).collect()
    by = defaultdict(list)
    for r in got:
        by[r.page_id].append((r.text, r.n_words))
    assert by[1] == [("a", 1)] * 2 and by[2] == [("", 0)] and by[3] == [("deep", 1)] and by[None] == [("x", 1)] and by[4][0][1] == 100_000
    assert extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_pages_lose_no_visible_word(spark):
    """Every word outside tags, head, scripts and comments comes out, in order."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    texts = {r.page_id: r.text.split() for r in extract(pages).collect()}
    import html
    for r in pages.collect():
        t = re.sub(r"<!--.*?-->|<head>.*?</head>|<script.*?</script>|<style.*?</style>", "", r.html, flags=re.S)
        t = re.sub(r"</?(?:b|a|i)\b[^>]*>", "", t)
        t = html.unescape(re.sub(r"<[^>]*>", " ", t))
        assert [w for w in texts[r.page_id] if w != "-"] == t.split()


DECLARATIONS = {
    "// SPDX-License-Identifier: MIT": "mit", "# SPDX-License-Identifier: BSD-3-Clause": "bsd-3", "SPDX-License-Identifier: MPL-2.0": "mpl-2",
    "/* SPDX-License-Identifier: ISC */": "isc", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2", "SPDX-License-Identifier: MIT OR Apache-2.0": "apache-2,mit",
    "SPDX-License-Identifier: (GPL-2.0-only OR BSD-2-Clause) AND Zlib": "bsd-2,gpl-2,zlib", "This crate is licensed under MIT.": "mit", "MIT licensed": "mit",
    "Code is dual-licensed under Apache-2.0": "apache-2", '"license": "ISC",': "isc", "Released under BSD.": "bsd", "https://opensource.org/licenses/MIT": "mit",
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files": "mit",
    "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above copyright": "isc",
    "under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License": "gpl-3",
    "http://www.apache.org/licenses/LICENSE-2.0": "apache-2", "https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa",
    "This is free and unencumbered software released into the public domain.": "unlicense", "https://mozilla.org/MPL/2.0/": "mpl-2",
    "ein Haus mit Garten": "", "He studied at MIT and ISC.": "", "the identifier mit": "", "python 2.0 was released": "",
}


def test_license_declarations_as_found_in_the_wild(spark):
    texts = list(DECLARATIONS)
    got = license_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {texts[r.doc_id]: r.labels for r in got} == DECLARATIONS


def test_license_matches_hold_their_keyword_and_a_gate():
    """Every identifier in every form: the keyword and a gate are in the reduced match itself."""
    compiled = [(n, label, k, re.compile(f"(?=( {x} ))"), c) for n, label, k, x, c in RULES]
    for text in [f.replace("[cs]", "s").replace("{}", x) for _, x, _ in IDS for f, _, _ in ID_FORMS] + [x.replace("[cs]", "s") for _, x, *_ in TEXTS]:
        whole = " " + " ".join(words(re.sub(r"\(\?:([^()|]*)\)\?", r"\1", text))) + " "
        for _, _, keyword, x, _ in compiled:
            for m in x.finditer(whole):
                assert keyword in m[1] and any(g in m[1] for g in GATES), (x.pattern, keyword, m[1])


def water(sizes, ratio=1.5, limit=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, got, open_ = ratio * sum(sizes.values()), {}, set(order)
    while open_:
        level = (total - sum(got.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > limit * sizes[s] + 1e-9}
        if not over:
            got.update({s: level * weight[s] for s in open_})
            break
        got.update({s: limit * sizes[s] for s in over})
        open_ -= over
    return got


def test_mix(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randrange(0, 60)), rnd.choice(["a", "b", "ü", "z", None, "hot", "hot", "hot"])) for i in range(1200)]
    rows += [(5000, None, "a"), (5001, "x y", "tiny"), (7, rows[7][1], rows[7][2]), (None, "q r s", "a"), (5002, "", "void")]
    docs = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, size int, number int")
    got = mix_report(docs).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0 for r in got)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = water(sizes)
    named = spark.createDataFrame([(i, s) for i, _, s in rows], "doc_id long, source string").distinct()
    by = {r.source: r for r in mix_report(docs).join(named, "doc_id", "left").where("doc_id is not null").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size")).collect()}
    for s, r in by.items():
        assert abs(r.target - want[s]) < 1e-6 and r.size == sizes[s]
        if s not in ("tiny", "void"):
            assert abs(r.taken - r.target) <= 60
    again = mix_report(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id or -1, r.size, r.taken, r.shards)
    assert sorted(map(key, got)) == sorted(map(key, again))
    out = mixed_documents(docs, place=False)
    clash = docs.withColumnRenamed("size", "mix_shard").withColumnRenamed("number", "uses")
    assert mixed_documents(clash, place=False).columns == clash.columns
    assert out.columns == docs.columns and out.count() == sum(len([x for x in r.shards.split(",") if x]) for r in got)
    assert mix_report(docs.limit(0)).count() == 0 and mixed_documents(docs.limit(0)).count() == 0


def test_mix_meets_targets_beside_long_documents(spark):
    """Sources of 600 short documents and one with a fifth of the words: every target within 0.5%."""
    docs = spark.sql("""select s * 1000 + i as doc_id, concat('s', lpad(s, 2, '0')) as source,
        repeat('w ', if(i = 600, 7500 + s, 1 + pmod(xxhash64(s, i), 99))) as text
        from (select explode(sequence(0, 23)) as s) cross join (select explode(sequence(0, 600)) as i)""")
    got = mix_report(docs).groupBy(F.floor(F.col("doc_id") / 1000)).agg({"taken": "sum", "target": "max", "source_size": "max", "size": "max"}).collect()
    assert len(got) == 24
    for r in got:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 0.005 * r["max(target)"], r
    # one long document holds nearly all: it cannot be taken, all others are
    few = spark.createDataFrame([(i, "a", "w " * (900 if i == 9 else 5)) for i in range(10)] + [(10 + i, "b", "w " * 50) for i in range(40)],
                                "doc_id long, source string, text string")
    assert all(0 <= r.taken <= 2 * r.size for r in mix_report(few).collect())
    with pytest.raises(ValueError):
        mixed_documents(few.withColumnRenamed("source", "mix_order").selectExpr("*", "'a' as source"))


def test_mix_shards_are_disjoint_and_even(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a b c", f"s{i % 4}") for i in range(2000)], "doc_id long, text string, source string")
    out = mixed_documents(docs, shards=5)
    n = [r["count"] for r in out.groupBy("mix_shard").count().collect()]
    assert len(n) == 5 and max(n) < 1.5 * min(n)
    write_shards(out, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == out.count()


def test_hypergeometric_quantiles(spark):
    cases = [(20, 7, 9), (5, 5, 3), (5, 0, 3), (1000, 300, 500), (1, 1, 1), (4, 2, 0)]
    for n, k, m in cases:
        u = spark.range(200).select(((F.col("id") + 0.5) / 200).alias("u"))
        got = [r.x for r in u.select(hypergeometric(F.lit(n), F.lit(k), F.lit(m), F.col("u")).alias("x"), "u").orderBy("u").collect()]
        p = {x: math.comb(k, x) * math.comb(n - k, m - x) / math.comb(n, m) for x in range(max(0, m - n + k), min(k, m) + 1)}
        cum = np.cumsum(list(p.values()))
        want = [list(p)[int(np.searchsorted(cum, (i + 0.5) / 200, side="right"))] for i in range(200)]
        assert sum(a != b for a, b in zip(got, want)) <= 2 and got == sorted(got)


def test_splitting_tree_keeps_margins(spark):
    q = {0: 13, 1: 0, 2: 200, 3: 1}
    rows = split_tree(spark.createDataFrame(list(q.items()), "number int, blocks long"), 6).collect()
    assert {n: sum(r.blocks for r in rows if r.number == n) for n in q} == q
    sums = [sum(r.blocks for r in rows if r.shard == j) for j in range(6)]
    assert sum(sums) == 214 and max(sums) - min(sums) <= 1 and all(r.blocks >= 0 for r in rows)


def check_shards(rows, texts, shards):
    n = Counter(r.shard for r in rows)
    assert set(n) <= set(range(shards)) and max(n.values()) - (min(n.values()) if len(n) == shards else 0) <= 1
    for j in n:
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(n[j]))
    where = defaultdict(set)
    for r in rows:
        where[texts.get(r.doc_id)].add(r.shard)
    return where


def test_shards(spark):
    rows = [(i, f"single {i}") for i in range(300)] + [(1000 + i, f"pair {i // 2}") for i in range(60)] + [(2000 + i, "hot") for i in range(150)]
    rows += [(3000, None), (3001, None), (3002, ""), (3003, ""), (None, "x")]
    docs = spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "doc_id long, text string, shard int, key int")
    got = shard_documents(docs, 10).collect()
    assert len(got) == len(rows)
    where = check_shards(got, dict(rows), 10)
    assert len(where["hot"]) <= 5                      # 150 rows need three shards of 51 or 52
    assert sum(len(s) > 1 for t, s in where.items() if t and t.startswith("pair")) <= 4
    import zlib
    for r in got:
        t = dict(rows).get(r.doc_id) if r.doc_id is not None else "x"
        b = (t or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 8, zlib.crc32(b), "rows", None)
    key = lambda r: (r.doc_id or -1, r.shard)
    assert sorted(map(key, got)) == sorted(map(key, shard_documents(docs.repartition(5), 10).collect()))
    assert shard_documents(docs.limit(0)).count() == 0


def test_shards_when_every_row_is_linked(spark):
    rows = [(i, f"t{i % 7}") for i in range(100)] + [(i, f"t{i % 7}") for i in range(100)]
    got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    n = Counter(r.shard for r in got)
    assert len(got) == 200 and set(n.values()) == {25}


def test_propagation_gathers_groups(spark):
    start = spark.createDataFrame([(k, s, 1) for k in range(30) for s in (k % 4, (k + 1) % 4)], "key long, shard int, c long")
    end = propagate(start, [100] * 4).collect()
    assert len(end) == 30 and all(r.c == 2 for r in end)
    tight = propagate(start, [15] * 4).collect()
    load = Counter()
    for r in tight:
        load[r.shard] += r.c
    assert sum(load.values()) == 60 and max(load.values()) <= 15


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("p"), F.xxhash64("id").alias("h"), "id")
    for p in range(3):
        rows = [r for r in positions(df, ["p"], "h", ["id"], 50).collect() if r.p == p]
        assert [r.h for r in sorted(rows, key=lambda r: r.pos)] == sorted(r.h for r in rows)
        assert sorted(r.pos for r in rows) == list(range(len(rows)))


def test_pipeline_against_its_stages(spark, tmp_path):
    """run() gives what the stages give one by one; each stage keeps the columns and its decisions hold."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.schema == first.schema
        kept[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert set(kept["near_duplicates"]) <= set(kept["quality"]) and set(kept["decontamination"]) <= set(kept["near_duplicates"])
    assert max(kept["mixing"].values()) <= 2
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, SF).collect())
    assert got == kept["mixing"]


def test_hard_pages_take_time_and_room_in_proportion():
    import time
    from quarry.llm.html_text import render
    words = "word " * 60_000
    pages = {
        "wide": f"<table><tr><td>{words}</td><td>x</td></tr>" + "<tr><td>a</td><td>b</td></tr>" * 20_000 + "</table>",
        "tall": "<table><tr>" + "<td>a" * 20_000 + "<td>" + "a<br>" * 20_000 + "</table>",
        "columns": "<table><tr>" + ("<td>" + "a" * 40) * 2_000 + "<tr>" + "<td>a" * 100_000 + "</table>",
        "open": "<div>" * 10_000 + "<p>a" * 10_000,
        "buttons": "<p><button>" + "<div>" * 10_000 + "<p>a</p></b>" * 10_000,
        "lists": "<ul><li>" * 10_000 + "<li>a" * 10_000,
        "quotes": "<blockquote>a" * 10_000,
        "tables": "<table><tr><td>a" * 8_000,
        "inline": "<b>a</b>" * 100_000,
    }
    for name, page in pages.items():
        start = time.time()
        text = render(page)
        assert time.time() - start < 15 and len(text) < 10 * len(page) + 80 * page.count("<blockquote"), name
        shown = re.sub(r"<[^>]*>", "", page)
        assert all(text.count(c) == shown.count(c) for c in "aword"), name       # no letter is lost or doubled
    assert render(pages["wide"]).startswith(words.strip() + "  x\na") and render(pages["wide"]).endswith("b")


def test_long_cells_do_not_widen_their_column():
    from quarry.llm.html_text import COLUMN_WIDTH, render
    long = "x" * (COLUMN_WIDTH + 1)
    assert render(f"<table><tr><td>{long}<td>1<tr><td>ab<td>2<tr><td>c<td>3</table>") == f"{long}  1\nab  2\nc   3"
    fits = "y" * COLUMN_WIDTH
    assert render(f"<table><tr><td>{fits}<td>1<tr><td>ab<td>2</table>") == f"{fits}  1\nab{' ' * (COLUMN_WIDTH - 2)}  2"


def test_license_fold_and_dense_texts(spark):
    from quarry.llm import licenses as m
    rnd = random.Random(4)
    rows = [[rnd.randrange(10 ** 6) for _ in range(n)] for n in (0, 1, 2, m.STRETCH - 1, m.STRETCH, m.STRETCH + 1, 3 * m.STRETCH + 5)]
    df = spark.createDataFrame([(r,) for r in rows], "v array<bigint>")
    for r in df.select("v", m._before(F.col("v"), F.greatest).alias("most"), m._before(F.col("v"), lambda a, b: a + b).alias("total")).collect():
        assert r.most == [max(r.v[:i], default=0) for i in range(len(r.v))] and r.total == [sum(r.v[:i]) for i in range(len(r.v))]
    dense = spark.createDataFrame([(1, "see the mit license or not at " * 1500)], "doc_id long, text string")
    found = scan(dense).select("license_scan.findings").first()[0]
    assert len(found) == 1500 and [f.start for f in found] == sorted({f.start for f in found}) and {f.label for f in found} == {"mit"}
