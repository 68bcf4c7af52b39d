"""Interpolated back-off n-gram models (A7 beyond single words).

A model of order ``n`` discounts every count by ``discount`` and gives what that
frees to the next shorter context, down to an even share for unknown words. The
longest n-grams count places; a shorter one counts the different words that stand
before it (continuation counts), so a word seen after one word only does not
profit from its frequency.

For a context ``c`` with total ``T`` and ``K`` different next words::

    p(w | c) = max(count(c w) - D, 0) / T + D * K / T * p(w | c without its first word)

An unseen context takes the shorter one's probability as it is. The empty
context goes on to ``1 / (V + 1)``: ``V`` known words and one place for all unknown ones.

All that is known of a context comes from the grams that begin with it, so grams
are dealt by their context, one length after the other: the tasks of a length add
up its counts, settle its share of the asked grams, and count the next shorter
grams. An asked gram carries the ``a`` and ``b`` of ``p = a + b * p(shorter)`` down
to the single words. Most grams of a corpus are distinct and all are needed, so

* texts are cut into n-grams and counted by the task that reads them, and grams
  travel as compressed Arrow tables of dictionary-coded words, one per task and part;
* grams of more than two words are taken in ``SLICES`` by their last but one word,
  one after the other: a slice holds all that its grams need down to two words,
  and its shuffles go before the next begins.

The empty string, which is no token, stands for the places before a text's start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import TOKEN_SEPARATOR_RUN, TOKEN_SEPARATORS, lower_tokens
from quarry.llm.common import mix64, release
from quarry.session import cut_lineage, ship_package

DISCOUNT = 0.75
STRETCH_BYTES = 1 << 22             # of texts that a task cuts and counts together
STRETCH_ROWS = 1 << 19              # of asked grams that a task packs together
PARTS = 2                           # parts a shuffle partition of the session: each task holds one
SLICES = 3                          # grams of more than two words are taken in slices by their last but one word
GRAMS, ASKED, TOTALS = 0, 1, 2      # kinds of packed tables
PACKED = "kind int, part int, rows binary"


def _names(k: int) -> list[str]:
    """Columns of a gram of ``k`` words, the last word is ``w1``."""
    return [f"w{i}" for i in range(k, 0, -1)]


def _stretches(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], int], most: int) -> Iterator[pa.Table]:
    """The batches put together to tables of about ``most`` by ``size``."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += size(batch)
        if n >= most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _texts(texts: DataFrame, by: list[str], text_col: str) -> DataFrame:
    """``(*by, _t)``: the texts, lower-cased and without separators at their ends."""
    return texts.select(*by, F.btrim(F.lower(text_col), F.lit(TOKEN_SEPARATORS)).alias("_t"))


def _counted(order: int, by: list[str], min_len: int = 1, slices: int = 1, piece: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.Table]]:
    """Tables ``(*by, w<order> .. w1, c)`` of dictionary-coded columns and a count, from ``_texts``.

    Of several ``slices`` (by ``w2``) only the grams of one ``piece`` are counted.
    """
    def run(batches):
        for table in _stretches(batches, lambda b: b.nbytes, STRETCH_BYTES):
            table = table.filter(pc.not_equal(table["_t"], "")).combine_chunks()
            for batch in table.to_batches():
                texts = pc.split_pattern_regex(batch["_t"], TOKEN_SEPARATOR_RUN)
                long = pc.greater_equal(texts.value_lengths(), min_len)
                texts, n = texts.filter(long), texts.value_lengths().filter(long).to_numpy()
                tokens = texts.flatten().dictionary_encode()
                words = pa.concat_arrays([pa.array([""], tokens.dictionary.type), tokens.dictionary])
                code = np.append(tokens.indices.to_numpy() + 1, 0).astype(np.int32)
                place, start = np.arange(n.sum()), np.repeat(np.cumsum(n) - n, n)
                at = {k: code[np.where(place - (k - 1) >= start, place - (k - 1), -1)] for k in range(order, 0, -1)}
                mine = np.ones(len(place), bool)
                if slices > 1:
                    mine = np.fromiter((crc32(w.encode()) % slices == piece for w in words.to_pylist()), bool, len(words))[at[2]]
                row = pa.array(np.repeat(np.arange(len(n)), n)[mine])
                keys = {b: batch[b].filter(long).dictionary_encode() for b in by}
                cols = {b: keys[b].indices.take(row) for b in by} | {f"w{k}": pa.array(x[mine]) for k, x in at.items()}
                got = pa.table(cols).group_by(list(cols), use_threads=False).aggregate([([], "count_all")])
                coded = {x: pa.DictionaryArray.from_arrays(got[x].combine_chunks(), keys[x].dictionary if x in keys else words) for x in cols}
                yield pa.table(coded | {"c": got["count_all"]})
        pa.default_memory_pool().release_unused()
    return run


def gram_counts(texts: DataFrame, order: int, by: list[str], text_col: str = "text", min_len: int = 1) -> DataFrame:
    """``(*by, w<order> .. w1, c)``: counted n-grams of the texts of at least ``min_len`` tokens, one per token.

    A text that is null or has no token has no n-gram. Grams are counted by
    stretches of texts; the rows of a gram that comes in several add up.
    """
    ship_package(texts.sparkSession)
    toks = _texts(texts, by, text_col)
    count = _counted(order, by, min_len)
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in toks.schema if f.name in by]
    return toks.mapInArrow(lambda batches: (b for t in count(batches) for b in _plain(t).to_batches(1 << 16)),
                           ", ".join([*types, *(f"{w} string" for w in _names(order)), "c long"]))


def _plain(table: pa.Table) -> pa.Table:
    """The table without dictionaries."""
    return pa.table({n: c.cast(c.type.value_type) if pa.types.is_dictionary(c.type) else c for n, c in zip(table.column_names, table.columns, strict=True)})


def _keys(k: int) -> list[str]:
    """What the grams of ``k`` words are dealt by: their context, and single words by themselves."""
    return _names(k)[:-1] or ["w1"]


def _taken(col: pa.DictionaryArray, at: np.ndarray) -> pa.DictionaryArray:
    """Rows ``at`` of a coded column, with the words that they use."""
    used = col.indices.take(pa.array(at)).dictionary_encode()
    return pa.DictionaryArray.from_arrays(used.indices, col.dictionary.take(used.dictionary))


def _dealt(kind: int, table: pa.Table, keys: list[str], parts: int) -> Iterator[pa.RecordBatch]:
    """``table``, whose ``keys`` and words are coded, as one packed table (``PACKED``) per part of ``keys``."""
    if not len(table):
        return
    cols = {n: c.combine_chunks() for n, c in zip(table.column_names, table.columns, strict=True)}
    codes = {n: c.indices.fill_null(-1).to_numpy() for n, c in cols.items() if pa.types.is_dictionary(c.type)}
    mixed = np.zeros(len(table), np.uint64)
    for key in keys:
        values = pd.util.hash_array(cols[key].dictionary.to_numpy(zero_copy_only=False), categorize=False)
        mixed = mix64(mixed + np.append(values, np.uint64(0))[codes[key]])
    part = (mixed % np.uint64(parts)).astype(np.int64)
    near = codes[keys[-1]].astype(np.int64)
    order = np.argsort((near << 31) + codes["w1"], kind="stable") if "w1" in codes else np.arange(len(near))       # equal words side by side pack well
    order = order[np.argsort(part[order], kind="stable")]
    found, start = np.unique(part[order], return_index=True)
    for p, at in zip(found, np.split(order, start[1:]), strict=True):
        rows = pa.table({n: _taken(c, at) if n in codes else c.take(pa.array(at)) for n, c in cols.items()})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        yield _row(kind, int(p), sink.getvalue().to_pybytes())


def _row(kind: int, part: int, rows: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([rows], pa.binary())], ["kind", "part", "rows"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    for batch in batches:
        for kind, rows in zip(batch["kind"].to_pylist(), batch["rows"], strict=True):
            yield kind, pa.ipc.open_stream(rows.as_buffer()).read_all()


def _dense(codes: list[np.ndarray]) -> np.ndarray:
    """Numbers from 0 of the distinct rows of ``codes``."""
    out = codes[0]
    for code in codes[1:]:
        rows = pa.array(out * (code.max(initial=0) + 1) + code).dictionary_encode()
        out = rows.indices.to_numpy().astype(np.int64)
    return out


def _first(ids: np.ndarray) -> np.ndarray:
    """Per number of ``_dense`` its first row (-1: none)."""
    out = np.full(ids.max(initial=-1) + 1, -1, np.int64)
    out[ids[::-1]] = np.arange(len(ids))[::-1]
    return out


def _level(k: int, order: int, corpus_col: str, corpora: list | None, discount: float, parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Settles the grams of ``k`` words of a part: in and out are packed tables.

    Asked grams get this length's share into ``_a`` and ``_b`` of each corpus, the
    grams are counted as those of ``k - 1`` words. At single words asked ones get
    their count ``_c``, and the words are summed: ``t`` and ``k`` per corpus.
    """
    names = _names(k)

    def run(batches):
        tables = {GRAMS: [], ASKED: []}
        for kind, table in _unpacked(batches):
            tables[kind].append(table)
        m, q = (sum(map(len, tables[kind])) for kind in (GRAMS, ASKED))
        if not m and not q:
            return

        def merged(kinds, name):
            return pa.chunked_array([c for kind in kinds for t in tables[kind] for c in t[name].chunks]).unify_dictionaries().combine_chunks()

        cols = {n: merged((GRAMS, ASKED), n) for n in names}
        codes = {n: c.indices.fill_null(-1).to_numpy() + 1 for n, c in cols.items()}
        if corpora is None:
            corpus = merged((GRAMS, ASKED), corpus_col)
            known = corpus.indices.fill_null(-1).to_numpy().astype(np.int64) + 1
            sides = [known[m:]]
        else:
            corpus = merged((GRAMS,), corpus_col) if m else pa.array([], pa.string()).dictionary_encode()
            known = corpus.indices.to_numpy().astype(np.int64) + 1
            at = {x: i + 1 for i, x in enumerate(corpus.dictionary.to_pylist())}
            sides = [np.full(q, at.get(x, 0)) for x in corpora]
        # the counted rows, then the asked ones once for each corpus
        every = np.concatenate([np.arange(m), *(np.arange(m, m + q) for _ in sides)])
        context = _dense([np.concatenate([known[:m], *sides]), *(codes[n][every] for n in names[:-1])])
        gram = _dense([context, codes["w1"][every]])
        c = np.concatenate([np.zeros(0), *(t["c"].to_numpy() for t in tables[GRAMS])])
        count = np.bincount(gram[:m], weights=c, minlength=gram.max(initial=-1) + 1)
        of = context[_first(gram)]
        total = np.bincount(of, weights=count, minlength=context.max(initial=-1) + 1)
        words = np.bincount(of[count > 0], minlength=len(total))
        if q:
            asked = pa.concat_tables(tables[ASKED])
            for i, n in enumerate(asked.column_names):
                if pa.types.is_dictionary(asked[n].type):
                    asked = asked.set_column(i, n, cols[n].slice(m) if n in cols else merged((ASKED,), n))
            for j in range(len(sides)):
                mine = slice(m + j * q, m + (j + 1) * q)
                n, x = count[gram[mine]], context[mine]
                if k == 1:
                    asked = asked.append_column(f"_c{j}", pa.array(n.astype(np.int64)))
                    continue
                a, b, seen = asked[f"_a{j}"].to_numpy(), asked[f"_b{j}"].to_numpy(), total[x] > 0
                t = np.where(seen, total[x], 1)
                a = a + b * np.where(seen, np.maximum(n - discount, 0) / t, 0)
                b = b * np.where(seen, discount * words[x] / t, 1)
                for name, new in ((f"_a{j}", a), (f"_b{j}", b)):
                    asked = asked.set_column(asked.column_names.index(name), name, pa.array(new))
            yield from _dealt(ASKED, asked, _keys(max(1, k - 1)), parts)
        if m and k > 1:
            rows = _first(gram[:m])
            rows = rows[rows >= 0]
            shorter = _dense([known[rows], *(codes[n][rows] for n in names[1:])])
            at = pa.array(rows[_first(shorter)])
            table = pa.table({n: col.take(at) for n, col in {corpus_col: corpus, **{n: cols[n] for n in names[1:]}}.items()} | {"c": np.bincount(shorter)})
            yield from _dealt(GRAMS, table, _keys(k - 1), parts)
        elif m:
            found = _first(known[:m])
            found = found[found >= 0]
            sums = pa.table({corpus_col: corpus.take(pa.array(found)), "t": total[context[found]].astype(np.int64), "k": words[context[found]]})
            yield from _dealt(TOTALS, sums, [corpus_col], parts)
        tables.clear()
        pa.default_memory_pool().release_unused()       # a worker stays for later tasks
    return run


@dataclass(frozen=True)
class BackoffModel:
    """Training texts whose grams of up to ``order`` words a model counts, per corpus, when it is asked."""
    texts: DataFrame
    corpus_col: str
    order: int
    parts: int

    @property
    def slices(self) -> int:
        return SLICES if self.order > 2 else 1

    def packed(self, piece: int) -> DataFrame:
        """The counted grams of ``order`` words of a slice, dealt to ``parts`` (``PACKED``)."""
        order, parts, keys = self.order, self.parts, _keys(self.order)
        count = _counted(order, [self.corpus_col], 1, self.slices, piece)
        return self.texts.mapInArrow(lambda batches: (b for t in count(batches) for b in _dealt(GRAMS, t, keys, parts)), PACKED)


def backoff_model(train: DataFrame, corpus_col: str, order: int, text_col: str = "text") -> BackoffModel:
    """The model of all grams of ``order`` words of each corpus.

    Nothing is written here: ``gram_probabilities`` counts all grams and
    contexts, slice by slice and length by length, so each use reads ``train``.
    """
    spark = train.sparkSession
    ship_package(spark)
    texts = _texts(train.where(F.col(corpus_col).isNotNull()), [corpus_col], text_col)
    return BackoffModel(texts, corpus_col, order, PARTS * int(spark.conf.get("spark.sql.shuffle.partitions")))


def gram_probabilities(grams: DataFrame, model: BackoffModel, corpus_col: str, discount: float = DISCOUNT, corpora: list | None = None) -> DataFrame:
    """``grams`` (``corpus_col, w<order> .. w1`` and more columns) with ``p``, the probability of ``w1`` after the others.

    With ``corpora``, ``grams`` have no ``corpus_col``, and each is asked of each of these corpora.
    A corpus that the model lacks has a null probability.
    """
    order, parts = model.order, model.parts
    coded = [*_names(order), *([corpus_col] if corpora is None else [])]
    sides = range(1 if corpora is None else len(corpora))

    def ask(batches):
        for table in _stretches(batches, len, STRETCH_ROWS):
            cols = {n: c.combine_chunks().dictionary_encode() if n in coded else c for n, c in zip(table.column_names, table.columns, strict=True)}
            share = {f"_a{j}": np.zeros(len(table)) for j in sides} | {f"_b{j}": np.ones(len(table)) for j in sides}
            yield from _dealt(ASKED, pa.table(cols | share), _keys(order), parts)

    def settled(k: int, state: DataFrame) -> DataFrame:
        return cut_lineage(state.repartitionById(parts, "part").mapInArrow(_level(k, order, corpus_col, corpora, discount, parts), PACKED))

    state = None
    for piece in range(model.slices):
        mine = F.crc32(F.coalesce("w2", F.lit("")).cast("binary")) % model.slices == piece if model.slices > 1 else F.lit(True)
        part = grams.where(mine).mapInArrow(ask, PACKED).union(model.packed(piece))
        for k in range(order, 1, -1):
            part = settled(k, part)             # written, so that the shuffle and the length before it can go
            release(grams.sparkSession)
        state = part if state is None else state.union(part)
    state = settled(1, state)
    del part
    release(grams.sparkSession)

    def rows(kind: int, schema: str) -> DataFrame:
        names = [x.split("`")[1] for x in schema.split(", ")]
        return (state.where(F.col("kind") == kind)
                .mapInArrow(lambda batches: (b for _, t in _unpacked(batches) for b in _plain(t.select(names)).to_batches(1 << 16)), schema))

    typed = [f"`{f.name}` {f.dataType.simpleString()}" for f in grams.schema]
    corpus = f"`{corpus_col}` {model.texts.schema[corpus_col].dataType.simpleString()}"
    totals = rows(TOTALS, f"{corpus}, `t` bigint, `k` bigint").groupBy(corpus_col).agg(F.sum("t").alias("_t"), F.sum("k").alias("_k"))
    out = rows(ASKED, ", ".join([*typed, *(f"`_{x}{j}` {t}" for j in sides for x, t in (("a", "double"), ("b", "double"), ("c", "bigint")))]))
    side = [F.struct((F.col(corpus_col) if corpora is None else F.lit(corpora[j])).alias("corpus"),
                     *(F.col(f"_{x}{j}").alias(x) for x in "abc")) for j in sides]
    kept = [c for c in grams.columns if c != corpus_col]
    out = out.select(*kept, F.explode(F.array(*side)).alias("_s")).select(*kept, F.col("_s.corpus").alias(corpus_col), *(F.col(f"_s.{x}").alias(f"_s_{x}") for x in "abc"))
    out = out.join(F.broadcast(totals), corpus_col, "left")
    known = F.greatest(F.col("_s_c") - F.lit(discount), F.lit(0.0)) / F.col("_t")
    single = known + F.lit(discount) * F.col("_k") / F.col("_t") / (F.col("_k") + 1)
    return out.select(*(grams.columns if corpora is None else [corpus_col, *kept]), (F.col("_s_a") + F.col("_s_b") * single).alias("p"))


def backoff_losses(train: DataFrame, test: DataFrame, corpus_col: str, datasets: list[str], order: int = 3,
                   text_col: str = "text", discount: float = DISCOUNT, min_len: int = 2) -> DataFrame:
    """A7 of order ``order``, summed per training corpus: ``dataset, padded_len, loss, tokens, samples, batches``.

    The shape of ``ngram_losses``: texts under ``min_len`` tokens are samples
    that are not scored; a corpus without training rows, and a test without
    scored tokens, have a null loss.
    """
    model = backoff_model(train.where(F.col(corpus_col).isin(list(datasets))), corpus_col, order, text_col)
    size = F.size(lower_tokens(text_col))
    row = test.select(size.alias("_n")).agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(F.col("_n") >= min_len).alias("batches"),
        F.coalesce(F.sum(F.when(F.col("_n") >= min_len, F.col("_n"))), F.lit(0)).alias("tokens"))
    corpora = F.array(*[F.lit(d) for d in datasets])
    asked = gram_counts(test, order, [], text_col, min_len).withColumnRenamed("c", "n")
    p = gram_probabilities(asked, model, corpus_col, discount, list(datasets))
    total = cut_lineage(p.groupBy(corpus_col).agg(F.sum(-F.log("p") * F.col("n")).alias("_s")))
    del p
    release(train.sparkSession)
    grid = row.select("*", F.explode(corpora).alias(corpus_col)).join(total, corpus_col, "left")
    loss = F.when(F.col("tokens") > 0, F.col("_s") / F.col("tokens"))
    return grid.select(F.col(corpus_col).alias("dataset"), F.lit(min_len).alias("padded_len"), loss.alias("loss"), "tokens", "samples", "batches")
