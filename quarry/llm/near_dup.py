"""MinHash near-duplicate detection with odd sketches.

1. Every text becomes its set of distinct word shingles (64-bit hashes). Texts
   with equal sets form one class; only one representative of each class (its
   smallest id) goes on, so exact copies never meet each other.
2. Banded MinHash: ``rows`` minima a band, and so many bands that a pair at the
   threshold shares no band with probability below ``MISS``.
3. Odd sketch: one-permutation MinHash samples (the smallest hash of each of
   ``BINS`` bins) are folded into a parity bitmap of ``BITS`` bits. The
   population count of the XOR of two bitmaps tells how many samples differ;
   pairs whose count is beyond what a pair at the threshold can show (mean plus
   ``SIGMAS`` standard deviations) are not verified.
4. Verification on the full shingle sets, exact integer arithmetic.

The rows of a round stay linear in the members of the buckets, whatever a group's size:

* Round one compares each member of a bucket with the bucket's smallest id only.
* Buckets that then still hold more than ``BLOCK`` members outside their largest
  component get up to ``TURNS`` more such stars, each from another drawn member.
* In what is still apart, the largest component of a bucket is dealt to parts of
  ``BLOCK`` members and the members outside it, ``BLOCK`` at most, go to every
  part: less than two rows a member. A part first yields a spanning forest of the
  pairs that the sketches allow, then every such pair that is still between two
  components, produced by its first common band only.
* Buckets with more members outside the largest component after that are dealt
  anew by more minima a band (``LEVELS``; the number of bands follows from the same ``MISS``),
  so only texts that agree on more minima meet, and handled alike. Only on the
  last level such members go to every part all the same, so that no pair is lost.

So no link is lost, no bucket goes whole into one task, and members that are
already connected are not paired again.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, U64, map_groups, mix64, release, rows_with_ids, saver, shingle_hashes, slices, to_workers, word_hashes
from quarry.llm.graph import components
from quarry.session import cut_lineage, scratch

BINS = 8192
BITS = 4096
SIGMAS = 4.5
MISS = 1e-6
#: Members of a bucket that meet in one group.
BLOCK = 1024
#: Further stars in crowded buckets, each from another member.
TURNS = 2
#: Minima a band has more at each level.
LEVELS = (0, 4, 8)


def bands_for(percent: int, rows: int) -> int:
    """Bands of ``rows`` minima so that a pair of ``percent`` similarity shares none with probability below MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))


def band_plan(percent: int) -> tuple[int, int]:
    """(bands, rows) of the first level."""
    rows = 5 if percent >= 83 else 4 if percent >= 75 else 3 if percent >= 60 else 2
    return bands_for(percent, rows), rows


def signature(shingles: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, bytes]:
    """Band keys (the band number is part of the key) and the odd sketch of a sorted distinct set."""
    k = bands * rows
    c = mix64(np.arange(1, k + 1, dtype=U64))
    mul, xor = (c >> U64(32)).astype(np.uint32) | np.uint32(1), c.astype(np.uint32)
    x = (shingles >> U64(32)).astype(np.uint32)
    low = np.full(k, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 4096):
            low = np.minimum(low, ((x[None, at:at + 4096] ^ xor[:, None]) * mul[:, None]).min(axis=1))
        acc = np.arange(bands, dtype=U64)
        for r in range(rows):
            acc = mix64(acc * U64(0x9E3779B97F4A7C15) + low[r::rows].astype(U64) + U64(r + 1))
    y = np.sort(mix64(shingles))
    b = y >> U64(64 - int(math.log2(BINS)))
    sample = y[np.concatenate([[True], b[1:] != b[:-1]])]
    odd = np.bincount((mix64(sample) & U64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return acc.view(np.int64), np.packbits(odd.astype(np.uint8)).tobytes()


def xor_limit(n_a, n_b, percent: int):
    """Largest XOR population count of the sketches of two sets of these sizes at the threshold.

    An element of the symmetric difference changes the sample of its own bin
    only: one sample, or two where the other set has one there. So the samples
    differ by no more than the difference of the sets plus those extra ones; for
    sets much larger than ``BINS`` the mean over bins is the smaller bound.
    Parity can only hide differences.
    """
    j = percent / 100
    union = (n_a + n_b) / (1 + j)
    apart = (1 - j) * union                                     # most elements that a linked pair differs by
    both = -np.expm1(-np.minimum(n_a, n_b) / BINS)              # the other set has a sample in the bin, too
    small = apart * (1 + both) + SIGMAS * np.sqrt(apart * both * (1 - both))
    used = BINS * -np.expm1(-union / BINS)                      # bins that hold a hash of the union
    large = (1 + both) * ((1 - j) * used + SIGMAS * np.sqrt(used * j * (1 - j)))
    worst = np.minimum(small, large) + 1
    odd = BITS / 2 * -np.expm1(-2 * worst / BITS)
    return np.minimum(worst, odd + SIGMAS * np.sqrt(2) * worst / np.sqrt(BITS) + 1)


def _sketch_rows(words: int, bands: int, rows: int):
    import xxhash

    def run(batches):
        for big in batches:
            for pdf in slices(big, "text"):
                w, off = word_hashes(pdf["text"], SPACE)
                out = []
                for i, sh in zip(pdf["id"], shingle_hashes(w, off, words)):
                    u = np.unique(sh)
                    keys, odd = signature(u, bands, rows) if len(u) else (None, None)
                    out.append((i, len(u), xxhash.xxh3_128_digest(u.tobytes()) if len(u) else None, keys, odd))
                yield pd.DataFrame(out, columns=["id", "n", "set", "bands", "odd"])
    return run


def _set_rows(words: int):
    def run(batches):
        for big in batches:
            for pdf in slices(big, "text"):
                w, off = word_hashes(pdf["text"], SPACE)
                yield pd.DataFrame({"id": pdf["id"].to_numpy(),
                                    "s": [np.unique(x).tobytes() for x in shingle_hashes(w, off, words)]})
    return run


def _passing(percent: int):
    """Pairs whose odd sketches allow the threshold."""
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.frombuffer(b"".join(pdf["odd_a"]), U64) ^ np.frombuffer(b"".join(pdf["odd_b"]), U64)
            diff = np.bitwise_count(x.reshape(len(pdf), -1)).sum(axis=1)
            na, nb = pdf["n_a"].to_numpy(float), pdf["n_b"].to_numpy(float)
            ok = (diff <= xor_limit(na, nb, percent)) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            yield pdf.loc[ok, ["a", "b"]]
    return run


def _linked(percent: int):
    """Pairs whose full sets reach the threshold."""
    def run(batches):
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["s_a"], pdf["s_b"]):
                p, q = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
            yield pdf.loc[np.array(keep, bool), ["a", "b"]]
    return run


def _cross_forest(percent: int):
    """A spanning forest of the pairs that the sketches allow, most similar first, components counting as connected.

    Prim's method over one part of a bucket: fewer pairs than rows.
    """
    def run(g: pd.DataFrame):
        ids, n = g["id"].to_numpy(), g["n"].to_numpy(float)
        _, comp = np.unique(g["comp"].to_numpy(), return_inverse=True)
        if comp.max() == 0:
            return None
        odd = np.frombuffer(b"".join(g["odd"]), U64).reshape(len(g), -1)
        near = np.full(len(g), np.inf)                  # smallest allowed count to the tree, and to whom
        to = np.zeros(len(g), int)
        left = np.ones(len(g), bool)
        found = []
        while left.any():
            i = int(np.argmin(np.where(left, near, np.inf)))
            if not left[i] or not np.isfinite(near[i]):
                i = int(np.flatnonzero(left)[0])        # a new tree
            elif near[i] >= 0:
                found.append((ids[i], ids[to[i]]))
            left[i] = False
            j = np.flatnonzero(left)
            if not len(j):
                break
            z = np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1).astype(float)
            ok = (z <= xor_limit(n[i], n[j], percent)) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            z = np.where(comp[j] == comp[i], -1.0, np.where(ok, z, np.inf))
            closer = z < near[j]
            near[j[closer]], to[j[closer]] = z[closer], i
        if not found:
            return None
        p = np.sort(np.array(found, dtype=np.int64), axis=1)
        return pd.DataFrame({"a": p[:, 0], "b": p[:, 1]})
    return run


def _cross_pairs(percent: int):
    """All pairs of different components in one part of a bucket that the sketches allow, by their first common band."""
    def run(g: pd.DataFrame):
        key = g["key"].iat[0]
        ids, comp = g["id"].to_numpy(), g["comp"].to_numpy()
        n = g["n"].to_numpy(float)
        keys = np.vstack(g["bands"].to_numpy())
        odd = np.frombuffer(b"".join(g["odd"]), U64).reshape(len(g), -1)
        found = []
        for i in range(len(g) - 1):
            j = np.flatnonzero(comp[i + 1:] != comp[i]) + i + 1
            j = j[100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])]
            if not len(j):
                continue
            j = j[np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1) <= xor_limit(n[i], n[j], percent)]
            if len(j):                                # the first band in which both agree is this one
                j = j[keys[i][np.argmax(keys[i] == keys[j], axis=1)] == key]
                found.append(np.column_stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])]))
        if not found:
            return None
        p = np.vstack(found)
        return pd.DataFrame({"a": p[:, 0], "b": p[:, 1]})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(<id_col>, n_shingles, component_id, kept)`` for every row of ``docs``.

    Words are maximal runs of characters other than ASCII white space, A-Z
    lower-cased. Texts are linked when ``100 * |A & B| >= percent * |A | B|`` of
    their distinct ``words``-word shingles (fewer words: the whole sequence is
    the one shingle). component_id is the smallest id reachable over links.

    Defined cases: a null or blank text has no shingles, is linked with nothing
    and is its own component; a null id gives component null and kept true;
    repeated rows get equal results; other columns are never read, whatever
    their names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    to_workers(spark)
    with scratch(spark, "near") as folder:
        return _near_duplicates(docs, id_col, text_col, words, percent, saver(spark, folder))


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, save: Callable) -> DataFrame:
    spark = docs.sparkSession
    bands, rows = band_plan(percent)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketched = "id long, n long, set binary, bands array<long>, odd binary"
    sig = cut_lineage(base.mapInPandas(_sketch_rows(words, bands, rows), sketched))
    narrow = cut_lineage(sig.select("id", "n", "set"))
    classes = cut_lineage(sig.where("n > 0 and id is not null").groupBy("set").agg(F.min("id").alias("rep")))
    reps = cut_lineage(sig.join(classes, (sig["set"] == classes["set"]) & (sig["id"] == classes["rep"]))
                       .select("id", "n", "bands", "odd").dropDuplicates(["id"]))
    del sig
    release(spark)

    def members(of: DataFrame) -> DataFrame:
        """(id, key, pivot, size) of the members of buckets of two or more; the pivot is the smallest id."""
        bucket = of.select("id", F.explode("bands").alias("key"))
        shared = bucket.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("most"), F.count("*").alias("size"))
        shared = cut_lineage(shared.where("pivot < most").drop("most"))
        return cut_lineage(bucket.join(shared, "key"))

    def links(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
        sets = cut_lineage(rows_with_ids(base, "id", ids).mapInPandas(_set_rows(words), "id long, s binary")
                           .dropDuplicates(["id"]))
        return (pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("s_a")), "a")
                .join(sets.select(F.col("id").alias("b"), F.col("s").alias("s_b")), "b")
                .select("a", "b", "s_a", "s_b").mapInPandas(_linked(percent), "a long, b long"))

    def sketch(x: str) -> DataFrame:
        return reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("odd").alias(f"odd_{x}"))

    def allowed(pairs: DataFrame) -> DataFrame:
        return cut_lineage(pairs.distinct().join(sketch("b"), "b").join(sketch("a"), "a")
                           .mapInPandas(_passing(percent), "a long, b long"))

    found = spark.createDataFrame([], "a long, b long")
    comp = spark.createDataFrame([], "id long, component long")

    def connect(pairs: DataFrame) -> bool:
        """Verifies ``pairs``, adds their links to ``found`` and joins the components; False if there are none."""
        nonlocal found, comp
        if not pairs.limit(1).count():
            return False
        found = save(found.union(links(pairs)))
        release(spark)
        comp = save(components(found))
        release(spark)
        return True

    def apart(member: DataFrame) -> tuple[DataFrame, Column]:
        """Members of the buckets that still hold more than one component, and which buckets are crowded.

        A bucket that is whole stays whole, so each call looks at what the last
        one returned. ``comp`` is a member's component, ``main`` the largest one of its bucket
        with ``most`` members. A bucket is crowded if it has more than ``BLOCK``
        members outside that one.
        """
        now = member.where("size > 2").select("id", "key", "size").join(comp, "id", "left")
        now = cut_lineage(now.select("id", "key", "size", F.coalesce("component", "id").alias("comp")))
        main = (now.groupBy("key", "comp").count()
                .groupBy("key").agg(F.max_by("comp", "count").alias("main"), F.max("count").alias("most"), F.count("*").alias("comps")))
        seen = cut_lineage(now.join(cut_lineage(main.where("comps > 1").drop("comps")), "key"))
        return seen, (F.col("size") - F.col("most") > BLOCK)

    def settle(member: DataFrame, level: int) -> None:
        """Finds all links between members of one bucket that are not connected yet."""
        # stars: each member of a crowded bucket against one drawn member of another component, a row each
        seen, crowd = apart(member)
        calm, crowded = seen.where(~crowd), seen.where(crowd)
        for turn in range(TURNS):
            if not crowded.limit(1).count():
                break
            drawn = crowded.groupBy("key").agg(F.min_by(F.struct(F.col("id").alias("p"), F.col("comp").alias("c")),
                                                        F.xxhash64("id", F.lit(turn))).alias("d"))
            star = crowded.join(cut_lineage(drawn), "key").where("comp <> d.c")
            connect(allowed(star.select(F.least("id", "d.p").alias("a"), F.greatest("id", "d.p").alias("b"))))
            seen, crowd = apart(crowded)
            calm, crowded = calm.unionByName(seen.where(~crowd)), seen.where(crowd)
        last = level + 1 == len(LEVELS)
        few = calm.unionByName(crowded) if last else calm
        deep = None if last else cut_lineage(crowded.select("id").distinct())
        # parts: the largest component of a bucket is dealt out, the members outside it meet every part
        for pick in (_cross_forest, _cross_pairs):
            few = few.withColumn("parts", F.when(F.col("size") <= BLOCK, F.lit(1).cast("long")).otherwise(F.ceil(F.col("most") / BLOCK)))
            inside = F.array(F.pmod(F.xxhash64("id"), F.col("parts")))
            part = F.when(F.col("comp") == F.col("main"), inside).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
            dealt = few.select("id", "key", "comp", F.explode(part).alias("part")).join(reps, "id")
            pairs = cut_lineage(map_groups(dealt, ["key", "part"], ["id"], pick(percent), "a long, b long").distinct())
            release(spark)
            if connect(pairs) and pick is _cross_forest:
                few, _ = apart(few)
        # crowds outside the largest component: their buckets once more, by more minima
        if deep is not None and deep.limit(1).count():
            more = rows + LEVELS[level + 1]
            sub = rows_with_ids(base, "id", deep).mapInPandas(_sketch_rows(words, bands_for(percent, more), more), sketched)
            settle(members(cut_lineage(sub.dropDuplicates(["id"]))), level + 1)

    # round one: each member against the smallest id of its buckets
    member = members(reps)
    release(spark)
    connect(allowed(member.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))))
    settle(member, 0)

    of = cut_lineage(classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
                     .select("set", F.coalesce("component", "rep").alias("component_id")))
    out = narrow.join(of, "set", "left")
    comp_id = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), comp_id.alias("component_id"),
                      F.coalesce(F.col("id") == comp_id, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near duplicates, all columns unchanged.

    The smallest id of a group stays; rows that repeat an id with the same text
    leave one. Rows without an id or without words stay.
    """
    found = cut_lineage(near_duplicates(docs, id_col, text_col, words, percent))
    gone = found.where("not kept").select(id_col)
    left = rows_with_ids(docs, id_col, gone, "left_anti")
    twice = cut_lineage(found.where(F.col("kept") & F.col(id_col).isNotNull()).groupBy(id_col).count()
                        .where("count > 1").select(id_col))
    if not twice.limit(1).count():
        return left
    again = rows_with_ids(left, id_col, twice).dropDuplicates([id_col, text_col])
    return rows_with_ids(left, id_col, twice, "left_anti").unionByName(again)
