"""Hash trees of a log against plain hashing, proofs, and alterations."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from quarry.operators.merkle import GENESIS, altered, inclusion_proofs, leaves, seal, tree, verify_proofs

SCHEMA = "rid string, at long, note string, done timestamp, date date"
DAY = dt.date(2024, 1, 1)


def log_rows():
    """Days of 1, 2, 16, 17 and 300 records (one level up to three), and records without a day."""
    sizes = [(DAY, 1), (DAY + dt.timedelta(1), 2), (DAY + dt.timedelta(2), 16), (DAY + dt.timedelta(3), 17), (DAY + dt.timedelta(4), 300), (None, 3)]
    return [(f"r{d}-{i}", 1000 - i % 7, None if i % 5 == 0 else f"n{i}|:", None, d) for d, n in sizes for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_seal(rows):
    out, chain = [], GENESIS
    for day in sorted({r[4] for r in rows}, key=lambda d: (d is not None, d)):
        recs = []
        for r in rows:
            if r[4] == day:
                texts = [r[0], str(r[1]), r[2], None]
                recs.append((r[1], r[0], sha("leaf|" + "".join("-" if t is None else f"{len(t)}:{t}" for t in texts))))
        nodes = [h for _, _, h in sorted(recs)]
        while len(nodes) > 1:
            nodes = [sha("node|" + "|".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        chain = sha("|".join([chain, "-" if day is None else str(day), str(len(recs)), nodes[0]]))
        out.append((day, len(recs), nodes[0], chain))
    return out


def built(spark, rows):
    return tree(leaves(spark.createDataFrame(rows, SCHEMA).repartition(5), "rid", ["at"]))


def test_seal_equals_plain_hashing(spark):
    rows = log_rows()
    assert {tuple(r) for r in seal(built(spark, rows)).collect()} == set(plain_seal(rows))
    assert seal(built(spark, [])).count() == 0
    twice = rows + rows[:3]                                  # repeated records count
    assert {tuple(r) for r in seal(built(spark, twice)).collect()} == set(plain_seal(twice))


def test_proofs_hold_for_the_record_alone(spark):
    rows = log_rows()
    nodes = built(spark, rows)
    sealed = seal(nodes)
    ids = spark.createDataFrame([(r[0],) for r in rows[::9]] + [("unknown",)], "id string")
    proofs = inclusion_proofs(nodes, ids)
    assert proofs.count() == len(rows[::9])
    assert proofs.select(F.max(F.size("path"))).first()[0] == 3
    now = leaves(spark.createDataFrame(rows, SCHEMA), "rid", ["at"]).join(ids, "id", "left_semi")
    assert {r.ok for r in verify_proofs(now, proofs, sealed).collect()} == {True}
    forged = [(a, b, "forged", d, e) for a, b, _, d, e in rows]
    then = leaves(spark.createDataFrame(forged, SCHEMA), "rid", ["at"]).join(ids, "id", "left_semi")
    assert {r.ok for r in verify_proofs(then, proofs, sealed).collect()} == {False}


def test_alterations_are_named(spark):
    rows = log_rows()
    new = [list(r) for r in rows]
    new[30][2] = "other"                                     # changed
    new[40][4] = DAY + dt.timedelta(9)                       # moved to a day of its own
    new[100][4] = None
    gone = new.pop(200)
    new.append(["r-new", 5, None, None, DAY])
    got = {r.id: (r.finding, r.day, r.new_day) for r in altered(built(spark, rows), built(spark, [tuple(r) for r in new])).collect()}
    assert got == {rows[30][0]: ("changed", rows[30][4], rows[30][4]), rows[40][0]: ("moved", rows[40][4], DAY + dt.timedelta(9)),
                   rows[100][0]: ("moved", rows[100][4], None), gone[0]: ("dropped", gone[4], None), "r-new": ("added", None, DAY)}
    same = built(spark, rows)
    assert altered(same, same).count() == 0
