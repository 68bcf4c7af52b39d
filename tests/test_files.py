"""File inventory and completeness."""

import os

from quarry.sources import files


def test_inventory_and_missing_of_a_folder(spark, tmp_path):
    for name, size in (("a/x.parquet", 10), ("a/y.PARQUET", 2000), ("a/readme", 5), ("b/manifest.json", 3)):
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(b"0" * size)
    ls = files.listing(spark, str(tmp_path))
    inv = {os.path.basename(r.dir): r for r in files.file_inventory(ls).collect()}
    assert (inv["a"].total_size_bytes, inv["a"].file_count, inv["a"].total_size) == (2015, 3, "1.97 KB")
    assert inv["a"].extensions == {".parquet": "1.96 KB"} and inv["b"].extensions == {".json": "3.00 B"}
    done = {os.path.basename(r.dir): (r.missing, r.complete) for r in files.check_complete(ls, ["x.parquet"], [r"\.parquet$"]).collect()}
    assert done == {"a": ([], True), "b": (["x.parquet"], False)}
