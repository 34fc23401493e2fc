"""File inventory and manifest reconciliation on a small folder tree."""

import os

from daybook.operators.manifest import file_inventory, manifest_reconcile
from daybook.session import scratch_path
from tests_helpers import local_dir


def _tree(root, files):
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)


def test_inventory_and_reconcile(spark):
    src, dst = scratch_path(spark, "t-src"), scratch_path(spark, "t-dst")
    _tree(local_dir(src), {"a.txt": b"abc", "d/b.txt": b"12345", "d/e/c.txt": b"", "d/gone.txt": b"x"})
    _tree(local_dir(dst), {"a.txt": b"abc", "d/b.txt": b"1234", "d/e/c.txt": b"", "new.txt": b"n"})
    full = file_inventory(spark, src, include_empty=False)
    assert [r.relative_path for r in full.collect()] == ["a.txt", "d/b.txt", "d/gone.txt"]
    inv = file_inventory(spark, src)
    assert [(r.relative_path, r.size) for r in inv.collect()] == [
        ("a.txt", 3), ("d/b.txt", 5), ("d/e/c.txt", 0), ("d/gone.txt", 1)
    ]
    rec = {r.relative_path: r.status for r in manifest_reconcile(inv, file_inventory(spark, dst)).collect()}
    assert rec == {"a.txt": "ok", "d/b.txt": "size_mismatch", "d/e/c.txt": "ok", "d/gone.txt": "missing", "new.txt": "extra"}
    only_txt = file_inventory(spark, src, glob="b.*")
    assert [r.relative_path for r in only_txt.collect()] == ["d/b.txt"]


def test_reconcile_with_mtime(spark):
    src, dst = scratch_path(spark, "t-src"), scratch_path(spark, "t-dst")
    _tree(local_dir(src), {"a.txt": b"abc", "b.txt": b"xyz"})
    _tree(local_dir(dst), {"a.txt": b"abc", "b.txt": b"xyz"})
    os.utime(os.path.join(local_dir(src), "a.txt"), (1_600_000_000, 1_600_000_000))
    os.utime(os.path.join(local_dir(dst), "a.txt"), (1_600_000_000, 1_600_000_000))
    os.utime(os.path.join(local_dir(dst), "b.txt"), (1_600_000_100, 1_600_000_100))
    os.utime(os.path.join(local_dir(src), "b.txt"), (1_600_000_000, 1_600_000_000))
    rec = manifest_reconcile(file_inventory(spark, src), file_inventory(spark, dst), check_mtime=True)
    assert {r.relative_path: r.status for r in rec.collect()} == {"a.txt": "ok", "b.txt": "mtime_mismatch"}
    plain = manifest_reconcile(file_inventory(spark, src), file_inventory(spark, dst))
    assert {r.relative_path: r.status for r in plain.collect()} == {"a.txt": "ok", "b.txt": "ok"}
