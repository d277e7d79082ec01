"""Object listing, manifests and the distributed copy."""

import io
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recount.operators import objects
from recount.operators.objects import (
    copy_objects, copy_summary, ensure_target, list_objects, read_manifest, reconcile_objects, write_objects,
)


def _make_bucket(root):
    files = {
        "OrderHistory/a.jpg": b"alpha" * 100,
        "OrderHistory/b.png": b"",
        "OrderHistory/nested/c.gif": os.urandom(3 * 1024 * 1024 + 7),
        "OrderHistory/d.txt": b"delta",
        "Other/e.jpg": b"not under the prefix",
    }
    for k, v in files.items():
        p = os.path.join(root, k)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(v)
    return files


def test_copy_and_reconcile(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    files = _make_bucket(src)
    ensure_target(dst)
    ensure_target(dst)  # an existing container is fine
    listing = list_objects(spark, src, "OrderHistory")
    keys = sorted(r.key for r in listing.collect())
    assert keys == sorted(k for k in files if k.startswith("OrderHistory/"))
    out = copy_objects(listing, src, dst, num_tasks=3).collect()
    assert {r.key for r in out} == set(keys) and {r.status for r in out} == {"ok"}
    for r in out:
        assert r.bytes == len(files[r.key])
    a = {(r.key, r.length, r.sha256) for r in read_manifest(spark, src, "OrderHistory").collect()}
    b = {(r.key, r.length, r.sha256) for r in read_manifest(spark, dst, "OrderHistory").collect()}
    assert a == b and len(a) == 4


def test_one_bad_object_does_not_stop_the_rest(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    _make_bucket(src)
    ensure_target(dst)
    # a directory where a file must be written makes that one key unwritable
    os.makedirs(os.path.join(dst, "OrderHistory", "d.txt"))
    listing = list_objects(spark, src, "OrderHistory")
    out = spark.createDataFrame(copy_objects(listing, src, dst, num_tasks=2).collect())  # copies once
    rows = {r.key: r for r in out.collect()}
    assert rows["OrderHistory/d.txt"].status == "error" and rows["OrderHistory/d.txt"].error
    assert all(r.status == "ok" for k, r in rows.items() if k != "OrderHistory/d.txt")
    summary = {r.status: r.objects for r in copy_summary(out).collect()}
    assert summary == {"ok": 3, "error": 1}
    # a rerun after fixing the target copies the missing one (copies are idempotent)
    os.rmdir(os.path.join(dst, "OrderHistory", "d.txt"))
    again = {r.key: r.status for r in copy_objects(listing, src, dst).collect()}
    assert set(again.values()) == {"ok"}


def test_missing_source_object_is_an_error_row(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    _make_bucket(src)
    manifest = spark.createDataFrame([("OrderHistory/a.jpg",), ("OrderHistory/gone.jpg",), ("OrderHistory/",)], "key string")
    rows = {r.key: r.status for r in copy_objects(manifest, src, dst).collect()}
    assert rows == {"OrderHistory/a.jpg": "ok", "OrderHistory/gone.jpg": "error"}  # folder marker skipped


def test_pending_objects_resume(spark, tmp_path):
    from recount.operators.objects import pending_objects

    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    _make_bucket(src)
    ensure_target(dst)
    listing = list_objects(spark, src, "OrderHistory")
    first = copy_objects(listing.filter("key LIKE '%a.jpg'"), src, dst).collect()
    assert [r.status for r in first] == ["ok"]
    todo = pending_objects(listing, list_objects(spark, dst))
    assert sorted(r.key for r in todo.collect()) == ["OrderHistory/b.png", "OrderHistory/d.txt",
                                                     "OrderHistory/nested/c.gif"]


def test_prefix_is_a_string(spark, tmp_path):
    src = str(tmp_path / "src")
    _make_bucket(src)
    os.makedirs(os.path.join(src, "OrderHistory2"))
    open(os.path.join(src, "OrderHistory2", "f.jpg"), "wb").close()
    os.symlink(os.path.join(src, "Other"), os.path.join(src, "OrderHistory", "link"))
    open(os.path.join(src, "OrderHistory", "x.jpg.recount-part-" + "0" * 32), "wb").close()
    keys = lambda p: sorted(r.key for r in list_objects(spark, src, p, 2).collect())
    under = ["OrderHistory/a.jpg", "OrderHistory/b.png", "OrderHistory/d.txt", "OrderHistory/nested/c.gif"]
    assert keys("OrderHis") == keys("/OrderHistory") == sorted([*under, "OrderHistory2/f.jpg"])
    assert keys("OrderHistory/") == under and keys("OrderHistory/nested/c") == ["OrderHistory/nested/c.gif"]
    assert keys("nothing") == keys("no/such/folder") == []
    assert len(keys("")) == 6


def test_flat_folder_leaves_in_batches(monkeypatch):
    monkeypatch.setattr(objects, "BATCH", 3)
    rows = iter([(f"k{i}", i, 1.5 if i else None) for i in range(8)])
    assert [len(b) for b in objects._batches(rows, ["key", "length", "modified"])] == [3, 3, 2]


class _FakeFs:
    """A bucket in memory; names come back without the scheme, as from real stores."""

    def __init__(self, objects_):
        self.objects = dict(objects_)

    def ls(self, folder, detail=True):
        folder = folder.rstrip("/") + "/"
        names = {k[: len(folder)] + k[len(folder) :].split("/")[0] for k in self.objects if k.startswith(folder)}
        if not names:
            raise FileNotFoundError(folder)
        return [{"name": n, "type": "file", "size": len(self.objects[n])} if n in self.objects else {"name": n, "type": "directory"} for n in sorted(names)]

    def open(self, path, mode):
        if mode == "rb":
            if path.endswith("broken"):
                raise OSError("read failed")
            return io.BytesIO(self.objects[path])
        fs = self

        class Out(io.BytesIO):
            def close(self):
                if not self.closed:
                    fs.objects[path] = self.getvalue()
                super().close()

        return Out()

    def mv(self, a, b):
        self.objects[b] = self.objects.pop(a)

    def rm(self, path):
        self.objects.pop(path, None)


def test_store_keys_listing_and_copy(monkeypatch):
    data = {"bucket/pre/a.jpg": b"a", "bucket/pre/sub/b.jpg": b"bb", "bucket/prefix2.jpg": b"c", "bucket/pre/broken": b"d"}
    source, target = _FakeFs(data), _FakeFs({})
    monkeypatch.setattr(objects, "_fsspec", lambda url: (source if url.startswith("s3:") else target, url.split("://")[1]))
    fs, base = objects._at("s3://bucket/")
    assert base == "bucket" and objects._key_of(base, "bucket/pre/a.jpg") == "pre/a.jpg"
    with pytest.raises(ValueError):
        objects._key_of("bucket", "bucket2/pre/a.jpg")
    first = [(k, d) for k, _, _, d in objects._entries(fs, base, "", "pre")]
    assert first == [("pre", True), ("prefix2.jpg", False)]
    assert [(k, d) for k, _, _, d in objects._entries(fs, base, "pre", "pre")] == [("pre/a.jpg", False), ("pre/broken", False), ("pre/sub", True)]
    listed = next(objects._lister("s3://bucket", "none/at/all")(iter([pd.DataFrame({"folder": ["none/at"], "top": [True]})])), None)
    assert listed is None
    writer = objects._ObjectWriter({"root": "abfs://box/in", "source": "s3://bucket", "outcomes": "/"})
    row = writer._one("pre/sub/b.jpg", None)
    assert row["bytes"] == 2 and list(target.objects) == [f"box/in/pre/sub/b.jpg{objects.TEMPORARY}{row['token']}"]
    objects._publish_one("abfs://box/in", "pre/sub/b.jpg", row["token"])
    assert target.objects == {"box/in/pre/sub/b.jpg": b"bb"}
    assert writer._one("pre/broken", None)["status"] == "error"
    assert list(target.objects) == ["box/in/pre/sub/b.jpg"]  # nothing partial


def test_leftovers_of_a_killed_copy_go(tmp_path):
    src, dst = tmp_path / "s", tmp_path / "d"
    src.mkdir(), dst.mkdir()
    (src / "k").write_bytes(b"whole")
    (dst / ("k.recount-part-" + "f" * 32)).write_bytes(b"wh")
    row = objects._ObjectWriter({"root": str(dst), "source": str(src), "outcomes": "/"})._one("k", None)
    objects._publish_one(str(dst), "k", row["token"])
    assert sorted(os.listdir(dst)) == ["k"]
    objects._publish_one(str(dst), "k", row["token"])  # a task run again finds it published
    with pytest.raises(FileNotFoundError):
        objects._publish_one(str(dst), "other", row["token"])


def test_leftovers_are_cleared_by_folder(spark, tmp_path, monkeypatch):
    """One reading of each folder, not one per object."""
    (tmp_path / "f").mkdir()
    left = ".recount-part-" + "e" * 32
    for name in ("7" + left, "other" + left, "9.recount-part-short", "g" + left):
        (tmp_path / "f" / name).write_bytes(b"wh")
    (tmp_path / ("top" + left)).write_bytes(b"wh")
    (tmp_path / "file").write_bytes(b"no folder")
    rows = [(f"f/{i}", b"x") for i in range(20)] + [("top", b"y"), ("f/g", b"z"), ("file/below", b"error"), ("f//twice", b"s")]
    (tmp_path / "f" / ("twice" + left)).write_bytes(b"wh")
    monkeypatch.setattr(objects.glob, "glob", lambda *_: pytest.fail("a folder is read for an object"))
    out = write_objects(spark.createDataFrame(rows, "key string, content binary"), f"file://{tmp_path}", num_tasks=3).collect()
    assert sorted((r.key, r.status) for r in out) == sorted((k, "error" if k == "file/below" else "ok") for k, _ in rows)
    assert set(os.listdir(tmp_path)) == {"f", "top", "file"}
    assert set(os.listdir(tmp_path / "f")) == {str(i) for i in range(20)} | {"g", "twice", "other" + left, "9.recount-part-short"}
    # The write itself leaves that to the pass over the folders, else each object's folder would be read.
    calls = []
    monkeypatch.setattr(objects, "_clear_temporaries", lambda fs, path: calls.append(path))
    options = {"root": str(tmp_path), "outcomes": "/", "clear": "false"}
    assert objects._ObjectWriter(options)._one("f/1", b"x")["status"] == "ok" and not calls


def test_unreadable_folder_is_an_error():
    class Closed(objects._Local):
        def entries(self, folder):
            raise PermissionError(folder)
            yield

    with pytest.raises(PermissionError):
        list(objects._entries(Closed(), "/x", "", ""))


def test_objects_written_by_spark(spark, tmp_path):
    rows = [("a/1.html", b"x" * 10), ("a/b/2.html", b""), ("a/b/3.html", None), (None, b"no key")]
    out = write_objects(spark.createDataFrame(rows, "key string, content binary"), str(tmp_path), num_tasks=3).collect()
    assert {(r.key, r.bytes, r.status) for r in out} == {("a/1.html", 10, "ok"), ("a/b/2.html", 0, "ok"), ("a/b/3.html", 0, "ok"), (None, None, "error")}
    assert sorted((r.key, r.length) for r in list_objects(spark, str(tmp_path), "a/").collect()) == [("a/1.html", 10), ("a/b/2.html", 0), ("a/b/3.html", 0)]
    assert write_objects(spark.createDataFrame([], "key string, content binary"), str(tmp_path)).count() == 0
    text = write_objects(spark.createDataFrame([("t", "é")], "key string, content string"), str(tmp_path)).first()
    assert text.bytes == 2 and (tmp_path / "t").read_bytes() == "é".encode()


def test_only_the_committed_attempt_is_published(spark, tmp_path):
    """Two attempts of one task write the same objects; the commit names one of them."""
    import pyarrow as pa

    (tmp_path / "log").mkdir()
    writer = objects._ObjectWriter({"root": str(tmp_path / "dst"), "outcomes": str(tmp_path / "log")})
    batch = pa.RecordBatch.from_pydict({"key": ["k1", "k2"], "content": [b"one", b"two"]})
    first, second = writer.write(iter([batch])), writer.write(iter([batch]))
    assert list_objects(spark, str(tmp_path / "dst")).count() == 0  # nothing yet
    writer.abort([first, None])
    assert list_objects(spark, str(tmp_path / "dst")).count() == 0
    writer.commit([None, second])
    assert (tmp_path / "log" / objects.COMMITTED).read_text().split() == [second.outcomes]


def test_a_deep_listing_is_dealt_over_tasks(spark, tmp_path):
    for i in range(40):
        d = tmp_path / "archive" / "images" / "2023" / f"day{i}"
        d.mkdir(parents=True)
        (d / "x.jpg").write_bytes(b"x" * i)
    found = list_objects(spark, str(tmp_path), "archive/images/2023", num_tasks=8)
    assert {(r.key, r.length) for r in found.select("key", "length").collect()} == {(f"archive/images/2023/day{i}/x.jpg", i) for i in range(40)}
    # The day folders, all below one folder, were listed by several tasks: each wrote its own file.
    assert found.filter("length > 0").select(F.input_file_name()).distinct().count() > 4


def test_reconcile_objects(spark):
    schema = "key string, length long, sha256 string"
    a = spark.createDataFrame([("same", 1, "x"), ("missing", 2, "y"), ("longer", 3, "z"), ("other", 4, "u")], schema)
    b = spark.createDataFrame([("same", 1, "x"), ("longer", 5, "z"), ("other", 4, "v"), ("extra", 6, "w")], schema)
    got = {r.key: (r.source_length, r.target_length, r.verdict) for r in reconcile_objects(a, b).collect()}
    assert got == {
        "same": (1, 1, "same"), "missing": (2, None, "missing"), "longer": (3, 5, "length differs"),
        "other": (4, 4, "content differs"), "extra": (None, 6, "extra"),
    }
