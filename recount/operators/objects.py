"""Stored objects: listing, manifests, a distributed copy and its reconciliation.

The legacy script lists one page of keys under a prefix and copies the objects one at a time
through one process, holding each body in memory. Here:

* ``list_objects`` lists every object whose key begins with a prefix (a string, as stores
  understand it), level by level: the folders of a level are a table dealt over the tasks, each of
  which lists its folders and sends the rows in batches, until a level has no folders. The driver
  sees neither keys nor folders. Empty objects are included, which Spark's file scans would skip;
* ``object_manifest`` turns any (key, content) frame into key, byte length and SHA-256, so
  source and target can be reconciled like tables (R1-R4 on objects: ``reconcile_objects``);
* ``copy_objects`` and ``write_objects`` publish objects in two steps. A write through a Python
  data source (``ObjectSink``) streams each object in chunks (bounded memory whatever its size)
  to a temporary name; Spark commits one attempt of every task, and the sink's commit names those
  attempts' outcome files. Then tasks move the committed objects to their names, which can be done
  again without harm. So a retried or speculative task publishes nothing of its own, and a job that
  fails before its commit publishes nothing at all. Temporary objects of attempts that don't count
  are left out of listings and removed when their keys are published, by this copy or the next: each
  folder is read once for that, whatever the number of its objects. Each key yields one outcome
  row (``ok`` or ``error``), and a bad object never stops the others.

Local and mounted paths work out of the box; store URLs (s3://, abfs://, gs://) go through
``fsspec`` when that package is installed on the executors. Its interface returns a folder's
entries as one list, which a task, never the driver, holds.

Keys are spread by hash, so many objects balance by count; one object is one task's stream
(its memory stays bounded by the chunk size, but a single huge object is not split: a ranged
multipart copy is a feature of the store's own API, outside Spark), and so are the entries of one folder.
"""
from __future__ import annotations

import glob
import hashlib
import json
import logging
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..sources.shared import shared_dir

log = logging.getLogger(__name__)

CHUNK = 8 * 1024 * 1024

COPY_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
BATCH = 10_000  # rows of a listing that leave a task at a time
TEMPORARY = ".recount-part-"
_TEMPORARY_NAME = re.compile(re.escape(TEMPORARY) + r"[0-9a-f]{32}$")


LIST_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("sha256", T.StringType()),
    ]
)


class _Local:
    """The few calls of a filesystem that this module makes, on local paths."""

    def entries(self, folder: str) -> Iterator[tuple[str, bool, int, float | None]]:
        with os.scandir(folder) as it:
            for e in it:
                # Links to files count as files, links to folders are not followed, at any level.
                if e.is_dir(follow_symlinks=False):
                    yield e.path, True, 0, None
                elif e.is_file():
                    st = e.stat()
                    yield e.path, False, st.st_size, st.st_mtime

    def open(self, path: str, mode: str):
        if mode == "wb":
            os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        return open(path, mode)

    def move(self, old: str, new: str) -> None:
        os.replace(old, new)

    def exists(self, path: str) -> bool:
        return os.path.isfile(path)

    def remove(self, path: str) -> None:
        os.remove(path)

    def make(self, folder: str) -> None:
        os.makedirs(folder, exist_ok=True)


class _Store:
    """The same calls on an fsspec filesystem."""

    def __init__(self, fs):
        self.fs = fs

    def entries(self, folder: str) -> Iterator[tuple[str, bool, int, float | None]]:
        for info in self.fs.ls(folder, detail=True):
            name = info["name"]
            if info.get("type") == "directory":
                yield name.rstrip("/"), True, 0, None
            else:
                m = info.get("LastModified") or info.get("last_modified") or info.get("mtime")
                yield name, False, int(info.get("size") or 0), m.timestamp() if hasattr(m, "timestamp") else m

    def open(self, path: str, mode: str):
        return self.fs.open(path, mode)

    def move(self, old: str, new: str) -> None:
        self.fs.mv(old, new)

    def exists(self, path: str) -> bool:
        return self.fs.exists(path)

    def remove(self, path: str) -> None:
        self.fs.rm(path)

    def make(self, folder: str) -> None:
        self.fs.makedirs(folder, exist_ok=True)


def _fsspec(url: str):
    try:
        import fsspec  # noqa: PLC0415
    except ImportError as e:  # pragma: no cover - depends on the cluster image
        raise RuntimeError(f"{url}: install fsspec and the store's driver on the executors") from e
    return fsspec.core.url_to_fs(url)


def _at(root: str) -> tuple[_Local | _Store, str]:
    """A root's filesystem, and the root as that filesystem writes it (no scheme, no slash at the end)."""
    if "://" in root and not root.startswith("file:"):
        fs, base = _fsspec(root)
        return _Store(fs), base.rstrip("/")
    for scheme in ("file://", "file:"):
        root = root.removeprefix(scheme)
    return _Local(), root.rstrip("/")


def _key_of(base: str, path: str) -> str:
    """``path`` relative to ``base``, both as the filesystem writes them."""
    if not path.startswith(base + "/"):
        raise ValueError(f"{path} is not below {base}")
    return path[len(base) + 1 :]


def _entries(fs, base: str, folder: str, prefix: str) -> Iterator[tuple[str, bool, int, float | None]]:
    """Entries of a folder (relative to ``base``) whose keys begin with the prefix."""
    for path, is_dir, size, modified in fs.entries(f"{base}/{folder}" if folder else base):
        key = _key_of(base, path)
        if key.startswith(prefix):
            yield key, size, modified, is_dir


def _own_temporary(key: str) -> bool:
    return bool(_TEMPORARY_NAME.search(key))


def _batches(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    while part := list(islice(rows, BATCH)):
        pdf = pd.DataFrame(part, columns=columns)
        us = (pdf["modified"].astype("float64") * 1_000_000).round().astype("Int64")
        pdf["modified"] = pd.to_datetime(us, unit="us").astype("datetime64[us]")  # whole microseconds: Arrow-safe
        yield pdf


def _lister(root: str, prefix: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _at(root)
        for pdf in batches:
            for folder, top in zip(pdf["folder"], pdf["top"]):
                try:
                    yield from _batches(_entries(fs, base, folder, prefix), ["key", "length", "modified", "folder"])
                except FileNotFoundError:  # below the top, a folder that is gone is an error
                    if not top:
                        raise
                    log.warning("nothing found: no folder %s below %s", folder, base)

    return run


def list_objects(spark: SparkSession, root: str, prefix: str = "", num_tasks: int | None = None) -> DataFrame:
    """Every object whose key begins with ``prefix``, as ``key, length, modified``.

    Keys are relative to ``root``. The prefix is a string: ``a/b`` finds ``a/b.jpg``, ``a/b/c`` and
    ``a/b2/c``. A prefix that nothing has gives an empty listing. The whole listing is read (the
    legacy call stops after its first page); folder markers (keys ending in '/') and this
    module's own temporary names are left out. The listing is a table in the shared folder, read
    when this function is called: one job per level of folders."""
    n = num_tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    prefix = prefix.lstrip("/")
    out = shared_dir(spark, "listing")
    schema = T.StructType([*LIST_SCHEMA.fields, T.StructField("folder", T.BooleanType())])
    front = spark.createDataFrame([(prefix.rpartition("/")[0], True)], "folder string, top boolean")
    depth = 0
    while True:
        path = f"{out}/depth={depth}"
        front.repartition(n, "folder").mapInPandas(_lister(root, prefix), schema).write.parquet(path)
        folders = spark.read.schema(schema).parquet(path).filter("folder")
        if folders.isEmpty():
            break
        front = folders.select(F.col("key").alias("folder"), F.lit(False).alias("top"))
        depth += 1
    found = spark.read.schema(schema).option("basePath", out).parquet(out).filter("NOT folder").select(*LIST_SCHEMA.fieldNames())
    return found.filter(~F.col("key").endswith("/") & ~F.col("key").rlike(_TEMPORARY_NAME.pattern))


def object_manifest(objects: DataFrame, key: str = "key", content: str = "content") -> DataFrame:
    """``key, length, sha256`` of each object of a (key, content) frame; content may be binary
    or text (hashed as UTF-8). Folder markers are dropped."""
    c = F.col(content)
    return objects.filter(~F.col(key).endswith("/")).select(
        F.col(key).alias("key"),
        F.octet_length(c).cast("bigint").alias("length"),
        F.sha2(c, 256).alias("sha256"),
    )


def _hash_one(root: str, key: str) -> tuple[int, str]:
    fs, base = _at(root)
    h, n = hashlib.sha256(), 0
    with fs.open(f"{base}/{key}", "rb") as f:
        while b := f.read(CHUNK):
            h.update(b)
            n += len(b)
    return n, h.hexdigest()


def read_manifest(spark: SparkSession, root: str, prefix: str = "", num_tasks: int | None = None) -> DataFrame:
    """``key, length, sha256`` of every object under a root: listed as in ``list_objects`` and
    hashed in the tasks, each object streamed in chunks (no object is held whole)."""
    n = num_tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list_objects(spark, root, prefix, n).select("key").repartition(n, "key")

    def hasher(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(k, *_hash_one(root, k)) for k in pdf["key"]]
            yield pd.DataFrame(out, columns=["key", "length", "sha256"])

    return keys.mapInPandas(hasher, MANIFEST_SCHEMA)


def ensure_target(root: str) -> None:
    """Create the target container once from the driver; an existing one is fine (B1)."""
    fs, base = _at(root)
    fs.make(base)


def _chunks(fin) -> Iterator[bytes]:
    while b := fin.read(CHUNK):
        yield b


def _store_one(chunks: Iterator[bytes], fs, path: str) -> tuple[int, str, str]:
    """Streams one object to a temporary name beside ``path``: (bytes, sha256, the name's token).
    Raises on failure, and then leaves nothing."""
    h, n, token = hashlib.sha256(), 0, uuid.uuid4().hex
    tmp = f"{path}{TEMPORARY}{token}"
    try:
        with fs.open(tmp, "wb") as fout:
            for b in chunks:
                h.update(b)
                n += len(b)
                fout.write(b)
    except BaseException:
        # Closing a store's stream after an error can commit what was written: it goes, too.
        try:
            fs.remove(tmp)
        except OSError:
            pass
        raise
    return n, h.hexdigest(), token


def _clear_temporaries(fs, path: str) -> None:
    """Removes what a killed copy of this object has left (local paths; on stores, a bucket's
    rule for unfinished uploads does it, as listing a folder per object would cost too much). It
    reads the object's folder: many objects are cleared by ``_clear_leftovers``."""
    if isinstance(fs, _Local):
        for left in glob.glob(glob.escape(path) + TEMPORARY + "*"):
            if _own_temporary(left):
                fs.remove(left)


@dataclass
class _Attempt(WriterCommitMessage):
    """The outcome file of a task's attempt that Spark has committed."""

    outcomes: str


class ObjectSink(DataSource):
    """Rows (key, content), or keys of objects below ``source``, as temporary objects below
    ``root``; options ``outcomes`` (a folder for outcome files, one per attempt), ``threads`` and
    ``clear`` (``false``: the caller removes what killed copies have left)."""

    @classmethod
    def name(cls) -> str:
        return "recount_objects"

    def writer(self, schema: T.StructType, overwrite: bool) -> "_ObjectWriter":
        return _ObjectWriter(dict(self.options))


class _ObjectWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.root, self.source, self.outcomes = options["root"], options.get("source"), options["outcomes"]
        self.threads = int(options.get("threads", "8"))
        self.clear = options.get("clear", "true") == "true"

    def _one(self, key: str, content: bytes | str | None) -> dict:
        try:
            if key is None:
                raise ValueError("no key")
            dfs, dst = _at(self.root)
            path = f"{dst}/{key}"
            if self.clear:
                _clear_temporaries(dfs, path)
            if self.source is None:
                data = content.encode() if isinstance(content, str) else content or b""
                n, digest, token = _store_one(iter([data]), dfs, path)
            else:
                sfs, src = _at(self.source)
                with sfs.open(f"{src}/{key}", "rb") as fin:
                    n, digest, token = _store_one(_chunks(fin), dfs, path)
            return {"key": key, "bytes": n, "sha256": digest, "status": "ok", "token": token}
        except Exception as e:  # one bad object never stops the rest (B6)
            return {"key": key, "status": "error", "error": f"{type(e).__name__}: {e}"}

    def write(self, iterator) -> _Attempt:
        from concurrent.futures import ThreadPoolExecutor

        fs, folder = _at(self.outcomes)
        name = f"{uuid.uuid4().hex}.json"
        # Copies wait on the network; a few threads per task keep the task busy.
        with ThreadPoolExecutor(max_workers=self.threads) as pool, fs.open(f"{folder}/{name}", "wb") as log_:
            for batch in iterator:
                columns = batch.to_pydict()
                contents = columns.get("content") or [None] * batch.num_rows
                for row in pool.map(self._one, columns["key"], contents):
                    log_.write(json.dumps(row).encode() + b"\n")
        return _Attempt(name)

    def commit(self, messages: list[_Attempt | None]) -> None:
        """One row per task: the outcome files that count."""
        fs, folder = _at(self.outcomes)
        with fs.open(f"{folder}/{COMMITTED}", "wb") as f:
            f.write("".join(f"{m.outcomes}\n" for m in messages if m is not None).encode())

    def abort(self, messages: list[_Attempt | None]) -> None:
        log.error("nothing of this write is published")


COMMITTED = "_committed"


def _publish_one(root: str, key: str, token: str) -> None:
    """Moves a committed object to its name. Done again, it is there."""
    fs, base = _at(root)
    tmp = f"{base}/{key}{TEMPORARY}{token}"
    try:
        fs.move(tmp, f"{base}/{key}")
    except FileNotFoundError:  # moved by an earlier attempt of this task
        if not fs.exists(f"{base}/{key}"):
            raise
    except Exception:
        fs.remove(tmp)
        raise


def _publisher(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, n, digest, status, error, token in pdf.itertuples(index=False, name=None):
                if status == "ok":
                    try:
                        _publish_one(root, key, token)
                        out.append((key, int(n), digest, status, None))
                        continue
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                out.append((key, None, None, "error", error))
            yield pd.DataFrame(out, columns=COPY_SCHEMA.fieldNames(), dtype=object).astype({"bytes": "Int64"})

    return run


def _publish(frame: DataFrame, root: str, source: str | None, num_tasks: int | None, threads: int) -> DataFrame:
    spark = frame.sparkSession
    n = num_tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.dataSource.register(ObjectSink)
    folder = shared_dir(spark, "outcomes")
    fs, place = _at(folder)
    fs.make(place)
    options = {"root": root, "outcomes": folder, "threads": str(threads), "clear": "false"} | ({"source": source} if source else {})
    write = frame.repartition(n, "key").write.format(ObjectSink.name()).mode("append")
    write.options(**options).save()
    with fs.open(f"{place}/{COMMITTED}", "rb") as f:
        files = [f"{folder}/{x}" for x in f.read().decode().split()]
    schema = T.StructType([*COPY_SCHEMA.fields, T.StructField("token", T.StringType())])
    stored = spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
    outcomes = stored.repartition(n, "key").mapInPandas(_publisher(root), COPY_SCHEMA)
    outcomes.write.parquet(f"{folder}/published")
    published = spark.read.schema(COPY_SCHEMA).parquet(f"{folder}/published")
    _clear_leftovers(published, root, n)
    return published


_FOLDER = r"(?s)^(.*)/[^/]*$"


def _leftovers(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _at(root)
        for pdf in batches:
            for folder in pdf["folder"]:
                below = f"{folder}/" if folder else ""  # as the keys write it
                try:
                    names = (k.rpartition("/")[2] for k, _, _, is_dir in _entries(fs, base, folder, "") if not is_dir)
                    found = (below + name for name in names if _own_temporary(name))
                    while part := list(islice(found, BATCH)):
                        yield pd.DataFrame({"temporary": part})
                except OSError as e:  # what is published stays so
                    log.warning("leftovers not looked for in %s below %s: %s", folder, base, e)

    return run


def _remover(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _at(root)
        for pdf in batches:
            for temporary in pdf["temporary"]:
                try:
                    fs.remove(f"{base}/{temporary}")
                except FileNotFoundError:  # removed by an earlier attempt of this task
                    pass
                except OSError as e:
                    log.warning("%s below %s stays: %s", temporary, base, e)
            yield pdf[["temporary"]]

    return run


def _clear_leftovers(published: DataFrame, root: str, n: int) -> None:
    """Removes what attempts that don't count, of this write or an earlier one, have left of these
    keys: each of their folders is read once, by one task (local paths, as ``_clear_temporaries``)."""
    if not isinstance(_at(root)[0], _Local):
        return
    keys = published.select("key").filter(F.col("key").isNotNull())
    folders = keys.select(F.regexp_extract("key", _FOLDER, 1).alias("folder")).distinct().repartition(n, "folder")
    found = folders.mapInPandas(_leftovers(root), "temporary string")
    left = found.withColumn("key", F.regexp_replace("temporary", _TEMPORARY_NAME.pattern, ""))
    left.join(keys, "key", "left_semi").mapInPandas(_remover(root), "temporary string").write.format("noop").mode("overwrite").save()


def copy_objects(
    manifest: DataFrame, src_root: str, dst_root: str, num_tasks: int | None = None, threads_per_task: int = 8
) -> DataFrame:
    """Copy every key of ``manifest`` from ``src_root`` to the same key under ``dst_root``
    (B4, B5, B6); one outcome row per key: ``key, bytes, sha256, status, error``.

    Keys are hash-partitioned over ``num_tasks`` tasks (default: the shuffle partitions), so
    work spreads over the cluster; inside a task ``threads_per_task`` objects are in flight at
    once, each streamed in chunks. The copy is done when this function returns; the result is the
    table of its outcomes."""
    keys = manifest.select("key").filter(~F.col("key").endswith("/")).distinct()
    return _publish(keys, dst_root, src_root, num_tasks, threads_per_task)


def write_objects(objects: DataFrame, root: str, num_tasks: int | None = None, threads_per_task: int = 8) -> DataFrame:
    """Writes each row of a (key, content) frame as an object below ``root`` (S5); outcomes as in
    ``copy_objects``. Content is binary or text (UTF-8), null is an empty object; of several rows of
    a key any one stays."""
    return _publish(objects.select("key", "content"), root, None, num_tasks, threads_per_task)


def pending_objects(source: DataFrame, target: DataFrame) -> DataFrame:
    """Keys of ``source`` missing from ``target`` or of another length (two listings).

    Copying only these resumes an interrupted migration; on an empty target it is every key,
    the legacy behaviour. A distributed anti-join, so neither listing passes the driver."""
    return source.join(target.select("key", "length"), ["key", "length"], "left_anti")


def copy_summary(outcomes: DataFrame) -> DataFrame:
    """Totals per outcome: ``status, objects, bytes``."""
    return outcomes.groupBy("status").agg(
        F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    )


def reconcile_objects(source: DataFrame, target: DataFrame) -> DataFrame:
    """Two manifests (key, length, sha256) held against each other, a row per key: ``key,
    source_length, target_length, verdict``, the latter ``missing`` or ``extra`` in the target,
    ``length differs``, ``content differs`` or ``same``. A full outer join by key: neither manifest passes the
    driver."""
    s = source.select(F.col("key").alias("s_key"), F.col("length").alias("source_length"), F.col("sha256").alias("s_sha"))
    t = target.select(F.col("key").alias("t_key"), F.col("length").alias("target_length"), F.col("sha256").alias("t_sha"))
    verdict = (
        F.when(F.col("t_key").isNull(), "missing")
        .when(F.col("s_key").isNull(), "extra")
        .when(F.col("source_length") != F.col("target_length"), "length differs")
        .when(F.col("s_sha") != F.col("t_sha"), "content differs")
        .otherwise("same")
    )
    both = s.join(t, F.col("s_key") == F.col("t_key"), "full")
    return both.select(F.coalesce("s_key", "t_key").alias("key"), "source_length", "target_length", verdict.alias("verdict"))
