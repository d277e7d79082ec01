"""Token ids in files of Simple-8b blocks, and back (operator 10).

Documents are range-partitioned by id and sorted; each range is one file in the shared folder, written as
a stream: blocks of 512 ids coded in 64-bit words (``simple8b``), documents end to end, each followed
by the end id. Then, each padded to eight bytes: first word of each block (int64, one more at the
end); the documents' ids (int64), whether the id is null (uint8) and number of tokens (int64). A
footer of eight 64-bit numbers: magic, block size, tokens, documents, and where those four begin.

A task that is run again writes a file of another name; the manifest, a table of one row per file
written by Spark's commit protocol, names the files that count. ``read_tokens`` reads whole files
in bounded pieces, ``read_slice`` any stretch of ids by the blocks' offsets.

Defined cases: a null or empty text has the end id only. Null ids come first, in one order with the
others by the text's hash; rows equal in id are ordered by that hash. Repeated rows are written each. Empty
tables give empty results. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import texts_in, worker_encoder
from .common import filesystem, shared_dir, text_or_empty
from .simple8b import BLOCK, decode, encode

MAGIC = 0x3142385352  # "RS8B1", little-endian
END_ID = 2
PIECE = 1 << 20  # ids coded or decoded at a time; a multiple of the block


def _padded(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


class Writer:
    """A file, written as a stream."""

    def __init__(self, stream):
        import numpy as np

        self.f, self.np = stream, np
        self.offsets, self.words, self.tokens = [], 0, 0
        self.waiting, self.n_waiting = [], 0
        self.ids, self.nulls, self.sizes = [], [], []  # arrays, of many documents each
        self.documents = 0

    def add(self, doc_id, ids) -> None:
        np = self.np
        self.add_many(np.array([doc_id or 0]), np.array([doc_id is None]), np.array([len(ids)]), ids)

    def add_many(self, doc_ids, nulls, sizes, ids) -> None:
        """Documents: their ids, whether these are null, numbers of tokens, and all tokens end to end."""
        self.ids.append(doc_ids.astype("<i8"))
        self.nulls.append(nulls.astype("u1"))
        self.sizes.append(sizes.astype("<i8"))
        self.documents += len(sizes)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= PIECE:
            self._code(self.n_waiting - self.n_waiting % BLOCK)

    def _code(self, n: int) -> None:
        flat = self.np.concatenate(self.waiting) if self.waiting else self.np.zeros(0, self.np.uint32)
        for at in range(0, n, PIECE):
            words, first = encode(flat[at : min(n, at + PIECE)].astype(self.np.uint64))
            self.f.write(words.astype("<u8").tobytes())
            self.offsets.append(first[:-1] + self.words)
            self.words += len(words)
        self.tokens += n
        self.waiting, self.n_waiting = [flat[n:]], len(flat) - n

    def close(self) -> None:
        np = self.np
        self._code(self.n_waiting)
        at, places = self.words * 8, []
        sections = (
            np.concatenate([*self.offsets, [self.words]]).astype("<i8"),
            np.concatenate([np.zeros(0, "<i8"), *self.ids]),
            np.concatenate([np.zeros(0, "u1"), *self.nulls]),
            np.concatenate([np.zeros(0, "<i8"), *self.sizes]),
        )
        for a in sections:
            raw = _padded(a.tobytes())
            places.append(at)
            at += len(raw)
            self.f.write(raw)
        self.f.write(np.array([MAGIC, BLOCK, self.tokens, self.documents, *places], "<i8").tobytes())


class Reader:
    """A file, read by ranges. ``f``: a random-access file of ``size`` bytes."""

    def __init__(self, f, size: int):
        import numpy as np

        self.f, self.np = f, np
        foot = np.frombuffer(self._at(size - 64, 64), "<i8")
        if foot[0] != MAGIC:
            raise ValueError("not a token file")
        self.block, self.tokens, n = int(foot[1]), int(foot[2]), int(foot[3])
        offsets, ids, nulls, sizes = (int(x) for x in foot[4:8])
        self.offsets = np.frombuffer(self._at(offsets, ids - offsets), "<i8")
        self.ids = np.frombuffer(self._at(ids, 8 * n), "<i8")
        self.nulls = np.frombuffer(self._at(nulls, n), "u1")
        self.sizes = np.frombuffer(self._at(sizes, 8 * n), "<i8")

    def _at(self, offset: int, size: int) -> bytes:
        self.f.seek(offset)
        return self.f.read(size)

    def values(self, first: int, last: int):
        """Ids ``first`` to ``last``, the latter not included."""
        if first >= last:
            return self.np.zeros(0, self.np.uint64)
        a, b = first // self.block, -(-last // self.block)
        raw = self._at(int(self.offsets[a]) * 8, int(self.offsets[b] - self.offsets[a]) * 8)
        return decode(self.np.frombuffer(raw, "<u8"))[first - a * self.block : last - a * self.block]

    def documents(self):
        """(id or None, start, tokens, crc32 of the ids as little-endian unsigned 32-bit) of each."""
        import zlib

        piece, base, start = self.np.zeros(0, self.np.uint64), 0, 0
        for doc, null, n in zip(self.ids.tolist(), self.nulls.tolist(), self.sizes.tolist()):
            crc, at = 0, start
            while at < start + n:
                if at >= base + len(piece):
                    base, piece = at, self.values(at, min(self.tokens, at + PIECE))
                part = piece[at - base : start + n - base]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                at += len(part)
            yield None if null else doc, start, n, crc
            start += n


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", end_id: int = END_ID, files: int | None = None) -> DataFrame:
    """Writes the files; the manifest (file, uri, documents, tokens), in the shared folder itself."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "tokens")
    fs, place = filesystem(folder)
    fs.create_dir(place, recursive=True)
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text).alias("text"))
    ordered = src.repartitionByRange(n, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))

    def work(batches):
        import uuid

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = worker_encoder(tokenizer, by_library=True)
        number = TaskContext.get().partitionId()
        uri = f"{folder}/part-{number:06d}-{uuid.uuid4().hex}.s8b"
        fs, place = filesystem(uri)
        writer = None
        f = None
        for batch in batches:
            for at, texts in texts_in(batch.column("text")):
                if writer is None:
                    f = fs.open_output_stream(place)
                    writer = Writer(f)
                names = batch.column("id").slice(at, len(texts))
                ids, sizes = encoder.flat(texts)
                ends = np.cumsum(sizes)
                writer.add_many(
                    names.fill_null(0).to_numpy(zero_copy_only=False), names.is_null().to_numpy(zero_copy_only=False),
                    sizes + 1, np.insert(ids.astype(np.uint32), ends, end_id),
                )
        if writer is not None:
            writer.close()
            f.close()
            row = ([number], [uri], [writer.documents], [writer.tokens])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["file", "uri", "documents", "tokens"])

    ordered.mapInArrow(work, "file long, uri string, documents long, tokens long").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of all documents of the files of a manifest."""
    # One row per file: the running sum's single partition is as small as the number of files.
    before = F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = manifest.select("file", "uri", F.coalesce(before, F.lit(0)).cast("long").alias("base"))
    spread = starts.repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "file")

    def work(batches):
        import pyarrow as pa

        names = ["doc_id", "start", "n_tokens", "ids_crc32"]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist()):
                fs, place = filesystem(uri)
                with fs.open_input_file(place) as f:
                    rows = []
                    for doc, start, n, crc in Reader(f, f.size()).documents():
                        rows.append((doc, base + start, n, crc))
                        if len(rows) == 1 << 14:
                            yield batch_of(rows)
                            rows = []
                    if rows:
                        yield batch_of(rows)

    return spread.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_ids(spark, sf_dir):
    import public_tokenizers

    from .common import table

    docs = table(spark, sf_dir, "documents")
    return read_tokens(write_tokens(docs, public_tokenizers.path("word_bpe_49k.json")))
