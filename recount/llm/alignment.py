"""Alignment of two tokenizers' tokens by an associative fragment monoid (operator 11).

Tokenizer A is a byte-level BPE (a ``tokenizers`` file), B a byte-fallback BPE (a ``sentencepiece`` model). Both split a
space and the text into tokens; a byte offset where tokens of both end closes a group.

1. A text is cut into byte ranges (chunks) of about ``CHUNK`` code points; those of long texts are dealt over
   the tasks. A chunk's tokens are those that *end* within its range, wherever it was cut: its row carries
   the text as far as the last safe point before it and the next one after it. A safe point is a single space between
   two characters that are not white space: neither tokenizer has a token or a merge across it.
2. Between safe points lie segments, mostly words. Their tokens are found once per task, new segments
   together as one text, and kept in a table of bounded size; a text is a sequence of table entries. Each range's
   ids of both tokenizers are written as binary columns, which both passes below read: texts are tokenized once. The
   tokens' ends, common ends and groups are array operations over many ranges.
3. A chunk yields a ``Fragment``: an open prefix (the tokens up to the first common end), closed groups, and an open
   suffix. ``compose`` is associative, with ``EMPTY`` as its neutral element, so the fragments of a long document are
   reduced as a tree: ``FAN`` neighbours a round, each round one exchange.
4. A link is a pair of tokens that end together, so it lies in one chunk. A first pass counts the linked id
   pairs of the whole corpus, added up per task before the exchange; the counts are written as sorted binary files
   in the shared folder (``PairCounts``), from which tasks read the blocks that they need.

Defined cases: null and empty texts have no tokens, nor have texts whose bytes A's or B's tokens don't give back
(B writes U+2581 as a space); their counts are zero, their groups null, and no link of theirs is counted. Texts of any length are encoded whole;
one stretch without a safe point is one segment. Repeated rows are aligned and counted each. Empty tables give
empty results. Other columns are carried along unread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import _within, byte_alphabet
from .common import filesystem, shared_dir, text_or_empty, written

CHUNK = 1 << 15  # code points
# Fixed value: how byte-level tokenizers part a text before merging.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FAN = 16
TABLE_SEGMENTS = 1 << 17
ROWS = 32  # texts looked at together
BLOCK = 1 << 12  # pairs of a block in a file of counts
BLOCKS_KEPT = 1 << 9
LINKS = 1 << 19  # links added up at a time


# --- the monoid ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fragment:
    """Tokens of a byte range. ``closed``: whether a common end lies in it. ``head``: (A ids, B ids) up to the
    first common end, part of a group that may have begun earlier; ``body``: the groups after it, as
    text; ``tail``: (A ids, B ids) after the last common end. Without a common end all tokens are the tail."""

    closed: bool = False
    head: tuple[tuple, tuple] = ((), ())
    body: str = ""
    tail: tuple[tuple, tuple] = ((), ())


EMPTY = Fragment()


def group_text(a, b) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def _both(x: tuple[tuple, tuple], y: tuple[tuple, tuple]) -> tuple[tuple, tuple]:
    return x[0] + y[0], x[1] + y[1]


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    if not x.closed:
        open_ = _both(x.tail, y.head if y.closed else y.tail)
        return Fragment(True, open_, y.body, y.tail) if y.closed else Fragment(tail=open_)
    if not y.closed:
        return Fragment(True, x.head, x.body, _both(x.tail, y.tail))
    return Fragment(True, x.head, ";".join(t for t in (x.body, group_text(*_both(x.tail, y.head)), y.body) if t), y.tail)


def fragment(a_ids, a_ends, b_ids, b_ends) -> tuple[Fragment, list[tuple[int, int]]]:
    """The fragment of tokens given by ids and the byte offsets of their ends, and its links (A id, B id)."""
    at = {e: i for i, e in enumerate(b_ends)}
    common = [(i, at[e]) for i, e in enumerate(a_ends) if e in at]
    links = [(a_ids[i], b_ids[j]) for i, j in common]
    if not common:
        return Fragment(tail=(tuple(a_ids), tuple(b_ids))), links
    cuts = [(tuple(a_ids[i + 1 : k + 1]), tuple(b_ids[j + 1 : m + 1])) for (i, j), (k, m) in zip(common, common[1:])]
    (i, j), (k, m) = common[0], common[-1]
    head, tail = (tuple(a_ids[: i + 1]), tuple(b_ids[: j + 1])), (tuple(a_ids[k + 1 :]), tuple(b_ids[m + 1 :]))
    return Fragment(True, head, ";".join(group_text(*c) for c in cuts), tail), links


def groups_of(whole: Fragment) -> str | None:
    """The groups of a whole text; None if tokens are left open."""
    if not whole.closed or whole.tail != ((), ()):
        return None
    return ";".join(t for t in (group_text(*whole.head), whole.body) if t)


# --- the tokenizers -----------------------------------------------------------------------------


class Tokenizers:
    """Tokens of segments, given without the space that each begins with (B adds it by itself)."""

    def __init__(self, path_a: str, path_b: str):
        import json
        import re

        import numpy as np
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if all(c in byte_of for c in t)}
        # The file's merges make tokens in the order of their ids, so an id is a rank; special tokens are plain text.
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab["".join(p)] for p in pairs]
        special = {t["id"] for t in spec["added_tokens"]}
        kind = spec["pre_tokenizer"] or {}
        if made != sorted(made) or kind.get("type") != "ByteLevel" or not kind.get("use_regex") or spec["normalizer"]:
            raise ValueError(f"{path_a} is not a byte-level BPE whose ids are ranks")
        ranks = {raw: i for i, raw in self.a_bytes.items() if i not in special}
        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.wide = "<u2" if max(len(self.a_sizes), len(self.b_sizes)) <= 1 << 16 else "<u4"
        self.safe = re.compile(r" (?<=\S )(?=\S)")

    def tokens(self, segments: list[str]):
        """For A and B: (the segments' ids in some order, each segment's first place in them, how many: -1 where the tokens
        don't give its bytes back)."""
        import numpy as np

        # Segments without white space or U+2581 at their ends stay apart at safe points when put together.
        plain = [i for i, s in enumerate(segments) if s and not s[0].isspace() and not s[-1].isspace() and "▁" not in s]
        out = [([np.zeros(0, np.int64)], np.zeros(len(segments), np.int64), np.full(len(segments), -1)) for _ in range(2)]
        if plain:
            raw = [segments[i].encode() for i in plain]
            ends = np.cumsum([len(x) + 1 for x in raw])
            found = self._split(" " + " ".join([segments[i] for i in plain]), b" " + b" ".join(raw))
            cuts = found and [np.searchsorted(e, ends) + 1 for _, e in found]
            if not found or any((e[c - 1] != ends).any() for (_, e), c in zip(found, cuts)):
                plain = []  # one by one, below
            else:
                for (ids, first, size), (new, _), c in zip(out, found, cuts):
                    ids.append(new)
                    size[plain] = np.diff(c, prepend=0)
                    first[plain] = c - size[plain]
        done = set(plain)
        for i, s in enumerate(segments):
            if i not in done and (found := self._split(" " + s, b" " + s.encode())):
                for (ids, first, size), (new, _) in zip(out, found):
                    first[i], size[i] = sum(map(len, ids)), len(new)
                    ids.append(new)
        return [(np.concatenate(ids), first, size) for ids, first, size in out]

    def _split(self, spaced: str, data: bytes):
        """((A ids, ends), (B ids, ends)) of a text that begins with a space; None if bytes don't come back."""
        import numpy as np

        out = []
        for ids, of in ((self.a.encode_ordinary(spaced), self.a_bytes), (self.b.encode(spaced[1:]), self.b_bytes)):
            if b"".join(map(of.__getitem__, ids)) != data:
                return None
            ids = np.array(ids, np.int64)
            out.append((ids, np.cumsum((self.a_sizes if of is self.a_bytes else self.b_sizes)[ids])))
        return out


class PairCounts:
    """Counts of id pairs in sorted binary files: 16 bytes a pair (key, count; the count's lowest bit tells
    whether it is its B id's highest). ``files``: (first key, last key, uri, pairs), one per file."""

    def __init__(self, files: list[tuple]):
        from collections import OrderedDict

        self.files = sorted(files)
        self.kept: OrderedDict = OrderedDict()

    def _block(self, number: int, block: int):
        import numpy as np

        key = (number, block)
        if key in self.kept:
            self.kept.move_to_end(key)
            return self.kept[key]
        _, _, uri, n = self.files[number]
        fs, place = filesystem(uri)
        with fs.open_input_file(place) as f:
            raw = f.read_at(16 * min(BLOCK, n - block * BLOCK), 16 * block * BLOCK)
        self.kept[key] = np.frombuffer(raw, "<i8").reshape(-1, 2)
        if len(self.kept) > BLOCKS_KEPT:
            self.kept.popitem(last=False)
        return self.kept[key]

    def _first_of(self, number: int):
        """The first key of each block of a file, written at its end."""
        import numpy as np

        key = (number, -1)
        if key not in self.kept:
            _, _, uri, n = self.files[number]
            fs, place = filesystem(uri)
            with fs.open_input_file(place) as f:
                self.kept[key] = np.frombuffer(f.read_at(8 * -(-n // BLOCK), 16 * n), "<i8")
        self.kept.move_to_end(key)
        return self.kept[key]

    def find(self, keys):
        """(counts, whether highest) of sorted distinct keys, all of which are there."""
        import numpy as np

        out = np.zeros(len(keys), np.int64)
        lasts = np.array([f[1] for f in self.files], np.int64)
        number = np.searchsorted(lasts, keys)
        for k in np.unique(number).tolist():
            mine = np.flatnonzero(number == k)
            block = np.searchsorted(self._first_of(k), keys[mine], side="right") - 1
            for b in np.unique(block).tolist():
                at = mine[block == b]
                rows = self._block(k, b)
                out[at] = rows[np.searchsorted(rows[:, 0], keys[at]), 1]
        return out >> 1, (out & 1).astype(bool)


class Segments:
    """Tokens of ranges of texts, by a table of segments."""

    def __init__(self, tokenizers: Tokenizers):
        self.t = tokenizers
        self.clear()

    def clear(self) -> None:
        import numpy as np

        self.table: dict[str, int] = {}
        # Of A and B: each segment's first place in the pool of ids, and how many (-1: its bytes don't come back).
        self.first = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.size = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.pool = [np.zeros(0, np.int32), np.zeros(0, np.int32)]

    def learn(self, segments: list[str]) -> None:
        import numpy as np

        for k, (ids, first, size) in enumerate(self.t.tokens(segments)):
            self.first[k] = np.concatenate((self.first[k], first + len(self.pool[k])))
            self.size[k] = np.concatenate((self.size[k], size))
            self.pool[k] = np.concatenate((self.pool[k], ids.astype(np.int32)))

    def entries(self, texts: list[str]):
        """Table entries of the segments of texts (each beginning with a space), end to end, and how many of each."""
        from itertools import islice

        import numpy as np

        if len(self.table) > TABLE_SEGMENTS:
            self.clear()
        table, flat, sizes = self.table, [], []
        known, split = len(table), self.t.safe.split
        for text in texts:
            segments = split(text[1:])
            sizes.append(len(segments))
            flat += [table.setdefault(s, len(table)) for s in segments]
        if len(table) > known:
            self.learn(list(islice(table, known, None)))
        return np.array(flat, np.int64), np.array(sizes, np.int64)

    def packed(self, rows: list[tuple]):
        """Rows (text, low, high), each the range of bytes above ``low`` and up to ``high`` (None: the end) of a text that begins
        with a space and lies between safe points. Arrays of the ``TOKENS`` columns: whether the text's bytes come
        back, and of A and of B the ids of the tokens that end in the range and where the first begins, from ``low`` on."""
        import numpy as np
        import pyarrow as pa

        flat, sizes = self.entries([r[0] for r in rows])
        row = np.repeat(np.arange(len(rows)), sizes)
        good = np.ones(len(rows), bool)
        good[row[self.size[0][flat] < 0]] = False
        keep = good[row]
        flat, row = flat[keep], row[keep]
        far = np.iinfo(np.int64).max
        low, high = np.array([r[1] for r in rows], np.int64), np.array([far if r[2] is None else r[2] for r in rows], np.int64)
        at = np.arange(len(rows) + 1)
        ids_of, begins = [], []
        for k, weights in ((0, self.t.a_sizes), (1, self.t.b_sizes)):
            n = self.size[k][flat]
            ids = self.pool[k][np.repeat(self.first[k][flat], n) + _within(n)]
            of, ends = np.repeat(row, n), np.cumsum(weights[ids])
            # A row begins where its predecessor's last token ends.
            ends -= np.concatenate(([0], ends))[np.searchsorted(of, at[:-1])][of]
            inside = (ends > low[of]) & (ends <= high[of])
            ids, of, ends = ids[inside], of[inside], ends[inside]
            cuts = np.searchsorted(of, at)
            begin, some = np.zeros(len(rows), np.int64), np.flatnonzero(np.diff(cuts))
            head = cuts[some]
            begin[some] = ends[head] - weights[ids[head]] - low[some]
            raw = ids.astype(self.t.wide)
            offsets = (cuts * raw.itemsize).astype(np.int32)
            ids_of.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]))
            begins.append(pa.array(begin))
        return [pa.array(good), *ids_of, *begins]


class Aligner:
    """Links and fragments of rows (ok, A ids, B ids, begin of A's first, begin of B's first), as ``Segments.packed`` makes
    them. ``counts``: None in the counting pass."""

    def __init__(self, tokenizers: Tokenizers, counts: PairCounts | None = None):
        self.t, self.counts = tokenizers, counts

    def tokens(self, rows: list[tuple]):
        """Of A and of B (ids, ends, row); the ends count on from row to row, where both begin alike."""
        import numpy as np

        out, far = [], np.zeros(len(rows), np.int64)
        for k, weights in ((1, self.t.a_sizes), (2, self.t.b_sizes)):
            n = np.array([len(r[k]) for r in rows], np.int64) // np.dtype(self.t.wide).itemsize
            ids = np.frombuffer(b"".join([r[k] for r in rows]), self.t.wide).astype(np.int64)
            row, total = np.repeat(np.arange(len(rows)), n), np.concatenate(([0], np.cumsum(weights[ids])))
            upto = np.cumsum(n)
            begin = np.array([r[k + 2] for r in rows], np.int64)
            far = np.maximum(far, begin + total[upto] - total[upto - n])
            out.append((ids, total[1:] + (begin - total[upto - n])[row], row))
        base = np.cumsum(far) - far
        return [(ids, ends + base[row], row) for ids, ends, row in out]

    def links(self, rows: list[tuple]):
        """Keys of the linked pairs, in order (the counting pass)."""
        (a, a_ends, _), (b, b_ends, _) = self.tokens(rows)
        i, j = _common(a_ends, b_ends)
        return _key(a[i], b[j])

    def chunks(self, rows: list[tuple]) -> list[tuple[Fragment, list[int]] | None]:
        """Of each row its fragment and its numbers; None if it isn't ok."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        (a, a_ends, a_row), (b, b_ends, b_row) = self.tokens(rows)
        i, j = _common(a_ends, b_ends)
        of = a_row[i]  # the row of each group
        keys, back = np.unique(_key(a[i], b[j]), return_inverse=True)
        n, best = self.counts.find(keys) if self.counts else (np.zeros(len(keys), np.int64), np.zeros(len(keys), bool))
        at = np.arange(len(rows) + 1)
        group_of = np.searchsorted(of, at)
        bounds = [np.searchsorted(x, at) for x in (a_row, b_row)]
        sums = [np.concatenate(([0], np.cumsum(x[back])))[group_of] for x in (best.astype(np.int64), n)]
        # A token's group is that of the next common end; a tail's would be another row's.
        sides, tails = [], []
        for ids, ends, row in ((a, a_ends, a_row), (b, b_ends, b_row)):
            group = np.searchsorted(a_ends[i], ends)
            tail = np.append(of, -1)[group] != row
            tails.append((ids[tail], np.searchsorted(row[tail], at)))
            sides.append((ids[~tail], group[~tail], np.bincount(group[~tail], minlength=len(i))))
        (ga, a_group, a_n), (gb, b_group, b_n) = sides
        a_sum, b_sum = np.cumsum(a_n), np.cumsum(b_n)
        merged, sign = np.empty(len(ga) + len(gb), np.int64), np.zeros(len(ga) + len(gb), np.int64)
        a_at = np.arange(len(ga)) + (b_sum - b_n)[a_group]
        b_at = np.arange(len(gb)) + a_sum[b_group]
        merged[a_at], merged[b_at] = ga, gb
        if len(i):
            sign[a_at[a_sum - 1]], sign[b_at[b_sum - 1]] = 1, 2
        signs = pa.array([",", "|", ";"]).take(pa.array(sign))
        text = pc.binary_join_element_wise(pa.array(merged).cast(pa.string()), signs, "").cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1) if len(text) else np.zeros(1, np.int64)
        data = text.buffers()[2].to_pybytes() if len(text) else b""
        out = []
        for k in range(len(rows)):
            if not rows[k][0]:
                out.append(None)
                continue
            g, h = int(group_of[k]), int(group_of[k + 1])
            totals = [int(x[k + 1] - x[k]) for x in bounds] + [h - g, h - g] + [int(x[k + 1] - x[k]) for x in sums]
            tail = tuple(tuple(x[c[k] : c[k + 1]].tolist()) for x, c in tails)
            if g == h:
                out.append((Fragment(tail=tail), totals))
                continue
            head = tuple(tuple(x[c[g] - m[g] : c[g]].tolist()) for x, c, m in ((ga, a_sum, a_n), (gb, b_sum, b_n)))
            body = data[offsets[a_sum[g] + b_sum[g]] : offsets[a_sum[h - 1] + b_sum[h - 1]]][:-1]
            out.append((Fragment(True, head, body.decode(), tail), totals))
        return out


def _common(a_ends, b_ends):
    """The places of equal ends in two ascending sequences."""
    import numpy as np

    at = np.searchsorted(b_ends, a_ends)
    hit = np.append(b_ends, -1)[at] == a_ends
    return np.flatnonzero(hit), at[hit]


def _key(a, b):
    import numpy as np

    return b.astype(np.int64) << 32 | a.astype(np.int64)  # by B id first


def worker_tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """The worker process's tokenizers, kept from task to task."""
    import sys
    import types

    kept = sys.modules.setdefault("_recount_worker", types.ModuleType("_recount_worker")).__dict__
    if kept.get("aligned") != (path_a, path_b):
        kept["tokenizers"], kept["aligned"] = Tokenizers(path_a, path_b), (path_a, path_b)
    return kept["tokenizers"]


# --- Spark --------------------------------------------------------------------------------------

CHUNK_COLUMNS = "row long, number long, chunks long, text string, low long, high long"


def cut(text: str, chunk: int = 0):
    """Chunks (number, chunks, text between safe points, low, high) of a space and the text."""
    chunk = chunk or CHUNK
    s = " " + text
    if len(s) <= chunk:
        return [(0, 1, s, 0, None)]
    n = -(-len(s) // chunk)
    out = []

    def safe(at: int) -> bool:
        return s[at] == " " and not s[at - 1].isspace() and at + 1 < len(s) and not s[at + 1].isspace()

    def before(at: int) -> int:
        """The last safe point at or before a position (the begin is one)."""
        while at > 0:
            at = s.rfind(" ", 0, at + 1)
            if at <= 0 or safe(at):
                return max(at, 0)
            at -= 1
        return 0

    def after(at: int) -> int:
        """The first safe point at or after a position; the end is one."""
        while 0 <= at < len(s):
            at = s.find(" ", at)
            if at > 0 and safe(at):
                return at
            at = at + 1 if at >= 0 else -1
        return len(s)

    for k in range(n):
        a, b = k * chunk, min(len(s), (k + 1) * chunk)
        begin, end = before(a), after(b)
        low = len(s[begin:a].encode())
        high = None if end == b else low + len(s[a:b].encode())
        out.append((k, n, s[begin:end], low, high))
    return out


TOKENS = "ok boolean, a binary, b binary, a_begin long, b_begin long"
TOKEN_COLUMNS = ["ok", "a", "b", "a_begin", "b_begin"]


def _tokenized(ranges: DataFrame, path_a: str, path_b: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and the ``TOKENS`` of ranges (text, low, high)."""
    schema = ranges.select(*keep).schema
    for c in TOKENS.split(", "):
        schema = schema.add(*c.split())

    def work(batches):
        import pyarrow as pa

        segments = Segments(worker_tokenizers(path_a, path_b))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = segments.packed(list(zip(*(part.column(c).to_pylist() for c in ("text", "low", "high")))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *found], [*keep, *TOKEN_COLUMNS])

    return ranges.select(*keep, "text", "low", "high").mapInArrow(work, schema)


def _counted(tokens: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(a, b, n): linked id pairs, added up per task."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        aligner = Aligner(worker_tokenizers(path_a, path_b))
        found: list[np.ndarray] = []

        def flush():
            pairs, n = np.unique(np.concatenate(found), return_counts=True)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (pairs & 0xFFFFFFFF, pairs >> 32, n)], ["a", "b", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found.append(aligner.links(list(zip(*(part.column(c).to_pylist() for c in TOKEN_COLUMNS)))))
                if sum(map(len, found)) > LINKS:
                    yield flush()
        if found:
            yield flush()

    counted = tokens.select(*TOKEN_COLUMNS).mapInArrow(work, "a long, b long, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def pair_files(counted: DataFrame) -> list[tuple]:
    """The counts as files for ``PairCounts``; one row per file comes to the driver."""
    spark = counted.sparkSession
    folder = shared_dir(spark, "pairs")
    fs, place = filesystem(folder)
    fs.create_dir(place, recursive=True)
    # A B id's pairs: at most as many as A has ids.
    best = F.max("n").over(Window.partitionBy("b"))
    key = F.shiftleft("b", 32).bitwiseOR(F.col("a"))
    coded = counted.select(key.alias("key"), (F.col("n") * 2 + F.when(F.col("n") == best, 1).otherwise(0)).alias("coded"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = written(coded, "pair-counts").repartitionByRange(n, "key").sortWithinPartitions("key")

    def work(batches):
        import uuid

        import numpy as np
        import pyarrow as pa

        uri = f"{folder}/{uuid.uuid4().hex}"
        fs, place = filesystem(uri)
        out, heads, total, first, last = None, [], 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy() for c in ("key", "coded")], axis=1).astype("<i8")
            out = out or fs.open_output_stream(place)
            out.write(rows.tobytes())
            heads.append(rows[-total % BLOCK :: BLOCK, 0])
            first, last, total = rows[0, 0] if first is None else first, rows[-1, 0], total + len(rows)
        if out is not None:
            out.write(np.concatenate(heads).astype("<i8").tobytes())
            out.close()
            row = ([int(first)], [int(last)], [uri], [total])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["first", "last", "uri", "pairs"])

    ordered.mapInArrow(work, "first long, last long, uri string, pairs long").write.parquet(f"{folder}/manifest")
    return [tuple(r) for r in spark.read.parquet(f"{folder}/manifest").collect()]


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
FRAGMENT = "row long, number long, ok boolean, closed boolean, a1 binary, b1 binary, body string, a2 binary, b2 binary, " + ", ".join(f"{c} long" for c in NUMBERS)


def _packed(ids) -> bytes:
    from array import array

    return array("q", ids).tobytes()


def _unpacked(raw: bytes) -> tuple:
    from array import array

    out = array("q")
    out.frombytes(raw)
    return tuple(out)


def _row(row: int, number: int, found) -> tuple:
    if found is None:
        return (row, number, False, False, b"", b"", "", b"", b"", 0, 0, 0, 0, 0, 0)
    f, totals = found[:2]
    return (row, number, True, f.closed, *map(_packed, f.head), f.body, *map(_packed, f.tail), *totals)


def _batch(rows: list[tuple]):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in FRAGMENT.split(","))])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _fragments(tokens: DataFrame, path_a: str, path_b: str, files: list[tuple]) -> DataFrame:
    def work(batches):
        aligner = Aligner(worker_tokenizers(path_a, path_b), PairCounts(files))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                columns = batch.slice(at, ROWS)
                part = list(zip(*(columns.column(c).to_pylist() for c in ("row", "number", *TOKEN_COLUMNS))))
                yield _batch([_row(*r[:2], found) for r, found in zip(part, aligner.chunks([r[2:] for r in part]))])

    return tokens.select("row", "number", *TOKEN_COLUMNS).mapInArrow(work, FRAGMENT)


def _composer(batches):
    """Composes neighbours: rows sorted by (row, number // FAN, number)."""
    now = None  # row, group, ok, fragment, totals

    def made():
        row, group, ok, whole, totals = now
        return _row(row, group, (whole, totals) if ok else None)

    for batch in batches:
        out = []
        for row, number, ok, closed, a1, b1, body, a2, b2, *totals in zip(*(c.to_pylist() for c in batch.columns)):
            piece = Fragment(closed, (_unpacked(a1), _unpacked(b1)), body, (_unpacked(a2), _unpacked(b2)))
            if now is not None and (row, number // FAN) == now[:2]:
                now = (*now[:2], now[2] and ok, compose(now[3], piece), [x + y for x, y in zip(now[4], totals)])
                continue
            if now is not None:
                out.append(made())
            now = (row, number // FAN, ok, piece, totals)
        if out:
            yield _batch(out)
    if now is not None:
        yield _batch([made()])


def align(docs: DataFrame, path_a: str, path_b: str, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` columns, ``NUMBERS`` (long) and ``groups`` (``a1,a2|b1;...``, null without tokens) of every row."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.struct(*keep).alias("__kept"), text_or_empty(text).alias("__text"))
    long_ = F.length("__text") >= CHUNK

    def cutter(batches):
        import pyarrow as pa

        kinds = {"long": pa.int64(), "string": pa.string()}
        schema = pa.schema([(c, kinds[k]) for c, k in (x.split() for x in CHUNK_COLUMNS.split(","))])
        for batch in batches:
            for row, whole in zip(batch.column("row").to_pylist(), batch.column("__text").to_pylist()):
                for part in cut(whole):
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((row, *part), schema)], schema=schema)

    # Long texts are cut once, and their chunks, like their kept columns, written with the row's number.
    longs = written(src.filter(long_).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    parts = longs.select("row", "__text").mapInArrow(cutter, CHUNK_COLUMNS)
    chunks = written(parts.repartition(n, "row", "number"), "chunks")
    of_chunks = written(_tokenized(chunks, path_a, path_b, ["row", "number"]), "chunk-tokens")
    short = src.filter(~long_).select("__kept", F.concat(F.lit(" "), "__text").alias("text"), F.lit(0).cast("long").alias("low"), F.lit(None).cast("long").alias("high"))
    of_short = written(_tokenized(short, path_a, path_b, ["__kept"]), "tokens")
    # A long text is without tokens if one of its chunks is.
    fine = of_chunks.join(of_chunks.filter(~F.col("ok")).select("row").distinct(), "row", "left_anti")
    files = pair_files(_counted(of_short.filter("ok").select(*TOKEN_COLUMNS).unionByName(fine.select(*TOKEN_COLUMNS)), path_a, path_b))

    deepest = chunks.agg(F.max("chunks")).first()[0] or 1  # one number
    pieces = _fragments(of_chunks, path_a, path_b, files)
    while deepest > 1:
        group = F.floor(F.col("number") / FAN)
        dealt = pieces.repartition(n, "row", group).sortWithinPartitions("row", "number")
        pieces = written(dealt.mapInArrow(_composer, FRAGMENT), "fragments")
        deepest = -(-deepest // FAN)
    reduced = longs.select("__kept", "row").join(pieces.select("row", "ok", "closed", "a1", "b1", "body", "a2", "b2", *NUMBERS), "row").drop("row")
    whole = reduced.mapInArrow(_finish, _finish_schema(reduced))
    return _direct(of_short, path_a, path_b, files).unionByName(whole).select("__kept.*", *NUMBERS, "groups")


def _finish_schema(df: DataFrame):
    schema = df.select("__kept").schema
    for c in NUMBERS:
        schema = schema.add(c, "long")
    return schema.add("groups", "string")


def _finished(kept, found: list[tuple[Fragment, list[int]] | None]):
    """A batch of whole texts' results."""
    import pyarrow as pa

    texts = [groups_of(f[0]) if f else None for f in found]
    numbers = [f[1] if t is not None else [0] * len(NUMBERS) for f, t in zip(found, texts)]
    columns = [pa.array(c, pa.int64()) for c in zip(*numbers)] or [pa.array([], pa.int64())] * len(NUMBERS)
    return pa.RecordBatch.from_arrays([kept, *columns, pa.array(texts, pa.string())], ["__kept", *NUMBERS, "groups"])


def _direct(tokens: DataFrame, path_a: str, path_b: str, files: list[tuple]) -> DataFrame:
    """Texts of one chunk, in one Python step."""

    def work(batches):
        aligner = Aligner(worker_tokenizers(path_a, path_b), PairCounts(files))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = list(zip(*(part.column(c).to_pylist() for c in TOKEN_COLUMNS)))
                yield _finished(part.column("__kept"), aligner.chunks(rows))

    return tokens.mapInArrow(work, _finish_schema(tokens))


def _finish(batches):
    """Texts whose chunks are composed; one at a time, as they may be very long."""
    for batch in batches:
        for at in range(batch.num_rows):
            one = batch.slice(at, 1)
            columns = (one.column(c).to_pylist()[0] for c in ("ok", "closed", "a1", "b1", "body", "a2", "b2", *NUMBERS))
            ok, closed, a1, b1, body, a2, b2, *totals = columns
            whole = Fragment(closed, (_unpacked(a1), _unpacked(b1)), body, (_unpacked(a2), _unpacked(b2)))
            yield _finished(one.column("__kept"), [(whole, totals) if ok else None])


def op11_alignment(spark, sf_dir):
    import public_tokenizers

    from .common import table

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    out = align(table(spark, sf_dir, "documents"), a, b, [F.col("doc_id")])
    sha = F.coalesce(F.sha2(F.col("groups").cast("binary"), 256), F.lit(""))
    return out.select("doc_id", *NUMBERS, sha.alias("groups_sha256"))
