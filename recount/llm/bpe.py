"""Encoding and decoding by byte-pair merges of the word-end kind (operator 3).

The tokenizer file (a path, a parameter) names the vocabulary, the merges and the special tokens.
``Encoder`` reproduces it exactly: NFC, white-space runs to a space, lower case; special tokens cut
out of the text beforehand; contractions, letter runs, single digits and runs of other characters
as words; a word's bytes, the last with the word-end mark, merged by rank.

1. A first pass counts words over all documents; each task reports those that make up at least
   ``FREQUENT`` of its words (any word as frequent as that overall is so in some task; a task whose
   table is full forgets rare words, as in lossy counting). The reports are summed, and the frequent words with their ids compiled into a shared-suffix automaton
   (``lexicon``), of at most ``LEXICON_WORDS`` words, in a file in the shared folder.
2. Every task maps that file. A word it hasn't met is looked up there; words the automaton does not
   have are merged exactly (``merge_words``), many at a time. Both fill the task's table of pieces,
   which is emptied at ``TABLE_WORDS`` pieces, so its memory is bounded. Which words are frequent
   decides the speed, never the ids.

A piece is what stands between white space; no word and no merge reaches beyond it. Letters and digits
outside the ranges of ``SAFE`` depend on the Unicode version of a library: pieces with such characters, or with a
special token, are encoded by the tokenizers library, the rest of their text through the lexicon. Only texts with a control
character that Python and the library don't both take for white space (``DOUBTFUL``) go to it whole.

Defined cases: a null or empty text has no tokens and decodes to an empty text. Texts of any length
are encoded whole. Repeated rows are encoded each. Empty tables give empty results. Other columns
aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filesystem, shared_dir, text_or_empty
from .lexicon import Lexicon, build

FREQUENT = 2e-5
LEXICON_WORDS = 1 << 16
TABLE_WORDS = 1 << 19
BATCH_CHARS = 1 << 21
# Fixed ranges: control characters of white space, ASCII, Latin-1, Latin Extended A and B.
SAFE = r"\t-\r\x20-\x7e\xa0-ɏ"
DOUBTFUL = r"[\x1c-\x1f]"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    chars = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [chars[b] for b in range(256)]


class _Numbers(dict):
    """Strings numbered in the order in which they are first asked for; those met before cost one look-up."""

    def __missing__(self, text: str) -> int:
        n = self[text] = len(self)
        return n


class Encoder:
    """``ids(texts)``: token ids of texts, as arrays. ``lexicon``: a ``Lexicon``, or None.
    ``by_library``: words that are not in the table are encoded by the tokenizers library."""

    def __init__(self, path: str, lexicon=None, by_library: bool = False):
        import json
        import re
        import unicodedata

        import numpy as np
        from tokenizers import Tokenizer

        self.path, self.lexicon, self.by_library = path, lexicon, by_library
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = text
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.final = np.array([vocab[c + self.end] for c in alphabet], np.int64)
        pairs = [(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs] + [0], np.int64)
        self.none = len(pairs)  # the rank of pairs that don't merge

        def chars(kinds):
            return "".join(re.escape(c) for c in map(chr, range(0x250)) if unicodedata.category(c)[0] in kinds and re.match(f"[{SAFE}]", c))

        letters, digits = chars("L"), chars("N")
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\s{letters}{digits}]+")
        self.unsafe = re.compile(f"[^{SAFE}]|" + "|".join(map(re.escape, self.special)))
        self.doubtful = re.compile(DOUBTFUL)
        if len(self.tokens) > 1 << 16:
            raise ValueError("token ids above 65535 need a wider lexicon file")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._clear()

    def _clear(self):
        import numpy as np

        # Pieces, and the words they consist of: where their ids begin in a pool, and how many.
        self.table = _Numbers()
        self.first, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)
        self.word_table = _Numbers()
        self.word_first, self.word_size, self.word_pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def merge_words(self, flat, starts, sizes):
        """Exact merges of words (bytes, end to end): token ids end to end, and how many per word.
        In each round every word merges all occurrences of its pair of least rank."""
        import numpy as np

        tok = self.inner[flat]
        last = starts + sizes - 1
        tok[last] = self.final[flat[last]]
        word = np.repeat(np.arange(len(starts)), sizes)

        def ranks(a, b):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            return np.where(self.keys[at] == key, self.ranks[at], self.none)

        r = np.full(len(tok), self.none, np.int64)
        inside = np.flatnonzero(word[1:] == word[:-1])
        r[inside] = ranks(tok[inside], tok[inside + 1])
        out_tok, out_word = [], []
        while len(tok):
            begins = np.ones(len(tok), bool)
            begins[1:] = word[1:] != word[:-1]
            first = np.flatnonzero(begins)
            least = np.minimum.reduceat(r, first)
            n = np.diff(np.append(first, len(tok)))
            open_ = np.repeat(least < self.none, n)
            if not open_.all():
                out_tok.append(tok[~open_])
                out_word.append(word[~open_])
                tok, word, r, least = tok[open_], word[open_], r[open_], np.repeat(least, n)[open_]
                if not len(tok):
                    break
            else:
                least = np.repeat(least, n)
            hit = r == least
            # Of overlapping occurrences (aaa), from the left every other one.
            both = np.flatnonzero(hit[1:] & hit[:-1])
            if len(both):
                at = np.flatnonzero(hit)
                run = np.ones(len(at), bool)
                run[1:] = at[1:] != at[:-1] + 1
                begin = np.maximum.accumulate(np.where(run, at, 0))
                hit[at[(at - begin) % 2 == 1]] = False
            at = np.flatnonzero(hit)
            tok[at] = self.made[r[at]]
            keep = np.ones(len(tok), bool)
            keep[at + 1] = False
            new = np.cumsum(keep) - 1
            tok, word, r = tok[keep], word[keep], r[keep]
            at = new[at]
            near = np.unique(np.concatenate((at, at[at > 0] - 1)))
            r[near] = self.none
            near = near[near + 1 < len(tok)]
            near = near[word[near] == word[near + 1]]
            r[near] = ranks(tok[near], tok[near + 1])
        tok = np.concatenate(out_tok) if out_tok else np.zeros(0, np.int64)
        word = np.concatenate(out_word) if out_word else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return tok[order], np.bincount(word, minlength=len(starts))

    def pieces(self, text: str) -> list[str] | None:
        """The text's pieces, in lower case unless a piece is the library's to encode; None if the whole text is."""
        if not self.unsafe.search(text):
            return text.lower().split()
        if self.doubtful.search(text):
            return None
        return [p if self.unsafe.search(p) else p.lower() for p in text.split()]

    def _library_ids(self, text: str) -> list[int]:
        # The library's call without offsets, which nobody asks for here, takes half the time.
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _by_library(self, text: str):
        import numpy as np

        return np.array(self._library_ids(text), np.uint16)

    def _learn(self, new: list[str]):
        """Adds pieces to the table."""
        from itertools import islice

        import numpy as np

        table, numbers, counts, foreign = self.word_table, [], [], {}
        known = len(table)
        odd = self.unsafe.search(" ".join(new))  # mostly none: one search, not one per piece
        for i, piece in enumerate(new):
            if odd and self.unsafe.search(piece):
                foreign[i] = self._by_library(piece)
                counts.append(0)
                continue
            found = self.words.findall(piece)
            counts.append(len(found))
            numbers += map(table.__getitem__, found)
        if len(table) > known:
            self._learn_words(list(islice(table, known, None)))
        word = np.array(numbers, np.int64)
        n = self.word_size[word]
        ids = self.word_pool[np.repeat(self.word_first[word], n) + _within(n)]
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum(counts)]
        size = np.diff(ends, prepend=0)
        first = ends - size
        extra = len(ids)
        for i, x in foreign.items():
            first[i], size[i] = extra, len(x)
            extra += len(x)
        self.first = np.concatenate((self.first, first + len(self.pool)))
        self.size = np.concatenate((self.size, size))
        self.pool = np.concatenate([self.pool, ids, *foreign.values()])

    def _learn_words(self, new: list[str]):
        """Adds words to the table: from the lexicon, or merged."""
        import numpy as np

        raw = [w.encode() for w in new]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.cumsum(sizes) - sizes
        number = self.lexicon.numbers(flat, starts, sizes) if self.lexicon else np.full(len(new), -1)
        absent = np.flatnonzero(number < 0)
        n = np.zeros(len(new), np.int64)
        pool = np.zeros(0, np.int64)
        where = np.zeros(len(new), np.int64)
        if len(absent):
            if self.by_library:
                pool, k = self.library_words([new[i] for i in absent.tolist()])
            else:
                take = np.repeat(starts[absent], sizes[absent]) + _within(sizes[absent])
                pool, k = self.merge_words(flat[take], np.cumsum(sizes[absent]) - sizes[absent], sizes[absent])
            n[absent], where[absent] = k, np.cumsum(k) - k
        found = np.flatnonzero(number >= 0)
        if len(found):
            a, b = self.lexicon.first_id[number[found]].astype(np.int64), self.lexicon.first_id[number[found] + 1].astype(np.int64)
            n[found], where[found] = b - a, len(pool) + np.cumsum(b - a) - (b - a)
            pool = np.concatenate((pool, self.lexicon.ids[np.repeat(a, b - a) + _within(b - a)]))
        self.word_first = np.concatenate((self.word_first, where + len(self.word_pool)))
        self.word_size = np.concatenate((self.word_size, n))
        self.word_pool = np.concatenate((self.word_pool, pool.astype(np.uint16)))

    def library_words(self, new: list[str]):
        """As ``merge_words``, by the library: the words with spaces between are one text, in which
        every word ends with a word-end token."""
        import numpy as np

        if not hasattr(self, "ends"):
            self.ends = np.array([t.endswith(self.end) for t in self.tokens])
        tok = np.array(self._library_ids(" ".join(new)), np.int64)
        n = np.diff(np.flatnonzero(self.ends[tok]), prepend=-1)
        if len(n) != len(new) or n.sum() != len(tok):
            raise ValueError("the library splits these words otherwise")
        return tok, n

    def ids_of_words(self, words: list[str]) -> list[list[int]]:
        self._clear()
        if words:
            self._learn_words(words)
        out = [self.word_pool[a : a + n].tolist() for a, n in zip(self.word_first.tolist(), self.word_size.tolist())]
        self._clear()
        return out

    def flat(self, texts: list[str]):
        """The ids of texts end to end (uint16), and how many of each."""
        import numpy as np

        if len(self.table) > TABLE_WORDS:
            self._clear()
        table, whole, numbers, counts = self.table, {}, [], []
        for i, text in enumerate(texts):
            found = self.pieces(text)
            if found is None:
                whole[i] = self._by_library(text)
                found = []
            counts.append(len(found))
            numbers += map(table.__getitem__, found)
        if len(table) > len(self.first):
            from itertools import islice

            self._learn(list(islice(table, len(self.first), None)))
        piece = np.fromiter(numbers, np.int64, len(numbers))
        n = self.size[piece]
        ids = self.pool[np.repeat(self.first[piece], n) + _within(n)]
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum(counts)] if counts else np.zeros(0, np.int64)
        sizes = np.diff(ends, prepend=0)
        if whole:
            parts = np.split(ids, ends[:-1])
            for i, x in whole.items():
                parts[i], sizes[i] = x, len(x)
            ids = np.concatenate(parts)
        return ids, sizes

    def ids(self, texts: list[str]):
        """One uint16 array of ids per text."""
        import numpy as np

        ids, sizes = self.flat(texts)
        return np.split(ids, np.cumsum(sizes)[:-1]) if texts else []

    def decode(self, ids) -> str:
        """As the file, which names no decoder: the tokens with spaces between."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def _within(sizes):
    """0, 1, ... within each of the consecutive stretches of these sizes."""
    import numpy as np

    total = np.cumsum(sizes)
    return np.arange(int(total[-1]) if len(sizes) else 0) - np.repeat(total - sizes, sizes)


def worker_encoder(path: str, lexicon_uri: str | None = None, by_library: bool = False):
    """The worker process's encoder of a tokenizer and lexicon, kept from task to task."""
    import sys
    import types

    kept = sys.modules.setdefault("_recount_worker", types.ModuleType("_recount_worker")).__dict__
    key = (path, lexicon_uri, by_library)
    if kept.get("key") != key:
        import numpy as np

        lexicon = None
        if lexicon_uri:
            fs, place = filesystem(lexicon_uri)
            local = fs.type_name == "local"
            lexicon = Lexicon(np.memmap(place, np.uint8, "r") if local else fs.open_input_file(place).read())
        kept["encoder"], kept["key"] = Encoder(path, lexicon, by_library), key
    return kept["encoder"]


def texts_in(column, chars: int = BATCH_CHARS):
    """Slices (first row, texts) of an Arrow string column, of about ``chars`` characters."""
    at, texts, size = 0, [], 0
    for i, x in enumerate(column.to_pylist()):
        texts.append(x)
        size += len(x)
        if size >= chars:
            yield at, texts
            at, texts, size = i + 1, [], 0
    if texts:
        yield at, texts


def build_lexicon(docs: DataFrame, path: str, text: str = "text") -> str:
    """Counts words over all of ``docs`` and writes the automaton of the frequent ones; its URI."""
    src = docs.select(text_or_empty(text).alias("__text"))

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        encoder, counts, pieces = Encoder(path), Counter(), Counter()
        total = 0

        def add():
            """The words of the pieces counted so far."""
            nonlocal total
            for p, n in pieces.items():
                if not encoder.unsafe.search(p):
                    for w in encoder.words.findall(p):
                        counts[w] += n
                        total += n
            pieces.clear()

        for batch in batches:
            for _, texts in texts_in(batch.column("__text")):
                for t in texts:
                    pieces.update(encoder.pieces(t) or ())
                if len(pieces) > TABLE_WORDS:
                    add()
                if len(counts) > TABLE_WORDS:  # rare words only: none near the threshold is lost for long
                    counts = Counter({w: n for w, n in counts.items() if n >= FREQUENT * total / 2})
        add()
        often = [(w, n) for w, n in counts.items() if n >= FREQUENT * total]
        if often:
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in often]), pa.array([n for _, n in often], pa.int64())], ["word", "n"])

    reports = src.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # Bounded: 65,536 words at most reach the driver, whatever the corpus.
    top = sorted(r["word"] for r in reports.orderBy(F.desc("n"), "word").limit(LEXICON_WORDS).collect())
    raw = sorted(w.encode() for w in top)
    ids = Encoder(path).ids_of_words([w.decode() for w in raw])
    uri = shared_dir(docs.sparkSession, "lexicon")
    fs, place = filesystem(uri)
    fs.create_dir(place, recursive=True)
    with fs.open_output_stream(f"{place}/lexicon.bin") as f:
        f.write(build(raw, ids))
    return f"{uri}/lexicon.bin"


def encoded(docs: DataFrame, path: str, lexicon_uri: str | None, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` columns, ``ids`` (binary: little-endian unsigned 32-bit), ``decoded`` string."""
    src = docs.select(*keep, text_or_empty(text).alias("__text"))
    kept = src.drop("__text").schema
    names = kept.fieldNames()
    schema = kept.add("ids", "binary").add("decoded", "string")

    def work(batches):
        import pyarrow as pa

        encoder = worker_encoder(path, lexicon_uri)
        for batch in batches:
            for at, texts in texts_in(batch.column("__text")):
                ids = encoder.ids(texts)
                cols = [pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(map(encoder.decode, ids), pa.string())]
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *cols], [*names, "ids", "decoded"])

    return src.mapInArrow(work, schema)


def op3_bpe(spark, sf_dir):
    import public_tokenizers

    from .common import table

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents")
    out = encoded(docs, path, build_lexicon(docs, path), [F.col("doc_id")])
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
