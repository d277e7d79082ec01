"""Document fingerprints by consistent weighted sampling (operator 13, DataFrame functions only).

A text's terms are its words, weighted by how often each occurs. For sample i of a term, three
numbers are drawn from hashes of (term, i): r and c, gamma of shape 2, and b, uniform. The weight S is
quantised on the term's own grid, ``t = floor(ln S / r + b)``, and the term's value is
``ln a = ln c - r (t - b) - r``; the least value over the terms is the sample. Two texts share
sample i with a probability of the generalised Jaccard similarity of their weights, ``sum min / sum
max`` (Ioffe's sampling). Term and grid point are what a sample stands for; its value is a function of
both, to the last bit, so 16 bits of the value's hash stand for the sample in the fingerprint.

1. ``terms``: within one projection a text's word hashes are sorted and the ends of equal runs exploded:
   a row per distinct word, nothing shuffled.
2. ``signatures``: ``SAMPLES`` minima per key. The rows of a key lie in one task already
   (they come from its one row), so the aggregate needs no exchange either. The least of a text of W words
   is exponential of rate W, so values above ``REACH / W`` hardly ever matter: a product of the uniform
   numbers bounds a value from below, and only terms within that bound have their logarithms taken. If the
   least value found lies within ``REACH / W``, no other can be less; a text of which that does not hold (one
   sample in e**24) is judged again with all its terms.
3. ``with_edits``: documents are numbered by id (``surrogate_id``), which names each one's successor. A
   document's text is exchanged once, by key; the first part of the successor's text comes to it by
   a second, smaller exchange, and both joins read the one exchange of texts.

Defined cases: null texts are empty. A text without words has the empty fingerprint; two of these have
likeness 1, one and another 0. Rows equal in id and text are one document: each gets the same row, and their
successor is the next other document. Documents of one id are in the order of their texts' hashes; null ids come
last. A table of one document succeeds itself. Empty tables give empty results. Texts of any length are
read whole. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.surrogate import surrogate_id
from .common import text_or_empty, words, written

SAMPLES = 32  # a multiple of four
REACH = 24.0
LAST = (1 << 63) - 1  # the place of null ids
KEY = ["__k", "__t1", "__t2"]


def terms(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, ``total`` (words of the text), ``term`` (the hash of a word) and ``weight`` (its
    count): a row per distinct word of the text, or one of nulls if there is none."""
    hashed = df.select(*keep, F.array_sort(F.transform(words(F.col(text)), lambda w: F.xxhash64(w))).alias("__h"))
    ends = F.filter(
        F.sequence(F.lit(1), F.size("__h")),
        lambda i: (i == F.size("__h")) | (F.get("__h", i - 1) != F.get("__h", i)),
    )
    runs = hashed.select("*", F.when(F.size("__h") > 0, ends).alias("__ends"), F.size("__h").alias("total"))
    exploded = runs.select(*keep, "total", "__h", "__ends", F.posexplode_outer("__ends").alias("__run", "__end"))
    begin = F.when(F.col("__run") == 0, 0).otherwise(F.get("__ends", F.col("__run") - 1))
    return exploded.select(*keep, "total", F.get("__h", F.col("__end") - 1).alias("term"), (F.col("__end") - begin).alias("weight"))


def _key(i: int) -> int:
    """A 64-bit constant for the i-th hash function, signed."""
    x = (i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    x = (x ^ x >> 31) * 0xD6E8FEB86659FD93 & (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _uniform(x: Column, high: bool) -> Column:
    """A number within (0, 1) from the upper or lower 32 bits of a hash."""
    half = F.shiftrightunsigned(x, 32) if high else x.bitwiseAND(F.lit(0xFFFFFFFF))
    return (half.cast("double") + 0.5) * F.lit(2.0**-32)


def sample(term: Column, log_weight: Column, i: int, limit: Column | None = None) -> Column:
    """ln a of sample ``i``, a function of the term and its weight's grid point alone. Null where
    ``a * weight`` is above ``limit`` by its lower bound ``(1 - v) exp(-r)``, c being ``-ln v``."""
    x, y, z = (F.xxhash64(term.bitwiseXOR(F.lit(_key(3 * i + j)))) for j in range(3))
    u, v, b = _uniform(x, True) * _uniform(x, False), _uniform(y, True) * _uniform(y, False), _uniform(z, True)
    r, c = -F.ln(u), -F.ln(v)
    t = F.floor(log_weight / r + b).cast("double")
    # Of weight 1, t is 0: the same formula, shorter.
    value = F.when(log_weight == 0, F.ln(c) - r * (1.0 - b)).otherwise(F.ln(c) - r * (t + 1.0 - b))
    return value if limit is None else F.when((1.0 - v) * u <= limit, value)


def signatures(
    df: DataFrame, text: str, keys: Sequence[str], keep: Sequence[str] = (), samples: int = SAMPLES, reach: float | None = REACH
) -> DataFrame:
    """Per distinct ``keys``: the greatest value of each ``keep`` column (numbers) and ``fingerprint``: two bytes per sample,
    none for a text without words; null if the terms within ``reach`` do not settle it (None: all terms are taken)."""
    weights = terms(df, text, [*keys, *keep])
    inputs = weights.select("*", F.ln("weight").alias("__lw"), (F.lit((reach or 0) * (1 + 1e-9)) * F.col("weight") / F.col("total")).alias("__limit"))
    limit = None if reach is None else F.col("__limit")
    least = [F.min(sample(F.col("term"), F.col("__lw"), i, limit)).alias(f"__s{i}") for i in range(samples)]
    found = inputs.groupBy(*keys).agg(F.max("total").alias("__total"), *[F.max(c).alias(c) for c in keep], *least)
    part = lambda i: F.shiftleft(F.xxhash64(f"__s{i}").bitwiseAND(F.lit(0xFFFF)), 48 - i % 4 * 16)
    fours = [part(i).bitwiseOR(part(i + 1)).bitwiseOR(part(i + 2)).bitwiseOR(part(i + 3)) for i in range(0, samples, 4)]
    digits = F.concat(*[F.lpad(F.hex(x), 16, "0") for x in fours])
    settled = F.lit(True)
    if reach is not None:
        most = F.greatest(*[F.coalesce(f"__s{i}", F.lit(float("inf"))) for i in range(samples)], F.lit(float("-inf")))
        settled = most <= F.ln(F.lit(reach * (1 - 1e-9)) / F.col("__total"))
    none = F.unhex(F.lit(""))
    fingerprint = F.when(F.col("__total") == 0, none).when(settled, F.unhex(digits))
    return found.select(*keys, *keep, fingerprint.alias("fingerprint"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two fingerprints."""
    equal = F.filter(
        F.sequence(F.lit(0), F.lit(samples - 1)),
        lambda i: F.substring(a, i * 2 + 1, F.lit(2)) == F.substring(b, i * 2 + 1, F.lit(2)),
    )
    return F.when(a == b, 1.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(F.size(equal) / F.lit(float(samples)))


def _documents(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``KEY`` (never null), ``__id``, ``__text``."""
    t, id_ = text_or_empty(text), F.col(f"`{id_col}`").cast("long")
    return docs.select(
        F.coalesce(id_, F.lit(LAST)).alias("__k"),
        F.xxhash64(t, id_.isNull()).alias("__t1"),
        F.hash(t).alias("__t2"),
        id_.alias("__id"),
        t.alias("__text"),
    )


def successors(src: DataFrame) -> DataFrame:
    """Per distinct document: ``KEY``, its successor's key (``__nk, __nt1, __nt2``) and ``__n``, its length."""
    places = src.groupBy(*KEY).agg(F.first(F.length("__text")).alias("__n"))
    numbered = surrogate_id(places, KEY, "__no")
    last = numbered.agg(F.max("__no")).first()[0] or 0  # one number
    after = numbered.select(F.col("__no").alias("__place"), *[F.col(c).alias(c.replace("__", "__n")) for c in KEY])
    at = F.when(F.col("__no") == last, 1).otherwise(F.col("__no") + 1)
    return written(numbered.join(after, at == F.col("__place")).drop("__no", "__place"), "successors")


def with_edits(src: DataFrame, next_: DataFrame) -> DataFrame:
    """``KEY``, ``__text`` and ``__edited``: the last ``n div 4`` code points replaced by the successor's first as many."""
    distinct = src.groupBy(*KEY).agg(F.first("__text").alias("__text"))
    wanted = next_.select(*[F.col(c).alias(c.replace("__", "__p")) for c in KEY], *[F.col(c.replace("__", "__n")).alias(c) for c in KEY], "__n")
    quarter = F.floor(F.col("__n") / 4).cast("int")
    first = wanted.join(distinct, KEY).select(
        *[F.col(c.replace("__", "__p")).alias(c) for c in KEY], "__n", F.substring("__text", F.lit(1), quarter).alias("__first")
    )
    kept = F.substring("__text", F.lit(1), F.col("__n") - quarter)
    return distinct.join(first, KEY).select(*KEY, "__text", F.concat(kept, "__first").alias("__edited"))


_PARTS = ["__e0", "__e1", "__e2", "__e3"]  # a SHA-256 digest as four numbers, which an aggregate can keep


def _prints(both: DataFrame, samples: int, reach: float | None) -> DataFrame:
    """``KEY``, the edited text's digest (hex) and the fingerprints ``__a`` of the text, ``__b`` of the edited one."""
    found = signatures(both, "__body", [*KEY, "__which"], _PARTS, samples, reach)
    digest = F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in _PARTS]))
    of = lambda which: F.max(F.when(F.col("__which") == which, F.col("fingerprint")))
    return found.groupBy(*KEY).agg(F.max(digest).alias("__digest"), of(0).alias("__a"), of(1).alias("__b"))


def edit_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", samples: int = SAMPLES, reach: float = REACH
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_chars``, ``edited_sha256``, the fingerprints (hex) of its text and of
    its edited text, and the likeness of the former to the latter and to its successor's."""
    src = _documents(docs, id_col, text)
    next_ = successors(src)
    edits = with_edits(src, next_)
    sha = F.sha2(F.col("__edited").cast("binary"), 256)
    parts = [F.conv(F.substring("__sha", 16 * j + 1, 16), 16, -10).cast("long").alias(c) for j, c in enumerate(_PARTS)]
    rows = edits.select("*", sha.alias("__sha")).select(*KEY, "__text", "__edited", *parts)
    both = rows.select(*KEY, *_PARTS, F.expr("stack(2, 0, __text, 1, __edited) as (__which, __body)"))
    prints = written(_prints(both, samples, reach), "fingerprints")
    open_ = prints.filter(F.col("__a").isNull() | F.col("__b").isNull())
    if not open_.isEmpty():
        again = _prints(both.join(open_.select(*KEY), KEY, "left_semi"), samples, None)
        prints = written(prints.dropna(subset=["__a", "__b"]).unionByName(again), "fingerprints")
    other = prints.select(*[F.col(c).alias(c.replace("__", "__n")) for c in KEY], F.col("__a").alias("__c"))
    judged = next_.join(other, [c.replace("__", "__n") for c in KEY]).select(*KEY, "__n", "__c").join(prints, KEY)
    results = judged.select(
        *KEY,
        F.col("__n").cast("long").alias("n_chars"),
        F.col("__digest").alias("edited_sha256"),
        F.lower(F.hex("__a")).alias("fingerprint"),
        F.lower(F.hex("__b")).alias("edited_fingerprint"),
        likeness(F.col("__a"), F.col("__b"), samples).alias("near_edited"),
        likeness(F.col("__a"), F.col("__c"), samples).alias("near_next"),
    )
    return src.select(*KEY, F.col("__id").alias(id_col)).join(results, KEY).drop(*KEY)


def op13_weighted_sampling(spark, sf_dir):
    from .common import table

    return edit_fingerprints(table(spark, sf_dir, "documents"))
