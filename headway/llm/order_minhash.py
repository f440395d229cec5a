"""Order MinHash fingerprints in DataFrame expressions alone.

A text is cut at white space into words, and where a script writes none or a string goes on
without a space, into single characters or pieces; k successive words are a k-mer, and equal
k-mers are told apart by their occurrence number. One hash deals these out to bins; a bin selects its
least ones, puts them back into text order and hashes them as a tuple. Two texts agree in
a bin if they share its least k-mers in the same order, so the share of bins that agree
follows the edit distance and not only the words. Bins without k-mers say nothing.

All of it is array functions within a row: sorting brings equal k-mers together, and the
occurrence number is the distance to the first of them, found by halving.

Defined results: null texts are empty ones. Texts with fewer words than k are one k-mer,
texts without any word too. Texts of any length are taken whole: a place has as many bits
as the longest string has words.
The next document after one is that with the next smaller doc_id, and after the last the
first; null ids come last, repeated ids are ordered by text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.ordering import with_range

WORDS, BINS, LEAST = 3, 64, 2
_PLACE = 30  # bits of a position
_HASH = 27  # bits of an element's hash within its bin
_LOW = (1 << _PLACE) - 1
_HIGH = (1 << (63 - _PLACE)) - 1
# Scripts without spaces between words: a character is a word.
_SINGLE = "".join(
    rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
)
# Strings without a space are cut every 24 characters.
WORD = rf"[{_SINGLE}]|[^\s{_SINGLE}]{{1,24}}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def order_minhash(text: Column) -> Column:
    """The fingerprint as an array of longs: bin in the high bits, tuple hash below."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return _let(words, lambda words: _let(_kmers(words), _tuples_of))


def _kmers(words: Column) -> Column:
    """Sorted (hash, place) of all k-mers."""

    def packed(i: Column) -> Column:
        parts = [F.get(words, i + j) for j in range(WORDS)]
        key = F.xxhash64(*parts).bitwiseAND(_long(_HIGH))
        return F.shiftleft(key, _PLACE).bitwiseOR(i.cast("long").bitwiseAND(_long(_LOW)))

    last = F.greatest(F.size(words) - WORDS, F.lit(0))
    return F.sort_array(F.transform(F.sequence(F.lit(0), last), packed))


def _tuples_of(kmers: Column) -> Column:
    def same(x: Column, i: Column) -> Column:
        return F.shiftright(F.get(kmers, i), _PLACE) == F.shiftright(x, _PLACE)

    def occurrence(x: Column, i: Column) -> Column:
        steps = F.array(*(F.lit(1 << b) for b in range(_PLACE - 1, -1, -1)))
        back = F.aggregate(
            steps,
            F.lit(0),
            lambda d, step: F.when((i >= d + step) & same(x, i - d - step), d + step).otherwise(d),
        )
        return F.when((i > 0) & same(x, i - 1), back).otherwise(F.lit(0))

    def element(x: Column, i: Column) -> Column:
        key = F.xxhash64(F.shiftright(x, _PLACE), occurrence(x, i))
        ordered = F.shiftleft(key.bitwiseAND(_long(_HIGH)), _PLACE)  # bin and hash
        return ordered.bitwiseOR(x.bitwiseAND(_long(_LOW)))

    return _let(F.sort_array(F.transform(kmers, element)), _selected)


def _bin(x: Column) -> Column:
    return F.shiftright(x, _PLACE + _HASH)


def _selected(elements: Column) -> Column:
    """The least ones of each bin, as tuples in text order."""
    least = F.filter(
        elements, lambda x, i: (i < LEAST) | (_bin(F.get(elements, i - LEAST)) != _bin(x))
    )

    def tuples(few: Column) -> Column:
        def of(x: Column, i: Column) -> Column:
            follows = (i > 0) & (_bin(F.get(few, i - 1)) == _bin(x))
            other = F.get(few, i + 1)
            pair = other.isNotNull() & (_bin(other) == _bin(x))
            mine, its = F.shiftright(x, _PLACE), F.shiftright(other, _PLACE)
            before = x.bitwiseAND(_long(_LOW)) < other.bitwiseAND(_long(_LOW))
            ordered = F.when(before, F.xxhash64(mine, its)).otherwise(F.xxhash64(its, mine))
            own = F.when(pair, ordered).otherwise(F.xxhash64(mine))
            value = F.shiftleft(_bin(x), 32).bitwiseOR(own.bitwiseAND(_long((1 << 32) - 1)))
            return F.when(~follows, value)

        return F.filter(F.transform(few, of), lambda v: v.isNotNull())

    return _let(least, tuples)


def fingerprint_text(fingerprint: Column) -> Column:
    """Ten hexadecimal digits for each bin that has k-mers."""
    digits = F.transform(fingerprint, lambda v: F.lower(F.lpad(F.hex(v), 10, "0")))
    return F.array_join(digits, "")


def likeness(one: Column, other: Column) -> Column:
    """Share of bins that agree, among those where either text has k-mers."""
    bins = [F.transform(x, lambda v: F.shiftright(v, 32)) for x in (one, other)]
    return F.size(F.array_intersect(one, other)) / F.size(F.array_union(*bins))


def fingerprint_documents(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text, fingerprint, edited, edited_fingerprint, next_fingerprint.

    Documents are dealt out by ranges of doc_id, once; within a range the next document is
    the next row. Only the first document of each range, a bounded number, is handed to the
    range before it.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    placed = with_range(docs, "doc_id", "part", ranges)
    heads = _heads(placed)
    own = placed.repartition("part").withColumn("fingerprint", order_minhash(F.col("text")))
    order = Window.partitionBy("part").orderBy(F.col("doc_id").desc(), F.col("text").desc())
    led = own.select(
        "*",
        F.lead("text").over(order).alias("lead_text"),
        F.lead("fingerprint").over(order).alias("lead_fingerprint"),
    )
    joined = led.join(
        heads, (F.col("part") == F.col("head_part")) & F.col("lead_text").isNull(), "left"
    )
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    following = F.coalesce("lead_text", "head_text")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half), F.substring(following, F.lit(1), half)
    )
    return (
        joined.select(
            "doc_id",
            "text",
            "fingerprint",
            edited.alias("edited"),
            F.coalesce("lead_fingerprint", "head_fingerprint").alias("next_fingerprint"),
        )
        .withColumn("edited_fingerprint", order_minhash(F.col("edited")))
    )


def _heads(placed: DataFrame) -> DataFrame:
    """For each range: text and fingerprint of the document that follows its last one."""
    first = placed.groupBy("part").agg(F.max("doc_id").alias("first_id"))
    rows = placed.join(
        first.select(F.col("part").alias("first_part"), "first_id"),
        (F.col("part") == F.col("first_part")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
    )
    texts = rows.groupBy("part").agg(F.max("text").alias("text"))
    # Only the numbers of the ranges are ordered together; texts join them after that.
    down = Window.orderBy(F.col("part").desc())
    everything = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("part").over(down), F.first("part").over(everything))
    follows = first.select(F.col("part").alias("head_part"), following.alias("part"))
    heads = follows.join(texts, "part").select("head_part", F.col("text").alias("head_text"))
    return heads.withColumn("head_fingerprint", order_minhash(F.col("head_text")))
