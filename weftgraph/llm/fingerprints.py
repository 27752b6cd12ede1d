"""Order MinHash fingerprints, in DataFrame operations alone.

A text is cut into pieces: words, and longer runs at places chosen by their characters, so that a
character put in moves only the cuts around it. Its k-mers are ``k`` pieces in a row, numbered by occurrence, so that the third time counts as something else
than the first. Hashing (k-mer, number) deals the k-mers into ``slots``; each slot keeps the
``keep`` smallest, puts them back into the order of the text and hashes that tuple. Two texts
agree in a slot if they share its smallest k-mers *in the same order*, which falls with edit
distance and not only with the share of common k-mers. The upper 36 bits of a hash tell k-mers apart.

The arrays stay inside one row's expression: nothing is exploded and a document needs no shuffle.
A lambda over a one-element array binds a value, so that it is computed once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.ordered import numbered
from weftgraph.session import cut_lineage


# 2**28 k-mers of one text have places of their own, which leaves 36 bits to tell hashes apart.
_PLACE_BITS = 28

_SPACE = r"\x20\x09-\x0D"
# Long runs are cut after these: one in eight of the printable ASCII characters, and for other
# scripts one in sixteen of the bytes that follow a first byte in UTF-8.
_ASCII_ENDS = r"'/7?GOW_gow"
_BYTE_ENDS = r"\x8B\x9B\xAB\xBB"


@dataclass(frozen=True)
class Shape:
    """``slots`` is a power of two. Words of up to ``piece`` characters are one piece, and no piece is longer."""

    k: int = 2
    piece: int = 12
    slots: int = 64
    keep: int = 2


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _pieces(text: Column, piece: int) -> Column:
    """The pieces of a text in order.

    ASCII stretches of a run longer than ``piece`` are cut by characters, the others by bytes of their
    UTF-8 form. Where no place is chosen for ``piece`` characters, a piece ends there.
    """
    ascii_ = rf"[^{_SPACE}{_ASCII_ENDS}\x80-\x{{10FFFF}}]"
    first = "|".join(
        [
            rf"[^{_SPACE}]{{1,{piece}}}+(?![^{_SPACE}])",
            rf"{ascii_}{{0,{piece - 1}}}+[{_ASCII_ENDS}]",
            rf"{ascii_}{{1,{piece}}}+",
            r"[^\x00-\x7F]++",
        ]
    )
    size = 3 * piece
    second = rf"[^{_BYTE_ENDS}]{{0,{size - 1}}}+[{_BYTE_ENDS}]|[^{_BYTE_ENDS}]{{1,{size}}}+"
    long_ = lambda p: F.length(p) > piece
    by_bytes = lambda p: F.regexp_extract_all(F.decode(F.encode(p, "UTF-8"), "ISO-8859-1"), F.lit(second), F.lit(0))
    found = F.regexp_extract_all(text, F.lit(first), F.lit(0))
    cut = F.flatten(F.transform(found, lambda p: F.when(long_(p), by_bytes(p)).otherwise(F.array(p))))
    # Only a stretch outside ASCII can be longer still; most texts hold none.
    return F.when(text.rlike(rf"[^\x00-\x7F]{{{piece + 1}}}"), cut).otherwise(found)


def _kmers(pieces: Column, k: int) -> Column:
    """Hashes of k pieces in a row; fewer pieces are one k-mer, none are none."""
    n = F.size(pieces)
    gram = lambda x, i: F.xxhash64(x, *(F.get(pieces, i + d) for d in range(1, k)))
    return F.when(n >= k, F.transform(F.slice(pieces, F.lit(1), n - (k - 1)), gram)).otherwise(
        F.transform(F.filter(F.array(pieces), lambda p: F.size(p) > 0), lambda p: F.xxhash64(p))
    )


def _packed(hash_: Column, place: Column) -> Column:
    """A hash's upper bits and a place in one number: plain numbers sort faster than structs."""
    return F.shiftleft(F.shiftrightunsigned(hash_, _PLACE_BITS), _PLACE_BITS).bitwiseOR(place.cast("long"))


def _hash_part(x: Column) -> Column:
    return F.shiftright(x, _PLACE_BITS)


def _place(x: Column) -> Column:
    return x.bitwiseAND((1 << _PLACE_BITS) - 1)


def _first_equal(ordered: Column, hash_: Column, last: Column) -> Column:
    """The first index up to ``last`` with this hash, by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(last + 1)).cast("int"))

    def halve(ends: Column, _: Column) -> Column:
        middle = F.floor((ends.lo + ends.hi) / 2).cast("int")
        above = _hash_part(F.get(ordered, middle)) >= hash_
        done = ends.lo >= ends.hi
        return F.struct(
            F.when(done | above, ends.lo).otherwise(middle + 1).cast("int").alias("lo"),
            F.when(~done & above, middle).otherwise(ends.hi).cast("int").alias("hi"),
        )

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), last.cast("int").alias("hi")), halve, lambda e: e.hi)


def _numbered(kmers: Column) -> Column:
    """Hash of (k-mer, occurrence number) and place of each k-mer, packed."""

    def number(ordered: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            equal = lambda d: (i >= d) & (_hash_part(F.get(ordered, i - d)) == _hash_part(x))
            nth = F.when(~equal(1), 0).when(~equal(2), 1).otherwise(i - _first_equal(ordered, _hash_part(x), i))
            return _packed(F.xxhash64(_hash_part(x), nth.cast("int")), _place(x))

        return F.transform(ordered, one)

    return _let(F.sort_array(F.transform(kmers, _packed)), number)


def signature(text: Column, shape: Shape = Shape()) -> Column:
    """The slots that hold a k-mer, each as slot * 2**32 + code; equal texts have equal arrays."""
    pieces = _pieces(text, shape.piece)
    bits = 64 - (shape.slots.bit_length() - 1)
    slot = lambda x: F.shiftright(x, bits)
    width = 64 - _PLACE_BITS

    def tuples(items: Column) -> Column:
        new = F.transform(items, lambda x, i: F.when((i > 0) & (slot(F.get(items, i - 1)) == slot(x)), -1).otherwise(i))

        def code(i: Column) -> Column:
            own = F.filter(F.slice(items, i + 1, F.lit(shape.keep)), lambda y: slot(y) == slot(F.get(items, i)))
            # Back into the order of the text: the place first, then the hash.
            by_place = F.sort_array(F.transform(own, lambda y: F.shiftleft(_place(y), width).bitwiseOR(F.shiftrightunsigned(y, _PLACE_BITS))))
            hashes = F.transform(by_place, lambda y: y.bitwiseAND((1 << width) - 1))
            code = F.shiftrightunsigned(F.xxhash64(hashes), 32)
            return F.shiftleft(slot(F.get(items, i)) + shape.slots // 2, 32).bitwiseOR(code)

        return F.transform(F.filter(new, lambda i: i >= 0), code)

    return _let(pieces, lambda p: _let(F.sort_array(_numbered(_kmers(p, shape.k))), tuples))


def fingerprint(sig: Column) -> Column:
    """A signature as text: slot and code of each slot in hexadecimal digits."""
    return F.lower(F.array_join(F.transform(sig, lambda x: F.lpad(F.hex(x), 10, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of the slots in use by either that agree; two empty signatures agree fully."""
    slots = lambda s: F.transform(s, lambda x: F.shiftright(x, 32))
    used = F.size(F.array_union(slots(a), slots(b)))
    return F.when(used == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / used)


def borrowers(docs: DataFrame) -> DataFrame:
    """Of each distinct document (key, h) the one before it in the ring by id, with its length:
    key, h, to_key, to_h, to_id, to_n.

    Null ids come first; texts of one id follow the hash of the text.
    """
    ids = docs.select("doc_id", "key", "h", F.length("text").alias("n")).distinct()
    ids = cut_lineage(numbered(ids, F.col("doc_id").asc_nulls_first(), F.col("h").asc()))
    ring = F.lit(max(1, ids.count()))
    after = ids.select("key", "h", F.pmod(F.col("position") - 1, ring).alias("position"))
    before = ids.select(F.col("key").alias("to_key"), F.col("h").alias("to_h"), F.col("doc_id").alias("to_id"), F.col("n").alias("to_n"), "position")
    return cut_lineage(after.join(before, "position").drop("position"))


def edit_check(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Shape = Shape()) -> DataFrame:
    """Fingerprints of each text and of an edited one, and how alike they are.

    The edited text has its last floor(n / 4) characters replaced by the first as many (or all)
    of the next document by id; after the last comes the first. Returns doc_id, n_chars, edited
    (the text), fingerprint, edited_fingerprint, near_edited, near_next. Null texts count as
    empty; an empty text's fingerprint is empty and like another empty one only. Rows repeating id
    and text get equal results, their next document is the next different one; a document alone is
    its own next. No rows give no rows.

    Texts are shuffled once: both joins take the same columns of ``base``, so they share its
    exchange; the id comes back with what is lent. Every document lends its
    beginning and its signature to the one before it; its own signature is computed anew there,
    which is cheaper than to carry it along.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    # With the text's hash, 128 bits that are never null.
    base = base.withColumn("key", F.xxhash64(F.lit(5), "doc_id", "h"))
    borrower = borrowers(base)
    base = base.select("key", "h", "text")
    quarter = F.floor(F.col("to_n") / 4).cast("int")
    lent = (
        base.join(borrower, ["key", "h"])
        .select("to_key", "to_h", "to_id", F.substring("text", F.lit(1), quarter).alias("head"), signature(F.col("text"), shape).alias("next_sig"))
        .groupBy("to_key", "to_h")
        .agg(F.first("to_id").alias("doc_id"), F.first("head").alias("head"), F.first("next_sig").alias("next_sig"))
        .withColumnsRenamed({"to_key": "key", "to_h": "h"})
    )
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("head"))
    frame = base.join(lent, ["key", "h"]).select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "text", "next_sig")
    frame = frame.withColumn("sig", signature(F.col("text"), shape)).withColumn("edited_sig", signature(F.col("edited"), shape))
    return frame.select(
        "doc_id", "n_chars", "edited", fingerprint(F.col("sig")).alias("fingerprint"), fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
