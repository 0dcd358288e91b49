"""Text normalisation as Column expressions.

Everything here needs no shuffle and works on the whole text. All but the cleaning of
whole documents are chains of built-in string functions; that one is an Arrow function, as a
text takes a dozen passes, which bytes are several times faster in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkrank.functions.columns import as_column, slices

# The replacements of the cleaning contract.
PERCENT = " percent "
DOLLAR = " dollar "
NUMBER = " number "
MARKS = ("`", "'")

CLEAN_ROWS = 4_096  # texts, and bytes of them, that are Python objects at once; one text over it goes alone
CLEAN_BYTES = 4 << 20


def _swap(c: Column, needle: str, new: str) -> Column:
    return F.replace(c, F.lit(needle), F.lit(new))


def words(text: Column | str) -> Column:
    """Words of a text separated by white space; no empty entries."""
    return F.filter(F.split(as_column(text), r"\s+"), lambda w: w != "")


def word_count(text: Column | str) -> Column:
    return F.size(words(text))


def normal_id(c: Column | str) -> Column:
    """Identifier with everything but letters and digits removed, lower case."""
    return F.lower(F.regexp_replace(as_column(c), "[^a-zA-Z0-9]", ""))


def tag_of(doc_id: Column | str) -> Column:
    """Entity tag: the part of an identifier before its first digit."""
    return F.regexp_extract(F.lower(as_column(doc_id)), "^([^0-9]*)", 1)


def parent_of(chunk_id: Column | str) -> Column:
    """Parent document of a chunk whose parent was not kept as a column."""
    return F.substring_index(as_column(chunk_id), "_", 1)


def distinct_words(text: Column | str) -> Column:
    """Text with repeated words removed, the first occurrence stays."""
    return F.array_join(F.array_distinct(words(text)), " ")


def replace_word(text: Column, old: Column, new: Column, substring: bool = False) -> Column:
    """Replace ``old`` by ``new`` as a whole word, or wherever it occurs."""
    if substring:
        return F.replace(text, old, new)
    # doubled spaces give every word two of its own, so neighbours can both match
    padded = F.concat(F.lit(" "), F.replace(text, F.lit(" "), F.lit("  ")), F.lit(" "))
    space = F.lit(" ")
    swapped = F.replace(padded, F.concat(space, old, space), F.concat(space, new, space))
    inner = F.substring(swapped, F.lit(2), F.length(swapped) - 2)
    return F.replace(inner, F.lit("  "), space)


# upper case goes to lower case and some signs to a space; all but letters, digits, "(). " and signs replaced later leave
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ+*#", b"abcdefghijklmnopqrstuvwxyz   ")
_GONE = bytes(sorted(set(range(256)) - set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789(). +*#%$")))
# dashes, commas and bullets vanish, also between a mark and its s; nothing else has to be done for them
_OWNERS = [re.compile(f"{mark}[—,•]*s") for mark in MARKS]
_SPACES, _NUMBER, _ASIDE = re.compile(rb"  +"), re.compile(rb"\((\d+(?:\.\d+)?)\)"), re.compile(rb"\(([^)0-9]+)\)")


def cleaned(text: str) -> str:
    """One text normalised, see :func:`clean_corpus_text`."""
    for owner in _OWNERS:
        text = owner.sub("", text)
    if not text.isascii():  # the letters beyond ASCII whose lower case is in it
        text = text.replace("\u0130", "i").replace("\u212a", "k")
    c = text.encode("utf-8", "replace").translate(_LOWER, _GONE)
    c = c.replace(b"%", PERCENT.encode()).replace(b"$", DOLLAR.encode())
    c = _ASIDE.sub(rb"\1", _NUMBER.sub(rb"-\1", _SPACES.sub(b" ", c)))
    return c.strip(b" ").decode()


def clean_corpus_text(title: Column, body: Column, newline_as_space: bool = False) -> Column:
    """Searchable text of a document: title and body, normalised.

    Line breaks are deleted by default, which joins the words around them;
    ``newline_as_space`` keeps those words apart.
    """
    c = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")))
    if newline_as_space:
        c = F.regexp_replace(c, r"\s", " ")

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made = [pa.array([], pa.string())]
            sizes = pc.binary_length(batch).fill_null(0).to_numpy(zero_copy_only=False)
            for start, end in slices(sizes, CLEAN_ROWS, CLEAN_BYTES):
                made.append(pa.array([cleaned(t) for t in batch[start:end].to_pylist()], pa.string()))
            yield pa.concat_arrays(made)

    return clean(c)


def clean_query_text(text: Column | str) -> Column:
    """Normalised query text; runs of inner spaces are kept."""
    c = F.lower(as_column(text))
    for mark in MARKS:
        c = _swap(c, f"{mark}s", "")
    c = _swap(_swap(_swap(c, "%", PERCENT), "#", NUMBER), "$", DOLLAR)
    return F.trim(F.regexp_replace(c, "[^0-9a-z ]", ""))


def sentences(text: Column | str) -> Column:
    """Sentences of a text: an end mark followed by white space ends one."""
    marked = F.regexp_replace(F.trim(as_column(text)), r"([.!?])\s+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: s != "")


def bump_version(label: Column | str, step: str = "0.1") -> Column:
    """Next version label: the numeric part plus one step, null if there is none."""
    number = F.regexp_replace(as_column(label), "[^0-9.]", "").try_cast("decimal(28,10)")
    following = (number + F.lit(step).cast("decimal(28,10)")).cast("string")
    # keeps at least one digit behind the point
    return F.concat(F.lit("v"), F.regexp_replace(following, "([.][0-9]+?)0+$", "$1"))
