"""Vector arithmetic on array columns and the built-in text embedding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkrank.functions.columns import as_column, let
from sparkrank.functions.text import words


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def squared_l2(a: Column, b: Column) -> Column:
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, null when one of the vectors is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def hash_digits(dim: int) -> int:
    """Hexadecimal digits of a word's md5 that its bucket is taken from."""
    return 4 if dim <= 1 << 12 else 12


def word_bucket(word: Column, dim: int) -> Column:
    digits = F.substring(F.md5(word), 1, hash_digits(dim))
    return (F.conv(digits, 16, 10).cast("long") % F.lit(dim)).cast("int")


def hashed_bow(text: Column | str, dim: int = 64) -> Column:
    """Hashed bag of words, scaled to length one, as ``array<float>``.

    A text without words gives the zero vector.
    """
    buckets = F.transform(words(as_column(text)), lambda w: word_bucket(w, dim))
    axis = F.sequence(F.lit(0), F.lit(dim - 1))

    def counts(found: Column) -> Column:
        return F.transform(axis, lambda d: F.size(found) - F.size(F.array_remove(found, d)))

    def scaled(count: Column) -> Column:
        length = F.sqrt(F.aggregate(count, F.lit(0), lambda acc, c: acc + c * c).cast("double"))
        return let(
            length,
            lambda n: F.transform(
                count, lambda c: F.when(n > 0, c.cast("double") / n).otherwise(0.0).cast("float")
            ),
        )

    return let(buckets, lambda found: let(counts(found), scaled))
