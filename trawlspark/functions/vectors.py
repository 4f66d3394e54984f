"""Vector arithmetic as native columns (double precision). The batch scorer lives in operators.search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _nan() -> Column:
    return F.lit(float("nan"))


def _double(v: Column) -> Column:
    return v.cast("array<double>")


def sum_of_squares(v: Column) -> Column:
    return F.aggregate(_double(v), F.lit(0.0), lambda acc, x: acc + x * x)


def dot(a: Column, b: Column) -> Column:
    """Dot product; vectors of different length are an error."""
    product = F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors differ in length")).cast("double")).otherwise(
        product
    )


def l2_norm(v: Column) -> Column:
    return F.sqrt(sum_of_squares(v))


def cosine_similarity(a: Column, b: Column) -> Column:
    """1 - cosine distance. NaN when a vector is all zero."""
    scale = F.sqrt(sum_of_squares(a) * sum_of_squares(b))
    return F.when(scale == 0, _nan()).otherwise(dot(a, b) / F.nullif(scale, F.lit(0.0)))


def l2_normalize(v: Column) -> Column:
    """Unit-length vector; the zero vector becomes NaN throughout."""
    # The one-element array binds the norm once instead of once per vector position.
    scaled = F.transform(
        F.array(l2_norm(v)),
        lambda norm: F.transform(
            _double(v), lambda x: F.when(norm == 0, _nan()).otherwise(x / F.nullif(norm, F.lit(0.0)))
        ),
    )
    return F.element_at(scaled, 1)


def cls_of(token_vectors: Column) -> Column:
    """First token's vector of an array of token vectors."""
    return F.element_at(token_vectors, 1)
