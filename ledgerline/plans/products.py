"""Product ratings: fill, deduplicate, score, drop, save."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ledgerline.operators import cleaning, filters, shaping, transforms

RATINGS = StructType(
    [
        StructField("product_id", LongType()),
        StructField("final_price", DoubleType()),
        StructField("rating", DoubleType()),
        StructField("ratings_count", LongType()),
        StructField("difference", DoubleType()),
    ]
)


def clean_ratings(raw: DataFrame) -> DataFrame:
    """Missing values as 0, one copy per row, a popularity score, no difference."""
    filled = cleaning.fill_everything(raw, 0)
    single = cleaning.drop_duplicate_rows(filled)
    scored = transforms.add_product(single, "popularity_score", "rating", "ratings_count")
    return shaping.drop_columns(scored, "difference")


def well_rated(ratings: DataFrame, above: float = 3.0) -> DataFrame:
    return filters.where_greater(cleaning.fill_everything(ratings, 0), "rating", above)


def prices(ratings: DataFrame) -> DataFrame:
    return shaping.project(ratings, "product_id", "final_price")
