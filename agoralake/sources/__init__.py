"""Readers of every layer and of foreign files."""

from agoralake.sources.bronze import (
    SPLIT_ABOVE,
    good_documents,
    is_good_document,
    quarantined_documents,
    read_documents,
    read_foreign_documents,
)
from agoralake.sources.listing import read_listing
from agoralake.sources.parquet import (
    path_community,
    path_exists,
    read_foreign_silver,
    read_gold,
    read_silver,
)
from agoralake.sources.sql import query_to_dataframe

__all__ = [
    "SPLIT_ABOVE",
    "good_documents",
    "is_good_document",
    "path_community",
    "path_exists",
    "quarantined_documents",
    "query_to_dataframe",
    "read_documents",
    "read_foreign_documents",
    "read_foreign_silver",
    "read_gold",
    "read_listing",
    "read_silver",
]
