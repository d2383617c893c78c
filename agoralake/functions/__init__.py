"""Column helpers; all of them are built-in expressions."""

from agoralake.functions.predicates import post_filter
from agoralake.functions.stats import pearson
from agoralake.functions.text import WHITESPACE, strip, text_length
from agoralake.functions.time import epoch_to_timestamp, iso_to_timestamp, run_partition, run_time

__all__ = [
    "WHITESPACE",
    "epoch_to_timestamp",
    "iso_to_timestamp",
    "pearson",
    "post_filter",
    "run_partition",
    "run_time",
    "strip",
    "text_length",
]
