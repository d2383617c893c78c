"""Writers of every layer. A repeated run replaces its own partitions and touches no others."""

from agoralake.sinks.layers import (
    add_run_partitions,
    remove_partitions,
    remove_path,
    write_documents,
    write_gold,
    write_partitions,
    write_silver,
)
from agoralake.sinks.publish import clear_staged, publish_pending, publish_staged, staged_at

__all__ = [
    "add_run_partitions",
    "clear_staged",
    "publish_pending",
    "publish_staged",
    "remove_partitions",
    "remove_path",
    "staged_at",
    "write_documents",
    "write_gold",
    "write_partitions",
    "write_silver",
]
