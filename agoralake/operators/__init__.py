"""DataFrame-to-DataFrame steps; none of them reads, writes or runs anything."""
