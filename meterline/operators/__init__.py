"""DataFrame-to-DataFrame steps; nothing here reads or writes storage."""
