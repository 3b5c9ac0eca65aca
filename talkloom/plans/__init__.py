"""Stage runs: read, transform, commit, summarise."""
