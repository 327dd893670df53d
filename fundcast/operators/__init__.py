"""DataFrame operators: profiling reports, text tables, ML stages, scoring."""
