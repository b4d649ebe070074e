"""Table-level operators: ``DataFrame -> DataFrame``, lazy, keyed by ``pmid``."""
