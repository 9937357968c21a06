"""Column builders (`text`), shared regexes (`patterns`) and the per-cell Python syntax
helper (`pysyntax`)."""
