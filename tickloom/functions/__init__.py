"""Column expressions: guarded arithmetic, calendar encodings, classifiers, live-message parsers."""
