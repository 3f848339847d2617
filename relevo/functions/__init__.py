"""Column expressions: ``text`` (cleaning, words, hit counts) and ``porter2`` (the one-word stemmer)."""
