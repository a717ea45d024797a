"""Rows that every operator must take."""

LONG = " ".join(f"w{i}" for i in range(30_000))
# Nulls, blanks of every kind, one long "word", ties, repeated rows.
ODD = [(1, "a b"), (2, "a\t\n b"), (3, None), (4, ""), (5, " \x0b "), (6, LONG), (7, LONG), (8, "x" * 50_000), (8, "x" * 50_000),
       (None, "a b"), (None, "alone"), (9, "é\u00a0ü a"), (10, "A B"), (11, "a\x00b\u2028c")]
CLASHING = ("digest", "row", "key", "score", "kept", "words", "repetition", "near_id", "text_hash", "first")
