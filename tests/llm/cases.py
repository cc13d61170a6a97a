"""Small tables with every awkward case."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


AWKWARD = [
    None, "", " ", "\n", "a", "A", "'s it's ''s we'll  don't\n\n 're", "lead  trail  ", "tab\tx\n y\n", "あい abc 'll",
    " <|endoftext|> hi<|startoftext|>there<|endoftext|>", "Σας ΟΔΟΣ İstanbul é é", "123 4a5 ²³ ½", "x" * 3000,
    "\x1c\x85 a​b ՘ c", "😀 hey\U0001f600", "_a_b__", "a\u0000b",
]


def documents(spark, texts, **more):
    """A documents table with further columns whose names the operators use inside."""
    rows = [
        (i, t, "en", f"src{i % 3}", len(t or ""), i, "x", i % 5, more.get("norm"))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id long, hash string, row int, norm string"
    )
