"""Operations of training-data pipelines: dedup, search, tokenizing, mixing, quality."""
