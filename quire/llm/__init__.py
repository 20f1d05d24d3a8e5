"""Training-data operators: language, extraction, tokens, near copies, search, toxicity, shards, mixing, media."""
