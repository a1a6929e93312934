"""Training-data operators: language, toxicity, search, language models, deduplication, privacy, mixing, output."""
