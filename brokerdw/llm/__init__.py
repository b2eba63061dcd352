"""Operators for training data: licences, language model, tokens, duplicates, mixing, shards, toxicity, neighbours."""
