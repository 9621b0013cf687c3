"""Operators for training-data pipelines: quality, mixing, archives, secrets, duplicates, tokens, pages, chats."""
