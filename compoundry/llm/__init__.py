"""Operators for training-data pipelines: tokens, licences, packing, quality, duplicates, secrets, shards, chats."""
