"""Operators for preparing training data: tokens, packing, chat, scores, near copies and fingerprints."""
