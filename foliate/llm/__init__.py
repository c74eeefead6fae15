"""Operators for large-language-model training data; nothing else in foliate imports this."""
