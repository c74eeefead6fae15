"""Token counters that outlines and chunks can be sized with."""

from __future__ import annotations

from collections.abc import Callable

ESTIMATE = "char-estimate/4"


def estimate(text: str) -> int:
    return (len(text) + 3) // 4


def token_counter(spec: str | Callable[[str], int] | None = None) -> tuple[Callable[[str], int] | None, str]:
    """(counter, label): None counts characters; "tokenizers:FILE" and "tiktoken:NAME" load those libraries; what can't be loaded is an error."""
    if spec is None or spec in ("", "char"):
        return None, ESTIMATE
    if callable(spec):
        return spec, getattr(spec, "__name__", "custom")
    kind, _, name = spec.partition(":")
    if kind == "tokenizers":
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(name)
        return lambda text: len(loaded.encode(text, add_special_tokens=False).ids), spec
    if kind == "tiktoken":
        import tiktoken

        encoding = tiktoken.get_encoding(name or "cl100k_base")
        return lambda text: len(encoding.encode_ordinary(text)), spec
    raise ValueError(f"unknown tokenizer {spec!r}")
