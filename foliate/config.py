"""Settings: environment, then the file's section, then the default; a malformed number counts as absent."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

from foliate.functions.text import accepted_formats, supported_formats

PREFIX = "FOLIATE_"
BACKENDS = ("native", "docling")
TRUE = {"1", "true", "yes", "on"}


@dataclass(frozen=True)
class Settings:
    backend: str = "native"
    source_docs: str = ""
    markdown_dir: str = "data/markdown"
    assets_dir: str = "data/assets"
    vlm_url: str = "http://127.0.0.1:21717/v1/chat/completions"
    vlm_model: str = "qwen2.5-vl-7b"
    vlm_max_tokens: int = 8192
    enable_captions: bool = False
    enable_vlm_ocr: bool = False
    caption_max_pixels: int = 2458624
    caption_max_bytes: int = 12000000
    accept_formats: tuple[str, ...] = ()
    min_recall: float = 0.80
    min_tokens: int = 50
    fallback_min_recall: float = 0.50
    fallback_min_tokens: int = 100
    header_footer_min_frac: float = 0.50
    content_min_recall: float = 0.95
    fallback_content_min: float = 0.85
    threads_per_shard: int = 4
    mem_per_shard_gb: float = 8.0
    max_shards: int = 0
    retry_attempts: int = 2
    escalation_attempts: int = 1
    big_doc_threads: int = 0
    big_doc_mem_gb: float = 24.0
    load_high_frac: float = 1.1
    load_low_frac: float = 0.5
    image_region_min_paths: int = 10
    image_region_pad: float = 0.01
    image_region_max_frac: float = 0.85


def _read(value: object, default: object) -> object:
    text = "" if value is None else str(value).strip()
    if isinstance(default, bool):
        return text.lower() in TRUE if text else default
    if isinstance(default, tuple):
        formats = accepted_formats(value if isinstance(value, (str, list)) else None)
        return () if formats == frozenset(supported_formats()) else tuple(sorted(formats))
    if isinstance(default, (int, float)):
        try:
            return type(default)(float(text)) if isinstance(default, int) and "." in text else type(default)(text)
        except ValueError:
            return default
    return text or default


def load(env: Mapping[str, str] | None = None, path: str | Path | None = None, section: str = "ingest") -> Settings:
    """The settings in force. An unknown backend is an error."""
    env = os.environ if env is None else env
    table: dict = {}
    if path and Path(path).is_file():
        whole = tomllib.loads(Path(path).read_text())
        table = whole.get("paths", {}) | whole.get(section, {})
    made = {f.name: _read(env.get(PREFIX + f.name.upper(), table.get(f.name)), f.default) for f in fields(Settings)}
    made["backend"] = str(made["backend"]).lower()
    if made["backend"] not in BACKENDS:
        raise ValueError(f"unknown backend {made['backend']!r}; one of {', '.join(BACKENDS)}")
    if made["vlm_max_tokens"] < 1:
        made["vlm_max_tokens"] = Settings.vlm_max_tokens
    return Settings(**made)
