"""Older office formats through an outside office program, where one is installed; a plug-in like any other."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
from pathlib import Path

from foliate.sources import html, office

#: The package format that each older format becomes (fixed values).
TARGETS = {"odt": "docx", "doc": "docx", "rtf": "docx", "odp": "pptx", "ppt": "pptx", "ods": "xlsx", "xls": "xlsx"}


def find_office() -> str:
    """The program: named by FOLIATE_SOFFICE, else on the path; empty where there is none."""
    return os.environ.get("FOLIATE_SOFFICE") or shutil.which("soffice") or shutil.which("libreoffice") or ""


def to_package(program: str, content: bytes, ext: str, seconds: int = 180) -> bytes:
    """The file as a package; empty on any failure. Each call has its own folder and profile, so tasks don't meet."""
    if not program or ext not in TARGETS:
        return b""
    with tempfile.TemporaryDirectory() as folder:
        source = Path(folder) / f"in.{ext}"
        source.write_bytes(content)
        try:
            subprocess.run([program, "--headless", f"-env:UserInstallation=file://{folder}/profile", "--convert-to", TARGETS[ext], "--outdir", folder, str(source)], timeout=seconds, capture_output=True, check=True)
            return (Path(folder) / f"in.{TARGETS[ext]}").read_bytes()
        except (OSError, subprocess.SubprocessError):
            return b""


def legacy_converter(ext: str, program: str):
    def convert(content: bytes) -> dict:
        package = to_package(program, content, ext)
        return office.convert_package(package, TARGETS[ext]) if package else {"error": "libreoffice-convert-failed"}

    return convert


def register(program: str | None = None) -> bool:
    """Plug the program in for all older formats; False where there is none."""
    program = find_office() if program is None else program
    for ext in TARGETS if program else ():
        html.register_layout_converter(ext, legacy_converter(ext, program))
    return bool(program)
