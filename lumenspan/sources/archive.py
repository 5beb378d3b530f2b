"""Packing source files into one archive whose bytes depend on their contents only."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import tarfile
from pathlib import Path


def build_archive(root: str | Path, patterns: tuple[str, ...] = ("**/*.py",)) -> bytes:
    """A gzipped tar of the files under ``root``, in order of their names, without times or owners."""
    root = Path(root)
    files = sorted({p for pattern in patterns for p in root.glob(pattern) if p.is_file()})
    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w", format=tarfile.USTAR_FORMAT) as tar:
        for path in files:
            data = path.read_bytes()
            info = tarfile.TarInfo(path.relative_to(root).as_posix())
            info.size, info.mode = len(data), 0o644
            tar.addfile(info, io.BytesIO(data))
    return gzip.compress(plain.getvalue(), mtime=0)


def encode_archive(data: bytes) -> dict[str, str]:
    return {"base64": base64.b64encode(data).decode(), "sha256": hashlib.sha256(data).hexdigest()}
