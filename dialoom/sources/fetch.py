"""Source files: a path as it is, or a download kept in a cache folder."""

from __future__ import annotations

import logging
import os
import urllib.error
import urllib.parse
import urllib.request
import uuid
from pathlib import Path

LOG = logging.getLogger("dialoom")


def fetch(name: str, path: str | Path | None, url: str | None, cache: str | Path, timeout: float = 60) -> str | None:
    """Where to read the source; None, with a log line, if it is missing or cannot be downloaded.

    A download happens once: the cached file, named after the source, answers later calls.
    """
    if path:
        if Path(path).exists():
            return str(path)
        LOG.warning("source %s skipped: %s is missing", name, path)
        return None
    target = Path(cache) / f"{name}{Path(urllib.parse.urlparse(url).path).suffix}"
    if target.exists():
        return str(target)
    target.parent.mkdir(parents=True, exist_ok=True)
    staged = target.with_name(f"{target.name}.tmp-{uuid.uuid4().hex}")
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer, staged.open("wb") as out:
            while block := answer.read(1 << 20):
                out.write(block)
        os.replace(staged, target)
        return str(target)
    except (OSError, ValueError, urllib.error.URLError) as e:
        LOG.warning("source %s skipped: %s", name, e)
        return None
    finally:
        staged.unlink(missing_ok=True)
