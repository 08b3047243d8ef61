"""Logging on the driver: a rotating file and the console."""

from __future__ import annotations

import logging
import os
from logging.handlers import RotatingFileHandler

FILE_BYTES, FILES = 5 << 20, 5


def get_logger(name: str = "corpusloom", path: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """A logger that writes to the console and, if a path is given, to a file that rotates."""
    log = logging.getLogger(name)
    log.setLevel(level)
    form = logging.Formatter("%(asctime)s %(levelname)-7s %(message)s")
    wanted: list[logging.Handler] = []
    if not any(type(h) is logging.StreamHandler for h in log.handlers):
        wanted.append(logging.StreamHandler())
    if path and not any(isinstance(h, RotatingFileHandler) and h.baseFilename == os.path.abspath(path) for h in log.handlers):
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        wanted.append(RotatingFileHandler(path, maxBytes=FILE_BYTES, backupCount=FILES, encoding="utf-8"))
    for handler in wanted:
        handler.setFormatter(form)
        log.addHandler(handler)
    return log
