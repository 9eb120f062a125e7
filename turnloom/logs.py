"""Logging of the package: one line per message, to the console and, where a folder is named, to a file."""

from __future__ import annotations

import logging
import os
import sys

_FORMAT = logging.Formatter("[%(asctime)s] %(levelname)-8s [%(name)s] %(message)s", "%Y-%m-%d %H:%M:%S")
ROOT = "turnloom"


def get_logger(name: str) -> logging.Logger:
    """A logger below the package's; a library keeps still until :func:`log_to` is called."""
    root = logging.getLogger(ROOT)
    if not root.handlers:
        root.addHandler(logging.NullHandler())
    return logging.getLogger(name if name.startswith(ROOT) else f"{ROOT}.{name}")


def log_to(folder: str | None = None, run: str = "run", console: int = logging.INFO) -> logging.Logger:
    """Show messages from ``console`` on, and write all of them to ``folder/run.log``. Calling it again replaces both."""
    root = logging.getLogger(ROOT)
    for h in list(root.handlers):
        root.removeHandler(h)
        h.close()
    root.setLevel(logging.DEBUG)
    shown = logging.StreamHandler(sys.stdout)
    shown.setLevel(console)
    handlers: list[logging.Handler] = [shown]
    if folder:
        os.makedirs(folder, exist_ok=True)
        handlers.append(logging.FileHandler(os.path.join(folder, f"{run}.log"), encoding="utf-8"))
    for h in handlers:
        h.setFormatter(_FORMAT)
        root.addHandler(h)
    return root
