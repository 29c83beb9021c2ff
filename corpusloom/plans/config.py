"""YAML settings with environment variables."""

from __future__ import annotations

import os
import re

import yaml

_LEFT = re.compile(r"\$\{?([A-Za-z_]\w*)\}?")


def load_config(path: str) -> dict:
    """The settings, $NAME and ${NAME} replaced; names that are not set are a KeyError that lists them all."""
    with open(path, encoding="utf-8") as f:
        text = os.path.expandvars(f.read())
    if missing := sorted(set(_LEFT.findall(text))):
        raise KeyError(f"not set in the environment: {missing}; export them before the run")
    return yaml.safe_load(text)
