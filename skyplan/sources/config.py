"""Configuration: TOML with repeated tables, overlays, and flat rows."""

from __future__ import annotations

import os
import re
import tomllib
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def overlay(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """base with over's values; tables are merged, other values replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = overlay(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def merge_repeated_tables(text: str) -> str:
    """TOML allows a table once; the bodies of repeated ones are joined under
    the first, in order."""
    bodies: dict[str, list[str]] = {"": []}
    name = ""
    for line in text.splitlines():
        head = re.fullmatch(r"\s*(\[[^\[\]]+\])\s*(#.*)?", line)
        if head:
            name = head[1].replace(" ", "")
            bodies.setdefault(name, [])
        else:
            bodies[name].append(line)
    return "\n".join("\n".join([*([k] if k else []), *v]) for k, v in bodies.items()) + "\n"


def parse(text: str) -> dict[str, Any]:
    try:
        return tomllib.loads(text)
    except tomllib.TOMLDecodeError:
        return tomllib.loads(merge_repeated_tables(text))


def load(path: str, secondary: str | None = None, mode: str = "queue") -> dict[str, Any]:
    """The configuration, on top of a secondary one if given; in queue mode
    the secondary one's lists of proposals hold."""
    first = parse(Path(path).read_text())
    if secondary is None:
        return first
    second = parse(Path(secondary).read_text())
    out = overlay(second, first)
    if mode == "queue":
        for section, values in second.items():
            if isinstance(values, Mapping):
                out.setdefault(section, {}).update({k: v for k, v in values.items() if k.startswith("proposalIds")})
    return out


def from_environment(config: Mapping[str, Any], section: str, key: str, variable: str, required: bool = False, default: Any = None) -> Any:
    """The environment's value, else the configuration's, else the default."""
    value = os.environ.get(variable) or config.get(section, {}).get(key)
    value = default if value is None else value
    if required and value is None:
        raise KeyError(f"set {variable} or [{section}] {key}")
    return value


def toml_value(value: Any) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(toml_value, value)) + "]"
    text = str(value).replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\t", "\\t")
    return f'"{text}"'


def to_toml(config: Mapping[str, Any], path: str = "") -> str:
    """A table's own values come before the tables within it."""
    lines = [f"{k} = {toml_value(v)}" for k, v in config.items() if not isinstance(v, Mapping) and v is not None]
    out = ("\n".join([f"[{path}]", *lines]) if path else "\n".join(lines)) + "\n"
    for k, v in config.items():
        if isinstance(v, Mapping):
            out += "\n" + to_toml(v, f"{path}.{k}" if path else k)
    return out


def flat_rows(config: Mapping[str, Any], path: str = "") -> list[tuple[str, str, str]]:
    """(section, parameter, value); own values before those of inner tables."""
    out = [(path, k, str(v)) for k, v in config.items() if not isinstance(v, Mapping)]
    for k, v in config.items():
        if isinstance(v, Mapping):
            out += flat_rows(v, f"{path}.{k}" if path else k)
    return out


def flattened(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    return spark.createDataFrame(flat_rows(config), "section string, parameter string, value string")
