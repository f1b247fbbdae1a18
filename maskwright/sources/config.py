"""Configuration documents that extend others, JSON or YAML."""

from __future__ import annotations

import json
import posixpath

from pyspark.sql import SparkSession


def merged(base: dict, over: dict) -> dict:
    """`base` with the values of `over`; objects merge key by key, everything else is replaced."""
    both = {k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}
    return base | both


def load_config(spark: SparkSession, path: str, seen: tuple[str, ...] = ()) -> dict:
    """A document on any storage, on top of the one its `extends` names (relative to it); a circle is an error."""
    if path in seen:
        raise ValueError(f"configuration extends itself: {' -> '.join((*seen, path))}")
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    if path.endswith(".json"):
        found = json.loads(text or "{}")
    else:
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"{path}: YAML needs the yaml package; JSON doesn't") from e
        found = yaml.safe_load(text) or {}
    parent = found.pop("extends", None)
    if not parent:
        return found
    where = parent if "://" in parent or parent.startswith("/") else posixpath.join(posixpath.dirname(path), parent)
    return merged(load_config(spark, where, (*seen, path)), found)


def stage_settings(config: dict, section: str, backend: str = "transformers") -> dict:
    """Settings of a model-bound stage: the common `model` section, under the stage's own `model`; the backend in lower case."""
    found = merged(config.get("model") or {}, (config.get(section) or {}).get("model") or {})
    name = found.get("backend") or (config.get("inference") or {}).get("backend") or backend
    return found | {"backend": str(name).strip().lower()}
