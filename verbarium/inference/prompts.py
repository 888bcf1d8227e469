"""Prompt templates: files ``<name>/v<version>.txt`` of a folder, with ``{field}`` places.

A passage between ``{?field}`` and ``{/field}`` is left out where the field is null, false,
zero or empty.
"""

from __future__ import annotations

import re
from pathlib import Path

DEFAULT_FOLDER = Path(__file__).parent / "templates"


def load_prompt(name: str, folder: Path | str | None = None, version: str = "auto") -> str:
    """A template by name; ``auto`` is the highest version there."""
    home = Path(folder or DEFAULT_FOLDER) / name
    found = {m[1]: p for p in home.glob("v*.txt") if (m := re.fullmatch(r"v(\d+)\.txt", p.name))}
    if version == "auto" and found:
        version = max(found, key=int)
    if version not in found:
        raise FileNotFoundError(f"no version {version} of the prompt {name} in {home.parent}")
    return found[version].read_text(encoding="utf-8")


def fields_of(template: str) -> set[str]:
    """The names that a template has places for."""
    return set(re.findall(r"\{[?/]?(\w+)\}", template))


def fill(template: str, values: dict) -> str:
    """The template with its places filled, lists line by line and null as nothing, and passages without content left out."""

    def text(value: object) -> str:
        if value is None:
            return ""
        if isinstance(value, (list, tuple)):
            return "\n".join(f"- {text(v)}" for v in value)
        if isinstance(value, dict):
            return ": ".join(text(v) for v in value.values() if v is not None)
        return str(value)

    kept = re.sub(r"\{\?(\w+)\}(.*?)\{/\1\}", lambda m: m[2] if values.get(m[1]) else "", template, flags=re.DOTALL)
    return re.sub(r"\{(\w+)\}", lambda m: text(values.get(m[1])), kept)


def keywords(settings: dict, leave_out_null: bool = False) -> dict:
    """Settings as keyword arguments: those of a mapping named ``kwargs`` stand beside the others, and win over them.

    ``kwargs`` of another type stays as it is. Null settings go if ``leave_out_null``, at both levels.
    """
    kept = {k: v for k, v in settings.items() if not (leave_out_null and v is None)}
    if isinstance(inner := kept.get("kwargs"), dict):
        del kept["kwargs"]
        kept |= {k: v for k, v in inner.items() if not (leave_out_null and v is None)}
    return kept
