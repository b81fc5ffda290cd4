"""Questions in plain words as filters, on the driver: a question is one short text, never a table."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

# Words that name an action of the queue.
ACTIONS = {"draft": ("draft", "preview"), "publish": ("publish", "release", "pdf"), "web_publish": ("web", "html", "site"), "check": ("check", "lint", "verify"), "status": ("status", "progress", "state")}


def inferred(question: str, known: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Filters that a question names: for each column the longest known value that stands in it as a word; also
    version (v1.2 or version 1.2), latest, and action."""
    text = f" {' '.join(question.split())} ".lower()
    out = {}
    for column, values in known.items():
        for v in sorted(values, key=lambda v: (-len(v), v)):
            if v.strip() and re.search(rf"(?<![a-z0-9]){re.escape(v.strip().lower())}(?![a-z0-9])", text):
                out[column] = v
                break
    if m := re.search(r"\bv(\d+(?:\.\d+)*)\b|\bversion (\d+(?:\.\d+)*)", text):
        out["version"] = m[1] or m[2]
    if re.search(r"\b(latest|newest|current)\b", text):
        out["latest"] = "true"
    for action, words in ACTIONS.items():
        if any(re.search(rf"\b{w}(e?d|es|ing)?\b", text) for w in words):
            out["action"] = action
            break
    return out


def merged(explicit: Mapping[str, str | None], question: str, known: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Explicit filters win over inferred ones; blank explicit ones count as not given."""
    return inferred(question, known) | {k: v for k, v in explicit.items() if v}
