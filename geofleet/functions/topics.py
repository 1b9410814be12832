"""MQTT topic filters."""

from __future__ import annotations

import re


def topic_filter_regex(topic_filter: str) -> str:
    """Anchored regex equivalent of an MQTT topic filter.

    '+' matches exactly one level (possibly empty, never containing '/');
    a trailing '#' matches the parent level and any number of sub-levels.
    """
    levels = topic_filter.split("/")
    parts: list[str] = []
    for i, level in enumerate(levels):
        if level == "#":
            if i != len(levels) - 1:
                raise ValueError(f"'#' must be the last level: {topic_filter!r}")
            prefix = "/".join(parts)
            return f"^{prefix}(/.*)?$" if parts else "^.*$"
        if level == "+":
            parts.append("[^/]*")
        elif "+" in level or "#" in level:
            raise ValueError(f"wildcards must fill a whole level: {topic_filter!r}")
        else:
            parts.append(re.escape(level))
    return "^" + "/".join(parts) + "$"
