"""The formats by name."""

from __future__ import annotations

from chatlake.formats.base import Format
from chatlake.formats.flat_calls import FlatCalls
from chatlake.formats.messages import FlaggedMessages, ReplyMessages

# The names under which the layouts are known to users.
FLAGGED_MESSAGES = "acon96-v2"
FLAT_CALLS = "allenporter-fc"
REPLY_MESSAGES = "allenporter-msg"

# Fixed value: what users are told about another name.
UNKNOWN = "Unknown dataset format: '{}'\nSupported formats: {}"

FORMATS: dict[str, Format] = {
    f.name: f
    for f in (
        FlaggedMessages(FLAGGED_MESSAGES),
        FlatCalls(FLAT_CALLS),
        ReplyMessages(REPLY_MESSAGES),
    )
}


def list_formats() -> list[str]:
    return sorted(FORMATS)


def load_format(name: str) -> Format:
    if name not in FORMATS:
        raise ValueError(UNKNOWN.format(name, ", ".join(list_formats())))
    return FORMATS[name]
