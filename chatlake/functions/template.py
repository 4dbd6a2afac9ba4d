"""Declarative chat templates rendered with Column expressions.

A template gives the text around a message per role. The text of a turn depends
on that turn only, so rendering a longer conversation always starts with the
rendering of a shorter one and the turns can be joined like prefixes.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatlake.functions.messages import SUPPORTED_ROLES
from chatlake.functions.toolcall import render_call
from chatlake.functions.text import short_hash


@dataclass(frozen=True)
class Template:
    """Text around messages.

    ``before`` and ``after`` hold a ``{role}`` slot; ``role_names`` renames
    roles that the model knows under another name.
    """

    name: str
    before: str
    after: str
    tools_before: str
    tools_after: str
    generation: str
    role_names: dict[str, str] = field(default_factory=dict)

    def identity(self) -> str:
        """Text that changes whenever the rendering would."""
        return json.dumps(asdict(self), sort_keys=True, ensure_ascii=False)

    def key(self) -> Column:
        return short_hash(F.lit(self.identity()))

    def _around(self, role: Column, pattern: str) -> Column:
        if "{role}" not in pattern:
            return F.lit(pattern)
        result = None
        for known in SUPPORTED_ROLES:
            text = F.lit(pattern.replace("{role}", self.role_names.get(known, known)))
            result = F.when(role == known, text) if result is None else result.when(role == known, text)
        head, tail = pattern.split("{role}", 1)
        return result.otherwise(F.concat(F.lit(head), role, F.lit(tail)))

    def turn(self, role: Column, content: Column, calls: Column | None = None) -> Column:
        """One rendered turn; ``calls`` is an array of tool calls or null."""
        parts = [self._around(role, self.before), content]
        if calls is not None:
            rendered = F.array_join(F.transform(calls, render_call), "\n")
            gap = F.when(content != "", F.lit("\n")).otherwise(F.lit(""))
            parts.append(F.when(F.size(calls) > 0, F.concat(gap, rendered)).otherwise(F.lit("")))
        return F.concat(*parts, self._around(role, self.after))

    def tools_header(self, tools: Column) -> Column:
        """Text that announces the tools; empty for null, empty text or ``[]``."""
        empty = tools.isNull() | F.regexp_replace(tools, r"\s", "").isin("", "[]")
        return F.when(empty, F.lit("")).otherwise(
            F.concat(F.lit(self.tools_before), tools, F.lit(self.tools_after))
        )

    def turns(self, messages: Column, tools: Column | None = None) -> Column:
        """Rendered turns as ``array<struct<text,trainable>>``. The tools are
        announced in front of the first turn and belong to its text."""
        header = F.lit("") if tools is None else self.tools_header(tools)

        def one(message: Column, position: Column) -> Column:
            text = self.turn(
                message.getField("role"), message.getField("content"), message.getField("tool_calls")
            )
            first = F.when(position == 0, F.concat(header, text)).otherwise(text)
            return F.struct(
                first.alias("text"), message.getField("train_on_turn").alias("trainable")
            )

        return F.transform(messages, one)

    def prompt(self, messages: Column, tools: Column | None = None) -> Column:
        """Inference prompt: the rendered messages and the start of a reply."""
        texts = F.transform(self.turns(messages, tools), lambda t: t.getField("text"))
        header = F.lit("") if tools is None else self.tools_header(tools)
        lead = F.when(F.size(messages) == 0, header).otherwise(F.lit(""))
        return F.concat(lead, F.array_join(texts, ""), F.lit(self.generation))


CHATML = Template(
    name="chatml",
    before="<|im_start|>{role}\n",
    after="<|im_end|>\n",
    tools_before="<|im_start|>system\n# Tools\n\n<tools>\n",
    tools_after="\n</tools><|im_end|>\n",
    generation="<|im_start|>assistant\n",
)

TURN_MARKERS = Template(
    name="turn-markers",
    before="<start_of_turn>{role}\n",
    after="<end_of_turn>\n",
    tools_before="<start_of_turn>system\nTools: ",
    tools_after="<end_of_turn>\n",
    generation="<start_of_turn>model\n",
    role_names={"assistant": "model"},
)

TEMPLATES = {t.name: t for t in (CHATML, TURN_MARKERS)}
