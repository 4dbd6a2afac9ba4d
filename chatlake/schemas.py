"""Schemas shared by the formats and operators."""

from __future__ import annotations

# One tool call; arguments are JSON text because their keys differ per tool.
TOOL_CALL = "struct<name:string,arguments:string>"

# A message after normalisation, the one layout all operators work on.
MESSAGE = (
    "struct<role:string,content:string,train_on_turn:boolean,"
    f"tool_calls:array<{TOOL_CALL}>>"
)

# Training rows. ``text`` is what a trainer reads; prompt and completion keep
# the boundary between context and target explicit.
TRAINING = "example_index long, turn_index int, prompt string, completion string, text string"

EVALUATION = (
    f"example_index long, prompt string, expected_text string, expected_tool {TOOL_CALL}, input string"
)

# One line of a trainer's log.
LOSS_LINE = "run_id string, line_no long, line string"

# A model reply; a null text means the generation failed.
PREDICTION = "run_id string, example_index long, predicted_text string"
