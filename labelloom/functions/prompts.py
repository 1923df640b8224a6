"""Column expressions that build prompts, gold outputs and training texts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelloom.functions.values import named

# ---- Fixed values: instruction text ----------------------------------------------
INSTRUCTIONS = """\
You are given a programming problem with various details. Your task is to analyze the problem and determine which tags apply from the following list:
{labels}.

For each tag, output 1 if the tag applies to the problem or 0 if it does not.
It is important that you consider that none of the tags might apply, and that multiple tags may apply simultaneously.
IMPORTANT: Your output must be a single valid JSON object, and it must be wrapped between <output> and </output>.
The JSON object must only contain the following keys: {keys}.
Each key must have either the value 0 or 1.

Below are the problem details:"""
CLOSING = """\
Respond with only one JSON response wrapped in <output> and </output> with no additional text.
For example:
<output>{example}</output>"""
END_TOKEN = "<|endoftext|>"
SYSTEM_TURN = "<|im_start|>system\n{text}<|im_end|>\n"
USER_OPENING = "<|im_start|>user\n"
USER_CLOSING = "<|im_end|>\n<|im_start|>assistant\n"
TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"
ANSWER_OPENING = "<|im_start|>assistant\n"


def prompt_template(labels: Sequence[str]) -> str:
    """The instructions for these labels, the same for every row."""
    keys = ", ".join(f'"{label}"' for label in labels)
    return INSTRUCTIONS.format(labels=", ".join(labels), keys=keys)


def closing_text(labels: Sequence[str]) -> str:
    """The closing lines with an example answer of alternating 1 and 0."""
    example = {label: (position + 1) % 2 for position, label in enumerate(labels)}
    return CLOSING.format(example=json.dumps(example))


def feature_title(column: str) -> str:
    return column.replace("_", " ").capitalize()


def build_prompt(columns: Sequence[str], labels: Sequence[str]) -> Column:
    """Instructions, one line per non-null column, an empty line and the closing lines."""
    details = [
        F.concat(F.lit(feature_title(name) + ": "), named(name).cast("string")) for name in columns
    ]
    return F.concat_ws(
        "\n", F.lit(prompt_template(labels)), *details, F.lit(""), F.lit(closing_text(labels))
    )


def gold_output(flags: dict[str, Column | None]) -> Column:
    """The expected answer, {"label": 0 or 1, ...} between output tags; None stands for 0."""
    pieces: list[Column] = []
    for position, (label, flag) in enumerate(flags.items()):
        lead = ", " if position else ""
        pieces.append(F.lit(lead + json.dumps(label) + ": "))
        pieces.append(F.lit("0") if flag is None else flag.cast("int").cast("string"))
    return F.concat(F.lit("<output>{"), *pieces, F.lit("}</output>"))


def sft_text(prompt: Column, output: Column, end_token: str = END_TOKEN) -> Column:
    """One training text: prompt, expected answer, end token."""
    return F.concat(prompt, F.lit("\n"), output, F.lit(end_token))


def input_text(columns: Sequence[str]) -> Column:
    """Non-null columns joined by an empty line, white space at both ends removed."""
    joined = F.concat_ws("\n\n", *[named(name).cast("string") for name in columns])
    return F.regexp_replace(joined, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def chat_text(
    user: Column,
    system: str,
    system_turn: str = SYSTEM_TURN,
    user_opening: str = USER_OPENING,
    user_closing: str = USER_CLOSING,
) -> Column:
    """System and user turn as one text that ends in an open assistant turn."""
    opening = system_turn.replace("{text}", system) + user_opening
    return F.concat(F.lit(opening), user, F.lit(user_closing))


def conversation_text(
    turns: Column, turn: str = TURN, opening: str = ANSWER_OPENING
) -> Column:
    """Turns (array of structs role, text, in order) as one text that ends in an open assistant turn.

    A null text is an empty turn; a null array has no turns.
    """
    before, rest = turn.split("{role}")
    between, after = rest.split("{text}")
    parts = F.transform(
        turns,
        lambda t: F.concat(
            F.lit(before), t["role"], F.lit(between), F.coalesce(t["text"], F.lit("")), F.lit(after)
        ),
    )
    return F.concat(F.coalesce(F.array_join(parts, ""), F.lit("")), F.lit(opening))


def strip_prompt(output_ids: Column, input_ids: Column) -> Column:
    """The tokens generated after the prompt."""
    return F.slice(output_ids, F.size(input_ids) + 1, F.greatest(F.size(output_ids), F.lit(1)))
