"""Clean-up of model responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flags: s = dot matches newline, d = only \n ends a line, so $ means "end, or before one last \n".
# The markers and the stop texts are those the scoring tasks define.
THINK_BLOCK = "(?s)<think>.*?</think>"
THINK_PREAMBLE = r"(?sd)\AThinking Process:.*?(?=```python|```\n|Here is|My solution|$)"
PYTHON_BLOCK = r"(?s)```python\n(.*?)\n?```"
ANY_BLOCK = r"(?s)```[\p{L}\p{N}_]*\n(.*?)\n?```"
# end of fixed values

SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip_left(c: Column) -> Column:
    """Remove leading white space of any script, control separators included."""
    return F.regexp_replace(c, rf"\A{SPACE}+", "")


def strip_right(c: Column) -> Column:
    return F.regexp_replace(c, rf"{SPACE}+\z", "")


def strip_think(c: Column) -> Column:
    """Drop closed think blocks, then a plain-text preamble at the very start, then leading white space.

    The preamble is looked for before white space goes, so one that only starts the text after a removed
    block and a line break stays.
    """
    return strip_left(F.regexp_replace(F.regexp_replace(c, THINK_BLOCK, ""), THINK_PREAMBLE, ""))


def extract_code(c: Column) -> Column:
    """Last python block, else last block of any language, else the empty string."""
    last = F.try_element_at(F.regexp_extract_all(c, F.lit(PYTHON_BLOCK), 1), F.lit(-1))
    other = F.try_element_at(F.regexp_extract_all(c, F.lit(ANY_BLOCK), 1), F.lit(-1))
    return F.coalesce(last, other, F.lit(""))


def completion(cleaned: Column, code: Column, prompt: Column) -> Column:
    """Program to score for a prompt that is itself the start of the program."""
    is_solution = (code != "") & (code.contains("def ") | code.contains("return "))
    has_prompt = code.contains(strip_right(prompt))
    before_fence = F.substring_index(cleaned, "```", 1)
    return F.when(is_solution & has_prompt, code).when(is_solution, F.concat(prompt, code)).otherwise(
        F.concat(prompt, before_fence)
    )
