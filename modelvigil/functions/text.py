"""Column functions on text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a general-purpose strip removes (Unicode white space plus the four
# ASCII separators). SQL trim alone removes only the space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column, min_length: int) -> Column:
    """True for null text and for text shorter than ``min_length`` once stripped; never null."""
    return F.coalesce(F.length(strip(text)) < min_length, F.lit(True))


def identity(text: Column) -> Column:
    return text


def truncate(text: Column, max_chars: int) -> Column:
    return F.substring(text, 1, max_chars)


def replace_first(text: Column, find: str, replacement: str) -> Column:
    """Replace the first occurrence of a literal."""
    at = F.instr(text, find)
    head = F.substring(text, F.lit(1), at - 1)
    tail = F.substring(text, at + len(find), F.length(text))
    return F.when(at > 0, F.concat(head, F.lit(replacement), tail)).otherwise(text)


def normalize_prediction(raw: Column, vocabulary: Sequence[str], invalid: str = "INVALID") -> Column:
    """Map free text to the first label of the vocabulary it mentions, in either spelling."""
    lowered = F.lower(raw)
    mentions = [
        F.when(lowered.contains(v.lower().replace("_", " ")) | lowered.contains(v.lower()), F.lit(v))
        for v in vocabulary
    ]
    return F.coalesce(*mentions, F.lit(invalid))


def format_chat(system: str, user: Column, template: str | None = None) -> Column:
    """Prompt text of one system and one user message, ending where the answer begins."""
    template = template or CHAT_TEMPLATE
    before, after = template.replace("{system}", system).split("{user}")
    return F.concat(F.lit(before), user, F.lit(after))


# The public ChatML layout.
CHAT_TEMPLATE = (
    "<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n{user}<|im_end|>\n<|im_start|>assistant\n"
)
