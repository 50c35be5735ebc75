"""Prompt assembly and request envelopes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{(\w+)\}")

# The question/passage prompt, the chat wrapper around it and
# the request settings, as the retrieval example states them.
PASSAGE_TEMPLATE = "{question} using following \n            <text>\n            {passage}\n            <text>\n            "
CHAT_WRAPPER = "\n\nHuman: {prompt}\"\n\nAssistant:"
MAX_TOKENS = 300
TEMPERATURE = 0.1
TOP_P = 0.9


def fill_template(template: str, **slots) -> Column:
    """Fill ``{name}`` slots of a template from columns, in one ``concat``.

    Null slot values become empty strings so one missing passage does not
    null the whole prompt.
    """
    parts, pos = [], 0
    for m in _SLOT.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        val = slots[m.group(1)]
        val = F.col(val) if isinstance(val, str) else val
        parts.append(F.coalesce(val.cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def request_body(prompt, max_tokens: int = MAX_TOKENS, temperature: float = TEMPERATURE,
                 top_p: float = TOP_P, wrapper: str = CHAT_WRAPPER) -> Column:
    """JSON request for a text-completion call, prompt in the chat wrapper (X11)."""
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.to_json(F.struct(
        fill_template(wrapper, prompt=p).alias("prompt"),
        F.lit(int(max_tokens)).alias("max_tokens_to_sample"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(float(top_p)).alias("top_p"),
    ), {"ignoreNullFields": "false"})
