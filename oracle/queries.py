"""All DuckDB twins by query name, with the blocks they use written out as CTEs."""

from __future__ import annotations

import re

from oracle import book, buffer, tables
from oracle.compose import compose

BLOCKS = book.BLOCKS | buffer.BLOCKS


def _whole(query: str) -> str:
    """Merge a query's own WITH list into the list of the blocks."""
    text = compose(query, BLOCKS)
    own = re.search(r"\)\n\s*with (recursive )?", text)
    if own:
        text = text[:own.start()] + "),\n" + text[own.end():]
        if own.group(1):
            text = text.replace("with ", "with recursive ", 1)
    return text


ORACLE = {name: _whole(text) for group in (book, buffer, tables) for name, text in group.QUERIES.items()}
