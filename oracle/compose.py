"""Put the named building blocks a DuckDB query uses in front of it as CTEs."""

from __future__ import annotations

import re

from saldo.sources.demo_views import VIEWS, view_text


def compose(query: str, blocks: dict[str, str]) -> str:
    """``query`` and ``blocks`` refer to each other and to the demo views as ``{name}``."""
    texts = {name: view_text(name, "duckdb") for name in VIEWS} | blocks
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in texts and name not in order:
                visit(texts[name])
                if name not in order:
                    order.append(name)

    def plain(text: str) -> str:
        return re.sub(r"\{(\w+)\}", r"\1", text)

    visit(query)
    if not order:
        return plain(query)
    ctes = ",\n".join(f"{name} as ({plain(texts[name])})" for name in order)
    return f"with {ctes}\n{plain(query)}"
