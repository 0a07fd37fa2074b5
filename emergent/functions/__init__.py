"""Column-expression helpers (JVM-side, codegen-friendly; no Python UDFs)."""

from emergent.functions.items import (
    INDIRECT,
    INF,
    bridge_symbols,
    display_item,
    feature_tokens,
    finite_growth,
    growth_text,
    items_text,
    mesh_id,
    prefixed,
    restrict_prefix,
    sorted_text,
    strip_prefix_upper,
)

__all__ = [
    "INDIRECT", "INF", "bridge_symbols", "display_item", "feature_tokens", "finite_growth",
    "growth_text", "items_text", "mesh_id", "prefixed", "restrict_prefix",
    "sorted_text", "strip_prefix_upper",
]
