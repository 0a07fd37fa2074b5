"""Scalar and array expressions used by the operators (P3-P18 of the survey).

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen / JVM higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source semantics.
INF = float("inf")
FINITE_STAND_IN = 999999.0          # stand-in for an infinite growth rate in tolerance tests
INDIRECT = "indirect"               # bridge text when the intersection is empty
MESH_PREFIX = "MESH:"               # label ids are normalised to this scheme for bridge lookup


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefixed(prefix: str, c: Column | str) -> Column:
    """``prefix + value`` (value cast to string)."""
    return F.concat(F.lit(prefix), _col(c).cast("string"))


def mesh_id(c: Column | str) -> Column:
    """Add ``MESH:`` unless the id already carries it."""
    s = _col(c).cast("string")
    return F.when(s.startswith(MESH_PREFIX), s).otherwise(F.concat(F.lit(MESH_PREFIX), s))


def strip_prefix_upper(c: Column | str, prefix: str) -> Column:
    """Remove every occurrence of ``prefix`` and upper-case."""
    return F.upper(F.replace(_col(c), F.lit(prefix), F.lit("")))


def feature_tokens(names: Column | str, prefix: str = "TARGET_") -> Column:
    """``prefix + name.replace(' ', '_')`` per non-empty name, first occurrence kept."""
    kept = F.filter(_col(names), lambda n: n.isNotNull() & (n != F.lit("")))
    return F.array_distinct(
        F.transform(kept, lambda n: F.concat(F.lit(prefix), F.replace(n, F.lit(" "), F.lit("_")))))


def bridge_symbols(symbols: Column | str) -> Column:
    """Upper-cased, de-duplicated, non-empty symbols."""
    kept = F.filter(_col(symbols), lambda g: g.isNotNull() & (g != F.lit("")))
    return F.array_distinct(F.transform(kept, lambda g: F.upper(g)))


def restrict_prefix(arr: Column | str, *prefixes: str) -> Column:
    """Keep only the items carrying one of the prefixes."""
    def carries(x: Column) -> Column:
        out = F.lit(False)
        for p in prefixes:
            out = out | x.startswith(p)
        return out

    return F.filter(_col(arr), carries)


def items_text(arr: Column | str, sep: str = " ") -> Column:
    """Sorted items joined to text (deterministic output form of an item set)."""
    return F.array_join(F.array_sort(_col(arr)), sep)


def sorted_text(arr: Column | str, sep: str = ", ") -> Column:
    """Set joined to text, sorted so the output is deterministic."""
    return F.array_join(F.array_sort(_col(arr)), sep)


def finite_growth(gr: Column | str) -> Column:
    """Finite stand-in for an infinite growth rate."""
    g = _col(gr)
    return F.when(g == F.lit(INF), F.lit(FINITE_STAND_IN)).otherwise(g)


def fixed2(x: Column | str) -> Column:
    """Two-decimal text of the exact binary value, exact ties to the even digit (1.125 -> 1.12)."""
    return F.replace(F.format_number(_col(x), 2), F.lit(","), F.lit(""))


def growth_text(gr: Column | str) -> Column:
    """The infinity sign for a jumping pattern, else two decimals."""
    g = _col(gr)
    return F.when(g.isNull() | (g == F.lit(INF)), F.lit("∞")).otherwise(fixed2(g))


def display_item(item: Column | str, label_name: Column | None = None,
                 label_prefix: str = "LABEL_",
                 feature_prefixes: tuple[str, ...] = ("BRAND_", "TYPE_", "SIZE_", "WORD_",
                                                      "TARGET_", "GENE_")) -> Column:
    """P10: label item -> 【name】, feature/bridge item -> [item], anything else as is."""
    it = _col(item)
    name = label_name if label_name is not None else it.substr(F.lit(len(label_prefix) + 1), F.length(it))
    is_feature = F.lit(False)
    for p in feature_prefixes:
        is_feature = is_feature | it.startswith(p)
    return (F.when(it.startswith(label_prefix), F.concat(F.lit("【"), name, F.lit("】")))
            .when(is_feature, F.concat(F.lit("["), it, F.lit("]")))
            .otherwise(it))
