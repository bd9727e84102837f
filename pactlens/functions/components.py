"""Spark SQL expressions over amount containers: ``map<category, map<component, raw amount>>``."""

from __future__ import annotations

import re

from pactlens.config import ReportConfig
from pactlens.functions.scalars import MONEY, lenient_element, quoted, trimmed, trimmed_element

# What names mark a component as not belonging to the administrator.
COMMON_PARTS = ["DEALER", "DLR", "COMMISSION", "COMM", "F&I", "PACK"]
COMMON_NAMES = ["LOANPMT", "LOANPAYMENT"]
RESERVE_NAMES = ["CLIPFEE", "PREMIUMTAX", "CEDINGFEE", "ADMIN", "SLUSH"]
RESERVE_PARTS = ["PREMIUM TAX", "CEEDING", "CEDING", "CLIP FEE", "OEM TRANSPORT"]
ADMIN_NAMES = ["ROADSIDEADMIN", "OTHERCOMM", "PREMTAX", "AGENTNCB"]
ADMIN_PARTS = ["ROADSIDE AKMC"]


def named(value: str, names: list[str], parts: list[str]) -> str:
    """Whether an upper-cased, trimmed value equals one of the names or holds one of the parts."""
    upper = f"upper({trimmed(value)})"
    held = "|".join(re.escape(p) for p in parts).replace("\\", "\\\\")
    by_part = f"{upper} RLIKE '{held}'"
    return f"({by_part} OR {upper} IN ({quoted(*names)}))" if names else f"({by_part})"


def _is_named(upper: str, names: list[str], parts: list[str]) -> str:
    """``named`` of a value that is upper-cased and trimmed already, in cheap tests: lambdas are not compiled."""
    tests = [f"contains({upper}, {quoted(p)})" for p in parts]
    return f"({' OR '.join([*tests, f'{upper} IN ({quoted(*names)})'] if names else tests)})"


def _common_names(cfg: ReportConfig) -> list[str]:
    return COMMON_NAMES + list(cfg.excluded_component_codes)


def _common(value: str, cfg: ReportConfig) -> str:
    return named(value, _common_names(cfg), COMMON_PARTS)


_SPECIFIC = {"RESERVE": (RESERVE_NAMES, RESERVE_PARTS), "ADMIN": (ADMIN_NAMES, ADMIN_PARTS)}


def excluded_component(name: str, category: str, cfg: ReportConfig) -> str:
    """True for components left out of the ADMIN or RESERVE amount."""
    return f"({_common(name, cfg)} OR {named(name, *_SPECIFIC[category])})"


def gross_income_excluded(category: str, name: str, cfg: ReportConfig) -> str:
    """True for components left out of gross income, by their own or their category's name."""
    return f"({named(category, [], COMMON_PARTS)} OR {_common(name, cfg)})"


def total(entries: str, amount: str) -> str:
    """Sum of ``amount``, an expression in ``e``, over an array; 0 if there is none."""
    zero = f"cast(0 AS {MONEY})"
    return (
        f"coalesce(aggregate({entries}, {zero}, (acc, e) -> cast(acc + {amount} AS {MONEY})), {zero})"
    )


def cells(container: str) -> str:
    """All amounts of a container as one array, each parsed once.

    ``ordinal`` is the place of the category, ``upper_category`` and ``name`` what it and the component are judged by.
    """
    return (
        f"flatten(transform(map_entries({container}), (c, i) -> transform("
        f"coalesce(map_entries(c.value), array()), e -> named_struct('ordinal', i,"
        f" 'category', upper(c.key), 'component', e.key, 'amount', {lenient_element('e.value')},"
        f" 'upper_category', upper({trimmed_element('c.key')}), 'name', upper({trimmed_element('e.key')})))))"
    )


def counted_cells(cells_: str, cfg: ReportConfig) -> str:
    """The cells without those that the exclusion all sums share leaves out."""
    return f"filter({cells_}, f -> NOT {_is_named('f.name', _common_names(cfg), COMMON_PARTS)})"


def category_place(container: str, category: str) -> str:
    """Place of the first category of that name, whatever its case and padding; -1 if none."""
    return (
        f"array_position(transform(map_keys({container}), k -> upper({trimmed_element('k')})), '{category}') - 1"
    )


def included_amount(cells_: str, counted: str, category: str, places: dict[str, str]) -> str:
    """ADMIN or RESERVE amount. ADMIN of the RESERVE category is always an ADMIN amount."""
    kept = f"f.ordinal = {places[category]} AND NOT {_is_named('f.name', *_SPECIFIC[category])}"
    amount = total(f"filter({counted}, f -> {kept})", "e.amount")
    if category == "RESERVE":
        return amount
    # another category's cells: none is counted twice
    always = f"f.ordinal = {places['RESERVE']} AND f.name = 'ADMIN'"
    return f"cast({amount} + {total(f'filter({cells_}, f -> {always})', 'e.amount')} AS {MONEY})"


def gross_income(counted: str) -> str:
    """Sum of every component of every category that is not excluded."""
    kept = f"NOT {_is_named('f.upper_category', [], COMMON_PARTS)}"
    return total(f"filter({counted}, f -> {kept})", "e.amount")


def component_list(container: str, cells_: str) -> str:
    """Cleaned components as ``array<struct<category, component, amount>>``.

    Of two spellings of one category the later value counts.
    """
    names = f"transform(map_keys({container}), n -> upper(n))"
    last_only = (
        f"filter({cells_}, (e, i) -> NOT exists(slice({cells_}, i + 2, size({cells_})),"
        f" o -> o.category = e.category AND o.component = e.component))"
    )
    return (
        f"transform(CASE WHEN size(array_distinct({names})) = size({container}) THEN {cells_}"
        f" ELSE {last_only} END, e -> named_struct('category', e.category,"
        f" 'component', e.component, 'amount', e.amount))"
    )
