"""Report parameters."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date


def parse_as_of(args: Sequence[str], today: date | None = None) -> date:
    """As-of date from ``--as-of D``, from a bare ``YYYY-MM-DD`` argument, or today."""
    args = list(args)
    raw = None
    if "--as-of" in args and args.index("--as-of") + 1 < len(args):
        raw = args[args.index("--as-of") + 1]
    if not raw:
        raw = next((a for a in args if re.fullmatch(r"\d{4}-\d{2}-\d{2}", a)), None)
    if not raw:
        return today or date.today()
    try:
        return date.fromisoformat(raw)
    except ValueError as err:
        raise ValueError("--as-of needs a day such as 2026-07-31") from err


@dataclass(frozen=True)
class ReportConfig:
    """Everything a report run is parameterised by.

    ``as_of`` always belongs to an open month: the reporting month is the one before it,
    even when ``as_of`` is the last day of its month.
    """

    as_of: date
    inception_start: date = date(2010, 1, 1)
    company_name: str = "PORTFOLIO"
    top_dealer_count: int = 20
    warning_loss_ratio: float = 0.75
    high_loss_ratio: float = 0.9
    excluded_component_codes: tuple[str, ...] = ()
    # pairs of (code, name) that name the same agent
    entity_aliases: tuple[tuple[str, str], ...] = ()
    market_states: tuple[str, ...] = ("FL", "FLORIDA")
    market_zip_prefixes: tuple[str, ...] = ("32", "33", "34")
    low_admin_fee: float = 20.0

    def __post_init__(self):
        if self.top_dealer_count < 1:
            raise ValueError("top_dealer_count: at least 1 is needed")
        for name in ("warning_loss_ratio", "high_loss_ratio"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name}: a ratio cannot be below 0")

    @classmethod
    def from_args(cls, args: Sequence[str], env: Mapping[str, str] | None = None) -> ReportConfig:
        """Configuration of a command-line run; thresholds come from the environment."""
        env = os.environ if env is None else env
        codes = env.get("EXCLUDED_COMPONENT_CODES", "").split(",")
        return cls(
            as_of=parse_as_of(args),
            company_name=env.get("REPORT_COMPANY_NAME", "").strip() or "PORTFOLIO",
            top_dealer_count=int(env.get("TOP_DEALER_COUNT", "").strip() or 20),
            warning_loss_ratio=float(env.get("LOSS_RATIO_WARNING", "").strip() or 0.75),
            high_loss_ratio=float(env.get("LOSS_RATIO_HIGH", "").strip() or 0.9),
            excluded_component_codes=tuple(c.strip().upper() for c in codes if c.strip()),
        )
