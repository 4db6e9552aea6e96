"""Business constants, all overridable per job."""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    """Money is in cents (``BIGINT``), percentages are plain numbers.

    The defaults are fixed values: they must equal the published ones for the
    results to agree.
    """

    # --- fixed values ---------------------------------------------------
    pos_bonus_me: int = 2
    demand_depth: int = 2_000_000_000 * 100
    supply_depth: int = 2_000_000_000 * 100
    notable_demand: int = 300_000_000 * 100
    notable_supply: int = 20_000_000 * 100
    buys_max_below_break: Decimal = Decimal("1.20")
    sells_min_above_break: Decimal = Decimal("1.05")
    order_relevancy_days: int = 2
    spread_overshoot: int = 7
    deep_transport_m3: int = 71_500
    jump_freighter_m3: int = 348_000
    build_list_transport_m3: int = 80_500
    build_cost_multiplier: Decimal = Decimal("1.03")
    sales_cost_multiplier: Decimal = Decimal("1.02")
    hub_region: int = 10_000_002
    # 10000033 The Citadel, 10000064 Essence, 10000037 Everyshore, 10000067 Genesis,
    # 10000048 Placid, 10000068 Verge Vendor, then the trade hubs 10000043 Domain,
    # 10000002 The Forge, 10000030 Heimatar, 10000042 Metropolis, 10000032 Sinq Laison
    regions_of_interest: tuple[int, ...] = (
        10_000_033, 10_000_064, 10_000_037, 10_000_067, 10_000_048, 10_000_068,
        10_000_043, 10_000_002, 10_000_030, 10_000_042, 10_000_032,
    )
    # --- sizing ---------------------------------------------------------
    cell_rows: int = 4096
    """A window over orders never holds more different (price, quantity) than this of a group."""
    radix_bits: int = 12
    """Bits by which a larger cell is divided at a time."""
    task_rows: int = 500_000
    """Orders a task gets where whole groups meet, on the average."""
    piece_rows: int = 1_000_000
    """Different (price, quantity) folded at a time where every order is rounded."""

    def but(self, **changes) -> "Params":
        return replace(self, **changes)
