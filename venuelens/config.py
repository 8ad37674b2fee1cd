"""Parameters of the engine: scopes, support floors, filters and cleaning rules.

Operators take these objects as arguments; none of them reads a global.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Bands:
    """Left-closed intervals ``[edges[i], edges[i+1])``; a ``None`` last edge is open."""

    edges: Sequence[float | None]
    labels: Sequence[str]

    def __post_init__(self) -> None:
        if len(self.edges) != len(self.labels) + 1:
            raise ValueError("bands need exactly one more edge than labels")
        if any(edge is None for edge in self.edges[:-1]):
            raise ValueError("only the last edge of a band list may be open")


# ---------------------------------------------------------------------------
# The domain constants every result depends on.
# ---------------------------------------------------------------------------
COUNTRY_NAMES: Mapping[int, str] = {
    1: "India",
    14: "Australia",
    30: "Brazil",
    37: "Canada",
    94: "Indonesia",
    148: "New Zealand",
    162: "Philippines",
    166: "Qatar",
    184: "Singapore",
    189: "South Africa",
    191: "Sri Lanka",
    208: "Turkey",
    214: "UAE",
    215: "United Kingdom",
    216: "United States",
}

PRICE_LABELS: Mapping[int, str] = {
    1: "1 - Budget",
    2: "2 - Mid-range",
    3: "3 - Premium",
    4: "4 - Luxury",
}

METRO_CITIES = ("New Delhi", "Gurgaon", "Noida", "Faridabad", "Ghaziabad")

# Cost bands of the fact table, in the home currency.
COST_BANDS = Bands(
    edges=(0, 200, 500, 1000, 2000, None),
    labels=("< 200", "200-500", "500-1000", "1000-2000", "2000+"),
)

# Finer cost bands of the cost-versus-rating trend.
TREND_BANDS = Bands(
    edges=(0, 200, 400, 600, 800, 1200, 1600, 2400, None),
    labels=("<200", "200-400", "400-600", "600-800", "800-1200", "1200-1600", "1600-2400", "2400+"),
)

# Half-star rating bands; the last edge lets a full 5.0 in.
RATING_BANDS = Bands(
    edges=(1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.01),
    labels=("1.0-1.5", "1.5-2.0", "2.0-2.5", "2.5-3.0", "3.0-3.5", "3.5-4.0", "4.0-4.5", "4.5-5.0"),
)

UNKNOWN_COUNTRY = "Unknown"
UNSPECIFIED_CUISINE = "Unspecified"
NOT_RATED = "Not rated"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Floors:
    """Minimum support before a venue or group is ranked or benchmarked."""

    votes: int = 50
    city: int = 20
    cuisine: int = 30
    locality: int = 15


@dataclass(frozen=True)
class Scope:
    """The home market: money is comparable only inside one currency."""

    home_country: str = "India"
    home_currency: str = "Indian Rupees"
    metro_cities: Sequence[str] = METRO_CITIES


@dataclass(frozen=True)
class CleaningRules:
    """Everything that turns raw rows into the star schema."""

    scope: Scope = field(default_factory=Scope)
    floors: Floors = field(default_factory=Floors)
    price_labels: Mapping[int, str] = field(default_factory=lambda: dict(PRICE_LABELS))
    cost_bands: Bands = COST_BANDS
    unknown_country: str = UNKNOWN_COUNTRY
    unspecified_cuisine: str = UNSPECIFIED_CUISINE
    not_rated: str = NOT_RATED
    # Flag columns that are dropped when they never vary.
    constant_candidates: Sequence[str] = ("switch_to_order_menu",)


@dataclass(frozen=True)
class FilterSpec:
    """One filter context. An empty field filters nothing; the fields are ANDed."""

    cities: Sequence[str] = ()
    cuisines: Sequence[str] = ()
    price_tiers: Sequence[int] = ()
    delivery_only: bool = False
    booking_only: bool = False
    rated_only: bool = False
    credible_only: bool = False
    min_rating: float = 0.0
    search: str = ""
