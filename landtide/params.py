"""Thresholds and per-country settings; nothing else in the library holds one."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # fixed values: spectral validity and quantisation
    scl_clear: tuple = (4, 5, 7)
    scl_water: int = 6
    snow_ndsi: float = 0.4
    snow_nir: float = 0.11
    snow_green: float = 0.10
    dark_nir: float = 0.04
    # fixed values: detection
    window_months: int = 3
    reference_years: tuple = (1, 2)
    water_months: int = 24
    water_q: int = 100
    least_obs: int = 3
    reference_q: int = 160
    current_q: int = 135
    drop_q: int = 30
    least_pixels: int = 20
    # fixed values: life cycle and merging
    recovery_ndvi: float = 0.50
    expiry_months: int = 3
    merge_cells: int = 2
    merge_months: int = 3
    # fixed values: parcels and permits
    sliver_m2: float = 200.0
    sliver_share: float = 0.5
    top_parcels: int = 40
    permit_months: int = 36
    permit_since: str = "2018-01-01"
    first_hits: int = 8
    least_declared: float = 0.5
    permanent_groups: tuple = (17, 18)
    feed_entries: int = 100


PARAMS = Params()


@dataclass(frozen=True)
class Country:
    code: str
    language: str
    data: str
    site: str
    site_prefix: str
    alert_prefix: str


# fixed values: the two countries
COUNTRIES = {
    "ES": Country("ES", "es", "data", "site", "", "CN"),
    "FR": Country("FR", "fr", "data/fr", "site/fr", "FR64_", "CF"),
}


def country(code: str) -> Country:
    if code not in COUNTRIES:
        raise ValueError(f"unknown country {code!r}")
    return COUNTRIES[code]
