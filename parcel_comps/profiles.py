"""The two rule sets for resolving parcels and finding comps.

The batch scripts and the live service disagree in a handful of places. Every
disagreement is one field here, so a caller may also mix them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    name: str
    # Land targets keep neighbours of any lot size.
    skip_size_for_land: bool
    # "computed": acres measured on the polygon; "stored": the acreage column.
    acres_source: str
    # Measured acres leave holes out.
    net_of_holes: bool
    # Listings without a plausible containing parcel are matched by address.
    address_fallback: bool
    # near_same_street is only tested when near_similar_size did not fire.
    exclusive_reasons: bool
    # Candidates must have <= 2 parts, <= 2 holes and stay near the target centroid.
    shape_screen: bool
    # A point within ``contain_tol_deg`` of the polygon counts as inside; 0 is
    # strict containment with the boundary outside.
    contain_tol_deg: float
    # "metres" or "degrees" for the touching tolerance.
    touch_unit: str
    touch_tol: float
    # Comp types compare trimmed and case-insensitive, or exactly.
    exact_types: bool
    # A lot size of 0 means "not reported".
    zero_lot_is_missing: bool
    # Only Single Family and Land listings are resolved at all.
    eligible_listings_only: bool
    # Same-street and punctuation rules use Unicode word characters.
    unicode_words: bool
    # compute_gap re-checks lot size on acres rounded to two decimals.
    recheck_size: bool
    # "flat": one length of a degree everywhere; "wgs84": lot sizes and distances on the ellipsoid.
    earth: str = "flat"


SERVICE = Profile(
    name="service",
    skip_size_for_land=False,
    acres_source="stored",
    net_of_holes=True,
    address_fallback=False,
    exclusive_reasons=False,
    shape_screen=True,
    contain_tol_deg=0.0,
    touch_unit="metres",
    touch_tol=5.0,
    exact_types=False,
    zero_lot_is_missing=False,
    eligible_listings_only=False,
    unicode_words=False,
    recheck_size=False,
)

BATCH = Profile(
    name="batch",
    skip_size_for_land=True,
    acres_source="computed",
    net_of_holes=False,
    address_fallback=True,
    exclusive_reasons=True,
    shape_screen=False,
    contain_tol_deg=0.00005,
    touch_unit="degrees",
    touch_tol=0.00005,
    exact_types=True,
    zero_lot_is_missing=True,
    eligible_listings_only=True,
    unicode_words=True,
    recheck_size=True,
)


def get_profile(profile: str | Profile) -> Profile:
    if isinstance(profile, Profile):
        return profile
    try:
        return {"service": SERVICE, "batch": BATCH}[profile]
    except KeyError:
        raise ValueError(f"unknown profile {profile!r}, expected 'service' or 'batch'") from None
