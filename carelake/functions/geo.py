"""Projection to metres and market arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# WGS84 ellipsoid and the UTM grid of zone 37 south.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0
CENTRAL_MERIDIAN = 39.0


def utm37s(lon, lat) -> tuple[Column, Column]:
    """Easting and northing in metres: Krüger's transverse Mercator series, third order."""
    n = FLATTENING / (2 - FLATTENING)
    rectifying = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    ]
    e = 2 * math.sqrt(n) / (1 + n)

    phi = F.radians(_c(lat))
    lam = F.radians(_c(lon) - CENTRAL_MERIDIAN)
    t = F.sinh(F.atanh(F.sin(phi)) - F.atanh(F.sin(phi) * e) * e)
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(t * t + 1))
    east, north = eta, xi
    for j, a in enumerate(alpha, start=1):
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
    return (
        east * (SCALE * rectifying) + FALSE_EASTING,
        north * (SCALE * rectifying) + FALSE_NORTHING,
    )


# Yearly growth and the years from the census to the projection.
GROWTH_RATE = 0.042
YEARS = 2026 - 2019


def projected_population(base, poi_count=None) -> Column:
    """Whole people after growth; 0 where the area has no point of interest."""
    grown = F.floor(_c(base) * F.pow(F.lit(1 + GROWTH_RATE), F.lit(YEARS))).cast("bigint")
    if poi_count is None:
        return grown
    return F.when(F.coalesce(_c(poi_count), F.lit(0)) > 0, grown).otherwise(F.lit(0).cast("bigint"))


# Keywords of each demand category, and the advice texts.
KEYWORDS = {
    "lifestyle_drivers": ["gym", "fitness", "salon", "beauty", "spa", "barber"],
    "social_drivers": ["bar", "pub", "nightclub", "wines", "spirits", "restaurant", "liquor"],
    "competition": ["pharmacy", "chemist", "hospital", "clinic", "dawa"],
}
ADVICE = {
    "urgent": "URGENT: Price-match competitors. Channel shift to WhatsApp Delivery.",
    "stable": "STABLE: Maintain margins. Focus on loyalty.",
    "upsell": "UPSELL: Target Gyms/Salons. Grow Beauty (20% -> 25%) & Body Building (3% -> 8%).",
    "night": "NIGHT ECONOMY: High impulse-buy potential. Stock Sexual Health & Recovery.",
    "core": "CORE: Protect Chronic care. Stock for regular patient refills.",
}


def keyword_hit(text: Column, category: str) -> Column:
    return F.lower(text).rlike("|".join(KEYWORDS[category]))


def strategy(pressure, lifestyle, social) -> Column:
    price = F.when(_c(pressure) > 3, ADVICE["urgent"]).otherwise(ADVICE["stable"])
    market = (
        F.when(_c(lifestyle) > 10, ADVICE["upsell"])
        .when(_c(social) > 50, ADVICE["night"])
        .otherwise(ADVICE["core"])
    )
    return F.concat_ws(" | ", price, market)
