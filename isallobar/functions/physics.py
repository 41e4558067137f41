"""Thermodynamic and dynamical quantities as Catalyst column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants.
EARTH_RADIUS_M = 6_371_000.0
ROTATION = 7.292115e-5  # rad/s
GRAVITY = 9.80665  # m/s2
GAS_CONSTANT = 287.05  # dry air, J/(kg K)
HEAT_CAPACITY = 1004.0  # dry air at constant pressure, J/(kg K)
LATENT_HEAT = 2.501e6  # vaporisation at 0 C, J/kg
MOLAR_RATIO = 0.622  # water vapour to dry air
REFERENCE_HPA = 1000.0
LEAST_HUMIDITY = 1e-9  # kg/kg
PASCALS_PER_HPA = 100.0


def potential_temperature(temperature: Column, hpa: Column) -> Column:
    """Potential temperature (K) at a pressure in hPa."""
    return temperature * F.pow(REFERENCE_HPA / hpa, F.lit(GAS_CONSTANT / HEAT_CAPACITY))


def mixing_ratio(humidity: Column) -> Column:
    """Mixing ratio of a specific humidity (kg/kg)."""
    return humidity / (1.0 - humidity)


def clamped_humidity(humidity: Column) -> Column:
    """Specific humidity with a positive floor, so that logarithms exist; missing values stay missing."""
    return F.when(humidity.isNotNull(), F.greatest(humidity, F.lit(LEAST_HUMIDITY)))


def equivalent_potential_temperature(temperature: Column, humidity: Column, hpa: Column) -> Column:
    """Equivalent potential temperature (K), Bolton (1980) equation 43."""
    ratio = mixing_ratio(clamped_humidity(humidity))
    vapour = ratio / (MOLAR_RATIO + ratio) * hpa
    saturation = F.ln(vapour / 6.112)
    dewpoint = 243.5 * saturation / (17.67 - saturation) + 273.15
    condensation = 1.0 / (1.0 / (dewpoint - 56.0) + F.ln(temperature / dewpoint) / 800.0) + 56.0
    return potential_temperature(temperature, hpa) * F.exp(LATENT_HEAT * ratio / (HEAT_CAPACITY * condensation))


def coriolis(lat: Column) -> Column:
    """Coriolis parameter (1/s) of a latitude in degrees."""
    return 2.0 * ROTATION * F.sin(F.radians(lat))


def to_hpa(pascals: Column) -> Column:
    return pascals / PASCALS_PER_HPA


def nan_to_zero(x: Column) -> Column:
    """Missing values, NaN or null, as zero."""
    return F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))


def nan_to_null(x: Column) -> Column:
    """NaN as null: inside the engine missing values are null, so comparisons drop them."""
    return F.when(~F.isnan(x), x)


def squashed(x: Column, scale: float) -> Column:
    """A clue squeezed into (-1, 1)."""
    return F.tanh(x / F.lit(scale))
