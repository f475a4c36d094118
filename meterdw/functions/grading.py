"""Grading rules as column expressions: health scores, band statuses, reading statuses.

A rule set is plain data (`Profile`); the functions turn it into CASE expressions, so that
every grade stays inside whole-stage codegen. A NULL measure matches no tier and no
band and falls through to the last value, unless the rule set names a score for
missing values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORE_TYPE = "decimal(5,2)"


@dataclass(frozen=True)
class Tier:
    """One health tier: all named limits must hold."""

    score: str
    voltage: tuple[str, str]            # inclusive range
    temperature: str                    # strictly below
    power_factor: str | None = None     # strictly above
    frequency: tuple[str, str] | None = None


@dataclass(frozen=True)
class Health:
    tiers: tuple[Tier, ...]
    otherwise: str
    missing: str | None = None          # score where voltage, temperature or power factor is NULL or 0


# --- fixed values: health tiers ------------------------------------------------------
G1 = Health((Tier("95", ("200", "240"), "80", "0.9"),
             Tier("80", ("180", "260"), "90", "0.8")), "60")
G2 = Health((Tier("98", ("210", "230"), "70", "0.95", ("49.8", "50.2")),
             Tier("90", ("200", "240"), "80", "0.9", ("49.5", "50.5")),
             Tier("75", ("180", "260"), "90", "0.8")), "50")
G3 = Health((Tier("95", ("210", "230"), "70"),
             Tier("85", ("200", "240"), "80")), "70")
G4 = Health((Tier("95", ("200", "240"), "80"),
             Tier("80", ("180", "260"), "90")), "60")
G5 = Health(G1.tiers, "60", missing="50")

# --- fixed values: status bands, first match wins; ('>', limit, label) ----------------
VS3 = ((">", "240", "HIGH"), ("<", "200", "LOW"))
VS5 = ((">", "250", "CRITICAL_HIGH"), (">", "240", "HIGH"),
       ("<", "180", "CRITICAL_LOW"), ("<", "200", "LOW"))
TS3 = ((">", "80", "HIGH"), (">", "60", "MEDIUM"))
TS4 = ((">", "90", "CRITICAL_HIGH"), (">", "80", "HIGH"), (">", "60", "MEDIUM"))


def power_bands(high: str, low: str):
    return ((">", high, "HIGH"), ("<", low, "LOW"))


@dataclass(frozen=True)
class Profile:
    """The rule set of one pipeline variant."""

    health: Health = G1
    voltage: tuple = VS3
    temperature: tuple = TS3
    power: tuple = field(default_factory=lambda: power_bands("5000", "1000"))


MAIN = Profile()
GENERATED = Profile(G2, VS5, TS4, power_bands("4500", "2000"))
STORED_STREAM = Profile(power=power_bands("3500", "2500"))
BATCH = Profile(health=G5)


def _case(steps, otherwise: str) -> str:
    """CASE text over (condition, result) pairs; results are SQL literals."""
    arms = " ".join(f"WHEN {condition} THEN {result}" for condition, result in steps)
    return f"CASE {arms} ELSE {otherwise} END"


def _tier_holds(tier: Tier) -> str:
    holds = [f"voltage BETWEEN {tier.voltage[0]} AND {tier.voltage[1]}", f"temperature < {tier.temperature}"]
    if tier.power_factor is not None:
        holds.append(f"power_factor > {tier.power_factor}")
    if tier.frequency is not None:
        holds.append(f"frequency BETWEEN {tier.frequency[0]} AND {tier.frequency[1]}")
    return " AND ".join(holds)


def health(rule: Health) -> Column:
    """Health score of a reading; the measure columns carry their canonical names."""
    steps = [(_tier_holds(tier), tier.score) for tier in rule.tiers]
    if rule.missing is not None:
        absent = " OR ".join(f"coalesce({c}, 0) = 0" for c in ("voltage", "temperature", "power_factor"))
        steps.insert(0, (absent, rule.missing))
    return F.expr(f"CAST({_case(steps, rule.otherwise)} AS {SCORE_TYPE})")


def band(bands, measure: str) -> Column:
    """HIGH/LOW/... by the first band that matches, else NORMAL."""
    return F.expr(_case([(f"{measure} {side} {limit}", f"'{label}'") for side, limit, label in bands], "'NORMAL'"))


def grade(readings: DataFrame, profile: Profile = MAIN) -> DataFrame:
    """Readings plus health_score, voltage_status, temperature_status, power_status."""
    return readings.withColumns({
        "health_score": health(profile.health),
        "voltage_status": band(profile.voltage, "voltage"),
        "temperature_status": band(profile.temperature, "temperature"),
        "power_status": band(profile.power, "power"),
    })


# --- statuses --------------------------------------------------------------------------

VOLTAGE_OFF = "voltage_status <> 'NORMAL'"
OVERHEATED = "temperature_status IN ('HIGH', 'CRITICAL_HIGH')"
POWER_OFF = "power_status <> 'NORMAL'"
# never NULL: band statuses always carry a label
ABNORMAL = f"({VOLTAGE_OFF} OR {OVERHEATED})"


def _warn_if(condition: str) -> Column:
    return F.expr(_case([(condition, "'WARNING'")], "'NORMAL'"))


def reading_status(low_voltage: bool = True, zero_is_missing: bool = False) -> Column:
    """WARNING on a raw reading out of 200..240 V or above 80 degrees.

    `low_voltage=False` leaves the lower bound out; with `zero_is_missing` a voltage
    of 0 counts as not measured.
    """
    bad = ["voltage > 240", "temperature > 80"]
    if low_voltage:
        bad.append("(voltage < 200 AND voltage <> 0)" if zero_is_missing else "voltage < 200")
    return _warn_if(" OR ".join(bad))


def graded_status() -> Column:
    """WARNING when the voltage or temperature grade is off."""
    return _warn_if(ABNORMAL)


def four_level_status() -> Column:
    """CRITICAL, WARNING, ATTENTION (health below 80) or NORMAL."""
    critical = "voltage_status IN ('CRITICAL_HIGH', 'CRITICAL_LOW') OR temperature_status = 'CRITICAL_HIGH'"
    return F.expr(_case([(critical, "'CRITICAL'"), (ABNORMAL, "'WARNING'"), ("health_score < 80", "'ATTENTION'")],
                        "'NORMAL'"))


def window_status_text(*counters: str) -> str:
    """WARNING when any abnormal counter is positive, else FAULT below an average health of 70."""
    positive = " OR ".join(f"{c} > 0" for c in counters)
    return _case([(positive, "'WARNING'"), ("avg_health_score < 70", "'FAULT'")], "'NORMAL'")


def window_console_status() -> Column:
    return _warn_if("abnormal_count > 0")
