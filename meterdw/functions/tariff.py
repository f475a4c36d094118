"""Energy prices per kWh, as SQL text."""

from __future__ import annotations

# fixed values
FLAT = "0.6"
PEAK, SHOULDER, VALLEY = "0.8", "0.6", "0.4"
PEAK_HOURS = ((8, 11), (18, 21))
SHOULDER_HOURS = ((12, 17), (22, 23))


def _within(hour: str, ranges) -> str:
    return " OR ".join(f"{hour} BETWEEN {first} AND {last}" for first, last in ranges)


def time_of_use_rate(hour: str) -> str:
    return (f"CASE WHEN {_within(hour, PEAK_HOURS)} THEN {PEAK} "
            f"WHEN {_within(hour, SHOULDER_HOURS)} THEN {SHOULDER} ELSE {VALLEY} END")


def flat_cost(energy: str) -> str:
    return f"{energy} * {FLAT}"


def time_of_use_cost(hour: str, energy: str) -> str:
    return f"{energy} * {time_of_use_rate(hour)}"
