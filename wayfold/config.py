"""Settings of the matcher, with the shipped tuning values as defaults."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class MatchConfig:
    """Frozen, so that plans carry values instead of process-wide state."""

    sigma: float = 4.07
    beta_lambda: float = 3.0
    radius_m: float = 25.0
    max_distance_m: float = 1500.0
    min_interval_ms: int = 5000
    min_distance_m: float = 10.0
    seqprob_delta_min: float = -10.0
    max_inputs: int = 1000
    connect: bool = True  # False: routes within one edge only
    bin_size_m: float = 10.0
    filter_estimates: bool = False  # rows of kind `filtered` too: the likeliest candidate of each sample so far

    @classmethod
    def from_properties(cls, text: str, **changes) -> MatchConfig:
        """Reads `key=value` lines; # and ! start comments; unknown keys are ignored."""
        # The property names of the tuning file.
        names = {
            "matcher.sigma": "sigma",
            "matcher.lambda": "beta_lambda",
            "matcher.radius.max": "radius_m",
            "matcher.distance.max": "max_distance_m",
            "matcher.interval.min": "min_interval_ms",
            "matcher.distance.min": "min_distance_m",
            "matcher.seqprobdelta.min": "seqprob_delta_min",
        }
        types = {f.name: f.type for f in fields(cls)}
        found = {}
        for line in text.splitlines():
            key, sep, value = line.strip().partition("=")
            if sep and key[:1] not in "#!" and (name := names.get(key.strip())):
                found[name] = int(float(value)) if types[name] == "int" else float(value)
        return replace(cls(), **(found | changes))
