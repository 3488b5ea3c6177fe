"""Hidden Markov chains as frames: any states, emissions and transitions given as rows.

The forward (filter) probabilities and the likeliest sequence of states, each as a scan
over pieces of a trace (see pieces): products of matrices, (+, *) for the filter and
(max, +) of logarithms for the sequence, so that a chain of any length is work for many
tasks. States that no survivor of the step before leads to are left out; where none is
reached the chain starts anew, with the emissions alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.operators import kernel, pieces
from wayfold.shared import materialize

_OUT = "trace string, t long, state string, filter double, log double, before string, chosen boolean"


class _Rows:
    """What pieces asks of a graph: here states are told by name, and transitions come with their step."""

    find = name = ref = staticmethod(str)

    @staticmethod
    def prepared(before: list, last, s: dict):
        now = [(kernel.Candidate(state, fraction, 0.0, 0.0), p) for state, fraction, p, _, _ in s["found"]]
        place = {c.edge: k for k, (c, _) in enumerate(now)}
        ways: dict[str, dict[int, tuple]] = {}
        for a, b, p in s["ways"]:
            if b in place:
                ways.setdefault(a, {})[place[b]] = (p, (0.0, 0.0, []))
        return now, lambda p: ways.get(p.edge, {})


def decode(emissions: DataFrame, transitions: DataFrame, piece: int, key: str = "trace", step: str = "t") -> DataFrame:
    """(key, step, state, filter, log, before, chosen) of the states that survive.

    emissions has key, step (a long, its order), state and probability; transitions key,
    step (of the later state), from_state, state and probability. filter is the
    probability given all steps so far, log the decimal logarithm of the likeliest
    sequence that ends in the state since the chain last started anew, before its state
    before (null where it starts anew), chosen whether the likeliest sequence takes it.
    Steps are taken in the order of their numbers, gaps are no matter; so many numbers
    are a piece. Transitions must be of a step and the one before it that has states.
    Ties go to the smaller state.
    """
    at = [key, step]
    found = emissions.groupBy(*at).agg(F.collect_list(F.struct(F.col("state").cast("string").alias("state"), "probability")).alias("found"))
    ways = transitions.groupBy(*at).agg(F.collect_list(F.struct(F.col("from_state").cast("string").alias("from_state"), F.col("state").cast("string").alias("state"), "probability")).alias("ways"))
    both = found.alias("f").join(ways.alias("w"), F.col(f"f.{key}").eqNullSafe(F.col(f"w.{key}")) & (F.col(f"f.{step}") == F.col(f"w.{step}")), "left")
    return decode_steps(both.select(f"f.{key}", f"f.{step}", "found", "ways"), piece, key, step)


def decode_steps(steps: DataFrame, piece: int, key: str = "trace", step: str = "t") -> DataFrame:
    """decode() of a row for each key and step: found, its states as structs (state, probability), and ways, its transitions as structs (from_state, state, probability)."""
    zero = F.lit(0.0)
    some = lambda c: F.filter(c, lambda x: x["probability"] > 0)
    own = F.sort_array(F.transform(some("found"), lambda c: F.struct(c["state"].alias("edge"), zero.alias("fraction"), c["probability"].alias("metres"), zero.alias("x"), zero.alias("y"))))
    ways = F.sort_array(F.transform(some("ways"), lambda w: F.struct(w["from_state"].alias("a"), w["state"].alias("b"), w["probability"].alias("p"))))
    samples = steps.select(pieces._trace(key).alias("trace"), pieces._piece(step, piece).alias("piece"), F.col(step).alias("id"), F.col(step).alias("t"), zero.alias("lon"), zero.alias("lat"), F.lit(False).alias("has"), own.alias("found"), F.coalesce(ways, F.array().cast("array<struct<a:string,b:string,p:double>>")).alias("ways"))
    samples = materialize(samples.where(F.size("found") > 0), "samples")
    kind = steps.schema[key].dataType.simpleString()
    steps = pieces._linked(samples, _Rows)
    parts = pieces._pieces(steps)
    ends = pieces._scanned(steps, parts)
    filtered = pieces._entered(steps, parts, sums=True).select("trace", "piece", F.col("v").alias("filter_v"))

    def told(group, piece):
        rows, head, out = pieces._records(group), piece[0], []
        f, names = head["filter_v"], head["edges_before"]
        scanned = list(pieces._viterbi(rows, head["v"]))
        chain, _ = pieces._chain(rows, scanned, head["v"], head["end"].index(0.0))
        for r, (seq, by), (c, _, _) in zip(rows, scanned, chain):
            if r["broke"]:
                now = [10.0**x for x in r["logs"]]
            else:
                now = [0.0] * len(r["logs"])
                for a, b, prob in zip(r["from"], r["to"], r["probs"]):
                    now[b] += f[a] * 10.0**prob
                now = [x * 10.0**e for x, e in zip(now, r["logs"])]
            total = sum(now)
            f = [x / total for x in now]
            for k, state in enumerate(r["edges"]):
                out.append((r["trace"], r["t"], state, f[k], seq[k], None if by[k] is None else names[r["from"][by[k]]], k == c))
            names = r["edges"]
        return out

    whole = ends.select("trace", "piece", "v", "end", "edges_before").join(filtered, ["trace", "piece"])
    rows = pieces.grouped(steps.select(*pieces._SCANNED, "edges"), told, _OUT, whole)
    named = F.from_json("trace", f"k {kind}")["k"]
    return rows.select(named.alias(key), F.col("t").alias(step), "state", "filter", "log", "before", "chosen")
