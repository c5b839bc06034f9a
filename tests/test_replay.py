"""The gate's replay on hand-made slates."""

import math

from newsloom.operators import replay as R

ARTICLES = "link int, quality double, source string, day string, on_topic boolean, verdict string"
SLATES = "week string, label string, bucket_size int, links array<int>, threshold double"


def score(*q):
    """Of articles of different sources and days."""
    return sum(q) * math.log(len(q) + 1) ** 2


def test_slates_live_die_or_are_not_judged(spark):
    rows = [(i, float(q), f"s{i}", f"d{i}", on, v) for i, (q, on, v) in enumerate([(3, True, "on"), (2, True, "off"), (1, False, "on"), (4, None, None), (5, True, "unclear"), (1, True, "on")])]
    t = score(3, 2)
    slates = [
        ("w", "lives", 3, [0, 1, 2], t * 0.9), ("w", "dies", 3, [0, 1, 2], t * 1.2), ("w", "close", 3, [0, 1, 2], t * 1.04), ("w", "larger", 4, [0, 1, 2], 1e9), ("w", "lost", 3, [0, 1, 99], 1e9),
        ("w", "empty", 0, [], 1.0), ("w", "none left", 1, [3], 0.0), ("w", "cap", 4, [0, 1, 4, 5], 0.1), ("w", "no threshold", 1, [0], None),
    ]
    out = R.gated(spark.createDataFrame(slates, SLATES), spark.createDataFrame(rows, ARTICLES), cap=2)
    got = {r.label: r for r in out.collect()}
    verdict = {k: (r.exact, r.survives, r.borderline, r.kept, r.dropped, r.after_n) for k, r in got.items()}
    assert verdict == {
        "lives": (True, True, False, 2, 1, 2), "dies": (True, False, False, 2, 1, 0), "close": (True, False, True, 2, 1, 0), "larger": (False, None, False, 2, 1, 2), "lost": (False, None, False, 2, 0, 2),
        "empty": (True, False, False, 0, 0, 0), "none left": (True, False, False, 0, 1, 0), "cap": (True, True, False, 4, 0, 2), "no threshold": (True, False, False, 1, 0, 0),
    }
    assert abs(got["lives"].after_score - t) < 1e-9 and got["larger"].after_score is None and got["empty"].before_score == 0
    assert (got["cap"].before_on, got["cap"].before_off, got["cap"].unclear, got["cap"].after_on, got["cap"].after_off) == (2, 1, 1, 1, 0)  # the two best are 4 (unclear) and 0

    recorded = spark.createDataFrame([("w", k, r.before_score + (1 if k == "dies" else 0)) for k, r in got.items()], "week string, label string, recorded_score double")
    one = R.ladder(out.where("label in ('lives', 'dies', 'larger')"), recorded).first()
    assert (one.rung, one.worst, one.before_on, one.after_on, one.lost_dead, one.lost_missed, one.loss_rung, one.slates, one.exact, one.faithful) == ("gate", 0.5, 4, 1, 2, 1, "below", 3, 2, 1)
    none = R.ladder(out.where("false"), recorded).first()
    assert (none.rung, none.loss_rung, none.slates) == ("none", "none", 0)
