"""K4/K5 fold against a dict replay, outcomes, validation (P6/P7), lookups."""

import random

from marketpulse.operators import subscriptions as K
from marketpulse.schemas import SUBSCRIPTION_COMMAND
from tests.helpers import at, rows_of


def replay(cmds):
    state, outcomes = {}, []
    for email, coin, op, thr, dirn, ts, seq in sorted(cmds, key=lambda c: (c[5], c[6])):
        key = (email, coin)
        if op == "upsert":
            if key in state:
                state[key] = (thr, dirn, state[key][2])
                outcomes.append((seq, "updated"))
            else:
                state[key] = (thr, dirn, ts)
                outcomes.append((seq, "created"))
        else:
            outcomes.append((seq, "deleted" if key in state else "noop"))
            state.pop(key, None)
    return sorted((k[0], k[1], v[0], v[1], v[2]) for k, v in state.items()), sorted(outcomes)


def test_lifecycle(spark):
    cmds = [("u@e", "a", "upsert", 2.0, "drop", at(0), 1), ("u@e", "a", "upsert", 3.0, "rise", at(10), 2),
            ("u@e", "a", "delete", None, None, at(20), 3), ("u@e", "a", "delete", None, None, at(30), 4),
            ("u@e", "a", "upsert", 5.0, "drop", at(40), 5), ("v@e", "a", "upsert", 1.0, "rise", at(5), 6),
            ("v@e", "a", "upsert", 1.5, "drop", at(6), 7)]
    df = spark.createDataFrame(cmds, SUBSCRIPTION_COMMAND)
    assert rows_of(K.apply_commands(df), "email", "coin", "threshold", "direction", "created_at") == [
        ("u@e", "a", 5.0, "drop", at(40)), ("v@e", "a", 1.5, "drop", at(5))]
    assert rows_of(K.with_outcome(df), "seq", "outcome") == [
        (1, "created"), (2, "updated"), (3, "deleted"), (4, "noop"), (5, "created"), (6, "created"), (7, "updated")]


def test_fold_matches_replay(spark):
    rnd = random.Random(11)
    cmds = []
    for seq in range(600):
        op = "delete" if rnd.random() < 0.2 else "upsert"
        cmds.append((f"u{rnd.randint(0, 6)}@e", rnd.choice("abc"), op, float(rnd.randint(1, 50)),
                     rnd.choice(["drop", "rise"]), at(rnd.randint(0, 400)), seq))
    df = spark.createDataFrame(cmds, SUBSCRIPTION_COMMAND)
    state, outcomes = replay(cmds)
    assert rows_of(K.apply_commands(df), "email", "coin", "threshold", "direction", "created_at") == sorted(state, key=repr)
    assert sorted(rows_of(K.with_outcome(df), "seq", "outcome")) == outcomes
    # small buckets: the previous command often sits in an earlier bucket
    assert sorted(rows_of(K.with_outcome(df, chunk_seconds=5, day_seconds=60), "seq", "outcome")) == outcomes


def test_validation_edges(spark):
    form = spark.createDataFrame(
        [("", "Bitcoin", "Drops by", 2.0), ("nobody", "Bitcoin", "Drops by", 2.0), ("a@b", "Bitcoin", "Rises by", 0.1),
         ("a@b", "Shiba Inu", "Drops by", 50.0), ("a@b", "Bitcoin", "Rises by", 0.09), ("a@b", "Bitcoin", "x", 50.1),
         ("a@b", "Bitcoin", "Drops by", None)],
        "email string, coin string, alert_when string, threshold double")
    valid, rejected = K.split_valid(K.normalise_command(form))
    assert rows_of(valid, "coin", "direction", "threshold") == [("bitcoin", "drop", 2.0), ("bitcoin", "rise", 0.1),
                                                                ("shiba inu", "drop", 50.0)]
    assert sorted(r["reason"] for r in rejected.collect()) == [
        "invalid email", "invalid email", "threshold out of range", "threshold out of range"]


def test_lookup_by_email(spark):
    subs = spark.createDataFrame([("a@b", "x", 2.5, "drop", at(0)), ("c@d", "y", 1.0, "rise", at(0))],
                                 "email string, coin string, threshold double, direction string, created_at timestamp_ntz")
    assert rows_of(K.subs_for_email(subs, "a@b"), "coin", "label") == [("x", "Drops by 2.5%")]
    assert K.subs_for_email(subs, "not-an-email").count() == 0
    assert rows_of(K.subs_for(subs, "y", "rise"), "email") == [("c@d",)]
