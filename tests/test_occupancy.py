"""Hand-traced cases and a step-by-step model on random histories."""

import random

import pytest

from conftest import rows
from ripplekit.operators import occupancy

LOG = "seq long, src string, key string, val string"


def alerts_of(spark, log, partitions=None):
    df = spark.createDataFrame(log, LOG)
    return rows(occupancy.alerts(df, partitions=partitions), "seq", "room", "value")


def test_hand_trace(spark):
    log = [(0, "class", "R1", "2"), (1, "student", "a", "R1"), (2, "student", "b", "R1"),
           (3, "student", "c", "R1"), (4, "student", "a", "R2"), (5, "class", "R2", "0")]
    assert alerts_of(spark, log) == [(3, "R1", "3"), (4, "R1", "OK"), (5, "R2", "1")]


def test_resend_same_room_gives_two_updates(spark):
    log = [(0, "class", "R", "1"), (1, "student", "a", "R"), (2, "student", "b", "R"),
           (3, "student", "b", "R")]
    # seq 3: retract (1 -> not over, previous 2 > 1 -> OK) then add (2 -> over)
    assert alerts_of(spark, log) == [(2, "R", "2"), (3, "R", "2"), (3, "R", "OK")]


def test_capacity_raised_while_over_gives_no_ok(spark):
    log = [(0, "class", "R", "1"), (1, "student", "a", "R"), (2, "student", "b", "R"),
           (3, "class", "R", "5"), (4, "student", "b", None)]
    assert alerts_of(spark, log) == [(2, "R", "2")]


def test_capacity_deleted_and_set_again(spark):
    log = [(0, "class", "R", "1"), (1, "student", "a", "R"), (2, "student", "b", "R"),
           (3, "class", "R", None), (4, "student", "b", None), (5, "class", "R", "3")]
    # the deletion reaches no one; the fold still remembers "2" and says OK
    assert alerts_of(spark, log) == [(2, "R", "2"), (5, "R", "OK")]


def test_student_deleted_and_count_back_to_zero(spark):
    log = [(0, "student", "a", "R"), (1, "student", "b", "R"), (2, "class", "R", "0"),
           (3, "student", "a", None), (4, "student", "b", None), (5, "class", "R", "0")]
    assert alerts_of(spark, log) == [(2, "R", "2"), (3, "R", "1"), (4, "R", "OK")]
    counts = rows(occupancy.room_counts(spark.createDataFrame(log, LOG)), "seq", "cnt")
    assert counts == [(0, 1), (1, 2), (3, 1), (4, 0)]


def test_latest_state_drops_deleted(spark):
    log = [(0, "student", "a", "R"), (1, "student", "a", None), (2, "student", "b", "R"),
           (3, "class", "R", "4")]
    got = rows(occupancy.latest_state(spark.createDataFrame(log, LOG)))
    assert got == [("class", "R", "4"), ("student", "b", "R")]


def simulate(log):
    """Step-by-step model of the changelog topology."""
    student, count, seen, cap, prev = {}, {}, set(), {}, {}
    out = []

    def joined(seq, sub, room):
        if room not in seen or cap.get(room) is None:
            return
        c, k = count[room], cap[room]
        if c > k:
            out.append((seq, room, str(c)))
            prev[room] = c
        elif prev.get(room) is not None and prev[room] > c:
            out.append((seq, room, "OK"))
            prev[room] = None
        else:
            prev[room] = None

    for seq, src, key, val in log:
        if src == "class":
            cap[key] = None if val is None else int(val)
            joined(seq, 0, key)
        else:
            old = student.get(key)
            if old is not None:
                count[old] -= 1
                joined(seq, 0, old)
            if val is not None:
                count[val] = count.get(val, 0) + 1
                seen.add(val)
                joined(seq, 1, val)
            student[key] = val
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_histories_match_model(spark, seed):
    rnd = random.Random(seed)
    log = []
    for seq in range(400):
        if rnd.random() < 0.2:
            log.append((seq, "class", f"R{rnd.randint(0, 3)}",
                        None if rnd.random() < 0.15 else str(rnd.randint(0, 4))))
        else:
            log.append((seq, "student", f"s{rnd.randint(0, 12)}",
                        None if rnd.random() < 0.1 else f"R{rnd.randint(0, 3)}"))
    # many partitions cut rooms and students
    assert alerts_of(spark, log, partitions=16) == simulate(log)


def test_hot_student_and_hot_room_match_model(spark):
    rnd = random.Random(42)
    log = []
    for seq in range(600):
        if rnd.random() < 0.15:
            log.append((seq, "class", rnd.choice(["HOT", "R1", "R2"]),
                        None if rnd.random() < 0.1 else str(rnd.randint(0, 6))))
        else:
            student = "hot" if rnd.random() < 0.4 else f"s{rnd.randint(0, 20)}"
            room = "HOT" if rnd.random() < 0.5 else f"R{rnd.randint(1, 2)}"
            log.append((seq, "student", student, None if rnd.random() < 0.05 else room))
    assert alerts_of(spark, log, partitions=8) == simulate(log)
