"""L7 zone test against a brute-force search for a linearization."""

import random

import pytest

from ripplekit.operators.history import check_history

OPS = "tid long, op string, k string, v string, start long, finish long, status string"


def linearizable(ops):
    """Brute force for one register starting at '': some total order that
    respects real time in which every read returns the latest write."""
    ops = list(ops)
    n = len(ops)

    def search(done, value, last_end):
        if len(done) == n:
            return True
        # candidates: operations not yet placed whose start precedes every
        # unplaced operation's finish (minimal in the real-time order)
        pending = [i for i in range(n) if i not in done]
        min_finish = min(ops[i][3] for i in pending)
        for i in pending:
            op, v, s, f = ops[i]
            if s > min_finish:
                continue
            if op == "r" and v != value:
                continue
            if search(done | {i}, v if op == "w" else value, f):
                return True
        return False

    return search(frozenset(), "", None)


def random_history(rnd, n_ops, pending_writes=False):
    t = 0
    ops, writes = [], []
    times = rnd.sample(range(1, 10 * n_ops), 2 * n_ops)
    times.sort()
    intervals = []
    for i in range(n_ops):
        a, b = sorted(rnd.sample(times, 2))
        times.remove(a)
        times.remove(b)
        intervals.append((a, b))
    for i, (s, f) in enumerate(intervals):
        if rnd.random() < 0.5:
            v = f"w{i}"
            writes.append(v)
            pend = pending_writes and rnd.random() < 0.3
            ops.append(("w", v, s, None if pend else f))
        else:
            ops.append(("r", None, s, f))
    out = []
    for op, v, s, f in ops:
        if op == "r":
            v = rnd.choice(writes + [""]) if writes else ""
        out.append((op, v, s, f))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_zone_check_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    histories = [random_history(rnd, rnd.randint(2, 6), pending_writes=seed % 2 == 1)
                 for _ in range(60)]
    data = []
    for h, ops in enumerate(histories):
        for op, v, s, f in ops:
            data.append((0, op, f"key{h}", v, s, f, "ok" if f is not None else "pending"))
    flagged = {r.k for r in check_history(spark.createDataFrame(data, OPS), partitions=9).collect()}
    for h, ops in enumerate(histories):
        # a pending write may take effect at any time after it starts
        options = []
        for op, v, s, f in ops:
            options.append([(op, v, s, f)] if f is not None else [(op, v, s, 10 ** 9)])
        want = linearizable([o[0] for o in options])
        assert (f"key{h}" not in flagged) == want, (h, ops)


def test_junk_and_reasons(spark):
    data = [
        (0, "w", "a", "x", 1, 2, "ok"), (0, "r", "a", "x", 3, 4, "ok"),
        (1, "r", "a", "nope", 5, 6, "ok"),              # junk
        (0, "w", "b", "y", 10, 11, "ok"), (1, "r", "b", "", 12, 13, "ok"),   # stale ''
    ]
    got = sorted((r.k, r.v, r.score, r.reason)
                 for r in check_history(spark.createDataFrame(data, OPS)).collect())
    # the unread write y lies inside the forward zone of the stale read of the
    # initial value
    assert got == [("a", "nope", 2, "junk"), ("b", "y", 1, "containment")]


def test_a_value_written_twice(spark):
    data = [(0, "w", "k", "v", 1, 2, "ok"), (0, "w", "k", "u", 5, 6, "ok"), (0, "w", "k", "v", 10, 11, "ok"),
            (0, "w", "j", "", 1, 2, "ok"), (0, "w", "p", "x", 1, None, "pending"),
            (1, "w", "p", "x", 3, None, "pending")]
    got = sorted((r.k, r.v, r.score, r.reason) for r in check_history(spark.createDataFrame(data, OPS)).collect())
    assert got == [("j", "", 2, "duplicate_write"), ("k", "v", 2, "duplicate_write"), ("p", "x", 2, "duplicate_write")]


def test_keys_with_duplicates_do_not_hide_others(spark):
    data = [(0, "w", "k", "v", 1, 2, "ok"), (0, "w", "k", "v", 3, 4, "ok"),
            (0, "w", "b", "y", 10, 11, "ok"), (1, "r", "b", "", 12, 13, "ok")]
    got = sorted((r.k, r.v, r.reason) for r in check_history(spark.createDataFrame(data, OPS)).collect())
    assert got == [("b", "y", "containment"), ("k", "v", "duplicate_write")]


def test_the_other_value(spark):
    """What a zone overlaps or lies in: the zone that ends last among those
    that started before."""
    data = [
        (0, "w", "k", "a", 1, 2, "ok"), (1, "r", "k", "a", 50, 51, "ok"),      # forward zone 2..50
        (0, "w", "k", "b", 3, 4, "ok"), (1, "r", "k", "b", 20, 21, "ok"),      # 4..20 overlaps a
        (0, "w", "k", "c", 30, 35, "ok"),                                      # 30..35 lies in a
        (0, "w", "k", "d", 60, 61, "ok"), (1, "r", "k", "d", 70, 71, "ok"),    # 61..70 alone
        (0, "r", "k", "e", 80, 81, "ok"), (1, "w", "k", "e", 90, 91, "ok"),    # read before its write
        (1, "r", "k", "junk", 95, 96, "ok"),
    ]
    got = sorted((r.v, r.reason, r.other) for r in check_history(spark.createDataFrame(data, OPS), 5).collect())
    assert got == [("b", "overlap", "a"), ("c", "containment", "a"), ("e", "read_before_write", None),
                   ("junk", "junk", None)]


@pytest.mark.parametrize("seed", range(2))
def test_the_other_value_is_an_offence(spark, seed):
    """Against all pairs of zones of random histories."""
    rnd = random.Random(100 + seed)
    data = []
    for h in range(30):
        for op, v, s, f in random_history(rnd, 8):
            data.append((0, op, f"key{h}", v, s, f, "ok"))
    zones = {}
    for _, op, k, v, s, f, _ in data:
        z = zones.setdefault((k, v), {"f": f, "s": s, "w": v == ""})
        z["f"], z["s"] = min(z["f"], f), max(z["s"], s)
        z["w"] = z["w"] or op == "w"
    span = {}
    for (k, v), z in zones.items():
        f = -1 if v == "" else z["f"]
        span[k, v] = (f < z["s"], min(f, z["s"]), max(f, z["s"]))
    seen = 0
    for r in check_history(spark.createDataFrame(data, OPS), 7).collect():
        if r.reason in ("overlap", "containment"):
            seen += 1
            fwd, lo, hi = span[r.k, r.v]
            inside = [(o_hi, v) for (k, v), (o_fwd, o_lo, o_hi) in span.items()
                      if k == r.k and o_fwd and o_lo < lo and o_hi > (lo if fwd else hi)]
            assert r.other == max(inside)[1]
        else:
            assert r.other is None
    assert seen > 10
