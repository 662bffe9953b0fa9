from conftest import lines_df, rows
from ripplekit.operators.kvlog import pair_operations
from ripplekit.plans.lineage import materialize, scratch_path
from ripplekit.sources.sinks import write_lines
from ripplekit.sources.text import (OPLOG_SCHEMA, good_operations, parse_calibration, parse_key_value, parse_oplog,
                                    read_lines, render_oplog)

# The reference's timing report (calibration output).
CALIBRATION = """Throughput for logRounds=8: 26.424442
Latency for logRounds=8: 37
Throughput for logRounds=9: 14.084507
Latency for logRounds=9: 71
Throughput for logRounds=10: 7.079646
Latency for logRounds=10: 141
Throughput for logRounds=11: 3.5492458
Latency for logRounds=11: 281
Throughput for logRounds=12: 1.776199
Latency for logRounds=12: 563""".splitlines()


def test_key_value_lines(spark):
    got = rows(parse_key_value(lines_df(spark, ["s1,R1", "s2,", "s3", "R1,2,3"])))
    assert got == [("R1", "2,3"), ("s1", "R1"), ("s2", ""), ("s3", None)]


def test_calibration_report(spark):
    cal = parse_calibration(lines_df(spark, CALIBRATION))
    per_cost = {r.cost: r for r in cal.groupBy("cost").pivot("metric", ["throughput", "latency"])
                .sum("value").collect()}
    assert sorted(per_cost) == [8, 9, 10, 11, 12]
    assert per_cost[12].latency == 563.0
    assert abs(per_cost[8].throughput - 26.424442) < 1e-9
    # the work doubles per cost step: latency roughly doubles
    assert all(per_cost[c + 1].latency > 1.9 * per_cost[c].latency for c in range(8, 12))


def test_json_log(spark):
    """Bad lines are told apart and counted, good ones are paired."""
    lines = [
        '{"t":1,"tid":1,"phase":"inv","op":"w","k":"a","v":"x"}',
        '{"t":2,"tid":1,"phase":"res","op":"w","k":"a"}',
        '{"tid":1,"k":"b","op":"r","phase":"inv","t":3,"more":[1]}',            # any order, unknown fields
        '{"t":4,"tid":1,"phase":"res","op":"r","k":"b","v":"\\u00e9\\n"}',
        '{"t":5,"tid":1,"phase":"inv","op":"w","k":"c","v":',                    # cut
        '{"t":"soon","tid":1,"phase":"inv","op":"w","k":"c"}', "no json", "[]", '"text"',
        '{"t":6,"tid":1,"op":"w","k":"c"}', '{"t":7,"tid":1,"phase":"inv","op":"w","k":null}', "{}",
        '{"t":8,"tid":1,"phase":"maybe","op":"w","k":"c"}', '{"t":9,"tid":1,"phase":"inv","op":"x","k":"c"}',
        "", "   ",
    ]
    parsed = parse_oplog(lines_df(spark, lines))
    assert rows(parsed.groupBy("state").count()) == [
        ("bad_value", 2), ("malformed", 5), ("missing_field", 3), ("ok", 4)]
    assert {r.line for r in parsed.collect()} == {x for x in lines if x.strip()}
    good = good_operations(parsed)
    assert good.columns == OPLOG_SCHEMA.fieldNames()
    assert rows(pair_operations(good), "op", "k", "v", "start", "finish", "status") == [
        ("r", "b", "\u00e9\n", 3, 4, "ok"), ("w", "a", "x", 1, 2, "ok")]
    # a round trip through files
    path = scratch_path(spark, "json-log")
    write_lines(render_oplog(materialize(good, "good-log")), path, ["value"])
    again = good_operations(parse_oplog(read_lines(spark, path)))
    assert sorted(map(str, rows(again))) == sorted(map(str, rows(good)))
