"""M0-M4 on the golden sample, the edge files and against brute force."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import CapturedException

from conftest import lines_df, rows
from ripplekit.operators import ratings
from ripplekit.sources.sinks import render_lines
from ripplekit.sources.text import parse_matrix

# The reference's sample matrix and its four expected outputs.
SAMPLE = [
    "Apocalypto,3,5,4,,5,4",
    "Apollo 13,,,4,5,,5",
    "The Lord of The Rings,5,4,4,,3,2",
]
SAMPLE_TOP = ["The Lord of The Rings,1", "Apocalypto,2,5", "Apollo 13,4,6"]
SAMPLE_TOTAL = 13
SAMPLE_PER_USER = [(1, 2), (2, 2), (3, 3), (4, 1), (5, 2), (6, 3)]
SAMPLE_SIM = [("Apocalypto", "Apollo 13", 1), ("Apocalypto", "The Lord of The Rings", 1),
              ("Apollo 13", "The Lord of The Rings", 1)]


def parsed(spark, lines):
    return parse_matrix(lines_df(spark, lines))


def test_golden_top_users(spark):
    top = ratings.top_users(parsed(spark, SAMPLE))
    got = sorted(r.value for r in ratings.render_top_users(top).collect())
    assert got == sorted(SAMPLE_TOP)


def test_golden_total(spark):
    assert [r.n for r in ratings.total_ratings(parsed(spark, SAMPLE)).collect()] == [SAMPLE_TOTAL]


def test_golden_per_user(spark):
    assert rows(ratings.ratings_per_user(parsed(spark, SAMPLE)), "usr", "n") == SAMPLE_PER_USER


def test_golden_similarity(spark):
    assert rows(ratings.similarity(parsed(spark, SAMPLE)), "m1", "m2", "n") == SAMPLE_SIM


def test_text_sink_renders_key_value(spark):
    out = render_lines(ratings.ratings_per_user(parsed(spark, SAMPLE)), ["usr", "n"])
    assert sorted(r.value for r in out.collect()) == [f"{u},{n}" for u, n in SAMPLE_PER_USER]


@pytest.mark.parametrize("line, arr, legacy, total, per_user", [
    ("M,1,,1", [1, 3], "M,,1,3", 2, [(1, 1), (2, 0), (3, 1)]),
    ("M,0,0", [], "M,", 2, [(1, 1), (2, 1)]),
    ("M,,", [], "M,", 0, [(1, 0), (2, 0)]),
    ("M", [], "M,", 0, []),
    ("", [], ",", 0, []),
])
def test_edge_rows(spark, line, arr, legacy, total, per_user):
    p = parsed(spark, [line])
    top = ratings.top_users(p)
    assert [r.top_users for r in top.collect()] == [arr]
    assert [r.value for r in ratings.render_top_users(top, legacy_comma=True).collect()] == [legacy]
    assert [r.n for r in ratings.total_ratings(p).collect()] == [total]
    assert rows(ratings.ratings_per_user(p), "usr", "n") == per_user


def test_empty_input_gives_no_total_row(spark):
    p = parse_matrix(spark.createDataFrame([], "value string"))
    assert ratings.total_ratings(p).collect() == []
    assert ratings.ratings_per_user(p).collect() == []


def test_non_integer_cell_fails(spark):
    with pytest.raises(CapturedException):
        ratings.top_users(parsed(spark, ["M,x"])).collect()
    with pytest.raises(CapturedException):
        ratings.top_users(parsed(spark, ["M, 5"])).collect()   # parseInt rejects blanks


def test_lenient_parse_nulls_bad_cells(spark):
    p = parse_matrix(lines_df(spark, ["M,x,3"]), strict=False)
    assert [r.ratings for r in p.collect()] == [[None, 3]]


def test_non_integer_cell_counts_in_total(spark):
    # M2 only tests for blanks, like the original.
    assert [r.n for r in ratings.total_ratings(parsed(spark, ["M,x"])).collect()] == [1]


def test_duplicate_titles_raise(spark):
    with pytest.raises(ratings.DuplicateTitles):
        ratings.similarity(parsed(spark, ["A,1", "A,2", "B,1"])).collect()


def test_zero_never_matches_and_ragged_pads(spark):
    got = rows(ratings.similarity(parsed(spark, ["A,0,3,2", "B,0,3", "C,1"])), "m1", "m2", "n")
    assert got == [("A", "B", 1)]
    with pytest.raises(ValueError):
        ratings.similarity(parsed(spark, ["A,0,3,2", "B,0,3"]), on_ragged="error")
    with pytest.raises(ValueError):
        ratings.similarity(parsed(spark, ["A,0,3,2"]), 0)


def _brute_similarity(matrix, least):
    out = []
    titles = sorted(matrix)
    for i, a in enumerate(titles):
        for b in titles[i + 1:]:
            n = sum(1 for x, y in zip(matrix[a], matrix[b]) if x == y and x != 0)
            if n >= least:
                out.append((a, b, n))
    return out


@pytest.mark.parametrize("least, width", [(1, 6), (2, 6), (4, 6), (6, 6), (7, 6), (3, 70)])
def test_similarity_matches_brute_force(spark, least, width):
    rnd = random.Random(least)
    matrix = {f"t{i:03d}": [rnd.choice([0, 0, 1, 2]) for _ in range(rnd.randint(width - 2, width))]
              for i in range(30)}
    lines = [t + "," + ",".join("" if x == 0 else str(x) for x in v) for t, v in matrix.items()]
    got = rows(ratings.similarity(parsed(spark, lines), least), "m1", "m2", "n")
    assert got == _brute_similarity(matrix, least)


def test_similarity_of_copies_and_frequent_keys(spark, monkeypatch):
    """Classes of equal ratings and keys that most titles share, in lists of
    a few: every pair once, and the work of one key in many tasks."""
    monkeypatch.setattr(ratings, "BLOCK", 4)
    rnd = random.Random(5)
    kinds = [[1] * 4 + [rnd.choice([0, 1, 2]) for _ in range(8)] for _ in range(12)] + [[0] * 12, [3] * 12]
    matrix = {f"t{i:03d}": rnd.choice(kinds) for i in range(90)}
    lines = [t + "," + ",".join(str(x or "") for x in v) for t, v in matrix.items()]
    similar = ratings.similarity(parsed(spark, lines), 7)
    assert rows(similar, "m1", "m2", "n") == _brute_similarity(matrix, 7)
    assert similar.groupBy(F.spark_partition_id()).count().count() == 4


@pytest.mark.parametrize("width, block, cells", [(6, 1000, 1 << 22), (12, 4, 1 << 22), (70, 1000, 350), (0, 4, 1)])
def test_all_pairs_match_brute_force(spark, monkeypatch, width, block, cells):
    """Without a minimum every pair once, those without a match too; lists of
    a few titles, or of few cells, change nothing."""
    monkeypatch.setattr(ratings, "BLOCK", block)
    monkeypatch.setattr(ratings, "CELLS", cells)
    monkeypatch.setattr(ratings, "TILES", 2)
    rnd = random.Random(width)
    matrix = {f"t{i:03d}": [rnd.choice([0, 0, 1, 2]) for _ in range(rnd.randint(max(0, width - 2), width))]
              for i in range(39)} | {"blank": [0] * width}
    lines = [",".join([t, *(str(x or "") for x in v)]) for t, v in matrix.items()]
    expected = _brute_similarity(matrix, 0)
    assert len(expected) == 40 * 39 // 2 and any(n == 0 for *_, n in expected)
    assert rows(ratings.similarity(parsed(spark, lines), None), "m1", "m2", "n") == expected


def test_all_pairs_of_few_titles(spark):
    for lines, expected in [(SAMPLE, SAMPLE_SIM), (["A,1"], []), ([], []), (["A,1", "B,2"], [("A", "B", 0)])]:
        assert rows(ratings.similarity(parsed(spark, lines), None), "m1", "m2", "n") == expected


def test_the_similarity_job_leaves_no_pair_out(spark, tmp_path):
    """The job has no minimum: every pair of suppliers is a row, of the SQL
    check too."""
    import duckdb

    import __spark_entry__ as entry

    lines = {1: {1: 1, 2: 2}, 2: {1: 1, 2: 3}, 3: {}, 4: {1: 1, 2: 2}, 5: {1: 6}}   # lines by month; 6 counts as 0
    spark.createDataFrame([(k, f"S{k}") for k in lines], "s_suppkey long, s_name string") \
        .write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, m) for k, v in lines.items() for m, n in v.items() for _ in range(n)],
                          "l_suppkey long, m int") \
        .select("l_suppkey", F.expr("make_timestamp(1995, m, 2, 0, 0, 0)").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    expected = [("S1", "S2", 1), ("S1", "S3", 0), ("S1", "S4", 2), ("S1", "S5", 0), ("S2", "S3", 0),
                ("S2", "S4", 1), ("S2", "S5", 0), ("S3", "S4", 0), ("S3", "S5", 0), ("S4", "S5", 0)]
    assert rows(entry.queries()["similarity"](spark, str(tmp_path)), "m1", "m2", "n") == expected
    con = duckdb.connect()
    for t in ("supplier", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert sorted(con.execute(entry.oracle_sql()["similarity"]).fetchall()) == expected


@pytest.mark.parametrize("width, least", [(12, 7), (6, 6), (6, 1), (70, 3), (9, 5), (7, 4)])
def test_any_equal_positions_hold_a_key(width, least):
    groups, keys = ratings._position_keys(width, least)
    rnd = random.Random(width)
    assert len(keys) == len(set(keys)) <= 68
    for _ in range(300):
        equal = set(rnd.sample(range(width), least))
        assert any(equal.issuperset(key) for key in keys)
    assert (width, least) != (12, 7) or {len(key) for key in keys} == {4}


def test_duplicates_are_counted_in_the_error(spark):
    lines = [f"T{i % 30},1" for i in range(60)]
    with pytest.raises(ratings.DuplicateTitles, match="30 repeated"):
        ratings.similarity(parsed(spark, lines))


def _top_users_text(line):
    """The rule: users who hold the largest rating of at least 1, joined by
    commas; a further comma in front if that rating is exactly 1."""
    title, *cells = line.split(",")
    values = {u: int(c) for u, c in enumerate(cells, start=1) if c}
    best = max([v for v in values.values() if v >= 1], default=None)
    users = [str(u) for u, v in values.items() if v == best]
    return ",".join([title] + [""] * (best == 1) + users) if users else title + ","


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", "0", "1", "2", "5", "-1"]), max_size=7),
                min_size=1, max_size=25))
def test_top_users_legacy_text_matches_the_rule(spark, rows_cells):
    lines = [f"t{i}," + ",".join(cells) if cells else f"t{i}"
             for i, cells in enumerate(rows_cells)]
    top = ratings.top_users(parsed(spark, lines))
    got = sorted(r.value for r in ratings.render_top_users(top, legacy_comma=True).collect())
    assert got == sorted(_top_users_text(x) for x in lines)


def test_text_files_end_to_end(spark):
    """The original flow: a text file in, ``key,value`` text files out."""
    from ripplekit.plans.lineage import scratch_path
    from ripplekit.sources.sinks import write_lines
    from ripplekit.sources.text import read_lines

    src = scratch_path(spark, "matrix-in")
    lines_df(spark, SAMPLE).coalesce(1).write.text(src)
    p = parse_matrix(read_lines(spark, src))
    outs = {}
    for name, df, cols in [
            ("top", ratings.top_users(p), ["title", "top_users"]),
            ("total", ratings.total_ratings(p), ["n"]),
            ("per_user", ratings.ratings_per_user(p), ["usr", "n"]),
            ("sim", ratings.similarity(p), ["m1", "m2", "n"])]:
        path = scratch_path(spark, f"matrix-out-{name}")
        write_lines(df, path, cols)
        outs[name] = sorted(r.value for r in read_lines(spark, path).collect())
    assert outs["top"] == sorted(SAMPLE_TOP)
    assert outs["total"] == [str(SAMPLE_TOTAL)]
    assert outs["per_user"] == sorted(f"{u},{n}" for u, n in SAMPLE_PER_USER)
    assert outs["sim"] == sorted(f"{a},{b},{n}" for a, b, n in SAMPLE_SIM)
