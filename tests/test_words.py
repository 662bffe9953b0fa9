from conftest import lines_df, rows
from ripplekit.operators.compare import multiset_diff, same_rows
from ripplekit.operators.words import word_count


def test_java_split_rules(spark):
    assert rows(word_count(lines_df(spark, [""]))) == [("", 1)]
    assert rows(word_count(lines_df(spark, ["   "]))) == []
    assert rows(word_count(lines_df(spark, [" a  b  "]))) == [("", 2), ("a", 1), ("b", 1)]


def test_case_tabs_and_punctuation_kept(spark):
    got = rows(word_count(lines_df(spark, ["The the\tend. the"])))
    assert got == [("The", 1), ("the", 1), ("the\tend.", 1)]


def test_multiset_diff(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "line string")
    b = spark.createDataFrame([("x",), ("z",), ("z",)], "line string")
    assert rows(multiset_diff(a, b)) == [("x", "<", 1), ("y", "<", 1), ("z", ">", 2)]
    assert same_rows(a, a)
    assert not same_rows(a, b)


def _java_split_space(line):
    """Java's String.split(" ") with limit 0."""
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


from collections import Counter  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=" ab\t.", max_size=12), min_size=1, max_size=60))
def test_word_count_matches_java_split(spark, lines):
    want = Counter(w for line in lines for w in _java_split_space(line))
    got = dict(rows(word_count(lines_df(spark, lines))))
    assert got == dict(want)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.sampled_from(["x", "y", "z", ""]), max_size=30),
       st.lists(st.sampled_from(["x", "y", "w"]), max_size=30))
def test_multiset_diff_matches_counters(spark, a, b):
    da = spark.createDataFrame([(x,) for x in a], "line string")
    db = spark.createDataFrame([(x,) for x in b], "line string")
    ca, cb = Counter(a), Counter(b)
    want = sorted([(k, "<", n) for k, n in (ca - cb).items()]
                  + [(k, ">", n) for k, n in (cb - ca).items()])
    assert rows(multiset_diff(da, db)) == want


def test_lines_of_a_column_are_those_of_a_text_scan(spark):
    from ripplekit.plans.lineage import scratch_path
    from ripplekit.sources.text import lines_of_column, read_lines
    for text in ("a b\n", "a\n\n", "\n", "", "x\r\ny", "x\ry\r", " \n b", "end"):
        path = scratch_path(spark, "one")
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\0").text(path)
        # the writer ends the text with the separator: drop that byte
        folder = path.replace("file:", "")
        import glob
        import os
        for f in glob.glob(f"{folder}/part-*"):
            raw = open(f, "rb").read()
            assert raw == text.encode() + b"\0"
            open(f, "wb").write(raw[:-1])
            crc = f"{folder}/.{os.path.basename(f)}.crc"
            if os.path.exists(crc):
                os.remove(crc)
        want = sorted(r.value for r in read_lines(spark, path).collect())
        got = lines_of_column(spark.createDataFrame([(text,), (None,)], "text string"), "text")
        assert sorted(r.value for r in got.collect()) == want, repr(text)
