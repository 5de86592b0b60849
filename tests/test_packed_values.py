import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerfold.operators.packed_values import split_packed, split_values

NAMES = [
    ("Bea A and L. B and C D", ["Bea A", "L. B", "C D"]), ("Robert A, and V. B", ["Robert A", "V. B"]), ("A B, C D & E F", ["A B", "C D", "E F"]), ("Last, First; Other, Second J.", ["Last, First", "Other, Second J."]),
    ('"Last, First", "Other, S."', ["Last, First", "Other, S."]), ('"A B" "C D"', ["A B", "C D"]), ("Last, First and Other,S.", ["Last, First", "Other,S."]), ("A B, Jr., C D", ["A B, Jr.", "C D"]), ("A B,\n   III and C D", ["A B, III", "C D"]), ("A B Jr. ; C D", ["A B Jr.", "C D"]),
    ("A B (1), C D (2) ((1) Inst, X, (2) Y; Z)", ["A B", "C D"]), ("A B (School; Campus), C D", ["A B", "C D"]), ("A B\n  C D\r\nE F", ["A B", "C D", "E F"]), ("A B|C D | E F", ["A B", "C D", "E F"]), ("A B / C D", ["A B", "C D"]), ("A B, , C D, ", ["A B", "C D"]),
    ("J.Smith, A B", ["J.Smith", "A B"]), ("One", ["One"]), ("", []), (None, None), (" ; , ", []), ("Andrew Anderson, Sandy Land", ["Andrew Anderson", "Sandy Land"]), ("A B, A B", ["A B", "A B"]), ("Łu Žé;Ωμ Ñ", ["Łu Žé", "Ωμ Ñ"]), ('"A B" C D; E F', ["A B", "C D", "E F"]),
    ("A B (open, C D", ["A B (open", "C D"]), ('5" pipe; x y', ['5" pipe', "x y"]),
]
TOKENS = [
    ("a:b; c:d", ["a:b", "c:d"]), ("a:b c:d\te:f\ng:h", ["a:b", "c:d", "e:f", "g:h"]), ('a:b, "l:Field, Robotics"', ["a:b", "l:Field, Robotics"]), ('"l:""Soft"" M"|x:y', ['l:"Soft" M', "x:y"]), ("a:b/ c:d", ["a:b", "c:d"]), ("l:Open Theses, a:b", ["l:Open Theses", "a:b"]), (";a:b,", ["a:b"]), ("", []), (None, None),
]


@pytest.mark.parametrize(("dialect", "cases"), [("names", NAMES), ("tokens", TOKENS)])
def test_cases(dialect, cases):
    got = split_values(pa.array([c[0] for c in cases]), dialect).to_pylist()
    for (text, want), have in zip(cases, got, strict=True):
        assert have == want, text
    # a row's values don't depend on its neighbours
    for text, want in cases:
        assert split_values(pa.array([text], pa.string()), dialect).to_pylist() == [want]


@given(st.lists(st.one_of(st.none(), st.text(alphabet='ab ,;|/&"()\n\té:.', max_size=30)), max_size=12), st.sampled_from(["names", "tokens"]))
@settings(max_examples=300, deadline=None)
def test_rows_are_independent(texts, dialect):
    whole = split_values(pa.array(texts, pa.string()), dialect).to_pylist()
    assert whole == [split_values(pa.array([t], pa.string()), dialect).to_pylist()[0] for t in texts]
    sliced = pa.array(["x, y", *texts], pa.string()).slice(1)
    assert split_values(sliced, dialect).to_pylist() == whole
    assert all(v and v == v.strip() for row in whole if row for v in row)


@given(st.lists(st.text(alphabet="abcß", min_size=1, max_size=5), min_size=2, max_size=6))
@settings(max_examples=100, deadline=None)
def test_round_trip_of_quoted_values(values):
    packed = "; ".join('"' + v.replace('"', '""') + '"' for v in values)
    assert split_values(pa.array([packed]), "tokens").to_pylist() == [values]


def test_operator(spark):
    rows = [(1, "A B; C D", ["a:b c:d", "e:f"], 9), (1, "A B; C D", ["a:b"], 9), (2, None, None, 9), (3, "", [None, ""], 9), (4, "A B", ["a:b"], 9), (5, "x y;" * 50_000, [], 9)]
    df = spark.createDataFrame(rows, "id bigint, authors string, sets array<string>, item int")
    out = split_packed(df, "id", {"a": ("authors", "names"), "s": ("sets", "tokens")}, least=2)
    got = sorted(tuple(r) for r in out.filter("id <> 5").collect())
    assert got == sorted([(1, "a", 1, "A B"), (1, "a", 2, "C D")] * 2 + [(1, "s", 1, "a:b"), (1, "s", 2, "c:d"), (1, "s", 3, "e:f")])
    assert out.filter("id = 5").count() == 50_000
    assert split_packed(df.limit(0), "id", {"a": ("authors", "names")}).count() == 0
