import pytest

from ledgerfold.llm.components import connected_components
from ledgerfold.llm.names import cluster_spellings, edits, jaro_winkler, link_spellings, name_distance

REGISTRY = [
    (1, "Anastasia H. Łubibertazu", "person"), (2, "Viktor A. Zanström", "person"), (3, "Jean-Luc Peñalgekamp", "person"), (4, "Anna-Lena Quilanderzétt", "person"), (5, "Francesca Weximarzétt", "person"), (6, "Thomas Zanström", "person"),
    (7, "Brightmoor Consortium", "organisation"), (8, "Wintermark Laboratory for Soft Machines", "organisation"), (9, "Wintermark University Robotics Group", "organisation"),
]
SPELT = {
    "A. Łubibertazu": 1, "Lubibertazu, Nastya": 1, "łubibertazu a. h.": 1, "Anastasia Lubibertaz": 1, "A. B. Łubibertazu": None, "V. Zanstroem": 2, "Vitkor Zanström": 2, "Zanström V A": 2, "Dr. Viktor A. Zanström, Jr.": 2, "Tom Zanström": 6, "J.-L. Peñalgekamp": 3, "JeanLuc Penalgekamp": 3,
    "Jean Luc Peñalgekamp": 3, "A.-L. Quilanderzétt": 4, "QUILANDERZÉTT Anna-Lena": 4, "Chiara Weximarzétt": 5, "Mira Zanström": None, "Brightmoor Consort.": 7, "the brightmoor consortum": 7, "Wintermark Lab. for Soft Machines": 8, "WINTERMARK U. ROBOTICS GROUP": 9, "Someone Else": None, "X": None,
}


def test_distances():
    assert edits("abcd", "abdc") == 1 and edits("abc", "abc") == 0 and edits("kitten", "sitting", 3) == 3
    assert jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert name_distance("A. Łubibertazu", "Anastasia H. Łubibertazu", "person") == 0


def test_links(spark):
    names = spark.createDataFrame([(n,) for n in SPELT] * 2 + [(None,), ("",), ("  ",)], "name string")
    registry = spark.createDataFrame([*REGISTRY, (10, None, "person"), (None, "No Id", "person")], "person_id bigint, registered_name string, entity_kind string")
    got = {r["name"]: r["person_id"] for r in link_spellings(names, registry).collect()}
    assert got == {n: p for n, p in SPELT.items() if p}


def test_nothing_to_link(spark):
    registry = spark.createDataFrame(REGISTRY, "person_id bigint, registered_name string, entity_kind string")
    assert link_spellings(spark.createDataFrame([], "name string"), registry).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (8, 9), (9, 10), (10, 8), (-1, 8), (None, 3)] + [(100, i) for i in range(101, 140)] + [(i, i + 1) for i in range(200, 230)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert {got[1], got[2], got[3]} == {1} and got[4] == got[5] == 4 and got[7] == 7 and {got[x] for x in (-1, 8, 9, 10)} == {-1}
    assert {got[i] for i in range(100, 140)} == {100} and {got[i] for i in range(200, 231)} == {200}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_clusters_hold_all_accepted_pairs(spark):
    """Two registered names that share a spelling are one cluster; the tie links to none, the nearer ones to their own."""
    registry = spark.createDataFrame([(3, "Anna Quilander", "person"), (1, "Annas Quilander", "person"), (9, "Otto Zanström", "person")], "person_id bigint, registered_name string, entity_kind string")
    names = spark.createDataFrame([("A. Quilander",), ("Anna Quilandr",), ("Otto Zanstrom",)], "name string")
    got = {(r["cluster"], r["name"], r["person_id"]) for r in cluster_spellings(names, registry).collect()}
    assert {(3, "A. Quilander", 1), (3, "A. Quilander", 3), (3, "Anna Quilandr", 3), (9, "Otto Zanstrom", 9)} <= got and {c for c, _, _ in got} == {3, 9}
    assert {tuple(r) for r in link_spellings(names, registry).collect()} == {("Anna Quilandr", 3), ("Otto Zanstrom", 9)}
