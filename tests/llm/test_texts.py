import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerfold.llm.lookalike import LOOK_ALIKES, Model, count_bigrams, equal_looking, look, look_classes, plain_form
from ledgerfold.llm.markup import clean, clean_markup, find_markup, languages, max_flow_side

MODEL = Model(count_bigrams(["We present a calibrated model for sparse lecture notes and pose tracking in the wild."] * 20 + ["модель системы распознавания речи и текста"] * 20))
SAME = [
    ("Ｔｈｅ model", "The model"), ("The mоdel", "The model"), ("mo\u200bdel", "model"), ("mo\u00addel", "model"), ("a\u00a0b", "a b"), ("e\u0301t", "\u00e9t"), ("ﬁne eﬀort", "fine effort"), ("Τhе ΜΟDЕL", "The MODEL"), ("low‑rank", "low-rank"), ("А", "A"), ("nаı\u0308ve x", "naı\u0308ve x"), ("a\n  b", "a b"), ("ѕресіаl", "special"), ("rinɡ", "ring"), ("длa", "дла"),
]
OTHER = [("naive", "naïve"), ("low-rank", "low rank"), ("m²", "m2"), ("Model", "model"), ("a b!", "a b"), ("system", "systems")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same_look(a, b):
    assert look(a, MODEL) == look(b, MODEL)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other_look(a, b):
    assert look(a, MODEL) != look(b, MODEL)


def test_other_scripts_stay():
    text = "система распознавания речи"
    assert look(text, MODEL) == text
    assert look(None, MODEL) is None and look("", MODEL) == "" and plain_form("\u200b ") == ""


@given(st.text(alphabet="abcdehimnoprstx AEHIMOPTXéö-", min_size=0, max_size=30), st.randoms())
@settings(max_examples=200, deadline=None)
def test_disguise_is_undone(text, rng):
    hidden = "".join(rng.choice(LOOK_ALIKES[c]) if c in LOOK_ALIKES and rng.random() < 0.4 else c + rng.choice(["", "\u200b", "\u2060"]) for c in text)
    assert look("the model " + hidden, MODEL) == look("the model " + text, MODEL)


def test_pairs(spark):
    rows = [(1, "The model", None), (2, "Thе model", ""), (3, "The model", "x"), (4, "The mo\u200bdel", "x"), (5, "Other", " "), (6, None, "\u200b"), (6, "long " * 50_000, None), (7, "Ｌong " + "long " * 49_999, None)]
    df = spark.createDataFrame(rows, "id bigint, title string, look string")
    got = {tuple(r) for r in equal_looking(df, "id", {"title": "title", "look": "look"}).collect()}
    assert got == {("title", 1, 2), ("title", 1, 4), ("title", 2, 3), ("title", 2, 4), ("title", 3, 4)}
    assert equal_looking(df.limit(0), "id", {"title": "title"}).count() == 0


def test_classes(spark):
    """A class for every row; copies of one string and rows of another look stand apart."""
    rows = [(1, "The model"), (2, "Th\u0435 model"), (3, "The model"), (5, "Other"), (6, None), (7, " "), (8, "Other")]
    df = spark.createDataFrame(rows, "class_id bigint, title string")
    got = {tuple(r) for r in look_classes(df, "class_id", {"title": "title"}).toDF("f", "k", "c", "n", "m").collect()}
    assert got == {("title", 1, 1, 3, 2), ("title", 2, 1, 3, 2), ("title", 3, 1, 3, 2), ("title", 5, 5, 2, 1), ("title", 8, 5, 2, 1)}
    assert look_classes(df.limit(0), "class_id", {"title": "title"}).count() == 0


MARKUP = [
    ("<p>Text</p>", ["html"]), ("a &lt;em&gt; b", ["html"]), ("<!-- x --> y", ["html"]), ("costs $5, saves $10 on it", []), ("5 < 6 and 7 > 3", []), ("R&D in C# and C++", []), ("see [3] and [7]", []), ("A == B", []), ("3 * 4 * 5", []), ("run_final_v2 and run_final_v3", []), ("about ~5 runs", []), ("a star (*) marks", []), ("3/5 # of raters {five}", []), ("users' choice, not 'ours'", []),
    ("a **b** c", ["markdown"]), ("*a b* c", ["markdown"]), ("[a](https://x.example/y)", ["markdown"]), ("# Title\n\nText", ["markdown"]), ("Overview\n========\n\nText", ["markdown"]), ("x\n\n```\ncode\n```", ["markdown"]), ("x\n\n- a\n- b", ["markdown"]), ("x\n\n1. a\n2. b", ["markdown"]), ("__a__ b", ["markdown"]), ("(`f(x)`) y", ["markdown"]),
    ("a ''b'' c", ["wiki"]), ("'''b''' c", ["wiki"]), ("[[a|b]] c", ["wiki"]), ("{{see also|x}}", ["wiki"]), ("== H ==\nText", ["wiki"]), ("[https://x.example/y text] z", ["wiki"]), ("a ''b'' c\n* x\n* y", ["wiki"]), ("[[a]] b\n# x\n# y", ["wiki"]), ("**a** b\n\n* x\n* y", ["markdown"]),
    ("\\emph{a} b", ["latex"]), ("$\\alpha$ x", ["latex"]), ("$10^{-3}$ x", ["latex"]), ("\\(x\\) y", ["latex"]), ("{\\bf a} b", ["latex"]), ("``a b'' c", ["latex"]), ("(Fig.~3) x", ["latex"]), ("up to 3\\% x", ["latex"]), ("caf\\'e x", ["latex"]), ("\\begin{itemize}\n\\item a\n\\end{itemize}", ["latex"]), ("\\verb|a_b * c| d", ["latex"]),
    ("<b>a</b> $x^2$ and [[b]]", ["html", "wiki", "latex"]), ("", []), ("plain", []),
]


@pytest.mark.parametrize(("text", "want"), MARKUP)
def test_languages(text, want):
    assert languages(text) == want


def test_clean():
    assert clean("<h2>Aim</h2>\n<p>We &amp; they use <em>x</em>.</p><ul><li>a</li><li>b</li></ul>") == "## Aim\n\nWe & they use x.\n\n- a\n- b"
    assert clean("== Aim ==\n''a'' [[b|c]]\n* x\n* y") == "# Aim\na c\n- x\n- y"
    assert clean("\\section{Aim} Use \\emph{x} and $x^2$, caf\\'e 5\\%.") == "# Aim\n Use x and $x^2$, café 5%."
    assert clean("**a** [b](https://x.example)\n\n```\nf(*x*)\n```") == "a b\n\n```\nf(*x*)\n```"
    assert clean(None) is None and clean("$5 and $10") == "$5 and $10"


def test_minimum_cut():
    # a chain in which one strong node pulls a weak neighbour, and another stays content
    assert max_flow_side(3, {0: 3.0}, {1: 0.4, 2: 2.0}, [(0, 1, 1.0), (1, 2, 0.1)]) == [True, True, False]


def test_markup_operators(spark):
    rows = [(1, "<p>a</p> $x^2$", None), (2, None, "plain"), (3, "", "''a''"), (3, "", "''a''"), (4, "x" * 300_000 + " **b**", "<b>" * 2_000)]
    df = spark.createDataFrame(rows, "id bigint, title string, markup string")
    got = sorted(tuple(r) for r in find_markup(df, "id", {"t": "title", "m": "markup"}).collect())
    assert got == sorted([(1, "t", "html"), (1, "t", "latex"), (3, "m", "wiki"), (3, "m", "wiki"), (4, "t", "markdown"), (4, "m", "html")])
    assert {(r["id"], r["field_name"]): r["text"] for r in clean_markup(df.filter("id < 4"), "id", {"t": "title", "m": "markup"}).collect()} == {(1, "t"): "a\n $x^2$", (2, "m"): "plain", (3, "t"): "", (3, "m"): "a"}
    assert find_markup(df.limit(0), "id", {"t": "title"}).count() == 0


def test_indented_lists_and_wrapped_bodies():
    """The hint lets through what the scanner reads; formulas, templates and links may be long or wrapped."""
    from ledgerfold.llm.markup import languages

    assert languages("We show:\n  - first point\n  - second point\n  - third point") == ["markdown"]
    assert languages("Steps:\n\n  1. first point\n  2. second point") == ["markdown"]
    assert languages("A title\n  ======\nand text") == ["markdown"]
    assert languages("We bound $a_1 +\nb^2 = c$ here.") == ["latex"]
    assert languages("We bound $" + "a_1 + " * 80 + "b$ here.") == ["latex"]
    assert languages("Text {{cite journal\n|title=" + "long " * 90 + "\n|year=2001}} here.") == ["wiki"]
    assert languages("See [[" + "long " * 90 + "page]] here.") == ["wiki"]
    assert languages("It costs $5\nor 6$ and\n\nmore = $7.") == []
    assert languages("It costs $5 here\nand $x_1$ holds.") == ["latex"]


def test_no_length_limits():
    """Long link texts, headings and quotations, templates within templates and over blank lines, deep nesting."""
    assert languages("See [" + "long " * 200 + "text](https://x.example/y).") == ["markdown"]
    assert languages("A " + "long " * 100 + "heading\n=====\n\ntext") == ["markdown"]
    assert languages("He said ``" + "many words " * 60 + "here'' twice") == ["latex"]
    assert clean("Text {{cite|a={{lang|x}}\n\n|b=2}} here {{{ and }} there") == "Text  here {{{ and }} there".replace("  ", " ")
    assert clean("**a [b _c `d` <i>e</i> &amp;_ f](https://x.example)**") == "a b c `d` e & f"


@pytest.mark.parametrize("line", ["* a point\n", "- a point\n", "# a point\n", "<p>a &amp; b</p>\n", "[[a|b]] and ''c''\n", "{{a\n", "$x^2$ **b**\n"])
def test_long_documents_take_time_in_proportion(line):
    import time

    began = time.time()
    languages(line * 50_000)
    clean(line * 20_000)
    assert time.time() - began < 60
