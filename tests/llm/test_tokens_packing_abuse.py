import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerfold.llm.abuse import _TOKEN, LEXICON, Lexicon, Scorer, Trie, _shortened, abuse_rates, known_words, score_documents
from ledgerfold.llm.names import edits
from ledgerfold.llm.packing import best_fit, container_usage, pack_documents
from ledgerfold.llm.tokens import VOCABULARIES, decode_ids, encode_corpus

TEXTS = [
    None, "", " ", "Hello world", "don't we'll I'VE they'd", "<|endoftext|> x", "x" * 3000, "ab" * 700, "实验在一个空仓库中进行，共记录了43次运行。", "😀👩\u200d🔬🤖", "a\n\n  b\t c  ", "\x01\x7f", "مرحبا بالعالم", "Zürich café naïve Łódź", "1234567 89.10", "e\u0301\u0308", "\u00a0nbsp\u2003em", " leading", "trailing ", "Bemeduzáve Kezogubifu " * 40,
]


def test_ids_equal_the_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    tok.encode_special_tokens = True
    df = spark.createDataFrame([(i, t, "w") for i, t in enumerate(TEXTS)] + [(None, "no id at all", "w"), (3, "Same id, other text", "w")], "doc_id bigint, text string, ids string")
    rows = encode_corpus(df).collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids"]) for r in rows)
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, tok.encode(r["text"] or "", add_special_tokens=False).ids) for r in df.collect())
    assert got == want
    back = encode_corpus(df.filter("doc_id <> 3")).withColumn("b", F.decode(decode_ids(spark, F.col("ids")), "UTF-8")).join(df.select("doc_id", "text"), "doc_id")
    assert back.filter("b <> coalesce(text, '')").count() == 0
    assert encode_corpus(df.limit(0)).count() == 0


def test_long_words_equal_the_library(spark):
    """A word of 20,000 letters, words on both sides of LONG_WORD, and one letter over and over."""
    import random

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    rng = random.Random(3)
    word = lambda n, letters="abcdefghijklmnopqrstuvwxyzABCDEFG": "".join(rng.choice(letters) for _ in range(n))
    texts = [word(20_000), word(255), word(256), word(257, "aab"), word(120, "ab"), "a" * 50_000, "実" * 85, "実" * 86, word(3000, "etaoinshr")]
    got = {r[0]: r[1] for r in encode_corpus(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != tok.encode(t, add_special_tokens=False).ids] == []


@given(st.lists(st.integers(0, 50), max_size=60), st.sampled_from(["norm", "dot"]), st.integers(1, 60), st.integers(2500, 4000))
@settings(max_examples=150, deadline=None)
def test_best_fit_keeps_every_capacity(sizes, rule, docs, attention):
    sizes = np.array(sizes, np.int64)
    bins = best_fit(sizes, 50, docs, attention, rule)
    for b in set(bins.tolist()):
        own = sizes[bins == b]
        assert own.sum() <= 50 and len(own) <= docs and (own**2).sum() <= attention
    assert len(bins) == len(sizes)
    if docs >= len(sizes) and attention >= 2500 and len(sizes):
        used = len(set(bins.tolist()))
        assert used <= 2 * (sizes.sum() // 50 + 1) + 1


def test_packing(spark):
    sizes = [(i, n, "x") for i, n in enumerate([0, 1, 5, 9, 10, 11, 20, 25, 30, 3, 3, 3, None])] + [(None, 4, "x"), (5, 11, "x")]
    df = spark.createDataFrame(sizes, "doc_id bigint, n_tokens int, slot string")
    caps = spark.createDataFrame([("ten", 10), ("big", 100), ("none", 0), ("null", None)], "container_kind string, capacity_tokens int")
    out = pack_documents(df, caps, group_items=4).collect()
    for kind, cap in (("ten", 10), ("big", 100)):
        own = [r for r in out if r["container_kind"] == kind]
        fill = {}
        for r in own:
            fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
        assert max(fill.values()) <= cap
        assert sum(r["n_tokens"] for r in own) == sum(n or 0 for _, n, _ in sizes)
        assert sum(1 for r in own if r["part"] == 1) == len(sizes)  # every row, split or not, begins once
    usage = {r["container_kind"]: r["fill"] for r in container_usage(pack_documents(df, caps), caps).collect()}
    assert set(usage) == {"ten", "big"} and usage["ten"] > 0.8
    assert pack_documents(df.limit(0), caps).count() == 0 and pack_documents(df, caps.limit(0)).count() == 0


def test_three_capacities_bind(spark):
    """Token-only packing breaks the other capacities on these sizes; bounded packing keeps them, in every group."""
    sizes = [(i, n) for i, n in enumerate([60, 60, 40, 40, 30, 30, 20, 20, 10, 10, 5, 5, 90, 100, 250] + [1] * 40)]
    df = spark.createDataFrame(sizes, "doc_id bigint, n_tokens int")
    caps = spark.createDataFrame([("c", 100)], "container_kind string, capacity_tokens int")

    def boxes(**limits):
        out = {}
        for r in pack_documents(df, caps, **limits).collect():
            out.setdefault(r["container_id"], []).append(r["n_tokens"])
        return list(out.values())

    keeps = lambda b: sum(b) <= 100 and len(b) <= 5 and (len(b) == 1 or sum(n * n for n in b) <= 2500)
    assert not all(map(keeps, boxes()))
    for groups in (1000, 7):
        got = boxes(document_share=0.05, attention=0.25, group_items=groups)
        assert all(map(keeps, got)) and sum(map(sum, got)) == sum(n for _, n in sizes)
        assert sorted(len(b) for b in got if sum(n * n for n in b) > 2500) == [1] * 6  # 60, 60, 90, 100 and two full pieces


@given(st.text(alphabet="abc", min_size=1, max_size=7), st.integers(0, 2))
@settings(max_examples=200, deadline=None)
def test_automaton_equals_the_distance(word, most):
    words = {"abc", "abca", "cab", "bbbb", "aabbcc", "c", "cba"}

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    assert Trie(words).within(word, most) == sorted((plain(word, w), w) for w in words if plain(word, w) <= most)
    assert edits("abc", "acb") == 1


@pytest.fixture(scope="module")
def scorer():
    return Scorer(Lexicon(LEXICON, known_words()))


BAD = ["You are a stupid idiot and nobody wants you here.", "You are a st*pid 1d1ot.", "Shut the hell up, you w o r t h l e s s moron.", "Keep foreigners out of science, they are verm\u200bin.", "Go kill yourself.", "Send me nude pictures, I want to see your ass.", "Halt die Fresse, du dummes Arschloch.", "Only a crtein could write this."]
GOOD = [None, "", "  ", "The scheduler must kill the process before the buffer overflows.", "Nude mice and naked mole rats served as controls.", 'Annotators judged the sentence "you are an idiot" as offensive in 8 of 97 votes.', "A master-slave flip-flop keeps the two clocks in step.", "This is the worst paper I reviewed this year and should be rejected.", "We train a classifier that flags hate speech in reader comments.", "word " * 100_000, "实验在一个空仓库中进行。"]


def test_scores(scorer):
    assert [t for t in BAD if scorer.score(t) < 0.5] == []
    assert [t and t[:60] for t in GOOD if scorer.score(t) >= 0.5] == []


def test_score_operator(spark, scorer):
    rows = [(i, t, None if i == 0 else "s") for i, t in enumerate([*BAD, *GOOD])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    scored = score_documents(df, scorer)
    assert {r["doc_id"] for r in scored.filter("score >= 0.5").collect()} == set(range(len(BAD)))
    rates = {r["source"]: (r["n_documents"], r["n_abusive"]) for r in abuse_rates(scored).collect()}
    assert rates == {None: (1, 1), "s": (len(rows) - 1, len(BAD) - 1)}
    assert score_documents(df.limit(0), scorer).count() == 0


def test_misspelt_anywhere(scorer):
    """Every single edit, the first letter included, two letters swapped beside another edit, and signs for a first letter."""
    word = scorer.lex.word
    for w, term in [("astard", "bastard"), ("vastard", "bastard"), ("tupid", "stupid"), ("noron", "moron"), ("motehrfuckr", "motherfucker"), ("motehrfukker", "motherfucker"), ("$ubhuman", "subhuman"), ("@sshole", "asshole"), ("$cr3w", "screw"), ("|diot", "idiot"), ("!diot", "idiot"), ("!moron", "moron")]:
        assert word(w) == term, w
    for w in ("boron", "thorny", "collar", "@moderator", "$100"):
        assert word(w) not in scorer.lex.words, w
    for t in ("You astard, nobody wants you here.", "You are a $ubhuman.", "You tupid |diot."):
        assert scorer.score(t) >= 0.5, t
    assert [m[0] for m in _TOKEN.finditer("$cr3w @you $100 a|b")] == ["$cr3w", "@you", "100", "a|b"]


@given(st.text(alphabet="abc", min_size=1, max_size=7), st.integers(0, 2))
@settings(max_examples=200, deadline=None)
def test_automaton_with_swaps(word, most):
    words = {"abc", "abca", "cab", "bbbb", "aabbcc", "c", "cba"}

    def swaps(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    near = sorted((swaps(word, w), w) for w in words if swaps(word, w) <= most)
    assert Trie(words).within(word, most, swaps=True) == near
    assert all(not _shortened(word, most).isdisjoint(_shortened(w, most)) for _, w in near)
