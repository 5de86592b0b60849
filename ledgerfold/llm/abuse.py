"""Abusive, hateful and sexual content: a score for every document, and rates per source.

Method: the lexicon is a trie; a Levenshtein automaton for each unknown word is intersected with it,
so misspelled terms are found without listing their spellings.  Disguises (digits for letters, stars,
spaced or repeated letters, invisible characters, look-alikes) are undone first.  Scores of the
context window then tell abuse from quotation, report and technical use: who is addressed, what stands
around a term, and whether the sentence speaks about such language.

The weights of these features are fitted on the labelled sample (at most ``SAMPLE_ROWS`` rows of it);
everything else is the same for every document.  Each document is scored on its own: no exchange.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm.lookalike import _CANDIDATES, plain_form
from ledgerfold.llm.tokens import VOCABULARIES, vocabulary

#: Most labelled rows that are used for fitting.
SAMPLE_ROWS = 10_000

#: Edits that a misspelt word may be away from a term, by its least length: shorter words have too many neighbours.
EDITS = {9: 2, 5: 1}

#: Terms, by how far they go alone. Longer terms are phrases; words may be misspelled.
LEXICON = {
    # abuse whoever it is said to
    "strong": """
        fuck, fucking, fucked, fucker, motherfucker, dickhead, asshole, arsehole, dumbass, jackass, scumbag, bastard, bitch, cunt, whore, slut, wanker, twat, retard, shithead, bullshit, faggot, horseshit, shitty, steaming shit,
        moron, cretin, imbecile, subhuman, vermin, cockroaches, pussy, tits, horny, porn, blowjob, cumshot, uncensored xxx, masturbate, orgasm, panties, dick pic,
        kill yourself, hang yourself, hope you die, should die, drop dead, smash your face, break your fingers, beat you bloody, hurt you badly, make you crawl, shut the hell up, shut your mouth, too dumb to, lesser breed, wiped out, belong in cages, gas chamber, nobody will miss you,
        arschloch, vollidiot, scheisse, hurensohn, wichser, fotze, schlampe, missgeburt, drecksau, halt die fresse, halt die klappe, verpiss dich, untermenschen, ungeziefer, abschaum, verdammter idiot, verreck,
        connard, connasse, salope, encule, pute, enfoire, batard, ferme ta gueule, ta gueule, vermine, va crever, sous hommes, merde, abruti, ordure, nique ta mere,
        hijo de puta, puta, gilipollas, zorra, perra, cabron, imbecil, pendejo, maricon, callate la boca, ojala te mueras, vete a la mierda, que mierda, alimanas, escoria, cretino,
        白痴, 傻逼, 混蛋, 去死, 贱人, 蠢货, 滚出""",
    # abuse when somebody is addressed, or a group is meant
    "directed": """
        idiot, idiots, idiota, idiote, stupid, stupide, dumb, dumm, dumme, dummes, brainless, braindead, clueless, spineless, worthless, pathetic, disgusting, filthy, loser, clown, parasite, parasites, filth, animals, disease, rats, traitor, ashamed, despise, stinks, begging, breeding, trash, scum, pig, pigs, freak, ugly, fat,
        goddamn, damn, hell, garbage, sorry-ass, screw, choke, scream, moaned, lick, bang, ride, nude, naked, bare, ass, cock, boobs, wet, sex, grabbed, xxx, nackt, gefickt, ficken, baiser, follar, desnuda, nue, shit, piss, crap,
        kill, hurt, beat, smash, disappear, crawled, drown, burn, rot, maldito, mierda, morir, estupido, basura, pauvre, espece, debile, meprise, chasser, creve, sale, scheisse, dreck, verschwinde, widerlich, erbarmlich""",
    # phrases of contempt and exclusion
    "phrase": """
        load of, whoever disagrees, by birth, deserve any rights, do not deserve, out of science, driven out, never be let into, ought to be, good only for, their kind, people like you, other human beings, world a favour, nobody wants you, nobody reads, must regret, you were born, come over, where your lab is, crawled out of, stare at your, come to my hotel, all night, send me, singles, near you, click for free, want to see your,
        you should be, go back to, has never built, never built anything, hold a pencil, spare us, pedazo de, nadie te quiere, tout le monde te, gens la, il faut les, niemand will dich, gehorst nicht, pedazo, diese leute, ausrotten, leute wie du, esa gente, gente como tu, gens comme toi, gens comme vous, hau ab, raus mit, fuera de aqui, largate, degage, retourne""",
}
#: Words that address somebody, or name a group as such.
ADDRESS = frozenset("you your yours yourself u ur ya du dich dir dein deine deinen dein tu te toi ton ta tes vous votre usted ustedes ti tus vosotros sie euch ihr 你 你们".split())
GROUPS = frozenset(
    "they them those people women men foreigners immigrants southerners northerners migrants refugees girls boys blacks whites jews muslims christians gays lesbians faith race kind breed elderly disabled old her him she he gens femmes etrangers frauen auslander leute mujeres extranjeros gente ellos elles ils".split()
)
#: Words of speech about such language, and of technical or factual use.
REPORT = frozenset("annotators annotator annotated judged labelled labeled corpus classifier classify flags flagged filter filters detection detect dataset offensive abusive toxicity speech votes slur moderation sentence quoted quote example examples sites compared study studies survey".split())
TECHNICAL = frozenset(
    "mice mouse rat mole rats controls process buffer scheduler terminal joints nuts shaft tightened valve seconds opened wool aluminium friction solvents imaging trial beetles dimorphism participants age recorded couples clocks flip-flop flip flop master-slave noise signal weaker falls bass recordings mass conserved baseline simple display cockpit stopcock cells tissue experiment samples temperature screws drill".split()
)
#: Words of their own that are one edit from a term and no tokens of the vocabulary of known words.
NEIGHBOURS = frozenset("boron corny thorny poser creak wreak brash baked raked faked dollar collar raiser kaiser terra serra greve summe scoria ducking tucking mucking bucking sucking ranker hanker canker danker fussy hussy thrash dastard kotze".split())

_LEET = str.maketrans("013457@$!|", "oieastasii")
_SIGNS = "@$!|"
_TOKEN = re.compile(r"(?:[@$!|](?=[^\W\d_]))?[^\W_]+(?:[*@$!|'’-]+[^\W_]+)*[*$]*|[一-鿿]")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_]([ ._-]))(?:[^\W\d_]\1){1,}[^\W\d_](?![^\W_])")
_GAPS = re.compile(r"[ ._-]")
_SENTENCE = re.compile(r"(?<=[.?…。！？])[\s\"'”)]+(?=\S)|(?<=[^!]!)[\s\"'”)]+(?=\S)|\n+")
_QUOTES = re.compile(r"[\"“”„«»](?=\S)([^\"“”„«»\n]+)[\"“”„«»]")


@lru_cache(200_000)
def _base(word: str) -> str:
    import unicodedata

    word = "".join(_CANDIDATES.get(c, c)[0] if c > "\x7f" else c for c in word).casefold()
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word.replace("ß", "ss")) if not unicodedata.combining(c))
    return word


def _squeeze(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


class Trie:
    """Words of the lexicon as nested dictionaries; '' marks an end."""

    def __init__(self, words: set[str]):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def within(self, word: str, most: int, swaps: bool = False) -> list[tuple[int, str]]:
        """The words that a Levenshtein automaton of ``word`` accepts, with their distances.

        The automaton is simulated in bits: in state ``r[e]`` bit i says that the first i letters can
        have been read with e edits. The walk goes down the trie only while a state is alive. With
        ``swaps`` two letters in each other's place are one edit: bit i of ``half[e]`` says that the
        second of the letters after the first i has been read and the first must follow. A star in
        ``word`` is any one letter.
        """
        n, out = len(word), []
        whole, end = (1 << (n + 1)) - 1, 1 << n
        stars = sum(1 << i for i, c in enumerate(word) if c == "*")
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, stars) | 1 << i
        stack = [(child, c, tuple((1 << (e + 1)) - 1 for e in range(most + 1)), (0,) * (most + 1)) for c, child in self.root.items()]
        while stack:
            node, c, r, half = stack.pop()
            m = at.get(c, stars)
            before, now = 0, 0
            new, begun = [], []
            for e, h in zip(r, half, strict=True):
                now = ((e & m) << 1 | before | before << 1 | now << 1 | (h & m) << 2) & whole
                new.append(now)
                begun.append(before & m >> 1 if swaps else 0)
                before = e
            if not now:
                continue
            state = tuple(new)
            for x, child in node.items():
                if x == "":
                    d = next((k for k, v in enumerate(state) if v & end), None)
                    if d is not None:
                        out.append((d, child))
                else:
                    stack.append((child, x, state, tuple(begun)))
        return sorted(out)


def _mask(word: str) -> int:
    """The letters of a word as bits; some letters share one."""
    return sum(1 << b for b in {ord(c) % 61 for c in word})


def _shortened(word: str, most: int) -> set[str]:
    """The word with up to ``most`` letters left out."""
    out = last = {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


class Lexicon:
    """Terms with their classes, the trie of their words, and known words that are no misspellings."""

    def __init__(self, terms: dict[str, str] = LEXICON, known: frozenset[str] = frozenset()):
        self.terms: dict[tuple[str, ...], str] = {}
        for kind, text in terms.items():
            for term in text.split(","):
                words = tuple(_base(w) for w in re.findall(r"[\w-]+", term))
                if words and all("一" <= c <= "鿿" for c in words[0]):
                    words = tuple(words[0])
                if words:
                    self.terms[words] = kind
        self.words = {w for t in self.terms for w in t}
        self.longest = max(map(len, self.terms))
        self.first = frozenset(t[0] for t in self.terms)
        #: the longest word of each term: without one of these a text has no term
        self.anchors = frozenset(max(t, key=len) for t in self.terms)
        self.trie = Trie(self.words)
        #: words within d edits share a form with up to d letters left out, so only words with one go to the trie
        self.forms = [set().union(*(_shortened(w, d) for w in self.words)) for d in range(max(EDITS.values()) + 1)]
        self.masks, self.lengths = np.array([_mask(w) for w in self.words], np.int64), np.array([len(w) for w in self.words])
        self.squeezed: dict[str, str] = {}
        for w in sorted(w for w in self.words if len(set(w)) > 1):
            self.squeezed.setdefault(_squeeze(w), w)
        self.known = known | NEIGHBOURS
        self.cache: dict[str, str] = {}
        self.seen: set[str] = set()  # written words that were looked at for anchors, and those that stand for one
        self.hot: set[str] = set()

    def anchored(self, text: str) -> set[str]:
        """Written words that stand for an anchor; every distinct one is looked up once."""
        tokens = set(_TOKEN.findall(text))
        if new := tokens - self.seen:
            if len(self.seen) > 1_000_000:
                self.seen, self.hot, new = set(), set(), tokens
            self.hot.update(t for t in new if self.word(t) in self.anchors)
            self.seen |= new
        return self.hot & tokens if len(self.hot) < len(tokens) else tokens & self.hot

    def word(self, raw: str) -> str:
        """The lexicon's word that a written word stands for, or the word itself."""
        hit = self.cache.get(raw)
        if hit is None:
            hit = self._word(raw)
            if len(self.cache) < 500_000:
                self.cache[raw] = hit
        return hit

    def _word(self, raw: str) -> str:
        if raw[0] in _SIGNS:  # a letter in disguise, or a sign before the word
            hit = self._plain_word(raw)
            return hit if hit in self.words else self._plain_word(raw[1:])
        return self._plain_word(raw)

    def _may_be_near(self, word: str, most: int) -> bool:
        """Whether some term has about the word's letters: an edit changes the length by one and the set of letters by two at most."""
        apart = np.bitwise_count(self.masks ^ _mask(word)) <= 2 * most
        return bool((apart & (np.abs(self.lengths - len(word)) <= most)).any())

    def _plain_word(self, raw: str) -> str:
        low = _base(raw).replace("’", "'")
        if low in self.words:
            return low
        plain = low.strip("*")
        if plain in self.known or (plain.endswith("s") and plain[:-1] in self.known):
            return low
        if plain.isalpha():
            short = _squeeze(plain)
            if re.search(r"(.)\1\1", plain) and short in self.squeezed:
                return self.squeezed[short]
        else:
            undone = re.sub(r"[-']", "", low.translate(_LEET))
            if undone in self.words:
                return undone
            if re.search(r"(.)\1\1", undone) and _squeeze(undone) in self.squeezed:
                return self.squeezed[_squeeze(undone)]
            if "*" in low:
                stars = [w for _, w in self.trie.within(low, 0)]
                return stars[0] if stars else low
            plain = undone
            if plain in self.known:
                return low
        most = next((d for n, d in EDITS.items() if len(plain) >= n), 0)
        if not most or not self._may_be_near(plain, most) or self.forms[most].isdisjoint(_shortened(plain, most)):
            return low
        near = sorted((d, w[0] != plain[0], w) for d, w in self.trie.within(plain, most, swaps=True) if d <= next((e for n, e in EDITS.items() if len(w) >= n - 1), 0))
        return near[0][2] if near else low


def known_words(folder: str = VOCABULARIES) -> frozenset[str]:
    """Words that are tokens of a public vocabulary: common words, so no misspellings of others."""
    out = set()
    for piece in vocabulary("byte_bpe_50k", folder):
        if piece[:1] == b" " and len(piece) > 4 and piece[1:].isalpha():
            out.add(piece[1:].decode("ascii", "ignore").lower())
    return frozenset(out)


FEATURES = ("strong", "directed", "phrase", "addressed", "grouped", "report", "technical", "quoted", "strong_addressed", "directed_addressed", "directed_grouped", "phrase_any")


def sentence_features(sentence: str, lex: Lexicon) -> np.ndarray | None:
    """Features of a sentence with a term in it; null without one."""
    joined = _SPACED.sub(lambda m: _GAPS.sub("", m[0]), sentence)
    spans = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(joined)]
    words = [lex.word(t) for _, _, t in spans]
    hits: list[tuple[int, int, str]] = []
    for i, w in enumerate(words):
        if w not in lex.first:
            continue
        for n in range(min(lex.longest, len(words) - i), 0, -1):
            kind = lex.terms.get(tuple(words[i : i + n]))
            if kind:
                hits.append((i, i + n, kind))
                break
    if not hits:
        return None
    quotes = [m.span(1) for m in _QUOTES.finditer(joined)]
    in_quotes = [h for h in hits if any(a <= spans[h[0]][0] and spans[h[1] - 1][1] <= b for a, b in quotes)]
    own = [h for h in hits if h not in in_quotes] if in_quotes else hits
    low = [_base(t).lstrip(_SIGNS) for _, _, t in spans]
    report = sum(w in REPORT for w in low)
    quoted = float(bool(in_quotes) and not any(k == "strong" for _, _, k in own))
    use = own if own and not quoted else hits
    # the window: eight words on either side of a term
    near = {j for a, b, _ in use for j in range(max(0, a - 8), min(len(low), b + 8))}
    window = [low[j] for j in near]
    count = lambda k: float(len({(a, b) for a, b, x in use if x == k}))
    s, d, p = min(count("strong"), 3), min(count("directed"), 4), min(count("phrase"), 3)
    a, g = float(any(w in ADDRESS for w in window)), float(any(w in GROUPS for w in window))
    t = min(sum(w in TECHNICAL for w in window), 3)
    return np.array([s, d, p, a, g, min(report, 3), t, quoted, min(s, 1) * a, min(d, 2) * a, min(d, 2) * g, float(p > 0 and (a or g or s or d))])


#: Where fitting starts and what it is drawn to: the sample is small.
PRIOR = np.array([2.5, 0.3, 0.3, 0.3, 0.3, -1.2, -1.0, -3.0, 1.0, 1.2, 0.9, 1.2])
PRIOR_BIAS = -2.2


class Scorer:
    def __init__(self, lex: Lexicon, weights: np.ndarray = PRIOR, bias: float = PRIOR_BIAS):
        self.lex, self.weights, self.bias = lex, weights, bias

    def sentences(self, text: str) -> list[np.ndarray]:
        plain, lex = plain_lines(text), self.lex
        spaced, hot = _SPACED.search(plain), lex.anchored(plain)
        if not spaced and not hot:
            return []
        return [f for s in _SENTENCE.split(plain) if s and (any(h in s for h in hot) or (spaced and _SPACED.search(s))) and (f := sentence_features(s, lex)) is not None]

    def score(self, text: str | None) -> float:
        """Chance that the text abuses: that of its worst sentence. 0 for null, empty and clean texts."""
        if not text:
            return 0.0
        z = max((float(f @ self.weights + self.bias) for f in self.sentences(text)), default=-30.0)
        return 1 / (1 + np.exp(-z)) if z > -30 else 0.0

    def fit(self, texts: list[str | None], labels: list[int], rounds: int = 400, rate: float = 0.05, pull: float = 0.02) -> Scorer:
        """Logistic regression on the worst sentence of each text, pulled towards the prior weights."""
        bags = [self.sentences(t) if t else [] for t in texts]
        w, b = PRIOR.copy(), PRIOR_BIAS
        for _ in range(rounds):
            gw, gb, n = np.zeros_like(w), 0.0, 0
            for fs, y in zip(bags, labels, strict=True):
                if not fs:
                    continue
                f = max(fs, key=lambda x: float(x @ w))
                e = 1 / (1 + np.exp(-(f @ w + b))) - y
                gw, gb, n = gw + e * f, gb + e, n + 1
            if not n:
                break
            w = w - rate * (gw / n + pull * (w - PRIOR))
            b = b - rate * (gb / n + pull * (b - PRIOR_BIAS))
        return Scorer(self.lex, w, b)


def plain_lines(text: str) -> str:
    """Text without invisible characters and odd forms, lines kept apart."""
    return "\n".join(plain_form(line) for line in text.split("\n"))


def fit_scorer(sample: DataFrame, folder: str = VOCABULARIES, rows: int = SAMPLE_ROWS) -> Scorer:
    """Fit on ``text`` and ``abusive`` of at most ``rows`` labelled rows."""
    got = sample.select("text", "abusive").filter("text is not null and abusive is not null").limit(rows).collect()
    return Scorer(Lexicon(known=known_words(folder))).fit([r["text"] for r in got], [r["abusive"] for r in got])


def score_documents(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """``docs`` without its text, and ``score`` in 0..1."""
    lex_known, weights, bias = scorer.lex.known, scorer.weights, scorer.bias
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(Lexicon(known=lex_known), weights, bias)
        for b in batches:
            scores = pa.array([float(own.score(x)) for x in b[text].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([b[c] for c in rest] + [scores], [*rest, "score"])

    return docs.mapInArrow(run, schema)


#: A document is reviewed from this score on.
THRESHOLD = 0.5


def abuse_rates(scored: DataFrame, source: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """Per source: documents, those from the threshold on, their share and the mean score; null sources are one."""
    return scored.groupBy(source).agg(
        F.count("*").alias("n_documents"), F.count_if(F.col("score") >= threshold).alias("n_abusive"),
        (F.count_if(F.col("score") >= threshold) / F.count("*")).alias("rate"), F.avg("score").alias("mean_score"),
    )
