"""Remains of HTML, Markdown, wiki and LaTeX markup in texts.

Method: minimum-cut labelling.  A scanner cuts a text into signs that may be markup and the plain
stretches between them.  A classifier gives each sign, for each language it may belong to, the cost
of calling it markup and of calling it content; these become terminal capacities.  Neighbouring signs
of one language, lines of one list, and the two ends of an element (its distance in the document
tree) are tied by smoothness edges.  The maximum flow separates markup from content, so that a weak
sign such as a line that begins with a star is decided by what stands around it.

Signs that only look like markup (prices, comparisons, products, file names) carry costs for content.
Texts without any sign, the great majority, are passed on untouched; each text is a graph of its own,
so the plan has no exchange.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("html", "markdown", "wiki", "latex")
#: Names of HTML elements.
ELEMENTS = frozenset(
    "a abbr acronym address article aside b big blockquote body br button caption center cite code col colgroup dd del dfn div dl dt em figure figcaption font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark meta nav object ol option p param pre q s samp script section select small span strike strong style sub sup table tbody td textarea tfoot th thead title tr tt u ul var video wbr".split()
)
#: Classifier: evidence for markup (above 0) or content (below 0) of each kind of sign.
EVIDENCE = {
    "comment": 4.0, "tag": 4.0, "odd_tag": -1.5, "entity": 3.0, "odd_entity": -2.0,
    "fence": 4.0, "md_code": 2.5, "md_strong": 3.0, "md_em": 2.0, "md_under": 0.6, "md_link": 4.0, "md_heading": 1.6, "md_setext": 3.0, "md_list": 2.0, "md_number": 1.2, "md_star": 0.3, "md_quote": 0.4,
    "wiki_quote": 2.5, "wiki_link": 3.5, "wiki_template": 3.0, "wiki_heading": 3.5, "wiki_url": 4.0, "wiki_star": -0.2, "wiki_number": -0.2,
    "tex_env": 4.0, "tex_cmd": 3.0, "tex_group": 4.0, "tex_math": 3.0, "tex_price": -3.0, "tex_escape": 1.5, "tex_accent": 2.5, "tex_quote": 3.0, "tex_tie": 1.0,
}
#: Smoothness: of neighbours (falling with their distance), of list lines, and of the ends of an element.
NEIGHBOUR, LIST_LINES, ELEMENT_ENDS, REACH = 0.5, 1.5, 3.0, 400

#: A line that was only wrapped.
_WRAP = r"\n(?=[ \t]+\S)"
#: The end of a line that a formula or template runs over: no blank line follows.
_LINE = r"\n(?![ \t]*\n)"
#: The scanner: alternatives in order of precedence; the group's name is the kind of sign.
_SIGNS = re.compile(
    rf"""
    (?P<fence>(?m:^)[ \t]*(?P<f_mark>```|~~~)(?P<f_lang>[\w+-]*)[ \t]*\n(?P<f_body>.*?)\n?[ \t]*(?P=f_mark)[ \t]*(?m:$))
  | (?P<verb>\\verb\*?(?P<v_mark>[^\w\s])(?P<v_body>[^\n]*?)(?P=v_mark))
  | (?P<comment><!--.*?-->)
  | (?P<pre><pre\b[^<>]*>(?P<pre_body>.*?)</pre\s*>)
  | (?P<tag></?(?P<t_name>[a-zA-Z][a-zA-Z0-9]*)(?:\s+[^<>"]*(?:"[^"<>]*"[^<>"]*)*)?\s*/?>)
  | (?P<entity>&(?:\#[0-9]{{1,7}}|\#[xX][0-9a-fA-F]{{1,6}}|[a-zA-Z][a-zA-Z0-9]{{1,30}});)
  | (?P<env>\\begin\{{(?P<e_name>[a-zA-Z]+\*?)\}}(?P<e_body>.*?)\\end\{{(?P=e_name)\}})
  | (?P<env_end>\\(?:begin|end)\{{[a-zA-Z]+\*?\}})
  | (?P<display>\\\[(?P<d_body>.*?)\\\]|\\\((?P<p_body>.*?)\\\)|\$\$(?P<dd_body>[^$]+)\$\$)
  | (?P<math>(?<![\\$\w])\$(?P<m_body>[^$\n]+|(?=\S)(?:[^$\n]|{_LINE})+(?<=\S))\$(?!\d))
  | (?P<group>\{{\\(?P<g_name>it|em|bf|tt|sc|sl|rm|sf|small|large)\b\s*(?P<g_body>[^{{}}]*)\}})
  | (?P<accent>\\["'`^~=.uvHtcdb](?:\{{\\?[a-zA-Z]\}}|\\[ij]\b|[a-zA-Z](?![a-zA-Z]*\{{)))
  | (?P<cmd>\\(?P<c_name>[a-zA-Z]+)\*?(?:\[[^\]\n]*\])?(?P<c_args>(?:\{{(?:[^{{}}]|\{{[^{{}}]*\}})*\}})*))
  | (?P<escape>\\[%&_\#{{}}$])
  | (?P<texquote>``(?P<q_body>[^`'\n]+(?:'[^`'\n]+)*)'')
  | (?P<tie>(?<=[\w.)])~(?=[\w\\$])|~(?=\\|\$))
  | (?P<wtemplate>\{{\{{(?=[^{{}}\\]))
  | (?P<wlink>\[\[(?P<wl_body>(?:[^\[\]\n]|{_WRAP})+)\]\])
  | (?P<mlink>!?\[(?P<ml_text>(?:[^\[\]\n]|{_WRAP})*)\]\((?P<ml_url>[^()\s]+)(?:\s+"[^"\n]*")?\))
  | (?P<wurl>\[(?:https?|ftp)://[^\s\]]+(?:\s+(?P<wu_text>(?:[^\]\n]|{_WRAP})*))?\])
  | (?P<wquote>'''''(?P<wq5>(?=\S)(?:[^'\n]|{_WRAP}|'(?!'))+)'''''|''(?P<wqn>(?=[^\s'])(?:[^'\n]|{_WRAP}|'(?!')|'''(?:[^'\n]|'(?!'))+''')+)''(?!'(?!''))|'''(?P<wq3>(?=\S)(?:[^'\n]|{_WRAP}|'(?!')|(?<!')''(?!')(?:[^'\n]|'(?!'))+''(?!'))+)'''|''(?P<wq2>(?=\S)(?:[^'\n]|{_WRAP}|'(?!'))+)'')
  | (?P<wheading>(?m:^)(?P<wh_mark>={{2,6}})[ \t]*(?P<wh_text>[^=\n]+?)[ \t]*(?P=wh_mark)[ \t]*(?m:$))
  | (?P<setext>(?m:^)(?P<s_text>[^\s=\-*\#>][^\n]*)\n[ \t]*(?P<s_mark>={{3,}}|-{{3,}})[ \t]*(?m:$))
  | (?P<mheading>(?m:^)(?P<mh_mark>\#{{1,6}})[ \t]+(?P<mh_text>[^\n\#]+?)[ \t]*\#*[ \t]*(?m:$))
  | (?P<item>(?m:^)[ \t]*(?P<i_mark>[*+\-\#]|\d{{1,3}}[.)])[ \t]+(?P<i_text>[^\n]+))
  | (?P<mquote>(?m:^)>[ \t]+(?=\S))
  | (?P<mstrong>(?<![\w*])(?P<ms_mark>\*\*\*|\*\*)(?P<ms_text>[^\s*](?:(?:[^*\n]|{_WRAP})*[^\s*])?)(?P=ms_mark)(?![\w*])|(?<![\w_])__(?P<mu_text>[^\s_](?:(?:[^_\n]|{_WRAP})*[^\s_])?)__(?![\w_]))
  | (?P<mem>(?<![\w*])\*(?P<me_text>[^\s*](?:(?:[^*\n]|{_WRAP})*[^\s*])?)\*(?![\w*]))
  | (?P<munder>(?<![\w_/.])_(?P<mun_text>[^\s_](?:(?:[^_\n]|{_WRAP})*[^\s_])?)_(?![\w_]))
  | (?P<mcode>(?<!`)`(?P<mc_text>(?:[^`\n]|{_WRAP})+)`(?!`))
    """,
    re.VERBOSE | re.DOTALL,
)
#: A text without any of these has no sign.
_HINT = r"[<&\\$~`*_#{\[]|''|(?m:^)[ \t]*(?:[-+>]|\d{1,3}[.)])[ \t]|(?m:^)[ \t]*[=-]{2,}"
_TITLES = {"section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4, "chapter": 1, "title": 1}
_DROPPED = {"cite", "citep", "citet", "ref", "eqref", "label", "pageref", "footnotemark", "bibliography", "vspace", "hspace"}


@dataclass
class Sign:
    start: int
    end: int
    kind: str
    match: re.Match
    #: language -> kinds of sign that it may be there
    may: dict[str, str] = field(default_factory=dict)


def _looks_like_math(body: str) -> bool:
    if body != body.strip():
        return False
    return bool(re.search(r"[\\^_{}=<>+]|^[a-zA-Z]$|^[a-zA-Z]\([a-zA-Z0-9]\)$", body))


_INK, _NEXT_NUMBER = re.compile(r"\S"), re.compile(r"\n#[ \t]")


def _apart(text: str, at: int) -> bool:
    """Whether a blank line stands before a place."""
    return text.startswith("\n\n", at - 2) if at >= 2 else False


def template_ends(text: str) -> dict[int, int]:
    """Where a template that begins at a place ends; templates may hold others and run over lines."""
    out, open_ = {}, []
    for m in _BRACES.finditer(text):
        if m[0] == "{{":
            open_.append(m.start())
        elif open_:
            out[open_.pop()] = m.end()
    return out


_BRACES = re.compile(r"\{\{|\}\}")


def _offers(m: re.Match, text: str) -> dict[str, str]:
    """The languages that a sign may belong to, with its kind in each."""
    k = m.lastgroup if m.lastgroup in _KINDS else next(n for n in _KINDS if m[n] is not None)
    if k == "tag":
        return {"html": "tag" if m["t_name"].lower() in ELEMENTS else "odd_tag"}
    if k == "entity":
        return {"html": "entity" if html.unescape(m[0]) != m[0] else "odd_entity"}
    if k == "math":
        return {"latex": "tex_math" if _looks_like_math(m["m_body"]) else "tex_price"}
    if k == "cmd":
        return {"latex": "tex_cmd"}
    if k == "item":
        mark = m["i_mark"]
        apart = m.start() == 0 or _apart(text, m.start())
        if mark in "+-":
            return {"markdown": "md_list"}
        if mark == "*":
            return {"markdown": "md_star", "wiki": "wiki_star"} if apart else {"wiki": "wiki_star", "markdown": "md_star"}
        if mark == "#":
            return {"wiki": "wiki_number"}
        return {"markdown": "md_number"}
    if k == "mheading":
        # a heading stands first or after a blank line; otherwise a line of a numbered wiki list
        begins = _apart(text, m.start()) or _INK.search(text).start() >= m.start()
        if len(m["mh_mark"]) > 1 or (begins and (text.startswith("\n\n", m.end()) or not _NEXT_NUMBER.match(text, m.end()))):
            return {"markdown": "md_heading"}
        return {"wiki": "wiki_number"}
    return _KINDS[k]


_KINDS: dict[str, dict[str, str]] = {
    "fence": {"markdown": "fence"}, "verb": {"latex": "tex_cmd"}, "comment": {"html": "comment"}, "pre": {"html": "tag"}, "tag": {}, "entity": {}, "env": {"latex": "tex_env"}, "env_end": {"latex": "tex_env"},
    "display": {"latex": "tex_env"}, "math": {}, "group": {"latex": "tex_group"}, "accent": {"latex": "tex_accent"}, "cmd": {}, "escape": {"latex": "tex_escape"}, "texquote": {"latex": "tex_quote"}, "tie": {"latex": "tex_tie"},
    "wtemplate": {"wiki": "wiki_template"}, "wlink": {"wiki": "wiki_link"}, "mlink": {"markdown": "md_link"}, "wurl": {"wiki": "wiki_url"}, "wquote": {"wiki": "wiki_quote"}, "wheading": {"wiki": "wiki_heading"},
    "setext": {"markdown": "md_setext"}, "mheading": {}, "item": {}, "mquote": {"markdown": "md_quote"}, "mstrong": {"markdown": "md_strong"}, "mem": {"markdown": "md_em"}, "munder": {"markdown": "md_under"}, "mcode": {"markdown": "md_code"},
}
#: Signs whose inside is text that may hold further signs: the group of that inside.
_INSIDE = {"wlink": "wl_body", "mlink": "ml_text", "wurl": "wu_text", "wquote": ("wq5", "wqn", "wq3", "wq2"), "wheading": "wh_text", "setext": "s_text", "mheading": "mh_text", "item": "i_text", "mstrong": ("ms_text", "mu_text"), "mem": "me_text", "munder": "mun_text", "group": "g_body", "env": "e_body", "texquote": "q_body"}
_MATHS = ("equation", "align", "displaymath", "gather", "eqnarray", "multline", "math")


def _inside(m: re.Match, kind: str) -> tuple[int, int] | None:
    names = _INSIDE.get(kind)
    for n in (names,) if isinstance(names, str) else names or ():
        if m[n] is not None:
            return m.span(n)
    if kind == "cmd" and m["c_args"]:
        at = m.start("c_args") + m["c_args"].rfind("{") + 1 if m["c_args"].count("{") == 1 else m.start("c_args") + 1
        return at, m.end("c_args") - 1
    return None


def _matches(text: str, start: int, end: int, ends: dict[int, int]) -> Iterator[tuple[re.Match, int]]:
    """Signs of a stretch and where they end; braces that open no template are passed over."""
    while m := _SIGNS.search(text, start, end):
        to = ends.get(m.start(), 0) if m["wtemplate"] is not None else m.end()
        if not m.start() < to <= end:
            start = m.start() + 1
            continue
        yield m, to
        start = to


def scan(text: str, start: int = 0, end: int | None = None, in_math: bool = False, ends: dict[int, int] | None = None) -> list[Sign]:
    """Signs in order, those inside others after them: a kind never holds itself but for environments, so nesting ends."""
    out = []
    end = len(text) if end is None else end
    ends = template_ends(text) if ends is None else ends
    for m, to in _matches(text, start, end, ends):
        kind = next(n for n in _KINDS if m[n] is not None)
        s = Sign(m.start(), to, kind, m, _offers(m, text))
        if kind == "cmd" and not m["c_args"] and m["c_name"] not in ("item", "ldots", "dots", "LaTeX", "TeX", "newline", "noindent", "par", "alpha", "beta", "to", "times", "cdot", "quad", "emph", "maketitle") and len(m["c_name"]) < 3:
            s.may = {"latex": "tex_tie"}
        out.append(s)
        if in_math:
            continue
        if kind == "math":  # a formula may be cut by a sign of another language
            out += [x for x in scan(text, *m.span("m_body"), True, ends) if x.kind in ("wurl", "wlink", "mlink", "mstrong", "wquote")]
        inner = _inside(m, kind)
        if inner and not (kind == "env" and m["e_name"].rstrip("*") in _MATHS) and inner[1] > inner[0]:
            out += scan(text, inner[0], inner[1], False, ends)
    return out


def max_flow_side(n: int, source: dict[int, float], sink: dict[int, float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut of an undirected graph with terminals: for each node, is it on the source's side."""
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, c: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(c)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for v, c in source.items():
        link(s, v, c, 0.0)
    for v, c in sink.items():
        link(v, t, c, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = [s]
        for v in queue:
            for e in out[v]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[v] >= 0 for v in range(n)]
        at = [0] * (n + 2)
        while True:  # one augmenting path at a time, without recursion
            path, v = [], s
            while v != t:
                while at[v] < len(out[v]) and not (cap[out[v][at[v]]] > 1e-9 and level[to[out[v][at[v]]]] == level[v] + 1):
                    at[v] += 1
                if at[v] == len(out[v]):
                    if not path:
                        break
                    v = to[path.pop() ^ 1]
                    at[v] += 1
                    continue
                path.append(out[v][at[v]])
                v = to[path[-1]]
            if v != t:
                break
            f = min(cap[e] for e in path)
            for e in path:
                cap[e] -= f
                cap[e ^ 1] += f


def label(text: str) -> list[tuple[Sign, str]]:
    """The signs of a text that are markup, each with its language."""
    signs = scan(text)
    nodes = [(i, lang) for i, s in enumerate(signs) for lang in s.may]
    if not nodes:
        return []
    source, sink, edges = {}, {}, []
    last: dict[str, int] = {}
    opened: list[tuple[str, int]] = []
    for v, (i, lang) in enumerate(nodes):
        s = signs[i]
        kind = s.may[lang]
        cost = EVIDENCE[kind]
        if s.kind == "item":  # a Markdown list stands apart from the paragraph before it
            prev = nodes[last[lang]] if lang in last else None
            begins = not (prev and signs[prev[0]].kind == "item" and signs[prev[0]].end + 1 == s.start)
            if begins and kind in ("md_star", "md_list", "md_number") and s.start and not _apart(text, s.start):
                cost -= 1.0
            if begins and kind in ("wiki_star", "wiki_number") and _apart(text, s.start):
                cost -= 0.6
        if cost > 0:
            source[v] = cost
        else:
            sink[v] = -cost
        if lang in last:
            w = last[lang]
            before = signs[nodes[w][0]]
            gap = s.start - before.end
            if before.kind == "item" == s.kind and gap <= 1:
                edges.append((w, v, LIST_LINES))
            elif cost > -2 and abs(gap) < REACH and not (s.kind == "math" and kind == "tex_price"):
                edges.append((w, v, NEIGHBOUR * (1 - abs(gap) / REACH)))
        last[lang] = v
        if s.kind == "tag":
            name = s.match["t_name"].lower()
            if s.match[0].startswith("</"):
                for j in range(len(opened) - 1, -1, -1):
                    if opened[j][0] == name:
                        edges.append((opened[j][1], v, ELEMENT_ENDS))
                        del opened[j:]
                        break
            else:
                opened.append((name, v))
    side = max_flow_side(len(nodes), source, sink, edges)
    tied = [0.0] * len(nodes)  # what holds a sign to others on its side
    for a, b, c in edges:
        if side[a] and side[b]:
            tied[a] += c
            tied[b] += c
    best: dict[int, tuple[float, str]] = {}
    for v, (i, lang) in enumerate(nodes):
        if side[v]:
            strength = EVIDENCE[signs[i].may[lang]] + tied[v]
            if i not in best or strength > best[i][0]:
                best[i] = (strength, lang)
    return [(s, best[i][1]) for i, s in enumerate(signs) if i in best]


def languages(text: str | None) -> list[str]:
    """Languages of which a text holds markup; none for null and plain text."""
    if not text or not re.search(_HINT, text):
        return []
    found = {lang for _, lang in label(text)}
    return [x for x in LANGUAGES if x in found]


#: Accents of LaTeX and the combining marks they stand for.
_ACCENTS = {"'": "\u0301", "`": "\u0300", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307", "u": "\u0306", "v": "\u030c", "H": "\u030b", "c": "\u0327"}


def _render(s: Sign, inner: str, text: str) -> str:
    """What stands for a sign in clean text: headings as ``# x``, items as ``- x``, code and formulas kept."""
    import unicodedata

    m, k = s.match, s.kind
    if k == "fence":
        return f"```{m['f_lang']}\n{m['f_body']}\n```"
    if k == "verb":
        return f"`{m['v_body']}`"
    if k == "mcode":
        return m[0]
    if k == "pre":
        body = re.sub(r"</?[a-zA-Z][^<>]*>", "", m["pre_body"])
        return f"\n```\n{html.unescape(body).strip(chr(10))}\n```\n"
    if k == "comment":
        return ""
    if k == "entity":
        return html.unescape(m[0]).replace("\xa0", " ")
    if k == "tag":
        name, closing = m["t_name"].lower(), m[0].startswith("</")
        if re.fullmatch("h[1-6]", name):
            return "\n" if closing else "\n" + "#" * int(name[1]) + " "
        if name == "li":
            return "" if closing else "\n- "
        if name in ("br", "p", "div", "ul", "ol", "tr", "table", "blockquote", "hr"):
            return "\n"
        if name in ("code", "tt", "kbd", "samp"):
            return "`"
        if name in ("sub", "sup"):
            return ("}" if closing else "_{" if name == "sub" else "^{")
        if name in ("td", "th"):
            return "" if closing else "\t"
        return ""
    if k == "env":
        name = m["e_name"].rstrip("*")
        if name in _MATHS:
            return f"\n$${m['e_body'].strip()}$$\n"
        if name in ("verbatim", "lstlisting"):
            return f"\n```\n{m['e_body'].strip(chr(10))}\n```\n"
        return "\n" + inner.strip("\n") + "\n"
    if k == "env_end":
        return ""
    if k == "display":
        body = next(b for b in (m["d_body"], m["p_body"], m["dd_body"]) if b is not None)
        return f"${body.strip()}$" if m["p_body"] is not None else f"$${body.strip()}$$"
    if k == "math":
        return m[0]
    if k == "accent":
        letter = re.sub(r"[\\{}]", "", m[0][2:])[-1:]
        return unicodedata.normalize("NFC", letter + _ACCENTS.get(m[0][1], ""))
    if k == "escape":
        return m[0][1]
    if k == "tie":
        return " "
    if k == "texquote":
        return f"\u201c{inner}\u201d"
    if k == "cmd":
        name = m["c_name"]
        if name in _TITLES:
            return "\n" + "#" * _TITLES[name] + f" {inner}\n"
        if name == "item":
            return "\n- "
        if name in ("texttt", "code"):
            return f"`{inner}`"
        if name in _DROPPED:
            return ""
        return inner if m["c_args"] else {"ldots": "...", "dots": "..."}.get(name, "")
    if k in ("wheading", "setext", "mheading"):
        n = len(m["wh_mark"]) - 1 if k == "wheading" else len(m["mh_mark"]) if k == "mheading" else 1 if m["s_mark"][0] == "=" else 2
        return "#" * n + " " + inner.strip()
    if k == "item":
        return ("- " if m["i_mark"] in "*+-" else "1. " if m["i_mark"] == "#" else m["i_mark"] + " ") + inner
    if k == "wlink":
        return inner.rpartition("|")[2]
    if k in ("wtemplate", "mquote"):
        return ""
    return inner


def clean(text: str | None) -> str | None:
    """Text without markup; null for null. Headings, lists, code and formulas are kept in plain form."""
    if not text or not re.search(_HINT, text):
        return text
    kept = [s for s, _ in label(text)]

    def build(start: int, end: int, at: int) -> tuple[str, int]:
        parts, pos = [], start
        while at < len(kept) and kept[at].start < end:
            s = kept[at]
            if s.start < pos:
                at += 1
                continue
            parts.append(text[pos : s.start])
            span = _inside(s.match, s.kind)
            inner, at = build(*span, at + 1) if span else ("", at + 1)
            while at < len(kept) and kept[at].start < s.end:
                at += 1
            parts.append(_render(s, inner, text))
            pos = s.end
        parts.append(text[pos:end])
        return "".join(parts), at

    out = build(0, len(text), 0)[0]
    out = re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", out))
    return re.sub(r"(?<=\S) {2,}", " ", out).strip()


def _fields(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(c).alias("text")) for n, c in columns.items()])).alias("f")).select("key", "f.*").filter("text is not null")


def find_markup(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """``key, field_name, markup``: one row for each language whose markup a field holds."""
    kind = df.select(key).schema[0].dataType.simpleString()
    signs = _fields(df, key, columns).filter(F.col("text").rlike(_HINT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [languages(x) for x in b["text"].to_pylist()]
            parents = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
            yield pa.RecordBatch.from_arrays([b["key"].take(parents), b["field_name"].take(parents), pa.array([x for f in found for x in f], pa.string())], ["key", "field_name", "markup"])

    return signs.mapInArrow(run, f"key {kind}, field_name string, markup string").withColumnRenamed("key", key)


def clean_markup(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """``key, field_name, text``: every field that is not null, without markup."""
    kind = df.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["key"], b["field_name"], pa.array([clean(x) for x in b["text"].to_pylist()], pa.string())], ["key", "field_name", "text"])

    return _fields(df, key, columns).mapInArrow(run, f"key {kind}, field_name string, text string").withColumnRenamed("key", key)
