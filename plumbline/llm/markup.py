"""Markup residue in texts: recognising HTML/XML, Markdown, wiki and LaTeX constructs and turning them into structured plain text."""

from __future__ import annotations

import html
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from html.entities import html5

import pyarrow as pa
import regex as re
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.lineage import cut
from plumbline.plans.shipping import ship

#: Element names of HTML, and of the journal and formula vocabularies that come without a prefix.
ELEMENTS = (
    "a abbr article b bdi bdo big blockquote body br button caption center cite code col dd del details dfn div dl dt em fig figcaption figure font footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html i img inf input ins italic kbd label li link list list-item main mark math meta mfrac mi mml mn mo mrow msub msup mtext nav object ol option p pre q s "
    "samp script sec section select small span strike strong style sub sup svg table tbody td textarea tfoot th thead title tr tt u ul underline bold var video wbr ref references nowiki xref abstract"
)
#: LaTeX commands that may stand without an argument.
BARE_COMMANDS = (
    "item par noindent newline linebreak bigskip medskip smallskip centering maketitle hline ldots dots cdots textbackslash quad qquad LaTeX TeX "
    "alpha beta gamma delta epsilon varepsilon zeta eta theta kappa lambda mu nu xi pi rho sigma tau phi varphi chi psi omega Gamma Delta Theta Lambda Xi Pi Sigma Phi Psi Omega "
    "sum prod int max min log exp leq geq le ge neq approx times cdot pm infty partial nabla in notin subset cup cap to rightarrow leftarrow top forall exists sim propto"
)
#: Signs that LaTeX commands stand for.
SIGNS = dict(
    zip(
        (
            "alpha beta gamma delta epsilon varepsilon zeta eta theta kappa lambda mu nu xi pi rho sigma tau phi varphi chi psi omega Gamma Delta Theta Lambda Xi Pi Sigma Phi Psi Omega "
            "sum prod int leq geq le ge neq approx times cdot pm infty partial nabla in notin subset cup cap to rightarrow leftarrow top forall exists sim propto ldots dots cdots quad qquad"
        ).split(),
        (
            "α β γ δ ε ε ζ η θ κ λ μ ν ξ π ρ σ τ φ φ χ ψ ω Γ Δ Θ Λ Ξ Π Σ Φ Ψ Ω "
            "Σ Π ∫ ≤ ≥ ≤ ≥ ≠ ≈ × · ± ∞ ∂ ∇ ∈ ∉ ⊂ ∪ ∩ → → ← ⊤ ∀ ∃ ∼ ∝ … … ⋯"
        ).split()
        + [" ", " "],
    )
)
#: Combining marks of LaTeX accents.
ACCENTS = dict(zip("`'^\"~=.cvuHr", "\u0300\u0301\u0302\u0308\u0303\u0304\u0307\u0327\u030c\u0306\u030b\u030a"))

_NAMES = "|".join(sorted(map(re.escape, ELEMENTS.split()), key=len, reverse=True))
_VALUE = r"""\s*=\s*(?:"[^"<]*"|'[^'<]*'|[^\s"'<>=]+)"""
_TAG = rf"</?(?:(?i:{_NAMES})|[A-Za-z][\w.-]*:[A-Za-z][\w.-]*)(?:\s+[\w:.-]+(?:{_VALUE})?)*\s*/?>|</[A-Za-z][\w.-]*\s*>|<[A-Za-z][\w.-]*(?:\s+[\w:.-]+{_VALUE})+\s*/?>|<[A-Za-z][\w.-]*\s*/>"
_COMMENT = r"<!--.*?-->|<!DOCTYPE[^>]*>|<\?xml[^>]*\?>|<!\[CDATA\[.*?\]\]>"
_ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]{1,31}|\#[0-9]{1,7}|\#[xX][0-9A-Fa-f]{1,6});"
_BARE = "|".join(sorted(BARE_COMMANDS.split(), key=len, reverse=True))
_MATH = r"(?<![\w$\\])\$(?![\s$])(?=[^$\n]*[\\^_={}+]|[A-Za-z]\$|[^\s$]+\$)((?:[^$\n\\]|\\.)+?)(?<![\s])\$(?![\w$])"

#: One pattern for each kind; a text has the kind where the pattern is found.
KINDS = {
    "html": re.compile(rf"{_TAG}|{_COMMENT}|{_ENTITY}", re.S),
    "markdown": re.compile(
        r"(?m)^\ {0,3}\#{1,6}[ \t]+\S|^\ {0,3}(?:```|~~~)|(?<![\w*\\])\*{1,3}(?=[^\s*])[^*\n]*?[^\s*\\]\*{1,3}(?![\w*])|(?<![\w_\\])_{1,3}(?=[^\s_])[^\n]*?[^\s_]_{1,3}(?![\w_])"
        r"|(?<![`\w])`[^`\n]+`(?![`'])|!?\[[^\[\]\n]*\]\((?:[^()\s]|\([^()\s]*\))+(?:\s+\"[^\"]*\")?\)|\[[^\[\]\n]+\]\[[^\[\]\n]*[A-Za-z][^\[\]\n]*\]|^\ {0,3}\[[^\]\n]+\]:\s+\S+|~~[^~\n]+~~"
        r"|^\ {0,3}>[ \t]+\S|^[ \t]*[-*+][ \t]+(?!p\s*[<>=\u2264\u2265])\S.*|^\ {0,3}[0-9]{1,3}[.)][ \t]+\S.*\n\ {0,3}[0-9]{1,3}[.)][ \t]+\S|^\ {0,3}\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$|^\ {0,3}(?:-{3,}|\*{3,}|_{3,}|={3,})[ \t]*$|<https?://[^<>\s]+>"
    ),
    "wiki": re.compile(
        r"(?m)^={2,6}[^=\n].*?={2,6}[ \t]*$|\[\[[^\[\]\n]+\]\]|\{\{[^{}]+\}\}|^\{\|.*$|^\|\}|^\|-|(?<!')'{2,5}(?=[^'\s])[^'\n](?:[^\n]*?[^'\s`])?'{2,5}(?!')|(?<!\])\[(?:https?|ftp)://[^\s\]]+(?:[ \t]+[^\]\n]+)?\]|__(?:NO)?TOC__|\#REDIRECT|^[*\#:;]+[ \t]*\S.*\n[*\#:;]+[ \t]*\S"
    ),
    "latex": re.compile(
        rf"\\[A-Za-z]+\*?\s*(?:\[[^\]\n]*\])?\{{|\\(?:{_BARE})(?![A-Za-z])|\\(?:begin|end)\b|\\[%&$\#_{{}}](?=\W|\w|$)|\\[`'^\"~=.]\{{?\\?[A-Za-z]\}}?|\$\$.+?\$\$|{_MATH}|\\\(.+?\\\)|\\\[.+?\\\]|``[^`\n]+?''|\\\\(?=\s|$)|\w~\\?[(\\\w]",
        re.S | re.M,
    ),
}

#: Signs of which a text has at least one where it has the kind; plain substrings, far cheaper than the patterns.
GATES = {"html": ("<", "&"), "latex": ("\\", "$", "``", "~")}
#: Signs after a line's start, of kinds whose gate would else be open for every prose text.
_LINE_START = re.compile(r"(?m)^[ \t]*(?:[-*+#>|=_:;~`\[]|[0-9]{1,3}[.)])")

#: Without one of these a text can't hold any construct; the test runs inside the JVM.
MAY_HOLD = r"[<&*_`\[\]{}\\$~|>]|''|(?m:^[ \t]*[-+#=;:])|(?m:^[ \t]*[0-9]{1,3}[.)][ \t])|#{1,6} |\[\["


@lru_cache(maxsize=512)
def _compiled(pattern: str, flags: int = 0) -> re.Pattern:
    return re.compile(pattern, flags)


def _sub(pattern: str, to, text: str, flags: int = 0) -> str:
    return _compiled(pattern, flags).sub(to, text)


def _open(kind: str, text: str) -> bool:
    """Whether the kind's pattern can match at all."""
    if kind in ("markdown", "wiki"):
        inner = ("*", "_", "`", "](", "][", "~~", "<http") if kind == "markdown" else ("''", "[[", "{{", "[http", "[ftp", "TOC__", "#REDIRECT")
        return any(g in text for g in inner) or bool(_LINE_START.search(text))
    return any(g in text for g in GATES[kind])


def kinds_of(text: str) -> list[str]:
    """The kinds of markup that a text holds."""
    out = []
    for kind, pattern in KINDS.items():
        if not _open(kind, text):
            continue
        if kind == "html":
            if any(not m[0].startswith("&") or m[0].startswith("&#") or m[0][1:] in html5 for m in pattern.finditer(text)):
                out.append(kind)
        elif pattern.search(_sub(r"``[^`\n]+?''", "", text) if kind == "wiki" and "``" in text else text):
            out.append(kind)
    return out


def _formula(body: str) -> str:
    """A formula in one line of plain signs: fractions as quotients, named signs as characters."""
    body = _sub(r"\\(?:left|right|displaystyle|limits|,|;|!|:)", "", body)
    before = None
    while body != before:
        before = body
        body = _sub(r"\\(?:d|t)?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"(\1)/(\2)", body)
        body = _sub(r"\\sqrt\s*\{([^{}]*)\}", r"√(\1)", body)
        body = _sub(r"\\(?:hat|bar|tilde|vec)\s*\{?([A-Za-z])\}?", lambda m: m[1] + "\u0302", body)
        body = _sub(r"\\(?:text|mathrm|mathbf|mathit|operatorname|mathcal|mathbb)\s*\{([^{}]*)\}", r"\1", body)
        body = _sub(r"([_^])\{([^{}]*)\}", lambda m: m[1] + (m[2] if len(m[2]) == 1 else f"({m[2]})"), body)
    body = _sub(r"\\([A-Za-z]+)", lambda m: SIGNS.get(m[1], m[1]), body)
    return _sub(r"\s+", " ", _sub(r"[{}\\]", "", body)).strip()


def _accent(m: re.Match) -> str:
    return unicodedata.normalize("NFC", m[2].replace("\\", "") + ACCENTS[m[1]])


def _unescape(text: str) -> str:
    """Character entities resolved until none is left, so that texts escaped twice come out whole."""
    while True:  # each round shortens the text
        new = _sub(_ENTITY, lambda m: html.unescape(m[0]) if m[0].startswith("&#") or m[0][1:] in html5 else m[0], text)
        if new == text:
            break
        text = new
    return text.replace("\xa0", " ")


def to_plain(text: str) -> str:
    """Plain text with structure: headings and list items (``•``) on lines of their own, code indented, formulas in plain signs.

    A text without markup is returned unchanged.
    """
    if not kinds_of(text):
        return text
    kept: list[str] = []

    def keep(s: str) -> str:
        kept.append(s)
        return f"\ue000{len(kept) - 1}\ue001"

    def code(s: str, block: bool) -> str:
        s = _unescape(s.strip("\n"))
        return keep("\n" + "\n".join("    " + line for line in s.split("\n")) + "\n") if block else keep(s)

    def display(m: re.Match) -> str:
        return "\n" + keep("    " + _formula(next(g for g in m.groups() if g is not None))) + "\n"

    t = text
    if not _compiled(_TAG).search(t) and _compiled(r"&(?:amp;)*lt;\s*/?[A-Za-z!]").search(t):
        t = _sub(r"&(?:amp;)*(lt|gt|quot);", lambda m: html.unescape(f"&{m[1]};"), t)  # markup escaped as a whole
    t = _sub(_COMMENT, lambda m: m[0][9:-3] if m[0].startswith("<![CDATA[") else " ", t, flags=int(re.S))
    t = _sub(r"(?i)<(script|style)\b[^>]*>.*?</\1\s*>", " ", t, flags=int(re.S))
    t = _sub(r"(?i)<pre[^>]*>\s*(?:<code[^>]*>)?(.*?)(?:</code>)?\s*</pre>", lambda m: code(m[1], True), t, flags=int(re.S))
    t = _sub(r"(?m)^ {0,3}(```|~~~)[^\n]*\n(.*?)\n? {0,3}\1[ \t]*$", lambda m: code(m[2], True), t, flags=int(re.S))
    t = _sub(r"\\begin\{(?:verbatim|lstlisting)\}(.*?)\\end\{(?:verbatim|lstlisting)\}", lambda m: code(m[1], True), t, flags=int(re.S))
    t = _sub(r"\\begin\{(?:equation|align|displaymath|gather)\*?\}(.*?)\\end\{(?:equation|align|displaymath|gather)\*?\}|\$\$(.+?)\$\$|\\\[(.+?)\\\]", display, t, flags=int(re.S))
    t = _sub(rf"\\\((.+?)\\\)|{_MATH}", lambda m: keep(_formula(m[1] or m[2])), t, flags=int(re.S))
    t = _sub(r"(?i)<code[^>]*>(.*?)</code>", lambda m: code(m[1], False), t, flags=int(re.S))
    t = _sub(r"(?<![`\w])`([^`\n]+)`(?![`'])", lambda m: code(m[1], False), t)

    def element(m: re.Match) -> str:
        name = m[1].lower().rpartition(":")[2]
        closing = m[0].startswith("</")
        if name in ("h1", "h2", "h3", "h4", "h5", "h6", "title", "p", "div", "sec", "section", "table", "tr", "ul", "ol", "list", "blockquote", "caption", "dl", "article", "abstract", "figure"):
            return "\n" if name in ("tr", "ul", "ol", "list") else "\n\n"
        if name == "br" or name == "hr":
            return "\n"
        if name in ("li", "list-item", "dt", "dd"):
            return "\n" if closing else "\n• "
        if name in ("td", "th"):
            return "\t" if closing else ""
        return ""

    t = _sub(_TAG, lambda m: element(re.match(r"</?([A-Za-z][\w.:-]*)", m[0])), t, flags=int(re.S))
    t = _unescape(t)
    t = _sub(r"``([^`\n]+?)''", r"“\1”", t)
    t = _sub(r"(?m)^\{\|.*$|^\|\}.*$|^\|-.*$", "", t)
    t = _sub(r"(?m)^[|!](?![-}|])[ \t]*(.*)$", lambda m: _sub(r"\s*(?:\|\||!!|\|)\s*", "\t", m[1].rstrip().rstrip("|")), t)
    t = _sub(r"(?m)^\s*:?-{3,}:?(?:[\t|]\s*:?-{3,}:?)*\s*$", "", t)
    before = None
    while t != before:
        before = t
        t = _sub(r"\{\{\s*([^{}|]*)((?:\|[^{}]*)?)\}\}", lambda m: " ".join(re.findall(r"\|\s*title\s*=\s*([^|]*)", m[2])), t)
    t = _sub(r"(?i)\[\[(?:file|image|category):[^\[\]]*\]\]", "", t)
    t = _sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]", r"\1", t)
    t = _sub(r"(?<!\])\[(?:https?|ftp)://[^\s\]]+(?:[ \t]+([^\]\n]+))?\]", lambda m: m[1] or "", t)
    t = _sub(r"(?m)^={2,6}\s*(.*?)\s*={2,6}[ \t]*$", r"\n\1\n", t)
    t = _sub(r"(?<!['`])'{2,5}(?=[^'\s])([^\n]*?[^'\s])'{2,5}(?!')", r"\1", t)
    t = _sub(r"!?\[([^\[\]\n]*)\]\((?:[^()\s]|\([^()\s]*\))+(?:\s+\"[^\"]*\")?\)|\[([^\[\]\n]+)\]\[[^\[\]\n]*[A-Za-z][^\[\]\n]*\]", lambda m: m[1] or m[2] or "", t)
    t = _sub(r"(?m)^ {0,3}\[[^\]\n]+\]:\s+\S+.*$|^ {0,3}(?:-{3,}|\*{3,}|_{3,}|={3,})[ \t]*$", "", t)
    t = _sub(r"<(https?://[^<>\s]+)>", r"\1", t)
    t = _sub(r"(?m)^ {0,3}#{1,6}[ \t]+(.*?)[ \t#]*$", r"\n\1\n", t)
    t = _sub(r"(?m)^ {0,3}>[ \t]?", "", t)
    t = _sub(r"(?m)^[ \t]*[-*+][ \t]+(?=\S)", "• ", t)
    t = _sub(r"(?m)^ {0,3}([0-9]{1,3})[.)][ \t]+(?=\S)", r"• \1: ", t)
    for mark in (r"\*{1,3}", r"_{1,3}", r"~~"):
        t = _sub(rf"(?<![\w*_~\\])({mark})(?=[^\s*_~])([^\n]*?[^\s*_~\\])\1(?![\w*_~])", r"\2", t)
    t = _sub(r"\\begin\{(?:tabular|array|longtable)[*x]?\}(?:\[[^\]]*\])?\s*\{(?:[^{}]|\{[^{}]*\})*\}|\\begin\{[^}]*\}(?:\[[^\]]*\])?|\\end\{[^}]*\}", "\n", t)
    t = _sub(r"\\item\s*(?:\[[^\]]*\])?\s*", "\n• ", t)
    t = _sub(r"\\(?:part|chapter|(?:sub)*section|paragraph|title)\*?\s*\{([^{}]*)\}", r"\n\n\1\n", t)
    t = _sub(r"~?\\(?:cite\w*|ref|eqref|label|pageref|bibliography\w*|usepackage|documentclass)\s*(?:\[[^\]]*\])*\{[^{}]*\}", "", t)
    t = _sub(r"\\([`'^\"~=.cvuHr])\s*\{(\\?[A-Za-z])\}|\\([`'^\"~=.])(\\?[A-Za-z])", lambda m: _accent(re.match(r"(.)\{?(\\?[A-Za-z])", (m[1] or m[3]) + (m[2] or m[4]))), t)
    t = _sub(r"\\footnote\s*\{([^{}]*)\}", r" (\1)", t)
    before = None
    while t != before:
        before = t
        t = _sub(r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1", t)
        t = _sub(r"\\[A-Za-z]+\*?\s*(?:\[[^\]\n]*\])?\{([^{}]*)\}", r"\1", t)
    t = _sub(r"\\([%&$#_{}])", r"\1", t)
    t = _sub(r"\\\\(?=\s|$)", "\n", t)
    t = _sub(rf"\\({_BARE})(?![A-Za-z])", lambda m: SIGNS.get(m[1], ""), t)
    if "latex" in kinds_of(text):
        t = _sub(r"(?<=\w)~(?=[(\w])", " ", t)
    t = _sub(r"(?<=\S)[ \t]{2,}| +\n", lambda m: "\n" if m[0].endswith("\n") else " ", t)
    t = _sub(r"\(see\s*\)", "", t)
    t = _sub(r"\n{3,}", "\n\n", t)
    return _sub("\ue000([0-9]+)\ue001", lambda m: kept[int(m[1])], t.strip()).strip("\n").rstrip()


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        kinds = [kinds_of(t) for t in texts]
        plain = [to_plain(t) if k else t for t, k in zip(texts, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("ident"), pa.array(plain, pa.string()), pa.array(kinds, pa.list_(pa.string()))], names=["ident", "text", "kinds"])


def cleaned(df: DataFrame, ident: str, text: str) -> DataFrame:
    """``ident, text, kinds``: every text as readable plain text with the kinds of markup that were found in it (none: text unchanged).

    Texts without any sign that a construct needs are settled inside the JVM and never reach Python; nothing is shuffled. Null texts stay null;
    empty texts stay empty; repeated rows give one row each; an empty table gives no rows; other columns are ignored.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    schema = rows.select("ident", "text", F.array().cast("array<string>").alias("kinds")).schema
    holds = F.coalesce(F.col("text").rlike(MAY_HOLD), F.lit(False))
    return rows.where(holds).mapInArrow(_parse, schema).unionByName(rows.where(~holds).withColumn("kinds", F.array().cast("array<string>")))


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of the lines of both; blank lines never count. Work follows the number of equal pairs, not the product of the lengths."""
    where: dict[str, list[int]] = {}
    for k, line in enumerate(b):
        if line.strip():
            where.setdefault(line, []).append(k)
    tails: list[int] = []
    ends: list[tuple] = []
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(tails, j)
            link = (i, ends[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                ends.append(link)
            else:
                tails[k], ends[k] = j, link
    out, at = [], ends[-1] if ends else None
    while at:
        out.append(at[0])
        at = at[1]
    return out[::-1]


def differenced(df: DataFrame, ident: str, url: str, text: str) -> DataFrame:
    """``ident, text, shared``: every page without the lines that it shares with the page of the nearest address of its host, before or behind it, and how many lines that were.

    Pages are sorted by host and path over range partitions, so a host that holds a third of all pages is spread over many tasks; each task streams its rows and remembers one. What
    crosses a boundary is the first and last page of each partition, no more than two for each. Pages without an address, or alone on their host, stay whole; null
    texts stay null; repeated rows give one row each and differ from each other in nothing, so they end empty; an empty table gives no rows.
    """
    parts = F.regexp_extract(F.col(url), "^[a-zA-Z]+://([^/?#]+)", 1)
    pages = df.select(F.col(ident).cast("long").alias("ident"), F.lower(parts).alias("host"), F.col(url).alias("url"), F.col(text).alias("text"))
    schema = "ident long, text string, shared int"
    ship(df.sparkSession)
    order = ["host", "url", "ident", "text"]
    sorted_pages = cut(pages.where("host <> '' AND text IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order))
    edges = sorted_pages.withColumn("part", F.spark_partition_id()).mapInArrow(_first_and_last, "part int, last boolean, host string, text string").collect()
    first, last = ({r.part: (r.host, r.text) for r in edges if r.last == side} for side in (False, True))
    known = sorted(first)
    before = {p: last[q] for q, p in zip(known, known[1:])}
    behind = {p: first[q] for p, q in zip(known, known[1:])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        previous, held = before.get(number), None

        def done(row, following):
            lines = row[2].split("\n")
            gone = {k for other in (previous, following) if other and other[0] == row[1] for k in common_lines(lines, other[1].split("\n"))}
            return row[0], "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)

        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("ident", "host", "text"))):
                if held:
                    out.append(done(held, row[1:]))
                    previous = held[1:]
                held = row
            if out:
                yield _batch(out)
        if held:
            yield _batch([done(held, behind.get(number))])

    rest = pages.where("host IS NULL OR host = '' OR text IS NULL").select("ident", "text", F.lit(0).alias("shared"))
    return sorted_pages.mapInArrow(run, schema).unionByName(rest)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, texts, shared = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(shared, pa.int32())], names=["ident", "text", "shared"])


def _first_and_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last page of a partition."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            slim = batch.select(["part", "host", "text"])
            first, last = first or slim.slice(0, 1), slim.slice(slim.num_rows - 1, 1)
    if first is not None:
        for side, one in ((False, first), (True, last)):
            yield pa.RecordBatch.from_arrays([one.column(0), pa.array([side]), one.column(1), one.column(2)], names=["part", "last", "host", "text"])


def with_markup(df: DataFrame, ident: str, text: str) -> DataFrame:
    """``ident`` of every text in which the converter found markup."""
    return cleaned(df.where(F.col(text).rlike(MAY_HOLD)), ident, text).where("size(kinds) > 0").select("ident").distinct()
