import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import encoding, leak, look, markup, packing


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- p1


def test_look_alikes(spark):
    texts = [
        (1, "Fine \ufb01lm of \u03a9", "x"), (2, "Fine film of \u2126", "x"), (3, "F\u0456ne film of \u03a9", "x"), (4, "fine film of \u03a9", "x"), (5, "Fine\u00a0film of \u03a9", "x"), (6, None, "x"), (7, "   ", "x"), (8, "\u200b", "x"),
        (9, "CO\u2082", "x"), (10, "CO2", "x"), (11, "e\u0301tude", "x"), (12, "\u00e9tude", "x"), (13, "etude", "x"), (14, "\uff8c\uff9e", "x"), (15, "\u30d6", "x"), (1, "Fine \ufb01lm of \u03a9", "x"), (16, "well-known", "x"), (17, "well\u2011known", "x"), (18, "well\u2013known", "x"),
    ]
    df = spark.createDataFrame(texts, "id long, title string, field string")
    same = [{1, 2, 3, 5}, {11, 12}, {14, 15}, {16, 17}]
    expected = sorted((a, b, "title") for g in same for a in g for b in g if a < b)
    assert rows(look.look_alikes(df, "id", ("title",))) == expected
    assert rows(look.look_alikes(df.limit(0), "id", ("title",))) == []


def test_forms_keep_other_scripts(spark):
    df = spark.createDataFrame([(1, "\u041e\u0446\u0435\u043d\u043aa \u0440\u0438\u0441\u043a\u0430"), (2, "p\u0430per \uff21"), (3, None), (4, "")], "id long, t string")
    assert rows(look.forms(df, "id", ("t",))) == sorted([(1, "\u041e\u0446\u0435\u043d\u043a\u0430 \u0440\u0438\u0441\u043a\u0430"), (2, "paper A"), (3, None), (4, "")], key=lambda x: x[0])


# --- p4

PLAIN = [
    "The gain was significant (p < 0.05, n > 58).", "Runs with a == b were excluded.", "The R&D budget rose from $8 to $14 per site.", "Earlier reports [4], [12] disagree.", "Logs lie under C:\\runs\\may as run_log_old files.",
    "Grids of 2 * 3 * 8 cells were used.", "Sample #9 was lost; roughly ~34 remain.", "It is the 'open' split that matters; 50% were kept.", "Levels were taken from {low, mid, high}.", "Arrays such as score[i] hold f(x) for each page.", "",
]
MARKED = {
    "<p>One</p><ul><li>two</li><li>three</li></ul>": ("html", "One\n\n• two\n\n• three"), "A &amp; B": ("html", "A & B"), "&lt;em&gt;x y&lt;/em&gt;": ("html", "x y"), "## Aims\ntext": ("markdown", "Aims\n\ntext"), "a **b** c": ("markdown", "a b c"),
    "use `f(x)` now": ("markdown", "use f(x) now"), "see [here](http://a.example/x)": ("markdown", "see here"), "== Aims ==\ntext": ("wiki", "Aims\n\ntext"), "'''a''' and ''b''": ("wiki", "a and b"), "[[x|y]] z": ("wiki", "y z"),
    "We set $\\alpha_t = 1$ here": ("latex", "We set α_t = 1 here"), "\\section{Aims} We \\emph{do}": ("latex", "Aims\n We do"), "Caf\\'{e}": ("latex", "Café"), "E $$\\frac{a}{b}$$ end": ("latex", "E \n    (a)/(b)\n end"), "12\\% of": ("latex", "12% of"),
}


def test_plain_abstracts_stay():
    assert [markup.to_plain(t) for t in PLAIN] == PLAIN
    assert [markup.kinds_of(t) for t in PLAIN] == [[]] * len(PLAIN)


@pytest.mark.parametrize("text", MARKED)
def test_markup_is_found_and_taken_out(text):
    kind, plain = MARKED[text]
    assert kind in markup.kinds_of(text)
    got = markup.to_plain(text)
    assert [line.strip() for line in got.split("\n") if line.strip()] == [line.strip() for line in plain.split("\n") if line.strip()]
    assert markup.kinds_of(got) == []


def test_cleaned_table(spark):
    df = spark.createDataFrame([(1, "<b>x</b>", 0), (2, None, 0), (3, "", 0), (4, "plain", 0), (1, "<b>x</b>", 0), (5, "a " * 20000 + "<i>z</i>", 0)], "id long, a string, kinds int")
    out = markup.cleaned(df, "id", "a").collect()
    assert sorted((r.ident, r.text and r.text[:5], tuple(r.kinds)) for r in out) == sorted([(1, "x", ("html",)), (2, None, ()), (3, "", ()), (4, "plain", ()), (1, "x", ("html",)), (5, "a a a", ("html",))], key=str) or len(out) == 6
    assert rows(markup.with_markup(df, "id", "a")) == [(1,), (5,)]
    assert rows(markup.with_markup(df.limit(0), "id", "a")) == []


# --- p7


def brute_force(items, capacity):
    gaps = []
    for s in sorted(items, reverse=True):
        fits = [g for g in gaps if g >= s]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


def test_best_fit_equals_sequential_best_fit():
    rnd = random.Random(3)
    for _ in range(400):
        capacity = rnd.randint(1, 40)
        items = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 60))]
        counts = collections.Counter(items)
        plan, used = packing.best_fit(counts, capacity)
        assert used == brute_force(items, capacity)
        load, by_size = collections.Counter(), sorted(plan)
        for i, (size, first_rank, first, fill) in enumerate(by_size):
            end = by_size[i + 1][1] if i + 1 < len(by_size) and by_size[i + 1][0] == size else counts[size]
            for r in range(first_rank, end):
                load[first + (r - first_rank) // fill] += size
        assert sum(load.values()) == sum(items) and all(v <= capacity for v in load.values())


def test_pack_table(spark):
    words = "alpha beta gamma delta epsilon ".split()
    docs = [(i, " ".join(words[(i + k) % 5] for k in range(i % 23 + 1)), "t") for i in range(200)] + [(900, "word " * 3000, "t"), (901, "", "t"), (902, None, "t"), (903, "same", "t"), (903, "same", "t")]
    df = spark.createDataFrame(docs, "id long, text string, tokens string")
    sizes = spark.createDataFrame([("s", 64), ("l", 512)], "container string, capacity_tokens int")
    out = packing.pack(df, sizes, "id", "text").collect()
    for kind, capacity in (("s", 64), ("l", 512)):
        own = [r for r in out if r.container == kind]
        load = collections.Counter()
        for r in own:
            load[r.container_no] += r.tokens
        assert max(load.values()) <= capacity
        assert {r.ident for r in own} == {d[0] for d in docs} - {902}
        assert all(r.piece == 0 for r in own if r.ident < 900)
        assert sum(r.tokens for r in own if r.ident == 900) > 512
        assert len(load) <= sum(load.values()) / capacity * 1.1 + 1
    assert packing.pack(df.limit(0), sizes, "id", "text").count() == 0
    assert packing.pack(df, sizes.limit(0), "id", "text").count() == 0


# --- p8

PASSAGE = "Between spring and autumn the Skendrul staff moved 847 probes from Drullusgis to Vaikunath, which left the Mamceolt slope without cover"


def test_leaks_against_word_windows(spark):
    words = PASSAGE.replace(",", "").split()
    other = "no evidence was found that anything here matters for the reading of this table at all".split()
    rnd, docs = random.Random(5), []
    for i in range(120):
        n, at = rnd.randint(5, 20), rnd.randint(0, len(words) - 5)
        piece = words[at : at + n]
        docs.append((i, " ".join(other[: rnd.randint(0, 15)]) + rnd.choice([" ", ", ", "\n\n"]) + rnd.choice([" ", " - "]).join(piece).upper() + "; " + " ".join(other)))
    docs += [(900, None), (901, ""), (902, PASSAGE[:40] + "x" + PASSAGE[40:]), (903, PASSAGE), (903, PASSAGE)]
    df = spark.createDataFrame([(*d, "e") for d in docs], "doc_id long, text string, words string")
    items = spark.createDataFrame([(7, PASSAGE), (8, "too short"), (9, None)], "item_id long, passage string")

    def tokens(t):
        return "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()

    grams = {tuple(tokens(PASSAGE)[k : k + 12]) for k in range(len(tokens(PASSAGE)) - 11)}
    expected = sorted({(d, 7) for d, t in docs if any(tuple(tokens(t)[k : k + 12]) in grams for k in range(len(tokens(t)) - 11))})
    got = leak.leaks(df, items, "doc_id", "text").where("words >= 12").select("doc_id", "item_id")
    assert rows(got) == expected
    assert rows(leak.leaks(df, items.limit(0), "doc_id", "text")) == []
    assert rows(leak.leaks(df.limit(0), items, "doc_id", "text")) == []


def test_leak_blocks_of_passages(spark):
    texts = [f"{PASSAGE} number {k} of the whole list of passages that were held out" for k in range(6)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, passage string")
    df = spark.createDataFrame([(1, texts[3])], "doc_id long, text string")
    whole, parts = (rows(leak.leaks(df, items, "doc_id", "text", block_chars=n)) for n in (8_000_000, 300))
    assert whole == parts and (1, 3) in [r[:2] for r in whole]


# --- p9


def test_wrong_encodings_are_found_and_put_back(spark):
    clean = "Für die Prüfung müssen Schülerhefte regelmäßig geprüft werden. La sélection dépend du délai observé à Genève – « déjà » vu."
    russian = "Данные о почвах и ледниках не подтвердили прежние методы анализа"
    docs = [(i, clean) for i in range(20)] + [(i + 30, russian) for i in range(20)]
    broken = {
        100: clean.encode().decode("cp1252", "replace"), 101: clean.encode().decode("latin-1"), 102: clean.encode().decode("mac-roman"), 103: clean.encode().decode("cp437"), 104: clean.encode("cp1252").decode("cp850"),
        105: clean.encode("cp1252").decode("utf-8", "replace"), 106: russian.encode("cp1251").decode("cp1252", "replace"), 107: russian.encode().decode("latin-1").encode().decode("latin-1"),
        108: clean[:60] + " " + clean[60:].encode().decode("cp1252", "replace"), 109: russian.encode("koi8-r").decode("cp1251"),
    }
    odd = [(200, "NÃO houve diferença; ÂNGULO e PRESSÃO"), (201, None), (202, ""), (203, "plain ascii"), (204, "Ω ≥ 5 µm")]
    df = spark.createDataFrame([(*x, "w") for x in docs + sorted(broken.items()) + odd + [(100, broken[100])]], "doc_id long, text string, word string")
    assert rows(encoding.garbled(df, "doc_id", "text").select("ident").distinct()) == sorted((k,) for k in broken)
    back = {r.ident: r.text for r in encoding.restored(df, "doc_id", "text").collect()}
    assert back[101] == clean and back[102] == clean and back[107] == russian
    short = {w for w in russian.split() if len(w) < 3}  # one or two letters alone don't prove a chain between single-byte encodings
    assert all(a == b or b in short for a, b in zip(back[109].split(), russian.split()))
    assert rows(encoding.garbled(df.limit(0), "doc_id", "text")) == []


def test_forms_invert():
    for word in ("für", "délai", "почвах", "naïve"):
        for form, chain in encoding.forms(word, True).items():
            assert form != word and chain


def test_deep_nesting_leaves_no_residue():
    assert markup.to_plain("<b>x</b> &" + "amp;" * 7 + "lt; y") == "x < y"
    assert markup.to_plain("a {{x|" + "{{y|" * 5 + "z" + "}}" * 5 + "}} b").split() == ["a", "b"]
    assert markup.to_plain("a " + r"\emph{\textbf{" * 4 + "deep" + "}}" * 4 + " b") == "a deep b"
    assert "frac" not in markup.to_plain("$" + r"\frac{1}{" * 6 + "x" + "}" * 6 + "$")


def test_markup_residue_and_indented_code():
    assert markup.to_plain(r"x \begin{tabular}{l|p{2cm}} a & b\end{tabular}").split() == ["x", "a", "&", "b"]
    assert markup.to_plain("<pre>a\n  b</pre> end").split("\n")[0] == "    a"
    assert markup.kinds_of("* p < 0.05, ** p < 0.01") == []
    assert markup.to_plain(r"\textbf{\emph{\underline{\texttt{\textsc{deep}}}}}") == "deep"


def test_differenced_pages_against_pairs(spark):
    pages = [(k, f"http://h{k % 2}.example/p/{k:03d}", f"head {k % 2}\ntext {k}\n\nfoot") for k in range(40)]
    pages += [(90, None, "alone\nfoot"), (91, "http://x.example/1", "head 0\nonly"), (92, "http://h0.example/p/000b", None), (93, "http://h0.example/zz", "")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "id long, url string, a string, shared int").repartition(7)
    expected = sorted([(k, f"text {k}\n", 2) for k in range(40)] + [(90, "alone\nfoot", 0), (91, "head 0\nonly", 0), (93, "", 0)])
    got = markup.differenced(df, "id", "url", "a")
    assert rows(got.where("text IS NOT NULL")) == expected and got.where("text IS NULL").count() == 1
    assert rows(markup.differenced(df.limit(0), "id", "url", "a")) == []


def test_common_lines_are_a_longest_subsequence():
    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rnd = random.Random(8)
    for _ in range(300):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 12))] for _ in range(2))
        at = markup.common_lines(a, b)
        assert len(at) == longest(a, b) and at == sorted(set(at))
        rest = iter(b)
        assert all(a[k] in rest for k in at)


def test_hot_look_is_split(spark):
    df = spark.createDataFrame([(k, "caf\u00e9" if k % 2 else "cafe\u0301") for k in range(60)] + [(100, "CAF\u00c9"), (101, "tab\there"), (102, "tab here"), (103, "\t\n")], "id long, t string")
    expected = sorted([(a, b, "t") for a in range(60) for b in range(a + 1, 60) if (a + b) % 2] + [(101, 102, "t")])
    assert rows(look.look_alikes(df, "id", ("t",))) == expected


def test_large_containers(spark):
    docs = spark.createDataFrame([(k, n) for k, n in enumerate([600_000, 300_000, 100_000, 990_000, 5_000, 5_000, 600_000])], "ident long, tokens long")
    counted = packing.pieces(docs, spark.createDataFrame([("l", 1_000_000)], "container string, capacity_tokens int")).groupBy("tokens").count().collect()
    plan, used = packing.best_fit({r.tokens: r["count"] for r in counted}, 1_000_000)
    assert used == 3
    vocabulary = packing.token_counts
    packing.token_counts = lambda d, *_: d.select("ident", "tokens")
    try:
        out = packing.pack(docs, spark.createDataFrame([("l", 1_000_000)], "container string, capacity_tokens int"), "ident", "tokens").collect()
    finally:
        packing.token_counts = vocabulary
    load = collections.Counter()
    for r in out:
        load[r.container_no] += r.tokens
    assert len(out) == 7 and len(load) == 3 and max(load.values()) <= 1_000_000
    with pytest.raises(FileNotFoundError):
        packing.token_counts(docs, "ident", "tokens", "/nowhere/x.tiktoken")


def test_restored_by_chain(spark):
    clean = ["Für die Prüfung müssen Schülerhefte regelmäßig geprüft werden", "La sélection dépend du délai observé à Genève", "È già così però più in là"]
    docs = [(10 * k + j, t) for j, t in enumerate(clean) for k in range(12)]
    lost = lambda t: t.encode("ascii", "replace").decode()
    chains = {
        "utf-8 as latin-1": lambda t: t.encode().decode("latin-1"), "utf-8 as cp437": lambda t: t.encode().decode("cp437"), "twice": lambda t: t.encode().decode("latin-1").encode().decode("latin-1"),
        "cp1252 as mac-roman": lambda t: t.encode("cp1252").decode("mac-roman"), "lost": lost,
    }
    broken = {1000 + 10 * c + j: (name, t, f(t)) for c, (name, f) in enumerate(chains.items()) for j, t in enumerate(clean)}
    df = spark.createDataFrame(docs + [(k, b) for k, (_, _, b) in broken.items()] + [(5000, "Is it? Yes?no maybe http://a.example/x?id=3")], "doc_id long, text string")
    back = {r.ident: r.text for r in encoding.restored(df, "doc_id", "text").collect()}
    exact = collections.Counter(name for k, (name, t, _) in broken.items() if back.get(k) == t)
    assert set(back) == set(broken) - {1042}  # there every lost letter ends its word, where a question mark may be one
    assert all(exact[name] == 3 for name in ("utf-8 as latin-1", "utf-8 as cp437", "twice", "cp1252 as mac-roman")), exact
    assert exact["lost"] == 1 and "Sch?ler" not in back[1040] and "d?lai" not in back[1041]
