import datetime as dt
import random
import re
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import match, survivor, titles, topn
from plumbline.plans import lineage


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- p3


def key_of(title):
    parts = [re.sub(r"[\W_]+", "", p.lower()) for p in re.split(r"\s[|/·]\s", title or "")]
    return tuple(sorted(p for p in parts if p))


def test_title_copies_against_brute_force(spark):
    rnd, base = random.Random(2), ["On kelp forests", "A B", "Deep-sea vents", "x", "--"]
    data = []
    for i in range(300):
        t = rnd.choice(base)
        t = rnd.choice([t, t.upper(), f"{t} | 2016", f"2016 / {t}", f" {t}!", t.replace(" ", "  ")])
        data.append((i, t, "k"))
    data += [(900, None, "k"), (901, "", "k"), (902, " | ", "k"), (5, data[5][1], "k")]
    df = spark.createDataFrame(data, "cand_id long, title string, key string")
    groups = {}
    for i, t, _ in data:
        if key_of(t):
            groups.setdefault(key_of(t), set()).add(i)
    expected = sorted((min(g), i) for g in groups.values() for i in g if i != min(g))
    assert rows(titles.copies_of(df, "cand_id", "title")) == expected
    for share in (0.0001, 1000.0):  # all keys hot, none hot
        hot = titles.hot_keys(titles.keyed(df, "cand_id", "title"), share)
        assert (hot.count() > 0) == (share < 1)
    assert titles.collapse(df, "cand_id", "title").count() == len(groups)
    assert rows(titles.copies_of(df.limit(0), "cand_id", "title")) == []


# --- p5


def test_survivors(spark):
    t = dt.datetime(2024, 1, 1)
    late = dt.datetime(2024, 2, 1)
    schema = "paper_id long, key string, title string, abstract string, pdf_urls array<string>, retrieval_sources array<string>, updated_at timestamp, worth string"
    data = [
        (1, "k", "A title", "long enough text", ["u", "u"], ["good"], t, "w"), (2, "k", "Untitled", "No abstract available.", ["u", None, " ", "v"], ["bad", "good"], None, "w"), (3, "k", "Other", "  short  ", [], None, late, "w"),
        (4, "j", None, "N/A", None, [], t, "w"), (5, "j", "  ", "-", [None], [""], t, "w"), (6, "single", "T", "A", ["u"], ["good"], t, "w"), (7, "tie", "T", "ab", ["x"], ["good"], t, "w"), (8, "tie", "U", "cd", ["y"], ["good"], t, "w"), (9, "tie", "V", "ef", ["z"], ["good"], None, "w"),
        (8, "tie", "U", "cd", ["y"], ["good"], t, "w"), (10, None, "T", "A", ["u"], ["good"], t, "w"),
    ]
    trust = spark.createDataFrame([("good", 90), ("bad", 10)], "source string, trust int")
    df = spark.createDataFrame(data, schema)
    expected = sorted([("k", "title", 1), ("k", "abstract", 1), ("k", "pdf_urls", 2), ("k", "retrieval_sources", 2), ("tie", "title", 7), ("tie", "abstract", 7), ("tie", "pdf_urls", 7), ("tie", "retrieval_sources", 7)])
    assert rows(survivor.survivors(df, trust)) == expected
    many = trust.unionByName(spark.createDataFrame([(f"s{k}", 99) for k in range(1001)] + [("neg", -5)], "source string, trust int"))
    more = spark.createDataFrame([(11, "m", "T", None, None, [None, "neg"], None, None), (12, "m", "T", None, None, ["s1000", "x"], None, None), (12, "n", "T", None, None, ["x"], None, None), (13, "m", "T", None, None, None, None, None)], schema)
    assert rows(survivor.with_trust(df.unionByName(more), many).where("paper_id > 10").select("paper_id", "key", "_trust")) == [(11, "m", -5), (12, "m", 99), (12, "n", 0), (13, "m", 0)]
    assert rows(survivor.survivors(df.limit(0), trust)) == []
    assert len(rows(survivor.survivors(df, trust.limit(0)))) == 8


def test_order_of_states_is_learned_from_timestamped_rows(spark):
    schema = "paper_id long, key string, title string, abstract string, pdf_urls array<string>, retrieval_sources array<string>, updated_at timestamp"
    day = lambda k: dt.datetime(2024, 1, k)
    data = [(10 * k + j, f"k{k}", t, None, None, ["good"], day(1 + j)) for k in range(20) for j, t in enumerate(["A TITLE CUT...", "A TITLE", "A title"])]
    data += [(900, "u", "B TITLE", None, None, ["good"], day(1)), (901, "u", "B title", None, None, ["good"], None), (902, "u", "B tit...", None, None, ["good"], None)]
    data += [(910, "v", "C title", None, None, ["good"], day(1)), (911, "v", "C TITLE", None, None, ["good"], None), (920, "w", "D tit...", None, None, ["good"], None), (921, "w", "D title", None, None, ["good"], None)]
    df, trust = spark.createDataFrame(data, schema), spark.createDataFrame([("good", 90)], "source string, trust int")
    learned = survivor.precedence(survivor.transitions(df)["title"])
    assert learned == {"cut": {"shouted", "whole"}, "shouted": {"whole"}}
    of = lambda found: {r.key: r.paper_id for r in found.where("field = 'title' AND key < 'x' AND key > 'kz'").collect()}
    assert of(survivor.current(df, trust)) == {"u": 901, "v": 910, "w": 921}
    assert of(survivor.survivors(df, trust)) == {"u": 900, "v": 910, "w": 920}
    assert survivor.current(df.limit(0), trust).count() == 0


def test_precedence_has_no_circle():
    later = survivor.precedence({("a", "b"): 90, ("b", "c"): 80, ("c", "a"): 70, ("a", "d"): 3, ("d", "a"): 2})
    assert later == {"a": {"b", "c"}, "b": {"c"}}


# --- p6


def test_top_n_against_sort(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["a", "b", "c", None]), i % 70, rnd.choice([0.5, 0.7, float("nan"), None, 0.9]), rnd.choice([1, 2, None]), 0) for i in range(200)]
    once = {}
    for g, i, s, r, _ in data:
        once.setdefault(i, (g, i, s, r, 0))
    data = list(once.values()) * 2  # every record twice
    df = spark.createDataFrame(data, "query string, record_id long, sim double, rank int, ident int").repartition(5)
    expected = []
    for g in ("a", "b", "c"):
        own = sorted({(-s, r is None, r or 0, i) for q, i, s, r, _ in data if q == g and s is not None and s == s})
        expected += [(g, i) for *_, i in own[:5]]
    got = topn.top_n(df, "query", "sim", "rank", "record_id", 5).select("grp", "ident")
    assert rows(got) == sorted(expected)
    assert rows(topn.top_n(df.limit(0), "query", "sim", "rank", "record_id", 5)) == []


# --- p2

WORKS = ["Weighted term weighting across lichen transects after sudden shifts, Evidence from Norkhan", "Revisiting layered entity linking for moth traps in steep terrain at Zailgis", "Robust patch matching for kelp forests under low light: The Bilhind Study", "Sparse beam search of salt marshes in dense fog with the Culbiam Archive"]


def _tables(spark):
    a = [
        (1, WORKS[0], None, None), (2, WORKS[0].upper() + ".", None, None), (3, "Weighted term weighting across transects after sudden shifts, Evidence from Norkhan", None, None), (4, "Comment on: " + WORKS[0], None, None), (5, None, "10.1234/xyz.2010.555", None),
        (6, "Rcvisiting 1aycred entity 1inking for rnoth traps in stccp tcrrain at Zai1gis", None, None), (7, WORKS[2] + ", 2", None, None), (8, "[Preprint] " + WORKS[2], None, None), (9, "", None, None), (10, None, None, None), (11, WORKS[3].replace(" ", "", 4), None, None), (1, WORKS[0], None, None),
    ]
    b = [(501, WORKS[0] + " | Some Review | 2012", None, None), (502, "RETRACTED: " + WORKS[1], "doi:10.1234/XYZ.2010.555", None), (503, WORKS[2], None, None), (504, WORKS[3] + " (extended version)", None, None), (505, None, None, None), (506, "Reply to the comment on: " + WORKS[1], None, None)]
    schema = "id long, title string, doi string, url string"
    return spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


def test_matches(spark):
    a, b = _tables(spark)
    got = match.matches(match.records(a, "id", "title", "doi", ("url",)), match.records(b, "id", "title", "doi", ("url",)))
    pairs = {(r.ident_a, r.ident_b): r.confidence for r in got.collect()}
    assert set(pairs) == {(1, 501), (2, 501), (3, 501), (5, 502), (6, 502), (8, 503), (11, 504)}
    assert all(0 < c <= 1 for c in pairs.values()) and pairs[3, 501] < 1
    nothing = match.records(a.limit(0), "id", "title", "doi", ("url",))
    assert match.matches(nothing, match.records(b, "id", "title", "doi", ("url",))).count() == 0


def test_doi_keys(spark):
    df = spark.createDataFrame([("doi:10.99/abc.2001.77",), ("https://doi.example/10.9912%2Fabc.2001.77",), ("10. 9912/abc.2001.77.pdf",), ("10.9912/ABC.2001.77?src=rss",), ("abc.2001.77",), (None,), ("",)], "doi string")
    keys = [r[0] for r in df.select(match.doi_key(df.doi)).collect()]
    assert keys == ["abc.2001.77"] * 5 + [None, None]


def _found(spark, cited, described):
    """Pairs of cited and described titles; an entry is a title, or a title and a DOI."""
    schema = "id long, title string, doi string, url string"
    make = lambda entries, start: match.records(spark.createDataFrame([(start + k, *(e if isinstance(e, tuple) else (e, None)), None) for k, e in enumerate(entries)], schema), "id", "title", "doi", ("url",))
    return {(r.ident_a, r.ident_b - 500) for r in match.matches(make(cited, 0), make(described, 500)).collect()}


def test_abbreviated_words_are_candidates(spark):
    tail = ["kelp forests", "moth traps", "salt marshes", "dune fields", "tree rings", "bat calls", "reef mosaics", "grain silos", "dust plumes"]
    described = [f"Streaming boundary detection for {t} in steep terrain at Zailgis" for t in tail] + [f"Layered density estimation for {t} in steep terrain at Zailgis" for t in tail]
    cited = ["Streaming boundary detect. for kelp forests in steep terrain at Zailgis", "Layered density est. f. moth traps in steep terrain at Zailgis", "Streaming boundary detect. for bat calls in stp terrain at Zailgis"]
    assert _found(spark, cited, described) == {(0, 0), (1, 10), (2, 5)}


def _classes(spark, titles):
    """Title classes of spelled-right titles, as ``title_classes`` gives them."""
    df = spark.createDataFrame([(k, t.split()) for k, t in enumerate(titles)], "letters long, words array<string>")
    return df.withColumn("work", match._key(df.words))


def test_frequencies_at_hand_and_by_join(spark, monkeypatch):
    """Titles of a vocabulary that fits at hand are those of the join, and so are the index and the lists asked for; repeated words, other orders and words that set a work apart among them."""
    words = [f"w{k}x" for k in range(40)] + ["part", "ii", "comment", "straße"]
    titles = [" ".join(words[(7 * k + j * j) % len(words)] for j in range(k % 13)) for k in range(150)]
    classes = _classes(spark, [*titles, *(" ".join(t.split()[::-1]) for t in titles[:20]), *titles[:9]])
    found = []
    for small in (200_000, 0):
        monkeypatch.setattr(match, "SMALL_VOCABULARY", small)
        weighed, df = match.weighed(classes)
        found.append([sorted(map(str, rows.collect())) for rows in (weighed, df, match.postings(weighed).drop("total"), match._asked(weighed, df).distinct())])
    assert all(found[0]) and found[0] == found[1]


def test_index_entries_hash_as_spark_does(spark):
    numbers = [0, 1, -1, 2**62, -(2**63)]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long").select(F.xxhash64("n").alias("one"), F.xxhash64("n", F.lit(7).cast("long")).alias("two")).collect()
    one = match.hashed(np.array(numbers))
    assert one.view(np.int64).tolist() == [r.one for r in rows]
    assert match.hashed(np.full(len(numbers), 7), match.hashed(np.array(numbers))).view(np.int64).tolist() == [r.two for r in rows]


def test_matches_leaves_no_tables(spark):
    a, b = _tables(spark)
    lineage.ensure_checkpoint_dir(spark)
    kept = lambda: set(Path(lineage._folder(spark).removeprefix("file:")).glob("*"))
    before = kept()
    assert match.matches(match.records(a, "id", "title", "doi", ("url",)), match.records(b, "id", "title", "doi", ("url",))).count() == 7
    assert kept() == before


def _offers(spark, titles):
    classes = _classes(spark, titles)
    ident = {r.work: r.letters for r in classes.collect()}
    return {(ident[r.work], ident[r.parent]) for r in match.parents(classes).collect() if r.gap > 0.5}


def test_words_are_unread_by_their_title_not_by_their_count(spark):
    described = [f"streaming boundary linking {t}{u} steep terrain zailgis" for t in "kelp moth salt dune tree".split() for u in "qa rb sc td ue vf wg xh".split()]
    twice = ["streaming boundary xqxqxq kelpqa steep terrain zailgis", "streaming boundary xqxqxq mothrb steep terrain zailgis"]
    assert _offers(spark, described + twice) == {(40, 0), (41, 9)}


def test_short_titles(spark):
    whole = ["kelp forests steep terrain zailgis archive evidence", "moth traps dense fog culbiam archive study", "moth ponds dense fog culbiam archive study"]
    assert _offers(spark, [*whole, "kelp forests", "moth", "moth traps dense"]) == {(3, 0), (5, 1)}
    cited = ["Moth traps", (None, "10.1234/xyz.2010.555"), ("Dune fields", "10.1234/xyz.2010.777")]
    assert _found(spark, cited, ["Moth traps!", (None, "doi:10.1234/XYZ.2010.555"), ("Bat calls", "10.1234/xyz.2010.777"), "Tree rings"]) == {(0, 0), (1, 1), (2, 2)}


def test_spelling_sees_every_word_of_a_form(spark):
    words = spark.createDataFrame([("form", 1), ("forum", 9), ("forms", 8), ("tree", 1), ("trees", 40), ("treed", 9)], "word string, n long")
    assert {r.word: r.right for r in match.spelling(words).collect()}["form"] == ""
    assert {r.word: r.right for r in match.spelling(words).collect()}["tree"] == "trees"


def test_chains_of_parents_end_at_their_last(spark):
    links = spark.createDataFrame([(1, 2, 0.5), (2, 3, 0.5), (3, 4, 1.0), (7, 8, 1.0), (8, 7, 1.0), (9, 8, 0.5)], "work long, parent long, confidence double")
    assert {(r.work, r.parent, r.confidence) for r in match.ends(links).collect()} == {(1, 4, 0.25), (2, 4, 0.5), (3, 4, 1.0), (8, 7, 1.0), (9, 7, 0.5)}


def test_marks_far_behind_a_beginning_bar_it(spark):
    long = " ".join(f"w{k}x" for k in range(160))
    assert _offers(spark, [long + " rcply end", long.split(" w40x")[0]]) == set()
    assert _offers(spark, [long + " end", long.split(" w40x")[0]]) == {(1, 0)}


def test_two_words_may_differ(spark):
    described = [f"Streaming {m} detection for {t} in steep terrain at {p}" for m in ("boundary", "anomaly", "outlier") for t in ("kelp forests", "moth traps", "salt marshes", "dune fields") for p in ("Zailgis", "Culbiam")]
    cited = ["Streaming detection for kelp in steep terrain at Zailgis", "Streaming boumbary detection for moth traps in stuup terrain at Culbiam", "Streaming boundary for salt marshes in terrain at Zailgis", "Streaming harvest detection for moth pigeons in steep terrain at Culbiam", described[7]]
    assert _found(spark, cited, described) == {(1, 3), (2, 4), (4, 7)}
