"""Text decoded with the wrong encoding: garbled forms of clean corpus words, hash-joined with the tokens of the documents."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.lineage import cut, saved
from plumbline.plans.shipping import ship

#: Encodings that text is wrongly read with, and single-byte encodings that text is wrongly read from.
READ_AS = ("cp1252", "latin-1", "iso8859-15", "mac-roman", "cp437", "cp850", "cp1250", "cp1251", "koi8-r", "cp866")
WRITTEN_AS = ("cp1252", "mac-roman", "cp1251", "koi8-r", "cp866")

#: A token: a run without ASCII white space that holds a character beyond ASCII, or a question mark before a letter; ASCII punctuation at its ends is cut off.
_PLAIN = r"[\x00-\x08\x0E-\x1F!->@-\x7F]*+"
TOKEN = rf"(?<!\S){_PLAIN}(?:\?(?!\p{{L}}){_PLAIN})*+(?:[^\x00-\x7F]|\?(?=\p{{L}}))\S*"
_LEAD, _TAIL = r"""^(?:(?!\?\p{L})[!-/:-@\[-`{-~])+""", r"""[!-/:-@\[-`{-~]+$"""
_ENDS = f"{_LEAD}|{_TAIL}"
_PIECE = regex.compile(r"[^\x00-\x7F]+")
_ONE_BYTE = regex.compile(rf"^(?:{'|'.join(WRITTEN_AS)})>(?!utf-8|ascii)[^>]+$")
_LETTERS = {"LATIN", "GREEK", "CYRILLIC"}


@lru_cache(maxsize=1)
def _decoders() -> dict[str, list[str]]:
    """For each encoding the character of each byte; a byte that it lacks stays a control character, as lenient decoders have it."""
    return {name: [bytes([b]).decode(name, "ignore") or chr(b) for b in range(256)] for name in READ_AS}


def _read(raw: bytes, name: str) -> str:
    table = _decoders()[name]
    return "".join([table[b] for b in raw])


@lru_cache(maxsize=4096)
def _script(c: str) -> str:
    return unicodedata.name(c, "").split(" ")[0] if c.isalpha() else ""


def is_plausible(word: str) -> bool:
    """Whether letters are of one script, capitals come only first or throughout, no symbol stands between letters, and no opening quote or degree sign follows one."""
    letters = [c for c in word if c.isalpha()]
    scripts = {_script(c) for c in letters} & _LETTERS
    if len(scripts) > 1 or any("\x80" <= c <= "\x9f" or c == "�" for c in word):
        return False
    if any(a.islower() and b.isupper() for a, b in zip(letters, letters[1:])):
        return False
    if letters and not all(c.isalnum() or c in "'’-‘“”«»„–—…/.,()°%§ºª" for c in word):
        return False
    if any(a.isalpha() and b in "«“„§°%ºª" for a, b in zip(word, word[1:])):
        return False
    return bool(letters) or len(word) == 1


def forms(word: str, whole: bool, least: int = 2) -> dict[str, str]:
    """Every garbled form of a clean word under each chain, with the chain's name.

    ``whole``: chains between single-byte encodings too, whose forms tell nothing in pieces or in words of up to ``least`` letters.
    """
    out: dict[str, str] = {}

    def add(form: str, chain: str) -> None:
        for text in (form, form.replace("\xad", ""), "".join(c for c in form if not "\x80" <= c <= "\x9f"), form.strip("\xa0")):
            if text and text != word:
                out.setdefault(text, chain)

    raw = word.encode("utf-8", "surrogatepass")
    for name in READ_AS:
        once = _read(raw, name)
        add(once, f"utf-8>{name}")
        add(raw.decode(name, "replace"), f"utf-8>{name}>lost")
        again = once.encode("utf-8")
        for second in (name, "cp1252", "latin-1"):
            add(_read(again, second), f"utf-8>{name}>utf-8>{second}")
        add(again.decode(name, "replace"), f"utf-8>{name}>utf-8>{name}>lost")
    add(raw.decode("ascii", "replace"), "utf-8>ascii>lost")
    add(word.encode("ascii", "replace").decode(), "?")
    add(raw.decode("ascii", "replace").replace("\ufffd", "?"), "utf-8>?")
    for source in WRITTEN_AS:
        try:
            raw = word.encode(source)
        except UnicodeEncodeError:
            continue
        add(raw.decode("utf-8", "replace"), f"{source}>utf-8>lost")
        add(raw.decode("ascii", "replace"), f"{source}>ascii>lost")
        if whole and len(word) > least:
            for name in READ_AS:
                if name != source:
                    add(_read(raw, name), f"{source}>{name}")
    return out


def _make_forms(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form, original, many, chain = [], [], [], []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if is_plausible(word):
                    for f, c in forms(word, whole).items():
                        if whole or len(f) > 1 or f == "�":
                            form.append(f)
                            original.append(word)
                            many.append(n)
                            chain.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(form, pa.string()), pa.array(original, pa.string()), pa.array(many, pa.int64()), pa.array(chain, pa.string())], names=["form", "original", "times", "chain"])

    return run


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.append_column("plausible", pa.array([is_plausible(w) for w in batch.column("word").to_pylist()], pa.bool_()))


def tokens(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """``ident, word`` of every token beyond ASCII, found inside the JVM; ASCII texts give none."""
    found = docs.select(F.col(ident).alias("ident"), F.explode(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0))).alias("word"))
    return found.select("ident", F.regexp_replace("word", _ENDS, "").alias("word"))


def _originals(seen: DataFrame, made: DataFrame) -> DataFrame:
    """``word, original, chain``: seen words that are a garbled form of a clean word, with the most frequent such word.

    A word that could itself be clean counts as garbled only if its original is more than twice as frequent.
    """
    pairs = seen.join(made, seen.word == made.form).where("NOT plausible OR times > 2 * n")
    best = pairs.groupBy("word").agg(F.max_by(F.struct("original", "chain"), F.struct("times", "original", "chain")).alias("best"))
    return best.select("word", "best.original", "best.chain")


def garbled_words(words: DataFrame) -> DataFrame:
    """``word, original, chain`` of the garbled ones among distinct words (``word, n``).

    First whole words are joined with the forms of all clean words. A word left over is garbled if one of its pieces beyond ASCII (such as
    the two signs that a letter became) is a form of a clean piece; then only its pieces are put back.
    """
    schema = "form string, original string, times long, chain string"
    seen = words.mapInArrow(_plausible, "word string, n long, plausible boolean")
    whole = _originals(seen, words.mapInArrow(_make_forms(True), schema))
    pieces = words.select("word", "n", F.explode(F.array_distinct(F.regexp_extract_all("word", F.lit(r"[^\x00-\x7F]+"), F.lit(0)))).alias("piece"))
    counted = pieces.groupBy(F.col("piece").alias("word")).agg(F.sum("n").alias("n"))
    parts = _originals(counted.mapInArrow(_plausible, "word string, n long, plausible boolean").where("length(word) > 1 OR word = '\\uFFFD'"), counted.mapInArrow(_make_forms(False), schema))
    parts = parts.select(F.col("word").alias("piece"), F.col("original").alias("clean"), "chain")
    partly = pieces.join(parts, "piece").groupBy("word").agg(
        F.reduce(F.sort_array(F.collect_list(F.struct((-F.length("piece")).alias("k"), "piece", "clean"))), F.col("word"), lambda w, p: F.replace(w, p["piece"], p["clean"])).alias("original"),
        F.min("chain").alias("chain"),
    )
    return whole.unionByName(partly.join(whole, "word", "left_anti"))


def garbled(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """``ident, word, original, chain``: each distinct garbled token of each document with the original put in its place.

    Texts are read once, inside the JVM, and their tokens kept as a compressed table, a row for each document; what is shuffled are tokens beyond ASCII, counted before the shuffle. Both tables that are joined
    hold distinct words, so a document copied millions of times costs one row of each. Null texts and ASCII texts are never garbled; in
    lossy chains the original is the most frequent word of that form, and letters lost to a question mark are seen only before another letter. Repeated rows give one row for each token; an empty table gives none.
    """
    ship(docs.sparkSession)
    runs = F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0))
    kept = saved(docs.where(F.col(ident).isNotNull()).select(F.col(ident).alias("ident"), runs.alias("runs")).where("size(runs) > 0"))
    found = kept.select("ident", F.explode("runs").alias("word")).select("ident", F.regexp_replace("word", _ENDS, "").alias("word")).where("word <> ''")
    words = cut(found.groupBy("word").agg(F.count("*").alias("n")))
    wrong = cut(garbled_words(words))
    return found.join(wrong, "word").select("ident", "word", "original", "chain").distinct()


def _short_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forms of words of one or two letters under the chains between single-byte encodings."""
    for batch in batches:
        made = [(f, w, n, c) for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()) if is_plausible(w) for f, c in forms(w, True, 0).items() if _ONE_BYTE.match(c)]
        form, original, many, chain = zip(*made) if made else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(form, pa.string()), pa.array(original, pa.string()), pa.array(many, pa.int64()), pa.array(chain, pa.string())], names=["form", "original", "times", "chain"])


def restored(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """``ident, text, chains``: the affected documents with every garbled token replaced; several rows of one identifier are restored each.

    Each token is replaced once and as a whole, in one pass over the text. Words of one or two letters, which prove no chain between single-byte encodings by themselves, are put
    back in documents in which longer words show that chain.
    """
    found = garbled(docs, ident, text)
    words = tokens(docs, ident, text).where("length(word) BETWEEN 1 AND 2").groupBy("word").agg(F.count("*").alias("n"))
    short = words.mapInArrow(_short_forms, "form string, original string, times long, chain string").groupBy(F.col("form").alias("word"), "chain").agg(F.max_by("original", F.struct("times", "original")).alias("original"))
    shown = found.select("ident", "chain").where(F.col("chain").rlike(_ONE_BYTE.pattern)).distinct()
    in_them = tokens(docs, ident, text).where("length(word) BETWEEN 1 AND 2").distinct().join(shown, "ident").join(short, ["word", "chain"]).select("ident", "word", "original", "chain")
    by_doc = found.unionByName(in_them).groupBy("ident", "word").agg(F.max_by("original", F.struct(F.col("chain").rlike(_ONE_BYTE.pattern), "chain")).alias("original"), F.min("chain").alias("chain"))
    by_doc = by_doc.groupBy("ident").agg(F.map_from_entries(F.collect_list(F.struct("word", "original"))).alias("swaps"), F.array_sort(F.collect_set("chain")).alias("chains"))
    joined = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text")).join(by_doc, "ident")
    runs = F.regexp_extract_all("text", F.lit(r"\s+|\S+"), F.lit(0))

    def put_back(run):
        original = F.try_element_at("swaps", F.regexp_replace(run, _ENDS, ""))
        return F.when(original.isNull(), run).otherwise(F.concat(F.regexp_extract(run, _LEAD, 0), original, F.regexp_extract(run, _TAIL, 0)))

    return joined.select("ident", F.array_join(F.transform(runs, put_back), "").alias("text"), "chains")
