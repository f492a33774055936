"""Text functions as Column expressions; all stay inside the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.plans.columns import col

#: Characters that search back ends give a meaning to.
QUERY_SIGNS = "\"'()[]:+^~"
#: An arXiv address, its identifier, and the registrant of its DOIs.
ARXIV = r"(?i)arxiv\.org/(?:pdf|abs)/(\d{4}\.\d{4,5}|[a-z\-]+(?:\.[A-Z]{2})?/\d{7})"
ARXIV_DOI = "10.48550/arXiv."
#: Fixed value: the shape of a bare DOI.
BARE_DOI = r"^10\.[0-9]{4,9}/\S+$"


@lru_cache(maxsize=1)
def _plain_letters() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters of the basic plane whose compatibility decomposition without marks is ASCII: one-to-one pairs, and expansions."""
    source, target, longer = [], [], []
    for point in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2070, 0x2190), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)):
        c = chr(point)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain != c and plain.isascii():
            if len(plain) == 1:
                source.append(c)
                target.append(plain)
            elif plain.isalnum():
                longer.append((c, plain))
    return "".join(source), "".join(target), tuple(longer)


def without_accents(text: Column | str) -> Column:
    """Letters without their marks, compatibility forms as ASCII; ASCII texts pass untouched."""
    source, target, longer = _plain_letters()
    t = col(text)
    plain = F.translate(t, source, target)
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(p).alias("p")) for c, p in longer])
    spelled = F.reduce(pairs, plain, lambda s, x: F.replace(s, x["c"], x["p"]))
    whole = F.when(t.rlike("[" + "".join(c for c, _ in longer) + "]"), spelled).otherwise(plain)
    return F.when(t.rlike(r"[^\x00-\x7F]"), F.regexp_replace(whole, r"\p{Mn}+", "")).otherwise(t)


def normalize_title(title: Column | str) -> Column:
    """Lower-case letters and digits without accents, words divided by single blanks; empty where nothing is left."""
    return F.trim(F.regexp_replace(F.lower(without_accents(title)), r"[^a-z0-9]+", " "))


def strip_markup(text: Column | str) -> Column:
    """Tags become blanks, white space collapses; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(col(text), r"<[^>]+>", " "), r"\s+", " ")), F.lit(""))


def clean_query(text: Column | str) -> Column:
    """A search text without the signs that a back end would interpret."""
    return F.trim(F.regexp_replace(F.translate(col(text), QUERY_SIGNS, " " * len(QUERY_SIGNS)), r"\s+", " "))


def split_compounds(text: Column | str) -> Column:
    """Underscores, hyphens, slashes, quotes and case changes become blanks."""
    spaced = F.translate(col(text), "_-/\"'`", "      ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, r"([a-z0-9])([A-Z])", "$1 $2"), r"\s+", " "))


def host(url: Column | str) -> Column:
    """Lower-case host of an address, with or without a scheme, without a leading ``www.``; null where there is none."""
    found = F.regexp_extract(F.lower(F.trim(col(url))), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@\s]*@)?([^/:?#\s]+)", 1)
    return F.nullif(F.regexp_replace(found, r"^www\.", ""), F.lit(""))


def host_suffixes(name: Column | str) -> Column:
    """A host and every parent of it, so that an allowlist can be joined by equality."""
    parts = F.split(col(name), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def location_doi(pdf_url: Column | str, work_doi: Column | str) -> Column:
    """The DOI of the copy behind an address: an arXiv copy has its own, without version; any other copy has the work's."""
    found = F.regexp_extract(F.coalesce(col(pdf_url), F.lit("")), ARXIV, 1)
    return F.when(found != "", F.concat(F.lit(ARXIV_DOI), found)).otherwise(col(work_doi))


def slug(text: Column | str, limit: int) -> Column:
    """Letters and digits in lower case joined by hyphens, at most ``limit`` characters, no hyphen at an end."""
    return F.regexp_replace(F.substring(F.regexp_replace(F.regexp_replace(F.lower(col(text)), r"[^a-z0-9]+", "-"), r"^-+|-+$", ""), 1, limit), r"-+$", "")


def citation_slug(title: Column | str, identity: Column | str, url: Column | str) -> Column:
    """File name of a cited work: title, and its copy's DOI or else a digest of the address."""
    tail = F.coalesce(F.nullif(slug(col(identity), 40), F.lit("")), F.substring(F.sha1(F.coalesce(col(url), F.lit(""))), 1, 8))
    return F.concat_ws("_", F.nullif(slug(F.coalesce(col(title), F.lit("")), 80), F.lit("")), tail)


def semantic_slug(title: Column | str, url: Column | str) -> Column:
    """File name of a found work: title and a digest of the address, or of the title where there is none."""
    key = F.coalesce(F.nullif(col(url), F.lit("")), col(title), F.lit(""))
    return F.concat_ws("_", F.nullif(slug(F.coalesce(col(title), F.lit("")), 80), F.lit("")), F.substring(F.sha2(key, 256), 1, 10))


def uuid5(namespace: str, name: Column | str) -> Column:
    """Name-based identifier: SHA-1 of the namespace's 16 bytes and the name, with version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(col(name), "utf-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def paper_text(title: Column | str, abstract: Column | str, separator: str = "\n") -> Column:
    """Title and abstract as one text for embedding, without a dangling separator."""
    return F.concat_ws(separator, F.nullif(F.trim(col(title)), F.lit("")), F.nullif(F.trim(col(abstract)), F.lit("")))


def from_positions(index: Column | str) -> Column:
    """The text behind a JSON map from word to positions, ordered by position, then word."""
    entries = F.map_entries(F.from_json(col(index), "map<string,array<int>>"))
    places = F.flatten(F.transform(entries, lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.nullif(F.array_join(F.transform(F.array_sort(places), lambda x: x["w"]), " "), F.lit(""))


def base_name(path: Column | str) -> Column:
    """Last part of a path with either kind of slash."""
    return F.regexp_extract(col(path), r"([^/\\]+)$", 1)


def title_from_path(path: Column | str) -> Column:
    """A readable title out of a file name: no ending, no digest after the last underscore, hyphens as blanks."""
    stem = F.regexp_replace(base_name(path), r"\.[^.]+$", "")
    return F.translate(F.regexp_replace(stem, r"_[^_]*$", ""), "-", " ")


def snippet(text: Column | str, limit: int = 300) -> Column:
    """At most ``limit`` characters; a cut text ends with dots."""
    return F.when(F.length(col(text)) > limit, F.concat(F.rtrim(F.substring(col(text), 1, limit)), F.lit("..."))).otherwise(col(text))


def seconds_text(seconds: Column | str) -> Column:
    """A duration as people read it."""
    s = col(seconds).cast("double")
    return F.when(s.isNull(), "n/a").when(s < 60, F.format_string("%.1fs", s)).otherwise(F.format_string("%dm %02ds", (s / 60).cast("int"), (s % 60).cast("int")))


def bytes_text(size: Column | str) -> Column:
    """A size as people read it, in steps of 1024."""
    b = col(size).cast("double")
    return F.when(b.isNull(), "n/a").when(b < 1024, F.format_string("%.0f B", b)).when(b < 1024**2, F.format_string("%.1f KB", b / 1024)).when(b < 1024**3, F.format_string("%.1f MB", b / 1024**2)).otherwise(F.format_string("%.2f GB", b / 1024**3))
