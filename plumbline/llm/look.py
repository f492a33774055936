"""One consistent form for texts that look the same but differ in their characters: DuckDB SQL inside Arrow partitions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.lineage import cut
from plumbline.plans.shipping import ship
from plumbline.plans.sizing import shuffle_partitions

#: Letters of other scripts and the Latin letters of the same shape.
SHAPES = (
    ("АВСЕНІЈКМОРЅТХаеосрхуіјѕһԁԛԝԚԜҮӀѴѵ", "ABCEHIJKMOPSTXaeocpxyijshdqwQWYIVv"),  # Cyrillic
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρϳ", "ABEZHIKMNOPTYXovpj"),  # Greek
    ("ՕՏՍԼօհոսզց", "OSULohnuqg"),  # Armenian
)
#: Twin code points of one symbol that Unicode's canonical forms keep apart.
TWINS = ("µ∆∑∏‐‑﹣∙⋅ʼ", "μΔΣΠ---··’")
#: Characters without any glyph of their own, as ranges of code points.
INVISIBLE = "\\x{AD}\\x{34F}\\x{61C}\\x{115F}\\x{1160}\\x{17B4}\\x{17B5}\\x{180B}-\\x{180F}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{206F}\\x{FE00}-\\x{FE0F}\\x{FEFF}\\x{FFF9}-\\x{FFFB}\\x{E0000}-\\x{E0FFF}"


def _tables() -> tuple[dict[str, str], dict[str, str]]:
    """One-to-one and one-to-many mappings, made by rule from the fixed values and Unicode's width and ligature forms."""
    single = dict(zip(*TWINS)) | {a: b for other, latin in SHAPES for a, b in zip(other, latin)}
    many: dict[str, str] = {}
    for point in (*range(0xFF00, 0xFFF0), *range(0xFB00, 0xFB07), 0x132, 0x133):
        to = unicodedata.normalize("NFKC", chr(point))
        if 0xFF9E <= point <= 0xFF9F:  # half-width voicing marks join the kana before them
            to = chr(point - 0xFF9E + 0x3099)
        if to != chr(point):
            (single if len(to) == 1 else many)[chr(point)] = single.get(to, to)
    for point in (*range(0x370, 0x530), *range(0x1F00, 0x2000)):  # accented letters of the same shape, in Greek and Cyrillic
        form = unicodedata.normalize("NFD", chr(point))
        if len(form) > 1 and form[0] in single and len(to := unicodedata.normalize("NFC", single[form[0]] + form[1:])) == 1:
            single[chr(point)] = to
    return single, many


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def look_sql(column: str) -> str:
    """DuckDB expression of the form in which texts that look the same are equal; for comparing, not for display."""
    single, many = _tables()
    sql = f"nfc_normalize(regexp_replace(regexp_replace({column}, '[{INVISIBLE}]+', '', 'g'), '[\\p{{Zs}}\\t\\n\\r\\v\\f\\x{{85}}\\x{{2028}}\\x{{2029}}]', ' ', 'g'))"
    chain = sql
    for a, b in many.items():
        chain = f"replace({chain}, {_quoted(a)}, {_quoted(b)})"
    sql = f"CASE WHEN regexp_matches({column}, '[{''.join(many)}]') THEN {chain} ELSE {sql} END"
    return f"nfc_normalize(translate({sql}, {_quoted(''.join(single))}, {_quoted(''.join(single.values()))}))"


def form_sql(column: str) -> str:
    """DuckDB expression of the form to store: a word with a letter that only another script has keeps that script's letters."""
    shared = {a for other, _ in SHAPES for a in other} | {a for a in _tables()[0] if unicodedata.name(a, "").startswith(("GREEK", "CYRILLIC"))}
    own = "".join(c for c in map(chr, (*range(0x370, 0x400), *range(0x400, 0x530))) if c.isalpha() and c not in shared)
    cyrillic, latin = SHAPES[0]
    back = {b: a for a, b in reversed(list(zip(cyrillic, latin)))}
    to_cyrillic = f"translate(w, {_quoted(''.join(back))}, {_quoted(''.join(back.values()))})"
    single = {a: b for a, b in _tables()[0].items() if a not in shared}
    plain = f"nfc_normalize(regexp_replace(regexp_replace({column}, '[{INVISIBLE}]+', '', 'g'), '[\\p{{Zs}}\\t]', ' ', 'g'))"
    for a, b in _tables()[1].items():
        plain = f"replace({plain}, {_quoted(a)}, {_quoted(b)})"
    plain = f"nfc_normalize(translate({plain}, {_quoted(''.join(single))}, {_quoted(''.join(single.values()))}))"
    return (
        f"array_to_string(list_transform(string_split({plain}, ' '), lambda w: CASE WHEN NOT regexp_matches(w, '[\\p{{Greek}}\\p{{Cyrillic}}]') THEN w "
        f"WHEN regexp_matches(w, '[{own}]') THEN CASE WHEN regexp_matches(w, '\\p{{Cyrillic}}') THEN {to_cyrillic} ELSE w END ELSE {look_sql('w')} END), ' ')"
    )


def _in_duckdb(sql: str):
    """Runs ``sql`` over each Arrow batch (as table ``batch``) in one in-process, single-threaded DuckDB for each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        for batch in batches:
            if batch.num_rows:
                con.register("batch", pa.Table.from_batches([batch]))
                yield from con.sql(sql).to_arrow_table().to_batches()
                con.unregister("batch")

    return run


def looks(df: DataFrame, ident: str, fields: tuple[str, ...]) -> DataFrame:
    """``ident, field, look, raw``: 128-bit digests of each text's look and of its characters; null and blank texts give no row.

    A text of ASCII characters only looks like itself but for the kind of its spaces, which the JVM settles; all others go through DuckDB.
    """
    ship(df.sparkSession)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields])).alias("of")
    texts = df.where(F.col(ident).isNotNull()).select(F.col(ident).cast("long").alias("ident"), each).select("ident", "of.field", "of.text").where("text IS NOT NULL")
    ascii = ~F.col("text").rlike(r"[^\x00-\x7F]")
    plain = F.translate("text", "\t\n\r\v\f", " " * 5)
    settled = texts.where(ascii & F.col("text").rlike(r"[^\s\x0B]")).select("ident", "field", F.unhex(F.md5(plain)).alias("look"), F.unhex(F.md5("text")).alias("raw"))
    sql = f"SELECT ident, field, unhex(md5(look)) AS look, unhex(md5(text)) AS raw FROM (SELECT ident, field, text, {look_sql('text')} AS look FROM batch) WHERE regexp_matches(look, '[^ ]')"
    return settled.unionByName(texts.where(~ascii).mapInArrow(_in_duckdb(sql), "ident long, field string, look binary, raw binary"))


def forms(df: DataFrame, ident: str, fields: tuple[str, ...]) -> DataFrame:
    """``ident`` and every field in its consistent form; null stays null."""
    ship(df.sparkSession)
    slim = df.select(F.col(ident).cast("long").alias("ident"), *[F.col(f).cast("string").alias(f"t{k}") for k, f in enumerate(fields)])
    sql = "SELECT ident, " + ", ".join(f"{form_sql(f't{k}')} AS t{k}" for k in range(len(fields))) + " FROM batch"
    out = slim.mapInArrow(_in_duckdb(sql), "ident long, " + ", ".join(f"t{k} string" for k in range(len(fields))))
    return out.toDF(ident, *fields)


def look_alikes(df: DataFrame, ident: str, fields: tuple[str, ...]) -> DataFrame:
    """``ident_a, ident_b, field``, a < b: records whose texts look the same but are not the same string.

    Looks with one variant only are dropped by a pre-aggregated count of distinct strings before any pair is formed, so copies of one
    string, however many, meet no one; the join that remains is on (field, look) and its rows are the result itself. Looks with more records than a quarter of an
    even partition are split by salts on one side (no more than four times the partitions can be that frequent, which bounds the broadcast). Repeated rows give
    each pair once. Null, blank or wholly invisible texts never count; an empty table gives no rows; other columns are ignored.
    """
    rows = looks(df, ident, fields)
    several = rows.groupBy("field", "look").agg(F.min("raw").alias("low"), F.max("raw").alias("high")).where("low < high").select("field", "look")
    near = cut(rows.join(several, ["field", "look"], "left_semi").distinct())
    salts = shuffle_partitions(df.sparkSession)
    limit = near.count() // (4 * salts) + 1
    hot = near.groupBy("field", "look").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("field", "look", F.lit(salts).alias("parts"))
    near = near.join(F.broadcast(hot), ["field", "look"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    a = near.select("field", "look", F.pmod(F.xxhash64("ident"), F.col("parts")).cast("int").alias("salt"), F.col("ident").alias("ident_a"), F.col("raw").alias("raw_a"))
    b = near.select("field", "look", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.col("ident").alias("ident_b"), F.col("raw").alias("raw_b"))
    return a.join(b, ["field", "look", "salt"]).where("ident_a < ident_b AND raw_a <> raw_b").select("ident_a", "ident_b", "field").distinct()
