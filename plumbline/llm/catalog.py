"""Registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import encoding, leak, look, markup, match, packing, survivor, titles, topn
from plumbline.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = look.look_alikes(table(spark, d, "paper"), "paper_id", ("title", "abstract"))
    return pairs.select(F.col("ident_a").alias("paper_id_a"), F.col("ident_b").alias("paper_id_b"), "field")


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    return look.forms(table(spark, d, "paper"), "paper_id", ("title", "abstract"))


def p2_matches(spark: SparkSession, d: str) -> DataFrame:
    cited = match.records(table(spark, d, "identity_candidate"), "ident_id", "title", "doi", ("location_doi", "pdf_url", "landing_url"))
    described = match.records(table(spark, d, "semantic_candidate"), "cand_id", "title", "doi", ("pdf_url", "landing_url"))
    return match.matches(cited, described).withColumnsRenamed({"ident_a": "ident_id", "ident_b": "cand_id"})


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_matches(spark, d).select("ident_id", "cand_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return titles.copies_of(table(spark, d, "semantic_candidate"), "cand_id", "title")


def p3_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return titles.collapse(table(spark, d, "semantic_candidate"), "cand_id", "title")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.with_markup(table(spark, d, "semantic_candidate"), "cand_id", "abstract").select(F.col("ident").alias("cand_id"))


def p4_plain(spark: SparkSession, d: str) -> DataFrame:
    plain = markup.cleaned(table(spark, d, "semantic_candidate"), "cand_id", "abstract")
    return plain.select(F.col("ident").alias("cand_id"), F.col("text").alias("abstract"), "kinds")


def p4_differenced(spark: SparkSession, d: str) -> DataFrame:
    return markup.differenced(table(spark, d, "semantic_candidate"), "cand_id", "landing_url", "abstract").withColumnsRenamed({"ident": "cand_id", "text": "abstract"})


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "paper"), table(spark, d, "source_trust"))


def p5_current(spark: SparkSession, d: str) -> DataFrame:
    return survivor.current(table(spark, d, "paper"), table(spark, d, "source_trust"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    top = topn.top_n(table(spark, d, "manifest"), "query", "paper.similarity", "paper.rank", "record_id", 5)
    return top.select(F.col("grp").alias("query"), F.col("ident").alias("record_id"))


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    packed = packing.pack(table(spark, d, "documents"), table(spark, d, "container_size"), "doc_id", "text")
    return packed.withColumnRenamed("ident", "doc_id")


def p7_checked(spark: SparkSession, d: str) -> DataFrame:
    """What holds of the packing for each kind of container: every text placed, nothing over the capacity, no more containers than one in a hundred above the sum of tokens."""
    packed, sizes = p7_packed(spark, d), table(spark, d, "container_size")
    filled = packed.groupBy("container", "container_no").agg(F.sum("tokens").alias("filled"), F.count("*").alias("n"))
    kinds = filled.join(F.broadcast(sizes), "container").groupBy("container").agg(F.max(F.greatest(F.col("filled") - F.col("capacity_tokens"), F.lit(0))).alias("over"), (F.count("*") <= F.ceil(F.sum("filled") / F.first("capacity_tokens") * 1.01) + 1).alias("tight"))
    return packed.groupBy("container").agg(F.countDistinct("doc_id").alias("texts")).join(kinds, "container").select("container", "texts", F.col("over").cast("long").alias("over"), "tight")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    near = leak.leaks(table(spark, d, "documents"), table(spark, d, "eval_item"), "doc_id", "text", words=12)
    return near.where("words >= 12").select("doc_id", "item_id")


def p8_near(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(table(spark, d, "documents"), table(spark, d, "eval_item"), "doc_id", "text", words=12)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled(table(spark, d, "documents"), "doc_id", "text").select(F.col("ident").alias("doc_id")).distinct()


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.restored(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("ident", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_forms, p2_found, p2_matches, p3_found, p3_collapsed, p4_found, p4_plain, p4_differenced, p5_found, p5_current, p6_found, p7_packed, p7_checked, p8_found, p8_near, p9_found, p9_restored)}


#: Fixed values of the counterpart of p1_found, apart from the operator's own: signs and letters, and what has the same shape.
_P1_PAIRS = (
    ("АВЕЅІЈКМНОРСТХҮԚԜѴӀ", "ABESIJKMHOPCTXYQWVI"), ("асеһіјорѕухԁԛԝѵ", "acehijopsyxdqwv"),
    ("ЁЇЀӐӒӖӦ", "ËÏÈĂÄĔÖ"), ("ёїѐӑӓӗӧ", "ëïèăäĕö"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"), ("νορϳ", "vopj"), ("ΆΈΊΌΎΪΫό", "ÁÉÍÓÝÏŸó"), ("ՕՏՍԼօհոսզց", "OSULohnuqg"),
    ("µ∆∑∏‐‑﹣∙⋅ʼ", "μΔΣΠ---··’"), ("￠￡￢￤￥￦", "¢£¬¦¥₩"),
    ("｡｢｣､･ｦｧｨｩｪｫｬｭｮｯｰｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜﾝ", "。「」、・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン"),
)
_P1_WORDS = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "Ĳ": "IJ", "ĳ": "ij", "ﾞ": "\u3099", "ﾟ": "\u309a"}


def _p1_sql() -> str:
    """Texts taken apart into characters, each put in its plain form by number or by the list above, and put together again."""
    each = {a: b for x, y in _P1_PAIRS for a, b in zip(x, y, strict=True)} | _P1_WORDS
    forms = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in each.items()) + "}"
    gone = "[\\x{AD}\\x{34F}\\x{61C}\\x{115F}\\x{1160}\\x{17B4}\\x{17B5}\\x{180B}-\\x{180F}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{206F}\\x{FE00}-\\x{FE0F}\\x{FEFF}\\x{FFF9}-\\x{FFFB}\\x{E0000}-\\x{E0FFF}]"
    spaces = "[\\p{Zs}\\t\\n\\r\\v\\f\\x{85}\\x{2028}\\x{2029}]"
    return f"""
        WITH forms AS (SELECT {forms} AS m),
        t AS (SELECT paper_id, 'title' AS field, title AS text FROM paper UNION ALL SELECT paper_id, 'abstract', abstract FROM paper),
        c AS (SELECT paper_id, field, text, string_split(nfc_normalize(regexp_replace(regexp_replace(text, '{gone}', '', 'g'), '{spaces}', ' ', 'g')), '') AS chars FROM t WHERE text IS NOT NULL),
        s AS (SELECT paper_id, field, text, nfc_normalize(array_to_string(list_transform(chars, lambda x: CASE WHEN x <> '' AND unicode(x) BETWEEN 65281 AND 65374 THEN chr(CAST(unicode(x) - 65248 AS INTEGER)) ELSE coalesce(m[x], x) END), '')) AS look FROM c, forms)
        SELECT DISTINCT a.paper_id AS paper_id_a, b.paper_id AS paper_id_b, field FROM s a JOIN s b USING (field, look)
        WHERE trim(look) <> '' AND a.paper_id < b.paper_id AND a.text <> b.text"""


#: Whole statements that there is no title or abstract, for the counterpart of p5_found; written apart from the operator's own list.
_P5_NONE = (
    "(n ?/? ?a|none|nil|null|empty|missing|unknown|untitled|untitled (document|record|item|work)"
    "|(no|without) (title|abstract|text)( (is|was))?( (available|provided|given|supplied|found))?"
    "|(the )?(title|abstract) ?[:=-]? ?((is|was) )?(null|none|n ?/? ?a|missing|unavailable|unknown|empty|not (available|provided|given|supplied)|withheld( .*)?)"
    "|there is no (title|abstract)( (for|in|of|available)( .*)?)?|this (record|item|entry|work) (does not (contain|have|include)|has no|lacks) (an? )?(title|abstract)([^a-z0-9_].*)?)"
)
_P5_TEXT = rf"""
  SELECT key, paper_id, updated_at, '{{f}}' AS field, {{worth}} AS worth FROM t WHERE {{f}} IS NOT NULL
    AND regexp_replace(lower({{f}}), '^[^\p{{{{L}}}}\p{{{{N}}}}]+|[^\p{{{{L}}}}\p{{{{N}}}}]+$', '', 'g') <> ''
    AND NOT regexp_full_match(trim(regexp_replace(regexp_replace(lower({{f}}), '^[^\p{{{{L}}}}\p{{{{N}}}}]+|[^\p{{{{L}}}}\p{{{{N}}}}]+$', '', 'g'), '\s+', ' ', 'g')), '{_P5_NONE}', 's')"""
_P5_LIST = """
  SELECT key, paper_id, updated_at, '{f}', n FROM (
    SELECT *, len(list_distinct(list_filter({f}, lambda v: v IS NOT NULL AND trim(v) <> ''))) AS n FROM t) WHERE n > 0"""
_P5 = (
    """
WITH t AS (
  SELECT p.*, coalesce(list_max(list_transform(list_filter(retrieval_sources, lambda s: s IS NOT NULL), lambda s: coalesce(m[s], 0))), 0) AS trust_level
  FROM paper p, (SELECT map_from_entries(list((source, trust))) AS m FROM source_trust)
), v AS ("""
    + " UNION ALL ".join(
        [
            _P5_TEXT.format(f="title", worth="trust_level"),
            _P5_TEXT.format(f="abstract", worth="length(trim(abstract))"),
            _P5_LIST.format(f="pdf_urls"),
            _P5_LIST.format(f="retrieval_sources"),
        ]
    )
    + """
), many AS (SELECT key FROM paper GROUP BY key HAVING count(DISTINCT paper_id) > 1)
SELECT key, field, paper_id FROM (
  SELECT *, row_number() OVER (PARTITION BY key, field ORDER BY worth DESC, updated_at DESC NULLS LAST, paper_id) AS pos FROM v SEMI JOIN many USING (key))
WHERE pos = 1"""
)

_P3 = r"""
WITH k AS (
  SELECT cand_id, array_to_string(list_sort(list_filter(
    list_transform(regexp_split_to_array(title, '[\s\p{Z}][|/·][\s\p{Z}]'), lambda s: regexp_replace(lower(s), '[^\p{L}\p{N}]+', '', 'g')), lambda s: s <> '')), '|') AS key
  FROM semantic_candidate WHERE title IS NOT NULL
), g AS (SELECT cand_id, min(cand_id) OVER (PARTITION BY key) AS keep_id, count(*) OVER (PARTITION BY key) AS copies FROM k WHERE key <> '')
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _p1_sql(),
        "p5_found": _P5,
        "p7_checked": "SELECT container, (SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL) AS texts, CAST(0 AS BIGINT) AS over, true AS tight FROM container_size",
        "p8_found": r"""
            WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
            iw AS (SELECT item_id, regexp_extract_all(lower(passage), '[\p{L}\p{N}]+') AS w FROM eval_item),
            ds AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS s FROM dw, unnest(range(1, len(w) - 10)) AS u(k)),
            si AS (SELECT item_id, array_to_string(w[k:k + 11], ' ') AS s FROM iw, unnest(range(1, len(w) - 10)) AS u(k))
            SELECT DISTINCT doc_id, item_id FROM ds JOIN si USING (s)""",
        "p3_found": _P3 + "SELECT keep_id, cand_id AS copy_id FROM g WHERE cand_id > keep_id",
        "p3_collapsed": _P3 + "SELECT keep_id, CAST(copies AS BIGINT) AS copies FROM g WHERE cand_id = keep_id",
        "p6_found": """
            WITH once AS (
              SELECT DISTINCT query, record_id, paper.similarity AS s, paper.rank AS r FROM manifest
              WHERE query IS NOT NULL AND paper IS NOT NULL AND paper.similarity IS NOT NULL AND NOT isnan(paper.similarity))
            SELECT query, record_id FROM (
              SELECT query, record_id, row_number() OVER (PARTITION BY query ORDER BY s DESC, r ASC NULLS LAST, record_id) AS pos FROM once)
            WHERE pos <= 5""",
    }
