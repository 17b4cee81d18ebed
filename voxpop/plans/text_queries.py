"""Text-cleaning queries (T1-T10, P5, S7) over every text of the driver tables.

The driver texts contain no quote markers and no re-glue sequences, so a few
fixed edge rows are appended to the table rows (in Spark and in SQL alike);
all table rows are processed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.functions import text as T
from voxpop.operators import filters as P
from voxpop.plans.registry import register
from voxpop.sources import driver_tables as DT

# Fixed edge rows (id, body) exercising rules the generated text never hits.
EDGE_ROWS = [
    ("e01", "I'm afraid I can't, sir."),
    ("e02", "1,000 , 000."),
    ("e03", "Hi . Eat"),
    ("e04", ""),
    ("e05", "   "),
    ("e06", "x http://q y"),
    ("e07", "and/so //ss http://s.com/sub"),
    ("e08", "  &gt x"),
    ("e09", "/s&gt"),
    ("e10", "a &gt"),
    ("e11", "tab\t\nnewline, i . e . g . 0 , 0!"),
]


def _edge_sql() -> str:
    def lit(s: str) -> str:
        return "'" + s.replace("'", "''").replace("\t", "' || chr(9) || '").replace("\n", "' || chr(10) || '") + "'"

    return " UNION ALL ".join(f"SELECT {lit(i)} AS id, {lit(b)} AS body" for i, b in EDGE_ROWS)


def edge_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EDGE_ROWS, "id string, body string")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DT.text_corpus(spark, sf_dir).unionByName(edge_frame(spark))


SQL_CORPUS = f"""
    SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, text AS body FROM documents
    UNION ALL
    SELECT 'c' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS id, text AS body FROM conversations
    UNION ALL
    SELECT 'p' || CAST(page_id AS VARCHAR) AS id, concat_ws(' ', url, html) AS body FROM pages
    UNION ALL
    {_edge_sql()}"""

_SP = r"[\t-\r\x1c-\x20\x85\p{Z}]"
_TOK = r"[\p{L}\p{N}_''/%$\-]+|[.,!?;:]"
_PUNCT = "('.', '!', ':', ',', ';', '?')"
SQL_PARSE = (
    "replace(replace(replace(lower(array_to_string(regexp_extract_all("
    "regexp_replace(regexp_replace(replace(body, chr(9) || chr(10), ' '), "
    f"'http[^{_SP[1:-1]}]+', '', 'g'), '{_SP}{{2,}}', ' ', 'g'), '{_TOK}'), ' ')), "
    "'0 , 0', '0,0'), 'i . e', 'i.e'), 'e . g', 'e.g')"
)


def sql_words(source_sql: str) -> str:
    """SQL producing (id, parsed, w) with w the word list."""
    return f"""
    SELECT id, parsed, list_filter(string_split(parsed, ' '), lambda x: x <> '') AS w
    FROM (SELECT id, {SQL_PARSE} AS parsed FROM ({source_sql}) src) p"""


SQL_UNI = f"list_filter(w, lambda x: x NOT IN {_PUNCT})"
SQL_BI = (
    "list_filter(list_transform(range(1, len(w)), lambda i: CASE WHEN "
    f"w[i] NOT IN {_PUNCT} AND w[i + 1] NOT IN {_PUNCT} THEN w[i] || '_' || w[i + 1] END), "
    "lambda g: g IS NOT NULL)"
)
SQL_TRI = (
    "list_filter(list_transform(range(1, len(w) - 1), lambda i: CASE WHEN "
    f"w[i] NOT IN {_PUNCT} AND w[i + 1] NOT IN {_PUNCT} AND w[i + 2] NOT IN {_PUNCT} "
    "THEN w[i] || '_' || w[i + 1] || '_' || w[i + 2] END), lambda g: g IS NOT NULL)"
)


def _grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_grams(corpus(spark, sf_dir), "body")


@register("clean_parsed_text", f"SELECT id, parsed FROM ({sql_words(SQL_CORPUS)}) t")
def clean_parsed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("id", T.parse_text("body").alias("parsed"))


@register("clean_unigrams", f"SELECT id, array_to_string({SQL_UNI}, ' ') AS unigrams FROM ({sql_words(SQL_CORPUS)}) t")
def clean_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grams(spark, sf_dir).select("id", F.array_join("unigrams", " ").alias("unigrams"))


@register("clean_bigrams", f"SELECT id, array_to_string({SQL_BI}, ' ') AS bigrams FROM ({sql_words(SQL_CORPUS)}) t")
def clean_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grams(spark, sf_dir).select("id", F.array_join("bigrams", " ").alias("bigrams"))


@register("clean_trigrams", f"SELECT id, array_to_string({SQL_TRI}, ' ') AS trigrams FROM ({sql_words(SQL_CORPUS)}) t")
def clean_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grams(spark, sf_dir).select("id", F.array_join("trigrams", " ").alias("trigrams"))


@register(
    "gram_union",
    f"""
    SELECT id, array_to_string(g, ' ') AS grams, CAST(len(g) AS INTEGER) AS n_grams
    FROM (SELECT id, list_concat(list_concat({SQL_UNI}, {SQL_BI}), {SQL_TRI}) AS g
          FROM ({sql_words(SQL_CORPUS)}) t) u""",
)
def gram_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = T.with_gram_list(corpus(spark, sf_dir), "body")
    return g.select("id", F.array_join("grams", " ").alias("grams"), F.size("grams").alias("n_grams"))


SQL_COMMENTS_RAW = """
    SELECT CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS id, text AS body,
           't3_' || CAST(conv_id AS VARCHAR) AS link_id
    FROM conversations WHERE turn > 0"""


@register(
    "strip_link_prefix",
    f"""
    SELECT id, link_id, regexp_replace(link_id, '^t3_', '') AS link
    FROM (SELECT id, link_id FROM ({SQL_COMMENTS_RAW}) c
          UNION ALL
          SELECT 's' || CAST(conv_id AS VARCHAR) AS id, CAST(conv_id AS VARCHAR) AS link_id
          FROM conversations WHERE turn = 0) u""",
)
def strip_link_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = DT.comments(spark, sf_dir).select("id", "link_id")
    s = DT.submissions(spark, sf_dir).select(F.concat(F.lit("s"), F.col("id")).alias("id"), F.col("id").alias("link_id"))
    return c.unionByName(s).select("id", "link_id", T.strip_link_prefix("link_id").alias("link"))


_SQL_MARK = (
    f"CASE WHEN regexp_matches(body, '^{_SP}*&gt') THEN '&gt' ELSE replace(body, '/s', '') END"
)


@register("mark_quotes_and_sarcasm", f"SELECT id, {_SQL_MARK} AS marked FROM ({SQL_CORPUS}) t")
def mark_quotes_and_sarcasm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("id", T.mark_quotes_and_sarcasm("body").alias("marked"))


@register(
    "quote_filter",
    f"""
    SELECT id, marked AS body
    FROM (SELECT id, {_SQL_MARK} AS marked
          FROM (SELECT id, body FROM ({SQL_COMMENTS_RAW}) c UNION ALL {_edge_sql()}) u) m
    WHERE marked <> '&gt'""",
)
def quote_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = DT.comments(spark, sf_dir).select("id", "body").unionByName(edge_frame(spark))
    return P.quote_filter(rows, "body").select("id", "body")


@register(
    "json_props_projection",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_props_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = DT.table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


# ---------------------------------------------------------------------------
# The same rules through the SQL-function surface.
# ---------------------------------------------------------------------------
@register(
    "sql_function_grams",
    f"""
    SELECT id, array_to_string(g, ' ') AS grams, CAST(len(g) AS INTEGER) AS n_grams
    FROM (SELECT id, list_concat(list_concat({SQL_UNI}, {SQL_BI}), {SQL_TRI}) AS g
          FROM ({sql_words(SQL_CORPUS)}) t) u""",
)
def sql_function_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxpop.functions.sql import register_sql_functions

    register_sql_functions(spark)
    corpus(spark, sf_dir).createOrReplaceTempView("vp_corpus")
    return spark.sql(
        "SELECT id, array_join(g, ' ') AS grams, size(g) AS n_grams "
        "FROM (SELECT id, vp_grams(body) AS g FROM vp_corpus) t"
    )


@register(
    "sql_function_quote_filter",
    f"""
    SELECT id, regexp_replace(link_id, '^t3_', '') AS link, marked AS body
    FROM (SELECT id, link_id, {_SQL_MARK} AS marked
          FROM (SELECT id, body, link_id FROM ({SQL_COMMENTS_RAW}) c) u) m
    WHERE marked <> '&gt'""",
)
def sql_function_quote_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxpop.functions.sql import register_sql_functions

    register_sql_functions(spark)
    DT.comments(spark, sf_dir).createOrReplaceTempView("vp_comment_rows")
    return spark.sql(
        "SELECT id, vp_strip_link(link_id) AS link, vp_mark(body) AS body "
        "FROM vp_comment_rows WHERE vp_mark(body) <> '&gt'"
    )
