"""The cleaning helpers as SQL functions (U1-U4), for users who write SQL.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` functions are expanded by the
analyser into native expressions (no Python worker), and a parameter is bound
once through a projection, so layering them (parse -> words -> grams) costs
one evaluation of each layer per row.

Registered names:
    vp_parse(body)        parsed text                    (U1, string part)
    vp_words(parsed)      blank-separated words
    vp_mask(words)        words with bounding punctuation as NULL
    vp_unigrams(words), vp_bigrams(words), vp_trigrams(words)
    vp_grams(body)        unigrams ++ bigrams ++ trigrams (U2(U1(x)))
    vp_strip_link(link)   link id without 't3_'           (U3)
    vp_mark(body)         '&gt' or body without '/s'      (U4)
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from voxpop.functions import text as T

_PUNCT = "(" + ", ".join(f"'{p}'" for p in T.BOUNDING_PUNCTUATION) + ")"


def _parse_sql(arg: str) -> str:
    # Same composition as text.parse_text (T1/T3 cannot change the tokens).
    out = (
        f"lower(array_join(regexp_extract_all(regexp_replace({arg}, r'{T.URL_PATTERN}', ''), "
        f'r"{T.TOKEN_PATTERN}", 0), \' \'))'
    )
    for before, after in T.REGLUE_PAIRS:
        out = f"replace({out}, '{before}', '{after}')"
    return out


def _tail(arr: str, start: int, drop: int) -> str:
    return f"slice({arr}, {start}, greatest(size({arr}) - {drop}, 0))"


def _extend(left: str, right: str) -> str:
    return (
        f"zip_with({left}, {right}, "
        "(r, w) -> CASE WHEN r IS NOT NULL AND w IS NOT NULL THEN concat(r, '_', w) END)"
    )


def function_ddl() -> list[str]:
    fn = "CREATE OR REPLACE TEMPORARY FUNCTION"
    arr = "ARRAY<STRING>"
    nonnull = "g -> g IS NOT NULL"
    return [
        f"{fn} vp_parse(body STRING) RETURNS STRING RETURN {_parse_sql('body')}",
        f"{fn} vp_words(parsed STRING) RETURNS {arr} RETURN filter(split(parsed, ' '), w -> w <> '')",
        # mask: the word, or NULL for bounding punctuation
        f"{fn} vp_mask(words {arr}) RETURNS {arr} "
        f"RETURN transform(words, w -> CASE WHEN w NOT IN {_PUNCT} THEN w END)",
        f"{fn} vp_bi_runs(mask {arr}) RETURNS {arr} RETURN {_extend(_tail('mask', 1, 1), _tail('mask', 2, 1))}",
        f"{fn} vp_tri_runs(bi {arr}, mask {arr}) RETURNS {arr} "
        f"RETURN {_extend(_tail('bi', 1, 1), _tail('mask', 3, 2))}",
        f"{fn} vp_unigrams(words {arr}) RETURNS {arr} RETURN filter(vp_mask(words), {nonnull})",
        f"{fn} vp_bigrams(words {arr}) RETURNS {arr} RETURN filter(vp_bi_runs(vp_mask(words)), {nonnull})",
        f"{fn} vp_trigrams_of(mask {arr}) RETURNS {arr} RETURN filter(vp_tri_runs(vp_bi_runs(mask), mask), {nonnull})",
        f"{fn} vp_trigrams(words {arr}) RETURNS {arr} RETURN vp_trigrams_of(vp_mask(words))",
        f"{fn} vp_grams_of_runs(mask {arr}, bi {arr}) RETURNS {arr} "
        f"RETURN concat(filter(mask, {nonnull}), filter(bi, {nonnull}), filter(vp_tri_runs(bi, mask), {nonnull}))",
        f"{fn} vp_grams_of_mask(mask {arr}) RETURNS {arr} RETURN vp_grams_of_runs(mask, vp_bi_runs(mask))",
        f"{fn} vp_gram_union(words {arr}) RETURNS {arr} RETURN vp_grams_of_mask(vp_mask(words))",
        f"{fn} vp_grams(body STRING) RETURNS {arr} RETURN vp_gram_union(vp_words(vp_parse(body)))",
        f"{fn} vp_strip_link(link STRING) RETURNS STRING RETURN regexp_replace(link, '^{T.LINK_PREFIX}', '')",
        f"{fn} vp_mark(body STRING) RETURNS STRING RETURN CASE WHEN body RLIKE r'^{T.SPACE_CLASS}*{T.QUOTE_MARKER}' "
        f"THEN '{T.QUOTE_MARKER}' ELSE replace(body, '{T.SARCASM_MARKER}', '') END",
    ]


def register_sql_functions(spark: SparkSession) -> None:
    """Create the temporary SQL functions in this session."""
    for ddl in function_ddl():
        spark.sql(ddl)
