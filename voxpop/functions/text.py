"""Comment text cleaning as native Spark Column expressions.

Everything here compiles to JVM expressions (regexp_replace, regexp_extract_all,
replace, lower, higher-order filter/transform), so cleaning runs inside the
executors without a Python round trip and a NULL body yields NULL instead of a
failed task.

Rules (in order): fold the two-character sequence TAB+NEWLINE to a blank,
delete URLs, squeeze runs of two or more blanks, tokenise into word runs and
single punctuation marks, join with one blank and lower-case, re-glue three
literal sequences. Unigrams drop the bounding punctuation; bigrams and trigrams
are adjacent runs with no punctuation inside, joined by ``_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's cleaning rules exactly.
# ---------------------------------------------------------------------------
# Python's ``\s`` for str, written as an explicit class for Java regex
# (Java's ``\s`` is ASCII-only).
SPACE_CLASS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NON_SPACE_CLASS = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
TAB_NEWLINE = "\t\n"
URL_PATTERN = "http" + NON_SPACE_CLASS + "+"
SPACE_RUN_PATTERN = SPACE_CLASS + "{2,}"
# Python's ``\w`` is [\p{L}\p{N}_]; the token class adds ' / - % $.
TOKEN_PATTERN = r"[\p{L}\p{N}_'/%$\-]+|[.,!?;:]"
REGLUE_PAIRS = [("0 , 0", "0,0"), ("i . e", "i.e"), ("e . g", "e.g")]
BOUNDING_PUNCTUATION = [".", "!", ":", ",", ";", "?"]
QUOTE_MARKER = "&gt"
SARCASM_MARKER = "/s"
LINK_PREFIX = "t3_"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_tab_newline(text: Column | str) -> Column:
    """Replace every TAB+NEWLINE pair (not the class) by one blank."""
    return F.replace(_col(text), F.lit(TAB_NEWLINE), F.lit(" "))


def remove_urls(text: Column | str) -> Column:
    """Delete ``http`` followed by non-blank characters, anywhere."""
    return F.regexp_replace(_col(text), URL_PATTERN, "")


def squeeze_spaces(text: Column | str) -> Column:
    """A run of two or more blanks becomes one blank."""
    return F.regexp_replace(_col(text), SPACE_RUN_PATTERN, " ")


def tokenize(text: Column | str) -> Column:
    """T4: array of word runs and single punctuation marks; the rest vanishes."""
    return F.regexp_extract_all(_col(text), F.lit(TOKEN_PATTERN), 0)


def join_lower(tokens: Column | str) -> Column:
    """T5: join tokens with one blank and lower-case."""
    return F.lower(F.array_join(_col(tokens), " "))


def reglue(text: Column | str) -> Column:
    """The three literal re-glue replacements, in their fixed order."""
    out = _col(text)
    for before, after in REGLUE_PAIRS:
        out = F.replace(out, F.lit(before), F.lit(after))
    return out


def parse_text(text: Column | str) -> Column:
    """The parsed text (T1..T6 composed).

    T1 and T3 only rewrite runs of blanks, and neither a token nor the end of
    a URL can contain a blank, so they never change the token list; the
    composition skips those two passes and gives the same result.
    """
    return reglue(join_lower(tokenize(remove_urls(text))))


def parse_text_stepwise(text: Column | str) -> Column:
    """T7a with every rule applied literally."""
    return reglue(join_lower(tokenize(squeeze_spaces(remove_urls(fold_tab_newline(text))))))


def _is_bounding(word: Column) -> Column:
    return word.isin(*BOUNDING_PUNCTUATION)


def with_grams(
    df: DataFrame,
    text_col: str = "body",
    parsed_col: str = "parsed",
    keep_words: bool = False,
) -> DataFrame:
    """Add parsed text plus ``unigrams``, ``bigrams``, ``trigrams`` array columns.

    Staged projections, each referenced by name so it is computed once per row:
    words -> punctuation mask (NULL for bounding punctuation) -> bigram runs
    (mask zipped with itself shifted by one) -> trigram runs (bigram runs zipped
    with the mask shifted by two). The three gram lists are the non-NULL
    entries of mask, bigram runs and trigram runs.
    """
    # Parsed text joins non-empty tokens with single blanks (the re-glue steps
    # only remove blanks), so splitting yields no empty word unless the whole
    # text is empty: a CASE replaces the per-word filter pass.
    p = F.col(parsed_col)
    words = F.when(p == "", F.array().cast("array<string>")).otherwise(F.split(p, " "))
    staged = (
        df.withColumn(parsed_col, parse_text(text_col))
        .withColumn("_words", words)
        .withColumn("_mask", F.transform("_words", lambda w: F.when(~_is_bounding(w), w)))
    )

    def tail(arr: str, start: int, drop: int) -> Column:
        return F.slice(arr, F.lit(start), F.greatest(F.size(arr) - F.lit(drop), F.lit(0)))

    def extend(run: Column, w: Column) -> Column:
        return F.when(run.isNotNull() & w.isNotNull(), F.concat(run, F.lit("_"), w))

    staged = staged.withColumn("_bi", F.zip_with(tail("_mask", 1, 1), tail("_mask", 2, 1), extend))
    staged = staged.withColumn("_tri", F.zip_with(tail("_bi", 1, 1), tail("_mask", 3, 2), extend))
    out = (
        staged.withColumn("unigrams", F.filter("_mask", lambda g: g.isNotNull()))
        .withColumn("bigrams", F.filter("_bi", lambda g: g.isNotNull()))
        .withColumn("trigrams", F.filter("_tri", lambda g: g.isNotNull()))
        .drop("_mask", "_bi", "_tri")
    )
    return out if keep_words else out.drop("_words")


def union_grams(unigrams: Column | str, bigrams: Column | str, trigrams: Column | str) -> Column:
    """One flat gram list: unigrams, then bigrams, then trigrams; duplicates kept."""
    return F.concat(_col(unigrams), _col(bigrams), _col(trigrams))


def with_gram_list(df: DataFrame, text_col: str = "body", out_col: str = "grams") -> DataFrame:
    """T7 + T8: the ``grams`` array the models are trained and scored on."""
    staged = with_grams(df, text_col, parsed_col="_parsed")
    return staged.withColumn(out_col, union_grams("unigrams", "bigrams", "trigrams")).drop(
        "_parsed", "unigrams", "bigrams", "trigrams"
    )


def mark_quotes_and_sarcasm(body: Column | str) -> Column:
    """``&gt`` when the stripped body starts with a quote marker, else the body
    with every ``/s`` removed (also inside words and URLs, before URL removal)."""
    b = _col(body)
    starts_quoted = b.rlike("^" + SPACE_CLASS + "*" + QUOTE_MARKER)
    return F.when(starts_quoted, F.lit(QUOTE_MARKER)).otherwise(
        F.replace(b, F.lit(SARCASM_MARKER), F.lit(""))
    )


def strip_link_prefix(link_id: Column | str) -> Column:
    """Drop a leading ``t3_`` from a link id."""
    return F.regexp_replace(_col(link_id), "^" + LINK_PREFIX, "")


def epoch_to_day(epoch_seconds: Column | str) -> Column:
    """Epoch seconds -> ``yyyyMMdd`` as int, in UTC regardless of session zone.

    Day arithmetic on the epoch keeps it independent of
    ``spark.sql.session.timeZone``; week-year patterns are avoided on purpose.
    """
    day = F.date_from_unix_date(F.floor(_col(epoch_seconds) / F.lit(86400)).cast("int"))
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_key_to_date(day_key: Column | str) -> Column:
    """``yyyyMMdd`` int/string -> DATE."""
    return F.to_date(_col(day_key).cast("string"), "yyyyMMdd")


def timestamp_ntz_to_epoch(ts: Column | str) -> Column:
    """Epoch seconds of a wall-clock TIMESTAMP_NTZ read as UTC (no session zone)."""
    t = _col(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date"))
    return (
        days.cast("bigint") * 86400
        + F.hour(t) * 3600
        + F.minute(t) * 60
        + F.floor(F.second(t)).cast("bigint")
    )


def parse_bracketed_grams(text: Column | str) -> Column:
    """``"[a b c]"`` -> ``["a","b","c"]`` (strip the brackets, split on one blank);
    ``"[]"`` -> no gram."""
    t = _col(text)
    grams = F.split(F.substring(t, F.lit(2), F.length(t) - 2), " ")
    return F.when(F.length(t) <= 2, F.array().cast("array<string>")).otherwise(grams)
