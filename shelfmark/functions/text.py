"""Text expressions: tokens, search terms, HTML to text, line cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.common import let, run_starts

# Fixed patterns. A token is a maximal run of characters other than space, tab, CR
# and LF; a search term is a run of letters and digits of the lower-cased text.
TOKEN_PATTERN = r"[^ \t\r\n]+"
TERM_PATTERN = r"[\p{L}\p{N}]+"
SENTENCE_ENDS = (".", "!", "?")

# Fixed patterns for HTML: what is dropped with its content, which tags end a line,
# and the entities that are decoded (ampersand last, so that nothing is decoded twice).
HTML_DROPPED = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>"
HTML_LINE_TAGS = r"(?i)</?(p|br|div|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|title)\b[^>]*>"
HTML_TAGS = r"<[^>]*>"
HTML_ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
)


def tokens(text: Column) -> Column:
    """White-space separated tokens, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def terms(text: Column) -> Column:
    """Lower-cased search terms, in order and with repeats."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0))


def term_counts(text: Column) -> Column:
    """Distinct search terms with their counts, ``array<struct<term, tf>>``, by term.

    One sort per row and one pass over it: no shuffle and no quadratic search.
    """
    return let(
        F.sort_array(terms(text)),
        lambda s: let(
            run_starts(s),
            lambda starts: F.transform(
                starts,
                lambda p, j: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(starts, j + 1), F.size(s)) - p).alias("tf"),
                ),
            ),
        ),
    )


def term_slot(term: Column, dim: int) -> Column:
    """Hash slot of a term: the first 8 hex digits of its md5, modulo ``dim``."""
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint") % dim).cast("int")


def term_sign(term: Column) -> Column:
    """Hash sign of a term, from the ninth hex digit of its md5."""
    return F.when(F.substring(F.md5(term), 9, 1) < "8", F.lit(1.0)).otherwise(F.lit(-1.0))


def html_to_text(html: Column) -> Column:
    """Visible text of an HTML page; block tags become line ends."""
    out = F.regexp_replace(html, HTML_DROPPED, " ")
    out = F.regexp_replace(out, HTML_LINE_TAGS, "\n")
    out = F.regexp_replace(out, HTML_TAGS, " ")
    for entity, char in HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.regexp_replace(out, r"[ \t\r]+", " ")
    out = F.regexp_replace(out, r" ?\n[ \n]*", "\n")
    return F.trim(F.regexp_replace(out, r"^\n|\n$", ""))


def clean_lines(text: Column, min_letters: float = 0.5) -> Column:
    """Drop blank lines, later repeats of a line, and lines short of letters.

    A line stays when letters make up at least ``min_letters`` of its non-blank
    characters. Order is kept; the whole text is looked at.
    """
    squeezed = lambda line: F.regexp_replace(line, r"\s", "")
    letters = lambda line: F.regexp_replace(line, r"[^\p{L}]", "")
    kept = F.filter(
        F.array_distinct(F.transform(F.split(text, "\r?\n"), lambda line: F.trim(line))),
        lambda line: (F.length(squeezed(line)) > 0)
        & (F.length(letters(line)) >= F.length(squeezed(line)) * F.lit(float(min_letters))),
    )
    return F.array_join(kept, "\n")
