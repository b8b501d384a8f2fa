"""Text expressions: word splitting and the stop-word lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words the reference's keyword-frequency report leaves out, in its order.
FREQUENCY_STOP_WORDS = (
    "this", "that", "with", "from", "they",
    "have", "been", "were", "also", "very",
    "good", "nice", "great", "place", "visit",
)

# Minimum word length of the keyword-frequency report: words must be longer than this.
FREQUENCY_MIN_LENGTH = 3

# Whitespace class of java.util.regex ``\s`` spelled out, so that the same pattern means the
# same thing in Spark (Java regex) and in the DuckDB oracle (RE2, whose ``\s`` lacks \x0B).
WHITESPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"


# MLlib's default English stop words (``StopWordsRemover``), in its order. A plain
# list, so that neither a JVM nor a jar is needed to build a query or its oracle SQL.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now i'll you'll
    he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
    """.split()
)


def english_stop_words() -> tuple[str, ...]:
    """MLlib's default English stop words."""
    return ENGLISH_STOP_WORDS


def sql_string(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_in_words(column: str, words: tuple[str, ...]) -> Column:
    """``column NOT IN (words)`` as one SQL expression: built in one call however long the
    list, and planned as a hash-set lookup (InSet)."""
    return F.expr(f"NOT `{column}` IN ({', '.join(sql_string(w) for w in words)})")


def blank_split_words(text: str | Column) -> Column:
    """Lowercase, then split on every single blank (punctuation stays in the word)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(text), " ")


def tokens(text: str | Column) -> Column:
    """MLlib ``Tokenizer`` semantics: lowercase, split on each single whitespace
    character (runs of blanks give empty tokens, which callers drop)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(text), WHITESPACE_CLASS)
