from .columns import (
    clean_keywords,
    count_distinct_values,
    count_values_with_null,
    desc_keys,
    keyword_hits,
    null_or_empty,
    pattern_hits,
    substring_hits,
)
from .scalars import attach_scalars, attach_stats, min_max_scaled
from .text import (
    FREQUENCY_MIN_LENGTH,
    FREQUENCY_STOP_WORDS,
    blank_split_words,
    ENGLISH_STOP_WORDS,
    english_stop_words,
    not_in_words,
    sql_string,
    tokens,
)

__all__ = [
    "FREQUENCY_MIN_LENGTH",
    "FREQUENCY_STOP_WORDS",
    "attach_scalars",
    "attach_stats",
    "blank_split_words",
    "clean_keywords",
    "count_distinct_values",
    "count_values_with_null",
    "desc_keys",
    "ENGLISH_STOP_WORDS",
    "english_stop_words",
    "keyword_hits",
    "min_max_scaled",
    "not_in_words",
    "null_or_empty",
    "pattern_hits",
    "sql_string",
    "substring_hits",
    "tokens",
]
